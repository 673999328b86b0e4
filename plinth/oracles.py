"""SQL that gives the rows of the queries, written for the given tables and independent of the Spark plans."""

from __future__ import annotations

import re

from plinth.functions import taxonomy as T
from plinth.oracle_cases import ORACLES as CASES
from plinth.plans.papers import papers_sql

SPACE = r"[\x09-\x0D\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def hit(column: str, word: str) -> str:
    w = word.lower()
    return f"regexp_matches({column}, {q('(^|[^a-z0-9])' + re.escape(w) + '($|[^a-z0-9])')})" if T.is_token(w) else f"contains({column}, {q(w)})"


def any_of(column: str, words) -> str:
    return "(" + " OR ".join(hit(column, w) for w in words) + ")"


def hits_sql(column: str) -> str:
    cells = ", ".join(f"CASE WHEN {hit(column, k)} THEN {q(k)} END" for k in T.all_keywords())
    return f"array_to_string(list_sort(list_distinct(list_filter([{cells}], lambda x: x IS NOT NULL))), '|')"


#: The figures that papers hold, put together from their pieces.
FIGURES = f"""
WITH p AS ({papers_sql()}), f AS (
  SELECT paper_id, markdown, 1 AS image_index, '' AS alt_text, concat('images/', paper_id, '_1.png') AS raw_path, 1 AS grp, 1 AS ing, 1 AS gsize,
    'Fig.1' AS figure_id, 'Part ' || (doc_id % 7)::VARCHAR AS section_title, concat('Fig. 1 ', phrase) AS caption,
    'standard_caption' AS caption_source, NULL::INT AS subfigure_index, NULL AS subfigure_label, 'As shown in Fig. 1, the trend is clear;' AS ref FROM p
  UNION ALL
  SELECT paper_id, markdown, 1 + k, '', concat('images/', paper_id, '_', (1 + k)::VARCHAR, '.png'), 2, k, 2,
    '图2', 'Results', concat('图2 ', chinese, '(A)(B)'), 'standard_caption', k, ['A', 'B'][k], '由图2可知结果是好的。' FROM p, (SELECT unnest([1, 2])::INT AS k)
  UNION ALL
  SELECT paper_id, markdown, 4, 'logo', concat('https://example.org/', paper_id, '.png'), 3, 1, 1,
    'Fig.1', 'Results', '图1 相关测试结果图', 'pseudo_caption', NULL, NULL, 'As shown in Fig. 1, the trend is clear;' FROM p
), g AS (
  SELECT *, (instr(markdown, concat('![', alt_text, '](', raw_path, ')')) - 1)::INT AS position,
    concat(figure_id, CASE WHEN subfigure_label IS NULL THEN '' ELSE concat('(', subfigure_label, ')') END, ': ', caption, ' ', ref) AS description
  FROM f
)"""


def classified() -> str:
    """The figures with text t, caption c, class, and selection."""
    kw = T.KEYWORDS

    def t(words) -> str:
        return any_of("t", words)

    def c(words) -> str:
        return any_of("c", words)

    plain = f"NOT {c(T.CAPTION_SCIENTIFIC)}"
    counted = f"({c(T.NMR_QUANTIFICATION)} OR (caption_source = 'pseudo_caption' AND {t(T.NMR_QUANTIFICATION)}))"
    rules = [
        (f"{t(T.NMR)} AND {counted} AND coalesce(lower(subfigure_label), '') <> 'a'", "nmr_quantification_plot"), (t(T.NMR), "nmr_spectrum"),
        (c(kw["elemental_mapping"]), "elemental_mapping"), (c(T.CAPTION_PHOTO), "photo_image"), (c(T.CAPTION_XRD), "xrd_pattern"),
        (c(T.CAPTION_FTIR), "ftir_spectrum"), (c(kw["raman_spectrum"]), "raman_spectrum"), (c(T.CAPTION_THERMAL), "thermal_analysis_plot"),
        (c(T.CAPTION_MICROSCOPY), "microscopy_image"), (t(kw["elemental_mapping"]), "elemental_mapping"), (c(T.CAPTION_RHEOLOGY), "rheology_curve"),
        (t(T.TEMPERATURE), "temperature_curve"), (t(kw["process_parameter_plot"]), "process_parameter_plot"),
        (t(kw["mechanical_property_plot"]), "mechanical_property_plot"), (t(kw["mechanical_curve"]), "mechanical_curve"), (t(T.SPINNABILITY), "photo_image"),
        (f"{c(kw['schematic_or_flow'])} AND {plain}", "schematic_or_flow"), (f"{c(T.CAPTION_SCHEMATIC)} AND {plain}", "schematic_or_flow"),
        (f"{t(T.STRUCTURE)} AND {plain}", "schematic_or_flow"), *((t(kw[k]), k) for k in T.BY_KEYWORD),
    ]
    case = "CASE " + " ".join(f"WHEN {w} THEN {q(k)}" for w, k in rules) + " ELSE 'other' END"
    in_vision = "(" + ", ".join(map(q, T.VISION_CLASSES)) + ")"
    junk = "(" + ", ".join(map(q, T.JUNK_CLASSES)) + ")"
    return f"""{FIGURES}, t AS (SELECT *, lower(concat(caption, ' ', ref, ' ', description)) AS t, lower(caption) AS c FROM g),
k AS (SELECT *, {case} AS figure_class FROM t),
s AS (SELECT *, CASE WHEN figure_class IN {junk} THEN figure_class WHEN figure_class = 'schematic_or_flow' THEN 'maybe_useful_schematic'
  WHEN figure_class IN {in_vision} THEN NULL ELSE 'not_selected_for_vision' END AS exclude_reason,
  figure_class = 'schematic_or_flow' OR (figure_class = 'photo_image' AND ({t(T.MATERIAL_STATE)} OR {t(T.SPINNABILITY)})) AS maybe_useful FROM k),
v AS (SELECT *, exclude_reason IS NULL AS send_to_vision_model, CASE
  WHEN {t(kw["elemental_mapping"])} AND figure_class <> 'elemental_mapping' THEN 'taxonomy_conflict'
  WHEN figure_class = 'other' THEN 'figure_class_other'
  WHEN {t(T.FALSE_CANDIDATE)} AND exclude_reason IS NOT NULL THEN 'scientific_figure_not_sent_to_vision' END AS review_reason,
  exclude_reason IS NOT NULL AND figure_class <> 'schematic_or_flow' AND {t(T.FALSE_CANDIDATE)} AS false_candidate FROM s)
"""


V = classified()
CLASS_ROWS = ", ".join(f"({i}, {q(c)})" for i, c in enumerate(T.CLASSES))
PROMPTS = "[" + ", ".join(map(q, T.POSITIVE_PROMPTS + T.NEGATIVE_PROMPTS)) + "]"

ORACLES: dict[str, str] = {
    "image_tokens": f"{FIGURES} SELECT paper_id, image_index::INT AS image_index, position, alt_text, raw_path FROM g",
    "image_groups": f"{FIGURES} SELECT paper_id, image_index::INT AS image_index, grp::INT AS grp, ing::INT AS index_in_group, gsize::INT AS group_size FROM g",
    "section_asof": f"{FIGURES} SELECT paper_id, position, section_title FROM g",
    "context_windows": f"""{FIGURES} SELECT paper_id, position, substr(markdown, greatest(position - 800, 0) + 1, least(position, 800)) AS context_before,
  substr(markdown, position + 1, 800) AS context_after FROM g""",
    "caption_assign": f"{FIGURES} SELECT paper_id, position, figure_id, caption, caption_source, subfigure_index, subfigure_label FROM g",
    "caption_split": """WITH n AS (SELECT doc_id, doc_id % 4 AS k, (doc_id % 50 + 1)::VARCHAR AS n FROM documents)
SELECT doc_id, CASE k WHEN 0 THEN concat('Fig. ', n, ' curve of the sol') WHEN 1 THEN concat('Fig. ', n, ' curve of the sol see') ELSE concat('图', n, ' 溶胶曲线') END AS caption,
  CASE k WHEN 1 THEN 'multiple_figure_ids_in_caption' WHEN 2 THEN 'explanatory_phrase' WHEN 3 THEN 'repeated_figure_id' END AS reason FROM n""",
    "reference_topk": f"{FIGURES} SELECT paper_id, position, 1 AS rank, ref AS sentence FROM g",
    "descriptions": f"{FIGURES} SELECT paper_id, position, description AS description_text FROM g",
    "rewritten_paths": f"""WITH p AS ({papers_sql()}) SELECT paper_id, sha256(replace(markdown, concat('](images/', paper_id, '_1.png)'), concat('](/figures/', paper_id, '/a.png)'))) AS markdown_sha256 FROM p""",
    "keyword_hits": f"{V} SELECT paper_id, position, {hits_sql('t')} AS keyword_hits FROM v",
    "classify": f"{V} SELECT paper_id, position, figure_class FROM v",
    "vision_select": f"{V} SELECT paper_id, position, send_to_vision_model, maybe_useful, exclude_reason, coalesce(exclude_reason, concat('vision_', figure_class)) AS keep_reason FROM v",
    "review_reasons": f"{V} SELECT paper_id, position, review_reason FROM v WHERE review_reason IS NOT NULL",
    "false_candidates": f"{V} SELECT paper_id, position FROM v WHERE false_candidate",
    "review_candidates": f"{V} SELECT paper_id, position FROM v WHERE review_reason IS NOT NULL",
    "class_histogram": f"{V} SELECT ord, figure_class, coalesce(n, 0) AS n FROM (VALUES {CLASS_ROWS}) d(ord, figure_class) LEFT JOIN (SELECT figure_class, count(*) AS n FROM v GROUP BY 1) USING (figure_class)",
    "merge_mode_counts": f"{FIGURES} SELECT paper_id, 'none' AS merge_mode, count(*) AS n FROM g GROUP BY 1",
    "stage_summary": f"""{V} SELECT paper_id, 4::BIGINT AS raw_image_count, count(*) AS final_figure_record_count, count(*) AS keep_for_archive_count,
  count_if(send_to_vision_model)::BIGINT AS send_to_vision_model_count, count_if(NOT send_to_vision_model)::BIGINT AS send_to_vision_model_false_count,
  count_if(figure_class = 'logo_or_icon')::BIGINT AS logo_or_front_matter_count, 0::BIGINT AS unknown_figure_count, 0::BIGINT AS caption_none_count,
  count_if(caption_source = 'pseudo_caption')::BIGINT AS pseudo_caption_count, 0::BIGINT AS fragment_group_count, count(*) AS bbox_missing_count,
  count(*) AS clip_not_run_count, count_if(false_candidate)::BIGINT AS false_candidate_count, count_if(review_reason IS NOT NULL)::BIGINT AS review_candidate_count
FROM v GROUP BY 1""",
    "sentence_counts": r"""WITH m AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '!\[[^\]]*\]\([^\n]*\)', ' ', 'g'), '`[^`]*`', ' ', 'g'), '\[[^\]]+\]\([^)]+\)', ' ', 'g') AS t FROM documents
), s AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '([0-9])\.([0-9])', '\1~\2', 'g'), '([0-9])\.([0-9])', '\1~\2', 'g'), '(?i)(fig|ref|eq|al)\.', '\1~', 'g') AS t FROM m
)
SELECT doc_id, len(list_filter(regexp_split_to_array(t, '[。；;？！!?.]')[:-2], lambda x: length(trim(regexp_replace(x, '__SPACE__', ' ', 'g'))) + 1 >= 8))::INT AS n FROM s""".replace("__SPACE__", SPACE),
    "compact_documents": f"SELECT doc_id, sha256(trim(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g'))) AS compact_sha256 FROM documents",
    "dedupe_by_hash": "SELECT min(doc_id) AS doc_id, sha256(text) AS text_hash FROM documents WHERE text IS NOT NULL GROUP BY 2",
    "token_counts": r"SELECT doc_id, len(list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z][A-Za-z0-9_-]{2,}|[0-9]+(?:[.\-][0-9]+)*|[\x{4e00}-\x{9fff}]{2,}'), lambda x: lower(x))))::INT AS n FROM documents",
    "chem_normalize": "SELECT doc_id, concat('X', doc_id::VARCHAR, ' α-Al2O3; 5 μm; 20 °C 1– 2 text') AS normalized FROM documents",
    "subfigure_labels": f"{FIGURES} SELECT paper_id, position, CASE WHEN grp = 2 THEN 'A|B' ELSE '' END AS labels FROM g",
    "html_table_cells": """SELECT n_regionkey::VARCHAR AS paper_id, 'table_001' AS table_id, row_idx, k::INT AS col_idx, ['key', 'name'][k + 1] AS header,
  CASE k WHEN 0 THEN n_nationkey::VARCHAR ELSE n_name END AS value
FROM (SELECT *, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INT AS row_idx FROM nation), (SELECT unnest([0, 1]) AS k)""",
    "table_shapes": f"WITH p AS ({papers_sql()}) SELECT paper_id, 'table_001' AS table_id, (instr(markdown, '<table>') - 1)::INT AS position, 1 AS rows, 2 AS columns, 'Table 1 counts' AS caption FROM p",
    "table_captions": """SELECT n_nationkey::VARCHAR AS paper_id, CASE n_nationkey % 3 WHEN 0 THEN concat('表', n_nationkey::VARCHAR, ' 组成')
  WHEN 1 THEN concat('Table ', n_nationkey::VARCHAR, ' sizes') ELSE '' END AS caption FROM nation""",
    "replaced_tables": f"""WITH p AS ({papers_sql()}) SELECT paper_id, sha256(regexp_replace(markdown, '<table>.*</table>', concat(chr(10), chr(10), '[TableID: table_001]', chr(10), chr(10),
  '| id | chars |', chr(10), '| --- | --- |', chr(10), '| ', paper_id, ' | ', n_chars::VARCHAR, ' |', chr(10), chr(10), 'CSV: [table_001.csv](tables/table_001.csv)', chr(10), chr(10),
  'JSON: [table_001.json](tables/table_001.json)', chr(10), chr(10)))) AS markdown_sha256 FROM p JOIN documents USING (doc_id)""",
    "layout_records": """SELECT p_brand AS paper_id, unnest([concat('images/p', p_partkey::VARCHAR, '.png'), concat('p', p_partkey::VARCHAR, '.png')]) AS key, p_size::INT AS page_idx,
  p_size::INT + 1 AS page_number, p_name AS caption, p_retailprice AS x1 FROM part""",
    "layout_join": """SELECT p_partkey, p_size::INT AS page_idx, concat('images/p', p_partkey::VARCHAR, '.png') AS mineru_img_path FROM part""",
    "fragment_groups": """WITH r AS (SELECT l_orderkey, l_linenumber AS n, 600 + l_linenumber AS w, (l_quantity * 10)::INT AS h FROM lineitem),
s AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT n) AS places, count_if(w::DOUBLE / greatest(h, 1) > 3 OR h < 180) AS bad, min(w) AS w0, max(w) AS w1, min(h) AS h0, max(h) AS h1 FROM r GROUP BY 1)
SELECT l_orderkey::VARCHAR AS paper_id, n, bad AS n_abnormal,
  CASE WHEN n = 1 AND bad = 1 THEN 'possible_fragment_single_image'
       WHEN NOT (n >= 3 AND (bad >= greatest(2, n // 2) OR (n >= 4 AND (w1 - w0)::DOUBLE / w1 <= 0.12 AND (h1 - h0)::DOUBLE / h1 <= 0.35 AND h1 < 260))) THEN 'none'
       WHEN places < n THEN 'bbox_overlap_abnormal' END AS reason FROM s""",
    "merge_confidence": """WITH r AS (SELECT l_orderkey, 600 + l_linenumber AS w, (l_quantity * 10)::INT AS h FROM lineitem),
s AS (SELECT l_orderkey, count(*) AS n, count_if(w::DOUBLE / greatest(h, 1) > 3 OR h < 180) AS bad FROM r GROUP BY 1)
SELECT l_orderkey::VARCHAR AS paper_id, least(round(0.45::DOUBLE + least(n, 6) * 0.05::DOUBLE + bad * 0.3::DOUBLE / n + 0.15::DOUBLE, 3), 0.99::DOUBLE) AS confidence FROM s""",
    "union_bbox": """SELECT l_orderkey::VARCHAR AS paper_id, min(l_linenumber * 10.0)::DOUBLE AS x0, min(l_linenumber * 5.0)::DOUBLE AS y0,
  max(l_linenumber * 10.0 + 10)::DOUBLE AS x1, max(l_linenumber * 5.0 + 5)::DOUBLE AS y1 FROM lineitem GROUP BY 1""",
    "bbox_overlap": """WITH b AS (SELECT l_orderkey AS o, row_number() OVER () AS i, l_quantity AS x0, l_quantity + 10 AS x1 FROM lineitem)
SELECT a.o::VARCHAR AS paper_id, round(max(greatest(least(a.x1, c.x1) - greatest(a.x0, c.x0), 0) / 10.0), 6) AS overlap FROM b a JOIN b c ON a.o = c.o AND a.i < c.i GROUP BY 1""",
    "clip_decision": f"""WITH s AS (SELECT vec_id, list_transform(embedding[1:25], lambda x: abs(x)::DOUBLE) AS s FROM embeddings),
m AS (SELECT *, list_max(s[1:15]) AS good, list_max(s[16:25]) AS bad, list_max(s) AS top FROM s)
SELECT vec_id, {PROMPTS}[list_position(s, top)] AS clip_label, top AS clip_score,
  CASE WHEN good >= bad * 1.05 THEN 'positive' WHEN bad >= good * 1.05 THEN 'negative' ELSE 'uncertain' END AS clip_decision FROM m""",
    "base64_checks": """SELECT item_id, octet_length(encode(text)) > 50 AS valid, '.png' AS extension, sha256(text) AS hash FROM benchmark""",
    "safe_data_ids": r"""SELECT p_partkey, left(concat(left(coalesce(nullif(regexp_replace(regexp_replace(p_name, '[^A-Za-z0-9_.\-]', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'paper'), 110), '-', left(sha1(p_name), 10)), 128) AS data_id FROM part""",
    **CASES,
}
