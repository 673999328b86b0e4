"""What is known of the cases in plans.cases, as SQL: written down case by case, not computed by the library."""

from __future__ import annotations

SEM = "Fig.6 SEM images of gamma-Al2O3 fibers at low magnification(A), alpha-Al2O3 fibers at high magnification(B) and alpha-Al2O3 fibers after heat treatment(C)."
PHOTO, STEPS, STATES = "图2-4新制莫来石晶种分散液(a)及其放置3个月后(b)的光学照片", "图1.3 超滤离心管构造及使用步骤示意图", "Fig. 3 Photo of the sample in two states"
WORN, PANELS = "图3-17 所制纤维摩擦10000次后的损伤形貌(a)1#;(b)2#;(c)3#", "图6 SEM images of fibers at low magnification(a), high magnification(b), after treatment(c)."
KEY = "k, position, merged"
#: Paper, position, whether merged, figure id, sub-figure index and label, caption.
FIGURES = (
    (0, 0, False, "图2-4", 1, "a", PHOTO), (0, 18, False, "图2-4", 2, "b", PHOTO), (0, 36, False, "图2-5", None, None, "图2-5 新制莫来石晶种分散液的TEM"),
    (1, 9, False, "图1.3", 1, "Fill", STEPS), (1, 34, False, "图1.3", 2, "Spin", STEPS), (1, 59, False, "图1.3", 3, "Recover", STEPS), (1, 90, False, "图1.3", 4, "Collect", STEPS),
    (2, 0, False, "Fig.6", 1, "A", SEM), (2, 18, False, "Fig.6", 2, "B", SEM), (2, 36, False, "Fig.6", 3, "C", SEM),
    (3, 25, False, "图3.20", None, None, "图3.20 相关测试结果图"), (4, 13, False, "图2.3", None, None, "图2.3 XRD pattern of alumina sol powder."),
    (5, 0, False, "图3-17", None, None, "图3-17 所制纤维摩擦10000次后的损伤形貌。"), (6, 0, False, "Fig.2", None, None, "Fig. 2 Viscosity curve of the sol"),
    (7, 0, False, "Fig.3", 1, "low part", STATES), (7, 27, False, "Fig.3", 2, None, STATES),
    (8, 0, True, "图3-17", None, None, WORN), (8, 0, False, "图3-17", 1, "a", WORN), (8, 19, False, "图3-17", 2, "b", WORN), (8, 38, False, "图3-17", 3, "c", WORN),
    (8, 57, False, "图3-17", 4, None, WORN), (8, 76, False, "图3-17", 5, None, WORN),
    (9, 0, False, "图6", 1, "a", PANELS), (9, 19, False, "图6", 2, "b", PANELS), (9, 38, False, "图6", 3, "c", PANELS),
    (10, 0, False, "图8", 1, None, "图8 损伤形貌图"), (10, 19, False, "图8", 2, None, "图8 损伤形貌图"), (10, 38, False, "图8", 3, None, "图8 损伤形貌图"),
    (11, 0, False, "图9", 1, None, "图9 损伤形貌图"), (11, 19, False, "图9", 2, None, "图9 损伤形貌图"), (11, 38, False, "图9", 3, None, "图9 损伤形貌图"),
    (12, 0, False, "图10", 1, None, "图10 损伤形貌图"), (12, 19, False, "图10", 2, None, "图10 损伤形貌图"), (12, 38, False, "图10", 3, None, "图10 损伤形貌图"),
    (13, 0, False, "Unknown Figure 1", None, None, None), (14, 0, False, "图3.5", None, None, "图3.5 内确度下同种处理后的该酶的比值"), (15, 0, False, "图2.19", None, None, "图2.19 铝溶胶的XRD图"),
)
#: Sentences of a paper's figures by their id, best first.
SENTENCES = (
    (0, "图2-4", "如图2-4所示，晶种分散液放置后仍保持分散。"), (0, "图2-5", "图2-5显示晶种呈现典型TEM形貌。"), (1, "图1.3", "如图1.3所示，装置包括四个步骤。"),
    (2, "Fig.6", "由图6(A)可见，干凝胶纤维形成连续结构。"), (3, "图3.20", "核磁结果见图3.20。|如图3.20所示，^27Al NMR 和 ppm 信号发生变化。"),
    (4, "图2.3", "Figure 2.3 shows the same diffraction pattern in English.|如图2.3所示，样品出现明显的氧化铝衍射峰。"), (5, "图3-17", "如图3-17所示，1#纤维表面出现条带状损伤形貌。"),
    (6, "Fig.2", "Fig. 2 shows the viscosity curve of the sol sample.|As shown in Fig. 2, it rises.|See Fig. 2 for the raw data."), (15, "图2.19", "图2.19 铝溶胶的XRD图 图2.19为铝溶胶的XRD图，如图所示。"),
)
#: Class of a paper's figures by their id, and why they are not sent or are under review (from classes, from merging).
CLASSES = (
    (0, "图2-4", "photo_image", None, None, None), (0, "图2-5", "microscopy_image", None, None, "possible_fragment_single_image"),
    (1, "图1.3", "schematic_or_flow", "maybe_useful_schematic", None, "bbox_missing_for_fragment_group"), (2, "Fig.6", "microscopy_image", None, None, "bbox_missing_for_fragment_group"),
    (3, "图3.20", "nmr_spectrum", None, None, "possible_fragment_single_image"), (4, "图2.3", "xrd_pattern", None, None, "possible_fragment_single_image"),
    (5, "图3-17", "microscopy_image", None, None, "possible_fragment_single_image"), (6, "Fig.2", "rheology_curve", None, None, "possible_fragment_single_image"),
    (7, "Fig.3", "photo_image", None, None, None), (8, "图3-17", "microscopy_image", None, None, None), (9, "图6", "microscopy_image", None, None, None),
    (10, "图8", "microscopy_image", None, None, "bbox_missing_for_fragment_group"), (11, "图9", "microscopy_image", None, None, "fragments_not_on_same_page"),
    (12, "图10", "microscopy_image", None, None, "bbox_overlap_abnormal"), (13, "Unknown Figure 1", "other", "unknown_without_caption", "figure_class_other", None),
    (14, "图3.5", "other", "not_selected_for_vision", "caption_ocr_suspect", None), (15, "图2.19", "xrd_pattern", None, "multiple_figure_ids_caption_assignment_uncertain", None),
)
#: Page, box and dialect of figures with a layout.
BOXES = (
    (8, 0, True, 3, 100.0, 50.0, 700.0, 480.0, "content_list"), *((8, 19 * i, False, 3, 100.0, 50.0 + 90 * i, 700.0, 120.0 + 90 * i, "content_list") for i in range(5)),
    *((9, 19 * i, False, 1, 0.0, 400.0 * i, 400.0, 400.0 * i + 300, "content_list_v2") for i in range(3)),
    *((11, 19 * i, False, i // 2, 100.0, 50.0 + 90 * i, 700.0, 120.0 + 90 * i, "content_list_v2") for i in range(3)),
    *((12, 19 * i, False, 2, 125.0, 250 + 31.25 * i, 750.0, 375 + 31.25 * i, "model_json") for i in range(3)),
)
#: Caption, what follows it, and why it was cut.
CAPTIONS = (
    ("图3.2高 pH 铝溶胶调节前后核磁谱图", "由图3.2可知，处理后谱峰发生变化。", "repeated_figure_id"), ("图2.6不同搅拌速度合成的铝溶胶核磁谱图(a)和核磁积分比例图(b)", "由图2.6(a)可见，核磁结果差别不大。", "explanatory_phrase"),
    ("图3.8Al-Ferron比色标准曲线与标准方程 铝溶胶测定", "数据见表3.3。", "explanatory_phrase"), ("图2.19 铝溶胶的XRD图", "图2.19为铝溶胶的XRD图，如图所示。", "repeated_figure_id"),
    ("图3.6 ^27AlNMR 的化学位移范围", "铝溶胶中含有多种水合铝团簇形态，根据核磁共振的原理可知。", "explanatory_phrase"), ("图2.6 不同搅拌速度合成的铝溶胶核磁谱图(a)和核磁积分比例图(b)", "", None),
    ("图2.5不同起始反应温度的烧瓶内溶液温度变化图：(a) 50°C ，(b) 55°C", "结合之前关于反应温度的探究，起始反应温度为50°C时更有利。", "explanatory_phrase"),
    ("Fig. 3 XRD patterns of alumina fibers after calcination.", "The results show that phase conversion occurred.", "explanatory_phrase"),
    ("图2-12 粘度为800Pa·s的溶胶的流变性特征", "可纺丝溶胶的热失重(TG)曲线表明，有机物逐步分解。", "explanatory_phrase"), ("图3-16所制纤维往复线性摩擦测试照片", "测试发现，试样1没有发生断裂。", "explanatory_phrase"),
    ("图3-17所制纤维摩擦10000次后的损伤形貌(a)1#；(b)2#；(c)3#", "从动摩擦系数测试结果来看，所制氧化铝连续纤维摩擦系数趋于稳定。", "explanatory_phrase"),
    ("图2-18纺丝环境参数的影响", "图2-19采用400孔喷丝板进行纺丝的过程", "multiple_figure_ids_in_caption"), ("图3-17所制纤维摩擦10000次后的损伤形貌(a)1#；(b)2#；(c)3#", "", None),
)
_SENT, _MAYBE = (True, False, None), (False, True, "maybe_useful_schematic")
#: Class, (sent, maybe useful, why not sent), review reason, and what all options turned make of sending and why not.
SELECTION = (
    ("nmr_spectrum", _SENT, None, None), ("nmr_spectrum", _SENT, None, None), ("nmr_spectrum", _SENT, None, None), ("nmr_spectrum", _SENT, None, None),
    ("nmr_spectrum", _SENT, None, None), ("nmr_quantification_plot", _SENT, None, None), ("microscopy_image", _SENT, None, None), ("ftir_spectrum", _SENT, None, None),
    ("schematic_or_flow", _MAYBE, "scientific_figure_not_sent_to_vision", None), ("schematic_or_flow", _MAYBE, None, None), ("schematic_or_flow", _MAYBE, None, None),
    ("mass_spectrum", _SENT, None, None), ("photo_image", (True, True, None), None, "maybe_useful_material_state_photo"), ("photo_image", _SENT, None, None),
    ("temperature_curve", _SENT, None, None), ("photo_image", (True, True, None), None, "maybe_useful_spinnability_photo"), ("microscopy_image", _SENT, None, None),
    ("schematic_or_flow", _MAYBE, None, None), ("logo_or_icon", (False, False, "logo_or_icon"), None, "logo_or_icon"),
    ("other", (False, False, "not_selected_for_vision"), "caption_ocr_suspect", "not_selected_for_vision"), ("process_parameter_plot", _SENT, None, None),
    ("generic_chart_or_plot", _SENT, None, None), ("mechanical_property_plot", _SENT, None, None), ("xrd_pattern", _SENT, None, None), ("schematic_or_flow", _MAYBE, None, None),
    ("schematic_or_flow", _MAYBE, None, None), ("elemental_mapping", _SENT, None, None), ("rheology_curve", _SENT, None, None), ("microscopy_image", _SENT, None, None),
    ("other", (False, False, "not_selected_for_vision"), "figure_class_other", "not_selected_for_vision"),
    ("microscopy_image", (False, False, "replaced_by_bbox_stitched_figure"), "caption_truncated", "replaced_by_bbox_stitched_figure"),
    ("process_parameter_plot", _SENT, "multiple_figure_ids_in_caption", None), ("other", (False, False, "unknown_without_caption"), "figure_class_other", "unknown_without_caption"),
    ("other", _SENT, "figure_class_other", None), ("other", (False, False, "clip_negative"), "figure_class_other", "clip_negative"),
    ("logo_or_icon", (False, False, "logo_or_icon"), "scientific_figure_not_sent_to_vision", "logo_or_icon"), ("nmr_spectrum", _SENT, "taxonomy_conflict", None),
    ("qr_code_or_barcode", (False, False, "qr_code_or_barcode"), None, "qr_code_or_barcode"), ("table_image", (False, False, "table_image"), None, "table_image"),
)
FALSE_CANDIDATES, REVIEWED = (35,), (8, 19, 29, 31, 32, 33, 34, 35, 36)
N_PAPERS = 16


def _literal(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, (bool, int, float)) else "'" + v.replace("'", "''") + "'"


def values(rows, columns: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows) + f") v({columns})"


def _numbered(rows) -> list[tuple]:
    return [(k, *r) for k, r in enumerate(rows)]


_KNOWN = f"""
WITH e AS (SELECT * FROM {values(FIGURES, KEY + ", figure_id, ix, label, caption")}),
s AS (SELECT * FROM {values(SENTENCES, "k, figure_id, sentences")}),
c AS (SELECT * FROM {values(CLASSES, "k, figure_id, figure_class, why, review, merging")}),
b AS (SELECT * FROM {values(BOXES, KEY + ", page, x0, y0, x1, y1, source")}),
f AS (
  SELECT doc_id::VARCHAR AS paper_id, e.position::INT AS position, e.merged AS is_merged_figure, e.*, s.sentences, c.* EXCLUDE (k, figure_id), b.* EXCLUDE (k, position, merged), e.k = 8 AND NOT e.merged AS piece
  FROM documents d JOIN e ON d.doc_id % {N_PAPERS} = e.k LEFT JOIN s ON e.k = s.k AND e.figure_id = s.figure_id JOIN c ON e.k = c.k AND e.figure_id = c.figure_id
  LEFT JOIN b ON e.k = b.k AND e.position = b.position AND e.merged = b.merged
), g AS (
  SELECT *, NOT piece AND why IS NULL AS sent, CASE WHEN piece THEN 'replaced_by_bbox_stitched_figure' ELSE why END AS reason,
    CASE WHEN caption IS NULL THEN 'none' WHEN k = 3 THEN 'pseudo_caption' ELSE 'standard_caption' END AS caption_source FROM f
)"""
_COUNTS = {
    "final_figure_record": "true", "keep_for_archive": "true", "send_to_vision_model": "sent", "send_to_vision_model_false": "NOT sent", "logo_or_front_matter": "k = 13",
    "clip_positive": "false", "clip_negative": "false", "clip_uncertain": "false", "clip_not_run": "true", "unknown_figure": "k = 13", "caption_none": "caption IS NULL",
    "pseudo_caption": "k = 3", "fragment": "piece", "merged_figure": "is_merged_figure", "bbox_attached": "page IS NOT NULL", "bbox_missing": "page IS NULL",
    "bbox_stitched_figure": "is_merged_figure", "false_candidate": "false", "review_candidate": "review IS NOT NULL",
}


def _by_part(rows, columns: str, select: str, where: str = "true") -> str:
    return f"SELECT {select} FROM part JOIN {values(_numbered(rows), 'k, ' + columns)} ON p_partkey % {len(rows)} = k WHERE {where}"


ORACLES: dict[str, str] = {
    "case_figures": f"""{_KNOWN} SELECT paper_id, position, is_merged_figure, figure_id, ix::INT AS subfigure_index, label AS subfigure_label, caption, caption_source, k = 15 AS caption_cleaned,
  CASE WHEN k = 15 THEN review END AS caption_truncation_reason, CASE k WHEN 1 THEN '第一章 绪论' WHEN 3 THEN '第三章 3.3 结果' WHEN 4 THEN '第二章 2.3 结果' END AS section_title FROM g""",
    "case_links": f"{_KNOWN} SELECT paper_id, position, is_merged_figure, coalesce(sentences, '') AS sentences FROM g",
    "case_classes": f"{_KNOWN} SELECT paper_id, position, is_merged_figure, figure_class, sent AS send_to_vision_model, reason AS exclude_reason, review AS review_reason, merging AS merge_review_reason FROM g",
    "case_fragments": f"""{_KNOWN} SELECT paper_id, position, is_merged_figure, page::INT AS page_idx, x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1, source AS bbox_source, piece AS is_fragment,
  CASE WHEN piece THEN ix::INT END AS fragment_index, CASE WHEN k = 8 THEN concat(paper_id, '_fragment_group_001') END AS fragment_group_id, CASE WHEN k = 8 THEN 0.99::DOUBLE END AS fragment_merge_confidence,
  CASE WHEN is_merged_figure THEN 'bbox_grid_stitch' END AS merge_mode, CASE WHEN is_merged_figure THEN 'stitched_from_bbox_fragments' WHEN piece THEN 'mineru_fragment' ELSE 'mineru' END AS image_origin,
  CASE WHEN is_merged_figure THEN 5 ELSE 0 END AS n_sources FROM g""",
    "case_summary": f"""{_KNOWN} SELECT paper_id, (CASE WHEN k = 13 THEN 2 ELSE count_if(NOT is_merged_figure) END)::BIGINT AS raw_image_count, (CASE WHEN k = 8 THEN 1 ELSE 0 END)::BIGINT AS fragment_group_count,
  {", ".join(f"count_if({c})::BIGINT AS {n}_count" for n, c in _COUNTS.items())} FROM g GROUP BY paper_id, k""",
    "case_merge_modes": f"{_KNOWN} SELECT paper_id, CASE WHEN is_merged_figure THEN 'bbox_grid_stitch' ELSE 'none' END AS merge_mode, count(*) AS n FROM g GROUP BY 1, 2",
    "case_captions": _by_part(CAPTIONS, "caption, following, reason", "p_partkey, caption, following, reason"),
    "case_selection": _by_part(
        [(c, *chosen, review, other) for c, chosen, review, other in SELECTION], "figure_class, sent, maybe, why, review, other",
        "p_partkey::INT AS position, figure_class, sent AS send_to_vision_model, maybe AS maybe_useful, why AS exclude_reason, review AS review_reason",
    ),
    "case_selection_options": _by_part([(other,) for *_, other in SELECTION], "other", "p_partkey::INT AS position, other IS NULL AS send_to_vision_model, other AS exclude_reason"),
    "case_false_candidates": _by_part([(c,) for c, *_ in SELECTION], "c", "p_partkey::INT AS position", f"k IN ({', '.join(map(str, FALSE_CANDIDATES))})"),
    "case_review_candidates": _by_part([(c,) for c, *_ in SELECTION], "c", "p_partkey::INT AS position", f"k IN ({', '.join(map(str, REVIEWED))})"),
    "image_heads": "SELECT item_id, ['.jpg', '.gif', '.webp', '.bmp', '.png'][item_id % 5 + 1] AS extension, [true, true, false, false, true][item_id % 5 + 1] AS valid FROM benchmark",
    "distinct_texts": r"""SELECT doc_id, CASE WHEN t = '' THEN 0 ELSE 1 END::INT AS n, CASE WHEN t <> '' THEN length(t)::INT END AS chars
FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[\x09-\x0D\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS t FROM documents)""",
}
