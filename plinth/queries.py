"""Queries over the given tables, one or more for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions import models, taxonomy
from plinth.functions import text as X
from plinth.functions.chemistry import normalize_chemistry
from plinth.operators import captions as P
from plinth.operators import classify as C
from plinth.operators import figures as G
from plinth.operators import fragments as H
from plinth.operators import linking as L
from plinth.operators import summary as K
from plinth.operators import tables as B
from plinth.plans import cases
from plinth.plans.papers import papers
from plinth.sources import layout as Y

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).select("paper_id", "markdown")


def _figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _papers(spark, sf_dir)
    return L.linked(G.figure_rows(p), p)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.classify(_figures(spark, sf_dir))


def image_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.image_tokens(_papers(spark, sf_dir)).select("paper_id", "image_index", "position", "alt_text", "raw_path")


def image_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = G.image_groups(G.image_tokens(_papers(spark, sf_dir)))
    return rows.select("paper_id", "image_index", F.col("group").alias("grp"), "index_in_group", "group_size")


def section_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _papers(spark, sf_dir)
    return G.with_sections(G.image_tokens(p).select("paper_id", "position"), G.headings(p)).select("paper_id", "position", "section_title")


def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.image_tokens(_papers(spark, sf_dir)).select("paper_id", "position", "context_before", "context_after")


def caption_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.figure_rows(_papers(spark, sf_dir)).select("paper_id", "position", "figure_id", "caption", "caption_source", "subfigure_index", "subfigure_label")


def caption_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions that run on in four ways: not at all, into another figure, into a phrase, into a repeated id."""
    n = (F.col("doc_id") % 50 + 1).cast("string")
    made = (
        F.concat(F.lit("Fig. "), n, F.lit(" curve of the sol")), F.concat(F.lit("Fig. "), n, F.lit(" curve of the sol see Fig. 99 shows more")),
        F.concat(F.lit("图"), n, F.lit(" 溶胶曲线 结果表明样品良好。")), F.concat(F.lit("图"), n, F.lit(" 溶胶曲线图"), n, F.lit("显示黏度下降。")),
    )
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.element_at(F.array(*made), (F.col("doc_id") % 4 + 1).cast("int")).alias("raw"))
    rows = rows.select("doc_id", P.caption_details(F.col("raw"), X.figure_id(F.col("raw"))["id"]).alias("d"))
    return rows.select("doc_id", "d.caption", "d.reason")


def reference_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _papers(spark, sf_dir)
    found = L.with_references(G.figure_rows(p), L.sentences(p))
    return found.select("paper_id", "position", F.posexplode("refs").alias("pos", "sentence")).select("paper_id", "position", (F.col("pos") + 1).alias("rank"), "sentence")


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _figures(spark, sf_dir).select("paper_id", "position", "description_text")


def rewritten_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _papers(spark, sf_dir)
    copies = p.select("paper_id", F.concat(F.lit("images/"), "paper_id", F.lit("_1.png")).alias("raw_path"), F.concat(F.lit("/figures/"), "paper_id", F.lit("/a.png")).alias("image_path"))
    return G.rewritten_paths(p, copies).select("paper_id", F.sha2("markdown", 256).alias("markdown_sha256"))


def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = X.let(C.classification_text(), lambda t: taxonomy.found_words(t, taxonomy.all_keywords()))
    hits = taxonomy.keyword_hits(words, taxonomy.all_keywords())
    return _figures(spark, sf_dir).select("paper_id", "position", F.array_join(hits, "|").alias("keyword_hits"))


def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("paper_id", "position", "figure_class")


def vision_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("paper_id", "position", "send_to_vision_model", "maybe_useful", "exclude_reason", "keep_reason")


def review_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).filter("review_reason is not null").select("paper_id", "position", "review_reason")


def false_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.false_candidates(_classified(spark, sf_dir)).select("paper_id", "position")


def review_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.review_candidates(_classified(spark, sf_dir)).select("paper_id", "position")


def class_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.class_histogram(_classified(spark, sf_dir))


def merge_mode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.merge_mode_counts(_figures(spark, sf_dir))


def stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = K.raw_image_counts(_papers(spark, sf_dir)).join(K.counts(_classified(spark, sf_dir)), "paper_id")
    names = "raw_image final_figure_record keep_for_archive send_to_vision_model send_to_vision_model_false logo_or_front_matter unknown_figure caption_none pseudo_caption fragment_group bbox_missing clip_not_run false_candidate review_candidate"
    return rows.select("paper_id", *[f"{n}_count" for n in names.split()])


def sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", F.size(X.complete_sentences(F.coalesce("text", F.lit("")))).alias("n"))


def compact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", F.sha2(X.compact(F.col("text")), 256).alias("compact_sha256"))


def dedupe_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.sha2("text", 256).alias("text_hash"))
    return rows.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", F.size(X.tokens(F.col("text"))).alias("n"))


def chem_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("X"), F.col("doc_id").cast("string"), F.lit(r" $\alpha$ - A l _{2} O _{3} ;5 \mu m ; 20 ^{\circ} C 1\sim 2 \mathrm{\text{text}}"))
    return _table(spark, sf_dir, "documents").select("doc_id", normalize_chemistry(raw).alias("normalized"))


def subfigure_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.figure_rows(_papers(spark, sf_dir)).select("paper_id", "position", F.array_join(X.labels(F.col("caption")), "|").alias("labels"))


def html_table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.concat(F.lit("<tr><td>"), F.col("n_nationkey").cast("string"), F.lit("</td><td>"), "n_name", F.lit("</td></tr>"))
    rows = _table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").cast("string").alias("paper_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("row")))), lambda x: x["row"]), "").alias("rows"))
    made = rows.select("paper_id", F.concat(F.lit("<table><tr><th>key</th><th>name</th></tr>"), "rows", F.lit("</table>")).alias("markdown"))
    return B.table_cells(B.parsed_tables(B.html_tables(made)))


def table_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table_info(_papers(spark, sf_dir)).select("paper_id", "table_id", "position", "rows", "columns", "caption")


def table_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caption line before a table, one after it, or none."""
    n, t = F.col("n_nationkey").cast("string"), "<table><tr><th>a</th></tr><tr><td>1</td></tr></table>\n"
    made = F.array(F.concat(F.lit("表"), n, F.lit(f" 组成\n{t}")), F.concat(F.lit(f"Words.\n{t}Table "), n, F.lit(" sizes\n")), F.lit(f"Words.\n{t}"))
    rows = _table(spark, sf_dir, "nation").select(n.alias("paper_id"), F.element_at(made, (F.col("n_nationkey") % 3 + 1).cast("int")).alias("markdown"))
    return B.table_info(rows).select("paper_id", "caption")


def replaced_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _papers(spark, sf_dir)
    return B.replaced_tables(p, B.table_info(p)).select("paper_id", F.sha2("markdown", 256).alias("markdown_sha256"))


def _layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("./images\\p"), F.col("p_partkey").cast("string"), F.lit(".png"))
    box = F.array(F.lit(0.0), F.lit(1.0), F.col("p_retailprice"), F.lit(9.0))
    block = F.struct(F.lit("image").alias("type"), path.alias("img_path"), F.col("p_size").alias("page_idx"), box.alias("bbox"), F.array(F.struct(F.lit("text").alias("type"), F.col("p_name").alias("content"))).alias("image_caption"))
    files = _table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("paper_id")).agg(F.to_json(F.collect_list(block)).alias("json"))
    return Y.image_layout(files.withColumn("name", F.lit("content_list.json")))


def layout_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layout(spark, sf_dir).select("paper_id", "key", "page_idx", "page_number", "caption", F.get("bbox", F.lit(2)).alias("x1"))


def layout_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("paper_id"), F.col("p_partkey").cast("int").alias("position"), F.concat(F.lit("/work/out/p"), F.col("p_partkey").cast("string"), F.lit(".png")).alias("raw_path"), F.lit(None).cast("string").alias("image_path"))
    return Y.with_layout(parts, _layout(spark, sf_dir)).select("p_partkey", "page_idx", "mineru_img_path")


def _strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    rows = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("paper_id"), F.lit(1).alias("grp"), n.cast("int").alias("position"), F.lit("Fig. 1 strips").alias("caption"), F.lit(1).alias("page_idx"),
        (n + 600).alias("width"), (F.col("l_quantity") * 10).cast("int").alias("height"), F.array(n * 10.0, n * 5.0, n * 10.0 + 10, n * 5.0 + 5).alias("bbox"),
    )
    rows = rows.withColumn("ratio", F.col("width") / F.greatest("height", F.lit(1)))
    return rows.withColumn("abnormal", (F.col("ratio") > H.RATIO) | (F.col("height") < H.HEIGHT))


def fragment_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.group_stats(_strips(spark, sf_dir)).select("paper_id", "n", "n_abnormal", "reason")


def merge_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.group_stats(_strips(spark, sf_dir)).select("paper_id", "confidence")


def union_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = H.group_stats(_strips(spark, sf_dir)).select("paper_id", "bbox")
    return box.select("paper_id", *[F.get("bbox", F.lit(i)).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))])


def bbox_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    rows = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("paper_id")).agg(F.collect_list(F.array(q, F.lit(0.0), q + 10, F.lit(1.0))).alias("boxes"))
    return rows.filter(F.size("boxes") > 1).select("paper_id", F.round(H.overlap_ratio(F.col("boxes")), 6).alias("overlap"))


def clip_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = F.transform(F.slice("embedding", 1, 25), lambda x: F.abs(x).cast("double"))
    return _table(spark, sf_dir, "embeddings").select("vec_id", models.clip_decision(scores).alias("c")).select("vec_id", "c.*")


def base64_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    # without line breaks, as in data URIs
    text = F.regexp_replace(F.base64(F.col("text").cast("binary")), r"\s", "")
    rows = _table(spark, sf_dir, "benchmark").select("item_id", text.alias("b"))
    uri = X.data_uri_payload(F.concat(F.lit("data:image/png;base64,"), "b"))
    return rows.select("item_id", X.is_base64_image(F.col("b")).alias("valid"), X.image_extension(F.col("b")).alias("extension"), X.image_hash(F.lit(None).cast("binary"), uri).alias("hash"))


def safe_data_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select("p_partkey", X.safe_data_id(F.col("p_name")).alias("data_id"))


def _case_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases.extraction(spark, sf_dir).figures


def case_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, captions, labels and sections of the figures of the known papers."""
    rows = _case_rows(spark, sf_dir)
    return rows.select("paper_id", "position", "is_merged_figure", "figure_id", "subfigure_index", "subfigure_label", "caption", "caption_source", "caption_cleaned", "caption_truncation_reason", "section_title")


def case_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference sentences, best first, and descriptions of the figures of the known papers."""
    return _case_rows(spark, sf_dir).select("paper_id", "position", "is_merged_figure", F.array_join("reference_sentences", "|").alias("sentences"))


def case_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes, selection and review of the figures of the known papers."""
    return _case_rows(spark, sf_dir).select("paper_id", "position", "is_merged_figure", "figure_class", "send_to_vision_model", "exclude_reason", "review_reason", "merge_review_reason")


def case_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, boxes and fragment marks of the figures of the known papers, from the three layout dialects."""
    box = [F.get("bbox", F.lit(i)).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))]
    return _case_rows(spark, sf_dir).select("paper_id", "position", "is_merged_figure", "page_idx", *box, "bbox_source", "is_fragment", "fragment_index", "fragment_group_id", "fragment_merge_confidence", "merge_mode", "image_origin", F.size("source_fragment_ids").alias("n_sources"))


def case_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counts of the known papers."""
    done = cases.extraction(spark, sf_dir)
    return K.raw_image_counts(done.papers).join(K.counts(done.figures), "paper_id")


def case_merge_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.merge_mode_counts(_case_rows(spark, sf_dir))


def case_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases.captions(spark, sf_dir)
    rows = rows.select("p_partkey", P.caption_details(F.col("raw"), F.coalesce("figure_id", X.figure_id(F.col("raw"))["id"])).alias("d"))
    return rows.select("p_partkey", "d.caption", F.array_join("d.refs", "|").alias("following"), "d.reason")


def case_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases.figures(spark, sf_dir).select("position", "figure_class", "send_to_vision_model", "maybe_useful", "exclude_reason", "review_reason")


def case_selection_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures with every option turned."""
    turned = C.Options(include_material_state_photos=False, include_schematics_for_vision=True, include_spinnability_photos_for_vision=False)
    return cases.figures(spark, sf_dir, turned).select("position", "send_to_vision_model", "exclude_reason")


def case_false_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.false_candidates(cases.figures(spark, sf_dir)).select("position")


def case_review_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.review_candidates(cases.figures(spark, sf_dir)).select("position")


def image_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that start like images of each kind: what they are taken for."""
    heads = F.array(*[F.unhex(F.lit(h)) for h in ("FFD8FF", "474946383961", "524946460000000057454250", "424D", "89504E470D0A1A0A")])
    content = F.concat(F.get(heads, F.pmod(F.col("item_id"), F.lit(5)).cast("int")), F.left("text", F.lit(9)).cast("binary"))
    rows = _table(spark, sf_dir, "benchmark").select("item_id", F.base64(content).alias("b"))
    return rows.select("item_id", X.image_extension(F.col("b")).alias("extension"), X.is_base64_image(F.col("b")).alias("valid"))


def distinct_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a text, the text with other white space, and an empty one, one is left; its length tells which."""
    both = F.array(F.concat(F.lit("  "), "text"), F.col("text"), F.lit(" "), F.concat("text", F.lit("\n")))
    return _table(spark, sf_dir, "documents").select("doc_id", X.distinct_texts(F.filter(both, lambda t: t.isNotNull())).alias("d")).select("doc_id", F.size("d").alias("n"), F.length(F.get("d", F.lit(0))).alias("chars"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        image_tokens, image_groups, section_asof, context_windows, caption_assign, caption_split, reference_topk, descriptions, rewritten_paths,
        keyword_hits, classify, vision_select, review_reasons, false_candidates, review_candidates, class_histogram,
        merge_mode_counts, stage_summary, sentence_counts, compact_documents, dedupe_by_hash, token_counts, chem_normalize,
        subfigure_labels, html_table_cells, table_shapes, table_captions, replaced_tables, layout_records, layout_join, fragment_groups,
        union_bbox, merge_confidence, bbox_overlap, clip_decision, base64_checks, safe_data_ids, case_figures, case_links, case_classes,
        case_fragments, case_summary, case_merge_modes, case_captions, case_selection, case_selection_options,
        case_false_candidates, case_review_candidates, image_heads, distinct_texts,
    )
}
