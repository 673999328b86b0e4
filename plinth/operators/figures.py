"""Figure rows from Markdown: image tokens, groups of neighbouring images, captions, contexts, ids and sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from plinth.functions import text as X
from plinth.operators.captions import assignment, caption_lines, caption_segments

CONTEXT, CAPTION_REACH, GAP, LABEL_REACH, LABEL = 800, 1200, 80, 120, 30

_string, _int, _bool, _double = S.StringType(), S.IntegerType(), S.BooleanType(), S.DoubleType()
#: The columns of a figure row, in order.
FIGURE = S.StructType([
    S.StructField(name, kind)
    for kind, names in (
        (_string, "paper_id figure_id figure_id_raw"), (_int, "subfigure_index"),
        (_string, "subfigure_label alt_text image_path vision_image_path image_url base64_data image_hash image_origin mineru_img_path"),
        (_int, "page_idx page_number"), (S.ArrayType(_double), "bbox"), (_string, "bbox_format bbox_source"), (_int, "position"),
        (_string, "section_title context_before context_after raw_caption caption caption_source"), (_bool, "caption_cleaned"),
        (_string, "caption_truncation_reason"), (S.ArrayType(_string), "reference_sentences"),
        (_string, "description_text resnet_raw_class clip_label"), (_double, "clip_score"), (_string, "clip_decision figure_class"),
        (S.ArrayType(_string), "keyword_hits"), (_bool, "keep"), (_string, "keep_reason"),
        (_bool, "maybe_useful keep_for_archive send_to_vision_model"), (_string, "exclude_reason review_reason"),
        (_bool, "is_fragment"), (_string, "fragment_group_id"), (_int, "fragment_index"), (_double, "fragment_merge_confidence"),
        (_bool, "is_merged_figure"), (S.ArrayType(_string), "source_fragment_ids source_fragment_paths"),
        (_string, "merged_image_path merge_mode"),
    )
    for name in names.split()
])
DEFAULTS = {"image_origin": "mineru", "clip_decision": "not_run", "figure_class": "other", "keep": False, "maybe_useful": False, "keep_for_archive": True, "send_to_vision_model": False, "is_fragment": False, "is_merged_figure": False, "caption_cleaned": False}


def as_figures(rows: DataFrame) -> DataFrame:
    """The columns of FIGURE in order; missing ones get their defaults (null, or no elements for lists of sentences)."""
    empty = F.array().cast("array<string>")

    def column(f: S.StructField) -> Column:
        if f.name in rows.columns:
            return F.col(f.name).cast(f.dataType).alias(f.name)
        if f.name in ("reference_sentences", "keyword_hits", "source_fragment_ids", "source_fragment_paths"):
            return empty.alias(f.name)
        return F.lit(DEFAULTS.get(f.name)).cast(f.dataType).alias(f.name)

    return rows.select(*map(column, FIGURE.fields))


def image_tokens(papers: DataFrame) -> DataFrame:
    """paper_id, image_index, position, end, alt_text, raw_path, and the text up to the next image: one row per image."""
    spans = papers.withColumn("_spans", X.matches(F.col("markdown"), X.IMAGE)).select("paper_id", "markdown", "_spans", F.posexplode("_spans").alias("i", "x"))
    following = F.get(F.col("_spans"), F.col("i") + 1)["s"]
    before = F.get(F.col("_spans"), F.col("i") - 1)["e"]
    m = F.col("x.m")
    target = F.trim(F.regexp_replace(F.trim(F.regexp_extract(m, X.IMAGE, 2)), r"^\"+|\"+$", ""))
    return spans.select(
        "paper_id", (F.col("i") + 1).alias("image_index"), F.col("x.s").alias("position"), F.col("x.e").alias("end"),
        F.regexp_extract(m, X.IMAGE, 1).alias("alt_text"), F.regexp_replace(target, r"^'+|'+$", "").alias("raw_path"),
        X.window(F.col("markdown"), before, F.col("x.s")).alias("gap"),
        X.window(F.col("markdown"), F.col("x.e"), F.least(F.coalesce(following, F.length("markdown")), F.col("x.e") + CAPTION_REACH)).alias("after"),
        X.window(F.col("markdown"), F.col("x.s") - CONTEXT, F.col("x.s")).alias("context_before"),
        X.window(F.col("markdown"), F.col("x.s"), F.col("x.s") + CONTEXT).alias("context_after"),
        X.window(F.col("markdown"), F.col("x.s") - CONTEXT, F.col("x.e") + CONTEXT).alias("local"),
    )


def is_soft_gap(gap: Column) -> Column:
    """Whether two images belong together: nothing, or a short label without a caption, heading or sentence, between."""

    def soft(g: Column) -> Column:
        label = (F.length(g) <= GAP) & ~g.rlike(X.CAPTION_START) & ~g.rlike(X.HEADING) & ~g.rlike(f"[{X.ENDS}]") & g.rlike(r"(?U)^[\w\s/\-+&:：,，()（）]+$")
        return (g == "") | label

    return X.let(X.compact(gap), soft)


def short_label(text: Column) -> Column:
    """The first short line without sentence marks, unless a caption or heading comes before it."""
    state = F.struct(F.lit(False).alias("done"), F.lit(None).cast("string").alias("out"))

    def step(acc: Column, line: Column) -> Column:
        wall = line.rlike(X.CAPTION_START) | line.rlike(X.HEADING)
        good = (line != "") & (F.length(line) <= LABEL) & ~line.rlike(f"[{X.ENDS}]")
        return F.struct((acc["done"] | wall | good).alias("done"), F.when(~acc["done"] & ~wall & good, line).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.transform(X.lines(text), X.compact), state, step)["out"]


def image_groups(tokens: DataFrame) -> DataFrame:
    """Adds group (from 1), index_in_group, group_size: an island of images without a hard gap."""
    w = Window.partitionBy("paper_id").orderBy("position")
    hard = (F.lag("position").over(w).isNull() | ~is_soft_gap(F.col("gap"))).cast("int")
    rows = tokens.withColumn("_hard", hard).withColumn("group", F.sum("_hard").over(w).cast("int")).drop("_hard")
    g = Window.partitionBy("paper_id", "group")
    return rows.withColumn("index_in_group", F.row_number().over(g.orderBy("position"))).withColumn("group_size", F.count(F.lit(1)).over(g).cast("int"))


def captioned(groups: DataFrame) -> DataFrame:
    """Adds what the caption after the group's last image assigns to each image, and the group's fallback labels."""
    g = Window.partitionBy("paper_id", "group").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.coalesce(X.blank_to_null(X.compact(F.col("alt_text"))), short_label(F.when(F.col("index_in_group") < F.col("group_size"), F.col("after")).otherwise(F.left("after", F.lit(LABEL_REACH)))))
    rows = groups.withColumns({"_own": F.when(F.col("group_size") > 1, own), "_last": F.col("index_in_group") == F.col("group_size")})
    rows = rows.withColumn("_raw", F.when(F.col("_last"), F.array_join(caption_lines(F.col("after")), " ")))
    rows = rows.withColumn("_segments", F.when(F.col("_last"), caption_segments(F.col("_raw"))))
    rows = rows.withColumns({"_segments": F.last("_segments", ignorenulls=True).over(g), "_fallback": F.collect_list("_own").over(g)})
    return rows.withColumn("a", assignment(F.col("_segments"), F.col("group_size"), F.col("index_in_group"))).drop("_own", "_last", "_raw", "_segments")


def headings(papers: DataFrame) -> DataFrame:
    """paper_id, offset, title: one row per heading; offset is where its line (or the blank space before it) begins."""
    found = papers.select("paper_id", F.explode(X.matches(F.col("markdown"), X.HEADING)).alias("x"))
    return found.select("paper_id", F.col("x.s").alias("offset"), F.regexp_extract("x.m", X.HEADING, 1).alias("title"))


def with_sections(rows: DataFrame, found: DataFrame) -> DataFrame:
    """As-of join: the last heading at or before each row's position, by one window over both."""
    both = rows.withColumns({"offset": F.col("position"), "_title": F.lit(None).cast("string"), "_row": F.lit(True)}).unionByName(
        found.select("paper_id", "offset", F.col("title").alias("_title"), F.lit(False).alias("_row")), allowMissingColumns=True
    )
    w = Window.partitionBy("paper_id").orderBy("offset", "_row").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("section_title", F.last("_title", ignorenulls=True).over(w)).filter("_row").drop("offset", "_title", "_row")


def figure_rows(papers: DataFrame, images: DataFrame | None = None, layout: DataFrame | None = None) -> DataFrame:
    """Figure rows of papers (paper_id, markdown), as FIGURE.

    images (paper_id, raw_path, image_path, image_hash) gives local files and their hashes; of rows with one hash in a
    paper the first stays. layout (paper_id, key, ...) gives pages and boxes.
    """
    rows = with_sections(captioned(image_groups(image_tokens(papers))), headings(papers))
    if images is not None:
        rows = rows.join(images, ["paper_id", "raw_path"], "left")
    else:
        rows = rows.withColumns({"image_path": F.lit(None).cast("string"), "image_hash": F.lit(None).cast("string")})
    url = F.lower("raw_path").rlike(r"^https?://")
    rows = rows.withColumns({"image_url": F.when(url, F.col("raw_path")), "base64_data": X.data_uri_payload(F.col("raw_path"))})
    rows = rows.withColumn("image_hash", F.coalesce("image_hash", X.image_hash(F.lit(None).cast("binary"), F.col("base64_data"))))
    same = Window.partitionBy("paper_id", F.coalesce("image_hash", F.concat(F.lit("#"), F.col("position").cast("string")))).orderBy("position")
    rows = rows.withColumn("_copy", F.row_number().over(same)).filter("_copy = 1").drop("_copy")
    near = [X.figure_id(F.col(c)) for c in ("alt_text", "context_after", "context_before")]
    kth = F.row_number().over(Window.partitionBy("paper_id").orderBy("position"))
    name = F.coalesce(F.col("a.id"), *[n["id"] for n in near], F.concat(F.lit("Unknown Figure "), kth.cast("string")))
    rows = rows.withColumns({"figure_id": name, "figure_id_raw": F.coalesce(F.col("a.raw"), *[n["raw"] for n in near])})
    rows = rows.withColumn("_pseudo", X.pseudo_caption(F.col("figure_id"), F.col("local")))
    own_labels = F.when(F.size("a.labels") > 0, F.col("a.labels")).when(F.col("group_size") > 1, F.col("_fallback")).otherwise(F.array().cast("array<string>"))
    index = F.coalesce("a.subfigure_index", "index_in_group")
    rows = rows.withColumns({
        "raw_caption": F.col("a.raw_caption"), "caption": F.coalesce("a.caption", "_pseudo"),
        "caption_source": F.when(F.col("a.caption").isNotNull(), F.col("a.source")).when(F.col("_pseudo").isNotNull(), "pseudo_caption").otherwise("none"),
        "caption_cleaned": F.coalesce("a.cleaned", F.lit(False)), "caption_truncation_reason": F.col("a.reason"),
        "reference_sentences": F.coalesce("a.refs", F.array().cast("array<string>")),
        "subfigure_index": F.col("a.subfigure_index"),
        "subfigure_label": F.coalesce("a.subfigure_label", F.get(own_labels, index - 1)),
    })
    rows = rows.withColumn("description_text", X.description(F.col("caption"), F.col("reference_sentences"), F.col("figure_id"), F.col("subfigure_label"), F.col("context_after")))
    if layout is not None:
        from plinth.sources.layout import with_layout

        rows = with_layout(rows, layout)
    return indexed_copies(as_figures(rows))


def indexed_copies(figures: DataFrame) -> DataFrame:
    """Different images under one id and caption get the index of their position as subfigure_index."""
    key = ("paper_id", "figure_id", X.compact(F.col("caption")))
    w = Window.partitionBy(*key)
    several = (F.count(F.lit(1)).over(w) > 1) & (F.size(F.collect_set("image_hash").over(w)) > 1)
    named = (F.coalesce("caption", F.lit("")) != "") & ~F.col("figure_id").startswith("Unknown Figure")
    return figures.withColumn("subfigure_index", F.when(named & several, F.row_number().over(w.orderBy("position"))).otherwise(F.col("subfigure_index")))


def rewritten_paths(papers: DataFrame, images: DataFrame) -> DataFrame:
    """paper_id, markdown with local image targets replaced by their copied paths (images: paper_id, raw_path, image_path)."""
    tokens = image_tokens(papers).select("paper_id", "image_index", "position", "end", "alt_text", "raw_path")
    local = ~F.lower("raw_path").rlike(r"^(?:https?://|data:)")
    new = tokens.join(images.select("paper_id", "raw_path", "image_path"), ["paper_id", "raw_path"], "left").filter(local & F.col("image_path").isNotNull())
    edits = new.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("position", "end", F.concat(F.lit("!["), "alt_text", F.lit("]("), "image_path", F.lit(")")).alias("new")))).alias("edits"))
    rows = papers.join(edits, "paper_id", "left")
    text = F.col("markdown")
    # the text before each edit and its new words, then what follows the last one
    pieces = X.scanned(F.col("edits"), F.lit(0), "string", lambda at, x: (x["end"], F.concat(X.window(text, at, x["position"]), x["new"])))
    done = F.concat(F.array_join(pieces, ""), X.window(text, F.element_at("edits", -1)["end"], F.length(text)))
    return rows.select("paper_id", F.when(F.col("edits").isNull(), text).otherwise(done).alias("markdown"))
