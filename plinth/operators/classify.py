"""Figure classes, selection for a vision model, and review: one pass of CASE expressions over figure rows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions import taxonomy as T
from plinth.functions import text as X

REPLACED = "replaced_by_bbox_stitched_figure"
UNCERTAIN, SEVERAL = "multiple_figure_ids_caption_assignment_uncertain", "multiple_figure_ids_in_caption"


@dataclass(frozen=True)
class Options:
    include_material_state_photos: bool = True
    include_schematics_for_vision: bool = False
    include_spinnability_photos_for_vision: bool = True
    keywords: dict[str, tuple[str, ...]] = field(default_factory=lambda: T.KEYWORDS)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def classification_text() -> Column:
    references = F.array_join(F.coalesce("reference_sentences", F.array().cast("array<string>")), " ")
    return F.lower(F.concat_ws(" ", _text("caption"), references, _text("description_text")))


def figure_class(text: Column, caption: Column, options: Options) -> Column:
    """The first rule that holds gives the class: special rules, the classes' keywords, then what models said.

    text and caption are the words found in the figure's text and caption.
    """
    kw = options.keywords

    def in_text(words: Iterable[str]) -> Column:
        return T.any_of(text, words)

    def in_caption(words: Iterable[str]) -> Column:
        return T.any_of(caption, words)

    no_caption = (_text("caption") == "") | F.col("caption_source").eqNullSafe("pseudo_caption")
    counted = in_caption(T.NMR_QUANTIFICATION) | (no_caption & in_text(T.NMR_QUANTIFICATION))
    plain = ~in_caption(T.CAPTION_SCIENTIFIC)
    rules = [
        (in_text(T.NMR) & counted & (F.lower(_text("subfigure_label")) != "a"), "nmr_quantification_plot"),
        (in_text(T.NMR), "nmr_spectrum"),
        (in_caption(kw["elemental_mapping"]), "elemental_mapping"),
        (in_caption(T.CAPTION_PHOTO), "photo_image"),
        (in_caption(T.CAPTION_XRD), "xrd_pattern"),
        (in_caption(T.CAPTION_FTIR), "ftir_spectrum"),
        (in_caption(kw["raman_spectrum"]), "raman_spectrum"),
        (in_caption(T.CAPTION_THERMAL), "thermal_analysis_plot"),
        (in_caption(T.CAPTION_MICROSCOPY), "microscopy_image"),
        (in_text(kw["elemental_mapping"]), "elemental_mapping"),
        (in_caption(T.CAPTION_RHEOLOGY), "rheology_curve"),
        (in_text(T.TEMPERATURE), "temperature_curve"),
        *((in_text(kw[c]), c) for c in ("process_parameter_plot", "mechanical_property_plot", "mechanical_curve")),
        (in_text(T.SPINNABILITY), "photo_image"),
        (plain & (in_caption([*kw["schematic_or_flow"], *T.CAPTION_SCHEMATIC]) | in_text(T.STRUCTURE)), "schematic_or_flow"),
        *((in_text(kw[c]), c) for c in T.BY_KEYWORD),
        *(((F.col("clip_decision") == "negative") & F.col("clip_label").isin(*labels), c) for c, labels in T.CLIP_CLASSES.items()),
        (F.col("resnet_raw_class").isin(*T.RESNET_TABLES), "table_image"),
        (F.col("resnet_raw_class").isin(*T.RESNET_SCHEMATICS) & in_text(kw["schematic_or_flow"]), "schematic_or_flow"),
        (F.col("resnet_raw_class").isin(*T.RESNET_CHARTS) | F.col("clip_label").isin(*T.CLIP_CHARTS), "generic_chart_or_plot"),
    ]
    out = F
    for condition, name in rules:
        out = out.when(condition, name)
    return out.otherwise("other")


def is_ocr_suspect() -> Column:
    caption = F.trim(F.coalesce(F.when(F.col("caption") != "", F.col("caption")), F.col("raw_caption"), F.lit("")))
    anchors = sum((caption.contains(a).cast("int") for a in T.OCR_ANCHORS), F.lit(0))
    phrase = caption.rlike("|".join(T.OCR_PHRASES))
    chinese = F.length(F.regexp_replace(caption, r"[^\x{4e00}-\x{9fff}]", ""))
    return phrase | (anchors >= 2) | ((chinese >= 18) & (anchors > 0) & ~caption.rlike("|".join(T.OCR_COMMON)))


def _selection(text: Column, options: Options) -> Column:
    """Struct of exclude_reason (null: selected) and maybe_useful for what is no fragment."""
    science = T.any_of(text, [k for c in T.VISION_CLASSES for k in options.keywords[c]])
    c = F.col("figure_class")

    def kept(flag: bool, reason: str) -> Column:
        return F.struct(F.lit(None if flag else reason).cast("string").alias("reason"), F.lit(True).alias("maybe"))

    def out(reason: Column) -> Column:
        return F.struct(reason.cast("string").alias("reason"), F.lit(False).alias("maybe"))

    unknown = (_text("caption") == "") & F.col("figure_id").startswith("Unknown Figure") & ~F.col("clip_decision").eqNullSafe("positive")
    photo = c == "photo_image"
    return (
        F.when(c.isin(*T.JUNK_CLASSES), out(c))
        .when(unknown, out(F.lit("unknown_without_caption")))
        .when(c == "schematic_or_flow", kept(options.include_schematics_for_vision, "maybe_useful_schematic"))
        .when(photo & T.any_of(text, T.MATERIAL_STATE), kept(options.include_material_state_photos, "maybe_useful_material_state_photo"))
        .when(photo & T.any_of(text, T.SPINNABILITY), kept(options.include_spinnability_photos_for_vision, "maybe_useful_spinnability_photo"))
        .when(c.isin(*T.VISION_CLASSES), out(F.lit(None)))
        .when(F.col("clip_decision").eqNullSafe("positive") & science, out(F.lit(None)))
        .when(F.col("clip_decision").eqNullSafe("negative") & ~science, out(F.lit("clip_negative")))
        .otherwise(out(F.lit("not_selected_for_vision")))
    )


def classify(figures: DataFrame, options: Options = Options()) -> DataFrame:
    """Fills keyword_hits, figure_class, the selection columns and review_reason. A row's existing review_reason (from
    merging fragments) moves to merge_review_reason."""
    text, caption = F.col("_words.text"), F.col("_words.caption")
    words = X.let(classification_text(), lambda t: T.found_words(t, T.every_word(options.keywords)))
    own = X.let(F.lower(_text("caption")), lambda t: T.found_words(t, T.caption_words(options.keywords)))
    # through a generator of one row each, so that the texts are searched once, whatever is asked or filtered later
    rows = figures.select("*", F.explode(F.array(F.struct(words.alias("text"), own.alias("caption")))).alias("_words"))
    rows = rows.withColumns({"keyword_hits": T.keyword_hits(text, T.all_keywords(options.keywords)), "figure_class": figure_class(text, caption, options), "merge_review_reason": F.col("review_reason")})
    rows = rows.withColumn("_chosen", _selection(text, options))
    fragment = F.coalesce("is_fragment", F.lit(False))
    grouped = F.coalesce("fragment_group_id", F.lit("")) != ""
    fragment_reason = F.coalesce(F.when(F.col("exclude_reason") != "", F.col("exclude_reason")), F.when(grouped, REPLACED).otherwise("fragment_image"))
    rows = rows.withColumn("exclude_reason", F.when(fragment, fragment_reason).otherwise(F.col("_chosen.reason")))
    sent = ~fragment & F.col("exclude_reason").isNull()
    rows = rows.withColumns({"keep_for_archive": F.lit(True), "maybe_useful": ~fragment & F.col("_chosen.maybe"), "send_to_vision_model": sent, "keep": sent, "keep_reason": F.when(sent, F.concat(F.lit("vision_"), "figure_class")).otherwise(F.col("exclude_reason"))})
    reason = F.col("caption_truncation_reason")
    mapping = T.any_of(text, options.keywords["elemental_mapping"])
    review = (
        F.when(is_ocr_suspect(), "caption_ocr_suspect")
        .when(reason.isin(UNCERTAIN, SEVERAL), reason)
        .when(F.coalesce("caption_cleaned", F.lit(False)) & (F.coalesce(reason, F.lit("")) != ""), "caption_truncated")
        .when(mapping & (F.col("figure_class") != "elemental_mapping"), "taxonomy_conflict")
        .when(F.col("figure_class") == "other", "figure_class_other")
        .when(T.any_of(text, T.FALSE_CANDIDATE) & ~F.col("send_to_vision_model") & ~fragment, "scientific_figure_not_sent_to_vision")
    )
    return rows.withColumn("review_reason", review).drop("_words", "_chosen")


def names_science() -> Column:
    """Whether a figure's text holds a word of those that false candidates are known by."""
    return T.any_of(X.let(classification_text(), lambda t: T.found_words(t, T.FALSE_CANDIDATE)), T.FALSE_CANDIDATE)


def _not_replaced() -> Column:
    return ~F.coalesce("is_fragment", F.lit(False)) & ~F.col("exclude_reason").eqNullSafe(REPLACED)


def false_candidates(figures: DataFrame) -> DataFrame:
    """Rows with scientific keywords that are not sent to the vision model, schematics aside."""
    return figures.filter(~F.col("send_to_vision_model") & _not_replaced() & (F.col("figure_class") != "schematic_or_flow") & names_science())


def review_candidates(figures: DataFrame) -> DataFrame:
    return figures.filter(_not_replaced() & (F.col("review_reason").isNotNull() | is_ocr_suspect()))
