"""Sentences of the text that mention a figure: equi join on the figure's number, scores, the best three."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions import text as X

TOP, NEAR, FAR = 3, 2000, 6000
# What marks a sentence as left over from tables and paths.
JUNK = r"(?iU)TableID|\bCSV:|\bJSON:|[A-Za-z]:[\\/]|(?:/|\\)[\w.\-\\/]+"
HEADING_LINE = r"(?mU)^\s{0,3}#{1,6}\s+.*$"
REFERENCE_LINE = "|".join([*X.CUES, "所示"])


def sentences(papers: DataFrame) -> DataFrame:
    """paper_id, sent_idx, start, end, sentence: images, headings and pure captions masked, an unfinished tail kept."""
    text = X.masked(X.masked(F.col("markdown"), X.IMAGE), HEADING_LINE)
    parts = F.split(text, r"(?<=\n)", -1)

    def line(x: Column) -> Column:
        caption = F.trim(x).rlike(X.CAPTION_START) & ~F.lower(x).rlike(REFERENCE_LINE)
        body = F.regexp_replace(x, r"[\r\n]+$", "")
        return F.when(caption, F.concat(F.repeat(F.lit(" "), F.length(body)), F.substring(x, F.length(body) + 1, F.length(x)))).otherwise(x)

    clean = F.array_join(F.transform(parts, line), "")
    rows = papers.select("paper_id", F.posexplode(X.sentences(clean)).alias("sent_idx", "x"))
    return rows.select("paper_id", "sent_idx", F.col("x.s").alias("start"), F.col("x.e").alias("end"), F.col("x.m").alias("sentence"))


def cleaned(sentence: Column, identifier: Column) -> Column:
    """The sentence without leading leftovers; null if it holds junk, is too short or no longer mentions the figure."""
    s = X.compact(F.regexp_replace(X.compact(sentence), r"(?i)^(?:json|csv)\)\s*", ""))
    s = X.compact(F.regexp_replace(s, r"^(?:[A-Za-z]:[\\/]|/|\\)\S+\s*", ""))
    kept = X.let(s, lambda x: F.when(~x.rlike(JUNK), X.compact(F.regexp_replace(x, r"(?i)\b(?:json|csv)\)\b", " "))))
    return X.let(kept, lambda x: F.when((F.length(x) >= X.LEAST_SENTENCE) & X.mentions(x, identifier), x))


def score(sentence: Column, position: Column, start: Column, caption_tokens: Column) -> Column:
    cue = F.when(F.lower(sentence).rlike("|".join(X.CUES)), 1.5).otherwise(0.0)
    shared = F.least(F.size(F.array_intersect(caption_tokens, X.tokens(sentence))) * 0.25, F.lit(1.5))
    distance = F.abs(start - position)
    return F.lit(5.0) + cue + shared + F.when(distance < NEAR, 1.0).when(distance < FAR, 0.5).otherwise(0.0)


def with_references(figures: DataFrame, found: DataFrame) -> DataFrame:
    """figures with refs: the TOP sentences of each figure, best first, ties in text order; empty without any.

    Sentences that mention a number are gathered per paper and number (a part of one paper's text) before the join,
    so figures are read and shuffled once, however many sentences mention them.
    """
    identifier = F.col("figure_id")
    unknown = F.coalesce(identifier.startswith("Unknown Figure"), F.lit(True))
    named = figures.withColumns({"number": F.when(~unknown, F.lower(X.figure_number(identifier))), "own_numbers": X.mentioned_numbers(identifier), "caption_tokens": X.tokens(F.col("caption"))})
    mentioned = found.withColumn("number", F.explode(X.mentioned_numbers(F.col("sentence"))))
    gathered = mentioned.groupBy("paper_id", "number").agg(F.collect_list(F.struct("sent_idx", "start", "sentence")).alias("mentions"))

    def scored(m: Column) -> Column:
        def row(clean: Column) -> Column:
            others = F.size(F.array_except(X.mentioned_numbers(clean), F.col("own_numbers"))) > 0
            points = score(clean, F.col("position"), m["start"], F.col("caption_tokens")) - F.when(others, 2.5).otherwise(0.0)
            return F.when(clean.isNotNull(), F.struct((-points).alias("s"), m["sent_idx"].alias("sent_idx"), clean.alias("clean")))

        return F.when(X.mentions(m["sentence"], identifier), X.let(cleaned(m["sentence"], identifier), row))

    best = F.array_sort(F.array_compact(F.transform("mentions", scored)))
    refs = F.slice(F.array_distinct(F.transform(best, lambda x: x["clean"])), 1, TOP)
    rows = named.join(gathered, ["paper_id", "number"], "left")
    # through a generator of one row each, so that no later filter repeats the search
    return rows.select(*[F.col(c) for c in figures.columns], F.explode(F.array(F.coalesce(refs, F.array().cast("array<string>")))).alias("refs"))


def linked(figures: DataFrame, papers: DataFrame) -> DataFrame:
    """Figures with up to three reference sentences (existing ones first) and a description of caption and references."""
    rows = with_references(figures, sentences(papers))
    old = F.coalesce("reference_sentences", F.array().cast("array<string>"))
    merged = F.slice(X.distinct_texts(F.concat(old, F.col("refs"))), 1, TOP)
    rows = rows.withColumn("reference_sentences", F.when(F.size(merged) > 0, merged).otherwise(old))
    some = (F.coalesce("caption", F.lit("")) != "") | (F.size("reference_sentences") > 0)
    new = X.description(F.col("caption"), F.col("reference_sentences"), F.col("figure_id"), F.col("subfigure_label"), always_prefix=True)
    return rows.withColumn("description_text", F.when(some, new).otherwise(F.col("description_text"))).select(*figures.columns)


def relinked(figures: DataFrame, papers: DataFrame) -> DataFrame:
    """Links merged figures anew, from nothing; the others stay as they are."""
    merged = figures.filter("is_merged_figure").withColumns({"reference_sentences": F.array().cast("array<string>"), "description_text": F.lit(None).cast("string")})
    return figures.filter("not is_merged_figure").unionByName(linked(merged, papers))
