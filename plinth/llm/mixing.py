"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

The documents of each source stand in a hashed order, as one line of words cut into blocks of equal length. Slots
0, 1, 2 ... of the schedule fall on golden-ratio points; the cumulative weights of the sources map each point to a
source, so every stretch of the schedule holds the sources in proportion. The r-th slot of a source takes its
block r modulo the number of its blocks, and the slot that reaches the source's target is cut there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.llm.common import n_words, saved, text_digest

WEIGHTS, BLOCK_WORDS, CELLS = (5, 2, 1), 1024, 1024
GOLDEN = 0.6180339887498949
#: A table of sources up to this many rows is sent to all executors, if no name is longer than NAME bytes (so 50 MB at
#: most); a larger one is joined by a shuffle.
BROADCAST_ROWS, NAME = 50_000, 900
#: Equal rows are expanded in stretches of this many.
EQUAL = 65_536
PLACES = 1 << 28
#: Whole documents of the mix are sorted within stretches of this many slots, and each stretch lies in one partition.
STRETCH = 1024


def _fit(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sid, source, source_size, weight, target for each source of sizes (source, size).

    Sources in the order of code points, null last, get the weights in turn. They share `share` times all words by
    weight; a source stops at `most` times its own words, and what it leaves is shared by the others. With the
    sources ordered by size over weight, those that stop come first, so the common level is found in one pass.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    in_turn = Window.orderBy(F.col("source").isNull(), "source")
    full = Window.partitionBy()
    per = per.withColumn("sid", F.row_number().over(in_turn)).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1).cast("double"))
    upward = Window.orderBy(F.col("source_size") / F.col("weight"), "sid")
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(full) - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(upward.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", level).withColumn("place", F.row_number().over(upward))
    open_ = F.col("level") * F.col("weight") <= F.lit(most) * F.col("source_size")
    common = F.min(F.when(open_, F.struct("place", "level"))).over(full)["level"]
    target = F.coalesce(F.least(F.lit(most) * F.col("source_size"), common * F.col("weight")), F.lit(most) * F.col("source_size"))
    return per.select("sid", "source", "source_size", "weight", target.alias("target"))


def plan(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Adds the blocks of a source, the words and slots it gives, whole passes over it, and its share of [0, 1)."""
    words = F.floor("target").cast("long")
    some = F.greatest(F.col("source_size"), F.lit(1))
    out = sources.withColumns({"blocks": F.ceil(F.col("source_size") / block).cast("long"), "passes": F.floor(words / some).cast("long")})
    out = out.withColumn("rest", F.when(F.col("source_size") > 0, words - F.col("passes") * F.col("source_size")).otherwise(F.lit(0)))
    out = out.withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long"))
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("slots").over(upto) / F.greatest(F.sum("slots").over(Window.partitionBy()), F.lit(1))
    return out.withColumn("high", share).withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("sid")), F.lit(0.0)))


def schedule(sources: DataFrame) -> DataFrame:
    """slot, sid, rank: which source each slot of the mix serves, and how many slots served it before.

    Slots are numbered within stretches and the stretches' counts added up, so no task sees a whole source. What the
    schedule leaves a source short of (a few slots) follows at its end.
    """
    spark = sources.sparkSession
    row = sources.agg(F.sum("slots").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    n, rows = int(row["n"] or 0), int(row["rows"])
    stretch = min(8192, max(256, n // 2048))
    last = F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1))
    cells = sources.filter("slots > 0").select("sid", "low", "high", "slots", F.explode(F.sequence(F.floor(F.col("low") * CELLS), last)).alias("cell"))
    x = (F.col("slot") + 0.5) * GOLDEN
    points = spark.range(n).select(F.col("id").alias("slot"), F.floor(F.col("id") / stretch).cast("long").alias("stretch")).withColumn("u", x - F.floor(x)).withColumn("cell", F.floor(F.col("u") * CELLS))
    drawn = points.join(_fit(cells, rows + CELLS), "cell").filter("low <= u and u < high").select("slot", "stretch", "sid", F.col("slots").alias("wanted"))
    counts = drawn.groupBy("sid", "stretch").agg(F.count(F.lit(1)).alias("n"))
    counts = saved(counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    ranked = drawn.withColumn("within", F.row_number().over(Window.partitionBy("stretch", "sid").orderBy("slot")) - 1)
    ranked = ranked.join(counts.select("stretch", "sid", "before"), ["stretch", "sid"]).withColumn("rank", F.col("before") + F.col("within")).filter("rank < wanted").select("slot", "sid", "rank")
    had = counts.groupBy("sid").agg(F.sum("n").alias("had"))
    short = sources.join(_fit(had, rows), "sid", "left").select("sid", F.coalesce("had", F.lit(0)).alias("had"), "slots").filter("had < slots")
    more = short.select("sid", F.explode(F.sequence("had", F.col("slots") - 1)).alias("rank")).select((F.lit(n) + F.col("rank")).alias("slot"), "sid", "rank")
    return ranked.unionByName(more)


def lines(docs: DataFrame, sources: DataFrame, n_sources: int, n_docs: int) -> DataFrame:
    """Adds sid and start, the place of the first of the row's `same` documents on the line of words of its source.

    Documents stand in the order of md5(doc_id). Sums over ranges of the hash come first and are added up per source,
    so no task sees a whole source.
    """
    parts = max(1024, n_docs // 4096)
    own = _fit(sources.select("sid", F.col("source").alias("of")), n_sources)
    rows = docs.join(own, docs["source"].eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    rows = rows.withColumn("part", F.floor(F.conv(F.substring("h", 1, 7), 16, 10).cast("long") * parts / PLACES).cast("long"))
    words = F.col("size") * F.col("same")
    sums = rows.groupBy("sid", "part").agg(F.sum(words).alias("words"))
    base = F.coalesce(F.sum("words").over(Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = saved(sums.select("sid", "part", base.alias("base")))
    order = [c for c in ("h", "doc_id", "size", "copy") if c in rows.columns]
    within = F.sum(words).over(Window.partitionBy("part", "sid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - words
    return rows.withColumn("within", within).join(sums, ["sid", "part"]).withColumn("start", F.col("base") + F.col("within")).drop("h", "part", "within", "base")


def _mix(docs: DataFrame, weights: tuple[int, ...], share: float, most: float, block: int, keys: tuple[str, ...] = ("doc_id", "source", "size")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents with their places, their pieces by blocks, and the schedule's turns at the blocks.

    docs has the keys; equal rows are counted first and placed together, then each has its own place.
    """
    counted = docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("same"))
    sized = saved(counted)
    sources = saved(plan(targets(sized.select("source", (F.col("size") * F.col("same")).alias("size")), weights, share, most), block))
    names = sources.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("source")).alias("longest")).first()
    n_sources = names["n"] if (names["longest"] or 0) <= NAME else BROADCAST_ROWS + 1
    placed = lines(sized, sources, n_sources, sized.count()).join(_fit(sources.drop("source", "weight", "low", "high"), n_sources), "sid")
    ranges = F.sequence(F.lit(0).cast("long"), F.col("same") - 1, F.lit(EQUAL).cast("long"))
    stretch = placed.withColumn("first_same", F.explode(ranges))
    until = F.least(F.col("same"), F.col("first_same") + EQUAL) - 1
    placed = saved(stretch.withColumn("nth", F.explode(F.sequence("first_same", until))).withColumn("start", F.col("start") + F.col("nth") * F.col("size")).drop("first_same", "same"))
    first, last = F.floor(F.col("start") / block).cast("long"), F.floor((F.col("start") + F.col("size") - 1) / block).cast("long")
    pieces = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    pieces = pieces.withColumns({"low": F.greatest(F.col("start"), F.col("block") * block), "high": F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)})
    turns = schedule(sources).join(_fit(sources.select("sid", "blocks"), n_sources), "sid").select("slot", "sid", F.floor(F.col("rank") / F.col("blocks")).cast("long").alias("pass"), (F.col("rank") % F.col("blocks")).alias("block"))
    return placed, pieces, turns


def _sizes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(F.col("text")).alias("size"))


def mixed_stream(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, block: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: slot, doc_id, source, first_word, words; ordered by (slot, first place) it is the training order."""
    _, pieces, turns = _mix(_sizes(docs), weights, share, most, block)
    end = F.when(F.col("pass") < F.col("passes"), F.col("high")).otherwise(F.least("high", "rest"))
    return pieces.join(turns, ["sid", "block"]).withColumn("words", end - F.col("low")).filter("words > 0").select("slot", "doc_id", "source", (F.col("low") - F.col("start")).alias("first_word"), "words")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, block: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per row of docs.

    A null text has size 0, and texts without words take part with taken 0. Rows with a null source are a source of
    their own. Rows that share a doc_id (or have none) stand beside each other, the shorter first; repeated rows each
    have their own place. The words taken from a source are its target without its fraction. An empty table gives no
    rows. Columns other than doc_id, text and source are ignored.
    """
    placed, pieces, turns = _mix(_sizes(docs), weights, share, most, block)
    taken_blocks = turns.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("turns"))
    cut = F.greatest(F.least("high", "rest") - F.col("low"), F.lit(0))
    whole = (F.col("high") - F.col("low")) * F.least("turns", "passes") + F.when(F.col("turns") > F.col("passes"), cut).otherwise(F.lit(0))
    got = pieces.join(taken_blocks, ["sid", "block"], "left").groupBy("doc_id", "sid", "start", "size", "source_size", "target").agg(F.coalesce(F.sum(whole), F.lit(0)).cast("long").alias("taken"))
    none = placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    columns = ("doc_id", "size", "source_size", "target", "taken")
    return got.select(*columns).unionByName(none.select(*columns))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, block: int = BLOCK_WORDS) -> DataFrame:
    """The mix in whole documents: the rows and columns of docs, each as often as the mix takes it, in its order.

    A document that begins in a block is dealt at each turn of its block, if at least half of it lies before the
    place where its source's target is reached, so each source's words are its target but for one document. Texts
    without words are in no slot and left out. Rows of one doc_id, source and text are alike to the mix: those of
    them that it takes are any. An empty table gives no rows; columns may have any names.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    own = own.select("row", "doc_id", "source", text_digest(F.col("text")).alias("copy"), n_words(F.col("text")).alias("size"))
    placed, pieces, turns = _mix(own.drop("row"), weights, share, most, block, ("doc_id", "source", "copy", "size"))
    keys = ("doc_id", "source", "copy")
    starts = pieces.filter(F.col("block") == F.floor(F.col("start") / block)).select("sid", "block", "start", "size", "passes", "rest", "nth", *keys)
    fits = 2 * F.least(F.col("rest") - F.col("start"), F.col("size")) >= F.col("size")
    dealt = starts.join(turns, ["sid", "block"]).filter((F.col("pass") < F.col("passes")) | fits)
    places = dealt.groupBy(*keys, "nth").agg(F.collect_list(F.struct("slot", "start")).alias("places"))
    places = saved(places.withColumnsRenamed({k: f"of_{k}" for k in (*keys, "nth")})).hint("merge")
    own = own.drop("size")
    if placed.filter("nth > 0").isEmpty():
        own = own.withColumn("nth", F.lit(0).cast("long"))
    else:
        own = own.withColumn("nth", (F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) - 1).cast("long"))
    same = [own[k].eqNullSafe(places[f"of_{k}"]) for k in (*keys, "nth")]
    joined = own.join(places, reduce(lambda a, b: a & b, same)).select("row", F.explode("places").alias("at"))
    return joined.repartition(F.floor(F.col("at.slot") / STRETCH)).sortWithinPartitions("at.slot", "at.start").select("row.*")
