"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

Sketch: in round i every shingle throws a hashed value into a hashed bin, and a bin keeps the least value of the
first round that reached it. After COORDINATES such rounds, each further round aims at one bin, so every
coordinate fills, and the agreement of two sketches is concentrated about the Jaccard similarity.

Links: texts with equal words fold into one class first. Classes that share a band are compared with the pivot of
their bucket on full sets; what these links have not yet joined is compared too (small buckets as pairs, large
ones block by block), so that no link among candidates is lost though no group is ever expanded into all pairs.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import saved, text_digest

COORDINATES, BANDS, ROWS = 128, 25, 5
SHINGLE, PERCENT = 5, 85
#: Buckets up to SMALL members are compared as pairs of ids, larger ones in blocks of BLOCK members.
SMALL, BLOCK, PIVOT_BLOCK = 48, 384, 256
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_rng = np.random.default_rng(59)
BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
PLACE = _rng.integers(0, 1 << 64, SHINGLE, dtype=np.uint64) | np.uint64(1)
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit reaches each output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step % (1 << 64)
    return out


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start places of the words in bytes (words end at ASCII white space)."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    power = _powers(int(ODD), len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[data] * power[:-1], dtype=np.uint64)))
    inverse = _powers(pow(int(ODD), -1, 1 << 64), len(data) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[bytes], words: int = SHINGLE) -> tuple[list[np.ndarray], list[bytes]]:
    """For each lower-cased text: its sorted distinct shingle hashes, and a digest of its words (empty without words)."""
    sets: list[np.ndarray] = []
    digests: list[bytes] = []
    start = 0
    while start < len(texts):
        stop, total = start, 0
        while stop < len(texts) and (stop == start or total < 1 << 21):
            total += len(texts[stop]) + 1
            stop += 1
        part = texts[start:stop]
        hashes, places = word_hashes(np.frombuffer(b"\n".join(part), np.uint8))
        at = np.searchsorted(places, np.cumsum([0, *(len(t) + 1 for t in part)]))
        for i in range(len(part)):
            w = hashes[at[i] : at[i + 1]]
            n = min(len(w), words)
            if not n:
                sets.append(np.empty(0, np.uint64))
                digests.append(b"")
                continue
            h = np.full(len(w) - n + 1, n, np.uint64)
            for k in range(n):
                h = h + mix(w[k : len(w) - n + 1 + k] * PLACE[k])
            sets.append(np.unique(mix(h)))
            digests.append(hashlib.sha256(w.tobytes()).digest()[:16])
        start = stop
    return sets, digests


def sketches(sets: list[np.ndarray], size: int = COORDINATES) -> np.ndarray:
    """One row of size coordinates for each non-empty set, by rounds of bin placement over all sets at once."""
    n = len(sets)
    out = np.full((n, size), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    lengths = np.array([len(s) for s in sets], np.int64)
    items = np.concatenate(sets) if n else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), lengths)
    empty = np.ones(n * size, bool)
    for i in range(2 * size):
        salt = mix(np.array([i + 1], np.uint64) * ODD)
        h = mix(items ^ salt)
        bins = (h >> np.uint64(40)) % np.uint64(size) if i < size else np.full(len(h), i - size, np.uint64)
        place = owner * size + bins.astype(np.int64)
        free = empty[place]
        # the round stands in the upper bits, so an earlier round always wins
        np.minimum.at(flat, place[free], (h[free] & np.uint64((1 << 40) - 1)) | np.uint64(i << 40))
        empty[place] = False
        left = empty.reshape(n, size).any(axis=1)
        if not left.any():
            break
        more = left[owner]
        items, owner = items[more], owner[more]
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large or not small:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (small + large - both)


def lowered(texts: list) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass").translate(LOWER) for t in texts]


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, len(whole), 512):
            batch = whole.slice(at, 512)
            sets, digests = shingle_sets(lowered(batch["text"].to_pylist()))
            there = [i for i, s in enumerate(sets) if len(s)]
            rows = sketches([sets[i] for i in there])[:, : BANDS * ROWS].reshape(len(there), BANDS, ROWS)
            keys = np.zeros((len(there), BANDS), np.uint64)
            for r in range(ROWS):
                keys = mix(keys * ODD + rows[:, :, r])
            bands: list = [None] * len(sets)
            for i, k in zip(there, keys.view(np.int64).tolist(), strict=True):
                bands[i] = k
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"],
                "copy": batch["copy"],
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "words": pa.array([d or None for d in digests], pa.binary()),
                "bands": pa.array(bands, pa.list_(pa.int64())),
            })


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, copy (a digest of the text, null for null) and text: what tells a row from those with other texts."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("copy"), "text")


def sketch_table(docs: DataFrame) -> DataFrame:
    return identified(docs).mapInArrow(_sketched, "doc_id long, copy binary, n_shingles long, words binary, bands array<long>")


def _against_pivot(key: tuple, pivot: pd.DataFrame, members: pd.DataFrame, percent: int) -> pd.DataFrame:
    found: list[int] = []
    if len(pivot):
        first = shingle_sets(lowered([pivot["text"].iloc[0]]))[0][0]
        for at in range(0, len(members), 64):
            part = members.iloc[at : at + 64]
            sets = shingle_sets(lowered(part["text"].tolist()))[0]
            found += [i for i, s in zip(part["b"], sets, strict=True) if linked(first, s, percent)]
    return pd.DataFrame({"a": [key[0]] * len(found), "b": found}).astype("int64")


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of nodes that are linked on full sets; texts: node, text.

    The members b of one pivot a are dealt into blocks by their hash, and the pivot's text is sent to each block.
    """
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    blocks = saved(sizes.withColumn("parts", F.ceil(F.col("n") / PIVOT_BLOCK).cast("int")))
    left = texts.join(blocks, texts["node"] == blocks["a"]).select(F.col("a").alias("a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("text").alias("text"))
    hot = blocks.filter("parts > 1").select("a", "parts")
    right = (
        pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))
        .join(texts.withColumnRenamed("node", "b"), "b")
    )
    return left.groupBy("a", "part").cogroup(right.groupBy("a", "part")).applyInPandas(lambda key, pivot, members: _against_pivot(key, pivot, members, percent), "a long, b long")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the least node that each node reaches over links (a, b), by rounds of least labels and jumps."""
    both = saved(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = saved(nodes.select("node", F.col("node").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("other"))
        step = saved(labels.join(near, labels["node"] == near["a"], "left").select("node", F.col("component").alias("before"), F.least("component", "other").alias("component")))
        if step.filter("before != component").isEmpty():
            return step.select("node", "component")
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("root"))
        labels = saved(step.select("node", "component").join(jump, "component", "left").select("node", F.least("component", "root").alias("component")))


class Forest:
    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        while self.parent.setdefault(x, x) != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[b] = a
        return a != b


def _pairs_within(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of each small bucket that are not joined yet and whose sizes let them be linked."""
    for batch in batches:
        found: set[tuple[int, int]] = set()
        for members in batch["members"].to_pylist():
            rows = [(m["node"], m["n_shingles"], m["component"]) for m in members]
            for i, (x, n, root) in enumerate(rows):
                found.update((min(x, y), max(x, y)) for y, k, other in rows[:i] if other != root and 100 * min(n, k) >= percent * max(n, k))
        pairs = sorted(found)
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([y for _, y in pairs], pa.int64())})


def _blocks(members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A forest of the links between the minor members of a tile and its others, by products of membership matrices."""
    members = members.sort_values(["minor", "node"], ascending=[False, True])
    ids, roots = members["node"].tolist(), members["component"].tolist()
    m = int(members["minor"].sum())
    sets = []
    for at in range(0, len(members), 64):
        sets += shingle_sets(lowered(members["text"].iloc[at : at + 64].tolist()))[0]
    sizes = np.array([len(s) for s in sets])
    values, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(sets)), sizes)
    common = counts > 1  # a shingle of one text alone is in no intersection
    column = np.cumsum(common) - 1
    rows, cols = rows[common[where]], column[where][common[where]]
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    both = np.zeros((m, len(sets) - m), np.float32)
    for lo in range(0, int(common.sum()), 4096):
        a, b = np.searchsorted(cols, (lo, lo + 4096))
        x = np.zeros((len(sets), 4096), np.float32)
        x[rows[a:b], cols[a:b] - lo] = 1
        both += x[:m] @ x[m:].T
    hit = 100 * both >= percent * (sizes[:m, None] + sizes[None, m:] - both)
    forest, out = Forest(), []
    for i in range(m):
        for j in (np.flatnonzero(hit[i]) + m).tolist():
            if roots[i] != roots[j] and forest.join(roots[i], roots[j]):
                out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _tiles(large: DataFrame) -> DataFrame:
    """Tiles of large buckets (band, key, node, component, n): bucket, i, j, minor, node, component.

    Buckets of the same members are taken once. Their members outside of the bucket's largest component, the minor
    ones, stand in blocks i, and all members in blocks j: every pair of different components meets in a tile, and
    the more of a bucket is joined already, the fewer tiles there are.
    """
    bucket = ["band", "key"]
    whole = large.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.xxhash64(F.lit(1), "node").cast("decimal(38,0)")).alias("y"))
    once = whole.groupBy("n", "x", "y").agg(F.min(F.struct(*bucket)).alias("first")).select("first.band", "first.key")
    parts = large.join(once, bucket).groupBy(*bucket, "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy(*bucket).agg(F.max(F.struct("n", "component")).alias("major"), F.sum("n").alias("all"))
    sizes = saved(sizes.select(*bucket, F.col("major.component").alias("major"), F.ceil(F.col("all") / BLOCK).cast("int").alias("nj"), F.ceil((F.col("all") - F.col("major.n")) / BLOCK).cast("int").alias("ni")))
    rows = large.select(*bucket, "node", "component").join(sizes, bucket).withColumn("bucket", F.concat_ws(":", *bucket))
    i, j = F.pmod(F.xxhash64("node"), F.col("ni")).cast("int"), F.pmod(F.xxhash64("node"), F.col("nj")).cast("int")
    minor = rows.filter("component != major").select("bucket", i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("nj") - 1)).alias("j"), F.lit(1).alias("minor"), "node", "component")
    every = rows.select("bucket", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)).alias("i"), j.alias("j"), F.lit(0).alias("minor"), "node", "component")
    return minor.unionByName(every)


def class_links(classes: DataFrame, texts: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Nodes with a candidate partner, and links whose components are those of all links between candidates.

    classes: node, doc_id, copy, n_shingles, bands of one row for each set; texts: doc_id, copy, text.
    """
    bands = classes.select("node", "n_shingles", F.posexplode("bands").alias("band", "key"))
    sizes = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("pivot"))
    shared = saved(sizes.filter("n > 1"))
    members = saved(bands.join(shared, ["band", "key"]))
    nodes = saved(members.select("node").distinct())
    wanted = saved(classes.select("node", "doc_id", "copy").join(nodes.hint("merge"), "node", "left_semi")).hint("merge")
    own = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["copy"] == wanted["copy"]))
    own = saved(own.select("node", "text").dropDuplicates(["node"]))
    stars = saved(members.filter("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    links = saved(verified(stars, own, percent))
    joined = components(nodes, links)
    placed = saved(members.join(joined, "node"))
    mixed = placed.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("band", "key")
    placed = saved(placed.join(mixed, ["band", "key"]))
    lists = placed.filter(F.col("n") <= SMALL).groupBy("band", "key").agg(F.collect_list(F.struct("node", "n_shingles", "component")).alias("members"))
    small = lists.select("members").mapInArrow(lambda batches: _pairs_within(batches, percent), "a long, b long").distinct()
    tested = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = verified(saved(small.join(tested, ["a", "b"], "left_anti")), own, percent)
    tiles = _tiles(placed.filter(F.col("n") > SMALL))
    rest = tiles.join(own, "node").groupBy("bucket", "i", "j").applyInPandas(lambda members: _blocks(members, percent), "a long, b long")
    return nodes, links.unionByName(more).unionByName(rest).distinct()


def _same_ids(rows: DataFrame, heads: DataFrame) -> DataFrame | None:
    """Links (a, b) between the texts of each doc_id that has several; None if no doc_id has."""
    several = rows.filter("words is not null and doc_id is not null").groupBy("doc_id").agg(F.min("words").alias("lo"), F.max("words").alias("hi")).filter("lo != hi").select("doc_id")
    several = saved(several)
    if several.isEmpty():
        return None
    texts = saved(rows.select("doc_id", "words").join(several, "doc_id").distinct().join(heads.select("words", "node"), "words").select("doc_id", "node"))
    least = texts.groupBy("doc_id").agg(F.min("node").alias("a"))
    return saved(texts.join(least, "doc_id").filter("a != node").select("a", F.col("node").alias("b")).distinct())


def near_groups(docs: DataFrame, percent: int = PERCENT, same_ids: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows and the classes of equal word sequences with the group each belongs to.

    rows: doc_id, copy, n_shingles, words (null without words), one for each of docs. Classes: words, copies, root
    (which names the group), doc_id and copy of its first row (ids before none), and component_id, the least doc_id of
    the group (null if none of its rows has one). With same_ids the texts of one doc_id belong together too.
    """
    rows = saved(sketch_table(docs))
    by_words = rows.filter("words is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy"))
    heads = by_words.groupBy("words").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
    # an id that grows along the partitions, and stays: the table is written once
    heads = saved(heads.select("words", "copies", "first.doc_id", "first.copy", F.monotonically_increasing_id().alias("node")))
    same = (by_words["words"] == heads["words"]) & by_words["doc_id"].eqNullSafe(heads["doc_id"]) & (by_words["copy"] == heads["copy"])
    classes = by_words.join(heads, same).select(heads["node"], heads["doc_id"], heads["copy"], "n_shingles", "bands").dropDuplicates(["node"])
    nodes, links = class_links(saved(classes), identified(docs), percent)
    if same_ids and (more := _same_ids(rows, heads)) is not None:
        nodes = nodes.union(more.select("a")).union(more.select("b")).distinct()
        links = links.unionByName(more)
    roots = components(nodes, links)
    joined = saved(heads.select("node", "doc_id").join(roots, "node"))
    least = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = joined.join(least, "component").select("node", F.col("component").alias("root"), "component_id")
    out = heads.join(placed, "node", "left").withColumn("component_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return rows.drop("bands"), saved(out.select("words", "copies", "doc_id", "copy", F.coalesce("root", "node").alias("root"), "component_id"))


def near_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs; texts are linked from a similarity of percent on.

    A text without words (or null) has 0 shingles and is linked with nothing. A doc_id with several texts is one
    document: what any of them is linked with it reaches, and all its rows with words get its component. A row with a
    null doc_id takes part by its text; its component_id is null, and it is kept, if no document with an id is
    reachable. Repeated rows get equal results. An empty table gives no rows. Columns other than doc_id and text are
    ignored. Sets are compared by 64-bit hashes of shingles: for two sets of n shingles in all the chance that one
    differs by a collision is below n * n / 2^65, so 1e-9 for texts of 100,000 words.
    """
    rows, heads = near_groups(docs, percent)
    heads = heads.select("words", "copies", "component_id")
    hot = F.col("copies") * 1000 > rows.count()
    columns = ("doc_id", "n_shingles", "component_id")
    worded = rows.filter("words is not null").select("doc_id", "n_shingles", "words")
    big = F.broadcast(heads.filter(hot))  # 1000 rows at most
    near = worded.join(big, "words").select(*columns)
    rest = worded.join(big, "words", "left_anti").join(heads.filter(~hot), "words").select(*columns)
    none = rows.filter("words is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = near.unionByName(rest).unionByName(none)
    return out.select(*columns, F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, copy: of each group of linked texts the first one, and every text without words.

    Rows are told apart by doc_id and text, so a doc_id with several texts may keep one and lose another. The first
    text of a group is that of the least doc_id, of rows without one that of the least digest.
    """
    rows, heads = near_groups(docs, percent, same_ids=False)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy")).alias("first")
    return heads.groupBy("root").agg(first).select("first.doc_id", "first.copy").unionByName(rows.filter("words is null").select("doc_id", "copy").distinct())
