"""Best-fit packing under conflicts.

A bin holds at most one document of each source and of each duplicate cluster. Open bins are ordered by what they
have left and carry bitmaps of their sources and clusters; the search starts at the least residual that is enough
and goes on to its successors until a bin has no conflict, so the tightest compatible bin is taken.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import n_words, normalised, saved

CAPACITY, SHARD_ROWS = 2048, 1024
#: Bins of one partition are numbered below this.
BINS = 1 << 40


def pack(items: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """A bin for each item (length, source bitmap, cluster bitmap), longest first; lengths are 1 to capacity."""
    order = sorted(range(len(items)), key=lambda i: -items[i][0])
    left: list[tuple[int, int]] = []
    sources: list[int] = []
    clusters: list[int] = []
    place = [0] * len(items)
    for i in order:
        length, source, cluster = items[i]
        at = bisect_left(left, (length, -1))
        while at < len(left) and (sources[left[at][1]] & source or clusters[left[at][1]] & cluster):
            at += 1
        if at < len(left):
            room, b = left.pop(at)
        else:
            room, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[b] |= source
        clusters[b] |= cluster
        if room > length:
            insort(left, (room - length, b))
        place[i] = b
    return place


SCHEMA = pa.schema([("bin_id", pa.int64()), ("slot", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int64()), ("first_word", pa.int64()), ("length", pa.int64())])


def _packed(rows: list[dict], capacity: int, first_bin: int) -> tuple[pa.RecordBatch, int]:
    """The bins of one shard, numbered from first_bin on, and their number. Rows without words are in no bin."""
    rows.sort(key=lambda r: (-r["size"], r["doc_id"] is None, r["doc_id"] or 0, r["source"] is None, r["source"] or "", r["cluster"]))
    source_bit = {s: 1 << k for k, s in enumerate(dict.fromkeys(r["source"] for r in rows))}
    many = Counter(r["cluster"] for r in rows)
    cluster_bit = {c: 1 << k for k, c in enumerate(c for c, n in many.items() if n > 1)}
    items, out = [], []
    for r in rows:
        for piece, start in enumerate(range(0, r["size"], capacity)):
            length = min(capacity, r["size"] - start)
            items.append((length, source_bit[r["source"]], cluster_bit.get(r["cluster"], 0)))
            out.append([None, 0, r["doc_id"], piece, start, length])
    bins = pack(items, capacity)
    slots: Counter = Counter()
    for b, row in zip(bins, out, strict=True):
        row[:2] = first_bin + b, slots[b]
        slots[b] += 1
    out += [[None, 0, r["doc_id"], 0, 0, 0] for r in rows if not r["size"]]
    columns = zip(*out, strict=True) if out else [[] for _ in SCHEMA]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA), max(bins, default=-1) + 1


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, size: Column | None = None, cluster: Column | None = None, shard_rows: int = SHARD_ROWS, deal: bool = True) -> DataFrame:
    """bin_id, slot, doc_id, piece, first_word, length: one row per piece of a document.

    Documents longer than capacity words are split without loss, and their pieces lie in different bins, as do equal
    texts (white space aside) and documents of one source. Bins are filled within shards of shard_rows documents,
    which follow each other in a partition, so no key can make one shard larger than others. Documents are dealt
    to partitions in turn first, so that shards hold many sources however the table is sorted; without `deal` they
    stay in its order, as suits a table that is mixed already. A text without words (or null) has one row with bin_id
    null and length 0; a null source is a source. Null doc_ids stay null; repeated rows are packed each. An empty
    table gives no rows. Columns other than doc_id, text and source are ignored.
    """
    size = n_words(F.col("text")) if size is None else size
    cluster = F.xxhash64(normalised(F.col("text"))) if cluster is None else cluster
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.cast("long").alias("size"), cluster.alias("cluster"))
    if deal:
        rows = saved(rows)
        rows = rows.repartition(max(1, -(-rows.count() // (4 * shard_rows))))

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * BINS
        held: list[dict] = []
        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= shard_rows:
                out, n = _packed(held[:shard_rows], capacity, first)
                first += n
                del held[:shard_rows]
                yield out
        if held:
            yield _packed(held, capacity, first)[0]

    return rows.mapInArrow(pack_partition, "bin_id long, slot long, doc_id long, piece long, first_word long, length long")
