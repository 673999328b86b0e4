"""Exact dedup by content-defined chunk recipes.

Each normalised text is cut where a rolling hash of its last 16 bytes says so, so equal passages give equal
chunks wherever they stand. Distinct chunks are gathered once and prove that an identifier (a digest) stands for
one byte string only; then documents are compared by their ordered identifier lists, and their texts are not
moved again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import normalised, saved

GEAR = np.random.default_rng(20250711).integers(0, 1 << 32, 256, dtype=np.uint32)
WINDOW, LEAST, MOST, AVERAGE_BITS = 16, 256, 8192, 10
#: Groups of more than this share of the rows are joined by broadcast: there are HOT of them at most.
HOT = 1000


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte a hash of the WINDOW bytes that end there (shorter near the start)."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def cuts(data: np.ndarray, offsets: list[int]) -> Iterator[list[int]]:
    """Ends of chunks of each text data[offsets[i]:offsets[i + 1]]; each depends on its own text only."""
    marks = np.flatnonzero(rolling(data) >> np.uint32(32 - AVERAGE_BITS) == 0) + 1
    at = np.searchsorted(marks, offsets)
    for i in range(len(offsets) - 1):
        last, end, found = offsets[i], offsets[i + 1], []
        for m in marks[at[i] : at[i + 1]].tolist():
            if m - last < LEAST:
                continue
            while m - last > MOST:
                found.append(last := last + MOST)
            if m - last >= LEAST and m < end:
                found.append(last := m)
        while end - last > MOST:
            found.append(last := last + MOST)
        yield [*found, end]


def chunked(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Chunks of each text, in blocks of texts that bound the memory of the hashes."""
    start = 0
    while start < len(texts):
        stop, total = start, 0
        while stop < len(texts) and (stop == start or total + len(texts[stop]) <= 1 << 22):
            total += len(texts[stop])
            stop += 1
        part = texts[start:stop]
        data = np.frombuffer(b"".join(part), dtype=np.uint8)
        offsets = [0, *np.cumsum([len(x) for x in part]).tolist()]
        for i, ends in enumerate(cuts(data, offsets)):
            text, base, last, out = part[i], offsets[i], 0, []
            for e in ends:
                out.append(text[last : e - base])
                last = e - base
            yield out
        start = stop


def _identifier(chunk: bytes, width: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=width).digest()


def recipes(docs: DataFrame, width: int = 16) -> DataFrame:
    """doc_id, text_sha256 and recipe (the ordered identifiers of width bytes each, joined)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"],
                "text_sha256": [hashlib.sha256(t).hexdigest() for t in texts],
                "recipe": pa.array([b"".join(_identifier(c, width) for c in chunks) for chunks in chunked(texts)], pa.binary()),
            })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text"))
    return rows.mapInArrow(build, "doc_id long, text_sha256 string, recipe binary")


def distinct_chunks(docs: DataFrame, width: int = 16) -> DataFrame:
    """Distinct (identifier, chunk) pairs of all texts; copies are folded before the shuffle too."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, None] = {}
            for chunks in chunked([t.encode("utf-8", "surrogatepass") for t in batch["text"].to_pylist()]):
                seen.update(dict.fromkeys(chunks))
            yield pa.RecordBatch.from_pydict({"id": pa.array([_identifier(c, width) for c in seen], pa.binary()), "chunk": pa.array(list(seen), pa.binary())})

    rows = docs.select(normalised(F.col("text")).alias("text"))
    return rows.mapInArrow(build, "id binary, chunk binary").distinct()


def verified_recipes(docs: DataFrame, width: int = 16) -> DataFrame:
    """Recipes whose identifiers stand for one chunk each, as all distinct chunks prove.

    If one identifier has two chunks, everything is made again with identifiers of twice the width.
    """
    while width <= 64:
        shared = distinct_chunks(docs, width).groupBy("id").count().filter("count > 1")
        if shared.isEmpty():
            return recipes(docs, width)
        width *= 2
    raise ValueError("chunks with equal identifiers of 64 bytes")


def exact_dedup(docs: DataFrame, width: int = 16) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of docs.

    A null text counts as empty, and all empty texts are one group. Rows that share a doc_id and a text count in
    group_size one by one and are all kept, or all dropped. Rows with a null doc_id count in group_size; they stay
    only if no other row of the group has a doc_id (keep_id is null then). An empty table gives no rows. Columns
    other than doc_id and text are ignored.
    """
    rows = saved(verified_recipes(docs, width))
    # equal recipes are equal texts; each has one digest, which stands for it from here on
    groups = saved(rows.groupBy("recipe", "text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).drop("recipe"))
    hot = F.col("group_size") * HOT > rows.count()
    big = F.broadcast(groups.filter(hot))  # HOT rows at most
    own = rows.select("doc_id", "text_sha256")
    near = own.join(big, "text_sha256")
    rest = own.join(big, "text_sha256", "left_anti").join(groups.filter(~hot), "text_sha256")
    out = near.unionByName(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
