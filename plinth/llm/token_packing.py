"""Token ids in packed matrices.

Texts are tokenised, documents longer than a row are split without loss, and the pieces are packed best-fit
decreasing: a segment tree over the capacities that open rows have left gives the least one that is enough. Each row
of ids comes with its cumulative segment lengths and the places where positions start anew.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens of a row, and of the documents that are packed together.
CAPACITY, SHARD_TOKENS = 2048, 1 << 19
#: Rows of one partition are numbered below this.
ROWS = 1 << 40
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END, PAD = 50256, 0
#: Fixed value: how this public vocabulary splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class CapacityTree:
    """Rows by what they have left: a complete binary tree over 0 to capacity with counts, searched for a successor."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least room that is at least need; it is taken out."""
        at = need + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at *= 2
                if not self.count[at]:
                    at += 1
        room = at - self.leaves
        row = self.rows[room].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, row


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """A row for each piece (lengths 1 to capacity), the longest first."""
    tree, place, n = CapacityTree(capacity), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if (found := tree.take(lengths[i])) is None:
            found = capacity, n
            n += 1
        room, place[i] = found
        if room > lengths[i]:
            tree.add(room - lengths[i], place[i])
    return place


def encoder(tokenizer: str = TOKENIZER) -> tuple[Callable[[], Callable[[str], list[int]]], int]:
    """What makes, on an executor, the function from a text to its ids, and the greatest id of the vocabulary.

    The driver reads the file, so executors need no copy of it.
    """
    ranks = Path(tokenizer).read_bytes()

    def make() -> Callable[[str], list[int]]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        encoding = tiktoken.Encoding("plinth", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})

        def encode(text: str) -> list[int]:
            # the library's recursion over one text is bounded; its pieces are cut where the pattern always cuts
            if len(text) <= 1 << 17:
                return encoding.encode_ordinary(text)
            out: list[int] = []
            start = 0
            while start < len(text):
                stop = start + (1 << 16)
                while stop < len(text) and not (text[stop] == " " and text[stop - 1].isalpha() and text[stop + 1 : stop + 2].isalpha()):
                    stop += 1
                out += encoding.encode_ordinary(text[start:stop])
                start = stop
            return out

        return encode

    return make, max(int(line.split()[1]) for line in ranks.splitlines())


def position_ids(segments: list[int], capacity: int) -> np.ndarray:
    """Positions within each segment, from its cumulative lengths; 0 in the padding."""
    out = np.zeros(capacity, np.int32)
    for a, b in zip(segments, segments[1:], strict=False):
        out[a:b] = np.arange(b - a)
    return out


SCHEMA = pa.schema([("row_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int32()), ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("first_tokens", pa.list_(pa.int64()))])


def packed(docs: list[int | None], tokens: list[np.ndarray], capacity: int, first_row: int) -> pa.RecordBatch:
    """The rows of one shard, numbered from first_row on: its documents by length, cut into pieces, best-fit decreasing."""
    owner: list[int] = []
    starts: list[int] = []
    lengths: list[int] = []
    for r, ids in enumerate(tokens):
        for start in range(0, len(ids), capacity):
            owner.append(r)
            starts.append(start)
            lengths.append(min(capacity, len(ids) - start))
    place = best_fit_decreasing(lengths, capacity)
    rows: list[list[int]] = [[] for _ in range(max(place, default=-1) + 1)]
    for piece, row in enumerate(place):
        rows[row].append(piece)
    out: dict[str, list] = {name: [] for name in SCHEMA.names}
    for n, pieces in enumerate(rows):
        ids, cu = np.full(capacity, PAD, "<u2"), [0]
        for p in pieces:
            ids[cu[-1] : cu[-1] + lengths[p]] = tokens[owner[p]][starts[p] : starts[p] + lengths[p]]
            cu.append(cu[-1] + lengths[p])
        values = (first_row + n, ids.tobytes(), cu[-1], cu, cu[:-1], [docs[owner[p]] for p in pieces], [starts[p] for p in pieces])
        for name, value in zip(SCHEMA.names, values, strict=True):
            out[name].append(value)
    return pa.RecordBatch.from_pydict(out, SCHEMA)


def pack_tokens(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end: int = END, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """row_id, ids (capacity little-endian 16-bit ids), n_tokens, cu_seqlens, position_resets, doc_ids, first_tokens.

    One row per row of the matrices; its k-th segment is doc_ids[k] from its token first_tokens[k] on. Each document
    ends with the id `end`, so an empty or null text has that one token. No row moves: each partition packs its
    documents in shards of shard_tokens (and the rest of the last document), so no key makes a shard larger than
    others. A null doc_id stays null in doc_ids; repeated rows are packed each. An empty table gives no rows. Columns
    other than doc_id and text are ignored. A vocabulary with ids above 16 bits is refused.
    """
    make, most = encoder(tokenizer)
    if max(most, end) > np.iinfo(np.uint16).max:
        raise ValueError(f"ids up to {max(most, end)} do not fit into 16 bits")

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        row = TaskContext.get().partitionId() * ROWS
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        size = 0
        for batch in batches:
            encode = encode or make()
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                tokens.append(np.array([*encode(text.as_py() or ""), end], np.uint16))
                ids.append(doc_id.as_py())
                size += len(tokens[-1])
                if size >= shard_tokens:
                    yield (out := packed(ids, tokens, capacity, row))
                    row, ids, tokens, size = row + len(out), [], [], 0
        if ids:
            yield packed(ids, tokens, capacity, row)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(pack_partition, "row_id long, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, first_tokens array<long>")
