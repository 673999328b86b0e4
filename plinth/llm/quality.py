"""Quality classifier by Bradley-Terry pairwise ranking.

Every preferred document beats every rejected one: a linear score is learnt by logistic loss on the differences of
their features, over all pairs of all labelled rows. Scores are then placed on 0 to 1 so that the cut between training
scores which separates the labels best falls on the threshold.

The rows stay on the executors. Loss and gradient need, of every row, a sum over the rows of the other label, which is a
smooth function of the row's score. It is taken from the counts of all scores on a fine grid, spread and read by cubic
interpolation; the error is below 1e-9 a pair.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import held, saved

THRESHOLD = 0.3
#: Steps of the grid for sums over all pairs, of the one for their curvature (which only directs the steps), of scores.
FINE, COARSE, UNIT = 1 / 64, 1 / 4, 1e-9
#: Weight of the squared weights in the loss.
DECAY = 1e-4
#: Parts into which the scores are divided at once in search of the cut.
PARTS = 4096
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
REPEATED = re.compile(rb"([#$%&*!|@^~=_+\-.?])\1+")
NAMES = ("log_bytes", "log_words", "lower", "upper", "digit", "space", "newline", "beyond_ascii", "marks", "word_length", "repeated_marks", "marked_words", "capital_words", "different_words", "repeated_lines", "line_length", "word_entropy", *(f"mark_{m:02x}" for m in MARKS))


def features(text: str) -> list[float]:
    """Shares of character classes, marks, repetitions and the shape of words and lines, over the whole text."""
    raw = text.encode("utf-8", "replace")
    n = len(raw)
    if not n:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    w = max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    marks = [int(counts[m]) for m in MARKS]
    seen: dict[bytes, int] = {}
    for x in words:
        seen[x] = seen.get(x, 0) + 1
    freq = np.fromiter(seen.values(), float, len(seen)) / w
    entropy = float(-(freq * np.log(freq)).sum() / np.log(w + 1)) if len(seen) > 1 else 0.0
    runs = sum(1 for _ in REPEATED.finditer(raw))
    marked = sum(1 for x in words if not (x[-1:].isalnum() or x[-1] > 127 or x[-1:] in b".,"))
    capitals = sum(1 for x in words if len(x) > 1 and x.isupper())
    return [
        np.log1p(n), np.log1p(len(words)), counts[97:123].sum() / n, counts[65:91].sum() / n, counts[48:58].sum() / n,
        counts[32] / n, counts[10] / n, counts[128:].sum() / n, sum(marks) / n, min(60.0, n / w), runs / w, marked / w, capitals / w,
        len(seen) / w, 1 - len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))), entropy, *(m / w for m in marks),
    ]


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id, features (float array): one row per row of docs; a null text counts as empty."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "features": pa.array(rows, pa.list_(pa.float32()))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, "doc_id long, features array<float>")


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch["features"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(NAMES)).astype(float)


#: Calls a function with features and labels of every part of the rows and merges what it returns.
Gather = Callable[[Callable, Callable], object]


def gatherer(rows: DataFrame) -> Gather:
    """Parts are merged within each task; a task sends one result to the driver."""

    def gather(part: Callable, merge: Callable) -> object:
        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if len(batch):
                    one = part(matrix(batch), batch["quality"].to_numpy(zero_copy_only=False))
                    total = one if total is None else merge(total, one)
            if total is not None:
                yield pa.RecordBatch.from_pydict({"total": pa.array([pickle.dumps(total)], pa.binary())})

        parts = [pickle.loads(r["total"]) for r in rows.mapInArrow(build, "total binary").collect()]
        return reduce(merge, parts) if parts else None

    return gather


def added(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b))


def aligned(a: tuple, b: tuple) -> tuple:
    """Sum of two (first place, values by label and place)."""
    first = min(a[0], b[0])
    out = np.zeros((2, max(a[0] + a[1].shape[1], b[0] + b[1].shape[1]) - first))
    for start, values in (a, b):
        out[:, start - first : start - first + values.shape[1]] += values
    return first, out


def cubic(s: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """The first of the four places of the fine grid around each score, and the weights of the four."""
    at = np.floor(s / FINE)
    f = s / FINE - at
    return at.astype(int) - 1, (-f * (f - 1) * (f - 2) / 6, (f + 1) * (f - 1) * (f - 2) / 2, -(f + 1) * f * (f - 2) / 2, (f + 1) * f * (f - 1) / 6)


def on_grid(s: np.ndarray, y: np.ndarray) -> tuple:
    """(first place, rows by label and place) of the fine grid."""
    at, weights = cubic(s)
    first = int(at.min())
    n = int(at.max()) - first + 4
    flat = sum(np.bincount(y * n + at - first + k, w, 2 * n) for k, w in enumerate(weights))
    return first, flat.reshape(2, n)


def coarse_counts(s: np.ndarray, y: np.ndarray) -> tuple:
    at = np.rint(s / COARSE).astype(int)
    first = int(at.min())
    n = int(at.max()) - first + 1
    return first, np.bincount(y * n + at - first, minlength=2 * n).reshape(2, n).astype(float)


def over_pairs(counts: np.ndarray, f: Callable, unit: float = FINE) -> np.ndarray:
    """At every place i the sum of counts[j] * f(score of j - score of i) over all places j (the first axis)."""
    n = len(counts)
    size = 1 << (3 * n).bit_length()
    values = np.fft.rfft(f(np.arange(n - 1, -n, -1) * unit), size)
    return np.fft.irfft(np.fft.rfft(counts, size, axis=0).T * values, size).T[n - 1 : 2 * n - 1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(x / 2)


def curve(x: np.ndarray) -> np.ndarray:
    return sigmoid(x) * sigmoid(-x)


class PairwiseRanker:
    """score = 1 / (1 + exp(-(slope * (w . z(features)) + offset))), z the training rows' standard scores.

    What is learnt is rounded, so that it does not depend on the order in which the rows are added up.
    """

    def __init__(self, gather: Gather) -> None:
        n, total, squares, good = gather(lambda x, y: (len(y), x.sum(0), (x * x).sum(0), int(y.sum())), added)
        self.n = np.array([n - good, good], float)  # rejected, preferred
        mean = total / n
        self.mean, self.scale = np.round(mean, 9), np.round(np.sqrt(np.maximum(squares / n - mean * mean, 0)), 9) + 1e-3
        self.w = np.zeros(len(mean))
        self.descend(gather)
        self.w = np.round(self.w, 6)
        first, counts = self.counts(gather)[0]
        at, counts = (first + np.arange(counts.shape[1])) * FINE, counts.sum(0)
        self.cut = self.best_cut(gather, at[0], at[-1])
        spread = np.sqrt(max(0.0, float(counts @ (at - counts @ at / n) ** 2 / n)))
        self.slope = 4.0 / (round(spread, 6) + 1e-9)
        self.offset = float(np.log(THRESHOLD / (1 - THRESHOLD))) - self.slope * self.cut

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        """w . z in whole units; equal rows have equal ones whatever lies beside them."""
        return np.rint((self.standard(x) * self.w).sum(1) / UNIT).astype(np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.raw(x) * UNIT) + self.offset, -500, 500)))

    def counts(self, gather: Gather) -> tuple:
        """Rows by label on the fine and on the coarse grid."""

        def part(x: np.ndarray, y: np.ndarray) -> tuple:
            s = self.standard(x) @ self.w
            return on_grid(s, y), coarse_counts(s, y)

        return gather(part, lambda a, b: (aligned(a[0], b[0]), aligned(a[1], b[1])))

    def loss(self, fine: np.ndarray) -> float:
        """Mean of log(1 + exp(score of a rejected row - score of a preferred one)) over all pairs, with the decay."""
        return float(fine[1] @ over_pairs(fine[0], lambda d: np.logaddexp(0, d)) / self.n.prod() + DECAY / 2 * self.w @ self.w)

    def slopes(self, gather: Gather, fine: tuple, coarse: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the loss, and its curvature with scores as they are on the coarse grid."""
        first, rows = fine
        pull = np.stack([over_pairs(rows[1], lambda d: sigmoid(-d)), -over_pairs(rows[0], sigmoid)]).ravel()
        start, grouped = coarse
        n, m, pairs = rows.shape[1], grouped.shape[1], self.n.prod()
        bend = over_pairs(grouped[::-1].T, curve, COARSE).T.ravel()

        def part(x: np.ndarray, y: np.ndarray) -> tuple:
            z = self.standard(x)
            s = z @ self.w
            at, weights = cubic(s)
            at = np.clip(at - first, 0, n - 4) + y * n  # a score may be rounded otherwise than when it was counted
            c = sum(pull[at + k] * w for k, w in enumerate(weights))
            at = np.clip(np.rint(s / COARSE).astype(int) - start, 0, m - 1) + y * m
            order = np.argsort(at, kind="stable")
            places, starts = np.unique(at[order], return_index=True)
            sums = np.zeros((2 * m, z.shape[1]))
            sums[places] = np.add.reduceat(z[order], starts)
            return c @ z, (z * bend[at][:, None]).T @ z, sums

        gradient, own, sums = gather(part, added)
        cross = sums[m:].T @ over_pairs(sums[:m], curve, COARSE)
        return gradient / pairs + DECAY * self.w, (own - cross - cross.T) / pairs + DECAY * np.eye(len(self.w))

    def descend(self, gather: Gather) -> None:
        """Newton's method with halved steps, until the weights stand still."""
        fine, coarse = self.counts(gather)
        now = self.loss(fine[1])
        for _ in range(200):
            gradient, curvature = self.slopes(gather, fine, coarse)
            step, old = -np.linalg.solve(curvature, gradient), self.w
            share = 1.0
            while True:
                self.w = old + share * step
                fine, coarse = self.counts(gather)
                after = self.loss(fine[1])
                if after <= now + 1e-4 * share * (gradient @ step) + 1e-13 or share < 1e-6:
                    break
                share /= 2
            now = after
            if np.abs(self.w - old).max() < 1e-8:
                return

    def best_cut(self, gather: Gather, low: float, high: float) -> float:
        """The cut with the largest mean of both labels' recalls, among all cuts; the middle of the gap it falls in.

        Within a part that holds both labels a cut can win no more than the part's rejected rows. Parts that could win
        are divided again, down to single scores.
        """
        edges = np.unique(np.linspace(np.floor(low / UNIT), np.ceil(high / UNIT) + 1, PARTS).astype(np.int64))
        starts, ends = edges[:1], edges[-1:]
        best, cut = -np.inf, 0
        while len(starts):
            below = gather(lambda x, y: (self.below(x, y, edges),), added)[0]  # by label and edge
            gain = below[0] / self.n[0] - below[1] / self.n[1]
            if gain.max() > best + 1e-12:
                best, cut = float(gain.max()), int(edges[gain.argmax()])
            inside = np.diff(below)
            may = (gain[:-1] + inside[0] / self.n[0] > best + 1e-12) & (inside[1] > 0) & (np.diff(edges) > 1)
            may &= edges[:-1] < ends[np.searchsorted(starts, edges[:-1], "right") - 1]  # not what lies between the parts
            starts, ends = edges[:-1][may], edges[1:][may]
            parts = max(2, PARTS // max(1, len(starts)))
            edges = np.unique([np.linspace(a, b, parts + 1).astype(np.int64) for a, b in zip(starts, ends)])

        def around(x: np.ndarray, y: np.ndarray) -> tuple:
            s = self.raw(x)
            return s[s < cut].max(initial=np.iinfo(np.int64).min), s[s >= cut].min(initial=np.iinfo(np.int64).max)

        under, over = gather(around, lambda a, b: (max(a[0], b[0]), min(a[1], b[1])))
        under, over = (int(x) if abs(int(x)) < 1 << 62 else cut for x in (under, over))
        return (under + over) / 2 * UNIT

    def below(self, x: np.ndarray, y: np.ndarray, edges: np.ndarray) -> np.ndarray:
        s = self.raw(x)
        return np.stack([np.searchsorted(np.sort(s[y == label]), edges) for label in (0, 1)])


def training_rows(table: DataFrame, labels: DataFrame) -> DataFrame:
    """features, quality: every row of a labelled document outside the held-out fold."""
    own = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held(F.col("doc_id"), 5, 0))
    own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    return table.join(own, "doc_id").select("features", "quality")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of docs.

    Without documents of both labels to learn from, every score is 0.5. A null text counts as empty; empty texts get
    the score of their (zero) features. A null doc_id is not held out, nor learnt from. If a doc_id has several
    labels, 1 counts, for each of its rows. Repeated rows get equal scores, and each is learnt from; an empty table
    gives no rows. Columns of docs other than doc_id and text, and of labels other than doc_id and quality, are ignored.
    """
    table = saved(feature_table(docs))
    rows = saved(training_rows(table, labels.select("doc_id", "quality")))
    both = rows.select("quality").distinct().count() == 2
    ranker = PairwiseRanker(gatherer(rows)) if both else None

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            score = np.full(len(batch), 0.5) if ranker is None else ranker.score(matrix(batch))
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "score": pa.array(score, pa.float64())})

    scored = table.mapInArrow(apply, "doc_id long, score double")
    return scored.select("doc_id", held(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
