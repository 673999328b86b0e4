"""Language identification by a byte convolutional network.

Filters of several widths run over byte embeddings, are max-pooled over a window and feed a softmax. The network
is trained in numpy on a bounded sample of labelled texts and applied to every fixed-length window of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from plinth.llm.common import held, unit_hash

WIDTHS, FILTERS, EMBED, LENGTH = (2, 3, 4), 16, 6, 256
#: Bounds of the training sample: languages (those of most documents), and labelled documents of each of them (as
#: expected by the sampling rate), which are learnt from as whole texts.
LANGUAGES, PER_LANGUAGE = 500, 1200


def text_bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


@dataclass
class ByteCnn:
    """Embedding (256 x EMBED), filters as one matrix over max(WIDTHS) bytes, and the softmax layer."""

    classes: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def patches(self, windows: np.ndarray) -> np.ndarray:
        n, length = windows.shape
        wide = max(WIDTHS)
        padded = np.zeros((n, length + wide - 1, EMBED), np.float32)
        padded[:, :length] = self.embed[windows]
        view = np.lib.stride_tricks.sliding_window_view(padded.reshape(n, -1), wide * EMBED, axis=1)[:, ::EMBED]
        return np.ascontiguousarray(view)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        x = self.patches(windows)
        z = x.reshape(-1, x.shape[2]) @ self.filters
        return np.maximum(z.reshape(*windows.shape, -1).max(axis=1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = self.pooled(windows) @ self.out + self.out_bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Over all windows of each text: mean of the probabilities, weighted by the windows' bytes."""
        raw = [text_bytes(t) for t in texts]
        counts = np.array([-(-len(b) // LENGTH) for b in raw])
        probs = np.zeros((len(raw), len(self.classes)))
        owner = np.repeat(np.arange(len(raw)), counts)
        data = np.frombuffer(b"".join(b.ljust(n * LENGTH, b"\0") for b, n in zip(raw, counts, strict=True)), np.uint8).reshape(-1, LENGTH)
        for i in range(0, len(data), 256):
            part = data[i : i + 256]
            np.add.at(probs, owner[i : i + 256], self.probabilities(part) * (part != 0).sum(axis=1, keepdims=True))
        probs /= np.maximum(probs.sum(axis=1, keepdims=True), 1e-12)
        best = probs.argmax(axis=1)
        return [self.classes[k] for k in best], probs[np.arange(len(raw)), best].tolist()


def train(texts: list[str], langs: list[str], epochs: int = 30, seed: int = 7) -> ByteCnn | None:
    """Adam on crops of 12 to LENGTH bytes; None without any labelled text."""
    classes = sorted(set(langs))
    raw = [text_bytes(t) for t in texts]
    keep = [i for i, b in enumerate(raw) if b.strip()]
    if not keep:
        return None
    rng = np.random.default_rng(seed)
    y_all = np.array([classes.index(langs[i]) for i in keep])
    weight = (len(keep) / (len(classes) * np.bincount(y_all, minlength=len(classes)).clip(1)))[y_all]
    wide, n_filters = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((wide * EMBED, n_filters), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[: w * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
    net = ByteCnn(classes, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32), np.zeros(n_filters, np.float32), rng.normal(0, 0.2, (n_filters, len(classes))).astype(np.float32), np.zeros(len(classes), np.float32))
    net.embed[0] = 0
    names = ("embed", "filters", "bias", "out", "out_bias")
    moments = {k: [np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))] for k in names}
    batch, step = 64, 0
    steps = max(epochs * -(-len(keep) // batch), 400)
    while step < steps:
        order = rng.permutation(len(keep))
        for s in range(0, len(order), batch):
            pick = order[s : s + batch]
            windows = np.zeros((len(pick), LENGTH), np.uint8)
            for r, j in enumerate(pick):
                b = raw[keep[j]]
                n = min(len(b), LENGTH if rng.random() < 0.4 else int(rng.integers(12, LENGTH)))
                at = int(rng.integers(0, len(b) - n + 1))
                windows[r, :n] = np.frombuffer(b[at : at + n], np.uint8)
            x = net.patches(windows)
            z = (x.reshape(-1, x.shape[2]) @ net.filters).reshape(len(pick), LENGTH, -1)
            arg = z.argmax(axis=1)
            top = np.take_along_axis(z, arg[:, None], 1)[:, 0] + net.bias
            h = np.maximum(top, 0)
            logits = h @ net.out + net.out_bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            d = p
            d[np.arange(len(pick)), y_all[pick]] -= 1
            d *= (weight[pick] / len(pick))[:, None]
            dh = (d @ net.out.T) * (top > 0)
            rows = np.arange(len(pick))[:, None]
            at_max = x[rows, arg]  # batch x filters x (wide * EMBED)
            grads = {"out": h.T @ d, "out_bias": d.sum(0), "bias": dh.sum(0), "filters": np.einsum("bf,bfk->kf", dh, at_max) * mask}
            back = (dh[:, :, None] * net.filters.T[None]).reshape(len(pick), n_filters, wide, EMBED)
            g = np.zeros_like(net.embed)
            padded = np.pad(windows, ((0, 0), (0, wide - 1)))
            np.add.at(g, padded[rows[:, :, None], arg[:, :, None] + np.arange(wide)], back)
            g[0] = 0
            grads["embed"] = g
            step += 1
            rate = 0.01 * (1 - step / (steps + 1)) + 0.0005
            for k in names:
                m, v = moments[k]
                m += 0.1 * (grads[k] - m)
                v += 0.01 * (grads[k] ** 2 - v)
                getattr(net, k)[...] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            if step >= steps:
                break
    return net


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> pd.DataFrame:
    """Whole texts and languages of about per_language documents of each language, the same in every run.

    Rows of the held-out fold, null languages, texts or ids are left out. Rows are drawn by a hash of id and text, and
    equal ones count once, so what reaches the driver is bounded by documents however often one is repeated.
    """
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held(F.col("doc_id"), 4, 2))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()}
    if not counts:
        return pd.DataFrame({"lang": [], "text": []})
    rate = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))]), F.col("lang"))
    sample = rows.filter(unit_hash(F.col("doc_id"), F.col("text")) < rate).select("doc_id", "lang", "text").distinct()
    return sample.toPandas().sort_values(["lang", "doc_id", "text"], ignore_index=True)


def with_language(docs: DataFrame, per_language: int = PER_LANGUAGE, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of docs, with the predicted language and its score: no row moves.

    A column of docs by either name is replaced. See language_id for what odd rows get.
    """
    sample = training_sample(docs, per_language)
    net = train(sample["text"].tolist(), sample["lang"].tolist())
    kept = [c for c in docs.columns if c not in (lang, score)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"].to_pylist()]
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if net and any(map(str.isalpha, t))]
            start = 0
            while start < len(known):
                stop, size = start, 0
                while stop < len(known) and (stop == start or size < 1 << 21):
                    size += len(texts[known[stop]])
                    stop += 1
                for i, name, p in zip(known[start:stop], *net.predict([texts[i] for i in known[start:stop]]), strict=True):
                    langs[i], scores[i] = name, min(1.0, p)
                start = stop
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*kept, lang, score])

    schema = StructType([docs.schema[c] for c in kept] + [StructField(lang, StringType()), StructField(score, DoubleType())])
    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(apply, schema)


def language_id(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of docs.

    lang_pred is ``und`` with score 0 if the text is null or has no letter, and for all rows if no row has a
    language to learn from. A null doc_id is not held out, nor learnt from. An empty table gives no rows.
    Columns other than doc_id, text and lang are ignored; repeated rows give equal rows.
    """
    rows = with_language(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"), per_language)
    return rows.select("doc_id", held(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
