"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a bounded sample and every vector is put into the leaf it reaches. A query walks the tree
through a priority queue, nearest bins first; how many leaves it visits is widened until queries whose true
neighbours are known reach the wanted recall. Each visited leaf is then searched exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import saved, unit_hash

#: The tree is fitted on a share of the vectors (as expected by the sampling rate), at least and at most so many of
#: them; branches of a node; vectors of a leaf, which grow with the table only once the sample no longer does.
SHARE, SAMPLE, MOST_SAMPLE, BRANCHES, LEAF = 0.01, 20_000, 200_000, 12, 1000
#: Queries whose true neighbours are found by brute force, and the recall that they must reach.
KNOWN, RECALL = 100, 0.97
#: Vectors and queries of a leaf are dealt into blocks of about this many; queries compared at once.
BLOCK, AT_ONCE = 2000, 256


@dataclass
class KMeansTree:
    """Unit centres of each inner node, its children (inner nodes, or leaves as -1 - leaf), and the number of leaves."""

    centres: list[np.ndarray]
    children: list[list[int]]
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.centres else []
        while todo:
            node, rows = todo.pop()
            best = (x[rows] @ self.centres[node].T).argmax(axis=1)
            for k, child in enumerate(self.children[node]):
                part = rows[best == k]
                if child < 0:
                    out[part] = -1 - child
                elif len(part):
                    todo.append((child, part))
        return out

    def visits(self, q: np.ndarray, most: int) -> list[int]:
        """Leaves in the order of a best-bin-first walk: the closest bin seen so far is always opened next."""
        if not self.centres:
            return [0]
        queue: list[tuple[float, int]] = [(0.0, 0)]
        out: list[int] = []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            while node >= 0:
                near = self.centres[node] @ q
                order = np.argsort(-near, kind="stable")
                for k in order[1:]:
                    heapq.heappush(queue, (1.0 - float(near[k]), self.children[node][k]))
                node = self.children[node][order[0]]
            out.append(-1 - node)
        return out


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row by a power of two, so that no square overflows or vanishes; cosines stay the same to the last bit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(sample: np.ndarray, leaf: int, branches: int = BRANCHES, seed: int = 3) -> KMeansTree:
    """Spherical k-means, again and again, until a node holds at most `leaf` vectors of the sample or cannot be split."""
    rng = np.random.default_rng(seed)
    tree = KMeansTree([], [], 0)

    def grow(x: np.ndarray) -> int:
        if len(x) <= leaf or len(x) < 2 * branches:
            tree.leaves += 1
            return -tree.leaves
        centres = x[rng.choice(len(x), branches, replace=False)]
        for _ in range(10):
            best = (x @ centres.T).argmax(axis=1)
            for k in range(branches):
                if (best == k).any():
                    c = x[best == k].mean(axis=0)
                    centres[k] = c / max(float(np.linalg.norm(c)), 1e-12)
        best = (x @ centres.T).argmax(axis=1)
        kept = [k for k in range(branches) if (best == k).any()]
        if len(kept) < 2 or max((best == k).sum() for k in kept) > 0.95 * len(x):
            tree.leaves += 1
            return -tree.leaves
        node = len(tree.centres)
        tree.centres.append(centres[kept])
        tree.children.append([])
        tree.children[node] = [grow(x[best == k]) for k in kept]
        return node

    grow(sample)
    return tree


def _arrays(rows: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(rows), -1) if len(rows) else flat.reshape(0, 0)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = batch["n"].to_numpy()
    for n in np.unique(lengths):
        yield int(n), batch.filter(pa.array(lengths == n))


def best_of(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, float]]:
    """The k ids of the greatest scores, each id once by its best row, ties to smaller ids, the query's own rows left out."""
    best: dict[int, float] = {}
    for i in np.lexsort((ids, -scores)):
        if ids[i] != own:
            best.setdefault(int(ids[i]), float(scores[i]))
            if len(best) == k:
                break
    return list(best.items())


def candidates(near: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Rows that may be among the best k ids: those down to a score of `near` (rounded) that k other ids reach."""
    m = k + int((ids == own).sum())
    while m < len(near):
        keep = np.flatnonzero(near >= np.partition(near, len(near) - m)[len(near) - m] - 1e-9)
        if len(np.unique(ids[keep])) > k:
            return keep
        m *= 4
    return np.arange(len(near))


def top(q: np.ndarray, owns: list[int], x: np.ndarray, ids: np.ndarray, k: int) -> Iterator[list[tuple[int, float]]]:
    """best_of for each query: products of matrices find the candidates, whose cosines are then taken one by one."""
    q, x = _scaled(q), _scaled(x)
    q_norms, norms = np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)
    unit = x / norms[:, None]
    for at in range(0, len(q), AT_ONCE):
        near = (q[at : at + AT_ONCE] / q_norms[at : at + AT_ONCE, None]) @ unit.T
        for i, row in enumerate(near, at):
            some = candidates(row, ids, owns[i], k)
            yield best_of((x[some] * q[i]).sum(axis=1) / (norms[some] * q_norms[i]), ids[some], owns[i], k)


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, v (array of doubles) and n (its length) of the rows that take part: finite, not null, empty or zero."""
    v = F.transform(F.col(f"`{column}`"), lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(finite & F.exists("v", lambda x: x != 0)).select("vec_id", "v", F.size("v").alias("n"))


def _final(found: DataFrame, k: int) -> DataFrame:
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    hits = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).groupBy("query_id").agg(top.alias("top")).select("query_id", F.posexplode("top").alias("pos", "hit"))
    return hits.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score"))


HITS = "query_id long, vec_id long, score double"


def _hits(rows: list[tuple[int, int, float]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def _search(k: int):
    def search(key: tuple, queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return _hits([])
        owns = queries["query_id"].tolist()
        found = top(np.stack(queries["v"].to_numpy()), owns, np.stack(vectors["v"].to_numpy()), vectors["vec_id"].to_numpy(), k)
        return _hits([(q, i, s) for q, hits in zip(owns, found, strict=True) for i, s in hits])

    return search


def brute_force(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> pd.DataFrame:
    """The true k nearest of a bounded list of queries: each batch of vectors gives its k best, and those are merged."""
    by_length: dict[int, list[tuple[int, list[float]]]] = {}
    for q in queries:
        by_length.setdefault(len(q[1]), []).append(q)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, part in _by_length(batch):
                if asked := by_length.get(n):
                    owns = [i for i, _ in asked]
                    found = top(np.array([v for _, v in asked], np.float64), owns, _arrays(part["v"]), part["vec_id"].to_numpy(), k)
                    yield pa.RecordBatch.from_pandas(_hits([(q, i, s) for q, hits in zip(owns, found, strict=True) for i, s in hits]), preserve_index=False)

    return _final(vectors.mapInArrow(scan, HITS), k).toPandas()


class Forest:
    """One tree for each length of vectors; its leaves are numbered on from `first`."""

    def __init__(self, sample: dict[int, np.ndarray], counts: dict[int, int]) -> None:
        self.trees: dict[int, KMeansTree] = {}
        self.first: dict[int, int] = {}
        self.leaves = 0
        for n, total in sorted(counts.items()):
            x = sample.get(n)
            tree = KMeansTree([], [], 1) if x is None else fit(_unit(x), max(8, int(LEAF * min(1.0, len(x) / total))))
            self.trees[n], self.first[n] = tree, self.leaves
            self.leaves += tree.leaves

    def leaf_of(self, n: int, x: np.ndarray) -> np.ndarray:
        return self.first[n] + self.trees[n].leaf_of(_unit(x))

    def visits(self, n: int, q: np.ndarray, most: int) -> list[list[int]]:
        return [[self.first[n] + leaf for leaf in self.trees[n].visits(x, most)] for x in _unit(q)]


def _sampled(rows: DataFrame, rate: float) -> dict[int, np.ndarray]:
    """Vectors drawn by a hash of their ids, by length; each batch of them reaches the driver as bytes."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, part in _by_length(batch):
                yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int32()), "x": pa.array([_arrays(part["v"]).tobytes()], pa.binary()), "id": pa.array([part["vec_id"].to_numpy().tobytes()], pa.binary())})

    drawn = rows.filter(unit_hash(F.col("vec_id"), F.col("v"), seed=5) < rate).mapInArrow(packed, "n int, x binary, id binary").collect()
    out: dict[int, np.ndarray] = {}
    for n in {r["n"] for r in drawn}:
        x = np.concatenate([np.frombuffer(r["x"], np.float64).reshape(-1, n) for r in drawn if r["n"] == n])
        ids = np.concatenate([np.frombuffer(r["id"], np.int64) for r in drawn if r["n"] == n])
        out[n] = x[np.lexsort((*x.T[: min(n, 2)], ids))]
    return out


def _calibrated(rows: DataFrame, placed: DataFrame, queries: DataFrame, forest: Forest, k: int, recall: float) -> int:
    """How many leaves to visit, so that KNOWN queries reach the recall: their true neighbours are found by brute force."""
    known = queries.orderBy(unit_hash(F.col("vec_id"), seed=6), "vec_id", "v").limit(KNOWN).collect()
    truth = brute_force(rows, [(r["vec_id"], r["v"]) for r in known], k)
    if not len(truth):
        return 1
    wanted = rows.sparkSession.createDataFrame(truth[["vec_id"]].drop_duplicates())
    where: dict[int, set[int]] = {}
    for r in placed.join(F.broadcast(wanted), "vec_id").select("vec_id", "leaf").distinct().collect():
        where.setdefault(r["vec_id"], set()).add(r["leaf"])
    orders: dict[int, dict[int, int]] = {}
    for r in known:
        for place, leaf in enumerate(forest.visits(r["n"], np.array([r["v"]], np.float64), forest.leaves)[0], 1):
            order = orders.setdefault(r["vec_id"], {})
            order[leaf] = min(place, order.get(leaf, place))
    need = np.sort([min(orders[q][leaf] for leaf in where[v] if leaf in orders[q]) for q, v in zip(truth["query_id"], truth["vec_id"], strict=True)])
    return int(need[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)])


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, recall: float = RECALL, column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row with is_query, by cosine, ties to smaller ids.

    Vectors that are null, empty or zero, or hold null or non-finite components, and rows without a vec_id take no
    part; as queries they have no rows. A cosine needs vectors of one length, so those of each length are searched
    among themselves. Rows of one vec_id are never each other's neighbours; a repeated neighbour counts once, by its
    best row, and repeated query rows give one list, each neighbour by its best score. A query that finds fewer than k
    in the leaves it visits visits more, so there are fewer rows only where there are fewer candidates; an empty table
    gives none. Columns other than vec_id and the embedding are ignored.
    """
    spark = vectors.sparkSession
    rows = saved(usable(vectors, column))
    counts = {r["n"]: r["count"] for r in rows.groupBy("n").count().collect()}
    total = sum(counts.values())
    size = min(MOST_SAMPLE, max(SAMPLE, int(SHARE * total)))
    forest = Forest(_sampled(rows, min(1.0, size / max(1, total))), counts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, part in _by_length(batch):
                yield pa.RecordBatch.from_pydict({"vec_id": part["vec_id"], "v": part["v"], "leaf": pa.array(forest.leaf_of(n, _arrays(part["v"])), pa.int64())})

    placed = saved(rows.mapInArrow(place, "vec_id long, v array<double>, leaf long"))
    wanted = rows.withColumn("wanted", F.coalesce(is_query, F.lit(False))).filter("wanted").select("vec_id", "v", "n")
    queries = saved(wanted.repartition(max(1, spark.sparkContext.defaultParallelism)))
    visits = _calibrated(rows, placed, queries, forest, k, recall)
    sizes = saved(placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")))  # one row per leaf

    def asked(some: DataFrame, most: int) -> DataFrame:
        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n, part in _by_length(batch):
                    leaves = forest.visits(n, _arrays(part["v"]), most)
                    yield pa.RecordBatch.from_pydict({"query_id": part["vec_id"], "v": part["v"], "leaves": pa.array(leaves, pa.list_(pa.int64()))})

        walked = saved(some.mapInArrow(walk, "query_id long, v array<double>, leaves array<long>"))
        asks = walked.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("groups"))
        tiles = F.broadcast(saved(sizes.join(F.broadcast(asks), "leaf")))
        left = walked.select("query_id", "v", F.explode("leaves").alias("leaf")).join(tiles, "leaf")
        left = left.select("query_id", "v", "leaf", F.pmod(F.xxhash64("query_id"), "groups").cast("int").alias("group"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        right = placed.join(tiles, "leaf").select("vec_id", "v", "leaf", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"))
        keys = ("leaf", "group", "block")
        return _final(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search(k), HITS), k)

    most = max((t.leaves for t in forest.trees.values()), default=1)
    out = saved(asked(queries, visits))
    while visits < most:
        enough = saved(out.groupBy("query_id").count().filter(F.col("count") >= k).select("query_id"))
        few = saved(queries.join(enough, queries["vec_id"] == enough["query_id"], "left_anti"))
        if few.isEmpty():
            break
        visits = min(most, 8 * visits)
        out = saved(out.join(enough, "query_id", "left_semi").unionByName(asked(few, visits)))
    return out
