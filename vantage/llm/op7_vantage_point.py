"""Approximate nearest neighbours by inner product: vantage-point trees, one for each shard.

Vectors are placed in shards of about `shard_size` by a hash of their id. With
M the largest norm, a vector x becomes (x, sqrt(M^2 - |x|^2)) and a query
(q, 0): their distance falls as the inner product grows, and it is a metric, so
the triangle inequality may prune. A tree splits each node at the median
distance from a vantage point; a search skips the side that cannot hold a point
within tau / `factor` of the query, tau being the distance of the k-th best so
far. Factor 1 gives exact results; a larger one prunes more and may miss some.

Queries meet shards in blocks: a task searches one block in one shard. The best
of each shard meet in a window whose limit Spark applies before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF = 256         # vectors below which a node is scanned
QUERY_BLOCK = 4096
PART = 512         # queries that a leaf is scanned for at a time


class Tree:
    """A vantage-point tree over rows of `points` (already lifted)."""

    def __init__(self, points: np.ndarray, seed: int = 7):
        self.points, self.rng = points, np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, own: np.ndarray):
        if len(own) <= LEAF:
            return own
        pivot = self.points[own[self.rng.integers(len(own))]]
        gap = self.points[own] - pivot
        d = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        middle = np.median(d)
        inner = d <= middle
        if inner.all():  # more than half lie at one distance
            inner = d < middle
            if not inner.any():
                return own
        return pivot, middle, self._build(own[inner]), self._build(own[~inner])


class Search:
    """The k best of a tree for many queries at once, ties to the smaller id; counts the inner products it takes.

    A leaf's scores are first taken by a matrix product, whose rounding differs
    from pair to pair; whatever may be among the best is scored again by
    `exact`, so equal vectors of components tie wherever they lie."""

    def __init__(self, tree: Tree, vectors: np.ndarray, queries: np.ndarray, top: float, k: int, factor: float,
                 ids: np.ndarray | None = None):
        self.tree, self.vectors, self.queries, self.k, self.factor = tree, vectors, queries, k, factor
        self.ids = np.arange(len(vectors)) if ids is None else ids
        self.square = np.einsum("ij,ij->i", queries, queries) + top * top
        self.slack = 1e-11 * self.square     # of a score, for rounding
        self.score = np.full((len(queries), k), -np.inf)
        self.index = np.full((len(queries), k), -1)
        self.lifted = np.hstack([queries, np.zeros((len(queries), 1))])
        self.taken = 0
        if len(vectors) and len(queries):
            self._visit(tree.root, np.arange(len(queries)))

    def _reach(self, q: np.ndarray) -> np.ndarray:
        """Distances within which better points may lie, divided by the factor."""
        worst = self.score[q].min(1)
        return np.sqrt(np.maximum(self.square[q] - 2 * worst + self.slack[q], 0)) / self.factor + 1e-7 * np.sqrt(self.square[q])

    def _visit(self, node, q: np.ndarray) -> None:
        if not len(q):
            return
        if isinstance(node, np.ndarray):
            self.taken += len(q) * len(node)
            for part in np.array_split(q, -(-len(q) // PART)):
                self._scan(node, part)
            return
        pivot, middle, inner, outer = node
        self.taken += len(q)
        d = np.sqrt(np.maximum(((self.lifted[q] - pivot) ** 2).sum(1), 0))
        near = d <= middle
        self._visit(inner, q[near])
        self._visit(outer, q[~near])
        left = q[near]
        self._visit(outer, left[middle - d[near] <= self._reach(left)])
        right = q[~near]
        self._visit(inner, right[d[~near] - middle <= self._reach(right)])


    def _scan(self, node: np.ndarray, q: np.ndarray) -> None:
        s = self.queries[q] @ self.vectors[node].T
        least = self.score[q].min(1)
        if len(node) > self.k:
            least = np.maximum(least, np.partition(s, len(node) - self.k, axis=1)[:, len(node) - self.k])
        row, col = np.nonzero(s >= (least - self.slack[q])[:, None])
        if not len(row):
            return
        some, row = np.unique(row, return_inverse=True)
        q, point = q[some], node[col]
        row = np.concatenate([np.repeat(np.arange(len(q)), self.k), row])
        score = np.concatenate([self.score[q].ravel(), exact(self.vectors[point], self.queries[q[row[len(q) * self.k:]]])])
        point = np.concatenate([self.index[q].ravel(), point])
        by = np.lexsort((self.ids[point], -score, row))
        first = np.searchsorted(row[by], np.arange(len(q)))
        keep = by[first[:, None] + np.arange(self.k)]     # every row has k at least
        self.score[q], self.index[q] = score[keep], point[keep]


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, each by the same summation."""
    return (a * b).sum(1)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, top: float,
                 k: int, factor: float):
    """(query id, id, score) of the k best of this shard for each query; a query's own id does not count."""
    distinct, which = np.unique(vectors, axis=0, return_inverse=True)
    by = np.lexsort((ids, which.ravel()))
    first = np.searchsorted(which.ravel()[by], np.arange(len(distinct) + 1))
    square = np.einsum("ij,ij->i", distinct, distinct)
    tree = Tree(np.hstack([distinct, np.sqrt(np.maximum(top * top - square, 0))[:, None]]))
    # one more, as the query itself may be among them; equal vectors are one point with several ids
    found = Search(tree, distinct, queries, top, min(k + 1, len(distinct)), factor, ids[by[first[:-1]]]).index
    out_q, out_i, out_s = [], [], []
    for r, q in enumerate(query_ids.tolist()):
        point = found[r][found[r] >= 0]
        score = exact(distinct[point], queries[r])
        own = [ids[by[first[p]:min(first[p + 1], first[p] + k + 1)]] for p in point]
        i, s = np.concatenate(own), np.repeat(score, [len(x) for x in own])
        keep = i != q
        i, s = i[keep], s[keep]
        best = np.lexsort((i, -s))[:k]
        out_q.append(np.full(len(best), q))
        out_i.append(i[best])
        out_s.append(s[best])
    return tuple(np.concatenate(x) for x in (out_q, out_i, out_s))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, factor: float = 1.0, shard_size: int = 16_384,
            seed: int = 7) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query row's k best among all other rows (vec_id, embedding).

    Vectors that are null, empty, zero, or hold a null or non-finite component,
    and rows without id, take no part. Vectors only meet those of the same
    length. Of rows that share a vec_id the least vector counts. Ties go to
    the smaller vec_id. Other columns are read only by `is_query`."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = (vectors.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(sound)
            .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
            .agg(F.min(v.cast("array<double>")).alias("v"), F.max(is_query).alias("q"))
            .withColumn("dim", F.size("v")))
    size = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("nq"), F.max(F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + x * x)).alias("square")).first()
    shards, blocks = max(1, -(-size["n"] // shard_size)), max(1, -(-size["nq"] // QUERY_BLOCK))
    top = float(np.sqrt(size["square"] or 0.0))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(seed + salt)), F.lit(n)).cast("int")
    points = rows.select("vec_id", "v", "dim", place(shards, 0).alias("shard"), every(blocks).alias("block"))
    queries = rows.where("q").select("vec_id", "v", "dim", every(shards).alias("shard"), place(blocks, 1).alias("block"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        none = not left.num_rows or not right.num_rows
        q, i, s = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) if none else search_shard(
            left["vec_id"].to_numpy(), _matrix(left["v"]), right["vec_id"].to_numpy(), _matrix(right["v"]), top, k, factor)
        return pa.table({"query_id": q, "vec_id": i, "score": s})

    keys = ["dim", "shard", "block"]
    found = points.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
