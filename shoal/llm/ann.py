"""Nearest neighbours by vantage-point trees, one per shard of the data.

Rows are dealt by hash to shards of about ``SHARD`` rows. A task builds a shard's tree and sends a block of queries
down it together: each query first goes to the side of the vantage point it lies on, and to the other side
only if the triangle inequality leaves room there for a nearer neighbour. ``factor`` scales that bound: one is exact, above
one skips more. The nearest of each shard are then ranked per query.

Edge cases: rows with a NULL id or a vector that is NULL, empty, zero or holds NULL or non-finite components take no part. Vectors
of another length than the query's are no candidates. Fewer than ``k`` candidates: all of them. Ties: the smaller
id. A repeated query row is one query. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import materialise
from shoal.llm.vectors import in_blocks, matrix, valid

SHARD, QUERIES, LEAF = 8192, 4096, 64


def euclidean(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of paired rows in double precision, components added in order."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += (a[:, j] - b[:, j]) ** 2
    return np.sqrt(total)


class Tree:
    """A vantage-point tree over the rows of ``x``. A node is (vantage row, radius, inside, outside), a leaf an array of rows."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids = x, ids
        self.rng = np.random.default_rng(11)
        self.root = self._build(np.arange(len(x)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        at = int(self.rng.integers(len(rows)))
        point, rest = rows[at], np.delete(rows, at)
        d = euclidean(self.x[rest], np.broadcast_to(self.x[point], (len(rest), self.x.shape[1])))
        radius = float(np.median(d))
        inside = d <= radius
        if inside.all():  # copies: no radius splits them
            half = len(rest) // 2
            return int(point), radius, self._build(rest[:half]), rest[half:] if half <= LEAF else self._build(rest[half:])
        return int(point), radius, self._build(rest[inside]), self._build(rest[~inside])

    def search(self, q: np.ndarray, own: np.ndarray, k: int, factor: float = 1.0):
        """(distances, ids), queries x k, nearest first; infinite where there are fewer. ``own``: ids left out per query."""
        self.q, self.own, self.k, self.factor = q, own, k, factor
        self.best = np.full((len(q), k), np.inf)
        self.found = np.full((len(q), k), np.iinfo(np.int64).max)
        self.visited = 0
        self._visit(self.root, np.arange(len(q)))
        return self.best, self.found

    def _merge(self, who: np.ndarray, rows: np.ndarray) -> None:
        """Offer ``rows`` to the queries ``who``."""
        self.visited += len(who) * len(rows)
        a, b = self.q[who], self.x[rows]
        rough = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
        worst = self.best[who, -1]
        limit = np.where(np.isinf(worst), np.inf, worst * worst * (1 + 1e-9) + 1e-9 * (a * a).sum(1))
        i, j = np.nonzero((rough <= limit[:, None]) & (self.ids[rows][None] != self.own[who][:, None]))
        if not len(i):
            return
        d, ids = euclidean(a[i], b[j]), self.ids[rows[j]]
        hit = np.unique(i)
        owner = np.concatenate([i, np.repeat(hit, self.k)])
        d = np.concatenate([d, self.best[who[hit]].ravel()])
        ids = np.concatenate([ids, self.found[who[hit]].ravel()])
        order = np.lexsort((ids, d, owner))
        owner, d, ids = owner[order], d[order], ids[order]
        first = np.searchsorted(owner, hit)
        take = first[:, None] + np.arange(self.k)[None]
        self.best[who[hit]], self.found[who[hit]] = d[take], ids[take]

    def _visit(self, node, who: np.ndarray) -> None:
        if not len(who):
            return
        if isinstance(node, np.ndarray):
            if len(node):
                self._merge(who, node)
            return
        point, radius, inside, outside = node
        self._merge(who, np.array([point]))
        d = euclidean(self.q[who], np.broadcast_to(self.x[point], (len(who), self.x.shape[1])))
        near = d <= radius
        self._visit(inside, who[near])
        self._visit(outside, who[~near])
        # what lies on the other side is at least this far; rounding must not cut off an equal one
        room = self.factor * np.abs(d - radius) <= self.best[who, -1] * (1 + 1e-12) + 1e-12
        self._visit(outside, who[near & room])
        self._visit(inside, who[~near & room])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` (vec_id, embedding) its ``k`` nearest rows of
    ``vectors``, other than those with its own id."""
    def ready(df):
        return df.filter(F.col("vec_id").isNotNull() & valid()).select(
            "vec_id", F.col("embedding").cast("array<double>").alias("v"), F.size("embedding").alias("dim"))

    data = materialise(ready(vectors), "ann-rows")
    asked = materialise(ready(queries).dropDuplicates(["vec_id", "v"]), "ann-queries")
    shard, shards = in_blocks(data, F.struct("vec_id", "v"), SHARD, data.count())
    block, blocks = in_blocks(asked, F.col("vec_id"), QUERIES, asked.count())
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = (data.select("dim", shard.alias("shard"), "vec_id", "v", F.lit(False).alias("asks"))
            .withColumn("block", every(blocks))
            .unionByName(asked.select("dim", block.alias("block"), "vec_id", "v", F.lit(True).alias("asks"))
                         .withColumn("shard", every(shards))))
    schema = "query_id long, vec_id long, score double"
    names = ["query_id", "vec_id", "score"]

    def search(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, x = table.column("vec_id").to_numpy(), matrix(table.column("v"))
        empty = [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())]
        if not asks.any() or asks.all():
            return pa.table(empty, names=names)
        best, found = Tree(x[~asks], ids[~asks]).search(x[asks], ids[asks], k, factor)
        there = np.isfinite(best)
        return pa.table([pa.array(np.repeat(ids[asks], k).reshape(best.shape)[there]), pa.array(found[there]),
                         pa.array(best[there])], names=names)

    found = rows.groupBy("dim", "shard", "block").applyInArrow(search, schema)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
WITH ok AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
  FROM (SELECT DISTINCT * FROM ok WHERE vec_id % 100 = 0) q JOIN ok c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM near
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) <= 10
"""
