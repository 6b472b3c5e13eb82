"""Exact top-k by integer inner product: ball trees per shard, branch and bound over them.

Rows are dealt evenly over shards. A shard builds a ball tree of its vectors. No vector of a node
with centre c and radius r scores more than q.c + |q| r against a query q, so nodes are visited in
order of that bound and the search ends when the next bound is under the current k-th score.

The k-th score is shared: a query is searched in its own shard first, and the score found there
starts the search in all other shards, which then return only what may still be among the k best.
Queries go to the other shards in blocks; a task holds one shard and one block.
"""

from __future__ import annotations

import heapq
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgflow.session import materialize

SHARD_ROWS, QUERY_BLOCK, LEAF = 16_384, 2_048, 64
FOUND = "_query long, _query_id long, _shard long, _found long, _score long, _known int"


class BallTree:
    """A tree over the rows of an integer matrix."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.order = np.arange(len(vectors))
        self.vectors, self.ids = vectors, ids
        self.centres, self.radii, self.ranges, self.children = [], [], [], []
        self._real = vectors.astype(np.float64)
        if len(vectors):
            self._build()
        del self._real
        self.vectors, self.ids = vectors[self.order], ids[self.order]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def _node(self, lo: int, hi: int) -> int:
        points = self._real[self.order[lo:hi]]
        centre = points.mean(axis=0)
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(((points - centre) ** 2).sum(axis=1).max())))
        self.ranges.append((lo, hi))
        self.children.append(None)
        return len(self.radii) - 1

    def _build(self) -> None:
        open_nodes = [self._node(0, len(self.order))]
        while open_nodes:
            at = open_nodes.pop()
            lo, hi = self.ranges[at]
            if hi - lo <= LEAF:
                continue
            points = self._real[self.order[lo:hi]]
            # Split between two far points, in halves, so equal vectors are split as well.
            one = points[((points - self.centres[at]) ** 2).sum(axis=1).argmax()]
            two = points[((points - one) ** 2).sum(axis=1).argmax()]
            side = points @ (two - one)
            middle = (hi - lo) // 2
            self.order[lo:hi] = self.order[lo:hi][np.argpartition(side, middle)]
            pair = (self._node(lo, lo + middle), self._node(lo + middle, hi))
            self.children[at] = pair
            open_nodes += pair

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floors: list[Optional[int]]) -> list[list[tuple[int, int]]]:
        """For each query its best (score, id) other than its own; ties to smaller ids.

        With a floor given, results under it are left out.
        """
        if not len(self.radii):
            return [[] for _ in own]
        real = queries.astype(np.float64)
        bounds = real @ self.centres.T + np.sqrt((real**2).sum(axis=1))[:, None] * self.radii
        # Sums of floats are inexact in their last digits; scores are whole numbers.
        bounds += 1 + np.abs(bounds) * 1e-9
        out = []
        for q, mine, floor, bound in zip(queries, own.tolist(), floors, bounds):
            best: list[tuple[int, int]] = []  # a heap of (score, -id)
            least = floor
            todo = [(-bound[0], 0)]
            while todo:
                high, at = heapq.heappop(todo)
                if least is not None and -high < least:
                    break
                if self.children[at]:
                    for child in self.children[at]:
                        heapq.heappush(todo, (-bound[child], child))
                    continue
                lo, hi = self.ranges[at]
                scores = self.vectors[lo:hi] @ q
                hits = np.arange(hi - lo) if least is None else np.flatnonzero(scores >= least)
                for s, i in zip(scores[hits].tolist(), self.ids[lo:hi][hits].tolist()):
                    if i == mine:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                if len(best) == k and (least is None or best[0][0] > least):
                    least = best[0][0]
            out.append([(s, -i) for s, i in sorted(best, reverse=True)])
        return out


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of lists as a matrix; shorter lists are filled with zeros."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _longest(*columns: pa.ChunkedArray) -> int:
    return max((n for c in columns for n in c.combine_chunks().value_lengths().to_pylist() if n), default=0)


def _answers(tree: BallTree, shard: int, rows: pa.Table, queries: np.ndarray, k: int, floors) -> pa.Table:
    own, number = rows["_id"].to_numpy(), rows["_row"].to_numpy()
    results = tree.search(queries, own, k, floors)
    flat = [(n, o, shard, i, s, len(r)) for n, o, r in zip(number.tolist(), own.tolist(), results) for s, i in r]
    columns = list(zip(*flat)) or [[]] * 6
    types = [pa.int64()] * 5 + [pa.int32()]
    names = ["_query", "_query_id", "_shard", "_found", "_score", "_known"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names)


def _at_home(k: int):
    def run(rows: pa.Table) -> pa.Table:
        width = _longest(rows["_vector"])
        vectors = _matrix(rows["_vector"], width)
        tree = BallTree(vectors, rows["_id"].to_numpy())
        asked = np.flatnonzero(rows["_asks"].to_numpy(zero_copy_only=False))
        return _answers(tree, rows["_shard"][0].as_py(), rows.take(asked), vectors[asked], k, [None] * len(asked))

    return run


def _elsewhere(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        width = _longest(rows["_vector"], queries["_vector"])
        tree = BallTree(_matrix(rows["_vector"], width), rows["_id"].to_numpy())
        shard = rows["_shard"][0].as_py() if len(rows) else -1
        return _answers(tree, shard, queries, _matrix(queries["_vector"], width), k, queries["_floor"].to_pylist())

    return run


def _numbers(n: int):
    return F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>")


def top_k(
    table: DataFrame, asks, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0,
    shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of the table for each row where ``asks`` holds.

    Components are floor(scale * x) as whole numbers and scores their integer inner products, which
    must fit 64 bits. A row is no candidate for queries of its own key. Ties go to smaller keys.
    Rows whose key or vector is null, or holds null or non-finite components, take no part; shorter
    vectors count as filled with zeros. A query row that repeats gives its result once for each
    repeat. An empty table gives no rows; other columns are not looked at.
    """
    usable = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    # The row number is that of a scan, the same when a lost task is repeated.
    rows = materialize(
        table.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & usable).select(
            F.col(key).cast("long").alias("_id"), F.coalesce(asks, F.lit(False)).alias("_asks"),
            F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("_vector"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    n, n_asked = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("_asks"), 1))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_asked // query_block))
    dealt = rows.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))
    home = materialize(dealt.groupBy("_shard").applyInArrow(_at_home(k), FOUND))
    floors = home.filter(F.col("_known") == k).groupBy("_query").agg(F.min("_score").alias("_floor"))
    asked = materialize(
        dealt.filter("_asks").join(floors, dealt["_row"] == floors["_query"], "left")
        .select("_row", "_id", "_vector", "_floor", F.col("_shard").alias("_home"),
                F.pmod(F.xxhash64("_row", F.lit(1)), F.lit(blocks)).alias("_block"))
    )
    asked = asked.withColumn("_shard", F.explode(_numbers(shards))).filter("_shard <> _home")
    spread = dealt.select("_shard", "_id", "_vector", F.explode(_numbers(blocks)).alias("_block"))
    others = spread.groupBy("_shard", "_block").cogroup(asked.groupBy("_shard", "_block")).applyInArrow(_elsewhere(k), FOUND)
    best = Window.partitionBy("_query").orderBy(F.col("_score").desc(), "_found")
    return (
        home.unionByName(others).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select(F.col("_query_id").alias("query_id"), "rank", F.col("_found").alias("vec_id"), F.col("_score").alias("score"))
    )
