"""Exact top-k by inner product: a KD-tree for each shard of the vectors, best-first search.

A tree splits at the median of its widest side and keeps tight bounding boxes. A box bounds
the score of a query by sum(max(q * low, q * high)); nodes are opened best bound first until
the best bound is below the k-th score. Every query first searches one shard; the k-th score
it finds there is the bound with which it enters all other shards. Queries and trees meet
in units of a block of queries and one shard, both of bounded size.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from market_lens.sources.scratch import materialize

SHARD_ROWS = 8192
BLOCK_QUERIES = 1024
LEAF = 64


#: What a component or a score can be at most, either way: whatever lies beyond counts as that much.
LARGEST = (1 << 63) - 1025


def quantized(vector: Column, scale: int = 64) -> Column:
    """Components times ``scale``, rounded down to long integers, or the largest ones."""
    most = float(LARGEST)
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-most)), F.lit(most))))


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null, not a number or infinite."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & whole


def _matrix(rows: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of numbers; shorter rows are padded with zeros."""
    sizes = np.diff(rows.offsets.to_numpy()) if len(rows) else np.zeros(0, int)
    width = max(width, int(sizes.max(initial=0)))
    flat = rows.flatten().to_numpy()
    out = np.zeros((len(rows), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class Tree:
    def __init__(self, ids: np.ndarray, points: np.ndarray, lows=None, highs=None, nodes=None):
        self.ids, self.points, self.lows, self.highs, self.nodes = ids, points, lows, highs, nodes

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray) -> Tree:
        """``nodes`` are (start, end, left child, right child), -1 for leaves; the root is node 0."""
        order = np.arange(len(ids))
        lows, highs, nodes = [], [], []

        def add(start: int, end: int) -> int:
            here = points[order[start:end]]
            lows.append(low := here.min(axis=0))
            highs.append(high := here.max(axis=0))
            nodes.append([start, end, -1, -1])
            me = len(nodes) - 1
            widest = int((high - low).argmax()) if points.shape[1] else 0
            if end - start > LEAF and points.shape[1] and high[widest] > low[widest]:
                middle = (start + end) // 2
                part = np.argpartition(here[:, widest], middle - start)
                order[start:end] = order[start:end][part]
                nodes[me][2] = add(start, middle)
                nodes[me][3] = add(middle, end)
            return me

        add(0, len(ids))
        return cls(ids[order], points[order], np.array(lows), np.array(highs), np.array(nodes))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, points=self.points, lows=self.lows, highs=self.highs, nodes=self.nodes)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        return cls(**np.load(io.BytesIO(data)))

    def search(self, own: np.ndarray, queries: np.ndarray, floors: list[int | None], k: int):
        """``(row of the query, ids, scores)``: of each query the k best that reach its floor, ties to smaller ids."""
        width = max(self.points.shape[1], queries.shape[1])
        points, lows, highs = (_wider(x, width) for x in (self.points, self.lows, self.highs))
        queries = _wider(queries, width)
        largest = lambda x: float(np.abs(x.astype(np.float64)).max(initial=0))
        if largest(points) * largest(queries) * width < 2.0**53:  # then doubles are exact
            points, lows, highs, queries = (x.astype(np.float64) for x in (points, lows, highs, queries))
        else:
            points, lows, highs, queries = (x.astype(object) for x in (points, lows, highs, queries))
        bounds = _clamped(np.maximum(queries, 0) @ highs.T + np.minimum(queries, 0) @ lows.T)
        nodes = self.nodes.tolist()
        for row, query in enumerate(queries):
            bound = bounds[row].tolist()
            least = floors[row]
            best: list[tuple] = []  # a heap of (score, -id), the worst of the k best first
            todo = [(-bound[0], 0)]
            while todo:
                top, node = heapq.heappop(todo)
                if least is not None and -top < least:
                    break
                start, end, left, right = nodes[node]
                if left >= 0:
                    for child in (left, right):
                        if least is None or bound[child] >= least:
                            heapq.heappush(todo, (-bound[child], child))
                    continue
                scores = _clamped(points[start:end] @ query)
                able = self.ids[start:end] != own[row]
                if least is not None:
                    able &= (scores >= least).astype(bool)
                for i in np.flatnonzero(able).tolist():
                    found = (int(scores[i]), -int(self.ids[start + i]))
                    if len(best) < k:
                        heapq.heappush(best, found)
                    elif found > best[0]:
                        heapq.heapreplace(best, found)
                if len(best) == k and (least is None or best[0][0] > least):
                    least = best[0][0]
            yield row, [-i for _, i in best], [s for s, _ in best]


def _clamped(scores: np.ndarray) -> np.ndarray:
    """Scores of Python integers, cut to what a long holds; doubles are far below."""
    return np.minimum(np.maximum(scores, -LARGEST), LARGEST) if scores.dtype == object else scores


def _wider(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def _build(shard: pa.Table) -> pa.Table:
    ids = shard.column("id").combine_chunks().to_numpy(zero_copy_only=False)
    tree = Tree.build(ids, _matrix(shard.column("v").combine_chunks()))
    return pa.table({"shard": shard.column("shard").slice(0, 1).cast(pa.int32()), "tree": pa.array([tree.to_bytes()], pa.large_binary()).cast(pa.binary())})


def _searched(units: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """Hits of all units; ``units`` has a row for each query of each ``(shard, block)``."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, ids, scores = [], [], []
        if left.num_rows and right.num_rows:
            tree = Tree.from_bytes(left.column("tree")[0].as_py())
            own = right.column("query_id").combine_chunks().to_numpy(zero_copy_only=False)
            queries = _matrix(right.column("v").combine_chunks())
            for row, found, got in tree.search(own, queries, right.column("least").to_pylist(), k):
                rows += [row] * len(found)
                ids += found
                scores += got
        taken = pa.array(rows, pa.int64())
        return pa.table(
            {
                "query_id": right.column("query_id").take(taken),
                "key": right.column("key").take(taken),
                "vec_id": pa.array(ids, pa.int64()),
                "score": pa.array(scores, pa.int64()),
            }
        )

    pairs = units.select("shard", "block").distinct()
    sent = pairs.join(trees, "shard").toDF("to_shard", "to_block", "tree")
    met = sent.groupBy("to_shard", "to_block").cogroup(units.groupBy("shard", "block"))
    return met.applyInArrow(search, "query_id long, key long, vec_id long, score long")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row of ``queries`` the ``k`` best rows of ``vectors``.

    Both tables hold vectors of long integers. Rows without an id or a vector take no part; a row isn't its own
    query's candidate, nor is any row with the same id. Ties go to the smaller id; rows that
    repeat are candidates each, queries that repeat (same id and vector) are one query.
    Shorter vectors count as padded with zeros. Scores are exact up to ``LARGEST`` either way; beyond it they count as
    equal. Fewer candidates than ``k`` give fewer rows.
    """
    known = vectors.select(F.col(id).alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null")
    asked = queries.select(F.col(id).alias("query_id"), F.col(vector).alias("v")).where("query_id is not null and v is not null")
    asked = asked.withColumn("key", F.xxhash64("query_id", "v")).dropDuplicates(["query_id", "key"])
    n, m = known.count(), asked.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // block_queries))
    trees = known.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    trees = materialize(trees.groupBy("shard").applyInArrow(_build, "shard int, tree binary"), "trees")
    asked = asked.withColumn("block", F.pmod("key", F.lit(blocks)).cast("int"))

    home = F.pmod("block", F.lit(shards)).cast("int")
    first = asked.select(home.alias("shard"), "block", "query_id", "key", "v", F.lit(None).cast("long").alias("least"))
    hits = materialize(_searched(first, trees, k), "hits")
    reached = hits.groupBy("query_id", "key").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
    asked = asked.join(reached.select("query_id", "key", "least"), ["query_id", "key"], "left")
    others = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "block", "query_id", "key", "v", "least")
    more = _searched(others.where(F.col("shard") != home), trees, k)

    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = hits.union(more).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
