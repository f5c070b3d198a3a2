"""Exact top-k inner products with KD-trees per shard.

Vectors are dealt into shards of bounded size. In each shard a KD-tree is built by median splits on the widest
component, with tight bounding boxes. A query walks the tree best-first by the upper bound of its inner product
over a box, sum(max(q_i*lo_i, q_i*hi_i)), and stops when the best open bound cannot beat its k-th score. The k-th
scores found in a first shard are propagated to all other shards as starting bounds. Partial top-k lists are merged
by one window. Queries meet shards in blocks of bounded size, so no task holds all queries or all vectors.

Edge cases: null vectors and vectors with null or non-finite components take no part; rows equal in id and vector
count once; only vectors of the query's own length are scored; ties go to the smaller vec_id; a query id that has
several vectors is several queries merged into one list; an empty table gives no rows; other columns are ignored.
Scores are exact while they stay inside 63 bits.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and `v`: floor(scale * component) as longs; unusable vectors dropped, equal rows merged."""
    usable = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf"))
    )
    return (
        vectors.filter(usable & F.col("vec_id").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v"))
        .dropDuplicates(["vec_id", "v"])
        .withColumn("dim", F.size("v"))
    )


def grown(points: np.ndarray, leaf: int) -> tuple[np.ndarray, list[tuple[int, int, int, int]], np.ndarray, np.ndarray]:
    """Order of the points, nodes (start, end, left child, right child) and the nodes' boxes."""
    order, nodes, lo, hi = np.arange(len(points)), [], [], []
    todo = [(0, len(points), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        own = points[order[start:end]]
        low, high = own.min(axis=0), own.max(axis=0)
        me = len(nodes)
        nodes.append([start, end, -1, -1])
        lo.append(low)
        hi.append(high)
        if parent >= 0:
            nodes[parent][2 + side] = me
        if end - start > leaf and own.shape[1] and (high > low).any():
            half = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(own[:, np.argmax(high - low)], half)]
            todo += [(start, start + half, me, 0), (start + half, end, me, 1)]
    return order, [tuple(x) for x in nodes], np.array(lo), np.array(hi)


def best_of(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, k: int, leaf: int) -> list[tuple[int, int, int]]:
    """(query id, vec id, score) of each query's k best, at floors or above; exact in doubles or in 64-bit integers."""
    far = float(np.abs(points).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, points.shape[1])
    kind = np.float64 if far < 2**53 else np.int64
    points, queries = points.astype(kind), queries.astype(kind)
    order, nodes, lo, hi = grown(points, leaf)
    points, ids = points[order], ids[order]
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = up @ hi.T + down @ lo.T  # of every box, for every query
    out = []
    for q in range(len(queries)):
        bound, own, vector, floor = bounds[q], query_ids[q], queries[q], floors[q]
        best: list[tuple[int, int]] = []  # (score, -id), the worst first
        boxes = [(-bound[0], 0)]
        while boxes:
            most, at = heapq.heappop(boxes)
            if -most < floor or len(best) == k and -most < best[0][0]:
                break
            start, end, left, right = nodes[at]
            if left >= 0:
                heapq.heappush(boxes, (-bound[left], left))
                heapq.heappush(boxes, (-bound[right], right))
                continue
            scores = points[start:end] @ vector
            least = max(floor, best[0][0]) if len(best) == k else floor
            hits = np.flatnonzero(scores >= least)
            if len(hits) > k:
                hits = hits[np.lexsort((ids[start:end][hits], -scores[hits]))[: k + 1]]
            for i in hits:
                if (x := int(ids[start + i])) != own:
                    item = (int(scores[i]), -x)
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
        out += [(int(own), -x, s) for s, x in best]
    return out


def matched(vectors: pa.Table, queries: pa.Table, k: int, leaf: int) -> pa.Table:
    """One shard against one block of queries."""
    found: list = []
    if vectors.num_rows and queries.num_rows:
        dim = vectors.column("dim")[0].as_py()
        flat = lambda t, c: np.asarray(pc.list_flatten(t.column(c)), dtype=np.int64).reshape(t.num_rows, dim)
        ids, query_ids = np.asarray(vectors.column("vec_id"), dtype=np.int64), np.asarray(queries.column("q_id"), dtype=np.int64)
        found = best_of(flat(vectors, "v"), ids, flat(queries, "q_v"), query_ids, np.asarray(queries.column("least"), dtype=np.float64), k, leaf)
    a = np.array(found, dtype=np.int64).reshape(-1, 3)
    return pa.table({"query_id": a[:, 0], "vec_id": a[:, 1], "score": a[:, 2]})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = 8_192, block_rows: int = 4_096, leaf: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of every query; both sides as from quantised()."""
    shards, blocks = -(-max(1, vectors.count()) // shard_rows), -(-max(1, queries.count()) // block_rows)
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.select(F.col("vec_id").alias("q_id"), F.col("v").alias("q_v"), F.col("dim").alias("q_dim"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("q_block"))

    def met(some: DataFrame, by: DataFrame) -> DataFrame:
        run = partial(matched, k=k, leaf=leaf)
        return some.groupBy("dim", "shard", "block").cogroup(by.groupBy("q_dim", "q_shard", "q_block")).applyInArrow(lambda a, b: run(a, b), "query_id long, vec_id long, score long")

    open_ = F.lit(float("-inf"))
    first = met(dealt.filter("shard = 0"), asked.withColumn("q_shard", F.lit(0)).withColumn("least", open_))
    if shards > 1:
        first = written(first)
        # the k-th score of the first shard, where it has k rows, is a lower bound for the whole table
        ranked = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
        known = asked.groupBy(F.col("q_id").alias("query_id")).agg(F.count(F.lit(1)).alias("asked"))
        least = ranked.join(known, "query_id").filter("asked = 1").select(F.col("query_id").alias("q_id"), F.when(F.col("n") >= k, F.col("kth").cast("double")).alias("kth"))
        rest = asked.join(least, "q_id", "left").withColumn("least", F.coalesce("kth", open_)).drop("kth")
        rest = rest.withColumn("q_shard", F.explode(F.sequence(F.lit(1), F.lit(shards - 1))))
        first = first.unionByName(met(dealt.filter("shard > 0"), rest))
    pairs = first.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_of_table(embeddings: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The rows whose vec_id is divisible by `every` against all rows but their own."""
    vectors = quantised(embeddings)
    return top_k(vectors, vectors.filter(F.col("vec_id") % every == 0), k)
