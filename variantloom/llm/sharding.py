"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Law `rows`: the N rows get global numbers 0..N-1, a keyed permutation p of 0..N-1 is applied, and row r goes to
shard p(r) mod S, slot p(r) div S. Shard counts differ by one at most and slots have no gap. All work is in
DataFrame functions.

Row numbers come from a fixed number of hash buckets: a window numbers rows inside each bucket, and the running
sum of the bucket counts (one small row per bucket) gives the bucket's offset. No single-partition sort sees the rows.

The permutation acts on Z_a x Z_b with a*b just over N (a alternating Feistel network that adds a keyed hash of one
half to the other), so fewer than a of a*b values lie beyond N and a walk from a value below N returns within few
steps. Walks are bounded by what is provably enough or leaves a chance below N * b**-24; a walk that still were out
of range would raise an error, never give a wrong slot.

Edge cases: null text has size 16 and the CRC of no bytes; null ids are rows like any other; rows that are equal in
id, size and CRC share one run of numbers, in any order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_or_empty

ROUNDS = 6


def halves(n: int) -> tuple[int, int]:
    """The sides a, b of the smallest near-square domain that holds n values."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def permuted_once(x: Column, n: int, seed: int) -> Column:
    """One pass of the network over Z_a x Z_b; a bijection on 0..a*b-1."""
    a, b = halves(n)
    left, right = F.floor(x / F.lit(b)).cast("long"), x % F.lit(b)
    for k in range(ROUNDS):
        if k % 2 == 0:
            left = (left + F.pmod(F.xxhash64(F.lit(seed), F.lit(k), right), F.lit(a))) % F.lit(a)
        else:
            right = (right + F.pmod(F.xxhash64(F.lit(seed), F.lit(k), left), F.lit(b))) % F.lit(b)
    return left * F.lit(b) + right


def permuted(df: DataFrame, number: str, n: int, seed: int, out: str) -> DataFrame:
    """df with `out`: the place of row number `number` under the keyed permutation of 0..n-1."""
    a, b = halves(n)
    steps = min(a * b - n + 1, 25 if b > 24 else a * b)
    df = df.withColumn(out, permuted_once(F.col(number), n, seed))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(max(1, steps))),
        F.col(out),
        lambda x, _: F.when(x < n, x).otherwise(permuted_once(x, n, seed)),
    )
    df = df.withColumn(out, F.when(F.col(out) < n, F.col(out)).otherwise(walked))
    return df.withColumn(out, F.when(F.col(out) < n, F.col(out)).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long")))


def numbered(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """One row per row of `rows`, reduced to `keys`, with a global `row_number` from 0. Equal rows are counted
    before the shuffle and spread again after it, so a run of copies never meets in one task as rows."""
    runs = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    runs = runs.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    inside = Window.partitionBy("bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = runs.withColumn("before", F.sum("copies").over(inside) - F.col("copies"))
    sizes = runs.groupBy("bucket").agg(F.sum("copies").alias("held"))
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sizes.select("bucket", (F.sum("held").over(upto) - F.col("held")).alias("start"))  # one row per bucket
    return (
        placed.join(F.broadcast(starts), "bucket")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .select(*keys, (F.col("start") + F.col("before") + F.col("copy")).alias("row_number"))
    )


def shard_rows(docs: DataFrame, shards: int = 40, seed: int = 20240607, rows_per_bucket: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number for every row of docs."""
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    n = docs.count()
    buckets = min(16_384, max(1_024, -(-n // rows_per_bucket)))
    placed = permuted(numbered(rows, ["doc_id", "size", "text_crc32"], buckets), "row_number", max(1, n), seed, "place")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
