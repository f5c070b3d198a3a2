"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.operators.tables import cut as written
from variantloom.operators.tables import discarded, shared_home

__all__ = ["KEYS", "bit_words", "checkpointed", "discarded", "given_back", "in_bits", "id_crc", "mixed", "one_of_each", "picked", "table", "text_blocks", "text_keys", "text_or_empty", "texts_of", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write df to the session's checkpoint folder and read it back, so that lost executors cost nothing."""
    context = df.sparkSession.sparkContext
    home = shared_home(df.sparkSession)
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(home)
    return df.checkpoint()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of the id written as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")))


def given_back() -> None:
    """Give memory that nothing holds any more back to the system: Python workers live on between stages and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):  # glibc only
        libc.malloc_trim(0)


def text_blocks(batches: Iterator[pa.RecordBatch], most: int = 2_000_000, texts: Callable[[pa.RecordBatch], pa.Array] = lambda b: b.column("text")) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each has at most `most` text bytes, or one row; rows and order stay."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts(batch)), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to
    given_back()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: Two hashes of a text, null as empty: 128 bits that tell texts apart.
KEYS = ("key_a", "key_b")


def text_keys() -> list[Column]:
    return [F.xxhash64(text_or_empty()).alias("key_a"), F.xxhash64(F.lit(1), text_or_empty()).alias("key_b")]


def bit_words(keys: DataFrame, bits: int) -> np.ndarray:
    """A table of `bits` bits (a power of two), as 64-bit words, set at the low bits of one column of longs.

    Its size never changes with the data: it lets every key through and others by chance.
    """
    place = F.col(keys.columns[0]).bitwiseAND(F.lit(bits - 1))
    words = keys.select((place / 64).cast("long").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit"))
    packed = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[np.asarray(packed.column("word"))] = np.asarray(packed.column("bit"))
    return out.view(np.uint64)


def in_bits(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (signed longs) a table of bit_words lets through."""
    place = keys.view(np.uint64) & np.uint64(len(words) * 64 - 1)
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def picked(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), pick_a, pick_b: 128 bits that show a row by its id and text, null or not."""
    # a null adds nothing to a hash, so a null text counts as empty and a null id is told apart by a flag
    none = F.col("doc_id").isNull()
    return docs.select(F.struct("*").alias("row"), F.xxhash64(none, "doc_id", text_or_empty()).alias("pick_a"), F.xxhash64(F.lit(1), text_or_empty(), none, "doc_id").alias("pick_b"))


def one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One row of docs for each component of classes (doc_id, pick_a, pick_b, component): the smallest id, null last."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pick_a", "pick_b")
    first = classes.groupBy("component").agg(F.min(order).alias("first")).select("first.pick_a", "first.pick_b")
    return picked(docs).join(first, ["pick_a", "pick_b"], "left_semi").dropDuplicates(["pick_a", "pick_b"]).select("row.*")
