"""Table-level helpers: lineage cuts, upserts, hashes, islands, accounting."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_home(spark: SparkSession) -> str:
    """The folder for intermediate tables: spark.checkpoint.dir, or what setCheckpointDir named.

    Where neither is set, a session on one machine gets a folder of its own; on a cluster that is an error, since executors
    would not see it.
    """
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-tables-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_path(spark: SparkSession, kind: str = "table") -> str:
    return f"{shared_home(spark)}/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df, written to the session's shared folder and read back."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(*tables: DataFrame) -> None:
    """Delete tables that `cut` made and nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        home = spark._jvm.org.apache.hadoop.fs.Path(shared_home(spark)).toUri().getPath()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if path.getName().startswith("table-") and path.getParent().toUri().getPath() == home:
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_file(df: DataFrame) -> str:
    """The path of a text file with the rows of the column `value`, in the order of `at` if there is one; for sources that read paths."""
    path = new_path(df.sparkSession, "text")
    rows = df.repartitionByRange("at").sortWithinPartitions("at") if "at" in df.columns else df
    rows.select("value").write.text(path)
    return path


def upserted(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row per key: the last of the new batch, else the old one. Running it again changes nothing."""
    both = old.withColumn("batch_", F.lit(0)).unionByName(new.withColumn("batch_", F.lit(1)))
    w = Window.partitionBy(*key).orderBy(F.desc("batch_"), F.desc(order))
    return both.withColumn("rn_", F.row_number().over(w)).filter("rn_ = 1").drop("rn_", "batch_")


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """A hash of a row's values and of where its NULLs are; maps count as their sorted entries."""
    plain = lambda c: F.array_sort(F.map_entries(c)) if df.schema[c].dataType.typeName() == "map" else F.col(c)
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), plain(c).cast("string"))])


def table_hash(df: DataFrame) -> DataFrame:
    """Rows and an order-insensitive digest of a table. A hash passes over NULLs, so each value has a flag beside it."""
    h = row_hash(df, sorted(df.columns)).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("digest"))


def bucket_digests(df: DataFrame, key: list[str], buckets: int = 4_096) -> DataFrame:
    """bucket, n, digest: rows and an order-insensitive digest of each bucket of keys."""
    h = row_hash(df, sorted(df.columns)).cast("decimal(38,0)")
    return df.groupBy(F.pmod(row_hash(df, key), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("digest"))


def unequal_buckets(one: DataFrame, two: DataFrame, key: list[str], buckets: int = 4_096) -> DataFrame:
    """The buckets in which two tables differ; what each task sends is a row for each bucket."""
    a, b = (bucket_digests(df, key, buckets).withColumnsRenamed({"n": f"n_{s}", "digest": f"d_{s}"}) for df, s in ((one, "a"), (two, "b")))
    return a.join(b, "bucket", "full_outer").filter(~(F.col("n_a").eqNullSafe(F.col("n_b")) & F.col("d_a").eqNullSafe(F.col("d_b")))).select("bucket")


def differences(one: DataFrame, two: DataFrame, key: list[str], buckets: int = 4_096) -> DataFrame:
    """Keys that only one of two runs has or whose rows differ, with what differs: the columns, or the number of equal keys.

    Digests settle equal buckets; only rows of unequal ones are compared, so two runs of a deterministic query cost one pass each.
    """
    values = sorted(set(one.columns) - set(key))
    bad = F.broadcast(unequal_buckets(one, two, key, buckets))  # `buckets` rows at most

    def side(df: DataFrame, name: str) -> DataFrame:
        inside = df.withColumn("bucket", F.pmod(row_hash(df, key), F.lit(buckets))).join(bad, "bucket", "left_semi")
        each = [F.array_sort(F.collect_list(row_hash(df, [c]))).alias(f"{name}_{c}") for c in values]
        return inside.groupBy(*[F.col(k).alias(f"{name}_key_{k}") for k in key]).agg(F.count(F.lit(1)).alias(f"{name}_n"), *each)

    a, b = side(one, "a"), side(two, "b")
    on = [F.col(f"a_key_{k}").eqNullSafe(F.col(f"b_key_{k}")) for k in key]
    met = a.join(b, on, "full_outer").withColumns({k: F.coalesce(f"a_key_{k}", f"b_key_{k}") for k in key})
    state = F.when(F.col("b_n").isNull(), "only_first").when(F.col("a_n").isNull(), "only_second").otherwise("changed")
    changed = F.array_compact(F.array(F.when(F.col("a_n") != F.col("b_n"), "number of rows"), *[F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), c) for c in values]))
    out = met.withColumn("state", state).withColumn("columns", F.when(F.col("state") == "changed", changed).otherwise(F.array().cast("array<string>")))
    return out.filter((F.col("state") != "changed") | (F.size("columns") > 0)).select(*key, "state", "columns")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        out = one if out is None else out.union(one)
    return out


def content_id(category: Column, *parts: Column) -> Column:
    """Evidence id from content: the same content always has the same id."""
    text = F.concat_ws("\x1f", category, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit("EV-"), F.upper(F.substring(category, 1, 4)), F.lit("-"), F.substring(F.sha2(text, 256), 1, 16))


def islands(df: DataFrame, by: list[str], start: str, end: str, window: int, bin_size: int = 1 << 22) -> DataFrame:
    """Spans closer than `window` merged: (by, island number, start, end, n_spans).

    Spans are first merged inside bins of the axis, so that a group is as many tasks as it has bins; only the merged
    spans, a few for each bin, are then ordered by group to be joined across bin borders.
    """

    def one_pass(rows: DataFrame, keys: list[str]) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy("s_", "e_")
        before = F.max("e_").over(order.rowsBetween(Window.unboundedPreceding, -1))
        marked = rows.withColumn("new_", F.when(before.isNull() | (F.col("s_") - before > window), 1).otherwise(0))
        numbered = marked.withColumn("island", F.sum("new_").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        return numbered.groupBy(*keys, "island").agg(F.min("s_").alias("s_"), F.max("e_").alias("e_"), F.sum("k_").alias("k_"))

    rows = df.select(*by, F.col(start).alias("s_"), F.col(end).alias("e_"), F.lit(1).cast("long").alias("k_"), F.floor(F.col(start) / bin_size).alias("bin_"))
    inside = one_pass(rows, [*by, "bin_"]).drop("bin_", "island")
    return one_pass(inside, by).select(*by, "island", F.col("s_").alias("start"), F.col("e_").alias("end"), F.col("k_").alias("n_spans"))


def first_seen(df: DataFrame, by: list[str], id_: str, seq: str) -> DataFrame:
    """by, ids: distinct ids of each group in the order in which they were first seen; equal places go by the id."""
    once = df.groupBy(*by, id_).agg(F.min(seq).alias("at_"))
    return once.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("at_", id_))), lambda x: x[id_]).alias("ids"))


def gap_batches(df: DataFrame, by: list[str], order: list[str], position: str, gap: int) -> DataFrame:
    """Adds `batch`: a new one where the distance to the row before exceeds the gap."""
    w = Window.partitionBy(*by).orderBy(*order)
    jump = F.when(F.col(position) - F.lag(position).over(w) > gap, 1).otherwise(0)
    return df.withColumn("jump_", jump).withColumn("batch", F.sum("jump_").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("jump_")


def unsorted_rows(df: DataFrame, by: list[str], seq: str, key: list[str]) -> DataFrame:
    """Rows whose key goes backwards against the row before (a sorted file has none)."""
    w = Window.partitionBy(*by).orderBy(seq)
    own = F.struct(*key)
    return df.withColumn("last_", F.lag(own).over(w)).filter(F.col("last_").isNotNull() & (own < F.col("last_"))).drop("last_")


def accounted(whole: DataFrame, kept: DataFrame, gone: DataFrame) -> DataFrame:
    """One row: all, kept, discarded, and whether they balance."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return n(whole, "n_all").crossJoin(n(kept, "n_kept")).crossJoin(n(gone, "n_gone")).withColumn("balanced", F.col("n_all") == F.col("n_kept") + F.col("n_gone"))


def discard_counts(ledger: DataFrame) -> DataFrame:
    """Counts by stage and by stage and rule (rule NULL: the stage's total)."""
    return ledger.rollup("stage", "rule").agg(F.count(F.lit(1)).alias("n")).filter("stage IS NOT NULL")


def invalid(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that break a named check, with the names of those broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    return df.withColumn("broken", broken).filter(F.size("broken") > 0)
