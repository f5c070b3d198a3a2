"""Incremental ingest: arriving VCF text through quality and validity rules into tables, with running counters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from variantloom.config import DEFAULT, Config
from variantloom.functions import alleles, rules
from variantloom.operators import annotate
from variantloom.operators.tables import new_path
from variantloom.sources import vcf


def judged(calls: DataFrame, build: str = "GRCh38", config: Config = DEFAULT) -> DataFrame:
    """Adds flags and the hard-filter verdict; stateless, so the same code serves batches and streams."""
    balance = alleles.allele_balance(F.col("ref_reads"), F.col("alt_reads"))
    fraction = alleles.allele_fraction(F.col("depth"), F.col("ref_reads"), F.col("alt_reads"), F.col("was_split"))
    reason = F.coalesce(F.col("unusable"), rules.hard_reason(F.lit(build), build, F.col("contig").isNotNull(), F.col("alt"), F.col("zygosity")))
    df = calls.withColumn("qc_flags", rules.qc_flags(F.col("zygosity"), fraction, balance, F.col("depth"), F.col("gq"), F.col("filter_status"), config))
    df = df.withColumn("verdict", F.coalesce(reason, F.lit("kept")))
    return df.withColumn("variant_id", alleles.variant_id(F.lit(build), F.col("contig"), F.col("position"), F.col("ref"), F.col("alt")))


def stream_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Calls of all VCF text files that arrive in a folder."""
    text = spark.readStream.text(folder).select("value", F.input_file_name().alias("path"))
    return judged(vcf.called(vcf.records(text)))


def ingest(spark: SparkSession, folder: str, sink: Callable[[DataFrame, DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Runs until all present files are read; each micro-batch hands kept rows and discards to the sink.

    A sample is a column of one file, and a file is read in one micro-batch, so calls are made distinct by (path, sample_no)
    without any state between batches.
    """

    def each(batch: DataFrame, _: int) -> None:
        gone = batch.filter("verdict <> 'kept'").select("variant_id", F.lit("ingest").alias("stage"), F.col("verdict").alias("rule"), F.col("alt").alias("value"))
        sink(batch.filter("verdict = 'kept'").dropDuplicates(["path", "sample_no", "variant_id"]), gone)

    return stream_calls(spark, folder).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arriving_calls(spark: SparkSession, folder: str, per_batch: int | None = None, late: str = "1 hour") -> DataFrame:
    """Judged calls of the text files that arrive in folder/sample=<id>/, each (sample_id, variant_id) once.

    A call that was delivered before is dropped by state that outlives the batch, for `late` after its arrival; arrival times are the
    batch's own, so no file is late however old it is. `per_batch` bounds the files of a batch.
    """
    reader = spark.readStream if per_batch is None else spark.readStream.option("maxFilesPerTrigger", per_batch)
    text = reader.text(folder).select("value", F.input_file_name().alias("path"), F.current_timestamp().alias("arrived"))
    origin = F.struct(F.regexp_extract("path", r"/sample=([^/]+)/", 1).alias("sample_id"), "path", "arrived")
    calls = judged(vcf.called(vcf.records(text.select("value", origin.alias("path")))))
    calls = calls.withColumns({"sample_id": F.col("path.sample_id"), "arrived": F.col("path.arrived"), "path": F.col("path.path")})
    return calls.withWatermark("arrived", late).dropDuplicatesWithinWatermark(["sample_id", "variant_id"])


# State on the executors' disks, of which memory holds a bounded part, instead of all of it on their heaps.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true", "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def started(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    """Start a stream with its state on disk. It copies the session's settings when it starts, so these are put back at once; what was set by hand stays."""
    added = {k: v for k, v in STATE.items() if spark.conf.get(k, None) is None}
    try:
        for k, v in added.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k in added:
            spark.conf.unset(k)


class BatchTable:
    """A folder with a sub-folder for each batch. A batch that runs again replaces what it wrote, so replays change nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def put(self, rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def ingest_triaged(spark: SparkSession, folder: str, site: Column, consequences: DataFrame, clinical: DataFrame, out: str, per_batch: int | None = None) -> tuple[BatchTable, BatchTable]:
    """Reads all present files of a folder: calls that pass rules and triage, and the ledger of the others, as tables under `out`.

    Triage joins the stream with static tables by `site`, a key made of the call; frequencies are left to survivors. A run that is started again under
    the same `out` goes on where the last one ended.
    """
    kept, gone = BatchTable(spark, f"{out}/kept"), BatchTable(spark, f"{out}/gone")
    calls = annotate.triaged(arriving_calls(spark, folder, per_batch).withColumn("site_key", site), consequences, clinical)

    def each(batch: DataFrame, number: int) -> None:
        verdict = F.when(F.col("verdict") != "kept", F.struct(F.lit("ingest").alias("stage"), F.col("verdict").alias("rule")))
        rows = batch.withColumn("gone_", verdict.when(F.col("triage").startswith("dropped"), F.struct(F.lit("triage").alias("stage"), F.col("triage").alias("rule")))).persist()
        kept.put(rows.filter("gone_ IS NULL").drop("gone_"), number)
        gone.put(rows.filter("gone_ IS NOT NULL").select("sample_id", "variant_id", "gone_.stage", "gone_.rule", F.col("alt").alias("value")), number)
        rows.unpersist()

    started(spark, calls.writeStream.foreachBatch(each).option("checkpointLocation", f"{out}/log").trigger(availableNow=True)).awaitTermination()
    return kept, gone


def running_counts(calls: DataFrame) -> DataFrame:
    """Counts by verdict, kept up to date while files arrive."""
    return calls.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def drained(spark: SparkSession, schema: StructType, folder: str, pattern: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The state of a streaming aggregate once all present files are read, as a table in the checkpoint folder."""
    path = new_path(spark, "stream")
    stream = transform(spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder))

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/state")

    stream.writeStream.outputMode("complete").foreachBatch(each).option("checkpointLocation", f"{path}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/state")
