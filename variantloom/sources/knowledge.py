"""Builders of knowledge tables from public sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.functions import rules


def summary_genes(rows: DataFrame) -> DataFrame:
    """Transcripts per gene of a MANE summary (gene_id, symbol, transcript, status), Select first."""
    item = F.struct((F.col("status") != "MANE Select").alias("late"), F.col("transcript"), F.col("status"))
    return rows.groupBy("gene_id", "symbol").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["transcript"]).alias("transcripts"))


def joined_genes(gtf: DataFrame, summary: DataFrame) -> DataFrame:
    """GTF genes with their transcripts; anything unmatched or on two contigs carries a verdict that must be absent."""
    met = gtf.join(summary.withColumnRenamed("symbol", "symbol_s"), "gene_id", "full_outer")
    return met.withColumn("verdict", F.when(F.col("transcripts").isNull(), "not_in_summary").when(F.col("g_start").isNull(), "not_in_gtf").when(F.col("gene_symbol") != F.col("symbol_s"), "symbol_differs").otherwise("ok"))


def select_ids(summary: DataFrame) -> DataFrame:
    """MANE Select transcript ids without their versions."""
    return summary.filter("status = 'MANE Select'").select(F.split_part("transcript", F.lit("."), F.lit(1)).alias("transcript_id")).distinct()


def gene_lookup(genes: DataFrame, wanted: DataFrame, on: str) -> DataFrame:
    """Wanted symbols or ids with their genes; `found` is false where there is none."""
    return wanted.join(genes, on, "left").withColumn("found", F.col("g_start").isNotNull())


def off_primary_counts(gtf: DataFrame) -> DataFrame:
    return gtf.groupBy(F.col("contig").isNotNull().alias("is_primary")).agg(F.count(F.lit(1)).alias("n"))


def release(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path and release of files, from a pattern over their first lines; several releases in one set are a conflict."""
    lines = spark.read.text(path).select(F.input_file_name().alias("path"), F.nullif(F.regexp_extract("value", pattern, 1), F.lit("")).alias("release")).filter("release IS NOT NULL")
    return lines.groupBy("path").agg(F.min("release").alias("release"), (F.countDistinct("release") > 1).alias("conflict"))


def manifest(spark: SparkSession, folder: str, version: str, retrieved: str) -> DataFrame:
    """path, version, sha256, size and date of every file of a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("path"), F.lit(version).alias("version"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"), F.lit(retrieved).alias("retrieved"))


def gene_corpus(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Gene annotations (gene, hpo_id) with a verdict: ok or unresolvable."""
    met = rows.join(terms.select(F.col("term").alias("t_")), rows.hpo_id == F.col("t_"), "left")
    return met.withColumn("verdict", F.when(F.col("t_").isNull(), "unresolvable").otherwise("ok")).drop("t_")


def gene_phenotypes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Best row per (gene, hpo_id), stated frequency first, then disease; excluded frequencies are counted apart."""
    f = rules.hpo_frequency(F.col("frequency"))
    judged = rows.withColumn("f_", f).withColumn("verdict", F.when(F.col("f_.error") == "excluded_frequency", "excluded_frequency").when(F.col("f_.error").isNotNull(), F.col("f_.error")).otherwise("ok"))
    order = F.struct(F.col("f_.kind").isNull().alias("late"), "disease_id")
    best = judged.filter("verdict = 'ok'").groupBy("gene", "hpo_id").agg(F.min_by(F.struct("disease_id", F.col("f_.lower").alias("lower"), F.col("f_.upper").alias("upper")), order).alias("b"))
    return best.select("gene", "hpo_id", "b.*"), judged.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def clingen_rows(spark: SparkSession, path: str) -> DataFrame:
    """Validity rows of a CSV with banner and +++ rule rows, with the file's date as version."""
    lines = spark.read.text(path)
    version = lines.select(F.nullif(F.regexp_extract("value", r"FILE CREATED: *([0-9-]+)", 1), F.lit("")).alias("version")).filter("version IS NOT NULL").limit(1)
    body = lines.filter(~F.col("value").rlike(r'^"?\+{3}') & ~F.col("value").rlike(r'^"?(CLINGEN|FILE CREATED|WEBPAGE|GENE SYMBOL)') & (F.col("value") != ""))
    parsed = body.select(F.from_csv("value", "gene string, gene_id string, disease string, disease_id string, moi string, sop string, classification string, report string, date string, panel string").alias("r")).select("r.*")
    return parsed.crossJoin(F.broadcast(version))


def ddg2p_rows(rows: DataFrame) -> DataFrame:
    """Optional second source; the disease id falls back from MONDO to OMIM."""
    return rows.select("gene", F.coalesce("mondo", F.concat(F.lit("OMIM:"), "mim")).alias("disease_id"), "classification")


def optional_rows(spark: SparkSession, path: str, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of a source that may be absent, and what became of it (path, state, reason, n): absent, garbled (a required column is missing or never
    filled) or read. Without usable rows the table is empty, and the reason says why, so that nobody takes it for a source that found nothing.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    empty = spark.createDataFrame([], schema)
    said = lambda state, reason, n: spark.createDataFrame([(path, state, reason, n)], "path string, state string, reason string, n long")
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return empty, said("absent", "no such file", 0)
    names = spark.read.option("header", True).csv(path).columns
    if gone := [c for c in required if c not in names]:
        return empty, said("garbled", f"lacks {', '.join(gone)}", 0)
    rows = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path).select(*[F.col(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema])
    full = rows.filter(" AND ".join(f"{c} IS NOT NULL" for c in required))
    n = full.count()
    return (full, said("read", "", n)) if n else (empty, said("garbled", "no row has all required values", 0))


def unmatched_symbols(left: DataFrame, right: DataFrame, x_linked: DataFrame) -> DataFrame:
    """Symbols of one source that another lacks, marked where X-linkage explains it."""
    gone = left.select("gene").distinct().join(right.select("gene").distinct(), "gene", "left_anti")
    return gone.join(x_linked.select("gene", F.lit(True).alias("x_")).distinct(), "gene", "left").select("gene", F.coalesce("x_", F.lit(False)).alias("explained"))


def gene_panel(constraint: DataFrame, validity: DataFrame) -> DataFrame:
    """One row per gene with constraint metrics, parsed flags and the best classification."""
    flags = F.from_json(F.coalesce("flags", F.lit("[]")), "array<string>")
    return constraint.withColumn("flags", flags).join(validity, "gene", "full_outer")


def chain(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node rows and link rows of a mechanism file, by which block of columns is filled."""
    nodes = rows.filter("node_id IS NOT NULL AND node_id <> ''").select("mechanism_id", "node_id", F.col("node_kind").alias("kind"), F.col("node_label").alias("label"), "state_in_patient")
    links = rows.filter("link_id IS NOT NULL AND link_id <> ''").select("mechanism_id", "link_id", "source_node_id", "target_node_id", "relation", "direction", "strength", truth(F.col("is_directly_demonstrated")).alias("demonstrated"))
    return nodes, links


def truth(token: Column) -> Column:
    """Boolean of a token; blank is NULL: not assessed."""
    low = F.lower(F.trim(token))
    return F.when(low.isin("true", "yes", "1", "y"), True).when(low.isin("false", "no", "0", "n"), False)


def catalogue(rows: DataFrame) -> DataFrame:
    """Typed drug catalogue."""
    return rows.withColumns({
        "is_direct": truth(F.col("is_direct_evidence")), "pediatric": truth(F.col("has_pediatric_exposure")), "cns_penetrant": truth(F.col("cns_penetrant")), "worsens_cin": truth(F.col("worsens_cin")),
        "achievable_um": F.col("achievable_plasma_um").try_cast("double"), "required_um": F.col("required_effective_um").try_cast("double"), "evidence_type": F.col("strongest_evidence_type"),
    })


def typed_consequences(rows: DataFrame) -> DataFrame:
    """Consequence rows with typed flags and a map of the scores that are present."""
    scores = F.map_filter(F.create_map(F.lit("cadd_phred"), F.col("cadd_phred").try_cast("double"), F.lit("revel"), F.col("revel").try_cast("double")), lambda k, v: v.isNotNull())
    impact = F.lower(F.trim("impact"))
    return rows.withColumns({"is_canonical": truth(F.col("is_canonical")), "is_mane_select": truth(F.col("is_mane_select")), "impact": F.when(impact.isin(rules.IMPACTS), impact), "splice_ai": F.col("splice_ai_delta_max").try_cast("double"), "scores": scores})


def typed_frequencies(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).try_cast(k) for c, k in (("allele_frequency", "double"), ("allele_count", "long"), ("allele_number", "long"), ("homozygote_count", "long"))})


def empty_clinical(spark: SparkSession) -> DataFrame:
    """A declared clinical source without rows, labelled synthetic."""
    return spark.createDataFrame([], "site_key long, significance string, stars int").withColumn("synthetic", F.lit(True))
