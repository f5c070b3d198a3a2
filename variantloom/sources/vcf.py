"""VCF text as tables: headers, records, genotypes, INFO fields, sites tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.functions import alleles, rules

FIXED = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info"]


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value, path: every line. Compressed files are one partition each, so they are spread before any work."""
    rows = spark.read.text(path).select("value", F.input_file_name().alias("path"))
    return rows.repartition(spark.sparkContext.defaultParallelism * 4) if path.endswith((".gz", ".bz2")) else rows


def header_facts(text: DataFrame) -> DataFrame:
    """Per file: declared build, whether a column header was seen, sample names, ancestry groups, filter ids."""
    head = text.filter(F.col("value").startswith("#"))
    columns = F.when(F.col("value").startswith("#CHROM"), F.slice(F.split("value", "\t"), 10, 1_000_000))
    declared = F.when(F.col("value").rlike(r"(?i)^##(reference|assembly|contig).*(grch38|hg38)"), "GRCh38").when(F.col("value").rlike(r"(?i)^##(reference|assembly|contig).*(grch37|hg19|b37)"), "GRCh37")
    found = lambda p: F.array_sort(F.collect_set(F.nullif(F.regexp_extract("value", p, 1), F.lit(""))))
    return head.groupBy("path").agg(
        F.max(declared).alias("build"),
        F.bool_or(F.col("value").startswith("#CHROM")).alias("has_columns"),
        F.first(columns, ignorenulls=True).alias("samples"),
        found(r"^##INFO=<ID=AF_([A-Za-z]+),").alias("groups"),
        found(r"^##FILTER=<ID=([^,>]+)").alias("filters"),
    )


def records(text: DataFrame) -> DataFrame:
    """Body lines as columns, with format, sample texts and a verdict (ok or malformed_record)."""
    body = text.filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    parts = F.split("value", "\t")
    rows = body.withColumn("f_", parts).select("path", "value", "f_")
    cols = [F.get("f_", F.lit(k)).alias(c) for k, c in enumerate(FIXED)]
    out = rows.select("path", *cols, F.get("f_", F.lit(8)).alias("format"), F.slice("f_", 10, 1_000_000).alias("samples"), F.size("f_").alias("n_"))
    pos = F.col("pos").try_cast("long")
    return out.withColumn("position", pos).withColumn("verdict", F.when((F.col("n_") < 8) | pos.isNull() | (pos <= 0), "malformed_record").otherwise("ok")).drop("n_", "pos")


def called(rows: DataFrame) -> DataFrame:
    """One row per record, sample and ALT allele, with the genotype fields of that sample as a map."""
    alts = F.split("alt", ",")
    one = rows.filter("verdict = 'ok'").withColumn("n_alts", F.size(alts)).select("*", F.posexplode(alts).alias("alt_index", "allele")).withColumn("alt_index", F.col("alt_index") + 1)
    one = one.select("*", F.posexplode_outer("samples").alias("sample_no", "sample"))
    keys, values = F.split("format", ":"), F.split("sample", ":")
    n = F.least(F.size(keys), F.size(values))
    fields = F.when(F.col("sample").isNotNull() & F.col("format").isNotNull(), F.map_from_arrays(F.slice(keys, F.lit(1), n), F.slice(values, F.lit(1), n)))
    gt = F.element_at("g_", F.lit("GT"))
    depths = alleles.allele_depths(F.element_at("g_", F.lit("AD")), F.element_at("g_", F.lit("DP")), F.col("alt_index"), F.col("n_alts") + 1)
    return one.withColumn("g_", fields).select(
        "path", "sample_no", alleles.contig(F.col("chrom")).alias("contig"), "position", F.upper("ref").alias("ref"), F.upper("allele").alias("alt"), "alt_index", (F.col("n_alts") > 1).alias("was_split"),
        alleles.filter_status(F.col("filter")).alias("filter_status"), alleles.rounded_quality(F.col("qual").try_cast("double")).alias("quality"), gt.alias("genotype"), gt.contains("|").alias("phased"),
        alleles.zygosity(gt, F.col("alt_index").cast("string")).alias("zygosity"), F.element_at("g_", F.lit("PS")).try_cast("long").alias("phase_set"), F.element_at("g_", F.lit("GQ")).try_cast("int").alias("gq"),
        depths["depth"].alias("depth"), depths["ref_reads"].alias("ref_reads"), depths["alt_reads"].alias("alt_reads"), alleles.unusable_allele(F.col("ref"), F.col("allele")).alias("unusable"), "info",
    )


def info_map(info: Column) -> Column:
    """INFO as a map; the last of repeated keys stays, flags have NULL values."""
    parts = F.transform(F.split(info, ";"), lambda x: F.struct(F.split_part(x, F.lit("="), F.lit(1)).alias("key"), F.when(F.instr(x, "=") > 0, F.substring(x, F.instr(x, "=") + 1, F.length(x))).alias("value")))
    last = F.filter(parts, lambda x, i: (x["key"] != "") & ~F.exists(F.slice(parts, i + 2, F.size(parts)), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)


def site_frequencies(rows: DataFrame, groups: list[str], source: str = "sites", version: str = "") -> DataFrame:
    """One row per ALT and population with AF, AC, AN, nhomalt; rows without AF or with AN 0 are left out, not zero."""
    base = rows.filter("verdict = 'ok'").withColumn("m_", info_map(F.col("info"))).select("*", F.posexplode(F.split("alt", ",")).alias("k_", "allele"))
    populations = F.array(*[F.lit(g) for g in ["", *groups]])
    long = base.withColumn("g_", F.explode(populations)).withColumn("s_", F.when(F.col("g_") == "", "").otherwise(F.concat(F.lit("_"), F.col("g_"))))
    per_alt = lambda name: F.get(F.split(F.element_at("m_", F.concat(F.lit(name), F.col("s_"))), ","), F.col("k_"))
    out = long.select(
        alleles.contig(F.col("chrom")).alias("contig"), "position", "ref", F.col("allele").alias("alt"), F.lit(source).alias("source"), F.lit(version).alias("version"),
        F.when(F.col("g_") == "", "all").otherwise(F.col("g_")).alias("population"), per_alt("AF").try_cast("double").alias("af"), per_alt("AC").try_cast("long").alias("ac"),
        F.element_at("m_", F.concat(F.lit("AN"), F.col("s_"))).try_cast("long").alias("an"), per_alt("nhomalt").try_cast("long").alias("nhomalt"), F.col("filter").alias("filter_status"),
    )
    return out.filter(F.col("af").isNotNull() & ~F.coalesce(F.col("an") == 0, F.lit(False)))


def assertions(rows: DataFrame) -> DataFrame:
    """Clinical assertions of a sites table: decoded significance, stars, conditions; records without one are left out."""
    base = rows.filter("verdict = 'ok'").withColumn("m_", info_map(F.col("info"))).select("*", F.explode(F.split("alt", ",")).alias("allele"))
    get = lambda k: F.element_at("m_", F.lit(k))
    return base.filter(get("CLNSIG").isNotNull()).select(
        alleles.contig(F.col("chrom")).alias("contig"), "position", "ref", F.col("allele").alias("alt"), F.col("id").alias("accession"), rules.decoded_text(get("CLNSIG")).alias("significance"),
        rules.decoded_text(get("CLNREVSTAT")).alias("review_status"), rules.review_stars(get("CLNREVSTAT")).alias("stars"), F.coalesce(rules.decoded_list(get("CLNDN")), F.array().cast("array<string>")).alias("conditions"),
    )


ANN = ["allele", "terms", "impact", "gene_symbol", "gene_id", "feature_type", "transcript_id", "biotype", "exon", "hgvs_c", "hgvs_p", "cdna", "cds", "protein", "distance", "errors"]


def predicted(rows: DataFrame) -> DataFrame:
    """One row per transcript of an ANN field, with a verdict: ok, unplaceable (no gene or transcript) or incomplete."""
    base = rows.filter("verdict = 'ok'").withColumn("a_", F.element_at(info_map(F.col("info")), F.lit("ANN")))
    one = base.filter("a_ IS NOT NULL").select("chrom", "position", "ref", "alt", F.explode(F.split("a_", ",")).alias("a_")).withColumn("p_", F.split("a_", r"\|"))
    cols = [F.nullif(F.get("p_", F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(ANN)]
    verdict = F.when(F.size("p_") < 16, "incomplete").when((F.get("p_", F.lit(3)) == "") | (F.get("p_", F.lit(6)) == ""), "unplaceable").otherwise("ok")
    return one.select("chrom", "position", "ref", "alt", *cols, verdict.alias("verdict")).withColumn("impact", F.lower("impact"))


def build_verdict(build: Column, wanted: str) -> Column:
    """ok, build_mismatch (a file of another build must not be read on) or build_not_declared (a warning)."""
    return F.when(build.isNull(), "build_not_declared").when(build != wanted, "build_mismatch").otherwise("ok")


def contig_styles(rows: DataFrame) -> DataFrame:
    """Records by how their contig is written: ucsc (chr1), ensembl (1), refseq (an accession) or other."""
    c = F.col("chrom")
    style = F.when(alleles.refseq_contig(c).isNotNull(), "refseq").when(alleles.contig(c).isNull(), "other").when(F.lower(c).startswith("chr"), "ucsc").otherwise("ensembl")
    return rows.filter("verdict = 'ok'").groupBy(style.alias("style")).agg(F.count(F.lit(1)).alias("n"))


def callset_profile(rows: DataFrame) -> DataFrame:
    """Filter histogram with shares of multiallelic and indel records."""
    indel = F.exists(F.split("alt", ","), lambda x: F.length(x) != F.length("ref"))
    return rows.filter("verdict = 'ok'").groupBy("filter").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("alt").contains(",").cast("double")), 6).alias("multiallelic"), F.round(F.avg(indel.cast("double")), 6).alias("indel"))


# How a made-up file says so, how its samples are named, and the columns of a table of sites.
SYNTHETIC_MARKS, SYNTHETIC_SAMPLES, HEAD_BYTES = ["_synthetic=true", "SYNTH_", "SYNTH-"], ["SYNTH_", "SYNTH-"], 4_096
SITES_HEADER = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"


def located_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, at, value: the lines of files with the byte at which each begins. A file is read whole, so this is for the small files of a repository."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.split("value", "\n").alias("l_"))
    ends = F.transform("l_", lambda x, k: F.aggregate(F.slice("l_", F.lit(1), k), F.lit(0).cast("long"), lambda n, y: n + F.octet_length(y) + 1))
    return whole.select("path", F.explode(F.arrays_zip(ends.alias("at"), F.col("l_").alias("value"))).alias("z")).select("path", "z.*")


def file_claims(lines_: DataFrame) -> DataFrame:
    """path, synthetic_mark, n_unmarked, sites_only, declares_synthetic of files given as lines (path, at, value).

    A file is believed to be made up only if its head says so and every sample that it names has a made-up name. A table of sites has exactly one
    header, of the eight fixed columns; nothing but meta lines before it; and only rows of eight fields behind it.
    """
    value, at = F.regexp_replace("value", "\r$", ""), F.col("at")
    df = lines_.withColumn("value", value)
    head = F.when(at < HEAD_BYTES, F.substring("value", F.lit(1), (F.lit(HEAD_BYTES) - at).cast("int")))
    marked = F.exists(F.array(*[F.lit(m) for m in SYNTHETIC_MARKS]), lambda m: F.coalesce(F.contains(head, m), F.lit(False)))
    made_up = lambda x: F.exists(F.array(*[F.lit(p) for p in SYNTHETIC_SAMPLES]), lambda p: x.startswith(p))
    header, meta = F.col("value").startswith("#CHROM"), F.col("value").startswith("##")
    names = F.when(header, F.slice(F.split("value", "\t"), 10, 1_000_000)).when(F.col("value").startswith("@RG"), F.regexp_extract_all("value", F.lit(r"\tSM:([^\t]+)"), F.lit(1)))
    unmarked = F.coalesce(F.size(F.filter(names, lambda x: (x != "") & ~made_up(x))), F.lit(0))
    other = F.col("value").startswith("#") & ~header & ~meta
    data = (F.col("value") != "") & ~F.col("value").startswith("#")
    g = df.groupBy("path").agg(
        F.bool_or(marked).alias("synthetic_mark"), F.sum(unmarked).alias("n_unmarked"), F.count_if(header).alias("headers"), F.bool_and(~header | (F.col("value") == SITES_HEADER)).alias("plain"),
        F.max(F.when(header, at)).alias("header_at"), F.max(F.when(meta, at)).alias("meta_at"), F.count_if(other).alias("others"), F.min(F.when(data, at)).alias("data_at"),
        F.bool_and(~data | (F.size(F.split("value", "\t")) == 8)).alias("eight"),
    )
    sites = (F.col("headers") == 1) & F.col("plain") & (F.col("others") == 0) & F.col("eight") & F.coalesce(F.col("meta_at") < F.col("header_at"), F.lit(True)) & F.coalesce(F.col("data_at") > F.col("header_at"), F.lit(True))
    return g.select("path", "synthetic_mark", "n_unmarked", F.coalesce(sites, F.lit(False)).alias("sites_only"), (F.col("synthetic_mark") & (F.col("n_unmarked") == 0)).alias("declares_synthetic"))


def release_coverage(text: DataFrame) -> DataFrame:
    """path, contig, raw, n, populations: what a release of sites files can answer: its contigs, as it writes them, and its populations.

    A contig written in two ways is two rows: a lookup by either would find a part of it only. Contigs off the primary assembly have no name here.
    """
    groups = header_facts(text).select("path", F.concat(F.array(F.lit("all")), "groups").alias("populations"))
    found = records(text).filter("verdict = 'ok'").groupBy("path", alleles.contig(F.col("chrom")).alias("contig"), F.col("chrom").alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    return found.join(groups, "path", "left")
