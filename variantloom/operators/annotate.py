"""Annotation joins: exact keys, coverage holes, gene intervals, nearest genes, frequencies, clinical assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from variantloom.config import DEFAULT, Config
from variantloom.functions import rules
from variantloom.operators.tables import row_hash

BIN = 131_072


def lookup(variants: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on a canonical key; both sides must be canonicalised before."""
    return variants.join(table, keys, "left")


def distinct_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in the given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("rn_", F.row_number().over(w)).filter("rn_ = 1").drop("rn_")


def unqueryable(variants: DataFrame, available: DataFrame, on: str = "contig") -> DataFrame:
    """Variants on contigs without a table: reported, never read as absent."""
    return variants.join(available.select(on).distinct(), on, "left_anti")


def max_frequency(frequencies: DataFrame, key: str = "site_key", config: Config = DEFAULT) -> DataFrame:
    """Largest frequency over populations that are large enough (or of unknown size), with its population; populations
    that are too small are listed apart."""
    powered = F.col("an").isNull() | (F.col("an") >= config.min_an)
    order = F.when(powered & F.col("af").isNotNull(), F.struct("af", "population"))
    best = F.max(order)
    return frequencies.groupBy(key).agg(
        best["af"].alias("max_af"),
        best["population"].alias("max_af_population"),
        F.array_sort(F.collect_list(F.when(~powered, F.col("population")))).alias("underpowered"),
        F.max(F.when(powered, F.col("nhomalt"))).alias("max_nhomalt"),
    )


def consequence_summary(consequences: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: how many, worst impact rank, any selecting, any assessed, all benign, largest SpliceAI delta."""
    rank = rules.impact_rank(F.col("impact"))
    return consequences.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_consequences"),
        F.min(rank).alias("worst_rank"),
        F.bool_or(rules.selecting(F.col("impact"), F.col("terms"))).alias("any_selecting"),
        F.bool_or(F.col("impact").isNotNull()).alias("any_assessed"),
        F.bool_and(F.coalesce(F.col("impact").isin("low", "modifier"), F.lit(False))).alias("all_benign"),
        *[F.max(c).alias(c) for c in ("splice_ai", "cadd", "revel") if c in consequences.columns],
        F.bool_or(F.col("is_mane")).alias("any_mane"),
        F.bool_or(rules.term_list(F.col("terms")).isNotNull() & F.arrays_overlap(rules.term_list(F.col("terms")), F.array(*[F.lit(x) for x in rules.LOSS_OF_FUNCTION]))).alias("any_lof"),
    )


def worst_by_gene(consequences: DataFrame, keys: list[str]) -> DataFrame:
    """The worst impact of each variant in each of its genes; transcripts nobody assessed do not count, and NULL means that none was."""
    return consequences.groupBy(*keys).agg(rules.impact_of(F.min(rules.impact_rank(F.col("impact")))).alias("worst_impact"))


def consequence_order(df: DataFrame) -> list[Column]:
    """The total order of a variant's consequences: MANE, canonical, transcript, gene, impact, terms, then what tells equal transcripts apart."""
    given = lambda c, otherwise: F.coalesce(F.col(c), F.lit(otherwise)) if c in df.columns else F.lit(otherwise)
    return [~given("is_mane", False), ~given("is_canonical", False), F.col("transcript_id"), F.col("gene_symbol"), F.coalesce(rules.impact_rank(F.col("impact")), F.lit(9)), given("terms", ""), given("hgvs_c", ""), given("hgvs_p", ""), given("exon", "")]


def clinical_summary(clinical: DataFrame, key: str = "site_key") -> DataFrame:
    return clinical.groupBy(key).agg(F.bool_or(rules.pathogenic(F.col("significance"))).alias("pathogenic"), F.max("stars").alias("stars"), F.count(F.lit(1)).alias("n_assertions"))


def binned(df: DataFrame, contig: str, start: Column, end: Column) -> DataFrame:
    """One row per bin that start..end touches."""
    return df.withColumn("bin_", F.explode(F.sequence(F.floor(start / BIN).cast("long"), F.floor(end / BIN).cast("long"))))


def overlapping(variants: DataFrame, genes: DataFrame, start: str = "position", end: str = "end") -> DataFrame:
    """Variants with every gene whose span they touch: an equi-join on (contig, bin) with the overlap as residue.

    A pair that meets in several bins is kept in the first bin that both have.
    """
    v = binned(variants, "contig", F.col(start), F.col(end))
    g = binned(genes, "contig", F.col("g_start"), F.col("g_end"))
    met = v.join(g, ["contig", "bin_"])
    first = F.greatest(F.floor(F.col(start) / BIN), F.floor(F.col("g_start") / BIN)).cast("long")
    return met.filter((F.col(start) <= F.col("g_end")) & (F.col(end) >= F.col("g_start")) & (F.col("bin_") == first)).drop("bin_")


def with_loci(variants: DataFrame, genes: DataFrame) -> DataFrame:
    """Variants (contig, position, ref, ...) with a row for each gene whose span they touch: a variant in two genes is two rows."""
    return overlapping(variants.withColumn("end", F.col("position") + F.length("ref") - 1), genes)


def locus_annotations(variants: DataFrame, genes: DataFrame, transcripts: DataFrame, key: list[str]) -> DataFrame:
    """A consequence row for each variant, gene that it touches and transcript of that gene, Select or not.

    Standing in a gene says nothing of what a variant does there: the impact is NULL, never a low one. Variants between genes have no row.
    """
    met = with_loci(variants, genes).select(*key, "gene_symbol", "gene_id").join(transcripts, "gene_id")
    return met.select(*key, "gene_symbol", "gene_id", "transcript_id", "is_select", F.lit("gene_variant").alias("terms"), F.lit(None).cast("string").alias("impact"))


def nearest(variants: DataFrame, genes: DataFrame, key: list[str], within: int, start: str = "position", end: str = "end") -> DataFrame:
    """For variants that touch no gene: all nearest genes within some distance, with the gap; ties are all kept."""
    hit = overlapping(variants, genes, start, end).select(*key).distinct()
    rest = variants.join(hit, key, "left_anti")
    wide = genes.withColumns({"o_start": F.col("g_start"), "o_end": F.col("g_end"), "g_start": F.col("g_start") - within, "g_end": F.col("g_end") + within})
    gap = F.greatest(F.col("o_start") - F.col(end), F.col(start) - F.col("o_end"))
    near = overlapping(rest, wide, start, end).withColumn("gap", gap)
    best = Window.partitionBy(*key)
    return near.withColumn("least_", F.min("gap").over(best)).filter("gap = least_").withColumns({"g_start": F.col("o_start"), "g_end": F.col("o_end")}).drop("least_", "o_start", "o_end")


def backfilled(primary: DataFrame, fallback: DataFrame, key: list[str]) -> DataFrame:
    """The predictor's rows, and the fallback's where the predictor is silent."""
    return primary.unionByName(fallback.join(primary.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


def triaged(calls: DataFrame, consequences: DataFrame, clinical: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds consequences, clinical assertions and the triage verdict; calls may be a stream."""
    own = consequence_summary(consequences, ["site_key"])
    known = calls.join(own, "site_key", "left").join(clinical_summary(clinical), "site_key", "left")
    known = known.withColumns({
        "n_consequences": F.coalesce("n_consequences", F.lit(0)),
        "any_selecting": F.coalesce("any_selecting", F.lit(False)),
        "any_assessed": F.coalesce("any_assessed", F.lit(False)),
        "all_benign": F.coalesce("all_benign", F.lit(False)),
        "pathogenic": F.coalesce("pathogenic", F.lit(False)),
    })
    verdict = rules.triage_verdict(F.col("n_consequences"), F.col("any_selecting"), F.col("worst_rank"), F.col("splice_ai"), F.col("n_assertions").isNotNull(), config)
    return known.withColumn("triage", verdict)


def annotated(calls: DataFrame, consequences: DataFrame, frequencies: DataFrame, clinical: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The triage verdict first; frequencies are joined to survivors only."""
    known = triaged(calls, consequences, clinical, config)
    best = max_frequency(frequencies, config=config).withColumnRenamed("site_key", "f_key_")
    return known.join(best, (F.col("site_key") == F.col("f_key_")) & F.col("triage").startswith("kept"), "left").drop("f_key_")


def flagged(df: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds the soft flags; df has max_af, all_benign and the call's quality columns."""
    fraction = F.when(F.col("depth") > 0, F.col("alt_reads") / F.col("depth"))
    return df.withColumn("fraction", fraction).withColumn("flags", rules.soft_flags(F.col("max_af"), F.col("filter_status"), F.col("depth"), F.col("gq"), F.col("zygosity"), F.col("fraction"), F.col("all_benign"), config=config))


def selected(df: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds the selection verdict and its notes to triaged, annotated calls."""
    gates = [F.col("n_consequences"), F.col("any_selecting")]
    out = df.withColumn("selection", rules.selection_verdict(*gates, F.col("any_assessed"), F.col("splice_ai"), F.col("max_af"), F.col("pathogenic"), config))
    return out.withColumn("notes", rules.selection_notes(F.col("selection"), *gates, F.col("splice_ai"), F.col("max_af"), F.col("underpowered"), F.col("pathogenic"), config))


def plausible(df: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds `plausible_candidate`: an ALT is carried, at a frequency that is unknown or not too high for a recessive disorder. A mark, not a filter."""
    rare = F.col("max_af").isNull() | (F.col("max_af") <= config.max_recessive)
    return df.withColumn("plausible_candidate", F.col("zygosity").isin("het", "hom_alt", "hemi") & rare)


def replacement_counts(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """state, n: keys whose annotations a new source added, removed, replaced or left as they were."""
    digest = lambda df, name: df.groupBy(*key).agg(F.sum(row_hash(df, sorted(df.columns)).cast("decimal(38,0)")).alias(name))
    met = digest(old, "old_").join(digest(new, "new_"), key, "full_outer")
    state = F.when(F.col("old_").isNull(), "added").when(F.col("new_").isNull(), "removed").when(F.col("old_") != F.col("new_"), "replaced").otherwise("unchanged")
    return met.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def split_by(df: DataFrame, verdict: str, kept_prefix: str, stage: str, id_column: str, value: Column) -> tuple[DataFrame, DataFrame]:
    """Kept rows and the discard ledger (variant_id, stage, rule, value), from one verdict column."""
    keep = F.col(verdict).startswith(kept_prefix)
    gone = df.filter(~keep).select(F.col(id_column).alias("variant_id"), F.lit(stage).alias("stage"), F.col(verdict).alias("rule"), value.cast("string").alias("value"))
    return df.filter(keep), gone
