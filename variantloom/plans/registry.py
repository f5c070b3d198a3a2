"""All registered queries of the core library and their SQL equivalents.

Queries run over whole tables. Arrays leave a query as joined text and doubles are rounded to six places, so that two
engines can be compared. QUERIES without a text in ORACLES have their operators tested by themselves, and are only run here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from variantloom.functions import alleles, rules
from variantloom.operators import annotate, compare, mechanism, ontology, pairs, stages, tables, textscan
from variantloom.plans.views import Views, duck
from variantloom.sources import tables as knowledge

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Callable[[Views], DataFrame]], Callable[[Views], DataFrame]]:
    """Register f(views) under a name, with its SQL."""

    def wrap(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if oracle:
            ORACLES[name] = duck(oracle)
        return f

    return wrap


def joined(c: str) -> F.Column:
    return F.array_join(c, ",").alias(c)


def r6(c: str) -> F.Column:
    return F.round(F.col(c).cast("double"), 6).alias(c)


# ---- shared SQL -------------------------------------------------------------------------------------------------------

CODING = ", ".join(f"'{x}'" for x in rules.CODING_OR_SPLICE)
LOF = ", ".join(f"'{x}'" for x in rules.LOSS_OF_FUNCTION)
SQL_RANK = "CASE impact WHEN 'high' THEN 0 WHEN 'moderate' THEN 1 WHEN 'low' THEN 2 WHEN 'modifier' THEN 3 END"
SQL_FREQ = """freq AS (
  SELECT s.site_key, p.af AS max_af, p.population AS max_af_population, s.underpowered, s.max_nhomalt
  FROM (SELECT site_key, coalesce(string_agg(CASE WHEN an < 2000 THEN population END, ',' ORDER BY population), '') AS underpowered,
          max(CASE WHEN an IS NULL OR an >= 2000 THEN nhomalt END) AS max_nhomalt FROM frequencies GROUP BY site_key) s
  LEFT JOIN (SELECT site_key, af, population, row_number() OVER (PARTITION BY site_key ORDER BY af DESC, population DESC) AS rn
          FROM frequencies WHERE an IS NULL OR an >= 2000) p ON p.site_key = s.site_key AND p.rn = 1)"""
SQL_CONS = f"""cons AS (
  SELECT site_key, count(*) AS n_consequences, min({SQL_RANK}) AS worst_rank,
    bool_or(impact IN ('high', 'moderate') IS TRUE OR len(list_filter(string_split(terms, '&'), lambda t: t IN ({CODING}))) > 0) AS any_selecting,
    bool_or(impact IS NOT NULL) AS any_assessed, bool_and(coalesce(impact IN ('low', 'modifier'), false)) AS all_benign,
    max(splice_ai) AS splice_ai, max(cadd) AS cadd, max(revel) AS revel, bool_or(is_mane) AS any_mane, bool_or(len(list_filter(string_split(terms, '&'), lambda t: t IN ({LOF}))) > 0) AS any_lof
  FROM consequences GROUP BY site_key)"""
SQL_CLIN = """clin AS (
  SELECT site_key, bool_or(lower(significance) LIKE '%pathogenic%' AND lower(significance) NOT LIKE '%conflict%' AND lower(significance) NOT LIKE '%benign%') AS pathogenic,
    max(stars) AS stars, count(*) AS n_assertions FROM clinical GROUP BY site_key)"""
SQL_TRIAGED = f"""{SQL_FREQ}, {SQL_CONS}, {SQL_CLIN},
triaged AS (
  SELECT c.*, coalesce(n_consequences, 0) AS n_cons, worst_rank, coalesce(any_selecting, false) AS any_selecting, coalesce(any_assessed, false) AS any_assessed,
    coalesce(all_benign, false) AS all_benign, splice_ai, cadd, revel, any_mane, any_lof, coalesce(pathogenic, false) AS pathogenic, n_assertions,
    CASE WHEN coalesce(n_consequences, 0) = 0 AND n_assertions IS NOT NULL THEN 'kept_clinical_assertion'
      WHEN coalesce(n_consequences, 0) = 0 THEN 'dropped_no_gene_assignment'
      WHEN any_selecting THEN 'kept_relevant_consequence' WHEN worst_rank <= 2 THEN 'kept_impact_at_or_above_floor'
      WHEN splice_ai >= 0.2 THEN 'kept_splice_ai' WHEN n_assertions IS NOT NULL THEN 'kept_clinical_assertion'
      WHEN worst_rank IS NULL THEN 'kept_impact_not_assessed' ELSE 'dropped_impact_below_floor' END AS triage
  FROM calls c LEFT JOIN cons ON cons.site_key = c.site_key LEFT JOIN clin ON clin.site_key = c.site_key),
annot AS (
  SELECT t.*, CASE WHEN triage LIKE 'kept%' THEN max_af END AS max_af, CASE WHEN triage LIKE 'kept%' THEN max_nhomalt END AS max_nhomalt,
    CASE WHEN depth > 0 THEN alt_reads / depth END AS fraction
  FROM triaged t LEFT JOIN freq ON freq.site_key = t.site_key),
judged AS (
  SELECT *, CASE WHEN NOT pathogenic AND max_af > 0.02 THEN 'dropped_common_in_population' WHEN n_cons = 0 AND pathogenic THEN 'retained_pathogenic_assertion'
      WHEN n_cons = 0 THEN 'dropped_no_gene_assignment' WHEN any_selecting OR coalesce(splice_ai >= 0.2, false) THEN 'retained_coding_or_splice'
      WHEN NOT any_assessed THEN 'retained_impact_not_assessed' WHEN pathogenic THEN 'retained_pathogenic_assertion' ELSE 'dropped_not_coding_or_splice' END AS selection,
    filter_status = 'filtered' OR coalesce(depth < 10, false) OR coalesce(gq < 20, false) OR coalesce(zygosity = 'het' AND (fraction > 0.75 OR fraction < 0.10), false) AS poor
  FROM annot)"""


def annotated(v: Views) -> DataFrame:
    return annotate.annotated(v["calls"], v["consequences"], v["frequencies"], v["clinical"])


def judged(v: Views) -> DataFrame:
    """Triage survivors with flags and selection verdict."""
    return annotate.selected(annotate.flagged(annotated(v).filter(F.col("triage").startswith("kept"))))


# ---- rows: alleles, quality, filters ------------------------------------------------------------------------------------


@query("allele_normalisation", """
WITH v AS (SELECT DISTINCT contig, position, concat(ref, 'CA', alt, 'T', ref) AS ref, concat(ref, 'CA', ref, 'CA', alt, 'T', ref) AS alt FROM calls),
s AS (SELECT *, coalesce(list_min(list_filter(range(1, length(ref)), lambda i: substr(ref, length(ref) - i + 1, 1) <> substr(alt, length(alt) - i + 1, 1))) - 1, length(ref) - 1) AS s FROM v),
cut AS (SELECT contig, position, ref AS r0, alt AS a0, substr(ref, 1, length(ref) - s) AS r1, substr(alt, 1, length(alt) - s) AS a1 FROM s),
p AS (SELECT *, coalesce(list_min(list_filter(range(1, least(length(r1), length(a1))), lambda i: substr(r1, i, 1) <> substr(a1, i, 1))) - 1, least(length(r1), length(a1)) - 1) AS p FROM cut)
SELECT concat('GRCh38:', contig, ':', position, ':', r0, ':', a0) AS variant_id, CAST(CAST(substr(contig, 4) AS INT) - 1 AS INT) AS contig_order, position + p AS new_position,
  substr(r1, CAST(p AS INT) + 1) AS new_ref, substr(a1, CAST(p AS INT) + 1) AS new_alt FROM p""")
def allele_normalisation(v: Views) -> DataFrame:
    """Trimming of insertions built on each call."""
    ins = F.concat("ref", F.lit("CA"), "ref", F.lit("CA"), "alt", F.lit("T"), "ref")
    df = v["calls"].select("contig", "position", F.concat("ref", F.lit("CA"), "alt", F.lit("T"), "ref").alias("r"), ins.alias("a")).distinct()
    t = alleles.trimmed(F.col("position"), F.col("r"), F.col("a"))
    df = df.select(alleles.variant_id(F.lit("GRCh38"), F.col("contig"), F.col("position"), F.col("r"), F.col("a")).alias("variant_id"), alleles.contig_order(F.col("contig")).alias("contig_order"), t.alias("t"))
    return df.select("variant_id", "contig_order", F.col("t.position").alias("new_position"), F.col("t.ref").alias("new_ref"), F.col("t.alt").alias("new_alt"))


@query("identifier_rules", """
SELECT DISTINCT concat('GRCh38:', contig, ':', position, ':', ref, ':', alt) AS variant_id, substr(contig, 4) AS ensembl, contig, position, ref, alt,
  CASE WHEN alt = ref THEN 'same' ELSE 'usable' END AS state FROM calls""")
def identifier_rules(v: Views) -> DataFrame:
    """Ids built and parsed again, contig styles, usable alleles."""
    raw = v["calls"].select(alleles.variant_id(alleles.build(F.lit("hg38")), alleles.contig(F.substring("contig", 4, 2)), F.col("position"), F.col("ref"), F.col("alt")).alias("variant_id")).distinct()
    p = raw.select("variant_id", alleles.parsed_id(F.col("variant_id")).alias("p"))
    state = F.when(F.col("p.alt") == F.col("p.ref"), "same").otherwise(F.coalesce(alleles.unusable_allele(F.col("p.ref"), F.col("p.alt")), F.lit("usable")))
    return p.select("variant_id", alleles.contig(F.col("p.contig"), "ensembl").alias("ensembl"), "p.contig", "p.position", "p.ref", "p.alt", state.alias("state"))


SQL_QC = """q AS (
  SELECT *, CASE WHEN alt_reads IS NOT NULL AND depth > 0 THEN alt_reads / depth END AS fraction FROM variants),
f AS (SELECT *, list_filter([
    CASE filter_status WHEN 'filtered' THEN 'filtered_by_caller' WHEN 'missing' THEN 'no_caller_filter' END,
    CASE WHEN depth < 10 THEN 'low_depth' END, CASE WHEN gq < 20 THEN 'low_gq' END,
    CASE WHEN zygosity = 'het' AND fraction > 0.75 THEN 'high_allele_balance' END, CASE WHEN zygosity = 'het' AND fraction < 0.1 THEN 'low_allele_balance' END,
    CASE WHEN zygosity = 'het' AND fraction >= 0.1 AND fraction < 0.25 THEN 'possible_mosaic' END,
    CASE WHEN depth IS NULL AND gq IS NULL AND fraction IS NULL THEN 'no_quality_metrics' END], lambda x: x IS NOT NULL) AS flags FROM q),
d AS (SELECT *, CASE WHEN list_has_any(flags, ['filtered_by_caller', 'low_depth', 'low_gq', 'high_allele_balance', 'low_allele_balance']) THEN 'contradicts'
    WHEN list_has_any(flags, ['no_caller_filter', 'possible_mosaic', 'no_quality_metrics']) THEN 'neutral' ELSE 'supports' END AS direction,
  CASE WHEN list_has_any(flags, ['low_depth', 'low_gq', 'filtered_by_caller']) THEN 'moderate' WHEN list_has_any(flags, ['high_allele_balance', 'low_allele_balance']) THEN 'supporting'
    WHEN list_contains(flags, 'no_quality_metrics') THEN 'insufficient' WHEN list_contains(flags, 'possible_mosaic') THEN 'supporting' WHEN depth >= 20 AND gq >= 20 THEN 'strong' ELSE 'moderate' END AS strength FROM f)"""


def qc(v: Views) -> DataFrame:
    fraction = alleles.allele_balance(F.col("depth") - F.col("alt_reads"), F.col("alt_reads"))
    df = v["variants"].withColumn("fraction", fraction)
    df = df.withColumn("flags", rules.qc_flags(F.col("zygosity"), F.col("fraction"), F.col("fraction"), F.col("depth"), F.col("gq"), F.col("filter_status")))
    return df.withColumn("direction", rules.qc_direction(F.col("flags"))).withColumn("strength", rules.qc_strength(F.col("flags"), F.col("depth"), F.col("gq"), F.lit(None).cast("boolean")))


@query("quality_flags", f"WITH {SQL_QC} SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(flags, ',') AS flags, direction, strength, round(fraction, 6) AS fraction FROM d")
def quality_flags(v: Views) -> DataFrame:
    """B9, B17, B18, B19."""
    return qc(v).select("l_orderkey", "l_linenumber", "l_partkey", joined("flags"), "direction", "strength", r6("fraction"))


@query("quality_metrics", f"""WITH {SQL_QC}
SELECT sample_id, count(*) AS n, CAST(sum(CASE WHEN list_contains(flags, 'low_depth') THEN 1 ELSE 0 END) AS BIGINT) AS n_low_depth, CAST(sum(CASE WHEN direction = 'supports' THEN 1 ELSE 0 END) AS BIGINT) AS n_supports,
  round(avg(depth), 6) AS mean_depth, CAST(median(depth) AS DOUBLE) AS median_depth, min(depth) AS min_depth, max(depth) AS max_depth, round(avg(CASE WHEN zygosity = 'het' THEN fraction END), 6) AS mean_het FROM d GROUP BY sample_id""")
def quality_metrics(v: Views) -> DataFrame:
    """D-1."""
    return qc(v).groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("flags", "low_depth")).alias("n_low_depth"), F.count_if(F.col("direction") == "supports").alias("n_supports"), F.round(F.avg("depth"), 6).alias("mean_depth"),
        F.median("depth").alias("median_depth"), F.min("depth").alias("min_depth"), F.max("depth").alias("max_depth"), F.round(F.avg(F.when(F.col("zygosity") == "het", F.col("fraction"))), 6).alias("mean_het"),
    )


@query("hard_filter", """
SELECT sample_id, CASE WHEN l_orderkey % 50 = 0 THEN 'wrong_genome_build' WHEN l_partkey % 22 = 21 THEN 'non_canonical_contig' WHEN l_linenumber = 7 THEN 'uninformative_alt_allele'
  WHEN l_orderkey % 13 = 0 THEN 'missing_genotype' ELSE 'kept' END AS reason, count(*) AS n FROM variants GROUP BY 1, 2""")
def hard_filter(v: Views) -> DataFrame:
    """B20, D-11: invalid records by reason; some build, contig, allele and genotype values are spoilt by rule."""
    build = F.when(F.col("l_orderkey") % 50 == 0, "GRCh37").otherwise("GRCh38")
    contig = alleles.contig(F.when(F.col("l_partkey") % 22 == 21, F.concat("contig", F.lit("_alt"))).otherwise(F.col("contig")))
    zygosity = F.when(F.col("l_orderkey") % 13 == 0, "unknown").otherwise(F.col("zygosity"))
    reason = rules.hard_reason(build, "GRCh38", contig.isNotNull(), F.when(F.col("l_linenumber") == 7, "*").otherwise(F.col("alt")), zygosity)
    return v["variants"].withColumn("reason", F.coalesce(reason, F.lit("kept"))).groupBy("sample_id", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("soft_flags", f"""WITH {SQL_TRIAGED}, fl AS (
  SELECT sample_id, unnest(list_filter([CASE WHEN max_af IS NULL THEN 'no_frequency_data' WHEN max_af > 0.01 THEN 'common_variant' WHEN max_af > 0.001 THEN 'low_frequency_variant' END,
    CASE WHEN poor THEN 'low_quality_call' END, CASE WHEN zygosity = 'het' AND fraction >= 0.1 AND fraction < 0.25 THEN 'possible_mosaic' END,
    CASE WHEN all_benign THEN 'benign_consequence' END, CASE WHEN zygosity = 'hom_alt' THEN 'homozygous_call' END], lambda x: x IS NOT NULL)) AS flag FROM judged WHERE triage LIKE 'kept%')
SELECT sample_id, flag, count(*) AS n FROM fl GROUP BY sample_id, flag""")
def soft_flags(v: Views) -> DataFrame:
    """B21, B22 on triage survivors."""
    return judged(v).select("sample_id", F.explode("flags").alias("flag")).groupBy("sample_id", "flag").agg(F.count(F.lit(1)).alias("n"))


# ---- annotation ---------------------------------------------------------------------------------------------------------


@query("max_frequency", f"WITH {SQL_FREQ} SELECT site_key, max_af, max_af_population, underpowered, coalesce(max_nhomalt, -1) AS max_nhomalt FROM freq")
def max_frequency(v: Views) -> DataFrame:
    """D-3."""
    return annotate.max_frequency(v["frequencies"]).select("site_key", "max_af", "max_af_population", joined("underpowered"), F.coalesce("max_nhomalt", F.lit(-1)).alias("max_nhomalt"))


@query("consequence_summary", f"WITH {SQL_CONS} SELECT site_key, n_consequences, CASE worst_rank WHEN 0 THEN 'high' WHEN 1 THEN 'moderate' WHEN 2 THEN 'low' WHEN 3 THEN 'modifier' END AS worst_impact, any_selecting, any_assessed, all_benign, round(splice_ai, 6) AS splice_ai, any_lof FROM cons")
def consequence_summary(v: Views) -> DataFrame:
    """B23, B24, B25, D-2."""
    return annotate.consequence_summary(v["consequences"], ["site_key"]).select("site_key", "n_consequences", rules.impact_of(F.col("worst_rank")).alias("worst_impact"), "any_selecting", "any_assessed", "all_benign", r6("splice_ai"), "any_lof")


@query("clinical_assertions", """
SELECT c.sample_id, c.contig, c.position, c.ref, c.alt, k.significance, CASE WHEN lower(significance) LIKE '%conflict%' THEN 'neutral' WHEN lower(significance) LIKE '%pathogenic%' THEN 'supports' WHEN lower(significance) LIKE '%benign%' THEN 'contradicts' ELSE 'neutral' END AS direction,
  CASE WHEN stars >= 3 THEN 'strong' WHEN stars = 2 THEN 'moderate' WHEN stars = 1 THEN 'supporting' ELSE 'weak' END AS strength
FROM calls c JOIN clinical k ON k.site_key = c.site_key""")
def clinical_assertions(v: Views) -> DataFrame:
    """B28, B29, C4."""
    met = v["calls"].join(v["clinical"], "site_key")
    return met.select("sample_id", "contig", "position", "ref", "alt", "significance", rules.significance_direction(F.col("significance")).alias("direction"), rules.stars_strength(F.col("stars")).alias("strength"))


@query("triage_report", f"WITH {SQL_TRIAGED} SELECT triage LIKE 'kept%' AS retained, triage AS reason, count(*) AS n FROM triaged GROUP BY 1, 2")
def triage_report(v: Views) -> DataFrame:
    """B26, C1, C10, D-6."""
    return annotated(v).groupBy(F.col("triage").startswith("kept").alias("retained"), F.col("triage").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("selection_report", f"WITH {SQL_TRIAGED} SELECT sample_id, selection AS reason, count(*) AS n FROM judged WHERE triage LIKE 'kept%' GROUP BY 1, 2")
def selection_report(v: Views) -> DataFrame:
    """B27, D-7, O16."""
    return judged(v).groupBy("sample_id", F.col("selection").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("discard_ledger", f"""WITH {SQL_TRIAGED}, gone AS (
  SELECT 'triage' AS stage, triage AS rule FROM triaged WHERE triage LIKE 'dropped%' UNION ALL SELECT 'selection', selection FROM judged WHERE triage LIKE 'kept%' AND selection LIKE 'dropped%')
SELECT stage, rule, count(*) AS n FROM gone GROUP BY ROLLUP (stage, rule) HAVING stage IS NOT NULL""")
def discard_ledger(v: Views) -> DataFrame:
    """A31, D-9, F6: everything dropped, by stage and rule."""
    df = pairs.with_order(annotated(v))
    kept, gone = annotate.split_by(df, "triage", "kept", "triage", "variant_id", rules.impact_of(F.col("worst_rank")))
    _, later = annotate.split_by(annotate.selected(kept), "selection", "retained", "selection", "variant_id", F.col("max_af"))
    return tables.discard_counts(gone.union(later))


@query("stage_funnel", f"""WITH {SQL_TRIAGED} SELECT sample_id, count(*) AS n_calls, CAST(sum(CASE WHEN triage LIKE 'kept%' THEN 1 ELSE 0 END) AS BIGINT) AS n_triaged,
  CAST(sum(CASE WHEN triage LIKE 'kept%' AND max_af IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_with_frequency, CAST(sum(CASE WHEN triage LIKE 'kept%' AND selection LIKE 'retained%' THEN 1 ELSE 0 END) AS BIGINT) AS n_selected FROM judged GROUP BY sample_id""")
def stage_funnel(v: Views) -> DataFrame:
    """D-5, D-8 in one pass."""
    df = annotate.selected(annotated(v))
    kept = F.col("triage").startswith("kept")
    return df.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_calls"), F.count_if(kept).alias("n_triaged"), F.count_if(kept & F.col("max_af").isNotNull()).alias("n_with_frequency"), F.count_if(kept & F.col("selection").startswith("retained")).alias("n_selected"))


@query("coverage_hole", """
WITH av AS (SELECT DISTINCT concat('chr', CAST(1 + site_key % 22 AS VARCHAR)) AS contig FROM clinical WHERE site_key % 3 = 0)
SELECT c.contig, count(*) AS n FROM calls c WHERE c.contig NOT IN (SELECT contig FROM av) GROUP BY c.contig""")
def coverage_hole(v: Views) -> DataFrame:
    """Calls on contigs for which a table has nothing."""
    available = v["clinical"].filter("site_key % 3 = 0").select(F.concat(F.lit("chr"), (1 + F.col("site_key") % 22).cast("string")).alias("contig"))
    return annotate.unqueryable(v["calls"], available).groupBy("contig").agg(F.count(F.lit(1)).alias("n"))


SQL_SITES = "sites AS (SELECT DISTINCT contig, position, ref FROM calls)"


def sites(v: Views) -> DataFrame:
    return v["calls"].select("contig", "position", "ref").distinct().withColumn("end", F.col("position") + F.length("ref") - 1)


@query("gene_overlap", f"WITH {SQL_SITES} SELECT s.contig, s.position, s.ref, g.gene_symbol FROM sites s JOIN genes g ON g.contig = s.contig AND s.position <= g.g_end AND s.position + length(s.ref) - 1 >= g.g_start")
def gene_overlap(v: Views) -> DataFrame:
    """C5, C9, C14."""
    return annotate.overlapping(sites(v), v["genes"]).select("contig", "position", "ref", "gene_symbol")


@query("nearest_gene", f"""WITH {SQL_SITES}, rest AS (SELECT s.* FROM sites s WHERE NOT EXISTS (SELECT 1 FROM genes g WHERE g.contig = s.contig AND s.position <= g.g_end AND s.position >= g.g_start)),
d AS (SELECT r.contig, r.position, r.ref, g.gene_symbol, CAST(greatest(g.g_start - r.position, r.position - g.g_end) AS BIGINT) AS gap FROM rest r JOIN genes g ON g.contig = r.contig AND r.position BETWEEN g.g_start - 5000 AND g.g_end + 5000)
SELECT contig, position, ref, gene_symbol, gap FROM (SELECT *, min(gap) OVER (PARTITION BY contig, position, ref) AS least FROM d) q WHERE gap = least""")
def nearest_gene(v: Views) -> DataFrame:
    """Ties are kept."""
    return annotate.nearest(sites(v), v["genes"], ["contig", "position", "ref"], 5_000).select("contig", "position", "ref", "gene_symbol", F.col("gap").cast("long").alias("gap"))


@query("gene_backfill", """
WITH p AS (SELECT DISTINCT site_key, gene_key FROM consequences), m AS (SELECT DISTINCT site_key FROM calls)
SELECT site_key, gene_key, 'predictor' AS source FROM p UNION ALL SELECT m.site_key, m.site_key % 500, 'locus' FROM m WHERE m.site_key NOT IN (SELECT site_key FROM p)""")
def gene_backfill(v: Views) -> DataFrame:
    """The locus speaks where the predictor is silent."""
    primary = v["consequences"].select("site_key", "gene_key").distinct().withColumn("source", F.lit("predictor"))
    fallback = v["calls"].select("site_key", (F.col("site_key") % 500).alias("gene_key")).distinct().withColumn("source", F.lit("locus"))
    return annotate.backfilled(primary, fallback, ["site_key"])


@query("gene_projection", f"""WITH k AS (SELECT DISTINCT gene_key, site_key FROM calls)
SELECT k.gene_key, count(DISTINCT k.site_key) AS n_sites, min(CASE impact WHEN 'high' THEN 0 WHEN 'moderate' THEN 1 WHEN 'low' THEN 2 WHEN 'modifier' THEN 3 END) AS worst_rank, string_agg(DISTINCT CAST(tx_no AS VARCHAR), ',' ORDER BY CAST(tx_no AS VARCHAR)) AS transcripts
FROM k JOIN consequences c ON c.site_key = k.site_key AND c.gene_key = k.gene_key GROUP BY k.gene_key""")
def gene_projection(v: Views) -> DataFrame:
    """D-4."""
    met = v["calls"].select("gene_key", "site_key").distinct().join(v["consequences"], ["site_key", "gene_key"])
    return met.groupBy("gene_key").agg(F.countDistinct("site_key").alias("n_sites"), F.min(rules.impact_rank(F.col("impact"))).alias("worst_rank"), F.array_join(F.array_sort(F.collect_set(F.col("tx_no").cast("string"))), ",").alias("transcripts"))


# ---- pairs ----------------------------------------------------------------------------------------------------------------

SQL_PAIRS = f"""{SQL_TRIAGED},
mem AS (SELECT *, CAST(substr(contig, 4) AS INT) - 1 AS contig_order, concat('GRCh38:', contig, ':', position, ':', ref, ':', alt) AS variant_id,
    CASE WHEN max_af IS NULL OR max_af <= 0.01 THEN 0 ELSE 1 END AS common FROM judged WHERE triage LIKE 'kept%' AND selection LIKE 'retained%'),
placed AS (SELECT *, row_number() OVER (PARTITION BY sample_id, gene_key ORDER BY common, poor, coalesce(worst_rank, 2), contig_order, position, ref, alt, variant_id) AS place,
    count(*) OVER (PARTITION BY sample_id, gene_key) AS n_variants, coalesce(zygosity = 'het' AND fraction >= 0.1 AND fraction < 0.25, false) AS mosaic FROM mem),
capped AS (SELECT * FROM placed WHERE place <= 24),
made AS (SELECT a.sample_id, a.gene_key, a.variant_id AS id_a, b.variant_id AS id_b, a.place AS place_a, b.place AS place_b, a.n_variants,
    a.contig_order AS co_a, a.position AS pos_a, a.ref AS ref_a, a.alt AS alt_a, b.contig_order AS co_b, b.position AS pos_b, b.ref AS ref_b, b.alt AS alt_b
  FROM capped a JOIN capped b ON a.sample_id = b.sample_id AND a.gene_key = b.gene_key AND (a.contig_order, a.position, a.ref, a.alt, a.variant_id) < (b.contig_order, b.position, b.ref, b.alt, b.variant_id)
  UNION ALL SELECT sample_id, gene_key, variant_id, NULL, place, NULL, n_variants, contig_order, position, ref, alt, NULL, NULL, NULL, NULL FROM placed
  WHERE zygosity = 'hom_alt' OR mosaic OR (zygosity = 'het' AND coalesce(worst_rank = 0, false))),
kept AS (SELECT *, generated > 20 OR n_variants > 24 AS truncated FROM (SELECT *, count(*) OVER (PARTITION BY sample_id, gene_key) AS generated,
    row_number() OVER (PARTITION BY sample_id, gene_key ORDER BY greatest(place_a, place_b), least(place_a, place_b), id_b IS NOT NULL) AS pair_place FROM made) q WHERE pair_place <= 20)"""


GENE = ["sample_id", "gene_key"]


def placed_calls(v: Views) -> DataFrame:
    """Retained calls with their place in their gene, written once for a query's pairs, singles and genes."""
    if "placed_calls" not in v.made:
        df = pairs.with_order(judged(v).filter(F.col("selection").startswith("retained")))
        v.made["placed_calls"] = tables.cut(pairs.placed(df, GENE))
    return v.made["placed_calls"]


def candidates(v: Views) -> DataFrame:
    return pairs.kept_pairs(pairs.pairs_and_singles(placed_calls(v), GENE), GENE)


@query("pair_enumeration", f"WITH {SQL_PAIRS} SELECT sample_id, gene_key, id_a AS variant_a, id_b AS variant_b, generated, CAST(pair_place AS INT) AS pair_place, truncated FROM kept")
def pair_enumeration(v: Views) -> DataFrame:
    """Pairs, and single variants (variant_b NULL)."""
    return candidates(v).select("sample_id", "gene_key", F.col("a.variant_id").alias("variant_a"), F.col("b.variant_id").alias("variant_b"), "generated", "pair_place", "truncated")


def _sql_validity(x: str) -> str:
    low = lambda c, n: f"CASE WHEN {x}.{c} IS NULL THEN 0.7 WHEN {x}.{c} < {n} THEN greatest(0.15, {x}.{c} / {n}.0) ELSE 1.0 END"
    het = f"CASE WHEN {x}.zygosity <> 'het' THEN 1.0 WHEN {x}.fraction IS NULL THEN 0.85 WHEN {x}.fraction > 0.75 THEN 0.6 WHEN {x}.fraction < 0.10 THEN 0.4 WHEN {x}.fraction < 0.25 THEN 0.75 ELSE 1.0 END"
    return f"CAST(CASE {x}.filter_status WHEN 'filtered' THEN 0.25 WHEN 'missing' THEN 0.7 ELSE 1.0 END AS DOUBLE) * CAST({low('depth', 10)} AS DOUBLE) * CAST({low('gq', 20)} AS DOUBLE) * CAST({het} AS DOUBLE)"


SQL_GENE_TERMS = "gene_terms AS (SELECT p_partkey % 100 AS gene_key, 4 + p_partkey * 11 % 140 AS term, max(CAST(CASE p_size % 4 WHEN 0 THEN 0.4 WHEN 1 THEN 0.6 WHEN 2 THEN 0.8 ELSE 1.0 END AS DOUBLE)) AS weight FROM part GROUP BY 1, 2)"
SQL_PHENO = f"""{SQL_GENE_TERMS}, obs AS (SELECT subject_id, CAST(count_if(status = 'observed') AS BIGINT) AS n_observed FROM profile GROUP BY subject_id),
met_ AS (SELECT g.gene_key, p.subject_id, sum(CASE WHEN status = 'observed' THEN weight ELSE 0.0 END) AS matched, sum(CASE WHEN status = 'excluded' THEN weight ELSE 0.0 END) AS contradicted, CAST(count_if(status = 'observed') AS BIGINT) AS n_matched, count_if(status IN ('observed', 'excluded')) AS n_inf
  FROM gene_terms g JOIN profile p ON p.term = g.term GROUP BY 1, 2),
pheno AS (SELECT g.gene_key, s.subject_id, coalesce(matched, 0.0) AS matched, coalesce(contradicted, 0.0) AS contradicted, coalesce(n_matched, 0) AS n_matched, coalesce(n_observed, 0) AS n_observed,
  CASE WHEN coalesce(n_inf, 0) = 0 OR matched + contradicted = 0 THEN 0.5 ELSE round(0.5 * matched / (matched + contradicted) + 0.5 * CASE WHEN n_observed > 0 THEN n_matched / n_observed ELSE 0.5 END, 6) END AS score
  FROM (SELECT DISTINCT gene_key FROM gene_terms) g CROSS JOIN (SELECT DISTINCT subject_id FROM profile) s LEFT JOIN met_ m ON m.gene_key = g.gene_key AND m.subject_id = s.subject_id LEFT JOIN obs ON obs.subject_id = s.subject_id)"""
SQL_MECH = """chain_ AS (SELECT s_nationkey AS mechanism_id, s_suppkey AS node_id, lead(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS t FROM supplier),
means_ AS (SELECT mechanism_id, avg(CASE node_id % 3 WHEN 0 THEN 0.85 WHEN 1 THEN 0.6 ELSE 0.25 END) AS m, avg(CASE WHEN node_id % 2 = 0 THEN 1.0 ELSE 0.0 END) AS d, CAST(sum(CASE WHEN node_id % 2 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS inferred FROM chain_ WHERE t IS NOT NULL GROUP BY mechanism_id),
relevance AS (SELECT *, round(least(1.0, greatest(0.0, 0.55 * m + 0.45 * d - 0.05 * inferred)), 6) AS score FROM means_)"""
SQL_SCORED = f"""{SQL_PAIRS}, {SQL_PHENO}, {SQL_MECH},
one AS (SELECT *, CASE WHEN poor AND raw >= 0.9 THEN raw * 0.6 ELSE raw END AS validity,
    CAST(CASE WHEN max_af IS NULL THEN 0.5 WHEN max_af <= 1e-5 THEN 1.0 WHEN max_af <= 1e-4 THEN 1.0 - 0.2 * (log10(max_af) + 5) WHEN max_af <= 1e-3 THEN 0.8 - 0.3 * (log10(max_af) + 4)
      WHEN max_af <= 1e-2 THEN 0.5 - 0.35 * (log10(max_af) + 3) WHEN max_af <= 0.5 THEN 0.15 - 0.13 * (log10(max_af) + 2) / (log10(0.5) + 2) ELSE 0.02 END AS DOUBLE) AS rarity,
    CASE WHEN n_cons > 0 THEN least(1.0, CAST(CASE worst_rank WHEN 0 THEN 0.9 WHEN 1 THEN 0.5 WHEN 2 THEN 0.15 WHEN 3 THEN 0.05 ELSE 0.1 END AS DOUBLE) + CASE WHEN coalesce(any_lof, false) THEN 0.04 ELSE 0.0 END + 0.05 * coalesce(least(greatest((splice_ai - 0.5) / 0.5, 0.0), 1.0), 0.0) + 0.04 * coalesce(least(greatest((cadd - 20) / 15, 0.0), 1.0), 0.0) + 0.03 * coalesce(least(greatest((revel - 0.5) / 0.5, 0.0), 1.0), 0.0)) ELSE 0.1 END AS consequence,
    CASE WHEN (splice_ai IS NOT NULL)::INT + (cadd IS NOT NULL)::INT + (revel IS NOT NULL)::INT >= 2 THEN 1.0 ELSE 0.0 END AS predictors
  FROM (SELECT m.*, {_sql_validity('m')} AS raw FROM placed m) q),
both_ AS (SELECT k.*, k.id_b IS NOT NULL AS is_pair, coalesce(ph.score, 0.5) AS phenotype, coalesce(mr.score, 0.0) AS mechanism, (a.predictors + coalesce(b.predictors, a.predictors)) / 2 AS predictors, least(a.validity, b.validity) AS validity, least(a.rarity, b.rarity) AS rarity, least(a.consequence, b.consequence) AS consequence,
    CASE WHEN a.phase_set = b.phase_set AND a.hap_slot = b.hap_slot THEN 'cis_confirmed' WHEN a.phase_set = b.phase_set AND a.hap_slot <> b.hap_slot THEN 'trans_confirmed' ELSE 'unknown' END AS phase,
    CASE WHEN k.id_b IS NULL THEN CASE WHEN a.mosaic THEN 'mosaic' WHEN a.zygosity = 'hom_alt' THEN 'homozygous_recessive' ELSE 'unknown' END WHEN a.zygosity = 'het' AND b.zygosity = 'het' THEN 'compound_heterozygous' ELSE 'unknown' END AS model,
    (CASE WHEN a.max_af IS NOT NULL THEN 0.5 ELSE 0 END + CASE WHEN CASE WHEN k.id_b IS NULL THEN a.max_af ELSE b.max_af END IS NOT NULL THEN 0.5 ELSE 0 END) AS with_af,
    CASE WHEN coalesce(a.any_mane, false) OR coalesce(b.any_mane, false) THEN 1.0 WHEN a.n_cons > 0 OR b.n_cons > 0 THEN 0.5 ELSE 0.0 END AS ann,
    (CASE WHEN a.n_assertions IS NOT NULL THEN 0.5 ELSE 0 END + CASE WHEN CASE WHEN k.id_b IS NULL THEN a.n_assertions ELSE b.n_assertions END IS NOT NULL THEN 0.5 ELSE 0 END) AS clinical,
    (1 - CASE WHEN coalesce(a.max_af > 0.01, false) THEN 0.45 ELSE 0.0 END) * (1 - CASE WHEN coalesce(a.max_nhomalt > 0 AND a.max_af > 0.001, false) THEN 0.35 ELSE 0.0 END) * (1 - CASE WHEN a.poor THEN 0.3 ELSE 0.0 END) * (1 - CASE WHEN a.all_benign THEN 0.25 ELSE 0.0 END) AS left_a,
    (1 - CASE WHEN coalesce(b.max_af > 0.01, false) THEN 0.45 ELSE 0.0 END) * (1 - CASE WHEN coalesce(b.max_nhomalt > 0 AND b.max_af > 0.001, false) THEN 0.35 ELSE 0.0 END) * (1 - CASE WHEN b.poor THEN 0.3 ELSE 0.0 END) * (1 - CASE WHEN b.all_benign THEN 0.25 ELSE 0.0 END) AS left_b
  FROM kept k JOIN one a ON a.sample_id = k.sample_id AND a.gene_key = k.gene_key AND a.variant_id = k.id_a LEFT JOIN one b ON b.sample_id = k.sample_id AND b.gene_key = k.gene_key AND b.variant_id = k.id_b
  LEFT JOIN pheno ph ON ph.gene_key = k.gene_key AND concat('S', ph.subject_id) = k.sample_id LEFT JOIN relevance mr ON mr.mechanism_id = k.gene_key),
parts AS (SELECT *, (CASE model WHEN 'compound_heterozygous' THEN 1.0 WHEN 'homozygous_recessive' THEN 0.9 WHEN 'mosaic' THEN 0.5 ELSE CASE WHEN is_pair THEN 0.6 ELSE 0.2 END END) * CASE WHEN NOT is_pair THEN 1.0 ELSE CASE phase WHEN 'trans_confirmed' THEN 1.0 WHEN 'cis_confirmed' THEN 0.02 ELSE 0.55 END END AS inheritance,
    (with_af + ann + predictors + clinical + CASE WHEN phase <> 'unknown' THEN 1.0 ELSE 0.0 END + CASE WHEN is_pair THEN 1.0 ELSE 0.5 END) / 6 AS evidence,
    1 - CAST(left_a * left_b AS DOUBLE) * (1 - CASE WHEN model = 'compound_heterozygous' AND phase = 'cis_confirmed' THEN 0.6 ELSE 0.0 END) AS penalty FROM both_),
scored AS (SELECT *, concat('PAIR-', substr(sha256(CASE WHEN is_pair THEN concat(gene_key, '|', least(id_a, id_b), '|', greatest(id_a, id_b)) ELSE concat(gene_key, '|', id_a) END), 1, 16)) AS pair_id,
    floor(least(1.0, greatest(0.0, 0.20 * validity + 0.18 * rarity + 0.18 * consequence + 0.16 * inheritance + 0.14 * phenotype + 0.08 * mechanism + 0.06 * evidence - 0.25 * penalty)) * 1000000 + 0.500001) / 1000000 AS composite FROM parts),
ranks AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY composite DESC, co_a, pos_a, ref_a, alt_a, id_a, co_b NULLS FIRST, pos_b, ref_b, alt_b, id_b, pair_id) AS rank FROM scored)"""


def scored(v: Views) -> DataFrame:
    """Ranked pairs and single variants with all seven components; a sample's profile is the subject of its number."""
    df = candidates(v)
    profile = states(v).withColumn("sample_id", F.concat(F.lit("S"), F.col("subject_id").cast("string")))
    wanted = placed_calls(v).select("gene_key", F.substring("sample_id", 2, 9).cast("long").alias("subject_id")).distinct()
    phenotype = ontology.exact_scores(gene_terms(v), profile.drop("sample_id"), wanted).withColumn("sample_id", F.concat(F.lit("S"), F.col("subject_id").cast("string")))
    relevance = mechanism.relevance(graph(v)[2]).withColumnRenamed("mechanism_id", "gene_key")
    return pairs.ranked(pairs.score_pairs(stages.with_gene_scores(df, phenotype, relevance)), ["sample_id"])


@query("ranked_pairs", f"""WITH {SQL_SCORED} SELECT sample_id, CAST(rank AS INT) AS rank, pair_id, gene_key, id_a AS variant_a, id_b AS variant_b, model, phase, round(validity, 6) AS validity, round(rarity, 6) AS rarity, round(consequence, 6) AS consequence,
  round(inheritance, 6) AS inheritance, round(phenotype, 6) AS phenotype, round(mechanism, 6) AS mechanism, round(evidence, 6) AS evidence, round(penalty, 6) AS penalty, composite FROM ranks WHERE rank <= 10""")
def ranked_pairs(v: Views) -> DataFrame:
    """The ten most plausible candidates per sample, pairs and singles: C12, C19, E1, G1 to G9, G12 to G14, E7."""
    cols = [r6(c) for c in (*pairs.COMPONENTS, "penalty")]
    return scored(v).filter("rank <= 10").select("sample_id", "rank", "pair_id", "gene_key", F.col("a.variant_id").alias("variant_a"), F.col("b.variant_id").alias("variant_b"), "model", "phase", *cols, "composite")


@query("phase_and_models", f"WITH {SQL_SCORED} SELECT sample_id, model, phase, count(*) AS n, CAST(count_if(contradicted) AS BIGINT) AS n_contradicted, round(sum(composite), 3) AS composites FROM (SELECT *, penalty > 0.0001 AS contradicted FROM scored) q GROUP BY 1, 2, 3")
def phase_and_models(v: Views) -> DataFrame:
    """G12, G13 over all candidates."""
    return scored(v).groupBy("sample_id", "model", "phase").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("contradictions") > 0).alias("n_contradicted"), F.round(F.sum("composite"), 3).alias("composites"))


@query("subsumed_pairs", f"""WITH {SQL_PAIRS}, r AS (SELECT sample_id, row_number() OVER (PARTITION BY sample_id ORDER BY generated, gene_key, pair_place) AS rank, id_a, id_b, gene_key FROM kept)
SELECT x.sample_id, CAST(x.rank AS INT) AS rank, x.id_a AS variant_a, x.id_b AS variant_b FROM r x WHERE NOT EXISTS (SELECT 1 FROM r y WHERE y.sample_id = x.sample_id AND y.rank < x.rank AND (y.id_a = x.id_a OR coalesce(y.id_b = x.id_a, false)) AND (x.id_b IS NULL OR y.id_a = x.id_b OR coalesce(y.id_b = x.id_b, false)))""")
def subsumed_pairs(v: Views) -> DataFrame:
    """No row whose members a higher row has, a single variant under its pair included."""
    w = Window.partitionBy("sample_id").orderBy("generated", "gene_key", "pair_place")
    df = candidates(v).select("sample_id", F.row_number().over(w).alias("rank"), F.col("a.variant_id").alias("variant_a"), F.col("b.variant_id").alias("variant_b"))
    return pairs.not_subsumed(df.withColumn("members", F.array_compact(F.array("variant_a", "variant_b"))), ["sample_id"]).drop("members")


SQL_DISTINCT = f"""{SQL_SCORED}, left_ AS (SELECT x.*, row_number() OVER (PARTITION BY x.sample_id ORDER BY x.rank) AS n_ FROM ranks x WHERE NOT EXISTS (SELECT 1 FROM ranks y WHERE y.sample_id = x.sample_id AND y.gene_key = x.gene_key AND y.rank < x.rank
  AND (y.id_a = x.id_a OR coalesce(y.id_b = x.id_a, false)) AND (x.id_b IS NULL OR y.id_a = x.id_b OR coalesce(y.id_b = x.id_b, false))))"""


@query("submission", f"""WITH {SQL_DISTINCT}, top AS (SELECT sample_id, n_ AS rank, pair_id, CAST(round((0.01 + composite * 0.99) * 10000) AS BIGINT) AS u FROM left_ WHERE n_ <= 10),
w AS (SELECT *, rank - 1 AS i, count(*) OVER (PARTITION BY sample_id) AS n, min(u + 100 * (rank - 1)) OVER (PARTITION BY sample_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS low FROM top)
SELECT sample_id, CAST(rank AS INT) AS rank, pair_id, round((greatest(100 + 100 * (n - 1), least(10000, low)) - 100 * i) / 10000, 4) AS epcr FROM w""")
def submission(v: Views) -> DataFrame:
    """At most ten rows with separated values, none of them inside a higher one."""
    top = distinct_rows(v).filter("rank <= 10").withColumn("epcr", pairs.epcr(F.col("composite")))
    return pairs.separated(top, ["sample_id"]).select("sample_id", "rank", "pair_id", F.round("separated", 4).alias("epcr"))


def distinct_rows(v: Views) -> DataFrame:
    """The ranking without rows that a higher row contains, numbered anew."""
    left = pairs.not_subsumed(scored(v).select("sample_id", "rank", "pair_id", "gene_key", "members", "composite"), ["sample_id"])
    return left.withColumn("rank", F.row_number().over(Window.partitionBy("sample_id").orderBy("rank")))


@query("promoted_pairs")
def promoted_pairs(v: Views) -> DataFrame:
    """Supersets above their subsets, over every ranked row of each sample."""
    return pairs.promoted(distinct_rows(v), "sample_id").select("sample_id", "rank", "place", "promoted", "exchanged", joined("members"))


@query("submission_composed")
def submission_composed(v: Views) -> DataFrame:
    """E5 as composed: C13, then C20, then ten rows with separated values."""
    top = pairs.promoted(distinct_rows(v), "sample_id").filter("place <= 10").withColumn("epcr", pairs.epcr(F.col("composite")))
    return pairs.separated(top, ["sample_id"], order="place").select("sample_id", F.col("place").alias("rank"), "pair_id", F.round("separated", 4).alias("epcr"))


@query("open_questions", f"""WITH {SQL_SCORED}, q AS (
  SELECT s.sample_id, s.pair_id, s.phase, s.is_pair, s.model, a.max_af AS af_a, CASE WHEN s.is_pair THEN b.max_af ELSE a.max_af END AS af_b, a.poor OR coalesce(b.poor, false) AS poor, a.zygosity = 'hom_alt' OR coalesce(b.zygosity = 'hom_alt', false) AS hom, a.n_assertions IS NULL AND b.n_assertions IS NULL AS bare
  FROM scored s JOIN placed a ON a.sample_id = s.sample_id AND a.gene_key = s.gene_key AND a.variant_id = s.id_a LEFT JOIN placed b ON b.sample_id = s.sample_id AND b.gene_key = s.gene_key AND b.variant_id = s.id_b),
t AS (SELECT *, CASE WHEN is_pair AND phase = 'unknown' THEN 'segregation or long-read phasing' WHEN poor THEN 'orthogonal confirmation of the call' WHEN af_a IS NULL OR af_b IS NULL THEN 'frequency lookup in a further cohort'
  WHEN NOT is_pair AND model = 'unknown' THEN 'search for a second hit' WHEN phase = 'cis_confirmed' THEN 'parental segregation' WHEN hom THEN 'dosage or deletion test' ELSE 'functional assay' END AS next_test FROM q),
u AS (SELECT sample_id, next_test, unnest(list_filter([CASE WHEN is_pair AND phase = 'unknown' THEN 'phase_unknown' END, CASE WHEN NOT is_pair AND model = 'unknown' THEN 'single_hit_only' END, CASE WHEN af_a IS NULL OR af_b IS NULL THEN 'no_population_frequency' END, CASE WHEN poor THEN 'low_quality_call' END,
  CASE WHEN phase = 'cis_confirmed' THEN 'confirm_cis' END, CASE WHEN hom THEN 'true_homozygosity' END, CASE WHEN bare THEN 'no_clinical_curation' END], lambda x: x IS NOT NULL)) AS question FROM t)
SELECT sample_id, question, question IN ('phase_unknown', 'no_population_frequency', 'low_quality_call', 'single_hit_only') AS blocking, next_test, count(*) AS n FROM u GROUP BY 1, 2, 3, 4""")
def open_questions(v: Views) -> DataFrame:
    """Questions by the test that comes next."""
    return scored(v).select("sample_id", pairs.next_test(F.col("questions")).alias("next_test"), F.explode("questions").alias("q")).groupBy("sample_id", "q.question", "q.blocking", "next_test").agg(F.count(F.lit(1)).alias("n"))


SQL_GAPS = ", ".join(f"round(abs({c} - lead({c}) OVER w), 6) AS g_{c}" for c in pairs.COMPONENTS)
SQL_LARGEST = "CASE " + " ".join(f"WHEN g_{c} = gap THEN '{c}'" for c in pairs.COMPONENTS) + " END"
SQL_WEAKEST = "CASE " + " ".join(f"WHEN round({c}, 6) = weak THEN '{c}'" for c in pairs.COMPONENTS) + " END"


@query("discriminating_experiments", f"""WITH {SQL_SCORED}, nx AS (SELECT *, {SQL_GAPS}, lead(rank) OVER w AS next_ FROM ranks WINDOW w AS (PARTITION BY sample_id ORDER BY rank)),
g AS (SELECT *, greatest({", ".join(f"g_{c}" for c in pairs.COMPONENTS)}) AS gap, least({", ".join(f"round({c}, 6)" for c in pairs.COMPONENTS)}) AS weak FROM nx)
SELECT sample_id, CAST(rank AS INT) AS rank, gap, CASE WHEN next_ IS NOT NULL THEN {SQL_LARGEST} ELSE {SQL_WEAKEST} END AS experiment FROM g""")
def discriminating_experiments(v: Views) -> DataFrame:
    """The component with the largest gap to the next rank, and the gap; the last row names its weakest component."""
    df = scored(v).withColumns({c: F.col(c).cast("double") for c in pairs.COMPONENTS})
    return pairs.discriminating(df, ["sample_id"]).select("sample_id", "rank", "gap", "experiment")


@query("submission_violations", """
WITH r AS (SELECT o_custkey AS p, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_totalprice) AS row, concat('K', o_orderkey % 9) AS key, o_orderkey % 2 = 0 AS wide, round(o_totalprice / 400000, 2) AS epcr FROM orders),
s AS (SELECT *, lag(epcr) OVER (PARTITION BY p ORDER BY row) AS prev, count(*) OVER (PARTITION BY p, key) AS copies,
  CASE WHEN wide THEN coalesce(max(CASE WHEN NOT wide THEN 1 END) OVER (PARTITION BY p, key ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE 0 END AS below FROM r),
u AS (SELECT p, row, unnest(list_filter([CASE WHEN row > 10 THEN 'too_many_rows' END, CASE WHEN NOT epcr BETWEEN 0 AND 1 THEN 'epcr_out_of_range' END, CASE WHEN epcr > prev THEN 'epcr_not_decreasing' END, CASE WHEN epcr = prev THEN 'epcr_tie' END, CASE WHEN copies > 1 THEN 'duplicate_row' END,
  CASE WHEN below = 1 THEN 'superset_below_subset' END], lambda x: x IS NOT NULL)) AS rule FROM s)
SELECT p AS proband_id, CAST(row AS INT) AS row, rule FROM u""")
def submission_violations(v: Views) -> DataFrame:
    """Every order is a row of its customer's submission; even orders have a second member."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey", "o_totalprice")
    key = F.concat(F.lit("K"), (F.col("o_orderkey") % 9).cast("string"))
    rows = v["orders"].select(F.col("o_custkey").alias("proband_id"), F.row_number().over(w).alias("row"), key.alias("key"), F.round(F.col("o_totalprice") / 400000, 2).alias("epcr"), F.when(F.col("o_orderkey") % 2 == 0, F.array(key, F.lit("Z"))).otherwise(F.array(key)).alias("members"))
    return pairs.violations(rows)


@query("pair_flags", f"""WITH {SQL_SCORED} SELECT s.pair_id, s.sample_id, CASE s.phase WHEN 'cis_confirmed' THEN 'in_cis' WHEN 'trans_confirmed' THEN 'in_trans' ELSE 'phase_unknown' END AS phase_flag, NOT s.is_pair AS single, coalesce(a.zygosity <> b.zygosity, false) AS mixed, CASE WHEN a.contig = b.contig THEN abs(b.position - a.position) ELSE -1 END AS distance_bp
FROM scored s JOIN placed a ON a.sample_id = s.sample_id AND a.gene_key = s.gene_key AND a.variant_id = s.id_a LEFT JOIN placed b ON b.sample_id = s.sample_id AND b.gene_key = s.gene_key AND b.variant_id = s.id_b""")
def pair_flags(v: Views) -> DataFrame:
    """O18, of all candidates; -1 where there is no distance (other contigs, singles)."""
    df = stages.pair_flags(scored(v))
    has = lambda x: F.array_contains("pair_flags", x)
    phase = F.when(has("in_cis"), "in_cis").when(has("in_trans"), "in_trans").otherwise("phase_unknown")
    return df.select("pair_id", "sample_id", phase.alias("phase_flag"), has("single_variant").alias("single"), has("mixed_zygosity").alias("mixed"), F.coalesce("distance_bp", F.lit(-1)).alias("distance_bp"))


@query("cap_events", f"WITH {SQL_PAIRS} SELECT sample_id, gene_key, max(n_variants) AS n_variants, max(generated) AS generated, count(*) AS kept FROM kept GROUP BY 1, 2 HAVING max(n_variants) > 24 OR max(generated) > 20")
def cap_events(v: Views) -> DataFrame:
    """E4, O19."""
    return stages.cap_warnings(candidates(v), ["sample_id", "gene_key"])


@query("component_evidence", f"""WITH {SQL_SCORED}, u AS (SELECT pair_id, unnest(['validity', 'rarity', 'consequence', 'inheritance', 'phenotype', 'mechanism', 'evidence']) AS component, unnest([round(validity, 6), round(rarity, 6), round(consequence, 6), round(inheritance, 6), round(phenotype, 6), round(mechanism, 6), round(evidence, 6)]) AS score FROM scored)
SELECT component, CASE WHEN score > 0.5 THEN 'supports' WHEN score < 0.5 THEN 'contradicts' ELSE 'neutral' END AS direction, count(*) AS n FROM u GROUP BY 1, 2""")
def component_evidence(v: Views) -> DataFrame:
    """Seven items per pair, counted by direction."""
    rounded = scored(v).withColumns({c: F.round(F.col(c).cast("double"), 6) for c in pairs.COMPONENTS})
    return stages.component_evidence(rounded).groupBy(F.col("payload")["component"].alias("component"), "direction").agg(F.count(F.lit(1)).alias("n"))


@query("dossier_answers")
def dossier_answers(v: Views) -> DataFrame:
    """Nine answers for each of the ten first pairs of a sample."""
    return stages.answers(scored(v).filter("rank <= 10"))


@query("truncation_notice")
def truncation_notice(v: Views) -> DataFrame:
    """O35."""
    r = tables.cut(distinct_rows(v))
    lifted = tables.cut(pairs.promoted(r, "sample_id"))
    return stages.truncation_notice(r, lifted.filter("place <= 10"), lifted)


@query("run_warnings", f"""WITH {SQL_TRIAGED}, g AS (SELECT avg(CASE WHEN n_cons = 0 THEN 1.0 ELSE 0.0 END) AS a, avg(CASE WHEN triage LIKE 'kept%' THEN CASE WHEN max_af IS NULL THEN 1.0 ELSE 0.0 END END) AS b, avg(CASE WHEN triage LIKE 'kept%' THEN 0.0 ELSE 1.0 END) AS c, avg(CASE WHEN n_assertions IS NULL THEN 1.0 ELSE 0.0 END) AS d FROM judged)
SELECT 'no_consequence' AS code, round(a, 6) AS share FROM g WHERE a > 0 UNION ALL SELECT 'no_frequency', round(b, 6) FROM g WHERE b > 0 UNION ALL SELECT 'below_bar', round(c, 6) FROM g WHERE c > 0 UNION ALL SELECT 'no_clinical_source', round(d, 6) FROM g WHERE d > 0""")
def run_warnings(v: Views) -> DataFrame:
    """D-5, O5."""
    return stages.run_warnings(annotated(v)).select("code", "share")


@query("predictor_accounting", """WITH q AS (SELECT DISTINCT site_key FROM calls), p AS (SELECT site_key, min(CASE WHEN impact IS NOT NULL THEN 0 ELSE 2 END) AS k FROM consequences GROUP BY site_key)
SELECT CASE WHEN q.site_key % 50 = 0 THEN 'skipped' WHEN k = 0 THEN 'annotated' WHEN k = 2 THEN 'incomplete' ELSE 'without_annotation' END AS state, count(*) AS n FROM q LEFT JOIN p ON p.site_key = q.site_key GROUP BY 1""")
def predictor_accounting(v: Views) -> DataFrame:
    """O9, O10."""
    ids = v["calls"].select(F.col("site_key").alias("variant_id")).distinct()
    seen = v["consequences"].select(F.col("site_key").alias("variant_id"), F.when(F.col("impact").isNotNull(), "ok").otherwise("incomplete").alias("verdict"))
    return stages.predictor_accounting(ids, seen, ids.filter("variant_id % 50 = 0"))


@query("named_terms", f"SELECT site_key, arg_min(term, concat(CASE WHEN term IN ({LOF}) THEN '0' ELSE '1' END, term)) AS term FROM (SELECT site_key, unnest(string_split(terms, '&')) AS term FROM consequences WHERE impact = 'low') q GROUP BY site_key")
def named_terms(v: Views) -> DataFrame:
    """O21."""
    return stages.named_term(v["consequences"], "site_key", "low")


@query("normalise_stage")
def normalise_stage(v: Views) -> DataFrame:
    """O1, B14, B16, D-10: insertions built on calls, against a reference whose blocks are made from the documents' letters."""
    contig = F.concat(F.lit("chr"), (1 + F.col("doc_id") % 22).cast("string"))
    letters = F.translate(F.regexp_replace(F.upper("text"), "[^A-Z]", ""), "BDEFHIJKLMNOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTAC")
    first = v["documents"].groupBy(contig.alias("contig")).agg(F.min_by(letters, F.struct((-F.length("text")).alias("n"), "doc_id")).alias("seq"))
    lengths = first.select("contig", F.length("seq").alias("size"))
    blocks = stages.reference_blocks(first)
    at = v["calls"].select("contig", "position", "alt").distinct().join(lengths, "contig").withColumn("position", F.pmod("position", F.greatest(F.col("size") - 10, F.lit(1))) + 1)
    bases = stages.with_flank(at.withColumn("ref", F.lit("A")), blocks)
    ins = bases.filter("ref_seen <> ''").select("contig", "position", F.col("ref_seen").alias("ref"), F.concat("ref_seen", F.substring("flank", -1, 1), F.substring("flank", -1, 1)).alias("alt"))
    return stages.normalised(ins.distinct(), blocks).groupBy("status", F.array_join("ops", ",").alias("ops"), "reference_matches").agg(F.count(F.lit(1)).alias("n"), F.sum("position").alias("positions"))


# ---- windows, islands, knowledge, sets -------------------------------------------------------------------------------------


@query("query_regions", f"""WITH {SQL_SITES}, s AS (SELECT contig, position AS a, position + length(ref) - 1 AS b FROM sites),
m AS (SELECT *, CASE WHEN max(b) OVER (PARTITION BY contig ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= a - 200 THEN 0 ELSE 1 END AS new FROM s),
i AS (SELECT *, sum(new) OVER (PARTITION BY contig ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT contig, CAST(island AS BIGINT) AS island, min(a) AS start, max(b) AS "end", count(*) AS n_spans FROM i GROUP BY contig, island""")
def query_regions(v: Views) -> DataFrame:
    """Spans closer than 200 bases merged."""
    return tables.islands(sites(v), ["contig"], "position", "end", 200)


@query("event_batches", """
WITH j AS (SELECT *, CASE WHEN date_diff('microsecond', lag(ts) OVER w, ts) > 3600000000 THEN 1 ELSE 0 END AS jump FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(jump) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS batch FROM j)
SELECT user_id, CAST(batch AS BIGINT) AS batch, count(*) AS n FROM b GROUP BY user_id, batch""")
def event_batches(v: Views) -> DataFrame:
    """A new batch where the gap to the row before is over an hour."""
    df = v["events"].withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return tables.gap_batches(df, ["user_id"], ["ts", "event_id"], "us", 3_600_000_000).groupBy("user_id", "batch").agg(F.count(F.lit(1)).alias("n"))


@query("unsorted_rows", """
SELECT user_id, count(*) AS n FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS last_value FROM events) q WHERE value < last_value GROUP BY user_id""")
def unsorted_rows(v: Views) -> DataFrame:
    """Rows that go backwards."""
    return tables.unsorted_rows(v["events"], ["user_id"], "event_id", ["value"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("representative_transcript", """
SELECT gene, transcript FROM (SELECT p_partkey % 97 AS gene, concat('T', p_partkey) AS transcript, row_number() OVER (PARTITION BY p_partkey % 97 ORDER BY (p_size % 5 = 0) DESC, (p_size % 2 = 0) DESC, concat('T', p_partkey)) AS rn FROM part) q WHERE rn = 1""")
def representative_transcript(v: Views) -> DataFrame:
    """E12, E14, A17."""
    rows = v["part"].select((F.col("p_partkey") % 97).alias("gene"), F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("transcript"), (F.col("p_size") % 5 == 0).alias("mane_select"), (F.col("p_size") % 2 == 0).alias("canonical"))
    return knowledge.representative(rows).select("gene", "transcript")


CLASSES = ["definitive", "strong", "moderate", "limited", "supporting", "disputed", "refuted"]


@query("best_validity", """
WITH r AS (SELECT p_partkey % 211 AS gene, CAST(p_size % 7 AS INT) AS k, p_brand AS panel FROM part)
SELECT gene, CASE k WHEN 0 THEN 'definitive' WHEN 1 THEN 'strong' WHEN 2 THEN 'moderate' WHEN 3 THEN 'limited' WHEN 4 THEN 'supporting' WHEN 5 THEN 'disputed' ELSE 'refuted' END AS classification, panel,
  CAST(CASE k WHEN 0 THEN 1.0 WHEN 1 THEN 0.8 WHEN 2 THEN 0.6 WHEN 3 THEN 0.4 WHEN 4 THEN 0.4 WHEN 5 THEN 0.2 ELSE 0.1 END AS DOUBLE) AS weight
FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY k, panel) AS rn FROM r) q WHERE rn = 1""")
def best_validity(v: Views) -> DataFrame:
    """E11, E13, B34, A18."""
    rows = v["part"].select((F.col("p_partkey") % 211).alias("gene"), F.get(F.array(*[F.lit(c) for c in CLASSES]), F.col("p_size") % 7).alias("classification"), F.col("p_brand").alias("panel"))
    return knowledge.best_validity(rows).withColumn("weight", rules.association_weight(F.col("classification")))


SQL_SLICES = """s AS (SELECT o_custkey % 20 AS g, o_custkey AS key, row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY max(o_totalprice) DESC, o_custkey) AS rank FROM orders WHERE o_orderkey % 3 <> 1 GROUP BY o_custkey),
p AS (SELECT o_custkey % 20 AS g, o_custkey AS key, row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY min(o_totalprice) DESC, o_custkey) AS rank FROM orders WHERE o_orderkey % 3 <> 2 GROUP BY o_custkey)"""


def slices(v: Views) -> tuple[DataFrame, DataFrame]:
    """Two rankings of customers in twenty groups; every order counts for one of them at least."""

    def one(rows: DataFrame, f: Callable) -> DataFrame:
        g = rows.groupBy(F.col("o_custkey").alias("key")).agg(f("o_totalprice").alias("x")).withColumn("g", F.col("key") % 20)
        return g.select("g", "key", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("x"), "key")).alias("rank"))

    return one(v["orders"].filter("o_orderkey % 3 <> 1"), F.max), one(v["orders"].filter("o_orderkey % 3 <> 2"), F.min)


@query("ranking_overlap", f"""WITH {SQL_SLICES}, m AS (SELECT coalesce(s.g, p.g) AS g, s.rank AS a, p.rank AS b FROM s FULL OUTER JOIN p ON s.g = p.g AND s.key = p.key),
c AS (SELECT g, CAST(count_if(a IS NOT NULL AND b IS NOT NULL) AS BIGINT) AS n_both, CAST(count_if(b IS NULL) AS BIGINT) AS n_submitted_only, CAST(count_if(a IS NULL) AS BIGINT) AS n_produced_only, CAST(count_if(a <> b) AS BIGINT) AS n_moved FROM m GROUP BY g)
SELECT *, CASE WHEN n_both = 0 THEN 'disjoint' WHEN n_submitted_only + n_produced_only > 0 AND n_moved > 0 THEN 'differs' WHEN n_submitted_only + n_produced_only > 0 THEN 'partial' WHEN n_moved > 0 THEN 'reordered' ELSE 'identical' END AS verdict FROM c""")
def ranking_overlap(v: Views) -> DataFrame:
    """F2."""
    return compare.overlap(*slices(v), "g")


@query("top_k_agreement", f"WITH {SQL_SLICES} SELECT s.g, k.k, CAST(count_if(s.rank <= k.k AND p.rank <= k.k) AS BIGINT) AS n_agree FROM s JOIN p ON s.g = p.g AND s.key = p.key CROSS JOIN (SELECT unnest([1, 3, 5, 10]) AS k) k GROUP BY s.g, k.k")
def top_k_agreement(v: Views) -> DataFrame:
    """F3."""
    return compare.top_k_agreement(*slices(v), "g")


@query("rank_correlation", f"""WITH {SQL_SLICES}, r AS (SELECT s.g, row_number() OVER (PARTITION BY s.g ORDER BY s.rank, s.key) - row_number() OVER (PARTITION BY s.g ORDER BY p.rank, s.key) AS d FROM s JOIN p ON s.g = p.g AND s.key = p.key)
SELECT g, count(*) AS n, CASE WHEN count(*) >= 2 THEN round(1 - 6 * sum(CAST(d * d AS DOUBLE)) / (count(*) * (count(*) * count(*) - 1)), 6) END AS rho FROM r GROUP BY g""")
def rank_correlation(v: Views) -> DataFrame:
    """F4."""
    return compare.spearman(*slices(v), "g")


@query("evaluation_points", f"""WITH {SQL_SLICES} SELECT g, CAST(sum(CASE WHEN rank = 1 THEN 100.0 WHEN rank <= 3 THEN 50.0 WHEN rank <= 5 THEN 25.0 WHEN rank <= 10 THEN 10.0 ELSE 0.0 END * CASE WHEN key % 2 = 0 THEN 0.5 ELSE 1.0 END) AS DOUBLE) AS points FROM s GROUP BY g""")
def evaluation_points(v: Views) -> DataFrame:
    """J12, points."""
    s, _ = slices(v)
    return s.groupBy("g").agg(F.sum(compare.rank_points(F.col("rank"), F.col("key") % 2 == 0)).alias("points"))


@query("evaluation_f_max", """
WITH r AS (SELECT o_custkey % 30 AS g, round(o_totalprice / 1000, 0) AS score, o_orderstatus = 'F' AS truth FROM orders),
l AS (SELECT g, score, count(*) AS n, sum(CAST(truth AS INT)) AS hits FROM r GROUP BY g, score), t AS (SELECT g, sum(CAST(truth AS INT)) AS total FROM r GROUP BY g),
c AS (SELECT l.g, sum(n) OVER w AS n, sum(hits) OVER w AS hits, total FROM l JOIN t ON t.g = l.g WINDOW w AS (PARTITION BY l.g ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT g, round(max(2.0 * CAST(hits AS DOUBLE) / CAST(n + total AS DOUBLE)), 6) AS f_max FROM c GROUP BY g""")
def evaluation_f_max(v: Views) -> DataFrame:
    """J12, F over all thresholds."""
    rows = v["orders"].select((F.col("o_custkey") % 30).alias("g"), F.round(F.col("o_totalprice") / 1000, 0).alias("score"), (F.col("o_orderstatus") == "F").alias("truth"))
    return compare.f_max(rows, "g")


@query("citation_mismatches", """
WITH w AS (SELECT c_custkey AS pmid, c_mktsegment AS author, c_nationkey AS year, 'J' AS journal, c_name AS title FROM customer WHERE c_custkey % 3 <> 0),
k AS (SELECT c_custkey AS pmid, CASE WHEN c_custkey % 7 = 0 THEN 'X' ELSE c_mktsegment END AS author, CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE c_nationkey END AS year, 'J' AS journal, CASE WHEN c_custkey % 13 = 0 THEN 'T' ELSE c_name END AS title FROM customer WHERE c_custkey % 5 <> 0),
m AS (SELECT coalesce(w.pmid, k.pmid) AS pmid, unnest(list_filter([CASE WHEN k.pmid IS NULL THEN 'not_in_ledger' END, CASE WHEN w.pmid IS NULL THEN 'never_written' END, CASE WHEN w.author <> k.author THEN 'author_differs' END,
  CASE WHEN w.year <> k.year THEN 'year_differs' END, CASE WHEN w.title <> k.title THEN 'title_differs' END], lambda x: x IS NOT NULL)) AS kind FROM w FULL OUTER JOIN k ON w.pmid = k.pmid)
SELECT pmid, kind FROM m""")
def citation_mismatches(v: Views) -> DataFrame:
    """C17."""
    base = v["customer"].select(F.col("c_custkey").alias("pmid"), F.col("c_mktsegment").alias("author"), F.col("c_nationkey").alias("year"), F.lit("J").alias("journal"), F.col("c_name").alias("title"))
    spoilt = lambda n, c, x: F.when(F.col("pmid") % n == 0, x).otherwise(F.col(c)).alias(c)
    return compare.citation_mismatches(base.filter("pmid % 3 <> 0"), base.filter("pmid % 5 <> 0").select("pmid", spoilt(7, "author", "X"), spoilt(11, "year", 0), "journal", spoilt(13, "title", "T")))


# ---- ontology --------------------------------------------------------------------------------------------------------------

SQL_CLOSURE = """edges_ AS (SELECT * FROM onto_edges),
closure AS (SELECT term, term AS ancestor FROM (SELECT child AS term FROM edges_ UNION SELECT parent FROM edges_) t UNION SELECT c.term, e.parent FROM closure c JOIN edges_ e ON e.child = c.ancestor)"""
SQL_CORPUS = "corpus AS (SELECT DISTINCT o_orderkey % 300 AS entity, o_custkey AS term FROM orders WHERE o_custkey > 3)"
SQL_IC = f"""{SQL_CORPUS}, ic AS (SELECT c.ancestor AS term, count(DISTINCT k.entity) AS n_entities, -ln(count(DISTINCT k.entity) / (SELECT CAST(count(DISTINCT entity) AS DOUBLE) FROM corpus)) AS ic FROM corpus k JOIN closure c ON c.term = k.term GROUP BY c.ancestor)"""
SQL_STATES = """up AS (SELECT subject_id, c.ancestor AS term, 'observed' AS status, CASE WHEN c.ancestor = c.term THEN 0 ELSE 1 END AS place FROM profile p JOIN closure c ON c.term = p.term WHERE status = 'observed'),
down AS (SELECT subject_id, c.term, 'excluded' AS status, CASE WHEN c.ancestor = c.term THEN 0 ELSE 2 END AS place FROM profile p JOIN closure c ON c.ancestor = p.term WHERE status = 'excluded'),
states AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, term ORDER BY place, status) AS rn FROM (SELECT * FROM up UNION ALL SELECT * FROM down UNION ALL SELECT subject_id, term, status, 3 FROM profile WHERE status NOT IN ('observed', 'excluded')) u) q WHERE rn = 1)"""


def closure(v: Views) -> DataFrame:
    return ontology.ancestor_closure(v["onto_edges"])


def corpus(v: Views) -> DataFrame:
    return v["orders"].filter("o_custkey > 3").select((F.col("o_orderkey") % 300).alias("entity"), F.col("o_custkey").alias("term")).distinct()


def gene_terms(v: Views) -> DataFrame:
    weight = F.get(F.array(F.lit(0.4), F.lit(0.6), F.lit(0.8), F.lit(1.0)), F.col("p_size") % 4)
    return v["part"].groupBy((F.col("p_partkey") % 100).alias("gene_key"), (4 + F.col("p_partkey") * 11 % 140).alias("term")).agg(F.max(weight).alias("weight"))


def states(v: Views) -> DataFrame:
    return ontology.reconciled(v["profile"])


@query("ontology_closure", f"WITH RECURSIVE {SQL_CLOSURE} SELECT term, ancestor FROM closure")
def ontology_closure(v: Views) -> DataFrame:
    """H2."""
    return closure(v)


@query("information_content", f"WITH RECURSIVE {SQL_CLOSURE}, {SQL_IC} SELECT term, n_entities, round(ic, 6) + 0.0 AS ic FROM ic")
def information_content(v: Views) -> DataFrame:
    """H4."""
    return ontology.information_content(corpus(v), None, v["onto_edges"]).select("term", "n_entities", (F.round("ic", 6) + 0.0).alias("ic"))


@query("profile_propagation", f"WITH RECURSIVE {SQL_CLOSURE}, {SQL_STATES} SELECT subject_id, term, status, CASE WHEN place IN (0, 3) THEN 'recorded' ELSE 'implied' END AS origin FROM states")
def profile_propagation(v: Views) -> DataFrame:
    """H1, H3, O25."""
    return ontology.propagated(states(v), closure(v))


@query("profile_conflicts", f"WITH RECURSIVE {SQL_CLOSURE}, {SQL_STATES} SELECT DISTINCT up.subject_id, up.term FROM up JOIN down ON down.subject_id = up.subject_id AND down.term = up.term")
def profile_conflicts(v: Views) -> DataFrame:
    """F5."""
    return ontology.conflicts(states(v), closure(v))


SQL_SIMS = f"""{SQL_IC}, tp AS (SELECT DISTINCT 1 + p_partkey % 140 AS a, 1 + p_partkey * 13 % 139 AS b FROM part),
com AS (SELECT tp.a, tp.b, x.ancestor, ic.ic, row_number() OVER (PARTITION BY tp.a, tp.b ORDER BY ic.ic DESC, x.ancestor) AS rn FROM tp JOIN closure x ON x.term = tp.a JOIN closure y ON y.term = tp.b AND y.ancestor = x.ancestor JOIN ic ON ic.term = x.ancestor),
sims AS (SELECT c.a, c.b, c.ancestor AS mica, CASE WHEN c.a = c.b THEN 1.0 WHEN (SELECT max(ic) FROM ic) > 0 THEN c.ic / (SELECT max(ic) FROM ic) END AS resnik,
  CASE WHEN c.a = c.b THEN 1.0 WHEN ia.ic + ib.ic > 0 THEN 2 * c.ic / (ia.ic + ib.ic) WHEN ia.ic + ib.ic IS NOT NULL THEN 0.0 END AS lin,
  CASE WHEN c.a = c.b THEN 1.0 WHEN ia.ic + ib.ic IS NOT NULL THEN 1 / (1 + greatest(0.0, ia.ic + ib.ic - 2 * c.ic)) END AS jc
  FROM com c LEFT JOIN ic ia ON ia.term = c.a LEFT JOIN ic ib ON ib.term = c.b WHERE c.rn = 1)"""


@query("term_similarity", f"WITH RECURSIVE {SQL_CLOSURE}, {SQL_SIMS} SELECT a, b, mica, round(resnik, 5) AS resnik, round(lin, 5) AS lin, round(jc, 5) AS jc FROM sims")
def term_similarity(v: Views) -> DataFrame:
    """H5: Resnik, Lin and Jiang-Conrath by the most informative common ancestor."""
    c = closure(v)
    ic = tables.cut(ontology.information_content(corpus(v), c, v["onto_edges"]))
    tp = v["part"].select((1 + F.col("p_partkey") % 140).alias("a"), (1 + F.col("p_partkey") * 13 % 139).alias("b")).distinct()
    s = ontology.similarity(tp, c, ic)
    jc = F.when((F.col("a") == F.col("b")) | F.col("lin").isNotNull(), F.round("jc", 5))
    return s.select("a", "b", "mica", F.round("resnik", 5).alias("resnik"), F.round("lin", 5).alias("lin"), jc.alias("jc"))


@query("phenotype_scores", f"WITH {SQL_PHENO} SELECT gene_key, subject_id, round(matched, 6) AS matched, round(contradicted, 6) AS contradicted, n_matched, n_observed, score FROM pheno")
def phenotype_scores(v: Views) -> DataFrame:
    """C11, D-12, H7, H9."""
    return ontology.exact_scores(gene_terms(v), states(v)).select("gene_key", "subject_id", r6("matched"), r6("contradicted"), "n_matched", "n_observed", "score")


@query("unexplained_terms", f"WITH {SQL_GENE_TERMS} SELECT subject_id, term FROM profile WHERE status = 'observed' AND term NOT IN (SELECT term FROM gene_terms)")
def unexplained_terms(v: Views) -> DataFrame:
    """C11, the other side; H11."""
    return ontology.unexplained(gene_terms(v), states(v)).select("subject_id", "term")


SQL_ONTO_SCORES = f"""{SQL_CLOSURE}, {SQL_IC}, {SQL_STATES}, {SQL_GENE_TERMS},
q_ AS (SELECT subject_id, term AS a FROM profile WHERE status = 'observed'), g_ AS (SELECT gene_key, term AS b FROM gene_terms),
com_ AS (SELECT x.term AS a, y.term AS b, max(ic.ic) AS mica FROM closure x JOIN closure y ON y.ancestor = x.ancestor JOIN ic ON ic.term = x.ancestor WHERE x.term IN (SELECT a FROM q_) AND y.term IN (SELECT b FROM g_) GROUP BY 1, 2),
lin_ AS (SELECT c.a, c.b, CASE WHEN c.a = c.b THEN 1.0 WHEN ia.ic + ib.ic > 0 THEN 2 * c.mica / (ia.ic + ib.ic) WHEN ia.ic + ib.ic IS NOT NULL THEN 0.0 END AS lin FROM com_ c LEFT JOIN ic ia ON ia.term = c.a LEFT JOIN ic ib ON ib.term = c.b),
fore_ AS (SELECT subject_id, gene_key, avg(sim) AS bma FROM (SELECT q_.subject_id, g_.gene_key, q_.a, max(lin) AS sim FROM q_ JOIN lin_ s ON s.a = q_.a AND lin IS NOT NULL JOIN g_ ON g_.b = s.b GROUP BY 1, 2, 3) t GROUP BY 1, 2),
back_ AS (SELECT subject_id, gene_key, avg(sim) AS bma FROM (SELECT q_.subject_id, g_.gene_key, g_.b, max(lin) AS sim FROM q_ JOIN lin_ s ON s.a = q_.a AND lin IS NOT NULL JOIN g_ ON g_.b = s.b GROUP BY 1, 2, 3) t GROUP BY 1, 2),
most_ AS (SELECT max(ic) AS most FROM ic),
w_ AS (SELECT t.gene_key, t.term, weight * CASE WHEN most > 0 THEN coalesce(ic.ic / most, 1.0) ELSE 1.0 END AS w FROM gene_terms t CROSS JOIN most_ LEFT JOIN ic ON ic.term = t.term),
m_ AS (SELECT w_.gene_key, s.subject_id, sum(CASE WHEN status = 'observed' THEN w ELSE 0.0 END) AS m, sum(CASE WHEN status = 'excluded' THEN w ELSE 0.0 END) AS x FROM w_ JOIN states s ON s.term = w_.term GROUP BY 1, 2),
rows_ AS (SELECT g.gene_key, s.subject_id, coalesce(CASE WHEN m + x > 0 THEN m / (m + x) END, 0.5) AS spec, f.bma AS fore, b.bma AS back FROM (SELECT DISTINCT gene_key FROM gene_terms) g CROSS JOIN (SELECT DISTINCT subject_id FROM profile) s
  LEFT JOIN m_ ON m_.gene_key = g.gene_key AND m_.subject_id = s.subject_id LEFT JOIN fore_ f ON f.gene_key = g.gene_key AND f.subject_id = s.subject_id LEFT JOIN back_ b ON b.gene_key = g.gene_key AND b.subject_id = s.subject_id)"""
SQL_BAND = "CASE WHEN score >= 0.85 THEN 'strong' WHEN score >= 0.65 THEN 'moderate' WHEN score >= 0.40 THEN 'supporting' ELSE 'weak' END"


def onto_scores(v: Views, symmetric: bool) -> DataFrame:
    c = tables.cut(closure(v))
    ic = tables.cut(ontology.information_content(corpus(v), c, v["onto_edges"]))
    out = ontology.ontology_scores(gene_terms(v), tables.cut(states(v)), c, ic, symmetric=symmetric)
    return out.withColumn("band", ontology.band(F.col("score")))


@query("phenotype_scores_ontology", f"WITH RECURSIVE {SQL_ONTO_SCORES} SELECT gene_key, subject_id, score, {SQL_BAND} AS band FROM (SELECT *, round(0.5 * spec + 0.5 * coalesce(fore, 0.5), 6) AS score FROM rows_) q")
def phenotype_scores_ontology(v: Views) -> DataFrame:
    """Information-weighted scores with best-match averages through informative ancestors."""
    return onto_scores(v, False)


@query("phenotype_scores_symmetric", f"WITH RECURSIVE {SQL_ONTO_SCORES} SELECT gene_key, subject_id, score, {SQL_BAND} AS band FROM (SELECT *, round(0.5 * spec + 0.5 * coalesce((fore + back) / 2, fore, back, 0.5), 6) AS score FROM rows_) q")
def phenotype_scores_symmetric(v: Views) -> DataFrame:
    """H6: as above, with the average of both sides' best matches."""
    return onto_scores(v, True)


# ---- mechanism and drugs -----------------------------------------------------------------------------------------------------


def graph(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mechanisms, nodes and links shaped from nations and suppliers: a mechanism per nation, a node per supplier."""
    state = F.get(F.array(F.lit("decrease"), F.lit("increase"), F.lit("loss_of_function"), F.lit("unknown")), (F.col("s_suppkey") % 4).cast("int"))
    nodes = v["supplier"].select(F.col("s_nationkey").alias("mechanism_id"), F.col("s_suppkey").alias("node_id"), F.col("s_name").alias("label"), F.when(F.col("s_suppkey") % 6 == 0, "mitotic checkpoint").when(F.col("s_suppkey") % 10 == 3, "brain growth").otherwise("node").alias("description"), state.alias("state_in_patient"))
    target = nodes.groupBy("mechanism_id").agg(F.min("node_id").alias("therapeutic_target_node_id"), F.min_by("state_in_patient", "node_id").alias("s_"))
    mechanisms = target.join(v["nation"].select(F.col("n_nationkey").alias("mechanism_id"), F.col("n_name").alias("summary")), "mechanism_id").withColumn("required_correction", mechanism.corrective(F.col("s_"))).drop("s_")
    w = Window.partitionBy("mechanism_id").orderBy("node_id")
    strength = F.get(F.array(F.lit("strong"), F.lit("moderate"), F.lit("weak")), (F.col("node_id") % 3).cast("int"))
    links = nodes.withColumn("target_node_id", F.lead("node_id").over(w)).filter("target_node_id IS NOT NULL").select("mechanism_id", F.col("node_id").alias("link_id"), F.col("node_id").alias("source_node_id"), "target_node_id", strength.alias("strength"), (F.col("node_id") % 2 == 0).alias("demonstrated"))
    return mechanisms, nodes, links


SQL_GRAPH = """nodes AS (SELECT s_nationkey AS mechanism_id, s_suppkey AS node_id, CASE WHEN s_suppkey % 6 = 0 THEN 'mitotic checkpoint' WHEN s_suppkey % 10 = 3 THEN 'brain growth' ELSE 'node' END AS description,
  CASE s_suppkey % 4 WHEN 0 THEN 'decrease' WHEN 1 THEN 'increase' WHEN 2 THEN 'loss_of_function' ELSE 'unknown' END AS state FROM supplier),
mech AS (SELECT mechanism_id, min(node_id) AS target, bool_or(description = 'mitotic checkpoint') AS cin, bool_or(description = 'brain growth') AS neuro FROM nodes GROUP BY mechanism_id),
fix AS (SELECT *, CASE state WHEN 'decrease' THEN 'increase' WHEN 'increase' THEN 'decrease' WHEN 'loss_of_function' THEN 'restore' ELSE 'unknown' END AS corrective FROM nodes)"""


@query("mechanism_relevance", f"""WITH {SQL_GRAPH}, l AS (SELECT mechanism_id, node_id, lead(node_id) OVER (PARTITION BY mechanism_id ORDER BY node_id) AS t FROM nodes),
g AS (SELECT mechanism_id, avg(CASE node_id % 3 WHEN 0 THEN 0.85 WHEN 1 THEN 0.6 ELSE 0.25 END) AS m, avg(CASE WHEN node_id % 2 = 0 THEN 1.0 ELSE 0.0 END) AS d, CAST(sum(CASE WHEN node_id % 2 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS inferred FROM l WHERE t IS NOT NULL GROUP BY mechanism_id)
SELECT mechanism_id, round(m, 6) AS mean_strength, round(d, 6) AS share, inferred, round(least(1.0, greatest(0.0, 0.55 * m + 0.45 * d - 0.05 * inferred)), 6) AS score FROM g""")
def mechanism_relevance(v: Views) -> DataFrame:
    """D-13, G6."""
    return mechanism.relevance(graph(v)[2]).select("mechanism_id", r6("mean_strength"), r6("share"), "inferred", "score")


def agents(v: Views) -> DataFrame:
    """A catalogue shaped from parts: an agent per part, aimed at a supplier's node."""
    k = F.col("p_partkey")
    pick = lambda n, xs: F.get(F.array(*[F.lit(x) for x in xs]), (k % n).cast("int"))
    node = v["supplier"].select(F.col("s_suppkey").alias("s_"), F.col("s_nationkey").alias("mechanism_id"))
    n = v["supplier"].agg(F.count(F.lit(1)).alias("n_"))
    base = v["part"].crossJoin(F.broadcast(n)).withColumn("s_", k * 7 % F.col("n_")).join(node, "s_")
    return base.select(
        k.alias("drug_id"), "mechanism_id", F.when(k % 9 == 0, F.lit(-1).cast("long")).otherwise(F.col("s_")).alias("target_node_id"), pick(5, ["increase", "decrease", "no_change", "unknown", "restore"]).alias("observed_direction"),
        (k % 2 == 0).alias("is_direct"), pick(3, ["human_trial", "cell_line", "in_silico_prediction"]).alias("evidence_type"), pick(4, ["approved", "approved_adult_only", "tool_compound", "approved_other_indication"]).alias("approval_status"),
        pick(2, ["disease_modifying", "symptomatic"]).alias("intervention_class"), F.when(k % 7 == 0, F.lit(True)).when(k % 7 < 5, F.lit(False)).alias("worsens_cin"), (k % 3 != 0).alias("pediatric"), F.when(k % 8 == 0, "none").otherwise("oral").alias("route"),
        F.when(k % 4 == 1, F.lit(True)).when(k % 4 == 2, F.lit(False)).alias("cns_penetrant"), F.col("p_size").cast("double").alias("achievable_um"), F.when(k % 5 != 0, F.lit(25.0)).alias("required_um"),
    )


SQL_TRIAGE = f"""{SQL_GRAPH}, n AS (SELECT count(*) AS n FROM supplier),
ag AS (SELECT p_partkey AS k, p_size, s.s_nationkey AS mechanism_id, CASE WHEN p_partkey % 9 = 0 THEN -1 ELSE s.s_suppkey END AS node_id,
  CASE p_partkey % 5 WHEN 0 THEN 'increase' WHEN 1 THEN 'decrease' WHEN 2 THEN 'no_change' WHEN 3 THEN 'unknown' ELSE 'restore' END AS obs,
  CASE p_partkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.35 ELSE 0.1 END * CASE WHEN p_partkey % 2 = 0 THEN 1.0 ELSE 0.6 END AS quality,
  CASE WHEN p_partkey % 7 = 0 THEN true WHEN p_partkey % 7 < 5 THEN false END AS worse FROM part CROSS JOIN n JOIN supplier s ON s.s_suppkey = p_partkey * 7 % n.n),
j AS (SELECT ag.*, f.node_id IS NOT NULL AS in_chain, coalesce(m.target = ag.node_id, false) AS at_target, coalesce(f.corrective, 'unknown') AS req, m.cin, m.neuro FROM ag LEFT JOIN mech m ON m.mechanism_id = ag.mechanism_id LEFT JOIN fix f ON f.mechanism_id = ag.mechanism_id AND f.node_id = ag.node_id),
g AS (SELECT *, CASE WHEN req = 'unknown' OR obs = 'unknown' THEN NULL WHEN obs = 'no_change' THEN false ELSE (req IN ('increase', 'restore')) = (obs IN ('increase', 'restore')) END AS agrees,
  k % 4 <> 2 AS repurposable, cin AND (worse OR worse IS NULL) AS onco, k % 5 <> 0 AND 25 > p_size AS conc FROM j),
c AS (SELECT *, CASE WHEN worse AND cin THEN 1.0 WHEN worse THEN 1.0 WHEN worse IS NULL AND cin THEN 1.0 WHEN worse IS NULL THEN 0.35 ELSE 0.0 END + CASE WHEN k % 3 = 0 THEN 0.35 ELSE 0.0 END + CASE WHEN conc THEN 1.0 ELSE 0.0 END
  + CASE WHEN k % 5 = 0 THEN 0.35 ELSE 0.0 END + CASE WHEN k % 8 = 0 THEN 0.35 ELSE 0.0 END + CASE WHEN neuro AND k % 4 = 2 THEN 0.35 WHEN neuro AND k % 4 NOT IN (1, 2) THEN 0.2 ELSE 0.0 END AS pen FROM g),
r AS (SELECT *, coalesce(NOT in_chain OR agrees = false, NOT in_chain) OR NOT repurposable OR onco OR conc AS rejected,
  round(least(1.0, greatest(0.0, (0.40 * CASE WHEN agrees THEN 1.0 WHEN agrees IS NULL THEN 0.35 ELSE 0.0 END + 0.30 * CAST(quality AS DOUBLE) + 0.20 * greatest(0.0, 1 - pen) + 0.10 * CASE k % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.7 WHEN 2 THEN 0.05 ELSE 0.9 END) * CASE k % 2 WHEN 0 THEN 1.0 ELSE 0.5 END)), 6) AS score,
  CASE WHEN NOT in_chain THEN 'target_not_in_mechanism' WHEN agrees = false THEN 'wrong_direction' WHEN onco THEN 'oncogenic_risk' WHEN conc THEN 'concentration_not_achievable' WHEN NOT repurposable THEN 'not_approved' END AS first_reason FROM c)"""


@query("drug_triage", f"""WITH {SQL_TRIAGE} SELECT k AS drug_id, mechanism_id, req AS required_direction, agrees, round(CAST(quality AS DOUBLE), 6) AS quality, round(CAST(pen AS DOUBLE), 6) AS safety_penalty, score, rejected, CASE WHEN rejected THEN first_reason END AS primary_reason,
  CASE WHEN rejected THEN 0 ELSE CAST(row_number() OVER (PARTITION BY mechanism_id, rejected ORDER BY score DESC, k) AS INT) END AS rank FROM r""")
def drug_triage(v: Views) -> DataFrame:
    """C15, I1 to I8, E15."""
    m, nodes, _ = graph(v)
    return mechanism.triage(agents(v), nodes, m).select("drug_id", "mechanism_id", "required_direction", "agrees", r6("quality"), r6("safety_penalty"), "score", "rejected", "primary_reason", F.coalesce("rank", F.lit(0)).alias("rank"))


@query("drug_rejections", f"""WITH {SQL_TRIAGE}, u AS (SELECT k, mechanism_id, unnest(list_filter([CASE WHEN NOT in_chain THEN 'target_not_in_mechanism' END, CASE WHEN agrees = false THEN 'wrong_direction' END, CASE WHEN onco THEN 'oncogenic_risk' END, CASE WHEN conc THEN 'concentration_not_achievable' END,
  CASE WHEN NOT repurposable THEN 'not_approved' END, CASE WHEN NOT cin AND (worse OR worse IS NULL) THEN 'safety_concern' END, CASE WHEN k % 5 = 0 OR k % 8 = 0 OR (neuro AND k % 4 <> 1) THEN 'pharmacokinetic_barrier' END,
  CASE WHEN in_chain AND NOT at_target THEN 'mechanism_mismatch' END, CASE WHEN quality < 0.30 THEN 'insufficient_evidence' END, CASE WHEN k % 3 = 0 THEN 'no_pediatric_evidence' END, CASE WHEN agrees IS NULL THEN 'direction_unknown' END], lambda x: x IS NOT NULL)) AS reason FROM r WHERE rejected)
SELECT k AS drug_id, mechanism_id, reason FROM u""")
def drug_rejections(v: Views) -> DataFrame:
    """I8, I9."""
    m, nodes, _ = graph(v)
    return mechanism.rejections(mechanism.triage(agents(v), nodes, m))


@query("drug_answers", f"""WITH {SQL_TRIAGE}, w AS (SELECT *, list_filter([CASE WHEN cin AND (worse OR worse IS NULL) THEN 'oncogenic_risk' END, CASE WHEN NOT cin AND (worse OR worse IS NULL) THEN 'safety_concern' END, CASE WHEN k % 3 = 0 THEN 'no_pediatric_evidence' END,
  CASE WHEN conc THEN 'concentration_not_achievable' END, CASE WHEN k % 5 = 0 OR k % 8 = 0 OR (neuro AND k % 4 <> 1) THEN 'pharmacokinetic_barrier' END], lambda x: x IS NOT NULL) AS worries FROM r)
SELECT k AS drug_id, 'verdict' AS question, CASE WHEN rejected THEN concat('rejected: ', first_reason) ELSE 'accepted' END AS answer FROM w
UNION ALL SELECT k, 'does the direction fit', CASE WHEN agrees THEN 'yes' WHEN agrees IS NULL THEN 'unknown' ELSE 'no' END FROM w UNION ALL SELECT k, 'section', CASE k % 2 WHEN 0 THEN 'disease_modifying' ELSE 'non_disease_modifying' END FROM w
UNION ALL SELECT k, 'how good is the evidence', printf('%.3f', CAST(quality AS DOUBLE)) FROM w UNION ALL SELECT k, 'what worries', CASE WHEN len(worries) = 0 THEN 'nothing found' ELSE array_to_string(worries, ', ') END FROM w
UNION ALL SELECT k, 'what would reverse it', CASE WHEN NOT rejected THEN '-' WHEN first_reason = 'wrong_direction' THEN 'evidence of the opposite direction' WHEN first_reason = 'target_not_in_mechanism' THEN 'a link from its target into the chain' WHEN first_reason = 'not_approved' THEN 'an approval' ELSE 'new safety or exposure data' END FROM w""")
def drug_answers(v: Views) -> DataFrame:
    """Every question about every agent; an agent that no section shows would be an error."""
    m, nodes, _ = graph(v)
    triaged = mechanism.triage(agents(v), nodes, m)
    said = stages.drug_answers(triaged)
    shown = said.filter("question = 'section'")
    lost = stages.unrendered(triaged, shown).select(F.raise_error(F.concat(F.lit("not in one section: "), F.col("drug_id").cast("string"))).cast("long").alias("drug_id"), F.lit("").alias("question"), F.lit("").alias("answer"))
    return said.unionByName(lost)


@query("agents_to_avoid", f"""WITH {SQL_TRIAGE}, p AS (SELECT *, row_number() OVER (PARTITION BY mechanism_id ORDER BY rejected, score DESC, k) AS place FROM r)
SELECT k AS drug_id, mechanism_id, CASE WHEN rejected THEN 'avoid' ELSE 'screened' END AS list, CAST(place AS INT) AS place, CASE WHEN rejected THEN first_reason ELSE '' END AS primary_reason, CASE WHEN NOT in_chain THEN '(not on this chain)' ELSE s_name END AS node,
  CASE WHEN agrees THEN 'yes' WHEN agrees IS NULL THEN 'unknown' ELSE 'no' END AS agrees FROM p LEFT JOIN supplier ON s_suppkey = node_id AND s_nationkey = mechanism_id""")
def agents_to_avoid(v: Views) -> DataFrame:
    """Every agent of a triage run in one total order, accepted ones first; those to avoid with their reason and the node they act on."""
    m, nodes, _ = graph(v)
    rows = mechanism.avoid_and_ranking(mechanism.triage(agents(v), nodes, m), nodes)
    return rows.select("drug_id", "mechanism_id", "list", "place", F.coalesce("primary_reason", F.lit("")).alias("primary_reason"), "node", F.when(F.col("agrees"), "yes").when(F.col("agrees").isNull(), "unknown").otherwise("no").alias("agrees"))


@query("mechanism_validity", f"""WITH {SQL_GRAPH}, l AS (SELECT mechanism_id, node_id, CASE WHEN node_id % 5 = 0 THEN -node_id - 1 ELSE node_id END AS t FROM nodes)
SELECT mechanism_id, node_id AS link_id, t AS node_id FROM l WHERE t < 0""")
def mechanism_validity(v: Views) -> DataFrame:
    """Links to nodes that are not there, planted by rule."""
    _, nodes, _ = graph(v)
    spoilt = nodes.select("mechanism_id", F.col("node_id").alias("link_id"), F.col("node_id").alias("source_node_id"), F.when(F.col("node_id") % 5 == 0, -F.col("node_id") - 1).otherwise(F.col("node_id")).alias("target_node_id"))
    return mechanism.invalid_links(spoilt, nodes).select("mechanism_id", "link_id", "node_id")


# ---- evidence ------------------------------------------------------------------------------------------------------------------


def evidence_rows(v: Views) -> DataFrame:
    """One frequency item per site, missing frequency included."""
    best = annotate.max_frequency(v["frequencies"])
    known = v["calls"].select("site_key").distinct().join(best, "site_key", "left")
    direction = F.when(F.col("max_af").isNull(), "neutral").when(F.col("max_af") > 0.01, "contradicts").otherwise("supports")
    strength = F.when(F.col("max_af").isNull(), "insufficient").otherwise("moderate")
    claim = F.when(F.col("max_af").isNull(), "no frequency data").otherwise("population frequency")
    return compare.evidence(known, F.col("site_key"), "variant", "population_frequency", direction, strength, claim, F.col("max_af"), F.create_map(F.lit("population"), F.coalesce("max_af_population", F.lit(""))))


@query("frequency_evidence", f"""WITH {SQL_FREQ}, k AS (SELECT DISTINCT site_key FROM calls)
SELECT CAST(k.site_key AS VARCHAR) AS subject_id, CASE WHEN max_af IS NULL THEN 'no frequency data' ELSE 'population frequency' END AS claim, CASE WHEN max_af IS NULL THEN 'neutral' WHEN max_af > 0.01 THEN 'contradicts' ELSE 'supports' END AS direction,
  CASE WHEN max_af IS NULL THEN 'insufficient' ELSE 'moderate' END AS strength, max_af AS numeric_value FROM k LEFT JOIN freq ON freq.site_key = k.site_key""")
def frequency_evidence(v: Views) -> DataFrame:
    """Items with content-derived ids, deduplicated; an unknown frequency is an item of its own."""
    return compare.deduplicated(evidence_rows(v)).select("subject_id", "claim", "direction", "strength", "numeric_value")


@query("content_ids", """
SELECT o_orderkey, concat('EV-ORDE-', substr(sha256(concat('orders', chr(31), CAST(o_orderkey AS VARCHAR), chr(31), o_orderstatus)), 1, 16)) AS evidence_id FROM orders""")
def content_ids(v: Views) -> DataFrame:
    """J1."""
    return v["orders"].select("o_orderkey", tables.content_id(F.lit("orders"), F.col("o_orderkey"), F.col("o_orderstatus")).alias("evidence_id"))


@query("claim_status", """
WITH i AS (SELECT l_orderkey AS claim_id, CASE l_returnflag WHEN 'R' THEN 'contradicts' WHEN 'A' THEN 'supports' ELSE 'neutral' END AS direction, CAST(l_linenumber % 5 AS INT) AS s FROM lineitem)
SELECT claim_id, bool_or(direction = 'contradicts') AS contradicted, NOT bool_or(direction = 'supports') AS unproven, CASE max(s) WHEN 0 THEN 'strong' WHEN 1 THEN 'moderate' WHEN 2 THEN 'supporting' WHEN 3 THEN 'weak' ELSE 'insufficient' END AS weakest FROM i GROUP BY claim_id""")
def claim_status(v: Views) -> DataFrame:
    """C18, D-16, J8."""
    direction = F.when(F.col("l_returnflag") == "R", "contradicts").when(F.col("l_returnflag") == "A", "supports").otherwise("neutral")
    strength = F.get(F.array(*[F.lit(x) for x in ("strong", "moderate", "supporting", "weak", "insufficient")]), F.col("l_linenumber") % 5)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    items = v["lineitem"].select(key.alias("evidence_id"), direction.alias("direction"), strength.alias("strength"))
    claims = v["lineitem"].groupBy(F.col("l_orderkey").alias("claim_id")).agg(F.collect_list(key).alias("evidence_ids"))
    return compare.claim_status(claims, items)


@query("graph_edges", f"""WITH {SQL_PAIRS}, {SQL_TRIAGE}, p AS (SELECT DISTINCT concat('PAIR-', substr(sha256(CASE WHEN id_b IS NULL THEN concat(gene_key, '|', id_a) ELSE concat(gene_key, '|', least(id_a, id_b), '|', greatest(id_a, id_b)) END), 1, 16)) AS pid, gene_key, id_a, id_b FROM kept),
t AS (SELECT pid AS s, 'in_gene' AS predicate, CAST(gene_key AS VARCHAR) AS o, 'gene' AS kind FROM p UNION SELECT pid, 'has_member', id_a, 'variant' FROM p UNION SELECT pid, 'has_member', id_b, 'variant' FROM p WHERE id_b IS NOT NULL
  UNION SELECT CAST(mechanism_id AS VARCHAR), 'has_mechanism', CAST(mechanism_id AS VARCHAR), 'mechanism' FROM mech UNION SELECT CAST(k AS VARCHAR), CASE WHEN rejected THEN 'rejected_for_mechanism' ELSE 'targets_mechanism' END, CAST(mechanism_id AS VARCHAR), 'mechanism' FROM r)
SELECT substr(sha256(concat(s, chr(31), predicate, chr(31), o)), 1, 16) AS edge_id, s AS subject_id, predicate, o AS object_id, kind AS object_kind FROM t""")
def graph_edges(v: Views) -> DataFrame:
    """Edges of candidates, of mechanisms (a mechanism's number is its gene's) and of triaged agents."""
    a, b = F.col("a.variant_id"), F.col("b.variant_id")
    ids = F.when(b.isNull(), pairs.pair_id(F.col("gene_key"), a)).otherwise(pairs.pair_id(F.col("gene_key"), a, b))
    rows = candidates(v).select(ids.alias("pair_id"), "gene_key", F.array_compact(F.array(a, b)).alias("members"))
    m, nodes, _ = graph(v)
    drugs = mechanism.triage(agents(v), nodes, m)
    every = compare.edges(rows).unionByName(compare.mechanism_edges(m.withColumn("gene_key", F.col("mechanism_id")))).unionByName(compare.drug_edges(drugs))
    return every.select("edge_id", "subject_id", "predicate", "object_id", "object_kind")


@query("keyed_upsert", """
WITH b AS (SELECT o_custkey, o_orderkey, o_totalprice, 0 AS batch FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_custkey, o_orderkey, o_totalprice, 1 FROM orders WHERE o_orderkey % 5 = 0)
SELECT o_custkey, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY batch DESC, o_orderkey DESC) AS rn FROM b) q WHERE rn = 1""")
def keyed_upsert(v: Views) -> DataFrame:
    """The last row of the new batch wins; every order is in one of the batches."""
    rows = v["orders"].select("o_custkey", "o_orderkey", r6("o_totalprice"))
    return tables.upserted(rows.filter("o_orderkey % 5 <> 0"), rows.filter("o_orderkey % 5 = 0"), ["o_custkey"], "o_orderkey")


@query("table_digests")
def table_digests(v: Views) -> DataFrame:
    """D-17, J13: rows and order-insensitive digests of tables."""
    out = None
    for name in ("region", "nation", "supplier", "part", "orders", "lineitem"):
        one = tables.table_hash(v[name]).withColumn("table_name", F.lit(name))
        out = one if out is None else out.union(one)
    return out


@query("row_counts", "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'calls', count(*) FROM calls")
def row_counts(v: Views) -> DataFrame:
    """D-17."""
    return tables.row_counts({n: v[n] for n in ("orders", "lineitem", "calls")})


@query("partition_invariant", "WITH q AS (SELECT count(*) AS n, count_if(l_orderkey % 31 <> 0) AS k FROM variants) SELECT n AS n_all, CAST(k AS BIGINT) AS n_kept, CAST(n - k AS BIGINT) AS n_gone, true AS balanced FROM q")
def partition_invariant(v: Views) -> DataFrame:
    """kept and discarded rows add up."""
    df = v["variants"]
    return tables.accounted(df, df.filter("filter_status <> 'missing'"), df.filter("filter_status = 'missing'"))


@query("sql_surface", "SELECT contig, zygosity, count(*) AS n, CAST(max(position) AS BIGINT) AS last_position FROM calls WHERE gq >= 20 GROUP BY contig, zygosity")
def sql_surface(v: Views) -> DataFrame:
    """Spark SQL over the views."""
    return v.sql("SELECT contig, zygosity, count(*) AS n, CAST(max(position) AS BIGINT) AS last_position FROM calls WHERE gq >= 20 GROUP BY contig, zygosity")


# ---- text -----------------------------------------------------------------------------------------------------------------------


@query("sensitive_findings")
def sensitive_findings(v: Views) -> DataFrame:
    """K1, K2 over all documents, with the specimen texts as control rows so that every rule is seen to fire."""
    control = v.spark.createDataFrame([(-1 - k, t) for k, (_, t) in enumerate(textscan.SPECIMENS)], "doc_id long, text string")
    docs = v["documents"].select("doc_id", "text").unionByName(control)
    return textscan.resolved(textscan.findings(docs))


@query("redaction")
def redaction(v: Views) -> DataFrame:
    """Texts with matches replaced by <rule,length>."""
    control = v.spark.createDataFrame([(-1 - k, t) for k, (_, t) in enumerate(textscan.SPECIMENS)], "doc_id long, text string")
    docs = v["documents"].select("doc_id", "text").unionByName(control)
    return docs.select("doc_id", textscan.redacted(F.col("text")).alias("text")).select("doc_id", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


@query("path_classes", r"""SELECT page_id, CASE WHEN regexp_matches(lower(url), '\.(vcf|bcf|bam|cram|sam|fastq|fq|ped|fam|bed|bim|gvcf)$') THEN 'sensitive' WHEN regexp_matches(lower(url), '(^|/)(private|workspace|case)(/|$)') THEN 'sensitive'
  WHEN regexp_matches(lower(url), '(^|/)(results|artifacts|reports)(/|$)') THEN 'derived' ELSE 'public' END AS class FROM pages""")
def path_classes(v: Views) -> DataFrame:
    """K7."""
    return v["pages"].select("page_id", textscan.path_class(F.col("url")).alias("class"))


@query("normalised_titles", "SELECT p_partkey, regexp_replace(translate(lower(concat(p_name, ' É. ', p_brand)), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^a-z0-9]', '', 'g') AS title FROM part")
def normalised_titles(v: Views) -> DataFrame:
    """K9."""
    return v["part"].select("p_partkey", compare.normalised_title(F.concat("p_name", F.lit(" É. "), "p_brand")).alias("title"))


@query("hpo_frequencies", """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'ratio' WHEN p_size % 3 = 1 THEN 'percent' ELSE 'term' END AS kind,
  round(CASE WHEN p_size % 3 = 0 THEN p_size / 60.0 WHEN p_size % 3 = 1 THEN p_size / 100.0 ELSE 0.30 END, 6) AS lower, round(CASE WHEN p_size % 3 = 0 THEN p_size / 60.0 WHEN p_size % 3 = 1 THEN p_size / 100.0 ELSE 0.79 END, 6) AS upper FROM part""")
def hpo_frequencies(v: Views) -> DataFrame:
    """B33."""
    raw = F.when(F.col("p_size") % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit("/60"))).when(F.col("p_size") % 3 == 1, F.concat(F.col("p_size").cast("string"), F.lit("%"))).otherwise("Frequent")
    df = v["part"].select("p_partkey", rules.hpo_frequency(raw).alias("f"))
    return df.select("p_partkey", "f.kind", F.round("f.lower", 6).alias("lower"), F.round("f.upper", 6).alias("upper"))


# ---- streaming --------------------------------------------------------------------------------------------------------------------


@query("running_counts", "SELECT event_type AS verdict, count(*) AS n FROM events GROUP BY event_type")
def running_counts(v: Views) -> DataFrame:
    """M2: counters kept by a stream over the events file, read back when the stream has caught up."""
    from variantloom.streaming import ingest

    return ingest.drained(v.spark, v["events"].schema, v.sf_dir, "events.parquet", lambda df: ingest.running_counts(df.withColumnRenamed("event_type", "verdict")))


