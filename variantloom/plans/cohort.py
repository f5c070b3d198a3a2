"""Registered queries over arriving files, equivalent spellings, overlapping genes, roles, evidence and compared runs.

As in files.py, text and sites tables are written by Spark from the given tables, and the SQL says what must come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from variantloom.functions import alleles, rules
from variantloom import schemas
from variantloom.operators import annotate, builders, compare, ledger, mechanism, ontology, pairs, representation, roles, stages, tables
from variantloom.plans.files import vcf_record
from variantloom.plans.registry import SQL_PAIRS, SQL_QC, SQL_SCORED, SQL_SITES, SQL_TRIAGE, SQL_TRIAGED, agents, gene_terms, graph, joined, judged, placed_calls, query, scored, states
from variantloom.plans.views import Views
from variantloom.sources import vcf
from variantloom.streaming import ingest

# ---- arriving files -----------------------------------------------------------------------------------------------------------


@query("ingest_triage", f"""WITH {SQL_TRIAGED},
arrived AS (SELECT DISTINCT sample_id, contig, position, ref, unnest(CASE WHEN l_linenumber % 3 = 0 THEN ['AT', 'CG'] ELSE ['AT'] END) AS alt, l_partkey AS site_key FROM variants WHERE l_orderkey % 211 <> 0),
known AS (SELECT a.sample_id, CASE WHEN a.site_key % 19 = 0 THEN 'missing_genotype' WHEN coalesce(n_consequences, 0) = 0 AND n_assertions IS NOT NULL THEN 'kept_clinical_assertion' WHEN coalesce(n_consequences, 0) = 0 THEN 'dropped_no_gene_assignment'
    WHEN any_selecting THEN 'kept_relevant_consequence' WHEN worst_rank <= 2 THEN 'kept_impact_at_or_above_floor' WHEN splice_ai >= 0.2 THEN 'kept_splice_ai' WHEN n_assertions IS NOT NULL THEN 'kept_clinical_assertion'
    WHEN worst_rank IS NULL THEN 'kept_impact_not_assessed' ELSE 'dropped_impact_below_floor' END AS rule FROM arrived a LEFT JOIN cons ON cons.site_key = a.site_key LEFT JOIN clin ON clin.site_key = a.site_key)
SELECT sample_id, CASE WHEN rule LIKE 'kept%' THEN 'kept' WHEN rule LIKE 'dropped%' THEN 'triage' ELSE 'ingest' END AS stage, rule, count(*) AS n FROM known GROUP BY 1, 2, 3""")
def ingest_triage(v: Views) -> DataFrame:
    """M1: a sample's records arrive in two files that overlap, in several batches; every call counts once, by the rule that let it pass or stopped it."""
    folder = tables.new_path(v.spark, "arriving")
    record = vcf_record(F.when(F.col("l_partkey") % 19 == 0, "./."))
    deliveries = F.array_compact(F.array(F.when(F.col("l_linenumber") <= 4, 1), F.when(F.col("l_linenumber") >= 3, 2)))
    sent = v["variants"].select(F.col("sample_id").alias("sample"), F.explode(deliveries).alias("delivery"), record.alias("value"))
    sent.repartition("sample", "delivery").write.partitionBy("sample", "delivery").text(folder)
    site = F.floor(F.col("position") / 1000).cast("long")
    kept, gone = ingest.ingest_triaged(v.spark, folder, site, v["consequences"], v["clinical"], tables.new_path(v.spark, "ingested"), per_batch=6)
    rows = kept.read().select("sample_id", F.lit("kept").alias("stage"), F.col("triage").alias("rule")).unionByName(gone.read().select("sample_id", "stage", "rule"))
    return rows.groupBy("sample_id", "stage", "rule").agg(F.count(F.lit(1)).alias("n"))


# ---- equivalent spellings -------------------------------------------------------------------------------------------------------


def repeats(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For each part a contig TTG(CA)nGTT, a call in its repeat and a site for it, often written at another copy of the unit."""
    n = 3 + F.col("p_size") % 20
    parts = v["part"].select("p_partkey", F.col("p_size"), F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("contig"), n.alias("n"))
    sequences = parts.filter("p_partkey % 7 <> 0").select("contig", F.concat(F.lit("TTG"), F.expr("repeat('CA', n)"), F.lit("GTT")).alias("seq"))

    def spelled(place: F.Column, kind: F.Column) -> list[F.Column]:
        """An inserted (kind 0) or deleted (kind 1) unit, written `place` bases from the left-most anchor; kind 2 is a single base."""
        anchor = F.when(place == 0, "G").when(place % 2 == 0, "A").otherwise("C")
        long = F.concat(anchor, F.when(place % 2 == 0, "CA").otherwise("AC"))
        return [(3 + place).cast("long").alias("position"), F.when(kind == 1, long).otherwise(anchor).alias("ref"), F.when(kind == 0, long).when(kind == 1, anchor).otherwise(F.lit("T")).alias("alt")]

    room = 2 * F.col("n") - 1
    kind = F.col("p_partkey") % 3
    calls = parts.select("p_partkey", "contig", *spelled((F.col("p_partkey") * 5) % room, kind))
    sites = parts.filter("p_partkey % 11 <> 0").select("contig", *spelled((F.col("p_partkey") * 5 + F.col("p_size") % 4) % room, F.when(F.col("p_partkey") % 13 == 0, (kind + 1) % 2).otherwise(kind)), F.col("p_size").alias("value"))
    return calls, sites, sequences


@query("shifted_lookup", """
WITH p AS (SELECT p_partkey AS k, p_size, 2 * (3 + p_size % 20) - 1 AS room, p_partkey % 3 AS kind, CASE WHEN p_partkey % 13 = 0 THEN (p_partkey % 3 + 1) % 2 ELSE p_partkey % 3 END AS site_kind FROM part),
q AS (SELECT *, k * 5 % room AS a, (k * 5 + p_size % 4) % room AS b, k % 11 <> 0 AS has_site FROM p),
s AS (SELECT k, p_size, b, CASE WHEN kind = 2 THEN 'not_required' WHEN k % 7 = 0 THEN 'no_reference' ELSE 'applied' END AS representation,
  CASE WHEN has_site AND kind = site_kind AND a = b THEN 'exact' WHEN has_site AND kind = site_kind AND kind < 2 AND k % 7 <> 0 THEN 'shifted' END AS hit FROM q)
SELECT k AS p_partkey, representation, coalesce(hit, CASE WHEN representation = 'no_reference' THEN 'unreconciled' ELSE 'absent' END) AS found, CASE WHEN hit IS NULL THEN -1 ELSE 3 + b END AS site_position, CASE WHEN hit IS NULL THEN -1 ELSE p_size END AS value FROM s""")
def shifted_lookup(v: Views) -> DataFrame:
    """Indels found in a sites table under any of their spellings, with what could not be reconciled."""
    calls, sites, sequences = repeats(v)
    windows = representation.windowed(calls, stages.reference_blocks(sequences))
    found = representation.equivalent_lookup(windows, sites, "p_partkey")
    return found.select("p_partkey", "representation", "found", F.coalesce("site_position", F.lit(-1)).alias("site_position"), F.coalesce("value", F.lit(-1)).alias("value"))


@query("representation_status", """
WITH s AS (SELECT CASE WHEN p_partkey % 3 = 2 THEN 'not_required' WHEN p_partkey % 7 = 0 THEN 'no_reference' ELSE 'applied' END AS representation FROM part)
SELECT representation, count(*) AS n FROM s GROUP BY 1 UNION ALL SELECT 'all: degraded', count(*) FROM s WHERE representation <> 'not_required'""")
def representation_status(v: Views) -> DataFrame:
    """O6, D-10: whether shifted spellings of a table's calls could be compared."""
    calls, _, sequences = repeats(v)
    return representation.representation_report(representation.windowed(calls, stages.reference_blocks(sequences)))


# ---- overlapping genes ------------------------------------------------------------------------------------------------------------

#: Every gene has an antisense neighbour that begins inside it, so many sites stand in two genes.
SQL_LOCI = """loci AS (SELECT gene_id, gene_symbol, contig, g_start, g_end FROM genes
  UNION ALL SELECT gene_id, concat(gene_symbol, 'as'), contig, g_end - 50 * (1 + gene_id % 7), g_end + 400 FROM genes WHERE gene_id % 4 <> 0)"""


def loci(v: Views) -> DataFrame:
    own = v["genes"].select("gene_id", "gene_symbol", "contig", "g_start", "g_end")
    anti = v["genes"].filter("gene_id % 4 <> 0").select("gene_id", F.concat("gene_symbol", F.lit("as")), "contig", F.col("g_end") - 50 * (1 + F.col("gene_id") % 7), F.col("g_end") + 400)
    return own.union(anti)


@query("locus_annotations", f"""WITH {SQL_SITES}, {SQL_LOCI},
tx AS (SELECT gene_id, concat('T', gene_id, '.1') AS transcript_id, true AS is_select FROM genes WHERE gene_id % 9 <> 0 UNION ALL SELECT gene_id, concat('T', gene_id, '.2'), false FROM genes WHERE gene_id % 9 <> 0 AND gene_id % 5 = 0)
SELECT s.contig, s.position, s.ref, l.gene_symbol, t.transcript_id, t.is_select, 'gene_variant' AS terms, 'not assessed' AS impact
FROM sites s JOIN loci l ON l.contig = s.contig AND s.position <= l.g_end AND s.position + length(s.ref) - 1 >= l.g_start JOIN tx t ON t.gene_id = l.gene_id""")
def locus_annotations(v: Views) -> DataFrame:
    """Every gene a site touches with each of its transcripts, impact not assessed."""
    k = F.col("gene_id")
    one = v["genes"].filter(k % 9 != 0).select("gene_id", F.concat(F.lit("T"), k.cast("string"), F.lit(".1")).alias("transcript_id"), F.lit(True).alias("is_select"))
    two = v["genes"].filter((k % 9 != 0) & (k % 5 == 0)).select("gene_id", F.concat(F.lit("T"), k.cast("string"), F.lit(".2")), F.lit(False))
    found = annotate.locus_annotations(v["calls"].select("contig", "position", "ref").distinct(), loci(v), one.union(two), ["contig", "position", "ref"])
    return found.select("contig", "position", "ref", "gene_symbol", "transcript_id", "is_select", "terms", F.coalesce("impact", F.lit("not assessed")).alias("impact"))


SQL_FANNED = SQL_PAIRS.replace("gene_key", "gene_symbol").replace("FROM judged WHERE", "FROM judged j JOIN loci l ON l.contig = j.contig AND j.position <= l.g_end AND j.position + length(j.ref) - 1 >= l.g_start WHERE").replace("substr(contig, 4)", "substr(j.contig, 4)").replace("concat('GRCh38:', contig", "concat('GRCh38:', j.contig")


@query("gene_fanout_pairs", f"""WITH {SQL_LOCI}, {SQL_FANNED}, g AS (SELECT sample_id, id_a, id_b, count(*) AS n_genes FROM kept GROUP BY 1, 2, 3)
SELECT k.sample_id, k.gene_symbol, k.id_a AS variant_a, k.id_b AS variant_b, k.generated, CAST(k.pair_place AS INT) AS pair_place, k.truncated, g.n_genes,
  concat('PAIR-', substr(sha256(CASE WHEN k.id_b IS NOT NULL THEN concat(k.gene_symbol, '|', least(k.id_a, k.id_b), '|', greatest(k.id_a, k.id_b)) ELSE concat(k.gene_symbol, '|', k.id_a) END), 1, 16)) AS pair_id
FROM kept k JOIN g ON g.sample_id = k.sample_id AND g.id_a = k.id_a AND g.id_b IS NOT DISTINCT FROM k.id_b""")
def gene_fanout_pairs(v: Views) -> DataFrame:
    """Pairs within every gene that their members touch; a pair of two genes is a candidate in each, with an id of its own."""
    carried = pairs.with_order(judged(v).filter(F.col("selection").startswith("retained") & F.col("zygosity").isin("het", "hom_alt", "hemi")))
    fanned = annotate.with_loci(carried, loci(v)).drop("end", "g_start", "g_end", "gene_id", "gene_key")
    group = ["sample_id", "gene_symbol"]
    kept = pairs.kept_pairs(pairs.with_singles(fanned, group), group)
    a, b = F.col("a.variant_id"), F.col("b.variant_id")
    ids = kept.select(*group, a.alias("variant_a"), b.alias("variant_b"), "generated", "pair_place", "truncated", F.when(b.isNull(), pairs.pair_id(F.col("gene_symbol"), a)).otherwise(pairs.pair_id(F.col("gene_symbol"), a, b)).alias("pair_id"))
    ids = tables.cut(ids)
    shared = ids.groupBy("sample_id", F.col("variant_a").alias("a_"), F.col("variant_b").alias("b_")).agg(F.count(F.lit(1)).alias("n_genes"))
    return ids.join(shared.withColumnRenamed("sample_id", "s_"), (F.col("sample_id") == F.col("s_")) & (F.col("variant_a") == F.col("a_")) & F.col("variant_b").eqNullSafe(F.col("b_"))).drop("s_", "a_", "b_")


# ---- roles --------------------------------------------------------------------------------------------------------------------


def placed_table(v: Views, name: str, columns: list[str], keep: str) -> DataFrame:
    """A view by site_key as a sites table of the calls' own alleles."""
    keys = v["calls"].select("contig", "position", "ref", "alt", "site_key").distinct()
    return keys.filter(keep).join(v[name], "site_key").select(*roles.KEY, *columns)


def role_registry(v: Views) -> roles.Roles:
    """Two frequency releases (the second has no chr21) and a clinical one."""
    path = lambda rows: roles.written(rows, tables.new_path(v.spark, "role"))
    rows = placed_table(v, "frequencies", ["population", "af"], "true")
    return roles.Roles().add(
        roles.Provider("frequency", "cohort", "1.0", path(rows.filter("population <> 'ASIA'"))),
        roles.Provider("frequency", "cohort", "2.0", path(rows.filter("population = 'ASIA' AND contig <> 'chr21'")), synthetic=True),
        roles.Provider("clinical", "curated", "2024-01", path(placed_table(v, "clinical", ["significance", "stars"], "position % 3 <> 0"))),
    )


@query("role_answers", """WITH k AS (SELECT DISTINCT contig, position, ref, alt, site_key FROM calls)
SELECT 'frequency' AS role, CASE WHEN population = 'ASIA' THEN '2.0' ELSE '1.0' END AS version, population = 'ASIA' AS synthetic, contig, population AS about, count(*) AS n, round(sum(af), 6) AS total FROM k JOIN frequencies f ON f.site_key = k.site_key WHERE NOT (population = 'ASIA' AND contig = 'chr21') GROUP BY ALL
UNION ALL SELECT 'clinical', '2024-01', false, contig, significance, count(*), CAST(sum(stars) AS DOUBLE) FROM k JOIN clinical c ON c.site_key = k.site_key WHERE position % 3 <> 0 GROUP BY ALL""")
def role_answers(v: Views) -> DataFrame:
    """Answers of two roles and three providers, with where they came from."""
    registry = role_registry(v)
    frequency = registry.answers("frequency", v["calls"]).select("role", "version", "synthetic", "contig", F.col("population").alias("about"), F.col("af").alias("x"))
    clinical = registry.answers("clinical", v["calls"]).select("role", "version", "synthetic", "contig", "significance", F.col("stars").cast("double"))
    return frequency.union(clinical).groupBy("role", "version", "synthetic", "contig", "about").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 6).alias("total"))


@query("role_accounting", """WITH k AS (SELECT DISTINCT contig, position, ref, alt, site_key FROM calls), s AS (SELECT k.*, r.version, coalesce(CASE r.version WHEN '1.0' THEN n_other > 0 ELSE n_asia > 0 AND contig <> 'chr21' END, false) AS hit
  FROM k CROSS JOIN (SELECT unnest(['1.0', '2.0']) AS version) r LEFT JOIN (SELECT site_key, count_if(population <> 'ASIA') AS n_other, count_if(population = 'ASIA') AS n_asia FROM frequencies GROUP BY site_key) f ON f.site_key = k.site_key)
SELECT 'cohort' AS provider, version, CASE WHEN hit THEN 'answered' WHEN version = '2.0' AND contig = 'chr21' THEN 'contig_not_available' ELSE 'no_record' END AS state, count(*) AS n FROM s GROUP BY ALL""")
def role_accounting(v: Views) -> DataFrame:
    """What each provider of a role could say; a contig that it lacks is not an absence."""
    return role_registry(v).accounted("frequency", v["calls"])


# ---- compared runs ----------------------------------------------------------------------------------------------------------------


def run_of(v: Views, calls: DataFrame) -> DataFrame:
    """The verdicts of a run over calls."""
    df = annotate.selected(annotate.flagged(annotate.annotated(calls, v["consequences"], v["frequencies"], v["clinical"])))
    return df.select("sample_id", "contig", "position", "ref", "alt", "triage", "selection", "max_af", F.array_join("flags", ",").alias("flags"))


@query("determinism_check", "SELECT 4096 AS n_buckets, 0 AS n_unequal, count(*) AS n_rows FROM calls")
def determinism_check(v: Views) -> DataFrame:
    """Two runs over the calls, dealt and ordered differently, agree in every bucket."""
    key = ["sample_id", "contig", "position", "ref", "alt"]
    one, two = tables.cut(run_of(v, v["calls"])), tables.cut(run_of(v, v["calls"].repartition(13, "position").sortWithinPartitions("alt")))
    n = one.agg(F.count(F.lit(1)).alias("n_rows"))
    return tables.unequal_buckets(one, two, key).agg(F.lit(4_096).alias("n_buckets"), F.count(F.lit(1)).cast("int").alias("n_unequal")).join(F.broadcast(n))


@query("run_differences", """SELECT sample_id, contig, position, ref, alt, CASE WHEN position % 1009 = 0 THEN 'only_first' ELSE 'changed' END AS state, CASE WHEN position % 1009 = 0 THEN '' ELSE 'depth,zygosity' END AS columns FROM calls WHERE position % 1009 = 0 OR (position % 997 = 0 AND zygosity = 'het')
UNION ALL SELECT sample_id, contig, position, ref, concat(alt, 'N'), 'only_second', '' FROM calls WHERE position % 1013 = 0 AND position % 1009 <> 0""")
def run_differences(v: Views) -> DataFrame:
    """Planted changes name their rows: calls left out, calls changed in two columns, calls added."""
    calls = v["calls"].select("sample_id", "contig", "position", "ref", "alt", "depth", "zygosity")
    hit = (F.col("position") % 997 == 0) & (F.col("zygosity") == "het")
    other = calls.filter("position % 1009 <> 0")
    other = other.union(other.filter("position % 1013 = 0").withColumn("alt", F.concat("alt", F.lit("N")))).withColumns({"depth": F.when(hit & ~F.col("alt").endswith("N"), F.coalesce("depth", F.lit(-2)) + 1).otherwise(F.col("depth")), "zygosity": F.when(hit & ~F.col("alt").endswith("N"), "hom_alt").otherwise(F.col("zygosity"))})
    found = tables.differences(tables.cut(calls), tables.cut(other), ["sample_id", "contig", "position", "ref", "alt"])
    return found.select("sample_id", "contig", "position", "ref", "alt", "state", joined("columns"))


# ---- the evidence ledger ----------------------------------------------------------------------------------------------------------

SQL_STRENGTH = "CASE WHEN abs({0} - 0.5) >= 0.40 THEN 'moderate' WHEN abs({0} - 0.5) >= 0.25 THEN 'supporting' WHEN abs({0} - 0.5) >= 0.10 THEN 'weak' ELSE 'insufficient' END"
SQL_SAID = """said AS (SELECT s.sample_id, s.pair_id, s.rank, s.id_a, s.id_b, unnest(list_filter([
    CASE WHEN s.model = 'compound_heterozygous' AND s.phase = 'cis_confirmed' THEN {'code': 'in_cis_phase', 'size': 0.6, 'of': s.pair_id} END,
    CASE WHEN a.max_af > 0.01 THEN {'code': 'common_variant', 'size': 0.45, 'of': s.id_a} END, CASE WHEN a.max_nhomalt > 0 AND a.max_af > 0.001 THEN {'code': 'population_homozygotes', 'size': 0.35, 'of': s.id_a} END,
    CASE WHEN a.poor THEN {'code': 'low_quality_call', 'size': 0.3, 'of': s.id_a} END, CASE WHEN a.all_benign THEN {'code': 'benign_consequence', 'size': 0.25, 'of': s.id_a} END,
    CASE WHEN b.max_af > 0.01 THEN {'code': 'common_variant', 'size': 0.45, 'of': s.id_b} END, CASE WHEN b.max_nhomalt > 0 AND b.max_af > 0.001 THEN {'code': 'population_homozygotes', 'size': 0.35, 'of': s.id_b} END,
    CASE WHEN b.poor THEN {'code': 'low_quality_call', 'size': 0.3, 'of': s.id_b} END, CASE WHEN b.all_benign THEN {'code': 'benign_consequence', 'size': 0.25, 'of': s.id_b} END], lambda x: x IS NOT NULL)) AS x
  FROM ranks s JOIN placed a ON a.sample_id = s.sample_id AND a.gene_key = s.gene_key AND a.variant_id = s.id_a LEFT JOIN placed b ON b.sample_id = s.sample_id AND b.gene_key = s.gene_key AND b.variant_id = s.id_b)"""
SQL_PARTS = f"""parts_ AS (SELECT sample_id, pair_id, rank, unnest([{", ".join(f"'{c}'" for c in pairs.COMPONENTS)}]) AS component, unnest([{", ".join(f"round({c}, 6)" for c in pairs.COMPONENTS)}]) AS score FROM ranks)"""


def evidence_stages(v: Views) -> list[DataFrame]:
    """The rows of every stage with their items."""
    survivors = tables.cut(pairs.with_order(judged(v)))
    flags = rules.qc_flags(F.col("zygosity"), F.col("share"), F.col("share"), F.col("depth"), F.col("gq"), F.col("filter_status"))
    share = alleles.allele_balance(F.col("depth") - F.col("alt_reads"), F.col("alt_reads"))
    calls = survivors.withColumn("share", share).withColumn("qc_flags", flags).withColumn("qc_direction", rules.qc_direction(F.col("qc_flags"))).withColumn("qc_strength", rules.qc_strength(F.col("qc_flags"), F.col("depth"), F.col("gq"), F.lit(None).cast("boolean")))
    variants = survivors.select("variant_id", "site_key").distinct()
    ranking = tables.cut(scored(v))
    wanted = ranking.select("gene_key", F.substring("sample_id", 2, 9).cast("long").alias("subject_id")).distinct()
    mechanisms, nodes, links = graph(v)
    return [
        ledger.call_items(calls),
        ledger.variant_items(variants, v["consequences"], v["frequencies"], v["clinical"], "1.0"),
        ledger.selection_items(survivors),
        ledger.phenotype_items(gene_terms(v), states(v), ontology.exact_scores(gene_terms(v), states(v), wanted), wanted),
        ledger.rank_rows(ranking),
        ledger.mechanism_items(mechanisms, links, "1.0"),
        ledger.drug_items(mechanism.triage(agents(v), nodes, mechanisms)),
    ]


SQL_QC_CALLS = SQL_QC.replace("FROM variants)", "FROM judged WHERE triage LIKE 'kept%')").replace("SELECT *, CASE WHEN alt_reads IS NOT NULL AND depth > 0 THEN alt_reads / depth END AS fraction", "SELECT * EXCLUDE (fraction), CASE WHEN alt_reads IS NOT NULL AND depth > 0 THEN alt_reads / depth END AS fraction")


@query("evidence_ledger", f"""WITH {SQL_SCORED}, {SQL_TRIAGE}, {SQL_QC_CALLS}, {SQL_SAID}, {SQL_PARTS},
seen_ AS (SELECT DISTINCT contig, position, ref, alt, site_key FROM judged WHERE triage LIKE 'kept%'),
wanted_ AS (SELECT DISTINCT gene_key, CAST(substr(sample_id, 2) AS BIGINT) AS subject_id FROM ranks),
links_ AS (SELECT mechanism_id, node_id, CASE node_id % 3 WHEN 0 THEN 'strong' WHEN 1 THEN 'moderate' ELSE 'weak' END AS strength, node_id % 3 AS place FROM chain_ WHERE t IS NOT NULL),
every AS (
  SELECT 'quality' AS kind, direction, strength, 'observation' AS tier, concat(sample_id, contig, position, ref, alt) AS id FROM d
  UNION ALL SELECT 'consequence', CASE WHEN impact IN ('high', 'moderate') THEN 'supports' ELSE 'neutral' END, CASE impact WHEN 'high' THEN 'moderate' WHEN 'moderate' THEN 'supporting' WHEN 'low' THEN 'weak' ELSE 'insufficient' END, 'prediction', concat(contig, position, ref, alt, '|', tx_no) FROM seen_ JOIN consequences USING (site_key)
  UNION ALL SELECT 'frequency', 'neutral', 'moderate', 'database_assertion', concat(contig, position, ref, alt, population) FROM seen_ JOIN frequencies USING (site_key)
  UNION ALL SELECT 'missing_frequency', 'neutral', 'insufficient', 'inference', concat(contig, position, ref, alt) FROM seen_ WHERE site_key NOT IN (SELECT site_key FROM frequencies)
  UNION ALL SELECT 'clinical', CASE WHEN lower(significance) LIKE '%conflict%' THEN 'neutral' WHEN lower(significance) LIKE '%pathogenic%' THEN 'supports' WHEN lower(significance) LIKE '%benign%' THEN 'contradicts' ELSE 'neutral' END,
    CASE WHEN stars >= 3 THEN 'strong' WHEN stars = 2 THEN 'moderate' WHEN stars = 1 THEN 'supporting' ELSE 'weak' END, 'database_assertion', concat(contig, position, ref, alt, significance) FROM seen_ JOIN clinical USING (site_key)
  UNION ALL SELECT 'selection', 'neutral', 'moderate', 'inference', reason FROM (SELECT DISTINCT selection AS reason FROM judged WHERE triage LIKE 'kept%' UNION ALL SELECT 'all')
  UNION ALL SELECT 'phenotype_term', CASE p.status WHEN 'observed' THEN 'supports' WHEN 'excluded' THEN 'contradicts' ELSE 'neutral' END, CASE WHEN coalesce(p.status, '') NOT IN ('observed', 'excluded') THEN 'insufficient' WHEN weight >= 1 THEN 'strong' WHEN weight >= 0.8 THEN 'moderate' WHEN weight >= 0.6 THEN 'supporting' ELSE 'weak' END,
    'observation', concat(w.gene_key, '|', w.subject_id, '|', g.term) FROM wanted_ w JOIN gene_terms g ON g.gene_key = w.gene_key LEFT JOIN profile p ON p.subject_id = w.subject_id AND p.term = g.term
  UNION ALL SELECT 'phenotype_score', CASE WHEN s > 0.5 THEN 'supports' WHEN s < 0.5 THEN 'contradicts' ELSE 'neutral' END, CASE WHEN s >= 0.85 THEN 'strong' WHEN s >= 0.65 THEN 'moderate' WHEN s >= 0.40 THEN 'supporting' ELSE 'weak' END, 'inference', concat(gene_key, '|', subject_id)
    FROM (SELECT w.gene_key, w.subject_id, coalesce(p.score, 0.5) AS s FROM wanted_ w LEFT JOIN pheno p ON p.gene_key = w.gene_key AND p.subject_id = w.subject_id)
  UNION ALL SELECT 'component', CASE WHEN score >= 0.5 THEN 'supports' ELSE 'neutral' END, {SQL_STRENGTH.format("score")}, 'inference', concat(sample_id, '|', pair_id, '|', component) FROM parts_
  UNION ALL SELECT 'contradiction', 'contradicts', {SQL_STRENGTH.format("(0.5 + x.size)")}, 'inference', concat(sample_id, '|', x.of, '|', x.code) FROM said
  UNION ALL SELECT 'mechanism_chain', 'supports', coalesce(CASE max(place) WHEN 2 THEN 'weak' WHEN 1 THEN 'moderate' WHEN 0 THEN 'strong' END, 'insufficient'), 'database_assertion', CAST(m.mechanism_id AS VARCHAR) FROM mech m JOIN nation ON n_nationkey = m.mechanism_id LEFT JOIN links_ l ON l.mechanism_id = m.mechanism_id GROUP BY m.mechanism_id
  UNION ALL SELECT 'mechanism_link', CASE WHEN node_id % 2 = 0 THEN 'supports' ELSE 'neutral' END, strength, 'database_assertion', concat(mechanism_id, '|', node_id) FROM links_
  UNION ALL SELECT 'drug_direction', CASE WHEN agrees THEN 'supports' WHEN NOT agrees THEN 'contradicts' ELSE 'neutral' END, CASE WHEN agrees THEN 'moderate' WHEN NOT agrees THEN 'strong' ELSE 'insufficient' END, 'inference', concat(mechanism_id, '|', k) FROM r
  UNION ALL SELECT 'drug_verdict', CASE WHEN rejected THEN 'contradicts' ELSE 'neutral' END, CASE WHEN score >= 0.8 THEN 'strong' WHEN score >= 0.6 THEN 'moderate' WHEN score >= 0.4 THEN 'supporting' WHEN score >= 0.2 THEN 'weak' ELSE 'insufficient' END, 'inference', concat(mechanism_id, '|', k) FROM r)
SELECT kind, direction, strength, tier, count(DISTINCT id) AS n FROM every GROUP BY 1, 2, 3, 4""")
def evidence_ledger(v: Views) -> DataFrame:
    """The items of all stages, by kind, direction, strength and tier."""
    return ledger.emitted(*evidence_stages(v)).groupBy("kind", "direction", "strength", "tier").agg(F.count(F.lit(1)).alias("n"))


@query("rank_rows", f"""WITH {SQL_SCORED}, {SQL_SAID}, {SQL_PARTS},
for_ AS (SELECT sample_id, rank, CAST(count_if(score >= 0.5) AS INT) AS n_for FROM parts_ GROUP BY 1, 2), against_ AS (SELECT sample_id, rank, CAST(count(*) AS INT) AS n_against, bool_or(x.code = 'in_cis_phase') AS cis, list(DISTINCT x.code) AS codes FROM said GROUP BY 1, 2),
open_ AS (SELECT s.*, count(*) OVER (PARTITION BY s.sample_id) AS total, a.max_af IS NULL OR (CASE WHEN s.is_pair THEN b.max_af ELSE a.max_af END) IS NULL AS no_af, a.poor OR coalesce(b.poor, false) AS low
  FROM ranks s JOIN placed a ON a.sample_id = s.sample_id AND a.gene_key = s.gene_key AND a.variant_id = s.id_a LEFT JOIN placed b ON b.sample_id = s.sample_id AND b.gene_key = s.gene_key AND b.variant_id = s.id_b)
SELECT o.sample_id, CAST(o.rank AS INT) AS rank, o.total, o.pair_id, n_for, coalesce(n_against, 0) AS n_against, n_against IS NOT NULL AS has_contradictions, (o.is_pair AND o.phase = 'unknown') OR o.no_af OR o.low OR (NOT o.is_pair AND o.model = 'unknown') AS blocking,
  concat('validity #; rarity #; consequence #; inheritance #; phenotype #; mechanism #; evidence #; ', CASE WHEN n_against IS NULL THEN 'nothing speaks against it' ELSE concat('penalty for ', len(codes), ' codes') END, '; composite #; # open, # blocking; rank # of #') AS rationale
FROM open_ o JOIN for_ f ON f.sample_id = o.sample_id AND f.rank = o.rank LEFT JOIN against_ g ON g.sample_id = o.sample_id AND g.rank = o.rank""")
def rank_rows(v: Views) -> DataFrame:
    """Rank rows with the evidence they cite, their flags and a rationale (its figures masked here, its codes counted)."""
    rows = ledger.rank_rows(scored(v))
    has = lambda x: F.array_contains("flags", x)
    codes = F.size(F.split(F.regexp_extract("rationale", "penalty for ([^;]+)", 1), ", "))
    masked = F.regexp_replace(F.regexp_replace("rationale", "[0-9]+([.][0-9]+)?", "#"), "penalty for [^;]+", "penalty for")
    masked = F.replace(masked, F.lit("penalty for"), F.concat(F.lit("penalty for "), codes.cast("string"), F.lit(" codes")))
    return rows.select("sample_id", "rank", "total", "pair_id", F.size("supporting").alias("n_for"), F.size("contradicting").alias("n_against"), has("has_contradictions").alias("has_contradictions"), has("blocking_questions_open").alias("blocking"), masked.alias("rationale"))


@query("cited_evidence", f"""WITH {SQL_SCORED}, {SQL_SAID}, {SQL_PARTS}, c AS (SELECT 'for' AS side, sample_id FROM parts_ WHERE score >= 0.5 UNION ALL SELECT 'against', sample_id FROM said)
SELECT sample_id, side, count(*) AS n_cited, 0 AS n_unresolved FROM c GROUP BY ALL""")
def cited_evidence(v: Views) -> DataFrame:
    """Every id that a rank row cites is in the ledger."""
    rows = tables.cut(ledger.rank_rows(scored(v)))
    ids = ledger.emitted(rows).select("evidence_id", F.lit(1).alias("known"))
    cited = rows.select("sample_id", F.lit("for").alias("side"), F.explode("supporting").alias("evidence_id")).unionByName(rows.select("sample_id", F.lit("against").alias("side"), F.explode("contradicting").alias("evidence_id")))
    return cited.join(ids, "evidence_id", "left").groupBy("sample_id", "side").agg(F.count(F.lit(1)).alias("n_cited"), F.count_if(F.col("known").isNull()).cast("int").alias("n_unresolved"))


# ---- normalised calls into quality and selection -----------------------------------------------------------------------------------


@query("reference_quality", """
WITH s AS (SELECT p_partkey, p_size < 10 AS low, p_partkey % 10 = 0 AND p_partkey % 7 <> 0 AS wrong, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey % 10 <> 0 END AS matches, p_size FROM part)
SELECT p_partkey, matches, concat_ws(',', CASE WHEN low THEN 'low_depth' END, CASE WHEN wrong THEN 'reference_mismatch' END) AS flags, CASE WHEN low OR wrong THEN 'contradicts' ELSE 'supports' END AS direction, CASE WHEN wrong THEN 'strong' WHEN low THEN 'moderate' WHEN p_size >= 20 THEN 'strong' ELSE 'moderate' END AS strength FROM s""")
def reference_quality(v: Views) -> DataFrame:
    """Whether REF is what the reference has, carried from normalisation into flags, direction and strength."""
    calls, _, sequences = repeats(v)
    k = F.col("p_partkey")
    spoilt = calls.withColumn("ref", F.when(k % 10 == 0, F.concat(F.lit("T"), F.substring("ref", 2, 99))).otherwise(F.col("ref"))).join(v["part"].select("p_partkey", "p_size"), "p_partkey")
    normal = stages.normalised(spoilt, stages.reference_blocks(sequences))
    depth, gq, half = F.col("p_size"), F.lit(30), F.lit(0.5)
    df = normal.withColumn("flags", rules.qc_flags(F.lit("het"), half, half, depth, gq, F.lit("pass"), reference_matches=F.col("reference_matches")))
    return df.select("p_partkey", F.col("reference_matches").alias("matches"), joined("flags"), rules.qc_direction(F.col("flags")).alias("direction"), rules.qc_strength(F.col("flags"), depth, gq, F.col("reference_matches")).alias("strength"))


@query("selection_notes", f"""WITH {SQL_TRIAGED}, n AS (SELECT j.sample_id, j.selection, unnest(list_filter([CASE WHEN pathogenic THEN 'clinical_pathogenic_assertion' END,
    CASE WHEN j.max_af IS NULL THEN CASE WHEN coalesce(f.underpowered, '') <> '' THEN 'frequency_underpowered' ELSE 'frequency_unknown' END END,
    CASE WHEN selection <> 'dropped_common_in_population' AND n_cons > 0 AND NOT any_selecting AND splice_ai >= 0.2 THEN 'splice_ai_above_threshold' END], lambda x: x IS NOT NULL)) AS note
  FROM judged j LEFT JOIN freq f ON f.site_key = j.site_key WHERE triage LIKE 'kept%')
SELECT sample_id, selection, note, count(*) AS n FROM n GROUP BY ALL""")
def selection_notes(v: Views) -> DataFrame:
    """B27, D-7: the notes of the selection beside its reasons."""
    return judged(v).select("sample_id", "selection", F.explode("notes").alias("note")).groupBy("sample_id", "selection", "note").agg(F.count(F.lit(1)).alias("n"))


@query("plausible_candidates", f"""WITH {SQL_TRIAGED} SELECT sample_id, max_af IS NULL OR max_af <= 0.01 AS plausible_candidate, count(*) AS n FROM judged WHERE triage LIKE 'kept%' GROUP BY ALL""")
def plausible_candidates(v: Views) -> DataFrame:
    """Calls that a recessive hypothesis could use."""
    return annotate.plausible(judged(v)).groupBy("sample_id", "plausible_candidate").agg(F.count(F.lit(1)).alias("n"))


@query("annotation_replacements", """SELECT CASE WHEN p_partkey % 11 = 0 THEN 'added' WHEN p_partkey % 8 = 0 THEN 'removed' WHEN p_partkey % 6 = 0 THEN 'replaced' ELSE 'unchanged' END AS state, count(*) AS n FROM part GROUP BY 1""")
def annotation_replacements(v: Views) -> DataFrame:
    """What a second predictor's annotations replaced."""
    old = v["consequences"].select("site_key", "tx_no", "impact", "terms")
    new = old.filter("site_key % 8 <> 0").withColumn("terms", F.when(F.col("site_key") % 6 == 0, F.concat("terms", F.lit("&other"))).otherwise(F.col("terms")))
    more = v["part"].filter("p_partkey % 11 = 0").select(F.col("p_partkey").alias("site_key"), F.lit(0).alias("tx_no"), F.lit("low").alias("impact"), F.lit("intron_variant").alias("terms"))
    return annotate.replacement_counts(old, new.unionByName(more), ["site_key"])


# ---- files and consequences -----------------------------------------------------------------------------------------------------------


@query("file_claims", """
SELECT concat('f', c_custkey) AS path, c_custkey % 4 <> 3 AS synthetic_mark, CAST(CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 0 END AS BIGINT) AS n_unmarked, c_custkey % 5 > 1 AND c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AS sites_only,
  c_custkey % 4 <> 3 AND c_custkey % 5 <> 0 AS declares_synthetic FROM customer""")
def file_claims(v: Views) -> DataFrame:
    """A small file for each customer: some without a mark, with named samples, with made-up samples, stapled, or with a short row."""
    k = F.col("c_custkey")
    samples = F.when(k % 5 == 0, "\tFORMAT\tP1\tP2").when(k % 5 == 1, "\tFORMAT\tSYNTH_1").otherwise("")
    header = F.concat(F.lit(vcf.SITES_HEADER), samples)
    row = F.concat(F.lit("chr1\t5\t.\tA\tC\t.\tPASS\t"), F.col("c_name"))
    lines = F.array_compact(F.array(
        F.when(k % 4 != 3, "##x_synthetic=true"), F.lit("##fileformat=VCFv4.2"), F.when(k % 4 == 3, F.concat(F.lit("##"), F.lpad(F.lit("."), 5_000, "."))), F.when(k % 4 == 3, "##late_synthetic=true"), header, row,
        F.when(k % 7 == 0, "##fileformat=VCFv4.2"), F.when(k % 11 == 0, "chr1\t6"), F.lit(""),
    ))
    at = F.transform("l", lambda x, i: F.aggregate(F.slice("l", F.lit(1), i), F.lit(0).cast("long"), lambda n, y: n + F.octet_length(y) + 1))
    rows = v["customer"].select(F.concat(F.lit("f"), k.cast("string")).alias("path"), lines.alias("l")).select("path", F.explode(F.arrays_zip(at.alias("at"), F.col("l").alias("value"))).alias("z"))
    return vcf.file_claims(rows.select("path", "z.at", "z.value"))


@query("release_coverage", """
WITH p AS (SELECT concat('r', p_size % 3) AS path, 1 + p_partkey % 22 AS c, p_partkey % 40 = 0 AS bare FROM part), g AS (SELECT concat('r', r_regionkey % 3) AS path, string_agg(concat('g', chr(CAST(97 + r_regionkey AS INT))), ',' ORDER BY r_regionkey) AS groups FROM region GROUP BY 1)
SELECT p.path, concat('chr', c) AS contig, CASE WHEN bare THEN CAST(c AS VARCHAR) ELSE concat('chr', c) END AS raw, count(*) AS n, concat('all,', groups) AS populations FROM p JOIN g ON g.path = p.path GROUP BY ALL""")
def release_coverage(v: Views) -> DataFrame:
    """Contigs, as three releases write them, and populations."""
    k = F.col("p_partkey")
    name = F.concat(F.when(k % 40 == 0, "").otherwise("chr"), (1 + k % 22).cast("string"))
    body = v["part"].select(F.concat(F.lit("r"), (F.col("p_size") % 3).cast("string")).alias("path"), F.concat_ws("\t", name, (k + 1).cast("string"), F.lit("."), F.lit("A"), F.lit("C"), F.lit("."), F.lit("PASS"), F.lit("AF=0.1")).alias("value"))
    group = F.concat(F.lit("##INFO=<ID=AF_g"), F.char(97 + F.col("r_regionkey")), F.lit(",Number=A>"))
    head = v["region"].select(F.concat(F.lit("r"), (F.col("r_regionkey") % 3).cast("string")).alias("path"), group.alias("value"))
    return vcf.release_coverage(head.union(body)).select("path", "contig", "raw", "n", joined("populations"))


@query("worst_impact_by_gene", """SELECT site_key, gene_key, coalesce(CASE min(CASE impact WHEN 'high' THEN 0 WHEN 'moderate' THEN 1 WHEN 'low' THEN 2 WHEN 'modifier' THEN 3 END) WHEN 0 THEN 'high' WHEN 1 THEN 'moderate' WHEN 2 THEN 'low' WHEN 3 THEN 'modifier' END, 'not assessed') AS worst_impact
FROM (SELECT site_key, gene_key + tx_no AS gene_key, impact FROM consequences UNION ALL SELECT site_key, gene_key, 'modifier' FROM consequences WHERE site_key % 3 = 0) q GROUP BY 1, 2""")
def worst_impact_by_gene(v: Views) -> DataFrame:
    """D-2: worst impacts of sites in each of two genes."""
    rows = v["consequences"].select("site_key", (F.col("gene_key") + F.col("tx_no")).alias("gene_key"), "impact")
    more = v["consequences"].filter("site_key % 3 = 0").select("site_key", "gene_key", F.lit("modifier").alias("impact"))
    return annotate.worst_by_gene(rows.unionByName(more), ["site_key", "gene_key"]).select("site_key", "gene_key", F.coalesce("worst_impact", F.lit("not assessed")).alias("worst_impact"))


@query("consequence_order", """
WITH c AS (SELECT site_key, tx_no, k, is_mane AND k = 0 AS mane, (site_key + tx_no + k) % 3 = 0 AS canonical, concat('T', (site_key + k) % 4) AS tx, concat('G', (gene_key + tx_no) % 3) AS gene, impact, terms FROM consequences CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) x)
SELECT site_key, tx_no, k, CAST(row_number() OVER (PARTITION BY site_key ORDER BY NOT mane, NOT canonical, tx, gene, CASE impact WHEN 'high' THEN 0 WHEN 'moderate' THEN 1 WHEN 'low' THEN 2 WHEN 'modifier' THEN 3 ELSE 9 END, terms, concat('c.', k, '.', tx_no)) AS INT) AS place FROM c""")
def consequence_order(v: Views) -> DataFrame:
    """The place of each consequence of a site in the total order."""
    each = v["consequences"].withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    rows = each.select(
        "site_key", "tx_no", "k", (F.col("is_mane") & (F.col("k") == 0)).alias("is_mane"), ((F.col("site_key") + F.col("tx_no") + F.col("k")) % 3 == 0).alias("is_canonical"), F.concat(F.lit("T"), ((F.col("site_key") + F.col("k")) % 4).cast("string")).alias("transcript_id"),
        F.concat(F.lit("G"), ((F.col("gene_key") + F.col("tx_no")) % 3).cast("string")).alias("gene_symbol"), "impact", "terms", F.concat_ws(".", F.lit("c"), "k", "tx_no").alias("hgvs_c"),
    )
    return rows.select("site_key", "tx_no", "k", F.row_number().over(Window.partitionBy("site_key").orderBy(*annotate.consequence_order(rows))).alias("place"))


# ---- the store ---------------------------------------------------------------------------------------------------------------------


def store_tables(v: Views) -> dict[str, DataFrame]:
    """All tables of the store, for the calls that triage kept."""
    survivors = tables.cut(pairs.with_order(judged(v)))
    flags = rules.qc_flags(F.col("zygosity"), F.col("share"), F.col("share"), F.col("depth"), F.col("gq"), F.col("filter_status"))
    calls = survivors.withColumn("share", alleles.allele_balance(F.col("depth") - F.col("alt_reads"), F.col("alt_reads"))).withColumn("qc_flags", flags)
    ranking = tables.cut(scored(v))
    rows = tables.cut(ledger.rank_rows(ranking))
    mechanisms, nodes, links = graph(v)
    triaged = tables.cut(mechanism.triage(agents(v), nodes, mechanisms))
    run = schemas.run_row(v.spark, "cohort", "GRCh38", "default", "2024-01-01T00:00:00")
    run_id = run.first().run_id
    items = builders.evidence_items(tables.cut(ledger.emitted(rows, ledger.drug_items(triaged), ledger.mechanism_items(mechanisms, links, "1.0"))), run_id)
    edges = compare.edges(ranking.select(F.concat_ws("|", "sample_id", "pair_id").alias("pair_id"), "gene_key", "members")).unionByName(compare.drug_edges(triaged))
    files = tables.text_file(v["nation"].select(F.col("n_name").alias("value")))
    return {
        "variants": builders.variants(calls, "GRCh38", "calls", run_id), "consequences": builders.consequences(survivors, v["consequences"], "predictor", "1"), "frequencies": builders.frequencies(survivors, v["frequencies"], "cohort", "1"),
        "clinical_assertions": builders.clinical_assertions(survivors, v["clinical"], "curated", "1"), "phenotype_observations": builders.phenotype_observations(states(v), "profile", "1"),
        "genes": builders.genes(placed_calls(v).filter("place <= 24")), "candidate_pairs": builders.candidate_pairs(ranking, rows), "evidence_items": items, "citations": builders.citations(items),
        "mechanisms": builders.mechanisms(mechanisms, nodes, links), "mechanism_nodes": builders.mechanism_nodes(nodes), "mechanism_links": builders.mechanism_links(links), "drugs": builders.drugs(triaged), "drug_rejections": builders.drug_rejections(triaged),
        "pipeline_runs": builders.pipeline_runs(run, {"variantloom": "1"}, {"cohort": "1"}), "artifact_provenance": builders.artifact_provenance(schemas.provenance(v.spark, files, run_id, "text", "test").filter("artifact_id LIKE 'part-%'").groupBy("run_id", "kind", "produced_by_stage").agg(F.lit("lines").alias("artifact_id"), F.first("relative_path").alias("relative_path"), F.sha2(F.array_join(F.array_sort(F.collect_list("content_hash")), ""), 256).alias("content_hash"), F.sum("size_bytes").alias("size_bytes"))),
        "graph_edges": builders.graph_edges(edges),
    }


@query("store_commit", f"""WITH {SQL_SCORED}, {SQL_TRIAGE}, {SQL_SAID}, {SQL_PARTS},
kept_ AS (SELECT * FROM judged WHERE triage LIKE 'kept%'), links_ AS (SELECT * FROM chain_ WHERE t IS NOT NULL),
why_ AS (SELECT k, unnest(list_filter([NOT in_chain, coalesce(agrees = false, false), onco, conc, NOT repurposable, NOT cin AND (worse OR worse IS NULL), k % 5 = 0 OR k % 8 = 0 OR (neuro AND k % 4 <> 1), in_chain AND NOT at_target, quality < 0.30, k % 3 = 0, agrees IS NULL], lambda x: coalesce(x, false))) AS x FROM r WHERE rejected),
counts AS (
  SELECT 'variants' AS name, count(*) AS n FROM kept_ UNION ALL SELECT 'consequences', count(*) FROM kept_ JOIN consequences USING (site_key) UNION ALL SELECT 'frequencies', count(*) FROM kept_ JOIN frequencies USING (site_key)
  UNION ALL SELECT 'clinical_assertions', count(*) FROM kept_ JOIN clinical USING (site_key) UNION ALL SELECT 'phenotype_observations', count(*) FROM profile UNION ALL SELECT 'genes', count(DISTINCT gene_key) FROM mem UNION ALL SELECT 'candidate_pairs', count(*) FROM ranks
  UNION ALL SELECT 'evidence_items', (SELECT count(*) FROM parts_) + (SELECT count(DISTINCT concat(sample_id, '|', x.of, '|', x.code)) FROM said) + 2 * (SELECT count(*) FROM r) + (SELECT count(*) FROM links_) + (SELECT count(*) FROM nation JOIN mech ON mechanism_id = n_nationkey)
  UNION ALL SELECT 'citations', CASE WHEN EXISTS (SELECT 1 FROM nation JOIN mech ON mechanism_id = n_nationkey) THEN 1 ELSE 0 END + CASE WHEN EXISTS (SELECT 1 FROM links_) THEN 1 ELSE 0 END UNION ALL SELECT 'mechanisms', count(*) FROM nation JOIN mech ON mechanism_id = n_nationkey UNION ALL SELECT 'mechanism_nodes', count(*) FROM nodes UNION ALL SELECT 'mechanism_links', count(*) FROM links_
  UNION ALL SELECT 'drugs', count(*) FROM r UNION ALL SELECT 'drug_rejections', count(*) FROM why_ UNION ALL SELECT 'pipeline_runs', 1 UNION ALL SELECT 'artifact_provenance', 1
  UNION ALL SELECT 'graph_edges', (SELECT count(*) + sum(CASE WHEN is_pair THEN 2 ELSE 1 END) FROM ranks) + (SELECT count(*) FROM r))
SELECT name, CAST(CASE WHEN name IN ('drugs', 'variants') THEN 2 ELSE 1 END AS INT) AS version, CAST(n AS BIGINT) AS n_rows, CASE name WHEN 'drugs' THEN (SELECT count(*) FROM r WHERE k % 2 = 0) WHEN 'variants' THEN (SELECT count(*) FROM kept_ WHERE position % 10 = 0) ELSE 0 END AS n_changed FROM counts""")
def store_commit(v: Views) -> DataFrame:
    """All tables in one commit, then two of them in a second; a version's tables, their rows, and what the second commit changed."""
    store = schemas.Store(v.spark, tables.new_path(v.spark, "store"))
    store.commit(store_tables(v))
    drugs, calls = store.table("drugs"), store.table("variants")
    store.commit({
        "drugs": drugs.filter(F.col("drug_id").cast("long") % 2 == 0).withColumn("pk_notes", F.lit("seen again")),
        "variants": calls.filter("position % 10 = 0").withColumn("source_artifact", F.lit("second delivery")),
    })
    changed = {"drugs": F.col("pk_notes") == "seen again", "variants": F.col("source_artifact") == "second delivery"}
    out = None
    for name, entry in store.manifest().items():
        count = F.count_if(changed[name]) if name in changed else F.lit(0).cast("long")
        one = store.table(name).agg(F.count(F.lit(1)).alias("n_rows"), count.alias("n_changed")).select(F.lit(name).alias("name"), F.lit(entry["version"]).alias("version"), "n_rows", "n_changed")
        out = one if out is None else out.unionByName(one)
    return out
