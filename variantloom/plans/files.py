"""Registered queries over text sources, sinks and knowledge builders.

The text comes from the given tables: Spark writes each row as the line that a file of that kind would have, the source parses
it, and the equivalent SQL says what must come out of the table itself. Registered through registry.query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.functions import alleles, rules
from variantloom.operators import annotate, compare, mechanism, ontology, pairs, stages, tables, textscan
from variantloom.plans.registry import SQL_GRAPH, SQL_SCORED, SQL_TRIAGE, agents, gene_terms, graph, joined, query, scored
from variantloom.plans.views import Views
from variantloom.sources import knowledge, vcf
from variantloom.sources import tables as source


def text(*columns: F.Column | str, sep: str = "\t") -> F.Column:
    return F.concat_ws(sep, *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns])


def coded(head: str, column: str) -> F.Column:
    return F.concat(F.lit(head), F.col(column).cast("string"))


# ---- VCF text ---------------------------------------------------------------------------------------------------------------


def vcf_record(genotype: F.Column | None = None) -> F.Column:
    """The record of an order line: bare contigs, two ALTs on every third line number, some positions spoilt."""
    two = F.col("l_linenumber") % 3 == 0
    gt = F.when(two, "1/2").when(F.col("zygosity") == "hom_alt", "1/1").when((F.col("hap_slot") == 1) & F.col("phase_set").isNotNull(), "0|1").otherwise("0/1")
    ad = F.concat_ws(",", F.col("l_linenumber").cast("string"), (F.col("l_orderkey") % 7).cast("string"), F.when(two, (F.col("l_partkey") % 5).cast("string")))
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    status = F.when(F.col("filter_status") == "pass", "PASS").when(F.col("filter_status") == "filtered", "q10").otherwise(".")
    position = F.when(F.col("l_orderkey") % 211 == 0, 0).otherwise(F.col("position"))
    sample = text(gt if genotype is None else F.when(genotype.isNotNull(), genotype).otherwise(gt), ad, known("depth"), known("gq"), known("phase_set"), sep=":")
    return text(F.substring("contig", 4, 2), position, F.lit("."), "ref", F.when(two, "AT,CG").otherwise("AT"), F.col("l_orderkey") % 1000, status, F.lit("DP=9"), F.lit("GT:AD:DP:GQ:PS"), sample)


def vcf_lines(v: Views) -> DataFrame:
    """A record for each order line."""
    return v["variants"].select(F.lit("one").alias("path"), vcf_record().alias("value"))


@query("vcf_calls", """
WITH b AS (SELECT *, l_linenumber % 3 = 0 AS two FROM variants WHERE l_orderkey % 211 <> 0), a AS (SELECT *, unnest(CASE WHEN two THEN [1, 2] ELSE [1] END) AS k FROM b)
SELECT contig, CAST(k AS INT) AS alt_index, CASE WHEN NOT two AND zygosity = 'hom_alt' THEN 'hom_alt' ELSE 'het' END AS zygosity, filter_status, two AS was_split, NOT two AND zygosity <> 'hom_alt' AND hap_slot = 1 AND phase_set IS NOT NULL AS phased, count(*) AS n,
  CAST(sum(coalesce(depth, l_linenumber + l_orderkey % 7 + CASE WHEN two THEN l_partkey % 5 ELSE 0 END)) AS BIGINT) AS depths, CAST(sum(l_linenumber) AS BIGINT) AS ref_reads, CAST(sum(CASE k WHEN 1 THEN l_orderkey % 7 ELSE l_partkey % 5 END) AS BIGINT) AS alt_reads,
  CAST(coalesce(sum(gq), 0) AS BIGINT) AS gqs, CAST(coalesce(sum(phase_set), 0) AS BIGINT) AS phase_sets, CAST(sum(l_orderkey % 1000) AS DOUBLE) AS qualities FROM a GROUP BY 1, 2, 3, 4, 5, 6""")
def vcf_calls(v: Views) -> DataFrame:
    """Records, alleles and genotypes of VCF text."""
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    return vcf.called(vcf.records(vcf_lines(v))).groupBy("contig", "alt_index", "zygosity", "filter_status", "was_split", "phased").agg(
        F.count(F.lit(1)).alias("n"), total("depth", "depths"), total("ref_reads", "ref_reads"), total("alt_reads", "alt_reads"), total("gq", "gqs"), total("phase_set", "phase_sets"), F.sum("quality").alias("qualities"))


@query("vcf_profile", """SELECT CASE filter_status WHEN 'pass' THEN 'PASS' WHEN 'filtered' THEN 'q10' ELSE '.' END AS filter, count(*) AS n, round(avg(CASE WHEN l_linenumber % 3 = 0 THEN 1.0 ELSE 0.0 END), 6) AS multiallelic, 1.0::DOUBLE AS indel FROM variants WHERE l_orderkey % 211 <> 0 GROUP BY 1""")
def vcf_profile(v: Views) -> DataFrame:
    """A3: filter histogram and record shapes."""
    return vcf.callset_profile(vcf.records(vcf_lines(v)))


@query("contig_styles", """SELECT 'ensembl' AS style, count(*) AS n FROM variants WHERE l_orderkey % 211 <> 0""")
def contig_styles(v: Views) -> DataFrame:
    """A3: how the contigs of a callset are written."""
    return vcf.contig_styles(vcf.records(vcf_lines(v)))


@query("vcf_headers", """
SELECT r_name AS path, CASE r_regionkey % 3 WHEN 0 THEN 'GRCh38' WHEN 1 THEN 'GRCh37' END AS build, CASE r_regionkey % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'build_mismatch' ELSE 'build_not_declared' END AS verdict,
  string_agg(concat('F', n_nationkey), ',' ORDER BY concat('F', n_nationkey)) AS filters, string_agg(concat('S', n_nationkey), ',' ORDER BY n_nationkey) AS samples FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name, r_regionkey""")
def vcf_headers(v: Views) -> DataFrame:
    """A header for each region; its nations are filters and samples."""
    met = v["region"].join(v["nation"], F.col("n_regionkey") == F.col("r_regionkey"))
    filters = met.select(F.col("r_name").alias("path"), F.concat(F.lit("##FILTER=<ID=F"), F.col("n_nationkey").cast("string"), F.lit(',Description="x">')).alias("value"))
    build = v["region"].filter("r_regionkey % 3 < 2").select(F.col("r_name").alias("path"), F.when(F.col("r_regionkey") % 3 == 0, "##reference=file:///GRCh38.fa").otherwise("##assembly=hg19").alias("value"))
    names = met.groupBy(F.col("r_name").alias("path")).agg(F.array_sort(F.collect_list("n_nationkey")).alias("k"))
    names = names.select("path", F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"), F.array_join(F.transform("k", lambda x: F.concat(F.lit("S"), x.cast("string"))), "\t")).alias("value"))
    facts = vcf.header_facts(filters.union(build).union(names))
    return facts.select("path", "build", vcf.build_verdict(F.col("build"), "GRCh38").alias("verdict"), joined("filters"), joined("samples"))


# ---- sites tables ---------------------------------------------------------------------------------------------------------


def site_lines(v: Views, info: F.Column, keep: F.Column | None = None) -> DataFrame:
    k = F.col("p_partkey")
    line = text(F.concat(F.lit("chr"), (1 + k % 22).cast("string")), k * 1000 + 1, coded("V", "p_partkey"), F.lit("A"), F.when(k % 5 == 0, "G,T").otherwise("G"), F.lit("."), F.lit("PASS"), info)
    rows = v["part"] if keep is None else v["part"].filter(keep)
    return rows.select(F.lit("sites").alias("path"), line.alias("value"))


@query("frequency_lookup", """
WITH a AS (SELECT p_partkey AS k, p_size, unnest(CASE WHEN p_partkey % 5 = 0 THEN [1, 2] ELSE [1] END) AS i FROM part WHERE p_partkey % 11 <> 0),
f AS (SELECT k, i, g AS population, (k % 7 + i) / 1000.0 AS af, k % 100 + i AS ac, p_size * 100 AS an FROM a CROSS JOIN (SELECT unnest(['all', 'nfe']) AS g) g WHERE NOT (g = 'nfe' AND k % 3 = 0)),
w AS (SELECT p_partkey AS k, 1 AS i FROM part)
SELECT w.k AS site, population, round(CAST(af AS DOUBLE), 6) AS af, CAST(coalesce(ac, -1) AS BIGINT) AS ac, CAST(coalesce(an, -1) AS BIGINT) AS an FROM w LEFT JOIN f ON f.k = w.k AND f.i = w.i""")
def frequency_lookup(v: Views) -> DataFrame:
    """A sites table split by ALT and population, looked up by (contig, position, ref, alt)."""
    k = F.col("p_partkey")
    per_alt = lambda f: F.when(k % 5 == 0, F.concat_ws(",", f(1), f(2))).otherwise(f(1))
    af, ac = per_alt(lambda i: F.format_string("0.%03d", k % 7 + i)), per_alt(lambda i: (k % 100 + i).cast("string"))
    own = lambda s: F.concat(F.lit(f"AF{s}="), af, F.lit(f";AC{s}="), ac, F.lit(f";AN{s}="), (F.col("p_size") * 100).cast("string"))
    info = F.when(k % 11 == 0, "flag").when(k % 3 == 0, own("")).otherwise(F.concat(own(""), F.lit(";"), own("_nfe")))
    sites = vcf.site_frequencies(vcf.records(site_lines(v, info)), ["nfe"])
    asked = v["part"].select(k.alias("site"), F.concat(F.lit("chr"), (1 + k % 22).cast("string")).alias("contig"), (k * 1000 + 1).alias("position"), F.lit("A").alias("ref"), F.lit("G").alias("alt"))
    met = annotate.lookup(asked, sites.select("contig", "position", "ref", "alt", "population", "af", "ac", "an"), ["contig", "position", "ref", "alt"])
    return met.select("site", "population", F.round("af", 6).alias("af"), *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("ac", "an")])


@query("clinical_sites", """
SELECT p_partkey AS site, CASE p_partkey % 3 WHEN 0 THEN 'Likely pathogenic' WHEN 1 THEN 'Conflicting classifications, of pathogenicity' ELSE 'Benign' END AS significance,
  CASE p_partkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE -1 END AS stars, CASE p_partkey % 3 WHEN 0 THEN 'supports' WHEN 1 THEN 'neutral' ELSE 'contradicts' END AS direction, concat('Disease ', p_size) AS conditions, unnest(CASE WHEN p_partkey % 5 = 0 THEN ['G', 'T'] ELSE ['G'] END) AS alt FROM part WHERE p_partkey % 6 <> 5""")
def clinical_sites(v: Views) -> DataFrame:
    """Assertions of each ALT with decoded text, stars and direction; records without an assertion are left out."""
    k = F.col("p_partkey")
    sig = F.when(k % 3 == 0, "Likely_pathogenic").when(k % 3 == 1, "Conflicting_classifications%2C_of_pathogenicity").otherwise("Benign")
    status = F.when(k % 4 == 0, "reviewed_by_expert_panel").when(k % 4 == 1, "criteria_provided,_single_submitter").when(k % 4 == 2, "no_assertion_provided").otherwise("something_else")
    info = F.when(k % 6 == 5, "OTHER=1").otherwise(F.concat(F.lit("CLNSIG="), sig, F.lit(";CLNREVSTAT="), status, F.lit(";CLNDN=not_provided|Disease_"), F.col("p_size").cast("string")))
    found = vcf.assertions(vcf.records(site_lines(v, info)))
    return found.select(((F.col("position") - 1) / 1000).cast("long").alias("site"), "significance", F.coalesce("stars", F.lit(-1)).alias("stars"), rules.significance_direction(F.col("significance")).alias("direction"), joined("conditions"), "alt")


@query("assertions_by_site", """SELECT site_key, string_agg(concat(significance, '*', stars), ',' ORDER BY concat(significance, '*', stars)) AS assertions FROM clinical GROUP BY site_key""")
def assertions_by_site(v: Views) -> DataFrame:
    """C4: all assertions of a site, in order."""
    return v["clinical"].groupBy("site_key").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("*", "significance", F.col("stars").cast("string")))), ",").alias("assertions"))


@query("predicted_transcripts", """
SELECT CASE WHEN p_partkey % 10 = 0 THEN 'incomplete' WHEN p_partkey % 7 = 0 THEN 'unplaceable' ELSE 'ok' END AS verdict, CASE WHEN p_partkey % 10 <> 0 THEN 'moderate' ELSE 'low' END AS impact, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS sites FROM part GROUP BY 1, 2""")
def predicted_transcripts(v: Views) -> DataFrame:
    """A predictor's field, one row per transcript."""
    k = F.col("p_partkey")
    full = F.concat(F.lit("ANN=G|missense_variant|MODERATE|"), F.when(k % 7 == 0, "").otherwise(coded("G", "p_partkey")), F.lit("|E1|transcript|T1|protein|1/2|c.1|p.1|1|2|3|4|"))
    found = vcf.predicted(vcf.records(site_lines(v, F.when(k % 10 == 0, "ANN=G|x|LOW").otherwise(full)).withColumn("value", F.replace("value", F.lit("G,T"), F.lit("G")))))
    return found.groupBy("verdict", "impact").agg(F.count(F.lit(1)).alias("n"), F.sum(((F.col("position") - 1) / 1000).cast("long")).alias("sites"))


# ---- genes and ontologies -------------------------------------------------------------------------------------------------


@query("gene_models", """
WITH g AS (SELECT concat('E', p_partkey, '.1') AS gene_id, concat('G', p_partkey) AS symbol, concat('chr', 1 + p_partkey % 22) AS contig FROM part WHERE p_partkey % 13 <> 0),
s AS (SELECT concat('E', p_partkey, '.1') AS gene_id, CASE WHEN p_partkey % 17 = 0 THEN 'X' ELSE concat('G', p_partkey) END AS symbol, concat('T', p_partkey, '.2', CASE WHEN p_partkey % 4 = 0 THEN concat(',T', p_partkey, '.1') ELSE '' END) AS transcripts FROM part WHERE p_partkey % 9 <> 0)
SELECT coalesce(g.gene_id, s.gene_id) AS gene_id, contig, transcripts, CASE WHEN s.gene_id IS NULL THEN 'not_in_summary' WHEN g.gene_id IS NULL THEN 'not_in_gtf' WHEN g.symbol <> s.symbol THEN 'symbol_differs' ELSE 'ok' END AS verdict FROM g FULL JOIN s ON s.gene_id = g.gene_id""")
def gene_models(v: Views) -> DataFrame:
    """Genes of a GTF with the transcripts of a summary, Select first."""
    met = knowledge.joined_genes(gtf(v).filter("verdict = 'ok'").drop("verdict"), knowledge.summary_genes(summary(v)))
    return met.select("gene_id", "contig", joined("transcripts"), "verdict")


def gtf(v: Views) -> DataFrame:
    k = F.col("p_partkey")
    contig = F.when(k % 13 == 0, "KI270728.1").otherwise(F.concat(F.lit("chr"), (1 + k % 22).cast("string")))
    attributes = F.concat(F.lit('gene_id "E'), k.cast("string"), F.lit('.1"; gene_name "G'), k.cast("string"), F.lit('";'))
    return source.gtf_genes(v.spark, tables.text_file(v["part"].select(text(contig, F.lit("src"), F.lit("gene"), k * 10 + 1, k * 10 + 9, F.lit("."), F.lit("+"), F.lit("."), attributes).alias("value"))))


def summary(v: Views) -> DataFrame:
    k = F.col("p_partkey")
    base = v["part"].filter("p_partkey % 9 <> 0").select(k.alias("k"), F.concat(F.lit("E"), k.cast("string"), F.lit(".1")).alias("gene_id"), F.when(k % 17 == 0, "X").otherwise(coded("G", "p_partkey")).alias("symbol"))
    one = base.select("gene_id", "symbol", F.concat(F.lit("T"), F.col("k").cast("string"), F.lit(".2")).alias("transcript"), F.lit("MANE Select").alias("status"))
    return one.union(base.filter("k % 4 = 0").select("gene_id", "symbol", F.concat(F.lit("T"), F.col("k").cast("string"), F.lit(".1")).alias("transcript"), F.lit("MANE Plus Clinical").alias("status")))


@query("gene_lookups", """
SELECT concat('G', p_partkey) AS gene_symbol, p_partkey % 13 <> 0 AS found, CAST(CASE WHEN p_partkey % 13 <> 0 THEN p_partkey * 10 + 1 ELSE -1 END AS BIGINT) AS g_start, p_partkey % 9 <> 0 AS selected FROM part""")
def gene_lookups(v: Views) -> DataFrame:
    """Every symbol with its gene, found or missing, and whether it has a Select transcript."""
    genes = gtf(v).filter("verdict = 'ok'")
    asked = v["part"].select(coded("G", "p_partkey").alias("gene_symbol"), coded("T", "p_partkey").alias("transcript_id"))
    chosen = knowledge.select_ids(summary(v)).withColumn("s_", F.lit(True))
    met = knowledge.gene_lookup(genes, asked, "gene_symbol").join(chosen, "transcript_id", "left")
    return met.select("gene_symbol", "found", F.coalesce("g_start", F.lit(-1)).alias("g_start"), F.coalesce("s_", F.lit(False)).alias("selected"))


@query("off_primary_genes", "SELECT p_partkey % 13 <> 0 AS is_primary, count(*) AS n FROM part GROUP BY 1")
def off_primary_genes(v: Views) -> DataFrame:
    """Genes skipped off the primary assembly."""
    return knowledge.off_primary_counts(gtf(v))


@query("term_resolution", """
WITH r AS (SELECT c_custkey AS k, CASE WHEN c_custkey = 0 THEN NULL WHEN c_custkey % 343 = 0 THEN c_custkey - 57 WHEN c_custkey % 49 = 0 THEN c_custkey - 8 WHEN c_custkey % 7 = 0 THEN c_custkey - 1 ELSE c_custkey END AS t FROM customer)
SELECT printf('HP:%07d', k) AS id, printf('HP:%07d', t) AS term FROM r UNION ALL SELECT printf('HP:9%06d', k), printf('HP:%07d', t) FROM r WHERE k % 5 = 0 UNION ALL SELECT printf('HP:8%06d', k), NULL FROM r WHERE k % 6 = 0""")
def term_resolution(v: Views) -> DataFrame:
    """An ontology file; obsolete terms forward once, twice or three times, other ids are aliases or unknown."""
    k = F.col("c_custkey")
    hp = lambda x: F.format_string("HP:%07d", x)
    gone = F.when(k % 343 == 0, k - 49).when(k % 49 == 0, k - 7).otherwise(k - 1)
    alias = F.when(k % 5 == 0, F.concat(F.lit("alt_id: "), F.format_string("HP:9%06d", k), F.lit("\n"))).otherwise("")
    rest = F.when(k % 7 == 0, F.concat(F.lit("is_obsolete: true\nreplaced_by: "), hp(gone))).otherwise(F.concat(F.lit("is_a: "), hp(((k - k % 3) / 3).cast("long")), F.lit(" ! parent")))
    stanza = F.concat(F.lit("[Term]\nid: "), hp(k), F.lit("\nname: term\n"), alias, rest, F.lit("\n"))
    terms, _, aliases = source.ontology_tables(source.obo_terms(v.spark, tables.text_file(v["customer"].select(stanza.alias("value")))))
    ids = v["customer"].select(hp(k).alias("id")).union(v["customer"].filter("c_custkey % 5 = 0").select(F.format_string("HP:9%06d", k))).union(v["customer"].filter("c_custkey % 6 = 0").select(F.format_string("HP:8%06d", k)))
    return ontology.resolved(ids, terms, aliases)


@query("phenotype_table", """
WITH r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE printf('HP:%07d', c_custkey - CASE WHEN c_custkey % 20 = 0 THEN 1 ELSE 0 END) END AS term, CASE c_custkey % 5 WHEN 0 THEN 'observed' WHEN 1 THEN 'excluded' WHEN 2 THEN 'not_assessed' WHEN 3 THEN 'uncertain' END AS status FROM customer)
SELECT term, status, CASE WHEN term IS NULL THEN 'bad_term' WHEN status IS NULL THEN 'unknown_status' WHEN count(*) OVER (PARTITION BY term) > 1 THEN 'duplicate_term' ELSE 'ok' END AS verdict FROM r""")
def phenotype_table(v: Views) -> DataFrame:
    """A commented table of terms and status tokens, with a verdict on each row."""
    k = F.col("c_custkey")
    term = F.when(k % 33 == 0, "HP:12").otherwise(F.format_string("hp_%07d", k - F.when(k % 20 == 0, 1).otherwise(0)))
    token = F.get(F.array(*[F.lit(x) for x in ("Present", "ruled out", "not-assessed", "suspected", "maybe")]), (k % 5).cast("int"))
    head = v["region"].limit(1).select(F.lit("hpo_id\tstatus").alias("value"), F.lit(-1).cast("long").alias("at"))
    path = tables.text_file(head.union(v["customer"].select(text(term, token).alias("value"), k.alias("at"))))
    return source.profile(v.spark, path, "P1").select("term", "status", "verdict")


@query("disease_annotations", """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'negated' WHEN o_orderkey % 4 = 1 THEN 'other_aspect' WHEN o_custkey % 8 = 0 THEN 'unresolvable' ELSE 'ok' END AS verdict, count(*) AS n, count(*) FILTER (o_custkey % 8 <> 0) AS known FROM orders GROUP BY 1""")
def disease_annotations(v: Views) -> DataFrame:
    """Annotation rows of two corpora, every one with a verdict, so that the counts balance."""
    o = F.col("o_orderkey")
    rows = v["orders"].select(o.alias("entity"), F.when(o % 10 == 0, "NOT").alias("qualifier"), F.col("o_custkey").alias("hpo_id"), F.when(o % 4 == 1, "I").otherwise("P").alias("aspect"))
    terms = v["customer"].filter("c_custkey % 8 <> 0").select(F.col("c_custkey").alias("term"))
    genes = knowledge.gene_corpus(rows.select(F.col("entity").alias("gene"), "hpo_id"), terms).withColumnRenamed("verdict", "v2").select(F.col("gene").alias("entity"), "hpo_id", "v2")
    diseases = source.disease_corpus(rows, terms)
    known = genes.filter("v2 = 'ok'").groupBy("entity", "hpo_id").agg(F.lit(1).alias("k_"))
    return diseases.join(known, ["entity", "hpo_id"], "left").groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.count("k_").alias("known"))


@query("gene_phenotype_rows", """
WITH r AS (SELECT p_partkey % 50 AS gene, p_size AS hpo_id, p_partkey AS disease_id, CASE WHEN p_partkey % 3 = 0 THEN 0.25 WHEN p_partkey % 3 = 1 THEN NULL ELSE 0.3 END AS f, p_partkey % 9 = 4 AS gone FROM part)
SELECT gene, hpo_id, disease_id, CAST(f AS DOUBLE) AS lower FROM (SELECT *, row_number() OVER (PARTITION BY gene, hpo_id ORDER BY f IS NULL, disease_id) AS rn FROM r WHERE NOT gone) q WHERE rn = 1""")
def gene_phenotype_rows(v: Views) -> DataFrame:
    """The best row for a gene and term, stated frequencies first, excluded ones left out."""
    k = F.col("p_partkey")
    frequency = F.when(k % 9 == 4, "HP:0040285").when(k % 3 == 0, "1/4").when(k % 3 == 1, "").otherwise("Frequent")
    best, _ = knowledge.gene_phenotypes(v["part"].select((k % 50).alias("gene"), F.col("p_size").alias("hpo_id"), k.alias("disease_id"), frequency.alias("frequency")))
    return best.select("gene", "hpo_id", "disease_id", "lower")


@query("curated_panel", """
WITH c AS (SELECT concat('G', p_partkey) AS gene, CASE p_partkey % 3 WHEN 0 THEN 'Definitive' WHEN 1 THEN 'Limited' ELSE 'Refuted' END AS classification FROM part WHERE p_partkey % 4 <> 0), d AS (SELECT concat('G', p_partkey) AS gene FROM part WHERE p_partkey % 6 = 0)
SELECT 'clingen' AS source, lower(classification) AS classification, count(*) AS n, count(*) FILTER (NOT EXISTS (SELECT 1 FROM d WHERE d.gene = c.gene)) AS unmatched FROM c GROUP BY 2 UNION ALL SELECT 'ddg2p', 'definitive', count(*), 0 FROM d""")
def curated_panel(v: Views) -> DataFrame:
    """Two curated sources, stacked with their vocabularies apart, and symbols that one lacks."""
    k = F.col("p_partkey")
    quoted = lambda *xs: F.concat(F.lit('"'), F.concat_ws('","', *xs), F.lit('"'))
    level = F.when(k % 3 == 0, "Definitive").when(k % 3 == 1, "Limited").otherwise("Refuted")
    body = v["part"].filter("p_partkey % 4 <> 0").select(quoted(coded("G", "p_partkey"), coded("HGNC:", "p_partkey"), F.lit("d"), F.lit("MONDO:1"), F.lit("AR"), F.lit("SOP1"), level, F.lit("u"), F.lit("2024-01-01"), F.lit("panel")).alias("value"))
    banner = v["region"].filter("r_regionkey < 3").select(F.get(F.array(F.lit('"CLINGEN GENE VALIDITY"'), F.lit('"FILE CREATED: 2024-05-01"'), F.lit('"+++","+++"')), F.col("r_regionkey").cast("int")).alias("value"))
    clingen = knowledge.clingen_rows(v.spark, tables.text_file(banner.union(body)))
    ddg2p = knowledge.ddg2p_rows(v["part"].filter("p_partkey % 6 = 0").select(coded("G", "p_partkey").alias("gene"), F.lit(None).cast("string").alias("mondo"), coded("", "p_size").alias("mim"), F.lit("definitive").alias("classification")))
    gone = knowledge.unmatched_symbols(clingen, ddg2p, ddg2p.select("gene")).withColumn("u_", F.lit("clingen"))
    both = source.stacked(clingen.select("gene", "disease_id", "classification"), ddg2p).join(gone.select("gene", F.col("u_").alias("source"), F.lit(1).alias("one")), ["gene", "source"], "left")
    return both.groupBy("source", F.lower("classification").alias("classification")).agg(F.count(F.lit(1)).alias("n"), F.count("one").alias("unmatched"))


@query("gene_panel_table", """
WITH c AS (SELECT concat('G', p_partkey) AS gene, p_size, CASE WHEN p_partkey % 5 = 0 THEN 2 WHEN p_partkey % 5 = 1 THEN 0 ELSE 1 END AS n_flags FROM part WHERE p_partkey % 7 <> 0), b AS (SELECT concat('G', p_partkey) AS gene, 'strong' AS classification FROM part WHERE p_partkey % 2 = 0)
SELECT coalesce(c.gene, b.gene) AS gene, coalesce(p_size, -1) AS pli, coalesce(n_flags, -1) AS n_flags, classification FROM c FULL JOIN b ON b.gene = c.gene""")
def gene_panel_table(v: Views) -> DataFrame:
    """Constraint columns, the parsed flags and the best classification, one row per gene."""
    k = F.col("p_partkey")
    constraint = v["part"].filter("p_partkey % 7 <> 0").select(coded("G", "p_partkey").alias("gene"), F.col("p_size").alias("pli"), F.when(k % 5 == 0, '["no_exp","outlier"]').when(k % 5 == 1, F.lit(None)).otherwise('["few"]').alias("flags"))
    best = v["part"].filter("p_partkey % 2 = 0").select(coded("G", "p_partkey").alias("gene"), F.lit("strong").alias("classification"))
    return knowledge.gene_panel(constraint, best).select("gene", F.coalesce("pli", F.lit(-1)).alias("pli"), F.when(F.col("flags").isNotNull(), F.size("flags")).otherwise(-1).alias("n_flags"), "classification")


# ---- typed tables -----------------------------------------------------------------------------------------------------------


@query("typed_tables", """
WITH c AS (SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS canonical, CASE p_partkey % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'low' END AS impact, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS n_scores, CASE WHEN p_partkey % 6 <> 0 THEN p_size * 10 END AS an FROM part)
SELECT canonical, impact, n_scores, count(*) AS n, count(an) AS n_an, CAST(coalesce(sum(an), 0) AS BIGINT) AS ans FROM c GROUP BY 1, 2, 3""")
def typed_tables(v: Views) -> DataFrame:
    """Text columns with tokens, blanks and unknown values, typed; blank is unassessed, never false or zero."""
    k = F.col("p_partkey")
    raw = v["part"].select(
        F.when(k % 4 == 0, "Yes").when(k % 4 == 1, "0").otherwise("").alias("is_canonical"), F.lit("true").alias("is_mane_select"), F.when(k % 5 == 0, " HIGH ").when(k % 5 == 1, "low").otherwise("odd").alias("impact"), F.lit("x").alias("splice_ai_delta_max"),
        F.when(k % 3 == 0, "20.5").otherwise("").alias("cadd_phred"), F.when(k % 2 == 0, "0.5").otherwise(".").alias("revel"), F.lit("0.1").alias("allele_frequency"), F.lit("1").alias("allele_count"),
        F.when(k % 6 == 0, "").otherwise((F.col("p_size") * 10).cast("string")).alias("allele_number"), F.lit("").alias("homozygote_count"),
    )
    t = knowledge.typed_frequencies(knowledge.typed_consequences(raw))
    return t.groupBy(F.col("is_canonical").alias("canonical"), "impact", F.size("scores").alias("n_scores")).agg(F.count(F.lit(1)).alias("n"), F.count("allele_number").alias("n_an"), F.coalesce(F.sum("allele_number"), F.lit(0)).alias("ans"))


@query("mechanism_file", f"""WITH {SQL_GRAPH}, l AS (SELECT mechanism_id, node_id, lead(node_id) OVER (PARTITION BY mechanism_id ORDER BY node_id) AS t FROM nodes)
SELECT n.mechanism_id, n.nodes AS n_nodes, coalesce(k.links, 0) AS n_links, coalesce(k.shown, 0) AS n_demonstrated FROM (SELECT mechanism_id, count(*) AS nodes FROM nodes GROUP BY 1) n LEFT JOIN (SELECT mechanism_id, count(*) AS links, count(*) FILTER (node_id % 2 = 0) AS shown FROM l WHERE t IS NOT NULL GROUP BY 1) k ON k.mechanism_id = n.mechanism_id""")
def mechanism_file(v: Views) -> DataFrame:
    """Node rows and link rows of one file, told apart by the columns that are filled."""
    _, nodes, links = graph(v)
    empty = F.lit("")
    one = nodes.select("mechanism_id", F.col("node_id").cast("string").alias("node_id"), F.lit("gene").alias("node_kind"), F.col("label").alias("node_label"), "state_in_patient", *[empty.alias(c) for c in ("link_id", "source_node_id", "target_node_id", "relation", "direction", "strength", "is_directly_demonstrated")])
    two = links.select("mechanism_id", *[empty.alias(c) for c in ("node_id", "node_kind", "node_label", "state_in_patient")], *[F.col(c).cast("string").alias(c) for c in ("link_id", "source_node_id", "target_node_id")], empty.alias("relation"), empty.alias("direction"), "strength", F.when(F.col("demonstrated"), "yes").otherwise("no").alias("is_directly_demonstrated"))
    n, k = knowledge.chain(one.unionByName(two))
    a = n.groupBy("mechanism_id").agg(F.count(F.lit(1)).alias("n_nodes"))
    b = k.groupBy("mechanism_id").agg(F.count(F.lit(1)).alias("n_links"), F.count_if("demonstrated").alias("n_demonstrated"))
    return a.join(b, "mechanism_id", "left").fillna(0)


# ---- sinks -------------------------------------------------------------------------------------------------------------------


@query("json_rows", """SELECT concat('{"key":', o_orderkey, ',"price":', CAST(floor(o_totalprice) AS BIGINT), ',"status":"', o_orderstatus, '"}') AS value FROM orders""")
def json_rows(v: Views) -> DataFrame:
    """Canonical JSON lines, written and read back."""
    path = tables.new_path(v.spark, "json")
    source.write_json_rows(v["orders"].select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key"), F.floor("o_totalprice").alias("price")), path)
    return v.spark.read.text(path)


@query("sorted_sink", "SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, 0 AS unsorted FROM orders")
def sorted_sink(v: Views) -> DataFrame:
    """A table written in key order; no row of a file goes backwards."""
    path = tables.new_path(v.spark, "sink")
    source.write_table(v["orders"], path, ["o_orderkey"])
    back = v.spark.read.parquet(path).select("o_orderkey", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("seq"))
    wrong = tables.unsorted_rows(back, ["file"], "seq", ["o_orderkey"]).agg(F.count(F.lit(1)).cast("int").alias("unsorted"))
    return back.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).crossJoin(wrong)


@query("submission_file", """
WITH r AS (SELECT o_custkey, concat('chr', 1 + o_orderkey % 22, ':', o_orderkey, ':A:G') AS a, CASE WHEN o_orderkey % 3 = 0 THEN concat('chr', 1 + o_orderkey % 22, ':', o_orderkey - 1, ':C:T') END AS b, CAST(o_orderkey % 1000 AS DOUBLE) / 1000 AS epcr, o_orderkey FROM orders),
k AS (SELECT o_custkey AS proband_id, CASE WHEN b IS NULL THEN a ELSE concat(least(a, b), '|', greatest(a, b)) END AS key, epcr FROM r)
SELECT CAST(proband_id AS VARCHAR) AS proband_id, key, CAST(row_number() OVER (PARTITION BY proband_id ORDER BY epcr DESC, key) AS INT) AS rank, round(epcr, 6) AS epcr FROM k""")
def submission_file(v: Views) -> DataFrame:
    """The twelve columns as a file, read back as ranked row keys."""
    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    contig, pair = F.concat(F.lit("chr"), (1 + k % 22).cast("string")), k % 3 == 0
    second = lambda x: F.when(pair, x).otherwise(none)
    rows = v["orders"].select(
        F.col("o_custkey").alias("proband_id"), contig.alias("chrom_1"), k.alias("pos_1"), F.lit("A").alias("ref_1"), F.lit("G").alias("alt_1"), second(contig).alias("chrom_2"), second((k - 1).cast("string")).alias("pos_2"), second(F.lit("C")).alias("ref_2"),
        second(F.lit("T")).alias("alt_2"), ((k % 1000) / 1000).alias("epcr"), F.lit("diagnostic").alias("finding_type"), F.lit("").alias("notes"),
    )
    path = tables.new_path(v.spark, "submission")
    source.write_submission(rows, path)
    back = v.spark.read.option("header", True).csv(path).withColumn("epcr", F.col("epcr").cast("double"))
    return source.submission_keys(back).select("proband_id", "key", "rank", F.round("epcr", 6).alias("epcr"))


@query("release_check", """SELECT 'ok' AS status, 2 AS n UNION ALL SELECT 'digest_differs', 1 UNION ALL SELECT 'missing', 1 WHERE (SELECT count(*) FROM nation) > 0""")
def release_check(v: Views) -> DataFrame:
    """A release of files against its manifest, after one file's digest and one name were changed in it."""
    path = tables.new_path(v.spark, "release")
    v["nation"].repartitionByRange(4, "n_nationkey").select(F.concat(F.lit("release 1 "), F.col("n_name")).alias("value")).write.text(path)
    plain = knowledge.manifest(v.spark, path, "1", "2024-01-01").filter("path LIKE 'part-%'").withColumn("k", F.substring("path", 6, 5).cast("int"))
    spoilt = plain.withColumn("sha256", F.when(F.col("k") == 1, "0").otherwise(F.col("sha256"))).withColumn("path", F.when(F.col("k") == 2, "gone.txt").otherwise(F.col("path")))
    return source.verified(v.spark, path, spoilt.drop("k")).groupBy("status").agg(F.count(F.lit(1)).cast("int").alias("n"))


# ---- rules -------------------------------------------------------------------------------------------------------------------


@query("genotype_rules", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 26 BETWEEN 1 AND 22 THEN concat('chr', l_partkey % 26) WHEN l_partkey % 26 = 23 THEN 'chrX' WHEN l_partkey % 26 = 24 THEN 'chrY' END AS contig, CASE WHEN l_linenumber % 3 = 0 THEN 'split_multiallelic' END AS tag,
  l_linenumber % 2 = 0 OR l_linenumber % 3 <> 0 AS consistent, CAST(CASE WHEN l_linenumber % 2 = 0 THEN 6 ELSE 0 END AS INT) AS shift FROM lineitem""")
def genotype_rules(v: Views) -> DataFrame:
    """Accessions, unsplit genotypes, right-most places and phase notation."""
    line = F.col("l_linenumber")
    accession = F.format_string("NC_0000%02d.11", F.col("l_partkey") % 26)
    genotype = F.when(line % 3 == 0, F.when(line % 2 == 0, "1|2").otherwise("1/2")).otherwise("0|1")
    flank, alt = F.when(line % 2 == 0, "CACACAT").otherwise("GGG"), F.when(line % 2 == 0, "ACA").otherwise("AT")
    return v["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", alleles.refseq_contig(accession).alias("contig"), stages.resolved_genotype(genotype)["tag"].alias("tag"), alleles.phase_consistent(F.lit(True), genotype).alias("consistent"),
        alleles.right_shift(flank, F.lit("A"), alt).alias("shift"),
    )


@query("noisy_or", "SELECT p_partkey, round(1 - (1 - 0.01 * (p_size % 40)) * (1 - 0.02 * (p_partkey % 30)), 6)::DOUBLE AS penalty FROM part")
def noisy_or(v: Views) -> DataFrame:
    """D-14: contradictions combined."""
    found = F.array(F.struct(F.lit("a").alias("code"), (F.col("p_size") % 40 * 0.01).alias("magnitude")), F.struct(F.lit("b").alias("code"), (F.col("p_partkey") % 30 * 0.02).alias("magnitude")))
    return v["part"].select("p_partkey", F.round(pairs.penalty(found), 6).alias("penalty"))


@query("first_seen_suppliers", """
SELECT l_partkey, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY first_, l_suppkey) AS suppliers FROM (SELECT l_partkey, l_suppkey, min(l_orderkey) AS first_ FROM lineitem GROUP BY 1, 2) q GROUP BY l_partkey""")
def first_seen_suppliers(v: Views) -> DataFrame:
    """Distinct ids in the order in which they were first seen."""
    return tables.first_seen(v["lineitem"], ["l_partkey"], "l_suppkey", "l_orderkey").select("l_partkey", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("suppliers"))


@query("unknown_validity", """
WITH r AS (SELECT CASE p_partkey % 4 WHEN 0 THEN 'definitive' WHEN 1 THEN 'limited' WHEN 2 THEN 'frequent' ELSE 'odd' END AS token FROM part)
SELECT token, CASE token WHEN 'definitive' THEN 'ok' WHEN 'limited' THEN 'ok' WHEN 'frequent' THEN 'frequency_vocabulary' ELSE 'unknown_tier' END AS verdict, count(*) AS n FROM r GROUP BY 1, 2""")
def unknown_validity(v: Views) -> DataFrame:
    """Strength tokens; another vocabulary and unknown tiers are errors, not the neutral weight."""
    token = F.get(F.array(*[F.lit(x) for x in ("definitive", "limited", "frequent", "odd")]), (F.col("p_partkey") % 4).cast("int"))
    rows = v["part"].select(token.alias("token"))
    return rows.withColumn("verdict", rules.strength_verdict(F.col("token"))).groupBy("token", "verdict").agg(F.count(F.lit(1)).alias("n"))


@query("clinical_source_absent", """SELECT count(*) AS n, 0 AS n_clinical, 0 AS n_kept_clinical FROM calls""")
def clinical_source_absent(v: Views) -> DataFrame:
    """With a declared but empty clinical source no call is kept for an assertion."""
    df = annotate.annotated(v["calls"], v["consequences"], v["frequencies"], knowledge.empty_clinical(v.spark))
    return df.agg(F.count(F.lit(1)).alias("n"), F.count("n_assertions").cast("int").alias("n_clinical"), F.count_if(F.col("triage") == "kept_clinical_assertion").cast("int").alias("n_kept_clinical"))


# ---- evidence, mechanisms, documents ---------------------------------------------------------------------------------------------


@query("quality_evidence_order", """
WITH e AS (SELECT CAST(p_partkey % 10 AS VARCHAR) AS subject_id, CASE WHEN p_size > 25 THEN 'supports' ELSE 'contradicts' END AS direction, CASE WHEN p_partkey % 3 = 0 THEN 'call passes all quality rules' ELSE concat('call is flagged f', p_partkey) END AS claim, CAST(p_partkey AS DOUBLE) AS x FROM part),
i AS (SELECT subject_id, direction, concat('EV-QUAL-', substr(sha256(concat_ws(chr(31), 'quality_control', subject_id, claim, direction, 'moderate', CAST(x AS VARCHAR))), 1, 16)) AS evidence_id FROM e)
SELECT subject_id, evidence_id, direction, CAST(row_number() OVER (PARTITION BY subject_id ORDER BY direction, evidence_id) AS INT) AS place FROM i""")
def quality_evidence_order(v: Views) -> DataFrame:
    """Items of many calls, deduplicated, numbered in the ledger's total order of each subject."""
    k = F.col("p_partkey")
    flags = F.when(k % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(coded("f", "p_partkey")))
    direction = F.when(F.col("p_size") > 25, "supports").otherwise("contradicts")
    rows = v["part"].select((k % 10).alias("variant_id"), flags.alias("flags"), direction.alias("direction"), F.lit("moderate").alias("strength"), k.cast("double").alias("fraction"))
    items = compare.deduplicated(stages.quality_evidence(rows))
    return stages.evidence_order(items).select("subject_id", "evidence_id", "direction", "place")


@query("evidence_checks", """SELECT CASE WHEN p_partkey % 6 = 0 THEN 'database_without_version,observed_without_value' WHEN p_partkey % 2 = 0 THEN 'database_without_version' ELSE 'observed_without_value' END AS broken, count(*) AS n FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0 GROUP BY 1""")
def evidence_checks(v: Views) -> DataFrame:
    """A database item names its version, an observed item has a value."""
    k = F.col("p_partkey")
    rows = v["part"].select(F.lit("database").alias("tier"), F.when(k % 2 != 0, "v1").alias("citation_version"), F.lit("observed").alias("basis"), F.when(k % 3 != 0, F.col("p_size").cast("double")).alias("numeric_value"))
    return tables.invalid(rows, compare.evidence_invariants()).groupBy(joined("broken")).agg(F.count(F.lit(1)).alias("n"))


@query("evidence_for_subject", """SELECT p_partkey AS subject_id, count(*) FILTER (r_regionkey % 2 = 0) AS n_for, count(*) FILTER (r_regionkey % 2 = 1) AS n_against FROM part CROSS JOIN region GROUP BY 1""")
def evidence_for_subject(v: Views) -> DataFrame:
    """What speaks for and against each subject."""
    items = v["part"].select(F.col("p_partkey").alias("subject_id")).crossJoin(v["region"].select(F.col("r_regionkey").alias("k"))).select("subject_id", F.when(F.col("k") % 2 == 0, "supports").otherwise("contradicts").alias("direction"))
    return compare.balance(items)


@query("agents_by_node", f"""WITH {SQL_GRAPH}, n AS (SELECT count(*) AS n FROM supplier)
SELECT CAST(CASE WHEN p_partkey % 9 = 0 THEN -1 ELSE s.s_suppkey END AS BIGINT) AS target_node_id, count(*) AS n, min(p_partkey) AS first FROM part CROSS JOIN n JOIN supplier s ON s.s_suppkey = p_partkey * 7 % n.n GROUP BY 1""")
def agents_by_node(v: Views) -> DataFrame:
    """The agents of each target node, by exact id, in order."""
    return mechanism.agents_of_nodes(agents(v)).select("target_node_id", F.size("agents").cast("long").alias("n"), F.get("agents", F.lit(0)).alias("first"))


@query("inferred_links", f"""WITH {SQL_GRAPH}, l AS (SELECT mechanism_id, node_id, lead(node_id) OVER (PARTITION BY mechanism_id ORDER BY node_id) AS t FROM nodes)
SELECT mechanism_id, node_id AS link_id, concat('test whether ', node_id, ' acts on ', t) AS experiment FROM l WHERE t IS NOT NULL AND node_id % 2 <> 0""")
def inferred_links(v: Views) -> DataFrame:
    """An experiment for each link that was not demonstrated."""
    return mechanism.link_experiments(graph(v)[2])


@query("bound_mechanisms", f"""WITH {SQL_SCORED}, known_ AS (SELECT DISTINCT s_nationkey AS mechanism_id FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT sample_id, CAST(rank AS INT) AS rank, pair_id, gene_key, coalesce(mechanism_id, -1) AS mechanism_id, CASE WHEN mechanism_id IS NULL THEN 'no_curated_mechanism' ELSE '' END AS warning FROM ranks LEFT JOIN known_ ON mechanism_id = gene_key""")
def bound_mechanisms(v: Views) -> DataFrame:
    """The chain of each candidate's gene, or a warning that there is none."""
    rows = scored(v).select("sample_id", "rank", "pair_id", "gene_key")
    met = mechanism.bound(rows, graph(v)[0].withColumn("gene_key", F.col("mechanism_id")))
    return met.select("sample_id", "rank", "pair_id", "gene_key", F.coalesce("mechanism_id", F.lit(-1)).alias("mechanism_id"), F.coalesce("warning", F.lit("")).alias("warning"))


@query("control_agents", f"""WITH {SQL_TRIAGE}, signed AS (SELECT m.mechanism_id, m.cin, f.corrective FROM mech m JOIN nation ON n_nationkey = m.mechanism_id JOIN fix f ON f.mechanism_id = m.mechanism_id AND f.node_id = m.target WHERE f.corrective <> 'unknown'),
expected AS (SELECT mechanism_id, cin, unnest(['accepted', 'inverted', 'unknown_direction', 'no_effect', 'risk_not_assessed', 'risk_known', 'off_chain', 'mirrored_mechanism', 'tool_compound', 'out_of_reach', 'no_pediatric_record', 'symptomatic']) AS control FROM signed)
SELECT mechanism_id, control, CASE WHEN control IN ('inverted', 'no_effect', 'mirrored_mechanism') THEN 'wrong_direction' WHEN control = 'off_chain' THEN 'target_not_in_mechanism' WHEN control = 'tool_compound' THEN 'not_approved'
  WHEN control = 'out_of_reach' THEN 'concentration_not_achievable' WHEN control LIKE 'risk%' AND cin THEN 'oncogenic_risk' ELSE 'accepted' END AS verdict, true AS met, (SELECT count(*) FROM r) AS n_agents FROM expected""")
def control_agents(v: Views) -> DataFrame:
    """Twelve controls for every given mechanism with a sign go through the same triage as the given agents; each must get its verdict."""
    m, nodes, _ = graph(v)
    own, made = mechanism.controlled_triage(agents(v), nodes, m)
    n = own.agg(F.count(F.lit(1)).alias("n_agents"))
    return made.select(F.col("of_mechanism").alias("mechanism_id"), "control", F.coalesce("primary_reason", F.lit("accepted")).alias("verdict"), "met").join(F.broadcast(n))


@query("invalid_mechanisms", f"""WITH {SQL_GRAPH}, x AS (SELECT m.mechanism_id, CASE WHEN m.mechanism_id % 5 = 0 THEN -7 ELSE m.target END AS target, m.mechanism_id % 3 = 1 AS flipped FROM mech m JOIN nation ON n_nationkey = m.mechanism_id)
SELECT x.mechanism_id, CASE WHEN f.node_id IS NULL THEN 'target_not_a_node' WHEN f.state = 'loss_of_function' THEN 'compensatory_target' ELSE 'inconsistent_direction' END AS reason FROM x LEFT JOIN fix f ON f.mechanism_id = x.mechanism_id AND f.node_id = x.target
WHERE f.node_id IS NULL OR f.state = 'loss_of_function' OR (flipped AND f.state IN ('decrease', 'increase'))""")
def invalid_mechanisms(v: Views) -> DataFrame:
    """Targets that are no nodes, that only compensate, or whose correction points the wrong way; some targets, states and corrections are spoilt."""
    m, nodes, _ = graph(v)
    k = F.col("mechanism_id")
    flipped = F.when((k % 3 == 1) & (F.col("required_correction") == "increase"), "decrease").when((k % 3 == 1) & (F.col("required_correction") == "decrease"), "increase").otherwise(F.col("required_correction"))
    spoilt = m.withColumn("therapeutic_target_node_id", F.when(k % 5 == 0, F.lit(-7).cast("long")).otherwise(F.col("therapeutic_target_node_id"))).withColumn("required_correction", flipped)
    return mechanism.invalid_mechanisms(spoilt, nodes.withColumn("kind", F.when(F.col("state_in_patient") == "loss_of_function", "compensatory").otherwise("causal")))


@query("matches_per_group", """
WITH p AS (SELECT DISTINCT p_size AS a, p_partkey % 60 AS b, CAST(1 + p_partkey % 9 AS DOUBLE) / 10 AS sim FROM part), s AS (SELECT a, b, max(sim) AS sim FROM p GROUP BY 1, 2), t AS (SELECT DISTINCT p_partkey % 20 AS group_id, p_partkey % 60 AS b FROM part), q AS (SELECT DISTINCT c_nationkey AS subject_id, 1 + c_custkey % 50 AS a FROM customer),
m AS (SELECT q.subject_id, t.group_id, q.a, max(s.sim) AS sim FROM q JOIN s ON s.a = q.a JOIN t ON t.b = s.b GROUP BY 1, 2, 3) SELECT subject_id, group_id, round(avg(sim), 6) AS bma FROM m GROUP BY 1, 2""")
def matches_per_group(v: Views) -> DataFrame:
    """H6: best matches and their average, through known similarities only."""
    sims = v["part"].groupBy(F.col("p_size").alias("a"), (F.col("p_partkey") % 60).alias("b")).agg(F.max((1 + F.col("p_partkey") % 9) / 10).alias("lin"))
    targets = v["part"].select((F.col("p_partkey") % 20).alias("group_id"), (F.col("p_partkey") % 60).alias("b")).distinct()
    queries = v["customer"].select(F.col("c_nationkey").alias("subject_id"), (1 + F.col("c_custkey") % 50).alias("a")).distinct()
    return ontology.best_match_average(ontology.best_matches(queries, targets, sims)).select("subject_id", "group_id", F.round("bma", 6).alias("bma"))


@query("terms_to_genes", """SELECT 4 + p_partkey * 11 % 140 AS term, string_agg(DISTINCT CAST(p_partkey % 100 AS VARCHAR), ',' ORDER BY CAST(p_partkey % 100 AS VARCHAR)) AS genes FROM part GROUP BY 1""")
def terms_to_genes(v: Views) -> DataFrame:
    """Genes of each term."""
    return ontology.genes_for_term(gene_terms(v)).select("term", F.array_join(F.array_sort(F.transform("genes", lambda x: x.cast("string"))), ",").alias("genes"))


SQL_CITED = """cited AS (SELECT p_partkey AS k, ['Archer', 'Núñez', 'O''Brien', 'García-Lopez'][1 + p_partkey % 4] AS author, 1950 + p_size AS year, ['Annals of Plans', 'J Tests'][1 + p_partkey % 2] AS journal, p_name AS title FROM part)"""


@query("citations_found", f"""WITH {SQL_CITED}
SELECT k AS p_partkey, 0 AS place, CAST(k AS VARCHAR) AS pmid, CASE k % 3 WHEN 0 THEN 'prose' WHEN 1 THEN 'row' ELSE 'bare' END AS form, author, CAST(year AS INT) AS year, CASE WHEN k % 3 < 2 THEN journal ELSE '-' END AS journal, CASE WHEN k % 3 = 1 THEN title ELSE '-' END AS title FROM cited
UNION ALL SELECT k, 1, CAST(k + 1000000 AS VARCHAR), CASE WHEN k % 5 = 0 THEN 'bare' ELSE 'unannotated' END, CASE WHEN k % 5 = 0 THEN 'Second' ELSE '-' END, CASE WHEN k % 5 = 0 THEN 2001 ELSE -1 END, '-', '-' FROM cited""")
def citations_found(v: Views) -> DataFrame:
    """K8: two citations in a text made from each part, the first as prose, as a table row or bare; the second must not borrow from the first."""
    k = F.col("p_partkey")
    author = F.get(F.array(*[F.lit(x) for x in ("Archer", "Núñez", "O'Brien", "García-Lopez")]), (k % 4).cast("int"))
    journal = F.get(F.array(F.lit("Annals of Plans"), F.lit("J Tests")), (k % 2).cast("int"))
    year, pmid = (1950 + F.col("p_size")).cast("string"), k.cast("string")
    prose = F.concat(F.lit("It was shown by "), author, F.lit(" et al.,\n*"), journal, F.lit("* 12:34-56 ("), year, F.lit("), PMID: "), pmid, F.lit("."))
    row = F.concat(F.lit("| 7 | "), author, F.lit(" A, Other B ("), year, F.lit("). "), F.col("p_name"), F.lit(". *"), journal, F.lit("* 3:1. PMID "), pmid, F.lit(" |"))
    bare = F.concat(F.lit("as in "), author, F.lit(" et al. "), year, F.lit(" (PMID "), pmid, F.lit(")"))
    first = F.when(k % 3 == 0, prose).when(k % 3 == 1, row).otherwise(bare)
    second = F.concat(F.when(k % 5 == 0, " then Second and Third, 2001, PMID ").otherwise(" and see PMID:"), (k + 1_000_000).cast("string"))
    found = textscan.citations(v["part"].select("p_partkey", F.concat(first, second).alias("text")), "p_partkey")
    shown = lambda c: F.coalesce(c, F.lit("-")).alias(c)
    return found.select("p_partkey", "place", "pmid", "form", shown("author"), F.coalesce("year", F.lit(-1)).alias("year"), shown("journal"), shown("title"))


@query("citation_differences", f"""WITH {SQL_CITED}
SELECT CAST(k AS VARCHAR) AS pmid, unnest(list_filter([CASE WHEN k % 7 = 0 THEN 'author_differs' END, CASE WHEN k % 11 = 0 THEN 'journal_differs' END, CASE WHEN k % 13 = 0 THEN 'title_differs' END, CASE WHEN k % 17 = 0 THEN 'year_differs' END], lambda x: x IS NOT NULL)) AS kind FROM cited""")
def citation_differences(v: Views) -> DataFrame:
    """Written and known citations compared without regard to accents, case, spacing and marks; some are spoilt."""
    k = F.col("p_partkey")
    pick = lambda xs: F.get(F.array(*[F.lit(x) for x in xs]), (k % 4).cast("int"))
    pmid = k.cast("string").alias("pmid")
    written = v["part"].select(pmid, pick(["Archer", "Núñez", "O'Brien", "García-Lopez"]).alias("author"), (1950 + F.col("p_size")).alias("year"), F.when(k % 2 == 0, "Annals of Plans").otherwise("J. Tests U.S.A.").alias("journal"), F.concat(F.lit("*"), F.col("p_name"), F.lit("* of NAD+.")).alias("title"))
    spoilt = lambda n, c: F.when(k % n == 0, "Another").otherwise(c)
    known = v["part"].select(
        pmid, spoilt(7, pick(["ARCHER", "Nunez", "OBrien", "Garcia-López"])).alias("author"), F.when(k % 17 == 0, 1900).otherwise(1950 + F.col("p_size")).alias("year"),
        spoilt(11, F.when(k % 2 == 0, "annals of plans").otherwise("J Tests USA")).alias("journal"), spoilt(13, F.concat(F.upper("p_name"), F.lit(" of NAD(+)"))).alias("title"),
    )
    return compare.citation_mismatches(written, known, alike=True)


@query("citation_forms", """SELECT 'with_colon' AS form, count(*) AS n, count(DISTINCT p_partkey % 500) AS n_ids FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT 'bare', count(*), count(DISTINCT p_partkey % 500) FROM part WHERE p_partkey % 2 = 1""")
def citation_forms(v: Views) -> DataFrame:
    """How citations are written, and how many distinct ids there are."""
    mark = F.when(F.col("p_partkey") % 2 == 0, "PMID: ").otherwise("PMID ")
    return textscan.citation_forms(v["part"].select("p_partkey", F.concat(F.lit("see "), mark, (F.col("p_partkey") % 500).cast("string")).alias("text")), "p_partkey")


@query("profile_shapes", """SELECT n_nationkey % 3 AS k, n_nationkey % 3 <> 2 AS profile_shape, count(*) AS n FROM nation GROUP BY 1, 2""")
def profile_shapes(v: Views) -> DataFrame:
    """K3: texts with a header row, with delimited rows of terms and statuses, and prose."""
    k = F.col("n_nationkey")
    rows = F.call_function("repeat", F.lit("HP:0001250\tobserved\n"), F.lit(3))
    docs = v["nation"].select(k.alias("doc_id"), F.when(k % 3 == 0, "hpo_id\tstatus\n").when(k % 3 == 1, rows).otherwise(F.col("n_name")).alias("text"))
    return textscan.profile_shaped(docs).groupBy((F.col("doc_id") % 3).alias("k"), "profile_shape").agg(F.count(F.lit(1)).alias("n"))


@query("export_decisions", """
SELECT page_id, list_aggregate(list_filter([CASE WHEN page_id % 4 = 0 THEN 'declared_not_public' END, CASE WHEN page_id % 3 = 0 THEN 'sensitive_path' END, CASE WHEN page_id % 3 = 0 THEN 'extension_not_allowed' END, CASE WHEN page_id % 5 = 0 THEN 'sensitive_content' END], lambda x: x IS NOT NULL), 'string_agg', ',') AS reasons,
  page_id % 4 <> 0 AND page_id % 3 <> 0 AND page_id % 5 <> 0 AS allowed FROM pages""")
def export_decisions(v: Views) -> DataFrame:
    """K6, K7: artifacts by path, declared class and content findings."""
    k = F.col("page_id")
    path = F.concat(F.lit("out/"), k.cast("string"), F.when(k % 3 == 0, ".vcf").otherwise(".tsv"))
    artifacts = v["pages"].select("page_id", path.alias("path"), F.when(k % 4 == 0, "internal").otherwise("public").alias("declared"))
    found = v["pages"].filter("page_id % 5 = 0").select(path.alias("path"), F.lit("mrn").alias("rule"), F.lit("fail").alias("severity"))
    return textscan.export_gate(artifacts, found, ["tsv"]).select("page_id", F.nullif(F.array_join("reasons", ","), F.lit("")).alias("reasons"), "allowed")
