"""Named stages composed of the operators, and the tables that reports show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from variantloom.config import DEFAULT, Config
from variantloom.functions import alleles, rules
from variantloom.operators import compare, pairs

BLOCK = 4_096
#: Bases of the next block that each block repeats, so that a REF allele rarely needs two; a longer one is not assessed.
AHEAD = 1_024


def reference_blocks(sequences: DataFrame) -> DataFrame:
    """contig, block, seq: sequences (contig, seq) cut into blocks, so that lookups are equi-joins."""
    n = F.ceil(F.length("seq") / BLOCK).cast("int")
    cut = sequences.withColumn("block", F.explode(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)))
    return cut.select("contig", F.col("block").cast("long").alias("block"), F.substring("seq", F.col("block") * BLOCK + 1, F.lit(BLOCK + AHEAD)).alias("seq"))


def with_flank(calls: DataFrame, blocks: DataFrame, cap: int = 1_000) -> DataFrame:
    """Adds `flank`: up to cap + 1 reference bases that end at the anchor. A flank touches two blocks at most."""
    own = F.floor((F.col("position") - 1) / BLOCK).cast("long")
    b = blocks.withColumnsRenamed({"contig": "contig_", "seq": "seq_"})
    one = calls.withColumn("block_", own).join(b.withColumnRenamed("block", "at_"), (F.col("contig") == F.col("contig_")) & (F.col("block_") == F.col("at_")), "left").drop("contig_", "at_").withColumnRenamed("seq_", "here_")
    two = one.join(b.withColumnRenamed("block", "at_"), (F.col("contig") == F.col("contig_")) & (F.col("block_") - 1 == F.col("at_")), "left").drop("contig_", "at_").withColumnRenamed("seq_", "before_")
    upto = F.concat(F.coalesce(F.substring("before_", F.lit(1), F.lit(BLOCK)), F.lit("")), F.substring("here_", F.lit(1), (F.col("position") - 1) % BLOCK + 1))
    return two.withColumn("flank", F.substring(upto, F.greatest(F.length(upto) - cap, F.lit(1)), F.lit(cap + 1))).withColumn("ref_seen", F.substring("here_", (F.col("position") - 1) % BLOCK + 1, F.length("ref"))).drop("block_", "here_", "before_")


def normalised(calls: DataFrame, blocks: DataFrame) -> DataFrame:
    """Splitting is done by the source; here REF is checked, alleles are trimmed and indels moved left. `ops` names what changed."""
    t = alleles.trimmed(F.col("position"), F.col("ref"), F.col("alt"))
    df = calls.withColumn("t_", t).withColumns({"old_": F.struct("position", "ref", "alt"), "position": F.col("t_.position"), "ref": F.col("t_.ref"), "alt": F.col("t_.alt")})
    df = with_flank(df, blocks)
    df = df.withColumn("n_", alleles.left_shift(F.col("flank"), F.col("ref"), F.col("alt"), F.col("position")))
    a = alleles.left_aligned(F.col("flank"), F.col("position"), F.col("ref"), F.col("alt"), shift=F.col("n_"))
    df = df.withColumn("reference_matches", alleles.reference_matches(F.col("ref_seen"), F.col("ref"))).withColumn("a_", a)
    trimmed = (F.col("old_.position") != F.col("t_.position")) | (F.col("old_.ref") != F.col("t_.ref")) | (F.col("old_.alt") != F.col("t_.alt"))
    ops = F.array_compact(F.array(F.when(F.col("a_.shift") > 0, "left_align"), F.when(trimmed, "trim")))
    out = df.withColumns({"position": F.col("a_.position"), "ref": F.col("a_.ref"), "alt": F.col("a_.alt"), "status": F.col("a_.status"), "ops": ops})
    return out.drop("t_", "old_", "a_", "n_", "flank", "ref_seen")


def alignment_report(normal: DataFrame) -> DataFrame:
    """Counts by status and the status of the whole: usable only if every indel could be looked up."""
    g = normal.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("ops", "left_align")).alias("n_moved"), F.count_if(F.col("status") == "not_supplied").alias("n_unchecked"), F.count_if(F.col("status") == "shift_limit_reached").alias("n_limit"))
    return g.withColumn("status", F.when(F.col("n_unchecked") == F.col("n"), "not_supplied").when(F.col("n_limit") > 0, "shift_limit_reached").when(F.col("n_unchecked") > 0, "partly_usable").otherwise("usable"))


def op_counts(normal: DataFrame) -> DataFrame:
    return normal.select(F.explode("ops").alias("op")).groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def resolved_genotype(genotype: Column) -> Column:
    """(zygosity, tag) of an unsplit record: two different ALTs are heterozygous, with a tag."""
    called = F.array_distinct(F.filter(F.split(F.translate(genotype, "|", "/"), "/"), lambda x: ~x.isin("0", ".", "")))
    return F.struct(F.when(F.size(called) >= 2, "het").otherwise(F.lit(None)).alias("zygosity"), F.when(F.size(called) >= 2, "split_multiallelic").alias("tag"))


def quality_evidence(assessed: DataFrame) -> DataFrame:
    """One evidence item per call, from its flags (variant_id, flags, direction, strength, fraction)."""
    claim = F.when(F.size("flags") == 0, "call passes all quality rules").otherwise(F.concat(F.lit("call is flagged "), F.array_join("flags", ", ")))
    return compare.evidence(assessed, F.col("variant_id"), "variant", "quality_control", F.col("direction"), F.col("strength"), claim, F.col("fraction"), F.create_map(F.lit("flags"), F.array_join("flags", ",")))


def predictor_accounting(requested: DataFrame, predicted: DataFrame, skipped: DataFrame) -> DataFrame:
    """Each requested id in exactly one state: skipped, annotated, unplaceable, incomplete or without_annotation."""
    best = predicted.groupBy("variant_id").agg(F.min(F.when(F.col("verdict") == "ok", 0).when(F.col("verdict") == "unplaceable", 1).otherwise(2)).alias("k"))
    met = requested.select("variant_id").distinct().join(best, "variant_id", "left").join(skipped.select("variant_id", F.lit(True).alias("s_")).distinct(), "variant_id", "left")
    state = F.when(F.col("s_"), "skipped").when(F.col("k") == 0, "annotated").when(F.col("k") == 1, "unplaceable").when(F.col("k") == 2, "incomplete").otherwise("without_annotation")
    return met.withColumn("state", state).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def predictor_requests(calls: DataFrame, style: str = "ensembl") -> DataFrame:
    """Distinct sites in the predictor's contig style and order; uninformative alleles are skipped."""
    return calls.filter(~F.col("alt").isin("*", ".")).select(alleles.contig(F.col("contig"), style).alias("contig"), "position", "ref", "alt", alleles.contig_order(F.col("contig")).alias("contig_order")).distinct()


def run_warnings(annotated: DataFrame) -> DataFrame:
    """(code, share, text) of shares that a reader should know: calls without consequence, without frequency, dropped at the bar."""
    g = annotated.agg(
        F.avg((F.col("n_consequences") == 0).cast("double")).alias("no_consequence"), F.avg(F.when(F.col("triage").startswith("kept"), F.col("max_af").isNull().cast("double"))).alias("no_frequency"),
        F.avg((~F.col("triage").startswith("kept")).cast("double")).alias("below_bar"), F.avg(F.col("n_assertions").isNull().cast("double")).alias("no_clinical_source"),
    )
    names = ["no_consequence", "no_frequency", "below_bar", "no_clinical_source"]
    long = g.select(F.explode(F.array(*[F.struct(F.lit(n).alias("code"), F.round(n, 6).alias("share")) for n in names])).alias("x")).select("x.*")
    return long.filter("share > 0").withColumn("text", F.format_string("%s: %.2f %% of calls", "code", F.col("share") * 100))


def pair_flags(pairs_: DataFrame) -> DataFrame:
    """Adds `pair_flags` (single, phase, zygosity, members' flags) and `distance_bp` (NULL across contigs and for singles)."""
    phase = F.when(F.col("phase") == "cis_confirmed", "in_cis").when(F.col("phase") == "trans_confirmed", "in_trans").otherwise("phase_unknown")
    mixed = F.when(F.col("a.zygosity") != F.col("b.zygosity"), "mixed_zygosity")
    flags = F.array_union(F.array_compact(F.array(F.when(F.col("b").isNull(), "single_variant"), phase, mixed)), F.array_union("a.flags", F.coalesce("b.flags", F.array().cast("array<string>"))))
    return pairs_.withColumn("pair_flags", flags).withColumn("distance_bp", F.when(F.col("a.contig") == F.col("b.contig"), F.abs(F.col("b.position") - F.col("a.position"))))


def cap_warnings(pairs_: DataFrame, group: list[str], config: Config = DEFAULT) -> DataFrame:
    """Genes whose candidates were cut: variants, hypotheses made and kept."""
    g = pairs_.groupBy(*group).agg(F.max("a.n_variants").alias("n_variants"), F.max("generated").alias("generated"), F.count(F.lit(1)).alias("kept"))
    return g.filter((F.col("n_variants") > config.variants_per_gene) | (F.col("generated") > config.pairs_per_gene))


def component_evidence(scored: DataFrame) -> DataFrame:
    """Seven evidence rows per pair: a component's distance from 0.5 is its strength, its side the direction."""
    rows = scored.select("pair_id", F.explode(F.array(*[F.struct(F.lit(c).alias("component"), F.col(c).cast("double").alias("score")) for c in pairs.COMPONENTS])).alias("x")).select("pair_id", "x.*")
    far = F.abs(F.col("score") - 0.5)
    strength = F.when(far >= 0.40, "strong").when(far >= 0.25, "moderate").when(far >= 0.10, "supporting").otherwise("weak")
    direction = F.when(F.col("score") > 0.5, "supports").when(F.col("score") < 0.5, "contradicts").otherwise("neutral")
    return compare.evidence(rows, F.col("pair_id"), "candidate_pair", "score_component", direction, strength, F.concat(F.lit("component "), F.col("component")), F.col("score"), F.create_map(F.lit("component"), F.col("component")))


def named_term(consequences: DataFrame, key: str, impact: str) -> DataFrame:
    """The term that stands for an impact class: loss-of-function terms first, then by name."""
    terms = consequences.filter(F.col("impact") == impact).select(key, F.explode(rules.term_list(F.col("terms"))).alias("term"))
    order = F.struct((~F.col("term").isin(rules.LOSS_OF_FUNCTION)).alias("late"), "term")
    return terms.groupBy(key).agg(F.min(order)["term"].alias("term"))


def with_gene_scores(pairs_: DataFrame, phenotype: DataFrame, mechanisms: DataFrame) -> DataFrame:
    """Phenotype (default 0.5) and mechanism (default 0) scores joined by gene."""
    own = [c for c in ("gene_key", "sample_id") if c in phenotype.columns]  # a phenotype score belongs to a gene, or to a gene in a sample
    joined = pairs_.drop("phenotype", "mechanism").join(phenotype.select(*own, F.col("score").alias("phenotype")), own, "left").join(mechanisms.select("gene_key", F.col("score").alias("mechanism")), "gene_key", "left")
    return joined.withColumn("phenotype", F.coalesce("phenotype", F.lit(0.5))).withColumn("mechanism", F.coalesce("mechanism", F.lit(0.0)))


def answers(scored: DataFrame) -> DataFrame:
    """(pair_id, question, answer): what a dossier says about each pair."""
    text = {
        "how rare": F.format_string("weaker rarity %.3f", "rarity"), "how damaging": F.format_string("weaker consequence %.3f", "consequence"), "what phase": F.col("phase"), "what model": F.col("model"),
        "what contradicts": F.coalesce(F.nullif(F.array_join(F.transform("contradictions", lambda x: x["code"]), ", "), F.lit("")), F.lit("nothing found")),
        "what is open": F.coalesce(F.nullif(F.array_join(F.transform("questions", lambda x: x["question"]), ", "), F.lit("")), F.lit("nothing")),
        "what next": pairs.next_test(F.col("questions")), "how sure of the calls": F.format_string("weaker validity %.3f", "validity"), "how complete": F.format_string("evidence %.3f", "evidence"),
    }
    return scored.select("pair_id", F.explode(F.array(*[F.struct(F.lit(q).alias("question"), a.alias("answer")) for q, a in text.items()])).alias("x")).select("pair_id", "x.*")


def drug_answers(triaged: DataFrame) -> DataFrame:
    """(drug_id, question, answer) of the drug report, with what would reverse a rejection."""
    reversal = F.when(F.col("primary_reason") == "wrong_direction", "evidence of the opposite direction").when(F.col("primary_reason") == "target_not_in_mechanism", "a link from its target into the chain").when(F.col("primary_reason") == "not_approved", "an approval").when(F.col("rejected"), "new safety or exposure data")
    text = {
        "does the direction fit": F.when(F.col("agrees"), "yes").when(F.col("agrees").isNull(), "unknown").otherwise("no"), "how good is the evidence": F.format_string("%.3f", "quality"), "what worries": F.coalesce(F.nullif(F.array_join(F.array_distinct(F.transform("concerns", lambda x: x["reason"])), ", "), F.lit("")), F.lit("nothing found")),
        "verdict": F.when(F.col("rejected"), F.concat(F.lit("rejected: "), F.col("primary_reason"))).otherwise("accepted"), "what would reverse it": F.coalesce(reversal, F.lit("-")), "section": F.when(F.col("intervention_class") == "disease_modifying", "disease_modifying").otherwise("non_disease_modifying"),
    }
    return triaged.select("drug_id", F.explode(F.array(*[F.struct(F.lit(q).alias("question"), a.alias("answer")) for q, a in text.items()])).alias("x")).select("drug_id", "x.*")


def unrendered(triaged: DataFrame, sections: DataFrame) -> DataFrame:
    """Agents that stand in no section or in several; a complete report has none."""
    n = triaged.select("drug_id").join(sections.select("drug_id", F.lit(1).alias("one")), "drug_id", "left").groupBy("drug_id").agg(F.sum("one").alias("n"))
    return n.filter("n IS NULL OR n <> 1")


def truncation_notice(ranked: DataFrame, submitted: DataFrame, promoted: DataFrame) -> DataFrame:
    """Per sample: candidates, submitted rows, promoted and exchanged rows, and how many were left out."""
    n = ranked.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_candidates"))
    s = submitted.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_submitted"))
    p = promoted.groupBy("sample_id").agg(F.count_if("promoted").alias("n_promoted"), F.count_if("exchanged").alias("n_exchanged"))
    return n.join(s, "sample_id", "left").join(p, "sample_id", "left").fillna(0).withColumn("n_omitted", F.col("n_candidates") - F.col("n_submitted"))


def evidence_order(items: DataFrame) -> DataFrame:
    """Adds the place of each item in the ledger's total order, per subject."""
    return items.withColumn("place", F.row_number().over(Window.partitionBy("subject_kind", "subject_id").orderBy("category", "direction", "evidence_id")))
