"""Quality flags, filters, triage, selection and vocabulary rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from variantloom.config import DEFAULT, Config

# Impact ranks and the term sets that decide relevance.
IMPACTS = ["high", "moderate", "low", "modifier"]
LOSS_OF_FUNCTION = ["frameshift_variant", "splice_acceptor_variant", "splice_donor_variant", "start_lost", "stop_gained", "transcript_ablation"]
CODING = [
    "coding_sequence_variant", "coding_transcript_variant", "conservative_inframe_deletion", "conservative_inframe_insertion", "disruptive_inframe_deletion", "disruptive_inframe_insertion",
    "exon_loss_variant", "feature_elongation", "feature_truncation", "frameshift_variant", "incomplete_terminal_codon_variant", "inframe_deletion", "inframe_insertion",
    "initiator_codon_variant", "missense_variant", "protein_altering_variant", "protein_protein_contact", "rare_amino_acid_variant", "start_lost", "start_retained_variant", "stop_gained",
    "stop_lost", "stop_retained_variant", "structural_interaction_variant", "transcript_ablation", "transcript_amplification",
]
SPLICE = [
    "exonic_splice_region_variant", "splice_acceptor_variant", "splice_branch_variant", "splice_donor_5th_base_variant", "splice_donor_region_variant", "splice_donor_variant",
    "splice_polypyrimidine_tract_variant", "splice_region_variant", "splice_site_variant",
]
CODING_OR_SPLICE = [*CODING, *SPLICE]
REVIEW_STARS = {
    "practice_guideline": 4,
    "reviewed_by_expert_panel": 3,
    "criteria_provided,_multiple_submitters,_no_conflicts": 2,
    "criteria_provided,_single_submitter": 1,
    "criteria_provided,_conflicting_classifications": 1,
    "criteria_provided,_conflicting_interpretations": 1,
    "no_assertion_criteria_provided": 0,
    "no_classification_provided": 0,
    "no_assertion_provided": 0,
    "no_classification_for_the_single_variant": 0,
    "no_interpretation_for_the_single_variant": 0,
    "no_classifications_from_unflagged_records": 0,
    "no_assertion_for_the_individual_variant": 0,
}
FREQUENCY_TERMS = {"obligate": (1.0, 1.0), "very frequent": (0.80, 0.99), "frequent": (0.30, 0.79), "occasional": (0.05, 0.29), "very rare": (0.01, 0.04)}


def mapped(values: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def impact_rank(impact: Column) -> Column:
    """0 is the worst; NULL stays NULL."""
    return mapped({x: k for k, x in enumerate(IMPACTS)}, impact)


def impact_of(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in IMPACTS]), rank)


def impact_at_least(impact: Column, floor: str) -> Column:
    """NULL is never at least anything."""
    return F.coalesce(impact_rank(impact) <= IMPACTS.index(floor), F.lit(False))


def term_list(terms: Column) -> Column:
    """Sequence-ontology terms of a text joined by & or +, in lower case."""
    return F.filter(F.transform(F.split(F.lower(terms), "[&+]"), F.trim), lambda x: x != "")


def selecting(impact: Column, terms: Column) -> Column:
    """High or moderate impact, or any coding or splice term."""
    return F.coalesce(impact.isin("high", "moderate"), F.lit(False)) | F.coalesce(F.arrays_overlap(term_list(terms), F.array(*[F.lit(x) for x in CODING_OR_SPLICE])), F.lit(False))


def pathogenic(significance: Column) -> Column:
    low = F.lower(significance)
    return F.coalesce(low.contains("pathogenic") & ~low.contains("conflict") & ~low.contains("benign"), F.lit(False))


def significance_direction(significance: Column) -> Column:
    low = F.lower(significance)
    return F.when(low.contains("conflict"), "neutral").when(low.contains("pathogenic"), "supports").when(low.contains("benign"), "contradicts").otherwise("neutral")


def stars_strength(stars: Column) -> Column:
    return F.when(stars >= 3, "strong").when(stars == 2, "moderate").when(stars == 1, "supporting").otherwise("weak")


def review_stars(status: Column) -> Column:
    """NULL for an unknown status."""
    return mapped(REVIEW_STARS, F.lower(F.replace(F.trim(status), F.lit(" "), F.lit("_"))))


def qc_flags(zygosity: Column, fraction: Column, balance: Column, depth: Column, gq: Column, status: Column, config: Config = DEFAULT, reference_matches: Column | None = None) -> Column:
    """Quality flags in fixed order; the last one only where REF was looked up and is not what the reference has."""
    het = zygosity == "het"
    differs = F.lit(None).cast("string") if reference_matches is None else F.when(reference_matches.eqNullSafe(F.lit(False)), "reference_mismatch")
    return F.array_compact(
        F.array(
            F.when(status == "filtered", "filtered_by_caller").when(status == "missing", "no_caller_filter"),
            F.when(depth < config.min_depth, "low_depth"),
            F.when(gq < config.min_gq, "low_gq"),
            F.when(het & (fraction > config.het_high), "high_allele_balance"),
            F.when(het & (fraction < config.mosaic_floor), "low_allele_balance"),
            F.when(het & (fraction >= config.mosaic_floor) & (fraction < config.het_low), "possible_mosaic"),
            F.when(depth.isNull() & gq.isNull() & balance.isNull(), "no_quality_metrics"),
            differs,
        )
    )


CONTRADICTING = ["filtered_by_caller", "low_depth", "low_gq", "high_allele_balance", "low_allele_balance", "reference_mismatch"]
NEUTRAL = ["no_caller_filter", "possible_mosaic", "no_quality_metrics"]


def qc_direction(flags: Column) -> Column:
    any_of = lambda names: F.arrays_overlap(flags, F.array(*[F.lit(x) for x in names]))
    return F.when(any_of(CONTRADICTING), "contradicts").when(any_of(NEUTRAL), "neutral").otherwise("supports")


def qc_strength(flags: Column, depth: Column, gq: Column, reference_matches: Column) -> Column:
    has = lambda *names: F.arrays_overlap(flags, F.array(*[F.lit(x) for x in names]))
    return (
        F.when(reference_matches.eqNullSafe(False), "strong")
        .when(has(*CONTRADICTING), F.when(has("low_depth", "low_gq", "filtered_by_caller"), "moderate").otherwise("supporting"))
        .when(has("no_quality_metrics"), "insufficient")
        .when(has("possible_mosaic"), "supporting")
        .when((depth >= 20) & (gq >= 20), "strong")
        .otherwise("moderate")
    )


def hard_reason(build: Column, wanted: str, canonical: Column, alt: Column, zygosity: Column) -> Column:
    """Why a record is not valid here; NULL if it is."""
    return (
        F.when(build != wanted, "wrong_genome_build")
        .when(~canonical, "non_canonical_contig")
        .when(alt.isin("*", "."), "uninformative_alt_allele")
        .when(zygosity == "hom_ref", "no_alt_allele_called")
        .when(zygosity == "unknown", "missing_genotype")
    )


def soft_flags(af: Column, status: Column, depth: Column, gq: Column, zygosity: Column, fraction: Column, all_benign: Column, untrusted: Column | None = None, config: Config = DEFAULT) -> Column:
    """Flags that inform ranking and drop nothing. all_benign is false where any impact is unknown."""
    het = zygosity == "het"
    poor = F.coalesce(status == "filtered", F.lit(False)) | F.coalesce(depth < config.min_depth, F.lit(False)) | F.coalesce(gq < config.min_gq, F.lit(False))
    poor = poor | F.coalesce(het & ((fraction > config.het_high) | (fraction < config.mosaic_floor)), F.lit(False))
    if untrusted is not None:
        poor = poor | untrusted
    return F.array_compact(
        F.array(
            F.when(af.isNull(), "no_frequency_data").when(af > config.max_recessive, "common_variant").when(af > config.low, "low_frequency_variant"),
            F.when(poor, "low_quality_call"),
            F.when(het & (fraction >= config.mosaic_floor) & (fraction < config.het_low), "possible_mosaic"),
            F.when(all_benign, "benign_consequence"),
            F.when(zygosity == "hom_alt", "homozygous_call"),
        )
    )


def triage_verdict(n: Column, any_selecting: Column, worst: Column, splice: Column, clinical: Column, config: Config = DEFAULT) -> Column:
    """First matching reason of the relevance bar. n counts consequences; worst is an impact rank or NULL."""
    t = config.triage
    if not t.enabled:
        return F.lit("kept_triage_disabled")
    none = n == 0
    return (
        F.when(none & clinical, "kept_clinical_assertion")
        .when(none, "kept_no_gene_assignment" if t.retain_no_gene else "dropped_no_gene_assignment")
        .when(any_selecting, "kept_relevant_consequence")
        .when(worst <= IMPACTS.index(t.floor), "kept_impact_at_or_above_floor")
        .when(splice >= t.splice_ai, "kept_splice_ai")
        .when(clinical, "kept_clinical_assertion")
        .when(worst.isNull(), "kept_impact_not_assessed" if t.retain_unassessed else "dropped_impact_not_assessed")
        .otherwise("dropped_impact_below_floor")
    )


def selection_verdict(n: Column, any_selecting: Column, any_assessed: Column, splice: Column, af: Column, clinical: Column, config: Config = DEFAULT) -> Column:
    """First matching reason of the selection gates; a pathogenic assertion rescues from both."""
    s = config.selection
    if not s.enabled:
        return F.lit("retained_selection_disabled")
    rescued = clinical if s.keep_pathogenic else F.lit(False)
    verdict = F.when(~rescued & (af > s.max_af), "dropped_common_in_population")
    if not s.retain_unknown_af:
        verdict = verdict.when(~rescued & af.isNull(), "dropped_frequency_unknown")
    return (
        verdict.when((n == 0) & rescued, "retained_pathogenic_assertion")
        .when(n == 0, "retained_no_gene_assignment" if s.retain_no_gene else "dropped_no_gene_assignment")
        .when(any_selecting | F.coalesce(splice >= s.splice_ai, F.lit(False)), "retained_coding_or_splice")
        .when(~any_assessed & F.lit(s.retain_unassessed), "retained_impact_not_assessed")
        .when(rescued, "retained_pathogenic_assertion")
        .otherwise("dropped_not_coding_or_splice")
    )


def selection_notes(verdict: Column, n: Column, any_selecting: Column, splice: Column, af: Column, underpowered: Column, clinical: Column, config: Config = DEFAULT) -> Column:
    """What was seen on the way to a selection verdict, whatever it is; a variant that its frequency stopped was not asked for splicing."""
    stopped = verdict.isin("dropped_common_in_population", "dropped_frequency_unknown")
    unknown = F.when(F.coalesce(F.size(underpowered), F.lit(0)) > 0, "frequency_underpowered").otherwise("frequency_unknown")
    return F.array_compact(
        F.array(
            F.when(clinical, "clinical_pathogenic_assertion"),
            F.when(af.isNull(), unknown),
            F.when(~stopped & (n > 0) & ~any_selecting & F.coalesce(splice >= config.selection.splice_ai, F.lit(False)), "splice_ai_above_threshold"),
        )
    )


def hpo_id(raw: Column) -> Column:
    """HP:0000000 form; NULL if it is none."""
    text = F.regexp_replace(F.upper(F.trim(raw)), "^HP_", "HP:")
    return F.when(text.rlike(r"^HP:\d{7}$"), text)


def hpo_frequency(raw: Column) -> Column:
    """(kind, lower, upper, error) of a frequency text: a term, n/m or a percentage."""
    text = F.lower(F.trim(raw))
    n, m = F.nullif(F.regexp_extract(text, r"^(\d+)/(\d+)$", 1), F.lit("")).cast("double"), F.nullif(F.regexp_extract(text, r"^(\d+)/(\d+)$", 2), F.lit("")).cast("double")
    pct = F.nullif(F.regexp_extract(text, r"^(\d+(?:\.\d+)?)%$", 1), F.lit("")).cast("double")
    lows, highs = ({k: v[i] for k, v in FREQUENCY_TERMS.items()} for i in (0, 1))
    error = F.when((m == 0) | (n > m), "bad_ratio").when(pct > 100, "bad_percent").when(text == "hp:0040285", "excluded_frequency")
    kind = F.when(text.isNull() | (text == ""), None).when(m.isNotNull(), "ratio").when(pct.isNotNull(), "percent").when(mapped(lows, text).isNotNull(), "term")
    low = F.when(error.isNull(), F.coalesce(n / F.nullif(m, F.lit(0.0)), pct / 100, mapped(lows, text)))
    high = F.when(error.isNull(), F.coalesce(n / F.nullif(m, F.lit(0.0)), pct / 100, mapped(highs, text)))
    unknown = F.when(text.isNotNull() & (text != "") & kind.isNull() & error.isNull(), "unknown_frequency")
    return F.struct(kind.alias("kind"), low.alias("lower"), high.alias("upper"), F.coalesce(error, unknown).alias("error"))


# Weights of curated validity tiers; uncurated genes are neutral.
VALIDITY = {"definitive": 1.0, "strong": 0.8, "moderate": 0.6, "limited": 0.4, "supporting": 0.4, "disputed": 0.2, "refuted": 0.1, "no known disease relationship": 0.1}


def association_weight(strength: Column, default: float = 0.5) -> Column:
    return F.coalesce(mapped(VALIDITY, F.lower(strength)), F.lit(default))


def strength_verdict(token: Column) -> Column:
    """ok for a validity tier or a blank, else why not: a word of the frequency vocabulary, or an unknown tier."""
    low = F.lower(F.trim(token))
    return F.when(low.isNull() | (low == "") | low.isin(list(VALIDITY)), "ok").when(low.isin(list(FREQUENCY_TERMS)), "frequency_vocabulary").otherwise("unknown_tier")


def decoded_text(raw: Column) -> Column:
    """VCF percent codes and underscores to text; the percent sign itself last."""
    out = raw
    for code, char in (("%3A", ":"), ("%3B", ";"), ("%3D", "="), ("%2C", ","), ("%0D", "\r"), ("%0A", "\n"), ("%09", "\t")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return F.replace(F.replace(out, F.lit("_"), F.lit(" ")), F.lit("%25"), F.lit("%"))


def decoded_list(raw: Column, separator: str = r"\|") -> Column:
    """Decoded, non-empty, distinct members of an encoded list."""
    return F.array_distinct(F.filter(F.transform(F.split(raw, separator), lambda x: F.trim(decoded_text(x))), lambda x: ~x.isin("", ".", "not provided")))
