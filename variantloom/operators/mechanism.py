"""Mechanism graphs and signed drug triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from variantloom.functions.rules import mapped

# Direction vocabularies, weights, markers and the order of reasons.
UP = ["increase", "gain_of_function", "stabilise", "restore"]
DOWN = ["decrease", "loss_of_function", "destabilise"]
UNSIGNED = ["unknown", "context_dependent"]
CORRECTIVE = {"decrease": "increase", "increase": "decrease", "loss_of_function": "restore", "gain_of_function": "decrease", "destabilise": "stabilise", "stabilise": "destabilise"}
LINK_STRENGTH = {"definitive": 1.0, "strong": 0.85, "moderate": 0.6, "supporting": 0.45, "weak": 0.25, "insufficient": 0.05}
EVIDENCE_TYPE = {
    "human_trial": 1.0, "human_observational": 0.85, "human_case_report": 0.7, "animal_model": 0.6, "direct_measurement": 0.55, "primary_patient_cells": 0.5, "cell_line": 0.35,
    "expert_review": 0.3, "curated_database": 0.3, "biochemical_binding": 0.25, "in_silico_prediction": 0.1, "pipeline_inference": 0.05,
}
APPROVAL = {
    "approved": 1.0, "approved_other_indication": 0.9, "approved_adult_only": 0.7, "investigational_phase_3": 0.35, "investigational_phase_2": 0.25, "investigational_phase_1": 0.15,
    "preclinical": 0.05, "tool_compound": 0.05, "withdrawn": 0.0, "unknown": 0.0,
}
CLASS = {"disease_modifying": 1.0, "preventive": 0.8, "symptomatic": 0.5, "supportive": 0.45, "surveillance": 0.4}
SEVERITY = {"critical": 1.0, "major": 0.35, "moderate": 0.2, "minor": 0.1}
REASONS = [
    "target_not_in_mechanism", "wrong_direction", "oncogenic_risk", "concentration_not_achievable", "not_approved", "safety_concern", "pharmacokinetic_barrier", "mechanism_mismatch",
    "insufficient_evidence", "no_pediatric_evidence", "direction_unknown",
]
CIN_MARKERS = ["aneuploid", "missegregation", "chromosomal instability", "chromosome instability", "genome instability", "genomic instability", "micronucle", "spindle assembly checkpoint", "mitotic checkpoint"]
NEURO_MARKERS = ["microcephaly", "brain", "cerebral", "cerebellar", "neuro", "cognitive", "seizure", "epilep", "developmental delay", "intellectual"]


def directions_agree(required: Column, observed: Column) -> Column:
    """True, false, or NULL where a side has no sign. A measured null disagrees."""
    return (
        F.when(required.isNull() | observed.isNull() | required.isin(UNSIGNED) | observed.isin(UNSIGNED), None)
        .when(observed == "no_change", False)
        .when(required == "no_change", None)
        .otherwise((required.isin(UP) & observed.isin(UP)) | (required.isin(DOWN) & observed.isin(DOWN)))
    )


def corrective(state: Column) -> Column:
    return F.coalesce(mapped(CORRECTIVE, state), F.lit("unknown"))


def matches(text: Column, markers: list[str]) -> Column:
    return F.coalesce(F.lower(text).rlike("|".join(markers)), F.lit(False))


def contexts(nodes: DataFrame, mechanisms: DataFrame) -> DataFrame:
    """mechanism_id with its chromosomal-instability and neurological contexts, from all its texts."""
    text = nodes.select("mechanism_id", F.concat_ws(" ", "label", "description").alias("text")).union(mechanisms.select("mechanism_id", "summary"))
    return text.groupBy("mechanism_id").agg(F.bool_or(matches(F.col("text"), CIN_MARKERS)).alias("cin_context"), F.bool_or(matches(F.col("text"), NEURO_MARKERS)).alias("neuro_context"))


def relevance(links: DataFrame) -> DataFrame:
    """Mechanism score: mean link strength, demonstrated share, a deduction per inferred link."""
    g = links.groupBy("mechanism_id").agg(F.avg(F.coalesce(mapped(LINK_STRENGTH, F.col("strength")), F.lit(0.05))).alias("mean_strength"), F.avg(F.col("demonstrated").cast("double")).alias("share"), F.count_if(~F.col("demonstrated")).alias("inferred"))
    raw = 0.55 * F.col("mean_strength") + 0.45 * F.col("share") - 0.05 * F.col("inferred")
    return g.withColumn("score", F.round(F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)), 6))


def concerns(df_cols: dict[str, Column]) -> Column:
    """(severity, disqualifying, reason) of every safety and exposure concern; keys: cin, worsens, pediatric, required, achievable, route, neuro, cns."""
    c = df_cols
    one = lambda test, severity, dis, reason: F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(severity).alias("severity"), (dis if isinstance(dis, Column) else F.lit(dis)).alias("disqualifying"), F.lit(reason).alias("reason")))
    both = c["required"].isNotNull() & c["achievable"].isNotNull()
    no_route = c["route"].isNull() | F.lower(F.trim(c["route"])).isin("", "none", "n/a")
    return F.array_compact(
        F.array(
            one(c["worsens"] & c["cin"], "critical", True, "oncogenic_risk"),
            one(c["worsens"] & ~c["cin"], "critical", False, "safety_concern"),
            one(c["worsens"].isNull() & c["cin"], "critical", True, "oncogenic_risk"),
            one(c["worsens"].isNull() & ~c["cin"], "major", False, "safety_concern"),
            one(~F.coalesce(c["pediatric"], F.lit(False)), "major", False, "no_pediatric_evidence"),
            one(both & (c["required"] > c["achievable"]), "critical", True, "concentration_not_achievable"),
            one(~both, "major", False, "pharmacokinetic_barrier"),
            one(no_route, "major", False, "pharmacokinetic_barrier"),
            one(c["neuro"] & (c["cns"] == F.lit(False)), "major", False, "pharmacokinetic_barrier"),
            one(c["neuro"] & c["cns"].isNull(), "moderate", False, "pharmacokinetic_barrier"),
        )
    )


def evidence_quality(kind: Column, direct: Column) -> Column:
    return F.coalesce(mapped(EVIDENCE_TYPE, kind), F.lit(0.05)) * F.when(direct, 1.0).otherwise(0.6)


def drug_score(agree: Column, quality: Column, penalty: Column, approval: Column, class_: Column) -> Column:
    direction = F.when(agree, 1.0).when(agree.isNull(), 0.35).otherwise(0.0)
    raw = (0.40 * direction + 0.30 * quality + 0.20 * F.greatest(F.lit(0.0), 1 - penalty) + 0.10 * F.coalesce(mapped(APPROVAL, approval), F.lit(0.0))) * F.coalesce(mapped(CLASS, class_), F.lit(0.0))
    return F.round(F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)), 6)


def triage(drugs: DataFrame, nodes: DataFrame, mechanisms: DataFrame) -> DataFrame:
    """Every agent against its mechanism: direction, concerns, score, reasons in fixed order, verdict and rank.

    drugs: drug_id, mechanism_id, target_node_id, observed_direction, is_direct, evidence_type, approval_status,
    intervention_class, worsens_cin, pediatric, route, cns_penetrant, achievable_um, required_um. Nothing is dropped: rejected agents stay, with reasons.
    """
    in_chain = nodes.select("mechanism_id", F.col("node_id").alias("target_node_id"), F.col("state_in_patient"), F.lit(True).alias("in_chain"))
    df = drugs.join(in_chain, ["mechanism_id", "target_node_id"], "left").join(mechanisms.select("mechanism_id", "therapeutic_target_node_id", "required_correction"), "mechanism_id", "left")
    df = df.join(contexts(nodes, mechanisms), "mechanism_id", "left").withColumn("in_chain", F.coalesce("in_chain", F.lit(False)))
    at_target = F.col("target_node_id") == F.col("therapeutic_target_node_id")
    df = df.withColumn("required_direction", F.when(F.coalesce(at_target, F.lit(False)), F.col("required_correction")).when(F.col("in_chain"), corrective(F.col("state_in_patient"))).otherwise("unknown"))
    df = df.withColumn("agrees", directions_agree(F.col("required_direction"), F.col("observed_direction")))
    cols = {"cin": F.coalesce("cin_context", F.lit(False)), "neuro": F.coalesce("neuro_context", F.lit(False)), "worsens": F.col("worsens_cin"), "pediatric": F.col("pediatric"), "required": F.col("required_um"), "achievable": F.col("achievable_um"), "route": F.col("route"), "cns": F.col("cns_penetrant")}
    df = df.withColumn("concerns", concerns(cols)).withColumn("quality", evidence_quality(F.col("evidence_type"), F.col("is_direct")))
    df = df.withColumn("safety_penalty", F.aggregate("concerns", F.lit(0.0), lambda a, x: a + mapped(SEVERITY, x["severity"])))
    repurposable = F.col("approval_status").isin("approved", "approved_other_indication", "approved_adult_only")
    found = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(~F.col("in_chain"), "target_not_in_mechanism"),
                F.when(F.col("agrees") == F.lit(False), "wrong_direction"),
                F.when(~repurposable, "not_approved"),
                F.when(F.col("in_chain") & ~F.coalesce(at_target, F.lit(False)), "mechanism_mismatch"),
                F.when(F.col("quality") < 0.30, "insufficient_evidence"),
                F.when(F.col("agrees").isNull(), "direction_unknown"),
            )
        )
    )
    df = df.withColumn("reasons", F.array_union(found, F.transform("concerns", lambda x: x["reason"])))
    df = df.withColumn("reasons", F.filter(F.array(*[F.lit(r) for r in REASONS]), lambda r: F.array_contains("reasons", r)))
    fatal = ~F.col("in_chain") | F.coalesce(F.col("agrees") == F.lit(False), F.lit(False)) | ~repurposable | F.exists("concerns", lambda x: x["disqualifying"])
    df = df.withColumn("rejected", fatal).withColumn("primary_reason", F.when(F.col("rejected"), F.get("reasons", F.lit(0))))
    df = df.withColumn("score", drug_score(F.col("agrees"), F.col("quality"), F.col("safety_penalty"), F.col("approval_status"), F.col("intervention_class")))
    order = Window.partitionBy("mechanism_id", "rejected").orderBy(F.desc("score"), "drug_id")
    return df.withColumn("rank", F.when(~F.col("rejected"), F.row_number().over(order)))


def rejections(triaged: DataFrame) -> DataFrame:
    """One row per rejected agent and reason."""
    return triaged.filter("rejected").select("drug_id", "mechanism_id", F.explode("reasons").alias("reason"))


def avoid_and_ranking(triaged: DataFrame, nodes: DataFrame) -> DataFrame:
    """All agents of a run with `list` (screened or avoid), their place in the run's order, accepted ones first, and the node they act on."""
    order = Window.partitionBy("mechanism_id").orderBy("rejected", F.desc("score"), "drug_id")
    named = nodes.select("mechanism_id", F.col("node_id").alias("target_node_id"), F.col("label").alias("node"))
    met = triaged.withColumn("place", F.row_number().over(order)).join(named, ["mechanism_id", "target_node_id"], "left")
    return met.withColumn("node", F.coalesce("node", F.lit("(not on this chain)"))).withColumn("list", F.when(F.col("rejected"), "avoid").otherwise("screened"))


def section(class_: Column) -> Column:
    """Where an agent is reported."""
    return F.when(class_ == "disease_modifying", "disease_modifying").otherwise("non_disease_modifying")


def score_strength(score: Column) -> Column:
    return F.when(score >= 0.8, "strong").when(score >= 0.6, "moderate").when(score >= 0.4, "supporting").when(score >= 0.2, "weak").otherwise("insufficient")


def invalid_links(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links with an end that is no node of their mechanism."""
    ends = links.select("mechanism_id", "link_id", F.explode(F.array("source_node_id", "target_node_id")).alias("node_id"))
    return ends.join(nodes.select("mechanism_id", "node_id"), ["mechanism_id", "node_id"], "left_anti")


def invalid_mechanisms(mechanisms: DataFrame, nodes: DataFrame) -> DataFrame:
    """Mechanisms without their target node, with a target that only compensates (nodes with a `kind`), or whose correction does not fit the target's state."""
    kind = F.col("kind") if "kind" in nodes.columns else F.lit(None).cast("string")
    target = nodes.select("mechanism_id", F.col("node_id").alias("therapeutic_target_node_id"), "state_in_patient", kind.alias("kind_"))
    met = mechanisms.join(target, ["mechanism_id", "therapeutic_target_node_id"], "left")
    agree = directions_agree(corrective(F.col("state_in_patient")), F.col("required_correction"))
    reason = F.when(F.col("state_in_patient").isNull(), "target_not_a_node").when(F.col("kind_") == "compensatory", "compensatory_target").when(agree == F.lit(False), "inconsistent_direction")
    return met.withColumn("reason", reason).filter("reason IS NOT NULL").select("mechanism_id", "reason")


def agents_of_nodes(agents: DataFrame) -> DataFrame:
    """target_node_id, agents: agents aimed at exactly this node, in order."""
    return agents.groupBy("target_node_id").agg(F.array_sort(F.collect_list("drug_id")).alias("agents"))


def bound(candidates: DataFrame, mechanisms: DataFrame) -> DataFrame:
    """Candidates with the mechanism of their gene; a missing one is a warning, not evidence that there is none."""
    met = candidates.join(mechanisms, "gene_key", "left")
    return met.withColumn("warning", F.when(F.col("mechanism_id").isNull(), "no_curated_mechanism"))


# What a control agent changes in an agent that must pass, and the verdict it must get (by the context of the mechanism for the two risks).
CONTROLS = {
    "accepted": ({}, None), "inverted": ({"observed_direction": "opposite"}, "wrong_direction"), "unknown_direction": ({"observed_direction": "unknown"}, None), "no_effect": ({"observed_direction": "no_change"}, "wrong_direction"),
    "risk_not_assessed": ({"worsens_cin": None}, "oncogenic_risk in context"), "risk_known": ({"worsens_cin": True}, "oncogenic_risk in context"), "off_chain": ({"target_node_id": -1}, "target_not_in_mechanism"),
    "mirrored_mechanism": ({}, "wrong_direction"), "tool_compound": ({"approval_status": "tool_compound"}, "not_approved"), "out_of_reach": ({"achievable_um": 5.0}, "concentration_not_achievable"),
    "no_pediatric_record": ({"pediatric": False}, None), "symptomatic": ({"intervention_class": "symptomatic"}, None),
}
PASSING = {
    "is_direct": True, "evidence_type": "human_trial", "approval_status": "approved", "intervention_class": "disease_modifying", "worsens_cin": False, "pediatric": True, "route": "oral", "cns_penetrant": True,
    "achievable_um": 50.0, "required_um": 25.0,
}
OPPOSITE = {"increase": "decrease", "decrease": "increase", "restore": "decrease", "stabilise": "destabilise", "destabilise": "stabilise"}


def controls(mechanisms: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Control agents for every mechanism that needs a signed correction, with the mirrored mechanisms and nodes that one of them is aimed at.

    Each control is an agent that must pass, with one thing changed. It goes through the same triage as the given agents, with an id below zero;
    `control`, `expected_rejected` and `expected_reason` say what must come out. A mechanism without a sign has nothing to invert and no controls.
    """
    target = nodes.select("mechanism_id", F.col("node_id").alias("therapeutic_target_node_id"), "label", "description")
    signed = mechanisms.filter(F.col("required_correction").isin(*OPPOSITE)).join(contexts(nodes, mechanisms).select("mechanism_id", "cin_context"), "mechanism_id")
    opposite = mapped(OPPOSITE, F.col("required_correction"))
    rows = None
    for k, (name, (changed, reason)) in enumerate(CONTROLS.items()):
        values = PASSING | changed
        own = F.col("mechanism_id") if name != "mirrored_mechanism" else -1 - F.col("mechanism_id")
        direction = values.get("observed_direction")
        observed = F.col("required_correction") if direction is None else opposite if direction == "opposite" else F.lit(direction)
        node = F.lit(values["target_node_id"]).cast("long") if "target_node_id" in values else F.col("therapeutic_target_node_id")
        why = F.when(F.col("cin_context"), reason.split(" ")[0]) if reason and reason.endswith("in context") else F.lit(reason).cast("string")
        fixed = [F.lit(values[c]).cast("boolean" if c in ("is_direct", "worsens_cin", "pediatric", "cns_penetrant") else "double" if c.endswith("_um") else "string").alias(c) for c in PASSING]
        one = signed.select((-1 - F.col("mechanism_id") * 100 - k).cast("long").alias("drug_id"), own.alias("mechanism_id"), node.alias("target_node_id"), observed.alias("observed_direction"), *fixed, F.lit(name).alias("control"), F.col("mechanism_id").alias("of_mechanism"), why.alias("expected_reason"))
        rows = one if rows is None else rows.unionByName(one)
    mirrored = signed.withColumn("mechanism_id", -1 - F.col("mechanism_id")).withColumn("required_correction", opposite)
    state = F.when(F.col("required_correction") == "decrease", "increase").when(F.col("required_correction") == "increase", "decrease").when(F.col("required_correction") == "stabilise", "destabilise").otherwise("stabilise")
    met = target.withColumn("mechanism_id", -1 - F.col("mechanism_id")).join(mirrored.select("mechanism_id", "therapeutic_target_node_id", "required_correction"), ["mechanism_id", "therapeutic_target_node_id"])
    mirrored_nodes = met.select("mechanism_id", F.col("therapeutic_target_node_id").alias("node_id"), "label", "description", state.alias("state_in_patient"))
    return rows.withColumn("expected_rejected", F.col("expected_reason").isNotNull()), mirrored_nodes, mirrored.select(mechanisms.columns)


def controlled_triage(drugs: DataFrame, nodes: DataFrame, mechanisms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The triage of the given agents, and of the controls with `met`: one pass judges both, so a dead check shows in the controls."""
    made, more_nodes, more = controls(mechanisms, nodes)
    marks = ["control", "of_mechanism", "expected_reason", "expected_rejected"]
    rows = drugs.unionByName(made, allowMissingColumns=True)
    judged = triage(rows, nodes.select(more_nodes.columns).unionByName(more_nodes), mechanisms.unionByName(more))
    met = (F.col("rejected") == F.col("expected_rejected")) & F.col("primary_reason").eqNullSafe(F.col("expected_reason"))
    flagged = F.when(F.col("control") == "unknown_direction", F.array_contains("reasons", "direction_unknown")).otherwise(F.lit(True))
    return judged.filter("control IS NULL").drop(*marks), judged.filter("control IS NOT NULL").withColumn("met", met & flagged)


def link_experiments(links: DataFrame) -> DataFrame:
    """A proposed experiment for each inferred link."""
    return links.filter(~F.col("demonstrated")).select("mechanism_id", "link_id", F.format_string("test whether %s acts on %s", "source_node_id", "target_node_id").alias("experiment"))
