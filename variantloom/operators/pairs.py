"""Candidate pairs within genes: caps, enumeration, phase, scores, ranking and submission."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from variantloom.config import DEFAULT, Config
from variantloom.functions import alleles
from variantloom.operators.tables import cut

ORDER = ["contig_order", "position", "ref", "alt", "variant_id"]
COMPONENTS = ["validity", "rarity", "consequence", "inheritance", "phenotype", "mechanism", "evidence"]


def placed(variants: DataFrame, group: list[str], config: Config = DEFAULT) -> DataFrame:
    """Variants with their place in the plausibility order of each gene; `n_variants` counts all. Both come from one shuffle."""
    common = F.when(F.col("max_af").isNull() | (F.col("max_af") <= config.max_recessive), 0).otherwise(1)
    poor = F.when(F.array_contains("flags", "low_quality_call"), 1).otherwise(0)
    key = F.struct(common.alias("common"), poor.alias("poor"), F.coalesce("worst_rank", F.lit(2)).alias("impact"), *ORDER)
    w = Window.partitionBy(*group).orderBy("plausibility")
    ranked = variants.withColumn("plausibility", key).withColumn("place", F.row_number().over(w)).withColumn("n_variants", F.count(F.lit(1)).over(Window.partitionBy(*group)))
    return ranked


def capped(variants: DataFrame, group: list[str], config: Config = DEFAULT) -> DataFrame:
    """The most plausible variants of each gene. Capping is what keeps the pairs of a gene bounded."""
    return placed(variants, group, config).filter(F.col("place") <= config.variants_per_gene)


def with_singles(variants: DataFrame, group: list[str], config: Config = DEFAULT) -> DataFrame:
    """Pairs of the capped variants, and single candidates of all; the variants are written out, as both read them."""
    return pairs_and_singles(cut(placed(variants, group, config)), group, config)


def pairs_and_singles(every: DataFrame, group: list[str], config: Config = DEFAULT) -> DataFrame:
    """As with_singles, of variants that have their places already."""
    return enumerated(every.filter(F.col("place") <= config.variants_per_gene), group).unionByName(singles(every, group))


def enumerated(variants: DataFrame, group: list[str]) -> DataFrame:
    """All pairs a < b (in genomic order) of each group's capped variants, as structs a and b.

    A capped group is a short array, so its pairs come out of the array: the variants are computed and shuffled once, where a
    self-join would do both twice.
    """
    rest = [c for c in variants.columns if c not in group and c not in ORDER]
    own = variants.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(*ORDER, *rest))).alias("v_"))
    first = own.select(*group, "v_", F.posexplode("v_").alias("at_", "a"))
    return first.select(*group, "a", F.explode(F.slice("v_", F.col("at_") + 2, F.size("v_"))).alias("b"))


def singles(variants: DataFrame, group: list[str]) -> DataFrame:
    """Variants that explain a gene alone, as rows with a and an empty b: two copies, no second copy, or one grave hit."""
    mosaic = F.array_contains("flags", "possible_mosaic")
    own = variants.filter(wants_single(F.col("contig"), F.col("zygosity"), mosaic, F.col("worst_rank")))
    rest = [c for c in variants.columns if c not in group and c not in ORDER]
    one = own.select(*group, F.struct(*ORDER, *rest).alias("a"))
    return one.withColumn("b", F.lit(None).cast(one.schema["a"].dataType))


def kept_pairs(pairs: DataFrame, group: list[str], config: Config = DEFAULT) -> DataFrame:
    """The pairs of each gene with the best weakest member; adds `generated`, `pair_place` and `truncated`. A group has
    at most variants_per_gene * (variants_per_gene - 1) / 2 pairs here."""
    w = Window.partitionBy(*group).orderBy(F.greatest("a.place", "b.place"), F.least("a.place", "b.place"), F.col("b").isNotNull())
    ranked = pairs.withColumn("generated", F.count(F.lit(1)).over(Window.partitionBy(*group))).withColumn("pair_place", F.row_number().over(w))
    short = (F.col("generated") > config.pairs_per_gene) | (F.col("a.n_variants") > config.variants_per_gene)
    return ranked.filter(F.col("pair_place") <= config.pairs_per_gene).withColumn("truncated", short)


def phase_status(same_set: Column, slot_a: Column, slot_b: Column) -> Column:
    """cis or trans only from a shared phase set; otherwise unknown, never assumed."""
    return F.when(same_set & (slot_a == slot_b), "cis_confirmed").when(same_set & (slot_a != slot_b), "trans_confirmed").otherwise("unknown")


def pair_model(contig_a: Column, contig_b: Column, zyg_a: Column, zyg_b: Column) -> Column:
    return F.when((contig_a == "chrM") & (contig_b == "chrM"), "mitochondrial").when((zyg_a == "het") & (zyg_b == "het"), "compound_heterozygous").otherwise("unknown")


def single_model(contig: Column, zygosity: Column, mosaic: Column) -> Column:
    return (
        F.when(contig == "chrM", "mitochondrial")
        .when(mosaic, "mosaic")
        .when(zygosity == "hom_alt", "homozygous_recessive")
        .when(zygosity == "hemi", F.when(contig == "chrX", "x_linked").otherwise("homozygous_recessive"))
        .otherwise("unknown")
    )


def wants_single(contig: Column, zygosity: Column, mosaic: Column, worst_rank: Column) -> Column:
    return zygosity.isin("hom_alt", "hemi") | (contig == "chrM") | mosaic | ((zygosity == "het") & F.coalesce(worst_rank == 0, F.lit(False)))


def pair_id(gene: Column, *members: Column) -> Column:
    """The same for either order of the members."""
    return F.concat(F.lit("PAIR-"), F.substring(F.sha2(F.concat_ws("|", gene.cast("string"), F.concat_ws("|", F.array_sort(F.array(*members)))), 256), 1, 16))


def clamp(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def steady(x: Column) -> Column:
    """Six places, half up, with a tolerance of 1e-12: a sum that is taken in another order still gives the same rank."""
    return F.floor(x * 1_000_000 + 0.500001) / 1_000_000


def validity_score(status: Column, depth: Column, gq: Column, zygosity: Column, fraction: Column, low_quality: Column, config: Config = DEFAULT) -> Column:
    score = F.when(status == "filtered", 0.25).when(status == "missing", 0.7).otherwise(1.0)
    for value, least in ((depth, config.min_depth), (gq, config.min_gq)):
        score = score * F.when(value.isNull(), 0.7).when(value < least, F.greatest(F.lit(0.15), value / F.lit(float(least)))).otherwise(1.0)
    het = F.when(fraction.isNull(), 0.85).when(fraction > config.het_high, 0.6).when(fraction < config.mosaic_floor, 0.4).when(fraction < config.het_low, 0.75).otherwise(1.0)
    score = score * F.when(zygosity == "het", het).otherwise(1.0)
    return clamp(F.when(low_quality & (score >= 0.9), score * 0.6).otherwise(score))


def rarity_score(af: Column, config: Config = DEFAULT) -> Column:
    """Linear in log10 of the frequency between fixed knots; unknown is neutral."""
    knots = [(1e-5, 1.0), (1e-4, 0.8), (1e-3, 0.5), (1e-2, 0.15), (0.5, 0.02)]
    out = F.when(af.isNull(), config.absent_score).when(af <= knots[0][0], 1.0)
    for (x0, y0), (x1, y1) in zip(knots, knots[1:], strict=False):
        out = out.when(af <= x1, y0 + (y1 - y0) * (F.log10(af) - F.log10(F.lit(x0))) / (F.log10(F.lit(x1)) - F.log10(F.lit(x0))))
    return out.otherwise(0.02)


def consequence_score(worst_rank: Column, annotated: Column, any_lof: Column, splice: Column, cadd: Column | None = None, revel: Column | None = None) -> Column:
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    base = F.when(worst_rank == 0, 0.9).when(worst_rank == 1, 0.5).when(worst_rank == 2, 0.15).when(worst_rank == 3, 0.05).otherwise(0.1)
    bonus = F.when(F.coalesce(any_lof, F.lit(False)), 0.04).otherwise(0.0) + 0.05 * zero(clamp((splice - 0.5) / 0.5))
    if cadd is not None:
        bonus = bonus + 0.04 * zero(clamp((cadd - 20) / 15))
    if revel is not None:
        bonus = bonus + 0.03 * zero(clamp((revel - 0.5) / 0.5))
    return F.when(annotated, clamp(base + bonus)).otherwise(0.1)


def inheritance_score(model: Column, is_pair: Column, phase: Column, config: Config = DEFAULT) -> Column:
    base = (
        F.when(model == "compound_heterozygous", 1.0)
        .when(model.isin("homozygous_recessive", "x_linked"), 0.9)
        .when(model.isin("mitochondrial", "mosaic"), 0.5)
        .when(model == "unknown", F.when(is_pair, 0.6).otherwise(0.2))
        .otherwise(0.5)
    )
    weight = F.lit(None).cast("double")
    for name, value in config.phase_weights:
        weight = F.coalesce(F.when(phase == name, value), weight)
    return base * F.when(is_pair, F.coalesce(weight, F.lit(dict(config.phase_weights)["unknown"]))).otherwise(1.0)


def evidence_quality(with_af: Column, depth: Column, predictors: Column, clinical: Column, phased: Column, is_pair: Column) -> Column:
    """Mean of six facets; the first four are shares of the members or annotation depth, 0 to 1."""
    return (with_af + depth + predictors + clinical + F.when(phased, 1.0).otherwise(0.0) + F.when(is_pair, 1.0).otherwise(0.5)) / 6


def contradictions(model: Column, phase: Column, flags: list[Column], nhomalt: list[Column], af: list[Column], config: Config = DEFAULT) -> Column:
    """(code, magnitude, member) of everything that speaks against a candidate; member: a or b, or both for what is said of the pair."""
    one = lambda test, code, size, member: F.when(test, F.struct(F.lit(code).alias("code"), F.lit(size).alias("magnitude"), F.lit(member).alias("member")))
    found = [one((model == "compound_heterozygous") & phase.isin("cis_confirmed", "cis_likely"), "in_cis_phase", 0.6, "both")]
    for member, f, n, a in zip("ab", flags, nhomalt, af, strict=True):
        found += [
            one(F.array_contains(f, "common_variant"), "common_variant", 0.45, member),
            one(F.coalesce((n > 0) & (a > config.low), F.lit(False)), "population_homozygotes", 0.35, member),
            one(F.array_contains(f, "low_quality_call"), "low_quality_call", 0.3, member),
            one(F.array_contains(f, "benign_consequence"), "benign_consequence", 0.25, member),
        ]
    return F.array_compact(F.array(*found))


def penalty(found: Column) -> Column:
    """1 - product(1 - magnitude)."""
    return 1 - F.aggregate(found, F.lit(1.0), lambda a, x: a * (1 - x["magnitude"]))


def composite(scores: dict[str, Column], penalty_: Column, config: Config = DEFAULT) -> Column:
    w = config.weights
    return clamp(sum((getattr(w, c) * scores[c] for c in COMPONENTS), F.lit(0.0)) - w.penalty * penalty_)


def ranked(df: DataFrame, by: list[str]) -> DataFrame:
    """Total order per sample: composite, the first member, the second member, the pair id."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("composite"), "key_a", "key_b", "pair_id")))


def discriminating(df: DataFrame, by: list[str]) -> DataFrame:
    """The component with the largest gap to the next rank; the last row names its weakest component."""
    w = Window.partitionBy(*by).orderBy("rank")
    gaps = F.array(*[F.struct(F.round(F.abs(F.col(c) - F.lead(c).over(w)), 6).alias("gap"), F.lit(-k).alias("place"), F.lit(c).alias("name")) for k, c in enumerate(COMPONENTS)])
    weak = F.array(*[F.struct(F.round(c, 6).alias("gap"), F.lit(k).alias("place"), F.lit(c).alias("name")) for k, c in enumerate(COMPONENTS)])
    df = df.withColumn("gap", F.when(F.lead("rank").over(w).isNotNull(), F.array_max(gaps)["gap"]))
    return df.withColumn("experiment", F.when(F.lead("rank").over(w).isNotNull(), F.array_max(gaps)["name"]).otherwise(F.array_min(weak)["name"]))


def not_subsumed(df: DataFrame, by: list[str], members: str = "members") -> DataFrame:
    """Drops a row whose members are all in a higher-ranked row of the same group.

    Only rows that share a member can subsume each other, so the join is on (group, member), not on the group. The ranking is
    written out first, as it is read three times.
    """
    df = cut(df)
    higher = df.select(*by, F.col("rank").alias("rank_h"), F.col(members).alias("members_h"), F.explode(members).alias("member_"))
    own = df.withColumn("member_", F.element_at(members, 1))
    keep = own.join(higher, [*by, "member_"], "left").withColumn("subsumed", (F.col("rank_h") < F.col("rank")) & (F.size(F.array_except(members, "members_h")) == 0))
    gone = keep.filter("subsumed").select(*by, "rank").distinct()
    return df.join(gone, [*by, "rank"], "left_anti")


def promoted(df: DataFrame, by: str, most: int = 10) -> DataFrame:
    """Strict supersets go directly above the rows that they contain, inside a window of `most` rows; a superset outside is
    exchanged for a row that has none inside. Rows outside meet the window by a shared member (an equi-join), and only the
    window and the first superset of each of its rows, 2 * `most` rows at most, go through the grouped step."""

    def lift(rows: list, moved: set) -> None:
        again = True
        while again:
            again = False
            for i, low in enumerate(rows):
                j = next((j for j in range(i + 1, len(rows)) if set(rows[j][1]) > set(low[1])), None)
                if j is not None:
                    moved.add(rows[j][0])
                    rows.insert(i, rows.pop(j))
                    again = True
                    break

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at_")
        rows = [(r, tuple(m)) for r, m in zip(pdf["at_"], pdf["members"], strict=True)]
        inside, outside, moved, swapped = [x for x in rows if x[0] <= most], [x for x in rows if x[0] > most], set(), set()
        slots = [*range(1, len(inside) + 1), *(r for r, _ in outside)]
        lift(inside, moved)
        for i, low in enumerate(inside):
            if not any(set(x[1]) > set(low[1]) for x in inside):
                j = next((j for j, x in enumerate(outside) if set(x[1]) > set(low[1])), None)
                if j is not None:
                    inside[i], outside[j] = outside[j], low
                    swapped.add(inside[i][0])
        if swapped:
            lift(inside, moved)
        order = {r: k for k, (r, _) in zip(slots, inside + outside, strict=True)}
        at = pdf["at_"]
        return pd.DataFrame({by: pdf[by], "at_": at, "place_": [order[r] for r in at], "promoted": [r in moved for r in at], "exchanged": [r in swapped for r in at]})

    numbered = cut(df.withColumn("at_", F.row_number().over(Window.partitionBy(by).orderBy("rank"))))
    top, rest = numbered.filter(F.col("at_") <= most).select(by, "at_", "members"), numbered.filter(F.col("at_") > most).select(by, "at_", "members")
    low = top.select(by, F.col("at_").alias("low_"), F.col("members").alias("m_"), F.element_at("members", 1).alias("one_")).filter("one_ IS NOT NULL")
    above = rest.select(by, "at_", F.col("members").alias("more_"), F.explode("members").alias("one_")).join(low, [by, "one_"])
    above = above.filter((F.size("more_") > F.size("m_")) & (F.size(F.array_except("m_", "more_")) == 0)).groupBy(by, "low_").agg(F.min("at_").alias("at_"))
    step = top.unionByName(rest.join(above.select(by, "at_").distinct(), [by, "at_"], "left_semi"))
    kind = df.schema[by].dataType.simpleString()
    moves = step.groupBy(by).applyInPandas(run, f"{by} {kind}, at_ int, place_ int, promoted boolean, exchanged boolean")
    out = numbered.join(moves, [by, "at_"], "left").withColumn("place", F.coalesce("place_", "at_"))
    return out.fillna(False, ["promoted", "exchanged"]).drop("at_", "place_")


def epcr(composite_: Column) -> Column:
    return F.round(0.01 + composite_ * 0.99, 4)


def separated(df: DataFrame, by: list[str], value: str = "epcr", order: str = "rank") -> DataFrame:
    """Strictly falling values at least 0.01 apart, with room for the rows below: a running minimum in 1e-4 units."""
    w = Window.partitionBy(*by).orderBy(order)
    i, n = F.row_number().over(w) - 1, F.count(F.lit(1)).over(Window.partitionBy(*by))
    units = F.round(F.col(value) * 10_000).cast("long")
    out = df.withColumn("i_", i).withColumn("n_", n).withColumn("u_", units + 100 * F.col("i_"))
    lowest = F.min("u_").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    floor = 100 + 100 * (F.col("n_") - 1)
    return out.withColumn("separated", (F.greatest(floor, F.least(F.lit(10_000), lowest)) - 100 * F.col("i_")) / 10_000).drop("i_", "n_", "u_")


def open_questions(is_pair: Column, phase: Column, model: Column, af: list[Column], flags: list[Column], clinical: Column, zygosity: list[Column]) -> Column:
    """(question, blocking) of what is not settled about a candidate."""
    one = lambda test, text, block: F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(text).alias("question"), F.lit(block).alias("blocking")))
    found = [one(is_pair & (phase == "unknown"), "phase_unknown", True)]
    found += [one(a.isNull(), "no_population_frequency", True) for a in af]
    found += [one(F.array_contains(f, "low_quality_call"), "low_quality_call", True) for f in flags]
    found += [one(~is_pair & (model == "unknown"), "single_hit_only", True), one(phase == "cis_confirmed", "confirm_cis", False)]
    found += [one(z == "hom_alt", "true_homozygosity", False) for z in zygosity]
    found += [one(~clinical, "no_clinical_curation", False)]
    return F.array_distinct(F.array_compact(F.array(*found)))


def next_test(questions: Column) -> Column:
    """The first matching of a fixed list of follow-ups."""
    has = lambda q: F.exists(questions, lambda x: x["question"] == q)
    rules_ = [
        ("phase_unknown", "segregation or long-read phasing"),
        ("low_quality_call", "orthogonal confirmation of the call"),
        ("no_population_frequency", "frequency lookup in a further cohort"),
        ("single_hit_only", "search for a second hit"),
        ("confirm_cis", "parental segregation"),
        ("true_homozygosity", "dosage or deletion test"),
    ]
    out = F.lit("functional assay")
    for question, test in reversed(rules_):
        out = F.when(has(question), test).otherwise(out)
    return out


def violations(rows: DataFrame, most: int = 10) -> DataFrame:
    """(proband_id, row, rule) for every broken rule of a submission (proband_id, row, key, epcr, members)."""
    w = Window.partitionBy("proband_id").orderBy("row")
    seen = rows.withColumn("last_", F.lag("epcr").over(w)).withColumn("copies_", F.count(F.lit(1)).over(Window.partitionBy("proband_id", "key")))
    tests = [
        ("too_many_rows", F.col("row") > most),
        ("epcr_out_of_range", ~F.col("epcr").between(0.0, 1.0)),
        ("epcr_not_decreasing", F.col("epcr") > F.col("last_")),
        ("epcr_tie", F.col("epcr") == F.col("last_")),
        ("duplicate_row", F.col("copies_") > 1),
        ("no_members", F.size("members") == 0),
    ]
    broken = seen.select("proband_id", "row", F.explode(F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests]))).alias("rule"))
    members = rows.select("proband_id", "row", "members", F.explode("members").alias("member"))
    other = members.select("proband_id", "member", F.col("row").alias("row_l"), F.col("members").alias("members_l"))
    inverted = members.join(other, ["proband_id", "member"]).filter((F.col("row") > F.col("row_l")) & (F.size("members") > F.size("members_l")) & (F.size(F.array_except("members_l", "members")) == 0))
    return broken.union(inverted.select("proband_id", "row", F.lit("superset_below_subset")).distinct())


def score_pairs(pairs: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds phase, model, the component scores, the penalty and the composite to candidates: structs a and b, b empty for a
    single variant. CADD and REVEL count where the members have them; phenotype and mechanism scores of the gene where the
    rows have them (with_gene_scores), else they are neutral and none."""
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    pair = F.col("b").isNotNull()
    same = F.coalesce(a("phase_set") == b("phase_set"), F.lit(False))
    phase = phase_status(same, a("hap_slot"), b("hap_slot"))
    alone = single_model(a("contig"), a("zygosity"), F.array_contains(a("flags"), "possible_mosaic"))
    model = F.when(pair, pair_model(a("contig"), b("contig"), a("zygosity"), b("zygosity"))).otherwise(alone)
    df = pairs.withColumn("phase", phase).withColumn("model", model)
    low = lambda x: F.array_contains(x("flags"), "low_quality_call")
    two = lambda f: F.when(pair, F.least(f(a), f(b))).otherwise(f(a))
    part = lambda t, x: F.when(t(x), 1.0).otherwise(0.0)
    share = lambda t: F.when(pair, (part(t, a) + part(t, b)) / 2).otherwise(part(t, a))
    has = {f.name for f in pairs.schema["a"].dataType.fields}
    scores_of = [c for c in ("splice_ai", "cadd", "revel") if c in has]
    several = lambda x: sum((x(c).isNotNull().cast("int") for c in scores_of), F.lit(0)) >= 2
    extra = lambda x, c: x(c) if c in has else None
    given = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in pairs.columns else F.lit(default)
    df = df.withColumns({
        "validity": two(lambda x: validity_score(x("filter_status"), x("depth"), x("gq"), x("zygosity"), x("fraction"), low(x), config)),
        "rarity": two(lambda x: rarity_score(x("max_af"), config)),
        "consequence": two(lambda x: consequence_score(x("worst_rank"), x("n_consequences") > 0, x("any_lof"), x("splice_ai"), extra(x, "cadd"), extra(x, "revel"))),
        "inheritance": inheritance_score(F.col("model"), pair, F.col("phase"), config),
        "phenotype": given("phenotype", 0.5),
        "mechanism": given("mechanism", 0.0),
        "evidence": evidence_quality(
            share(lambda x: x("max_af").isNotNull()),
            F.when(F.coalesce(a("any_mane"), F.lit(False)) | F.coalesce(b("any_mane"), F.lit(False)), 1.0).when((a("n_consequences") > 0) | F.coalesce(b("n_consequences") > 0, F.lit(False)), 0.5).otherwise(0.0),
            share(several), share(lambda x: x("n_assertions").isNotNull()), F.col("phase") != "unknown", pair),
    })
    found = contradictions(F.col("model"), F.col("phase"), [a("flags"), b("flags")], [a("max_nhomalt"), b("max_nhomalt")], [a("max_af"), b("max_af")], config)
    df = df.withColumn("contradictions", found).withColumn("penalty", penalty(F.col("contradictions")))
    scores = {c: F.col(c) for c in COMPONENTS}
    key = lambda x: F.struct(*[x(c) for c in ORDER])
    return df.withColumns({
        "composite": steady(composite(scores, F.col("penalty"), config)), "key_a": key(a), "key_b": key(b), "pair_id": F.when(pair, pair_id(F.col("gene_key"), a("variant_id"), b("variant_id"))).otherwise(pair_id(F.col("gene_key"), a("variant_id"))),
        "members": F.array_sort(F.array_compact(F.array(a("variant_id"), b("variant_id")))),
        "questions": open_questions(pair, F.col("phase"), F.col("model"), [a("max_af"), F.when(pair, b("max_af")).otherwise(a("max_af"))], [a("flags"), b("flags")], a("n_assertions").isNotNull() | b("n_assertions").isNotNull(), [a("zygosity"), b("zygosity")]),
    })


def with_order(calls: DataFrame) -> DataFrame:
    """Adds the genomic order key and the variant id."""
    return calls.withColumn("contig_order", alleles.contig_order(F.col("contig"))).withColumn("variant_id", alleles.variant_id(F.lit("GRCh38"), F.col("contig"), F.col("position"), F.col("ref"), F.col("alt")))


