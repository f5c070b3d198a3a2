"""Ontology closure, profile propagation, information content, similarity and gene phenotype scores."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.functions import rules
from variantloom.operators.tables import cut, discarded


@dataclass(frozen=True)
class Ontology:
    """Terms, edges and the materialised closure, as tables."""

    edges: DataFrame  # child, parent
    closure: DataFrame  # term, ancestor

    @classmethod
    def of(cls, edges: DataFrame) -> Ontology:
        return cls(edges, ancestor_closure(edges))


def ancestor_closure(edges: DataFrame, most_rounds: int = 64, most_waves: int = 32) -> DataFrame:
    """term, ancestor: reflexive and transitive.

    Waves come first: what is k + 1 edges above a term is what is k edges above its parents, one array for each term, so each round
    sends an array over each edge and nothing is found from more than its parents. An ontology deeper than `most_waves` (or with a cycle) goes on
    from what these found with paths that double in length every round, so its rounds are the logarithm of the depth.
    """
    edges = cut(edges.select("child", "parent").distinct())
    terms = edges.selectExpr("child AS term").union(edges.selectExpr("parent AS term")).distinct()
    waves = [cut(terms.selectExpr("term", "array(term) AS above"))]
    while len(waves) <= most_waves:
        met = edges.join(waves[-1], F.col("parent").eqNullSafe(F.col("term"))).groupBy("child").agg(F.array_distinct(F.flatten(F.collect_list("above"))).alias("above"))
        waves.append(cut(met.withColumnRenamed("child", "term")))
        if waves[-1].isEmpty():
            break
    every = reduce(DataFrame.unionByName, waves).groupBy("term").agg(F.array_distinct(F.flatten(F.collect_list("above"))).alias("above"))
    pairs = cut(every.select("term", F.explode("above").alias("ancestor")))
    deeper = not waves[-1].isEmpty()
    discarded(edges, *waves)
    return doubled(pairs, most_rounds) if deeper else pairs


def doubled(pairs: DataFrame, most_rounds: int) -> DataFrame:
    """term, ancestor: the transitive closure of reflexive pairs. Paths double in length every round and duplicates go at once; each round is
    written out, as it is read twice by the next."""
    size = pairs.count()
    for _ in range(most_rounds):
        step = pairs.alias("x").join(pairs.alias("y"), F.col("x.ancestor") == F.col("y.term")).select(F.col("x.term"), F.col("y.ancestor"))
        last, pairs = pairs, cut(step.distinct())
        discarded(last)
        now = pairs.count()
        if now == size:
            return pairs
        size = now
    raise RuntimeError("the ontology has a cycle or is deeper than 2**64")


def resolved(ids: DataFrame, terms: DataFrame, aliases: DataFrame, most_rounds: int = 32) -> DataFrame:
    """id and the primary term that it stands for: itself, or what its aliases (id, target) lead to; NULL if nothing.

    A live term stands for itself; others follow their aliases to the end. Chains double in length every round, so the
    rounds are the logarithm of the longest one; a chain that runs in a circle leads nowhere.
    """
    known = terms.select(F.col("term").alias("t_")).distinct()
    hops = cut(aliases.join(known, aliases.id == F.col("t_"), "left_anti").groupBy("id").agg(F.min("target").alias("target")))
    for _ in range(most_rounds):
        on = hops.select(F.col("id").alias("id_"), F.col("target").alias("next_"))
        hops = cut(hops.join(on, F.col("target") == F.col("id_"), "left").select("id", F.coalesce("next_", "target").alias("target"), (F.col("next_").isNotNull() & (F.col("next_") != F.col("target"))).alias("moved_")))
        if hops.filter("moved_").isEmpty():
            break
        hops = hops.drop("moved_")
    ends = hops.select(F.col("id").alias("a_"), "target")
    met = ids.join(ends, ids.id == F.col("a_"), "left").withColumn("last_", F.coalesce("target", "id"))
    return met.join(known, F.col("last_") == F.col("t_"), "left").select("id", F.col("t_").alias("term"))


def reconciled(profile: DataFrame) -> DataFrame:
    """One status per (subject, term): equal records agree; observed and excluded give uncertain; else the informative one."""
    seen = profile.groupBy("subject_id", "term").agg(F.collect_set("status").alias("s"))
    has = lambda x: F.array_contains("s", x)
    status = (
        F.when(has("observed") & has("excluded"), "uncertain").when(has("observed"), "observed").when(has("excluded"), "excluded").when(has("uncertain"), "uncertain").otherwise("not_assessed")
    )
    return seen.select("subject_id", "term", status.alias("status"))


def propagated(profile: DataFrame, closure: DataFrame) -> DataFrame:
    """subject_id, term, status, origin. Observed terms imply their ancestors, excluded terms their descendants; what
    was recorded goes before what is implied, and observed before excluded."""
    up = profile.filter("status = 'observed'").join(closure, "term").select("subject_id", F.col("ancestor").alias("term"), F.lit("observed").alias("status"), F.when(F.col("ancestor") == F.col("term"), 0).otherwise(1).alias("place"))
    down = profile.filter("status = 'excluded'").join(closure.select(F.col("ancestor").alias("term"), F.col("term").alias("below")), "term")
    down = down.select("subject_id", F.col("below").alias("term"), F.lit("excluded").alias("status"), F.when(F.col("below") == F.col("term"), 0).otherwise(2).alias("place"))
    rest = profile.filter("status NOT IN ('observed', 'excluded')").select("subject_id", "term", "status", F.lit(3).alias("place"))
    best = up.union(down).union(rest).groupBy("subject_id", "term").agg(F.min_by("status", F.struct("place", "status")).alias("status"), F.min("place").alias("place"))
    return best.withColumn("origin", F.when(F.col("place").isin(0, 3), "recorded").otherwise("implied")).drop("place")


def conflicts(profile: DataFrame, closure: DataFrame) -> DataFrame:
    """Terms that are both an ancestor of something observed and a descendant of something excluded."""
    up = profile.filter("status = 'observed'").join(closure, "term").select("subject_id", F.col("ancestor").alias("term"))
    down = profile.filter("status = 'excluded'").join(closure.select(F.col("ancestor").alias("term"), F.col("term").alias("below")), "term").select("subject_id", F.col("below").alias("term"))
    return up.intersect(down)


def raised_counts(corpus: DataFrame, edges: DataFrame, most_waves: int = 32) -> DataFrame | None:
    """term, n_entities: the distinct entities (entity, term) of each term and of all below it; None if the ontology is deeper than `most_waves`.

    Entities rise by one edge a round and are made distinct at once, so the many terms below an ancestor send it each entity once for each of its
    children, not once for each term.
    """
    edges = cut(edges.select("child", "parent").distinct())
    terms = edges.selectExpr("child AS term").union(edges.selectExpr("parent AS term")).distinct()
    waves = [cut(corpus.select("entity", "term").distinct().join(terms, "term", "left_semi"))]
    while len(waves) <= most_waves and not waves[-1].isEmpty():
        waves.append(cut(waves[-1].join(edges, F.col("term") == F.col("child")).select("entity", F.col("parent").alias("term")).distinct()))
    whole = waves[-1].isEmpty()
    counts = cut(reduce(DataFrame.unionByName, waves).groupBy("term").agg(F.countDistinct("entity").alias("n_entities"))) if whole else None
    discarded(edges, *waves)
    return counts


def information_content(corpus: DataFrame, closure: DataFrame | None, edges: DataFrame | None = None) -> DataFrame:
    """term, n_entities, ic: entities annotated with a term also have its ancestors; ic = -ln(share). By the edges if they are given, else by the closure."""
    total = corpus.agg(F.countDistinct("entity").alias("total"))
    counts = None if edges is None else raised_counts(corpus, edges)
    if counts is None:
        above = ancestor_closure(edges) if closure is None else closure
        counts = corpus.join(above, "term").groupBy(F.col("ancestor").alias("term")).agg(F.countDistinct("entity").alias("n_entities"))
    return counts.crossJoin(F.broadcast(total)).select("term", "n_entities", (-F.log(F.col("n_entities") / F.col("total"))).alias("ic"))


def similarity(pairs: DataFrame, closure: DataFrame, ic: DataFrame) -> DataFrame:
    """a, b, mica, resnik, lin, jc of term pairs (a, b). The most informative common ancestor breaks ties by the lowest id."""
    up = closure.join(ic.select(F.col("term").alias("ancestor"), "ic"), "ancestor")
    common = pairs.join(up.select(F.col("term").alias("a"), "ancestor", "ic"), "a").join(closure.select(F.col("term").alias("b"), "ancestor"), ["b", "ancestor"])
    best = common.groupBy("a", "b").agg(F.min(F.struct((-F.col("ic")).alias("neg"), "ancestor")).alias("m"))
    most = ic.agg(F.max("ic").alias("most"))
    own = best.join(ic.select(F.col("term").alias("a"), F.col("ic").alias("ic_a")), "a", "left").join(ic.select(F.col("term").alias("b"), F.col("ic").alias("ic_b")), "b", "left").crossJoin(F.broadcast(most))
    mica = -F.col("m.neg")
    both = F.col("ic_a") + F.col("ic_b")
    same = F.col("a") == F.col("b")
    return own.select(
        "a", "b", F.col("m.ancestor").alias("mica"),
        F.when(same, 1.0).when(F.col("most") > 0, mica / F.col("most")).alias("resnik"),
        F.when(same, 1.0).when(both > 0, 2 * mica / both).when(both.isNotNull(), 0.0).alias("lin"),
        F.when(same, 1.0).otherwise(1 / (1 + F.greatest(F.lit(0.0), both - 2 * mica))).alias("jc"),
    )


def best_matches(queries: DataFrame, targets: DataFrame, sims: DataFrame, measure: str = "lin") -> DataFrame:
    """For each (subject, group, query term) with any comparable target: the best one, the lowest id on ties. Terms meet
    through the similarities that are known (a, b), never all against all. queries: subject_id, a; targets: group_id, b."""
    met = queries.join(sims.select("a", "b", F.col(measure).alias("sim")).filter("sim IS NOT NULL"), "a").join(targets, "b")
    best = met.groupBy("subject_id", "group_id", "a").agg(F.min(F.struct((-F.col("sim")).alias("neg"), "b")).alias("m"))
    return best.select("subject_id", "group_id", "a", (-F.col("m.neg")).alias("sim"), F.col("m.b").alias("match"))


def best_match_average(matches: DataFrame) -> DataFrame:
    """Mean over comparable queries; NULL if none is."""
    return matches.groupBy("subject_id", "group_id").agg(F.avg("sim").alias("bma"))


def root_sets(closure: DataFrame) -> DataFrame:
    """term, roots: the roots above each term; an ontology has few."""
    roots = closure.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select(F.col("term").alias("ancestor"))
    return closure.join(roots, "ancestor").groupBy("term").agg(F.array_sort(F.collect_set("ancestor")).alias("roots"))


def informed_similarity(a_terms: DataFrame, b_terms: DataFrame, closure: DataFrame, ic: DataFrame) -> DataFrame:
    """a, b, sim (Lin) of all pairs of terms (a), (b) whose similarity is above zero.

    Terms meet only at ancestors that carry information. All terms are below a root, which carries none, so without this every pair would meet
    there; pairs that meet nowhere else have similarity zero, which needs no row.
    """
    up = closure.join(ic.select(F.col("term").alias("ancestor"), "ic").filter("ic > 0"), "ancestor")
    side = lambda terms, c: terms.select(c).distinct().join(up.withColumnRenamed("term", c), c)
    met = side(a_terms, "a").select("a", "ancestor", "ic").join(side(b_terms, "b").select("b", "ancestor"), "ancestor").groupBy("a", "b").agg(F.max("ic").alias("mica"))
    own = lambda c: ic.select(F.col("term").alias(c), F.col("ic").alias(f"ic_{c}"))
    sims = met.join(own("a"), "a").join(own("b"), "b").select("a", "b", (2 * F.col("mica") / (F.col("ic_a") + F.col("ic_b"))).alias("sim"))
    # a term is like itself even if it carries no information, as long as something above it was counted
    counted = closure.join(ic.select(F.col("term").alias("ancestor")), "ancestor").select(F.col("term").alias("a")).distinct()
    same = a_terms.select("a").distinct().join(b_terms.select(F.col("b").alias("a")).distinct(), "a").join(counted, "a").select("a", F.col("a").alias("b"), F.lit(1.0).alias("sim"))
    return sims.filter("a <> b").union(same)


def informed_average(queries: DataFrame, targets: DataFrame, sims: DataFrame, closure: DataFrame, ic: DataFrame) -> DataFrame:
    """subject_id, group_id, bma: mean over the queries (subject_id, a) that can be compared with any target (group_id, b).

    A query's best match is taken once for all subjects that have it. Comparable queries without a match count as zero; they are counted by sets of roots,
    of which there are few, instead of being paired with the targets.
    """
    best = sims.join(targets, "b").groupBy("a", "group_id").agg(F.max("sim").alias("sim"))
    known = ic.select(F.col("term").alias("a"), F.lit(True).alias("known"))
    met = queries.join(best, "a").join(known, "a", "left").groupBy("subject_id", "group_id").agg(F.sum("sim").alias("sum_"), F.count_if(F.col("known").isNull()).alias("bare_"))
    sets = root_sets(closure).join(ic.select("term"), "term")
    of_subjects = queries.join(sets.select(F.col("term").alias("a"), "roots"), "a").groupBy("subject_id", "roots").agg(F.count(F.lit(1)).alias("n_"))
    of_groups = targets.join(sets.select(F.col("term").alias("b"), "roots"), "b").select("group_id", F.explode("roots").alias("root")).distinct()
    # a root set meets a group once, however many roots they share
    shared = of_subjects.select("roots").distinct().withColumn("root", F.explode("roots")).join(of_groups, "root").select("roots", "group_id").distinct()
    comparable = of_subjects.join(shared, "roots").groupBy("subject_id", "group_id").agg(F.sum("n_").alias("n_"))
    both = comparable.join(met, ["subject_id", "group_id"], "full_outer").fillna(0, ["n_", "sum_", "bare_"])
    return both.select("subject_id", "group_id", (F.col("sum_") / (F.col("n_") + F.col("bare_"))).alias("bma"))


def symmetric_average(forward: DataFrame, backward: DataFrame) -> DataFrame:
    """Mean of both one-sided averages (subject_id, group_id, bma); where one side is unknown, the other."""
    both = forward.withColumnRenamed("bma", "f_").join(backward.withColumnRenamed("bma", "b_"), ["subject_id", "group_id"], "full_outer")
    return both.select("subject_id", "group_id", F.coalesce((F.col("f_") + F.col("b_")) / 2, "f_", "b_").alias("bma"))


def partitioned(genes: DataFrame, profile: DataFrame, wanted: DataFrame) -> DataFrame:
    """gene_key, subject_id, term, weight, status of the terms of wanted (gene_key, subject_id); missing is not assessed."""
    rows = wanted.join(genes, "gene_key").join(profile, ["subject_id", "term"], "left")
    return rows.withColumn("status", F.coalesce("status", F.lit("not_assessed")))


def every_gene(genes: DataFrame, profile: DataFrame) -> DataFrame:
    """gene_key, subject_id: what is scored if nothing narrower is asked for, one row for each row of the result."""
    return genes.select("gene_key").distinct().crossJoin(profile.select("subject_id").distinct())


def unexplained(genes: DataFrame, profile: DataFrame) -> DataFrame:
    """Observed terms that no gene in the table has."""
    return profile.filter("status = 'observed'").join(genes.select("term").distinct(), "term", "left_anti")


def exact_scores(genes: DataFrame, profile: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """gene_key, subject_id, score and its parts, one row for each of wanted (gene_key, subject_id; all if not given).
    Sums run over terms that are in both tables (an equi-join), and genes without any informative term are neutral."""
    wanted = every_gene(genes, profile) if wanted is None else wanted
    seen = profile.groupBy("subject_id").agg(F.count_if(F.col("status") == "observed").alias("n_observed"))
    met = genes.join(profile, "term").groupBy("gene_key", "subject_id").agg(
        F.sum(F.when(F.col("status") == "observed", F.col("weight")).otherwise(0.0)).alias("matched"),
        F.sum(F.when(F.col("status") == "excluded", F.col("weight")).otherwise(0.0)).alias("contradicted"),
        F.count_if(F.col("status") == "observed").alias("n_matched"),
        F.count_if(F.col("status").isin("observed", "excluded")).alias("n_informative"),
    )
    rows = wanted.join(met, ["gene_key", "subject_id"], "left").join(seen, "subject_id", "left").fillna(0, ["matched", "contradicted", "n_matched", "n_informative", "n_observed"])
    total = F.col("matched") + F.col("contradicted")
    spec = F.when(total > 0, F.col("matched") / total)
    coverage = F.when(F.col("n_observed") > 0, F.col("n_matched") / F.col("n_observed")).otherwise(0.5)
    score = F.when((F.col("n_informative") == 0) | spec.isNull(), 0.5).otherwise(F.round(0.5 * spec + 0.5 * coverage, 6))
    return rows.select("gene_key", "subject_id", "matched", "contradicted", "n_matched", "n_observed", score.alias("score"))


def ontology_scores(genes: DataFrame, profile: DataFrame, closure: DataFrame, ic: DataFrame, wanted: DataFrame | None = None, symmetric: bool = False) -> DataFrame:
    """As exact_scores, with weights times normalised information content, statuses from the propagated profile, and
    coverage as the best-match average of observed terms (of both sides if `symmetric`). Unknown parts count 0.5."""
    wanted = every_gene(genes, profile) if wanted is None else wanted
    most = ic.agg(F.max("ic").alias("most"))
    scaled = genes.join(ic, "term", "left").crossJoin(F.broadcast(most)).select("gene_key", "term", F.when(F.col("most") > 0, F.coalesce(F.col("ic") / F.col("most"), F.lit(1.0))).otherwise(1.0).alias("scale"), "weight")
    scaled = scaled.select("gene_key", "term", (F.col("weight") * F.col("scale")).alias("weight"))
    met = scaled.join(propagated(profile, closure), "term").groupBy("gene_key", "subject_id").agg(
        F.sum(F.when(F.col("status") == "observed", F.col("weight")).otherwise(0.0)).alias("matched"), F.sum(F.when(F.col("status") == "excluded", F.col("weight")).otherwise(0.0)).alias("contradicted")
    )
    queries = profile.filter("status = 'observed'").select("subject_id", F.col("term").alias("a"))
    targets = genes.select(F.col("gene_key").alias("group_id"), F.col("term").alias("b"))
    sims = informed_similarity(queries, targets, closure, ic)
    best = informed_average(queries, targets, sims, closure, ic)
    if symmetric:
        swapped = informed_average(targets.select(F.col("group_id").alias("subject_id"), F.col("b").alias("a")), queries.select(F.col("subject_id").alias("group_id"), F.col("a").alias("b")), sims.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"), closure, ic)
        best = symmetric_average(best, swapped.select(F.col("group_id").alias("subject_id"), F.col("subject_id").alias("group_id"), "bma"))
    best = best.select(F.col("group_id").alias("gene_key"), "subject_id", F.col("bma").alias("coverage"))
    total = F.col("matched") + F.col("contradicted")
    spec = F.coalesce(F.when(total > 0, F.col("matched") / total), F.lit(0.5))
    return wanted.join(met, ["gene_key", "subject_id"], "left").join(best, ["gene_key", "subject_id"], "left").select("gene_key", "subject_id", F.round(0.5 * spec + 0.5 * F.coalesce("coverage", F.lit(0.5)), 6).alias("score"))


def band(score: Column) -> Column:
    return F.when(score >= 0.85, "strong").when(score >= 0.65, "moderate").when(score >= 0.40, "supporting").otherwise("weak")


def genes_for_term(genes: DataFrame) -> DataFrame:
    return genes.groupBy("term").agg(F.array_sort(F.collect_set("gene_key")).alias("genes"))


def summary(profile: DataFrame, closure: DataFrame) -> DataFrame:
    """Counts of recorded and implied statuses per subject."""
    return propagated(profile, closure).groupBy("subject_id", "status", "origin").agg(F.count(F.lit(1)).alias("n"))


def status_token(raw: Column) -> Column:
    """Canonical status of a token; NULL if it is unknown."""
    token = F.regexp_replace(F.lower(F.trim(raw)), r"[\s/-]+", "_")
    return rules.mapped({x: k for k, xs in STATUS.items() for x in xs}, token)


# Accepted status tokens.
STATUS = {
    "observed": ["observed", "present", "positive", "affected", "yes"],
    "excluded": ["excluded", "absent", "negated", "negative", "no", "not_present", "not_observed", "ruled_out", "denied"],
    "uncertain": ["uncertain", "equivocal", "unclear", "questionable", "borderline", "possible", "probable", "suspected"],
    "not_assessed": ["not_assessed", "unassessed", "not_evaluated", "not_examined", "no_information", "unknown", "missing", "na", "n_a", "nd"],
}


# Onset classes.
ONSETS = ["antenatal", "congenital", "neonatal", "infantile", "childhood", "juvenile", "adult", "unknown"]


def onset_token(raw: Column) -> Column:
    """Canonical onset of a token; unknown where nothing is written, NULL if it is no onset."""
    token = F.regexp_replace(F.regexp_replace(F.lower(F.trim(raw)), r"[\s/.-]+", "_"), "_onset$", "")
    return F.when(F.coalesce(F.trim(raw), F.lit("")) == "", "unknown").when(token.isin(ONSETS), token)

