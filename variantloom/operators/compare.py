"""Comparison of rankings, evaluation, citations and evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from variantloom.operators.tables import content_id, row_hash


def overlap(submitted: DataFrame, produced: DataFrame, by: str) -> DataFrame:
    """Per group: keys in both, in one only, and a verdict on how the two rankings agree."""
    s, p = submitted.select(by, "key", F.col("rank").alias("rank_s")), produced.select(by, "key", F.col("rank").alias("rank_p"))
    met = s.join(p, [by, "key"], "full_outer").groupBy(by).agg(
        F.count_if(F.col("rank_s").isNotNull() & F.col("rank_p").isNotNull()).alias("n_both"),
        F.count_if(F.col("rank_p").isNull()).alias("n_submitted_only"),
        F.count_if(F.col("rank_s").isNull()).alias("n_produced_only"),
        F.count_if(F.col("rank_s") != F.col("rank_p")).alias("n_moved"),
    )
    only = (F.col("n_submitted_only") > 0) | (F.col("n_produced_only") > 0)
    verdict = F.when(F.col("n_both") == 0, "disjoint").when(only & (F.col("n_moved") > 0), "differs").when(only, "partial").when(F.col("n_moved") > 0, "reordered").otherwise("identical")
    return met.withColumn("verdict", verdict)


def top_k_agreement(submitted: DataFrame, produced: DataFrame, by: str, ks: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """Keys that both rankings have among their first k."""
    both = submitted.select(by, "key", F.col("rank").alias("rank_s")).join(produced.select(by, "key", F.col("rank").alias("rank_p")), [by, "key"])
    cut = both.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks])))
    return cut.groupBy(by, "k").agg(F.count_if((F.col("rank_s") <= F.col("k")) & (F.col("rank_p") <= F.col("k"))).alias("n_agree"))


def spearman(submitted: DataFrame, produced: DataFrame, by: str) -> DataFrame:
    """Rank correlation over common keys, ranks packed again; NULL under two keys."""
    both = submitted.select(by, "key", F.col("rank").alias("rank_s")).join(produced.select(by, "key", F.col("rank").alias("rank_p")), [by, "key"])
    pack = lambda c: F.row_number().over(Window.partitionBy(by).orderBy(c, "key"))
    d = both.withColumn("d2", F.pow(pack("rank_s") - pack("rank_p"), 2))
    g = d.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum("d2").alias("d2"))
    return g.select(by, "n", F.when(F.col("n") >= 2, F.round(1 - 6 * F.col("d2") / (F.col("n") * (F.pow("n", F.lit(2)) - 1)), 6)).alias("rho"))


def rank_points(rank: Column, partial: Column) -> Column:
    """100, 50, 25 or 10 points for a hit among the first 1, 3, 5 or 10; half for a partial hit."""
    points = F.when(rank == 1, 100.0).when(rank <= 3, 50.0).when(rank <= 5, 25.0).when(rank <= 10, 10.0).otherwise(0.0)
    return points * F.when(partial, 0.5).otherwise(1.0)


def f_max(scored: DataFrame, by: str) -> DataFrame:
    """Largest F over all thresholds of rows (score, truth), from running sums instead of a threshold self-join."""
    total = scored.groupBy(by).agg(F.sum(F.col("truth").cast("int")).alias("total"))
    levels = scored.groupBy(by, "score").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("truth").cast("int")).alias("hits"))
    w = Window.partitionBy(by).orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = levels.withColumn("n_", F.sum("n").over(w)).withColumn("hits_", F.sum("hits").over(w)).join(total, by)
    return run.groupBy(by).agg(F.round(F.max(2.0 * F.col("hits_") / (F.col("n_") + F.col("total"))), 6).alias("f_max"))


def letters(text: Column, keep: str = r"\p{L}\p{N}") -> Column:
    """The letters and digits of a text, under a collation that takes no notice of case and accents."""
    return F.collate(F.regexp_replace(text, f"[^{keep}]", ""), "UNICODE_CI_AI")


def same_surname(a: Column, b: Column) -> Column:
    """Equal but for accents, case and marks; an inner hyphen counts."""
    return letters(F.regexp_replace(a, "^-+|-+$", ""), r"\p{L}-") == letters(F.regexp_replace(b, "^-+|-+$", ""), r"\p{L}-")


def same_text(a: Column, b: Column) -> Column:
    """Titles and journals that are set differently, but say the same."""
    return letters(a) == letters(b)


def citation_mismatches(written: DataFrame, ledger: DataFrame, alike: bool = False) -> DataFrame:
    """Differences between citations as written and the ledger (pmid, author, year, journal, title), both ways.

    With `alike`, names, journals and titles are the same if they differ only in how they are set.
    """
    fields = ["author", "year", "journal", "title"]
    w, k = written.select("pmid", *[F.col(f).alias(f"w_{f}") for f in fields], F.lit(True).alias("in_w")), ledger.select("pmid", *[F.col(f).alias(f"k_{f}") for f in fields], F.lit(True).alias("in_k"))
    met = w.join(k, "pmid", "full_outer")
    both = F.col("in_w").isNotNull() & F.col("in_k").isNotNull()
    rule = {"author": same_surname, "journal": same_text, "title": same_text} if alike else {}
    equal = {f: rule.get(f, lambda a, b: a == b)(F.col(f"w_{f}"), F.col(f"k_{f}")) for f in fields}
    kinds = [F.when(F.col("in_k").isNull(), "not_in_ledger"), F.when(F.col("in_w").isNull(), "never_written")]
    kinds += [F.when(both & ~equal[f], f"{f}_differs") for f in fields]
    return met.select("pmid", F.explode(F.array_compact(F.array(*kinds))).alias("kind"))


def evidence(df: DataFrame, subject: Column, kind: str, category: str, direction: Column, strength: Column, claim: Column, value: Column, payload: Column, tool: str = "variantloom") -> DataFrame:
    """Evidence rows of one kind, with content-derived ids."""
    rows = df.select(subject.cast("string").alias("subject_id"), F.lit(kind).alias("subject_kind"), claim.alias("claim"), F.lit(category).alias("category"), direction.alias("direction"), strength.alias("strength"), value.cast("double").alias("numeric_value"), payload.alias("payload"), F.lit(tool).alias("tool"))
    return rows.withColumn("evidence_id", content_id(F.col("category"), F.col("subject_id"), F.col("claim"), F.col("direction"), F.col("strength"), F.col("numeric_value")))


def deduplicated(items: DataFrame) -> DataFrame:
    """One row per evidence id; the same id with other content raises an error. One aggregation finds both."""
    rest = [c for c in items.columns if c != "evidence_id"]
    marked = items.withColumn("h_", row_hash(items, rest))
    once = marked.groupBy("evidence_id").agg(F.min("h_").alias("lo_"), F.max("h_").alias("hi_"), F.first(F.struct(*rest)).alias("x_"))
    same = F.when(F.col("lo_") == F.col("hi_"), F.col("evidence_id")).otherwise(F.raise_error(F.concat(F.lit("two contents under "), F.col("evidence_id"))))
    return once.select("x_.*", same.alias("evidence_id")).select(items.columns)


def evidence_invariants() -> dict[str, Column]:
    """Checks of evidence rows (tier, citation_version, basis, numeric_value), by name."""
    return {
        "database_without_version": (F.col("tier") != "database") | F.col("citation_version").isNotNull(),
        "observed_without_value": (F.col("basis") != "observed") | F.col("numeric_value").isNotNull(),
    }


def balance(items: DataFrame) -> DataFrame:
    """subject_id, n_for, n_against: how many items support and contradict each subject."""
    return items.groupBy("subject_id").agg(F.count_if(F.col("direction") == "supports").alias("n_for"), F.count_if(F.col("direction") == "contradicts").alias("n_against"))


def unresolved(claims: DataFrame, items: DataFrame) -> DataFrame:
    """Cited evidence ids that are not in the ledger."""
    return claims.select("claim_id", F.explode("evidence_ids").alias("evidence_id")).join(items.select("evidence_id"), "evidence_id", "left_anti")


def claim_status(claims: DataFrame, items: DataFrame) -> DataFrame:
    """Per claim: contradicted by any, unproven if nothing supports it, and its weakest strength."""
    order = F.element_at(F.create_map(*[F.lit(x) for p in (("strong", 1), ("moderate", 2), ("supporting", 3), ("weak", 4), ("insufficient", 5)) for x in p]), F.col("strength"))
    met = claims.select("claim_id", F.explode("evidence_ids").alias("evidence_id")).join(items, "evidence_id")
    return met.groupBy("claim_id").agg(F.bool_or(F.col("direction") == "contradicts").alias("contradicted"), (~F.bool_or(F.col("direction") == "supports")).alias("unproven"), F.max_by("strength", order).alias("weakest"))


def edges(pairs: DataFrame) -> DataFrame:
    """subject-predicate-object rows of candidate pairs (pair_id, gene_key, members); ids are hashes of the triple."""
    gene = pairs.select(F.col("pair_id").alias("subject_id"), F.lit("candidate_pair").alias("subject_kind"), F.lit("in_gene").alias("predicate"), F.col("gene_key").cast("string").alias("object_id"), F.lit("gene").alias("object_kind"))
    member = pairs.select(F.col("pair_id").alias("subject_id"), F.lit("candidate_pair").alias("subject_kind"), F.lit("has_member").alias("predicate"), F.explode("members").alias("object_id"), F.lit("variant").alias("object_kind"))
    return edge_rows(gene.unionByName(member))


def mechanism_edges(mechanisms: DataFrame) -> DataFrame:
    """From each gene to its mechanism (gene_key, mechanism_id)."""
    return edge_rows(mechanisms.select(F.col("gene_key").cast("string").alias("subject_id"), F.lit("gene").alias("subject_kind"), F.lit("has_mechanism").alias("predicate"), F.col("mechanism_id").cast("string").alias("object_id"), F.lit("mechanism").alias("object_kind")))


def drug_edges(triaged: DataFrame) -> DataFrame:
    """From each triaged agent to the mechanism that it targets or was rejected for."""
    predicate = F.when(F.col("rejected"), "rejected_for_mechanism").otherwise("targets_mechanism")
    return edge_rows(triaged.select(F.col("drug_id").cast("string").alias("subject_id"), F.lit("drug").alias("subject_kind"), predicate.alias("predicate"), F.col("mechanism_id").cast("string").alias("object_id"), F.lit("mechanism").alias("object_kind")))


def edge_rows(rows: DataFrame) -> DataFrame:
    """Distinct triples with their ids."""
    rows = rows.distinct()
    return rows.withColumn("edge_id", F.substring(F.sha2(F.concat_ws("\x1f", "subject_id", "predicate", "object_id"), 256), 1, 16))


def normalised_title(text: Column) -> Column:
    plain = F.translate(F.lower(text), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
    return F.regexp_replace(plain, "[^a-z0-9]", "")
