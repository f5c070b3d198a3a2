"""Lookups that find an indel under any of its equivalent spellings, and say where they could not.

An indel in a repeat can be written at every place of the repeat. The caller's rows are few and a sites table is large, so only the
calls are compared with the reference: each gets the window from its left-most to its right-most place. A site in the window is the same
allele if it has the spelling that the call would have there; the sites need neither a reference nor a rewrite of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.functions import alleles
from variantloom.operators.annotate import binned
from variantloom.operators.stages import AHEAD, BLOCK, with_flank

CAP = 1_000


def with_tail(calls: DataFrame, blocks: DataFrame) -> DataFrame:
    """Adds `tail`: the reference bases after the REF allele that its block and the next one hold."""
    b = blocks.withColumnsRenamed({"contig": "contig_", "seq": "seq_", "block": "at_"})
    own = F.floor((F.col("position") - 1) / BLOCK).cast("long")
    joined = calls.withColumn("block_", own).join(b, (F.col("contig") == F.col("contig_")) & (F.col("block_") == F.col("at_")), "left")
    after = (F.col("position") - 1) % BLOCK + F.length("ref") + 1
    return joined.withColumn("tail", F.substring("seq_", after.cast("int"), F.lit(BLOCK + AHEAD))).drop("block_", "contig_", "at_", "seq_")


def windowed(calls: DataFrame, blocks: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds `first`, `last`, `unit` and `representation` to calls whose alleles are trimmed.

    first and last are the left-most and right-most place of an indel (of other calls, their own place), unit its inserted or deleted bases as
    written at `first`. representation: not_required (no indel), applied, shift_limit (a repeat longer than the cap, the window ends early),
    reference_unusable (REF is not what the reference has) or no_reference; in the last two the window is the own place.
    """
    indel = (F.least(F.length("ref"), F.length("alt")) == 1) & (F.length("ref") != F.length("alt")) & (F.substring("ref", 1, 1) == F.substring("alt", 1, 1))
    df = with_tail(with_flank(calls, blocks, cap), blocks)
    matches = alleles.reference_matches(F.col("ref_seen"), F.col("ref"))
    usable = indel & F.coalesce(matches, F.lit(False))
    left = F.when(usable, alleles.left_shift(F.col("flank"), F.col("ref"), F.col("alt"), F.col("position"), cap)).otherwise(0)
    right = F.when(usable, alleles.right_shift(F.col("tail"), F.col("ref"), F.col("alt"), cap)).otherwise(0)
    df = df.withColumns({"left_": left, "right_": right, "usable_": usable, "matches_": matches})
    own = F.when(F.length("ref") > F.length("alt"), F.col("ref")).otherwise(F.col("alt"))
    unit = F.when(indel, F.substring(own, F.lit(2), F.length(own)))
    # a base is turned from the unit's end to its begin for each place that the indel moves left
    unit = turned(unit, -F.col("left_"))
    state = (
        F.when(~indel, "not_required").when(F.col("matches_").isNull(), "no_reference").when(~F.col("matches_"), "reference_unusable")
        .when((F.col("left_") >= cap) | (F.col("right_") >= cap), "shift_limit").otherwise("applied")
    )
    out = df.withColumns({"first": F.col("position") - F.col("left_"), "last": F.col("position") + F.col("right_"), "unit": unit, "representation": state})
    return out.drop("flank", "tail", "ref_seen", "left_", "right_", "usable_", "matches_")


def turned(unit: Column, n: Column) -> Column:
    """A unit as it is written n places further to the right (to the left, if n is below zero)."""
    k = F.pmod(n, F.greatest(F.length(unit), F.lit(1))).cast("int")
    return F.concat(F.substring(unit, k + 1, F.length(unit)), F.substring(unit, F.lit(1), k))


def equivalent_lookup(windows: DataFrame, sites: DataFrame, key: str) -> DataFrame:
    """`key` of windows with what sites (contig, position, ref, alt, ...) say about them, and how they were found.

    found: exact, shifted, absent, or unreconciled: absent, but the spellings could not all be compared, which is no evidence of absence.
    An equi-join on bins of the contig with the window and the spelling as residue.
    """
    s = sites.withColumnsRenamed({c: f"s_{c}" for c in ("contig", "position", "ref", "alt")})
    met = binned(windows, "contig", F.col("first"), F.col("last")).withColumnRenamed("bin_", "b_").join(
        binned(s, "s_contig", F.col("s_position"), F.col("s_position")), (F.col("contig") == F.col("s_contig")) & (F.col("b_") == F.col("bin_")) & F.col("s_position").between(F.col("first"), F.col("last"))
    )
    exact = (F.col("s_position") == F.col("position")) & (F.col("s_ref") == F.col("ref")) & (F.col("s_alt") == F.col("alt"))
    spelled = turned(F.col("unit"), F.col("s_position") - F.col("first"))
    longer, shorter = (F.when(F.length("s_ref") > F.length("s_alt"), F.col(a)).otherwise(F.col(b)) for a, b in (("s_ref", "s_alt"), ("s_alt", "s_ref")))
    same_kind = (F.length("s_ref") > F.length("s_alt")) == (F.length("ref") > F.length("alt"))
    moved = F.col("representation").isin("applied", "shift_limit") & same_kind & (F.length(shorter) == 1) & (F.substring(longer, F.lit(2), F.length(longer)) == spelled) & (F.substring(longer, 1, 1) == shorter)
    rest = [c for c in sites.columns if c not in ("contig", "position", "ref", "alt")]
    hits = met.withColumn("found", F.when(exact, "exact").when(moved, "shifted")).filter("found IS NOT NULL").select(key, "found", F.col("s_position").alias("site_position"), *rest)
    out = windows.select(key, "representation").join(hits, key, "left")
    return out.withColumn("found", F.coalesce("found", F.when(F.col("representation").isin("applied", "not_required"), "absent").otherwise("unreconciled")))


def representation_report(windows: DataFrame) -> DataFrame:
    """Calls by status, and one status for all: degraded if any indel could not be compared under all its spellings."""
    g = windows.groupBy("representation").agg(F.count(F.lit(1)).alias("n"))
    whole = windows.agg(F.count_if(F.col("representation").isin("no_reference", "reference_unusable", "shift_limit")).alias("bad"), F.count_if(F.col("representation") == "applied").alias("good"))
    status = F.when(F.col("bad") > 0, "degraded").when(F.col("good") > 0, "applied").otherwise("not_required")
    return g.unionByName(whole.select(F.concat(F.lit("all: "), status).alias("representation"), (F.col("bad") + F.col("good")).alias("n")))
