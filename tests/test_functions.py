"""Column functions against plain Python on random and hand-made rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from variantloom.config import Config, Selection, Triage, Weights, widened
from variantloom.functions import alleles, rules
from variantloom.operators import pairs


def trim(pos, ref, alt):
    while min(len(ref), len(alt)) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    while min(len(ref), len(alt)) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


def shift(genome, pos, ref, alt):
    """Move an anchored indel left one base at a time; positions count from 1."""
    while pos > 1 and len(ref) != len(alt):
        longer = max(ref, alt, key=len)
        if genome[pos - 1] != longer[-1]:
            break
        unit = longer[-1] + longer[1:-1]
        pos -= 1
        anchor = genome[pos - 1]
        ref, alt = (anchor + unit, anchor) if len(ref) > len(alt) else (anchor, anchor + unit)
    return pos, ref, alt


def test_trim(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(1, 99), "".join(rng.choices("AC", k=rng.randrange(1, 7))), "".join(rng.choices("AC", k=rng.randrange(1, 7)))) for _ in range(400)]
    df = spark.createDataFrame(rows, "pos long, ref string, alt string")
    t = alleles.trimmed(F.col("pos"), F.col("ref"), F.col("alt"))
    for r in df.withColumn("t", t).collect():
        assert tuple(r.t) == trim(r.pos, r.ref, r.alt)


def test_left_alignment(spark):
    rng = random.Random(6)
    genome = "".join(rng.choices("AC", k=60))
    rows = []
    for _ in range(400):
        pos = rng.randrange(2, 50)
        size = rng.randrange(1, 4)
        ref, alt = (genome[pos - 1 : pos + size], genome[pos - 1]) if rng.random() < 0.5 else (genome[pos - 1], genome[pos - 1] + "".join(rng.choices("AC", k=size)))
        rows.append((pos, ref, alt, genome[:pos]))
    df = spark.createDataFrame(rows, "pos long, ref string, alt string, flank string")
    out = df.withColumn("t", alleles.left_aligned(F.col("flank"), F.col("pos"), F.col("ref"), F.col("alt"))).collect()
    for r in out:
        assert (r.t.position, r.t.ref, r.t.alt) == shift(genome, r.pos, r.ref, r.alt), r


def test_genotypes(spark):
    rows = [("0/1", "1"), ("1|0", "1"), ("1/1", "1"), ("1/2", "2"), ("0/0", "1"), ("./.", "1"), (None, "1"), ("1", "1"), ("0", "1")]
    df = spark.createDataFrame(rows, "gt string, a string").select(alleles.zygosity(F.col("gt"), F.col("a")).alias("z"))
    assert [r.z for r in df.collect()] == ["het", "het", "hom_alt", "het", "hom_ref", "unknown", "unknown", "hemi", "hom_ref"]
    d = spark.createDataFrame([("2,21,20", None, 2, 3), ("1,2", "9", 1, 3), (None, "7", 1, 2)], "ad string, dp string, i int, n int").select(alleles.allele_depths(F.col("ad"), F.col("dp"), F.col("i"), F.col("n")).alias("d")).collect()
    assert [tuple(r.d) for r in d] == [(43, 2, 20), (9, None, None), (7, None, None)]


def test_identifiers(spark):
    df = spark.createDataFrame([("1",), ("chrX",), ("MT",), ("chr1_alt",), (None,)], "c string")
    assert [tuple(r) for r in df.select(alleles.contig(F.col("c")), alleles.contig_order(alleles.contig(F.col("c")))).collect()] == [("chr1", 0), ("chrX", 22), ("chrM", 24), (None, 25), (None, 25)]
    acc = spark.createDataFrame([("NC_000001.11",), ("NC_000023.11",), ("NC_012920.1",), ("NW_1",)], "a string")
    assert [r[0] for r in acc.select(alleles.refseq_contig(F.col("a"))).collect()] == ["chr1", "chrX", "chrM", None]
    q = spark.createDataFrame([(1234.56789,), (0.0,), (None,)], "q double")
    assert [r[0] for r in q.select(alleles.rounded_quality(F.col("q"))).collect()] == [1234.57, 0.0, None]


def test_unknown_is_not_zero(spark):
    df = spark.createDataFrame([(None, None, None)], "depth int, gq int, af double")
    r = df.select(
        rules.soft_flags(F.col("af"), F.lit("pass"), F.col("depth"), F.col("gq"), F.lit("het"), F.lit(None).cast("double"), F.lit(False)).alias("soft"),
        rules.impact_at_least(F.lit(None).cast("string"), "modifier").alias("least"),
        pairs.rarity_score(F.col("af")).alias("rarity"),
    ).first()
    assert r.soft == ["no_frequency_data"] and r.least is False and r.rarity == 0.5


def test_text_rules(spark):
    df = spark.createDataFrame([("a_b%3Bc|x%25|.|not_provided|a_b%3Bc",)], "t string")
    assert df.select(rules.decoded_list(F.col("t")).alias("v")).first().v == ["a b;c", "x%"]
    f = spark.createDataFrame([("3/4",), ("12.5%",), ("Frequent",), ("1/0",), ("120%",), ("HP:0040285",), ("",), (None,)], "f string").select(rules.hpo_frequency(F.col("f")).alias("v")).collect()
    assert [tuple(r.v)[:3] for r in f[:3]] == [("ratio", 0.75, 0.75), ("percent", 0.125, 0.125), ("term", 0.3, 0.79)]
    assert [r.v.error for r in f[3:6]] == ["bad_ratio", "bad_percent", "excluded_frequency"] and f[6].v.kind is None and f[7].v.kind is None


def test_widening():
    wide = widened(Config(triage=Triage(retain_unassessed=False, splice_ai=0.5), selection=Selection(retain_no_gene=True)))
    assert wide.triage.retain_unassessed and wide.triage.retain_no_gene and wide.triage.splice_ai == 0.2
    assert widened(Config(selection=Selection(enabled=False))).triage.floor == "modifier"
    try:
        Weights(validity=0.9)
    except ValueError:
        return
    raise AssertionError("weights must sum to one")


def test_epcr_separation(spark):
    rng = random.Random(3)
    rows = [(g, k, round(rng.random(), 4)) for g in range(60) for k in range(1, rng.randrange(2, 11))]
    df = spark.createDataFrame(rows, "g int, rank int, epcr double")
    got = {}
    for r in pairs.separated(df, ["g"]).collect():
        got.setdefault(r.g, []).append((r["rank"], r.epcr, r.separated))
    for own in got.values():
        own.sort()
        n, last = len(own), None
        for i, (_, e, s) in enumerate(own):
            value = min(10_000, round(e * 10_000)) if last is None else min(round(e * 10_000), last - 100)
            value = max(value, 100 * (n - i))
            assert round(s * 10_000) == value
            last = value


def test_promotion(spark):
    rows = [("s", 1, ["a"]), ("s", 2, ["b"]), ("s", 3, ["a", "c"]), ("s", 4, ["d"])]
    out = pairs.promoted(spark.createDataFrame(rows, "p string, rank int, members array<string>"), "p").orderBy("place").collect()
    assert [r["rank"] for r in out] == [3, 1, 2, 4] and [r.promoted for r in out] == [True, False, False, False]
