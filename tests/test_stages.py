"""Compositions and knowledge builders on small tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from variantloom.functions import alleles
from variantloom.operators import compare, pairs, stages
from variantloom.sources import knowledge


def test_normalise_against_a_plain_walk(spark):
    rng = random.Random(11)
    genome = "".join(rng.choices("AC", k=9_000))
    rows = []
    for _ in range(150):
        pos, size = rng.choice([rng.randrange(2, 8_900), rng.randrange(4_090, 4_110)]), rng.randrange(1, 4)
        rows.append(("chr1", pos, genome[pos - 1 : pos + size], genome[pos - 1]) if rng.random() < 0.5 else ("chr1", pos, genome[pos - 1], genome[pos - 1] + genome[pos : pos + size]))
    rows.append(("chr2", 5, "A", "AT"))
    blocks = stages.reference_blocks(spark.createDataFrame([("chr1", genome)], "contig string, seq string"))
    out = stages.normalised(spark.createDataFrame(list(enumerate(rows)), "id int, v struct<contig:string,position:long,ref:string,alt:string>").select("id", "v.*"), blocks)
    got = {r.id: r for r in out.collect()}
    for k, (contig, pos, ref, alt) in enumerate(rows):
        if contig != "chr1":
            assert got[k].reference_matches is None
            continue
        while pos > 1 and genome[pos - 1] == max(ref, alt, key=len)[-1]:
            unit = max(ref, alt, key=len)
            unit, pos = unit[-1] + unit[1:-1], pos - 1
            ref, alt = (genome[pos - 1] + unit, genome[pos - 1]) if len(ref) > len(alt) else (genome[pos - 1], genome[pos - 1] + unit)
        assert (got[k].position, got[k].ref, got[k].alt) == (pos, ref, alt) and got[k].reference_matches
    assert stages.alignment_report(out).first().n == len(rows)
    assert {r.op for r in stages.op_counts(out).collect()} <= {"left_align", "trim"}


def test_right_shift(spark):
    df = spark.createDataFrame([("CACACAT", "A", "ACA"), ("GGG", "A", "AT"), ("", "A", "AT"), ("TT", "A", "C")], "flank string, ref string, alt string")
    assert [r[0] for r in df.select(alleles.right_shift(F.col("flank"), F.col("ref"), F.col("alt"))).collect()] == [6, 0, 0, 0]


def test_genotype_resolution(spark):
    df = spark.createDataFrame([("1/2",), ("0|1",), ("1/1",), (None,)], "gt string").select(stages.resolved_genotype(F.col("gt")).alias("r"))
    assert [tuple(r.r) for r in df.collect()] == [("het", "split_multiallelic"), (None, None), (None, None), (None, None)]


def test_gene_scores_default(spark):
    df = spark.createDataFrame([(1,), (2,)], "gene_key int")
    out = {r.gene_key: (r.phenotype, r.mechanism) for r in stages.with_gene_scores(df, spark.createDataFrame([(1, 0.9)], "gene_key int, score double"), spark.createDataFrame([(1, 0.4)], "gene_key int, score double")).collect()}
    assert out == {1: (0.9, 0.4), 2: (0.5, 0.0)}


def test_evidence_order_and_quality(spark):
    rows = spark.createDataFrame([("v1", [], "supports", "strong", 0.5), ("v2", ["low_depth"], "contradicts", "moderate", None)], "variant_id string, flags array<string>, direction string, strength string, fraction double")
    items = compare.deduplicated(stages.quality_evidence(rows))
    assert {r.claim for r in items.collect()} == {"call passes all quality rules", "call is flagged low_depth"}
    assert [r.place for r in stages.evidence_order(items).collect()] == [1, 1]


def test_single_candidates(spark):
    df = spark.createDataFrame([("chr1", "hom_alt", False, 3), ("chrX", "hemi", False, None), ("chr1", "het", False, 0), ("chr1", "het", True, 2), ("chrM", "het", False, 2), ("chr1", "het", False, 2)], "c string, z string, m boolean, w int")
    out = df.select(pairs.wants_single(F.col("c"), F.col("z"), F.col("m"), F.col("w")).alias("k"), pairs.single_model(F.col("c"), F.col("z"), F.col("m")).alias("m")).collect()
    assert [(r.k, r.m) for r in out] == [(True, "homozygous_recessive"), (True, "x_linked"), (True, "unknown"), (True, "mosaic"), (True, "mitochondrial"), (False, "unknown")]


def test_knowledge_builders(spark, tmp_path):
    best, counts = knowledge.gene_phenotypes(spark.createDataFrame([("G", "HP:1", "D2", None), ("G", "HP:1", "D9", "3/4"), ("G", "HP:2", "D1", "HP:0040285")], "gene string, hpo_id string, disease_id string, frequency string"))
    assert [(r.disease_id, r.lower) for r in best.collect()] == [("D9", 0.75)]
    assert {r.verdict: r.n for r in counts.collect()} == {"ok": 2, "excluded_frequency": 1}
    summary = spark.createDataFrame([("E1.1", "G1", "N2.1", "MANE Plus Clinical"), ("E1.1", "G1", "N9.3", "MANE Select"), ("E2.1", "G2", "N3.1", "MANE Select")], "gene_id string, symbol string, transcript string, status string")
    genes = knowledge.summary_genes(summary)
    assert {r.gene_id: r.transcripts for r in genes.collect()} == {"E1.1": ["N9.3", "N2.1"], "E2.1": ["N3.1"]}
    gtf = spark.createDataFrame([("E1.1", "G1", 1), ("E3.1", "G3", 2)], "gene_id string, gene_symbol string, g_start int")
    assert {r.gene_id: r.verdict for r in knowledge.joined_genes(gtf, genes).collect()} == {"E1.1": "ok", "E2.1": "not_in_gtf", "E3.1": "not_in_summary"}
    assert {r.transcript_id for r in knowledge.select_ids(summary).collect()} == {"N9", "N3"}
    (tmp_path / "c.csv").write_text('"CLINGEN GENE VALIDITY"\n"FILE CREATED: 2026-01-02"\n"+++++","+++"\n"GENE SYMBOL","x"\n"+++++"\n"G1","HGNC:1","d","MONDO:1","AR","SOP","Definitive","u","2020","Panel"\n')
    row = knowledge.clingen_rows(spark, str(tmp_path / "c.csv")).first()
    assert (row.gene, row.classification, row.panel, row.version) == ("G1", "Definitive", "Panel", "2026-01-02")
    assert [knowledge.truth(F.lit(x)) is not None for x in ("yes", "")] == [True, True]
    assert knowledge.empty_clinical(spark).count() == 0
    assert knowledge.manifest(spark, str(tmp_path), "v", "d").first().version == "v"
    assert knowledge.release(spark, str(tmp_path), r"FILE CREATED: *([0-9-]+)").first().release == "2026-01-02"
