"""Sources, sinks, streams and domain operators on small hand-made files."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from variantloom import schemas
from variantloom.operators import annotate, compare, mechanism, ontology, tables, textscan
from variantloom.sources import tables as knowledge
from variantloom.sources import vcf
from variantloom.streaming import ingest

HEADER = ["##fileformat=VCFv4.2", "##reference=GRCh38", '##INFO=<ID=AF_afr,Number=A,Type=Float,Description="x">', '##FILTER=<ID=LowQual,Description="x">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1"]
BODY = [
    ("chr15", 40200000, "C", "T", "PASS", "0/1", "45", "23,22", "99", ""), ("chr15", 40201000, "C", "A", "PASS", "1|0", "40", "21,19", "95", "40201000"), ("chr15", 40206000, "T", "C", "PASS", "1/1", "48", "1,47", "99", ""),
    ("chr15", 40211000, "G", "GAT", "LowQual", "0/1", "4", "3,1", "8", ""), ("chr11", 5000000, "A", "G,GT", "PASS", "1/2", "44", "2,21,21", "97", ""), ("chr3", 10000000, "G", "<DEL>", "PASS", "0/1", "33", "17,16", "88", ""),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("vcf")
    lines = [f"{c}\t{p}\t.\t{r}\t{a}\t50.123456\t{f}\tSYNTH;AF=0.1\tGT:DP:AD:GQ{':PS' if ps else ''}\t{gt}:{dp}:{ad}:{gq}{':' + ps if ps else ''}" for c, p, r, a, f, gt, dp, ad, gq, ps in BODY]
    (path / "case.vcf").write_text("\n".join([*HEADER, *lines, "chr1\tx\tbroken"]) + "\n")
    return str(path)


def test_vcf(spark, folder):
    text = vcf.lines(spark, folder)
    facts = vcf.header_facts(text).first()
    assert facts.build == "GRCh38" and facts.samples == ["S1"] and facts.groups == ["afr"] and facts.filters == ["LowQual"]
    rows = vcf.records(text)
    assert {r.verdict: r.n for r in rows.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()} == {"ok": 6, "malformed_record": 1}
    calls = {(r.contig, r.position, r.alt): r for r in ingest.judged(vcf.called(rows)).collect()}
    assert len(calls) == 7
    assert calls["chr11", 5000000, "G"].zygosity == "het" and calls["chr11", 5000000, "GT"].alt_reads == 21 and calls["chr11", 5000000, "G"].was_split
    assert calls["chr15", 40211000, "GAT"].qc_flags == ["filtered_by_caller", "low_depth", "low_gq"]
    assert calls["chr15", 40201000, "A"].phase_set == 40201000 and calls["chr15", 40201000, "A"].phased
    assert calls["chr3", 10000000, "<DEL>"].verdict == "symbolic_allele"
    assert calls["chr15", 40200000, "T"].quality == 50.1235


def test_sites(spark, tmp_path):
    (tmp_path / "sites.vcf").write_text("\n".join([
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
        "chr1\t10\tr1\tA\tC,G\t.\tPASS\tAF=0.1,0.2;AC=1,2;AN=10;nhomalt=0,1;AF_afr=0.5,.;AN_afr=0",
        "chr1\t20\tr2\tA\tC\t.\tPASS\tCLNSIG=Likely_pathogenic;CLNREVSTAT=reviewed_by_expert_panel;CLNDN=A%2C_b|not_provided;CLNSIG=Pathogenic",
        "chr1\t30\tr3\tA\tC\t.\tPASS\tANN=C|stop_gained|HIGH|G1|E1|transcript|T1|pc|1|c|p|1|1|1||,C|x|LOW|||||||||||||,C|short",
    ]) + "\n")
    rows = vcf.records(vcf.lines(spark, str(tmp_path)))
    freq = {(r.alt, r.population): (r.af, r.ac, r.nhomalt) for r in vcf.site_frequencies(rows, ["afr"]).collect()}
    assert freq == {("C", "all"): (0.1, 1, 0), ("G", "all"): (0.2, 2, 1)}
    a = vcf.assertions(rows).collect()
    assert len(a) == 1 and a[0].significance == "Pathogenic" and a[0].stars == 3 and a[0].conditions == ["A, b"]
    assert [(r.gene_symbol, r.verdict) for r in vcf.predicted(rows).collect()] == [("G1", "ok"), (None, "unplaceable"), (None, "incomplete")]
    assert vcf.callset_profile(rows).first().n == 3


def test_stream(spark, folder, tmp_path):
    kept, gone = [], []
    ingest.ingest(spark, folder, lambda a, b: (kept.extend(a.collect()), gone.extend(b.collect())), str(tmp_path / "log")).awaitTermination()
    assert len(kept) == 6 and [r.rule for r in gone] == ["symbolic_allele"]


def test_knowledge(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("# c\nhpo_id\tlabel\tstatus\nHP:0000001\ta\tpresent\nhp:0000002\tb\truled out\nHP:0000003\tc\tmaybe\nX\td\tyes\nHP:0000001\ta\tno\n")
    got = sorted((r.term or "", r.status or "", r.verdict) for r in knowledge.profile(spark, str(tmp_path / "p.tsv"), "s").collect())
    assert got == [
        ("", "observed", "bad_term"), ("HP:0000001", "excluded", "duplicate_term"), ("HP:0000001", "observed", "duplicate_term"), ("HP:0000002", "excluded", "ok"), ("HP:0000003", "", "unknown_status"),
    ]
    with pytest.raises(ValueError, match="lacks"):
        knowledge.read_delimited(spark, str(tmp_path / "p.tsv"), "x int", ["other"])
    (tmp_path / "o.obo").write_text("format-version: 1.2\n\n[Term]\nid: HP:1\nname: all\n\n[Term]\nid: HP:2\nname: two\nalt_id: HP:9\nis_a: HP:1 ! all\n\n[Term]\nid: HP:3\nname: old\nis_obsolete: true\nreplaced_by: HP:2\n")
    terms, edges, aliases = knowledge.ontology_tables(knowledge.obo_terms(spark, str(tmp_path / "o.obo")))
    assert sorted(r.term for r in terms.collect()) == ["HP:1", "HP:2"] and [tuple(r) for r in edges.collect()] == [("HP:2", "HP:1")]
    ids = spark.createDataFrame([("HP:2",), ("HP:9",), ("HP:3",), ("HP:7",)], "id string")
    assert {r.id: r.term for r in ontology.resolved(ids, terms, aliases).collect()} == {"HP:2": "HP:2", "HP:9": "HP:2", "HP:3": "HP:2", "HP:7": None}
    (tmp_path / "g.gtf").write_text('chr1\ts\tgene\t1\t9\t.\t+\t.\tgene_id "E1.2"; gene_name "G1";\nchr1_alt\ts\tgene\t1\t9\t.\t+\t.\tgene_id "E2.1"; gene_name "G2";\nchr1\ts\texon\t1\t9\t.\t+\t.\tgene_id "E1.2";\n')
    assert sorted((r.gene_symbol, r.verdict) for r in knowledge.gtf_genes(spark, str(tmp_path / "g.gtf")).collect()) == [("G1", "ok"), ("G2", "off_primary")]


def test_store(spark, tmp_path):
    store = schemas.Store(spark, str(tmp_path))
    one = spark.createDataFrame([("k1", "pubmed", "1"), ("k2", "pubmed", "2")], "citation_key string, source string, identifier string")
    store.write("citations", one)
    two = store.write("citations", spark.createDataFrame([("k2", "pubmed", "22"), ("k3", "pubmed", "3")], "citation_key string, source string, identifier string"), 2)
    assert sorted((r.citation_key, r.identifier) for r in two.collect()) == [("k1", "1"), ("k2", "22"), ("k3", "3")]
    assert store.query("SELECT count(*) AS n FROM citations WHERE source = :s", {"citations": 2}, s="pubmed").first().n == 3
    with pytest.raises(ValueError, match="has no"):
        schemas.conformed(one.withColumn("other", F.lit(1)), "citations")
    with pytest.raises(Exception, match="is NULL"):
        schemas.conformed(one.drop("source"), "citations").collect()
    assert len(schemas.TABLES) == 17 and all(set(k) <= set(schemas.schema(n).names) for n, (k, _) in schemas.TABLES.items())
    assert schemas.provenance(spark, str(tmp_path / "citations"), "r", "table", "export").count() > 0
    assert schemas.run_row(spark, "c", "GRCh38", {"a": 1}, "2026-01-02T03:04:05").first().run_id.startswith("RUN-")


def test_text_rules_fire(spark):
    assert textscan.dead_rules(spark).count() == 0
    docs = spark.createDataFrame([(1, "MRN: 123456789 and HP:0000118"), (2, None), (3, ""), (4, "HP:0000001 HP:0000002 HP:0000003"), (5, "x 2026-01-02 y")], "doc_id long, text string")
    got = {(r.doc_id, r.rule): r.severity for r in textscan.resolved(textscan.findings(docs)).collect()}
    assert got == {(1, "mrn"): "fail", (1, "hpo_term"): "warn", (4, "hpo_term"): "fail", (5, "iso_date_bare"): "warn"}
    assert docs.select(textscan.redacted(F.col("text")).alias("t")).filter("doc_id = 1").first().t == "<mrn,14> and <hpo_term,10>"
    shaped = {r.doc_id: r.profile_shape for r in textscan.profile_shaped(spark.createDataFrame([(1, "hpo_id\tstatus\n"), (2, "prose")], "doc_id long, text string")).collect()}
    assert shaped == {1: True, 2: False}
    cites = textscan.citations(spark.createDataFrame([(1, "Smith et al. 2011 (PMID: 123) and PMID:77")], "doc_id long, text string")).orderBy("place").collect()
    assert [(r.pmid, r.year, r.author) for r in cites] == [("123", 2011, "Smith"), ("77", None, None)]
    gate = textscan.export_gate(spark.createDataFrame([("a/report.tsv", "public"), ("private/x.vcf.gz", "public")], "path string, declared string"), spark.createDataFrame([], "path string, rule string, severity string"), ["tsv"])
    assert {r.path: r.allowed for r in gate.collect()} == {"a/report.tsv": True, "private/x.vcf.gz": False}


def test_directions(spark):
    rows = [("increase", "restore", True), ("increase", "decrease", False), ("increase", "no_change", False), ("no_change", "increase", None), ("unknown", "increase", None), ("increase", "context_dependent", None), ("decrease", "destabilise", True)]
    df = spark.createDataFrame(rows, "r string, o string, want boolean")
    assert df.filter(~mechanism.directions_agree(F.col("r"), F.col("o")).eqNullSafe(F.col("want"))).count() == 0


def test_ledger(spark):
    items = spark.createDataFrame([("E1", "a"), ("E1", "a"), ("E2", "b")], "evidence_id string, claim string")
    assert compare.deduplicated(items).count() == 2
    with pytest.raises(Exception, match="two contents"):
        compare.deduplicated(items.union(spark.createDataFrame([("E2", "c")], items.schema))).collect()
    claims = spark.createDataFrame([(1, ["E1", "E9"])], "claim_id int, evidence_ids array<string>")
    assert [r.evidence_id for r in compare.unresolved(claims, items).collect()] == ["E9"]


def test_frequency_power(spark):
    rows = [(1, "A", 0.5, 100, 1), (1, "B", 0.1, 3000, 2), (1, "C", 0.1, None, 3), (2, "A", 0.2, 5, 0), (3, "A", None, 9000, 0)]
    got = {r.site_key: r for r in annotate.max_frequency(spark.createDataFrame(rows, "site_key int, population string, af double, an long, nhomalt long")).collect()}
    assert (got[1].max_af, got[1].max_af_population, got[1].underpowered) == (0.1, "C", ["A"]) and got[2].max_af is None and got[3].max_af is None


def test_checks_and_cycles(spark):
    df = spark.createDataFrame([(1, True, "0|1"), (2, True, "0/1"), (3, None, None)], "id int, phased boolean, gt string")
    bad = tables.invalid(df, {"phase": F.when(F.col("phased"), F.col("gt").contains("|")).otherwise(True)})
    assert [r.id for r in bad.collect()] == [2]
    loop = ontology.ancestor_closure(spark.createDataFrame([(1, 2), (2, 3)], "child long, parent long"))
    assert sorted(map(tuple, loop.collect())) == [(1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 3)]


def test_table_in_parts(spark, tmp_path):
    """The header stands in the first part by name only; larger parts are read first by Spark, and lose no row to a header."""
    (tmp_path / "part-00000.txt").write_text("# note\nhpo_id\tstatus\nHP:0000001\tpresent\nhpo_id\tstatus\n")
    (tmp_path / "part-00001.txt").write_text("".join(f"HP:{k:07d}\tabsent\n" for k in range(2, 200)))
    (tmp_path / "part-00002.txt").write_text("hpo_id\tstatus\nHP:0000200\tpresent\n")
    rows = knowledge.profile(spark, str(tmp_path), "P1").collect()
    assert sorted(r.term for r in rows if r.term) == [f"HP:{k:07d}" for k in range(1, 201)]
    assert {r.verdict for r in rows if r.term} == {"ok"} and [r.verdict for r in rows if not r.term] == ["bad_term"]


def test_closure_by_waves(spark):
    """Waves and, beyond them, doubling give one closure: a chain, a diamond, a cycle; each term meets each of its parents once a round, whatever stands above."""
    edges = [(k, k + 1) for k in range(1, 50)] + [(101, 103), (101, 102), (102, 104), (103, 104), (104, 50)] + [(201, 202), (202, 201)]
    above = {t: {t} for e in edges for t in e}
    for _ in range(60):
        for c, p in edges:
            above[c] |= above[p]
    want = sorted((t, a) for t, xs in above.items() for a in xs)
    df = spark.createDataFrame(edges, "child long, parent long")
    for waves in (1, 64):
        assert sorted(map(tuple, ontology.ancestor_closure(df, most_waves=waves).collect())) == want
    home = Path(tables.shared_home(spark))
    old = set(home.glob("table-*"))
    ontology.ancestor_closure(df)
    assert len(set(home.glob("table-*")) - old) == 1  # the tables of the rounds are gone


def test_information_content_by_edges(spark):
    """By edges and by the closure alike, in a diamond with a term that no edge has; a cycle, and more edges than waves, are left to the closure."""
    corpus = spark.createDataFrame([("e1", 1), ("e2", 1), ("e2", 2), ("e2", 2), ("e3", 4), ("e4", 99)], "entity string, term long")
    df = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (3, 4)], "child long, parent long")
    got, want = (sorted(map(tuple, x.collect())) for x in (ontology.information_content(corpus, None, df), ontology.information_content(corpus, ontology.ancestor_closure(df))))
    assert got == want and [(t, n) for t, n, _ in got] == [(1, 2), (2, 2), (3, 2), (4, 3)]
    for edges in ([(1, 2), (2, 1)], [(1, 2), (2, 3), (3, 4), (4, 5)]):
        assert ontology.raised_counts(corpus, spark.createDataFrame(edges, "child long, parent long"), most_waves=2) is None
