"""Replayed batches, equivalent spellings, pruned lookups and compared runs, on small tables of their own."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from variantloom import schemas
from variantloom.operators import ledger, ontology, representation, roles, stages, tables
from variantloom.sources import knowledge, vcf
from variantloom.streaming import ingest

CONSEQUENCES = "site_key long, impact string, terms string, is_mane boolean, splice_ai double"


def deliver(folder: Path, sample: str, name: str, positions: list[int]) -> None:
    (folder / f"sample={sample}").mkdir(parents=True, exist_ok=True)
    lines = [f"1\t{p}\t.\tA\tC\t50\tPASS\tDP=9\tGT:AD:DP:GQ\t0/1:10,12:22:50" for p in positions]
    (folder / f"sample={sample}" / name).write_text("##fileformat=VCFv4.2\n" + "\n".join(lines) + "\nbroken\n")


def test_replayed_batches_change_nothing(spark, tmp_path):
    consequences = spark.createDataFrame([(1, "high", "stop_gained", True, None), (2, "modifier", "intron_variant", True, None)], CONSEQUENCES)
    clinical = spark.createDataFrame([], "site_key long, significance string, stars int")
    folder, out = tmp_path / "in", tmp_path / "out"

    def run():
        kept, gone = ingest.ingest_triaged(spark, str(folder), F.floor(F.col("position") / 100).cast("long"), consequences, clinical, str(out), per_batch=1)
        return sorted((r.sample_id, r.position) for r in kept.read().collect()), sorted((r.sample_id, r.variant_id, r.rule) for r in gone.read().collect())

    deliver(folder, "S1", "a.vcf", [101, 102, 201])
    deliver(folder, "S2", "a.vcf", [101, 301])
    first = run()
    assert first[0] == [("S1", 101), ("S1", 102), ("S2", 101)]
    assert [r[2] for r in first[1]] == ["dropped_impact_below_floor", "dropped_no_gene_assignment"]
    assert run() == first  # nothing new arrived
    last = max((out / "log" / "commits").iterdir(), key=lambda p: int(p.name) if p.name.isdigit() else -1)
    last.unlink()  # the batch wrote its rows, and the driver died before it said so
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == first
    deliver(folder, "S1", "b.vcf", [102, 201, 103])  # a later run: delivered before, delivered before, new
    assert run()[0] == [*first[0][:2], ("S1", 103), ("S2", 101)] and run()[1] == first[1]


def spellings(seq: str, position: int, ref: str, alt: str) -> set[tuple]:
    """All anchored spellings of an indel, by trying every place."""
    whole = seq[: position - 1] + alt + seq[position - 1 + len(ref) :]
    size, found = abs(len(ref) - len(alt)), set()
    for p in range(1, len(seq) + 1):
        a = seq[p - 1]
        if len(ref) > len(alt):
            if p + size <= len(seq) and seq[:p] + seq[p + size :] == whole:
                found.add((p, seq[p - 1 : p + size], a))
        elif whole[p : p + size] and seq[:p] + whole[p : p + size] + seq[p:] == whole:
            found.add((p, a, a + whole[p : p + size]))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_every_spelling_is_found(spark, seed):
    rng = random.Random(seed)
    calls, sites, sequences, want = [], [], [], {}
    for k in range(60):
        seq = "".join(rng.choice(["A", "C", "AC", "CAC", "G"]) for _ in range(30))
        sequences.append((f"c{k}", seq))
        p, size = rng.randrange(2, len(seq) - 8), rng.randrange(1, 5)
        a = seq[p - 1]
        ref, alt = (seq[p - 1 : p + size], a) if k % 2 else (a, a + "".join(rng.choice("AC") for _ in range(size)))
        calls.append((k, f"c{k}", p, ref, alt))
        for q, r, s in spellings(seq, p, ref, alt):
            sites.append((f"c{k}", q, r, s, "same"))
            want.setdefault(k, set()).add((q, "exact" if q == p else "shifted"))
        other = "G" + "".join(rng.choice("AC") for _ in range(size))
        sites.append((f"c{k}", p, "G", other, "other"))
    df = representation.windowed(spark.createDataFrame(calls, "k long, contig string, position long, ref string, alt string"), stages.reference_blocks(spark.createDataFrame(sequences, "contig string, seq string")))
    found = representation.equivalent_lookup(df, spark.createDataFrame(sites, "contig string, position long, ref string, alt string, says string"), "k").filter("says = 'same'").collect()
    got: dict = {}
    for r in found:
        got.setdefault(r.k, set()).add((r.site_position, r.found))
    assert got == want


def test_what_cannot_be_reconciled(spark):
    blocks = stages.reference_blocks(spark.createDataFrame([("c", "G" + "A" * 3_000 + "T")], "contig string, seq string"))
    rows = [(1, "c", 2_000, "A", "AA"), (2, "c", 3, "C", "CA"), (3, "none", 5, "A", "AT"), (4, "none", 5, "A", "T"), (5, "c", 1, "G", "GA")]
    df = representation.windowed(spark.createDataFrame(rows, "k long, contig string, position long, ref string, alt string"), blocks)
    assert {r.k: r.representation for r in df.collect()} == {1: "shift_limit", 2: "reference_unusable", 3: "no_reference", 4: "not_required", 5: "shift_limit"}
    found = representation.equivalent_lookup(df, spark.createDataFrame([("none", 9, "A", "AT")], "contig string, position long, ref string, alt string"), "k")
    assert {r.k: r.found for r in found.collect()} == {1: "unreconciled", 2: "unreconciled", 3: "unreconciled", 4: "absent", 5: "unreconciled"}


def test_lookups_read_the_contigs_that_are_asked_for(spark, tmp_path):
    rows = spark.range(2_000).selectExpr("concat('chr', id % 20) AS contig", "id AS position", "'A' AS ref", "'C' AS alt", "id / 2 AS af")
    p = roles.Provider("frequency", "x", "1", roles.written(rows, str(tmp_path / "sites")))
    calls = rows.withColumn("sample_id", F.when(F.col("contig").isin("chr3", "chr4"), "S1").otherwise("S2"))
    calls.write.parquet(str(tmp_path / "calls"))
    asked = spark.read.parquet(str(tmp_path / "calls")).filter("sample_id = 'S1'").select(*roles.KEY)
    out = p.answers(asked)
    assert "dynamicpruning" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == asked.count() == 200
    read = out._jdf.queryExecution().executedPlan().toString()  # the final plan: two of twenty folders were read
    assert "SubqueryBroadcast dynamicpruning" in read or "SubqueryAdaptiveBroadcast dynamicpruning" in read
    with pytest.raises(ValueError, match="no role"):
        roles.Provider("x", "y", "1", "")
    with pytest.raises(ValueError, match="already"):
        roles.Roles().add(p, p)
    with pytest.raises(KeyError, match="nothing answers"):
        roles.Roles().answers("clinical", asked)


def test_runs_are_compared_as_bags(spark):
    one = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, None, None), (None, "c", 3.0), (4, "d", 4.0)], "k long, x string, y double")
    two = spark.createDataFrame([(None, "c", 3.0), (1, "a", 1.0), (2, None, 2.0), (5, "e", 5.0), (4, "d", 4.0)], "k long, x string, y double")
    assert tables.differences(one, one.repartition(3), ["k"]).count() == 0
    assert {(r.k, r.state, tuple(r.columns)) for r in tables.differences(one, two, ["k"], 2).collect()} == {(1, "changed", ("number of rows", "x", "y")), (2, "changed", ("y",)), (5, "only_second", ())}


def test_commits_show_whole_or_not_at_all(spark, tmp_path):
    store = schemas.Store(spark, str(tmp_path / "s"))
    kind = "citation_key string, source string, identifier string"
    assert store.manifest() == {}
    assert store.commit({"citations": spark.createDataFrame([("k1", "p", "1"), ("k2", "p", "2")], kind), "mechanism_nodes": spark.createDataFrame([("m", "n", "k", "l", "s", "d")], "mechanism_id string, node_id string, kind string, label string, state_in_patient string, description string")}) == 1
    broken = spark.createDataFrame([("k9", None, "9")], kind)  # the second table of this commit cannot be written
    with pytest.raises(Exception, match="is NULL"):
        store.commit({"mechanism_nodes": store.table("mechanism_nodes").withColumn("label", F.lit("new")), "citations": broken})
    assert store.table("mechanism_nodes").first().label == "l" and store.table("citations").count() == 2
    assert store.commit({"citations": spark.createDataFrame([("k2", "p", "22"), ("k3", "p", "3")], kind)}) == 2
    assert {r.citation_key: r.identifier for r in store.table("citations").collect()} == {"k1": "1", "k2": "22", "k3": "3"}
    assert store.manifest() == {"citations": {"version": 2, "rows": 3}, "mechanism_nodes": {"version": 1, "rows": 1}}
    assert store.table("citations", 1).count() == 2
    with pytest.raises(RuntimeError, match="someone else"):
        store._publish(2, "{}")
    with pytest.raises(ValueError, match="not committed"):
        store.table("citations", 7)


def test_sources_that_may_be_absent(spark, tmp_path):
    (tmp_path / "good.csv").write_text("gene,classification\nA,strong\n,weak\n")
    (tmp_path / "bad.csv").write_text("name,other\nA,strong\n")
    (tmp_path / "blank.csv").write_text("gene,classification\n,strong\n")
    said = {}
    for name in ("good", "bad", "blank", "none"):
        rows, state = knowledge.optional_rows(spark, str(tmp_path / f"{name}.csv"), "gene string, classification string, extra string", ["gene"])
        one = state.first()
        said[name] = (rows.columns, rows.count(), one.state, one.reason)
    columns = ["gene", "classification", "extra"]
    assert said == {"good": (columns, 1, "read", ""), "bad": (columns, 0, "garbled", "lacks gene"), "blank": (columns, 0, "garbled", "no row has all required values"), "none": (columns, 0, "absent", "no such file")}


def test_claims_of_files(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("##x_synthetic=true\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\r\nchr1\t1\t.\tA\tC\t.\t.\tX\n")
    (tmp_path / "b.sam").write_text("SYNTH_ file\n@RG\tID:1\tSM:patient\tPL:x\n@RG\tID:2\tSM:SYNTH_2\n")
    (tmp_path / "c.txt").write_text("x" * 5_000 + "SYNTH_\n")
    got = {Path(r.path).name: (r.synthetic_mark, r.n_unmarked, r.sites_only, r.declares_synthetic) for r in vcf.file_claims(vcf.located_lines(spark, str(tmp_path))).collect()}
    assert got == {"a.vcf": (True, 0, True, True), "b.sam": (True, 1, False, False), "c.txt": (False, 0, False, False)}


def test_onsets(spark):
    rows = [("Infantile onset", "infantile"), (" ADULT ", "adult"), (None, "unknown"), ("", "unknown"), ("someday", None)]
    df = spark.createDataFrame(rows, "raw string, want string")
    assert df.filter(~ontology.onset_token(F.col("raw")).eqNullSafe(F.col("want"))).count() == 0


def test_items_of_a_ledger(spark):
    calls = spark.createDataFrame([("S1", "v1", ["low_depth"], "contradicts", "moderate", 0.5), ("S1", "v1", ["low_depth"], "contradicts", "moderate", 0.5), ("S2", "v1", [], "supports", "strong", None)], "sample_id string, variant_id string, qc_flags array<string>, qc_direction string, qc_strength string, fraction double")
    items = ledger.emitted(ledger.call_items(calls))
    assert {(r.subject_id, r.direction, r.kind) for r in items.collect()} == {("S1|v1", "contradicts", "quality"), ("S2|v1", "supports", "quality")}
    two = calls.withColumn("fraction", F.coalesce("fraction", F.lit(0.1)) + F.monotonically_increasing_id())
    with pytest.raises(Exception, match="two contents"):  # the same claim about the same call with two values
        ledger.emitted(ledger.call_items(two)).collect()
    unversioned = spark.range(1).select(ledger.item("frequency", "variant", F.lit("v"), "neutral", "moderate", "database_assertion", F.lit("x")).alias("i"))
    with pytest.raises(Exception, match="no version"):
        unversioned.collect()


def test_stream_state_is_on_disk(spark, tmp_path):
    """What was delivered before is known from state on disk; the session's own settings stay as they were."""
    spark.range(5).selectExpr("id", "TIMESTAMP '2024-01-01 00:00:00' AS arrived").write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("id long, arrived timestamp").parquet(str(tmp_path / "in"))
    stream = rows.withWatermark("arrived", "1 hour").dropDuplicatesWithinWatermark(["id"])
    done = ingest.started(spark, stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True))
    done.awaitTermination()
    states = [s for p in done.recentProgress for s in p["stateOperators"]]
    assert states and all(any(k.startswith("rocksdb") for k in s["customMetrics"]) for s in states) and states[0]["numRowsTotal"] == 5
    assert all(spark.conf.get(k, None) is None for k in ingest.STATE)
