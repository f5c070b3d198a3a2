"""Every operator on odd rows and on empty tables: it runs, and each case has its defined result."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from variantloom.llm import decontaminate, langid, nearcopies, pieces, pii, quality, sharding, simhash, substrings, topk, toxicity


def test_empty_tables(spark, empty, no_labels):
    bench = spark.createDataFrame([], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    runs = [
        pii.report(empty), pii.sanitised(empty), decontaminate.leaks(empty, bench), decontaminate.clean(empty, bench), simhash.near_duplicates(empty), simhash.deduplicated(empty), pieces.round_trip(empty), sharding.shard_rows(empty),
        topk.top_k_of_table(vectors), toxicity.detect(empty, no_labels), substrings.repeated_bytes(empty), quality.classify(empty, no_labels), quality.kept(empty, no_labels), langid.identify(empty),
    ]
    for df in runs:
        assert df.count() == 0


def test_no_labels(odd, no_labels):
    assert {r.score for r in quality.classify(odd, no_labels).collect()} == {0.5}
    assert len({round(r.score, 6) for r in toxicity.detect(odd, no_labels).collect()}) == 1
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_rows_stay_whole(odd, labels):
    n = odd.count()
    for df in (pii.report(odd), pii.sanitised(odd), simhash.near_duplicates(odd), pieces.round_trip(odd), sharding.shard_rows(odd), toxicity.detect(odd, labels), substrings.repeated_bytes(odd), quality.classify(odd, labels), langid.identify(odd)):
        assert df.count() == n


def test_defined_results(odd):
    lang = {(r.doc_id, r.lang_pred) for r in langid.identify(odd).collect()}
    assert {(2, "und"), (3, "und"), (7, "und")} <= lang
    trips = pieces.round_trip(odd).collect()
    assert all(r.lossless for r in trips) and {r.n_pieces for r in trips if r.doc_id in (2, 3)} == {0}
    near = {r.doc_id: r for r in simhash.near_duplicates(odd).collect()}
    assert near[2].fingerprint == near[3].fingerprint == "0" * 16 and near[3].component_id == 2 and near[4].component_id == 1
    assert near[None].component_id is None
    none = hashlib.sha256(b"").hexdigest()
    assert {r.base_sha256 for r in pii.report(odd).collect()} == {none}
    shards = sharding.shard_rows(odd).collect()
    assert sorted((r.shard, r.slot) for r in shards) == sorted((k % 40, k // 40) for k in range(len(shards)))
    assert {(r.size, r.text_crc32) for r in shards if r.doc_id in (2, 3)} == {(16, 0)}
    cut = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in substrings.repeated_bytes(odd).collect()}
    assert cut[6] == (15000, 15000, 1) and cut[2] == cut[3] == (0, 0, 0) and cut[1][1] == 0


def test_clashing_columns_stay(spark, odd, labels):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (2, None), (None, "x")], "item_id long, text string")
    for df in (pii.sanitised(odd), decontaminate.clean(odd, bench), simhash.deduplicated(odd), quality.kept(odd, labels), pieces.encode(odd).drop("pieces")):
        assert df.columns == odd.columns
    assert {r.doc_id for r in decontaminate.clean(odd, bench).collect()} == {2, 3, 6, 7, 8, None}
    assert sorted(r.doc_id for r in simhash.deduplicated(odd.filter("doc_id IS NOT NULL")).collect()) == [1, 2, 6, 7, 8]


def test_near_copies_and_pipeline(spark, odd, empty, labels, tmp_path):
    """The stages on null, empty, long and repeated rows and clashing columns, and on no rows."""
    assert nearcopies.deduplicated(empty).count() == 0
    kept = nearcopies.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 2), (False, 6), (False, 7), (False, 8), (True, 0)]
    bench = spark.createDataFrame([(1, "no such passage is in any of the texts of this table")], "item_id long, text string")
    assert decontaminate.leaks(odd, bench).count() == 0
    for name, docs in (("odd", odd), ("empty", empty)):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
        bench.write.parquet(str(tmp_path / name / "benchmark.parquet"))
        ids = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path / name)).collect()}
        assert ids <= {None, *range(9)} if name == "odd" else not ids


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, -1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit("x"))
    got = [tuple(r) for r in topk.top_k_of_table(df).orderBy("query_id", "rank").collect()]
    one = 1024 * 1024
    assert got == [(0, 1, 1, one), (0, 2, 2, one), (0, 3, 100, 0), (100, 1, 0, 0), (100, 2, 1, -one), (100, 3, 2, -one)]


def test_labels_may_hold_anything(odd, labels):
    scores = {r.doc_id: r.score for r in quality.classify(odd, labels).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    with pytest.raises(ValueError, match="agree only"):
        simhash.links(odd.select(F.lit(1).cast("long").alias("node"), F.lit(1).cast("long").alias("fp")), radius=9)
