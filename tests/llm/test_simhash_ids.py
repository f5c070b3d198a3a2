"""Classes of null and repeated ids keep one row each and do not merge."""

from __future__ import annotations

from variantloom.llm import simhash


def test_null_and_repeated_ids(spark):
    texts = [" ".join(f"{name}{k}" for k in range(40)) for name in "abcd"]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3]), (1, texts[1]), (9, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.deduplicated(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, texts[0]), (7, texts[2]), (7, texts[3]), (1, texts[1])])
    near = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert near == {(None, None), (None, 1), (7, 7), (1, 1), (9, 7)}
