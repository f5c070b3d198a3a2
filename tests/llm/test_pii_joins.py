"""Tables that are exploded by salts are SALTS times what Spark takes them for, so they are merged and never broadcast."""

from __future__ import annotations

from variantloom.llm import pii
from variantloom.llm.common import written


def test_told_terms_are_not_broadcast(spark):
    docs = spark.createDataFrame([(k, f"zorblat{c} writes to zorblat{c}@example.com about the weather") for k, c in enumerate("abc")], "doc_id long, text string")
    base = pii.base_table(docs)
    entity = pii.entity("user:zorblatb")
    told = written(spark.createDataFrame([(entity, "zorblatb", 1.0, "remove"), (entity, "weather", 0.7, "generalise")], "entity long, term string, ratio double, action string").coalesce(1))
    terms = pii.wanted(told, base)
    plan = terms._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    (row,) = terms.collect()
    assert sorted((x["term"], x["action"]) for x in row.told) == [("weather", "generalise"), ("zorblatb", "remove")]
