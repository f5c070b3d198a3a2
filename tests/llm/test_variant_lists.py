"""The inverted lists of op11 are many times their table of words, so they are merged and never broadcast, however small the table looks."""

from __future__ import annotations

from variantloom.llm import variants
from variantloom.llm.common import written


def test_lists_are_not_broadcast(spark):
    rows = [("reader", 9), ("readers", 3), ("reade", 4), ("wholly", 5)]
    near = variants.near_pairs(written(spark.createDataFrame(rows, "word string, n long").coalesce(1)))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(map(tuple, near.collect())) == [("reade", 4, "reader", 9), ("reader", 9, "readers", 3)]
