"""Pieces are merged by their hash, without their sides, and masks are joined without a shuffle of their own for copies."""

from __future__ import annotations

import random

from variantloom.llm import substrings


def test_wide_rows_stay_behind(spark, monkeypatch):
    tables, written = [], substrings.written
    monkeypatch.setattr(substrings, "written", lambda df: (tables.append(df.columns), written(df))[1])
    rng = random.Random(2)
    same = "".join(rng.choices("abcdef ", k=700))
    rows = [(k, f"{k} " * 9 + same + f" {k}" * 9) for k in range(4)]
    places = substrings.repeated_places(spark.createDataFrame(rows, "text_key long, text string"))
    assert "HashAggregate" not in places._jdf.queryExecution().executedPlan().toString()
    assert [x for x in tables if "a" in x and "b" in x] == [["core", "piece", "a", "b"]]
    assert {r.text_key for r in places.filter("mask <> 0").collect()} == {0, 1, 2, 3}
