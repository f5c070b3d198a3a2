"""Every registered query of the core library against its SQL on DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import variantloom.plans.cohort  # noqa: F401
import variantloom.plans.files  # noqa: F401
from variantloom.plans.registry import ORACLES, QUERIES
from variantloom.plans.views import TABLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    cell = lambda v: "NULL" if pd.isna(v) else repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name not in ORACLES:
        assert len(got) > 0
        return
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
