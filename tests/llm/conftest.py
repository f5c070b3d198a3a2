from __future__ import annotations

import pytest

LONG = "wort " * 3000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en"), (2, "", "en"), (3, None, None), (4, "The quick brown fox jumps over the lazy dog near the river bank today", "en"),
    (4, "The quick brown fox jumps over the lazy dog near the river bank today", "en"), (None, "zweite Zeile der alten Stadt und noch ein Satz", "de"), (6, LONG, "de"), (7, "12 34 !! ??", None), (8, "▁ mark  two blanks\n\ttab ß 日本 🎉", "fr"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, key string, node string, mask string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", "x", "x", "x") for i, t, lang in TEXTS], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, None), (6, None, 1), (7, 0, 1), (7, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
