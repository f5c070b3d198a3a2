"""A training-corpus pipeline: quality, near-duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again before the next.
All stages but the last return the columns of documents. Edge cases are those of the operators: null and empty
texts are scored, compared and encoded like others; repeated rows are copies of one document; tables may be empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from variantloom.llm import decontaminate, nearcopies, pieces, pii, quality
from variantloom.llm.common import discarded, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word similarity of 0.8 at least, verified on the whole texts."""
    return nearcopies.deduplicated(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what gives it away masked in the text; n_chars follows the new text."""
    return pii.sanitised(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every text, with merge-dropout, checked to decode to the text."""
    return pieces.encoded_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", no_near_copies),
    ("decontamination", no_benchmark),
    ("personal_data", no_personal_data),
    ("pieces", tokens),
]

#: Classifier, fingerprints, windows and pieces are not expressible in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over all of documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir))
        discarded(before)  # only tables that a stage wrote; the input stays
    return STAGES[-1][1](spark, docs, sf_dir)
