"""A training-corpus pipeline over the documents table: each stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meltline.llm import bpe, decontaminate, exact, minhash, quality
from meltline.llm.common import counted, stored, table
from meltline.llm.queries import RANKS

def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column of numbers that tell its rows apart, in the order of doc_id, and the column's name.

    Where each row has a doc_id of its own that is the number. Else rows are numbered in the order of doc_id (null
    first) and text, and written once, so that every row is judged, kept or dropped by itself.
    """
    name = "row"
    while name in docs.columns:
        name += "_"
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if shared.isEmpty():
        return docs.withColumn(name, F.col("doc_id")), name
    return stored(docs.orderBy("doc_id", "text").withColumn(name, F.monotonically_increasing_id()), "rows"), name


def _without(rows: DataFrame, name: str, dropped: DataFrame) -> DataFrame:
    """The rows whose number isn't in dropped; texts move only where too many numbers are dropped to be broadcast."""
    return rows.join(counted(dropped, "dropped"), name, "left_anti").drop(name)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (fitted on labels) doesn't reject, row by row.

    The verdict depends on the text alone: empty and null texts have one like any other, repeated rows have the same.
    """
    rows, name = _numbered(docs)
    found = quality.scored(rows, table(spark, sf_dir, "labels"), also=[name])
    return _without(rows, name, found.where("predicted = 0").select(name))


def _judged(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], dropped: str) -> DataFrame:
    """docs without the rows that an operator finds to be dropped; it sees each row's number as its doc_id."""
    rows, name = _numbered(docs)
    found = judge(rows.select(F.col(name).alias("doc_id"), "text")).where(dropped)
    return _without(rows, name, found.select(F.col("doc_id").alias(name)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the one with the smallest doc_id (null before all), of rows that share it
    the first by text; of full repetitions one. Null and empty texts are one group."""
    return _judged(docs, exact.exact_duplicates, "NOT kept")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by a Jaccard similarity of 0.8 or more over shingles of five words: the one with the
    smallest doc_id (null before all). Rows that share a doc_id are told apart; texts without words all stay."""
    return _judged(docs, lambda rows: minhash.near_duplicates(rows, size=5, percent=80), "NOT kept")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item, row by row. Null and empty texts stay; so does all without items."""
    return _judged(docs, lambda rows: decontaminate.decontaminated(rows, table(spark, sf_dir, "benchmark")), "contaminated")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the token ids of every document, row by row; null text is empty."""
    return bpe.tokenised(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", classify),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("bpe", tokenise),
]

#: The learnt classifier, MinHash components and BPE have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each one keeps is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
