"""Corpus pipeline over ``documents``: five stages, each written and read again.

Every stage gets what its predecessor kept, decides on all of it, and, but for the
last, returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayline.llm.line_dedup import drop_repeated_lines
from stayline.llm.mixing import mixed
from stayline.llm.near_dedup import one_of_each_class
from stayline.llm.pieces import coded
from stayline.llm.registry import let_workers_import, table
from stayline.llm.toxicity import without_toxic
from stayline.session import staged

#: A line found in this many documents stays only where it comes first.
LINE_DOCUMENTS = 10


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject; ``labels`` trains it."""
    let_workers_import(spark)
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat across many of them; the first document keeps its."""
    let_workers_import(spark)
    return drop_repeated_lines(docs, min_docs=LINE_DOCUMENTS, keep_first=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    let_workers_import(spark)
    return one_of_each_class(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``piece_ids``, their encoding, and ``decoded``, what those turn back into."""
    let_workers_import(spark)
    return coded(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("pieces", pieces),
]

#: The first stage is a fitted model, which SQL cannot express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
