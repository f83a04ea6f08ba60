"""Registry of the training-data queries and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def let_workers_import(spark: SparkSession) -> None:
    """Put this checkout on the path of the Python workers, wherever the driver was started.

    On machines without the checkout the package is installed or sent with
    ``--py-files``, as for any Spark job; then this path is just not there.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the equivalent statement over the same tables."""

    def register(function):
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            let_workers_import(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
