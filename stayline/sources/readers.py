"""Readers for the raw extract and for batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stayline import schema


def read_raw_csv(
    spark: SparkSession,
    path: str,
    columns: T.StructType = schema.RAW_SCHEMA,
    na_tokens: Sequence[str] = schema.NA_TOKENS,
) -> DataFrame:
    """Delimited extract with a header and an explicit schema.

    Every column is read as text first, so that all the usual tokens for
    "missing" become NULL before a type is applied. Blanks stay text. An integer
    column also takes whole numbers written with a point, as in ``34.0``.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in columns])
    rows = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    known = {f.name: F.when(~F.col(f.name).isin(*na_tokens), F.col(f.name)) for f in columns}
    return rows.select(
        *[
            (
                known[f.name]
                if isinstance(f.dataType, T.StringType)
                else _typed(F.trim(known[f.name]), f.dataType)
            ).alias(f.name)
            for f in columns
        ]
    )


def _typed(text: Column, kind: T.DataType) -> Column:
    value = text.try_cast(kind)
    if not isinstance(kind, T.IntegralType):
        return value
    number = text.try_cast("double")
    return F.coalesce(value, F.when(number == F.floor(number), number.try_cast(kind)))


def batch_format(path: str) -> str:
    """``parquet`` or ``csv`` by suffix; anything else is an error."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    suffix = name.rsplit(".", 1)[-1] if "." in name else ""
    if suffix not in ("parquet", "csv"):
        raise ValueError(f"cannot read a batch from '{name}': its name must end in .parquet or .csv")
    return suffix


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_batch(spark: SparkSession, path: str, columns: T.StructType | None = None) -> DataFrame:
    """Customers to score, from parquet or a delimited file with a header.

    A delimited batch needs ``columns``: inferring types would cost a full
    extra pass and could differ from batch to batch.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    if batch_format(path) == "parquet":
        return spark.read.schema(columns).parquet(path) if columns else spark.read.parquet(path)
    if columns is None:
        raise ValueError("a delimited batch needs an explicit schema")
    return read_raw_csv(spark, path, columns)
