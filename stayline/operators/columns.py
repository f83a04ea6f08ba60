"""Column typing helpers and long-form statistics used by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The named columns the table has; cleaning tolerates missing ones."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in set(df.columns)]
    if missing:
        raise ValueError(f"missing column(s): {missing}")


def value_frequencies(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n): one shuffle with map-side combine for all columns.

    Distinct counts, value lists, code tables, NULL counts and unexpected
    values all follow from this table, whose size is the number of distinct
    values, not of rows.
    """
    columns = list(text_columns(df) if columns is None else columns)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], columns, "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls) for every column, from a single pass over the rows."""
    columns = list(df.columns if columns is None else columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, nulls bigint")
    counted = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return counted.unpivot([], columns, "column", "nulls")
