"""Numeric expressions with explicit NULL, NaN and rounding behaviour."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def nan_to_null(column: Column) -> Column:
    """NaN sorts above every number in Spark; treat it as missing instead."""
    return F.when(~F.isnan(column), column)


def clip(column: Column, low: Column, high: Column) -> Column:
    """Cap to [low, high]; a missing value stays missing."""
    return F.when(column < low, low).when(column > high, high).otherwise(column)


def round_to(column: Column, digits: int) -> Column:
    """Half-up rounding that first drops the noise of floating-point summation."""
    return F.round(F.round(column.cast("double"), digits + 4), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0.0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")
    )


def count_if(condition: Column) -> Column:
    """Rows where ``condition`` holds, 0 for an empty input."""
    return F.count(F.when(condition, F.lit(1)))
