"""Cleaning: names, types, duplicates, labels, missing, impossible and extreme values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stayline import schema
from stayline.functions import text
from stayline.functions.numeric import clip, count_if, nan_to_null
from stayline.functions.quantiles import exact_quantiles, quantile_values
from stayline.operators.columns import (
    numeric_columns,
    present,
    text_columns,
    value_frequencies,
)
from stayline.session import lookup


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case; two columns must not get the same name."""
    names = [text.snake_case(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")
    return df.toDF(*names)


def coerce_numeric(
    df: DataFrame,
    columns: Sequence[str] = schema.COERCED_COLUMNS,
    id_columns: Sequence[str] = (schema.ID_COLUMN,),
) -> DataFrame:
    """Named columns to double (text that is no number becomes NULL), ids to text."""
    texts = set(text_columns(df))
    changed = {
        c: nan_to_null(text.to_number(F.col(c)) if c in texts else F.col(c).cast("double"))
        for c in present(df, columns)
    }
    changed |= {c: F.col(c).cast("string") for c in present(df, id_columns)}
    return df.withColumns(changed) if changed else df


def remove_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, order_by: str | None = None
) -> DataFrame:
    """Distinct rows, or the first row per ``subset`` in the order of ``order_by``.

    The subset form is a min-by aggregation, so each task keeps one candidate
    per key before the shuffle and a hot key never gathers in one place. Rows
    have no order of their own in Spark, hence ``order_by`` is required there.
    """
    if not subset:
        return df.dropDuplicates()
    if order_by is None:
        raise ValueError("keeping the first row of a subset needs order_by")
    first = df.groupBy(*subset).agg(F.min_by(F.struct(*df.columns), F.col(order_by)).alias("_row"))
    return first.select(*[F.col("_row")[c].alias(c) for c in df.columns])


def distinct_with_copies(df: DataFrame, copies: str = "_copies") -> DataFrame:
    """Distinct rows and how many copies each has, counted behind the shuffle."""
    return df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias(copies))


def duplicate_info(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row: initial_rows, duplicates_removed, final_rows, subset_columns."""
    keys = list(subset or df.columns)
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    initial = F.coalesce(F.sum("_n"), F.lit(0))
    return groups.agg(
        initial.alias("initial_rows"),
        (initial - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count(F.lit(1)).alias("final_rows"),
    ).withColumn("subset_columns", F.lit(",".join(subset)) if subset else F.lit(None).cast("string"))


def normalized_text(
    column: Column, no_service_labels: Sequence[str] = schema.NO_SERVICE_LABELS
) -> Column:
    """Trim, then unify the no-service labels (case-sensitive), then title-case."""
    trimmed = text.strip(column)
    unified = F.when(trimmed.isin(*no_service_labels), F.lit("No")).otherwise(trimmed)
    return text.title_case(unified)


def normalize_text(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    no_service_labels: Sequence[str] = schema.NO_SERVICE_LABELS,
) -> DataFrame:
    """Normalise every text column, ids included unless excluded."""
    names = [c for c in (text_columns(df) if columns is None else columns) if c not in set(exclude)]
    changed = {c: normalized_text(F.col(c), no_service_labels) for c in names}
    return df.withColumns(changed) if changed else df


def normalization_changes(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    no_service_labels: Sequence[str] = schema.NO_SERVICE_LABELS,
) -> DataFrame:
    """(column, changed): whether normalising changes the set of distinct values.

    With labels whose own normal form is stable, as the default ones, normalising
    twice is normalising once; then the sets differ exactly if some value is not
    its own normal form. That is one aggregation of all columns, without a value
    table. A column without a value does not appear.
    """
    names = text_columns(df) if columns is None else present(df, columns)
    texts = {c: F.col(c).cast("string") for c in names}
    if not names:
        return df.sparkSession.createDataFrame([], "column string, changed boolean")
    one = df.agg(
        *[F.max(t != normalized_text(t, no_service_labels)).alias(f"_{i}") for i, t in enumerate(texts.values())]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("changed")) for i, c in enumerate(names)])
    return one.select(F.inline(rows)).where(F.col("changed").isNotNull())


def sparse_row(columns: Sequence[str], threshold: float) -> Column:
    """True where more than ``threshold`` of the columns are NULL."""
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns])
    return nulls > F.lit(float(threshold) * len(columns))


def drop_sparse_rows(df: DataFrame, threshold: float) -> DataFrame:
    return df.where(~sparse_row(df.columns, threshold))


def fill_missing(
    df: DataFrame,
    strategy: str = "median",
    text_fill: str = schema.TEXT_FILL,
    drop_threshold: float | None = None,
    columns: Sequence[str] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Impute numbers with their median (any other strategy: mean), text with a constant.

    Fill values are computed after sparse rows are dropped. Numeric columns
    come out as double, so the schema does not depend on the data. A numeric
    column without any value stays NULL.
    """
    if drop_threshold is not None:
        df = drop_sparse_rows(df, drop_threshold)
    wanted = set(df.columns if columns is None else columns)
    numbers = [c for c in numeric_columns(df) if c in wanted]
    texts = [c for c in text_columns(df) if c in wanted]
    changed: dict[str, Column] = {c: F.coalesce(F.col(c), F.lit(text_fill)) for c in texts}
    if numbers and strategy == "median":
        medians = quantile_values(df, numbers, [0.5], approximate)
        fills = {c: F.lit(medians[c][0]) if c in medians else F.lit(None) for c in numbers}
    elif numbers:
        row = df.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(c) for c in numbers]).first()
        fills = {c: F.lit(row[c]) for c in numbers}
    else:
        fills = {}
    for c, fill in fills.items():
        changed[c] = F.coalesce(nan_to_null(F.col(c).cast("double")), fill.cast("double"))
    return df.withColumns(changed) if changed else df


def _violations(column: str, rule: Mapping) -> dict[str, Column]:
    c = F.col(column)
    found: dict[str, Column] = {}
    if "allowed" in rule:
        found["invalid_replaced"] = ~c.isin(*rule["allowed"])
        return found
    if rule.get("min") is not None:
        found["below_min"] = c < F.lit(rule["min"])
    if rule.get("max") is not None:
        found["above_max"] = c > F.lit(rule["max"])
    return found


def null_impossible(df: DataFrame, rules: Mapping[str, Mapping] = schema.IMPOSSIBLE_RULES) -> DataFrame:
    """Replace impossible values by NULL: outside a range, or not in an allowed set."""
    changed = {}
    for column in present(df, list(rules)):
        violations = _violations(column, rules[column]).values()
        bad = reduce(lambda a, b: a | b, violations, F.lit(False))
        changed[column] = F.when(bad, F.lit(None)).otherwise(F.col(column))
    return df.withColumns(changed) if changed else df


_IMPOSSIBLE_SCHEMA = "column string, before long, invalid_replaced long, below_min long, above_max long, after long"
_IQR_SCHEMA = "column string, lower_bound double, upper_bound double, lower_capped long, upper_capped long"


def impossible_counts(
    df: DataFrame, rules: Mapping[str, Mapping] = schema.IMPOSSIBLE_RULES
) -> DataFrame:
    """Per column with impossible values: NULLs before and after, and counts per rule."""
    kinds = ("invalid_replaced", "below_min", "above_max")
    columns = present(df, list(rules))
    if not columns:
        return df.sparkSession.createDataFrame([], _IMPOSSIBLE_SCHEMA)
    aggregates = []
    for c in columns:
        violations = _violations(c, rules[c])
        aggregates.append(
            F.struct(
                F.lit(c).alias("column"),
                count_if(F.col(c).isNull()).alias("before"),
                *[count_if(violations.get(k, F.lit(False))).alias(k) for k in kinds],
            ).alias(f"_{c}")
        )
    one = df.agg(*aggregates)
    rows = one.select(F.inline(F.array(*[F.col(f"_{c}") for c in columns])))
    replaced = F.col("invalid_replaced") + F.col("below_min") + F.col("above_max")
    return rows.where(replaced > 0).withColumn("after", F.col("before") + replaced)


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    factor: float = schema.IQR_FACTOR,
    approximate: bool = False,
) -> DataFrame:
    """(by…, column, lower_bound, upper_bound) from the interquartile range."""
    q = exact_quantiles(df, columns, [0.25, 0.75], by, approximate)
    iqr = F.col("quantiles")[1] - F.col("quantiles")[0]
    return q.select(
        *by,
        "column",
        (F.col("quantiles")[0] - factor * iqr).alias("lower_bound"),
        (F.col("quantiles")[1] + factor * iqr).alias("upper_bound"),
    )


def winsorize_iqr(
    df: DataFrame,
    columns: Sequence[str] = schema.OUTLIER_COLUMNS,
    by: Sequence[str] = (),
    factor: float = schema.IQR_FACTOR,
    approximate: bool = False,
) -> DataFrame:
    """Cap columns to their IQR bounds, over the whole table or within groups."""
    columns = present(df, columns)
    if not columns:
        return df
    bounds = iqr_bounds(df, columns, by, factor, approximate)
    if not by:
        # One row per column: plain literals in the plan.
        limits = {r["column"]: (r["lower_bound"], r["upper_bound"]) for r in bounds.collect()}
        return df.withColumns(
            {c: clip(F.col(c), F.lit(lo), F.lit(hi)) for c, (lo, hi) in limits.items()}
        )
    wide = bounds.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("column") == c, F.struct("lower_bound", "upper_bound"))).alias(f"_b_{c}")
            for c in columns
        ]
    )
    table = lookup(wide).alias("b")
    same = reduce(lambda a, b: a & b, [F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}")) for k in by])
    joined = df.alias("d").join(table, same, "left")
    capped = {
        c: clip(F.col(f"d.{c}"), F.col(f"b._b_{c}.lower_bound"), F.col(f"b._b_{c}.upper_bound"))
        for c in columns
    }
    return joined.select(*[capped.get(c, F.col(f"d.{c}")).alias(c) for c in df.columns])


def iqr_report(
    df: DataFrame,
    columns: Sequence[str] = schema.OUTLIER_COLUMNS,
    factor: float = schema.IQR_FACTOR,
    approximate: bool = False,
) -> DataFrame:
    """Per capped column: lower_bound, upper_bound, lower_capped, upper_capped."""
    columns = present(df, columns)
    bounds = iqr_bounds(df, columns, (), factor, approximate).collect() if columns else []
    if not bounds:  # no such column, or only NULLs in them
        return df.sparkSession.createDataFrame([], _IQR_SCHEMA)
    counted = df.agg(
        *[
            F.struct(
                F.lit(r["column"]).alias("column"),
                F.lit(r["lower_bound"]).alias("lower_bound"),
                F.lit(r["upper_bound"]).alias("upper_bound"),
                count_if(F.col(r["column"]) < r["lower_bound"]).alias("lower_capped"),
                count_if(F.col(r["column"]) > r["upper_bound"]).alias("upper_capped"),
            ).alias(f"_{r['column']}")
            for r in bounds
        ]
    )
    rows = counted.select(F.inline(F.array(*[F.col(f"_{r['column']}") for r in bounds])))
    return rows.where((F.col("lower_capped") > 0) | (F.col("upper_capped") > 0))
