"""Data-quality reports: schema inspection, validation, batch contract, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stayline import schema
from stayline.functions import text
from stayline.functions.numeric import count_if, nan_to_null, ratio
from stayline.functions.quantiles import exact_quantiles
from stayline.operators.columns import (
    null_counts,
    numeric_columns,
    present,
    value_frequencies,
)
from stayline.session import lookup

FINDING = "check string, column string, severity string, observed double, expected double, detail string"


# -- schema inspection -------------------------------------------------------


def inspect_schema(df: DataFrame) -> DataFrame:
    """One row per text column: distinct values, their ratio, numeric readings, kind.

    ``kind`` is ``numeric_as_text`` when more than half of the rows read as
    numbers, else ``categorical`` when the distinct ratio is below 0.05 or at
    most 10 values occur, else NULL. An empty table has ratio 0.
    """
    values = value_frequencies(df)
    numeric = text.is_number(F.col("value"))
    known = F.col("value").isNotNull()
    stats = values.groupBy("column").agg(
        F.sum("n").alias("rows"),
        count_if(known).alias("distinct_values"),
        F.coalesce(F.sum(F.when(numeric, F.col("n"))), F.lit(0)).alias("numeric_values"),
        F.coalesce(F.sum(F.when(known & ~numeric, F.col("n"))), F.lit(0)).alias("failed_conversions"),
    )
    unique_ratio = ratio(F.col("distinct_values"), F.col("rows"))
    kind = F.when(F.col("numeric_values") > F.col("rows") * 0.5, "numeric_as_text").when(
        (unique_ratio < 0.05) | (F.col("distinct_values") <= 10), "categorical"
    )
    return stats.withColumns({"unique_ratio": unique_ratio, "kind": kind})


def categorical_values(df: DataFrame) -> DataFrame:
    """(column, value, n) for the columns that inspection calls categorical."""
    candidates = inspect_schema(df).where(F.col("kind") == "categorical").select("column")
    return value_frequencies(df).join(lookup(candidates), "column", "left_semi")


# -- validation --------------------------------------------------------------


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row, ``duplicate_rows``: how many rows repeat an earlier one.

    Only an 8-byte hash and its count are shuffled for the whole table. Rows
    whose hash occurs more than once are then compared in full, so the result
    is exact and a table without duplicates never shuffles its rows.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    repeated = (
        hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_hash")
    )
    suspects = hashed.join(lookup(repeated), "_hash", "left_semi").drop("_hash")
    groups = suspects.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return groups.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("duplicate_rows"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: ``rows``, ``distinct_keys`` (NULL not counted), ``repeats`` (NULL counted)."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(key).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeats"),
    )


def unexpected_values(
    df: DataFrame, expected: Mapping[str, Sequence[str]] = schema.EXPECTED_VALUES
) -> DataFrame:
    """(column, value, n) of title-cased values that are not in the expected set."""
    columns = present(df, list(expected))
    values = value_frequencies(df, columns).where(F.col("value").isNotNull())
    titled = values.withColumn("value", text.title_case(F.col("value")))
    allowed = reduce(
        lambda a, b: a | b,
        [
            (F.col("column") == c) & F.col("value").isin(*[_title(v) for v in expected[c]])
            for c in columns
        ],
        F.lit(False),
    )
    return titled.where(~allowed).groupBy("column", "value").agg(F.sum("n").alias("n"))


def _title(value: str) -> str:
    return value.title()


def _finding(check, column, severity, observed, expected=None, detail=None):
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        F.lit(severity).alias("severity"),
        observed.cast("double").alias("observed"),
        F.lit(expected).cast("double").alias("expected"),
        F.lit(detail).cast("string").alias("detail"),
    )


def validation_report(
    df: DataFrame,
    id_column: str = schema.ID_COLUMN,
    ranges: Mapping[str, tuple] = schema.NUMERIC_RANGES,
    expected_values: Mapping[str, Sequence[str]] = schema.EXPECTED_VALUES,
    expected_types: Mapping[str, Sequence[str]] = schema.EXPECTED_TYPES,
    services: str = "total_services",
) -> DataFrame:
    """One row per finding: check, column, severity, observed, expected, detail.

    Missing values, values below the range and repeated ids are issues; wrong
    types, values above the range, unexpected labels and duplicate rows are
    warnings. The service count is checked again on its own. Never raises.
    """
    spark = df.sparkSession
    ranged = present(df, list(ranges))
    stats = df.agg(
        *[count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns],
        *[F.min(nan_to_null(F.col(c).cast("double"))).alias(f"min_{c}") for c in ranged],
        *[F.max(nan_to_null(F.col(c).cast("double"))).alias(f"max_{c}") for c in ranged],
    )
    tests = [(F.col(f"null_{c}") > 0, _finding("missing_values", c, "issue", F.col(f"null_{c}"))) for c in df.columns]
    for c in ranged:
        low, high = ranges[c]
        smallest, largest = F.col(f"min_{c}"), F.col(f"max_{c}")
        tests.append((smallest < low, _finding("below_minimum", c, "issue", smallest, low)))
        tests.append((largest > high, _finding("above_maximum", c, "warning", largest, high)))
        if c == services:
            tests.append((smallest < low, _finding("services_negative", c, "issue", smallest, low)))
            tests.append((largest > high, _finding("services_above_limit", c, "warning", largest, high)))
    findings = stats.select(
        F.inline(F.filter(F.array(*[F.when(t, f) for t, f in tests]), lambda x: x.isNotNull()))
    )

    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wrong = [
        ("type", c, "warning", None, None, actual[c])
        for c, types in expected_types.items()
        if c in actual and actual[c] not in types
    ]
    parts = [findings]
    if wrong:
        parts.append(spark.createDataFrame(wrong, FINDING))
    if present(df, list(expected_values)):
        odd = unexpected_values(df, expected_values).groupBy("column").agg(F.count(F.lit(1)).alias("k"))
        parts.append(
            odd.select(
                F.lit("unexpected_values").alias("check"),
                "column",
                F.lit("warning").alias("severity"),
                F.col("k").cast("double").alias("observed"),
                F.lit(None).cast("double").alias("expected"),
                F.lit(None).cast("string").alias("detail"),
            )
        )
    repeats = duplicate_rows(df).where(F.col("duplicate_rows") > 0)
    parts.append(
        repeats.select(F.inline(F.array(_finding("duplicate_rows", None, "warning", F.col("duplicate_rows")))))
    )
    if id_column in actual:
        ids = repeated_keys(df, id_column).where(F.col("distinct_keys") != F.col("rows"))
        parts.append(
            ids.select(
                F.lit("id_not_unique").alias("check"),
                F.lit(id_column).alias("column"),
                F.lit("issue").alias("severity"),
                F.col("distinct_keys").cast("double").alias("observed"),
                F.col("rows").cast("double").alias("expected"),
                F.lit(None).cast("string").alias("detail"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def validation_summary(df: DataFrame, **rules) -> DataFrame:
    """One row: is_valid, issue and warning counts, and the four table counts."""
    report = validation_report(df, **rules)
    counted = report.agg(
        count_if(F.col("severity") == "issue").alias("issues"),
        count_if(F.col("severity") == "warning").alias("warnings"),
        count_if(F.col("check") == "missing_values").alias("missing_value_columns"),
        F.coalesce(
            F.max(F.when(F.col("check") == "duplicate_rows", F.col("observed"))), F.lit(0)
        ).cast("bigint").alias("duplicate_rows"),
    )
    rows = df.agg(F.count(F.lit(1))).scalar()
    return counted.select(
        (F.col("issues") == 0).alias("is_valid"),
        "issues",
        "warnings",
        rows.alias("total_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        "missing_value_columns",
        "duplicate_rows",
    )


# -- batch contract ----------------------------------------------------------


def batch_checks(
    df: DataFrame,
    id_column: str = schema.ID_COLUMN,
    features: Sequence[str] = schema.FEATURES,
) -> DataFrame:
    """Four rows in the order they are enforced: position, check, passed, observed.

    ``observed`` is the row count, the missing id columns, the missing feature
    columns and the repeated ids.
    """
    has_id = id_column in df.columns
    missing = len([c for c in features if c not in set(df.columns)])
    if has_id:
        counts = repeated_keys(df, id_column)
    else:
        counts = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("repeats", F.lit(None).cast("bigint"))
    checks = [
        ("not_empty", F.col("rows") > 0, F.col("rows")),
        ("id_present", F.lit(has_id), F.lit(0 if has_id else 1)),
        ("features_present", F.lit(missing == 0), F.lit(missing)),
        ("ids_unique", F.col("repeats") == 0, F.col("repeats")),
    ]
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(name).alias("check"),
                        passed.alias("passed"),
                        seen.cast("bigint").alias("observed"),
                    )
                    for i, (name, passed, seen) in enumerate(checks, start=1)
                ]
            )
        )
    )


def validate_batch(
    df: DataFrame,
    id_column: str = schema.ID_COLUMN,
    features: Sequence[str] = schema.FEATURES,
) -> DataFrame:
    """Return the table, or raise on the first failed batch check."""
    failed = (
        batch_checks(df, id_column, features)
        .where(~F.coalesce(F.col("passed"), F.lit(True)))
        .orderBy("position")
        .first()
    )
    if failed is not None:
        raise ValueError(f"batch check failed: {failed['check']} (observed {failed['observed']})")
    return df


# -- profiles ----------------------------------------------------------------


def column_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per column: type, rows, nulls, distinct, range, mean, deviation, quartiles, top value.

    ``by`` gives the same profile per group, for a comparison by target. Two
    shuffles in all: the value table and the bracketed quantiles.
    """
    columns = [c for c in df.columns if c not in set(by)]
    numbers = [c for c in numeric_columns(df) if c not in set(by)]
    texts = df.select(*by, *[F.col(c).cast("string").alias(c) for c in columns])
    values = (
        texts.unpivot(list(by), columns, "column", "value")
        .groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = F.col("value").isNotNull()
    general = values.groupBy(*by, "column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
        count_if(known).alias("distinct_values"),
        F.min(F.when(known, F.struct((-F.col("n")).alias("m"), F.col("value").alias("v")))).alias("_top"),
    )
    kinds = F.create_map(
        *[F.lit(x) for f in df.schema if f.name in columns for x in (f.name, f.dataType.simpleString())]
    )
    general = general.select(
        *by,
        "column",
        kinds[F.col("column")].alias("type"),
        "rows",
        "nulls",
        "distinct_values",
        F.col("_top.v").alias("top_value"),
        (-F.col("_top.m")).alias("top_count"),
    )
    moments = (
        df.select(*by, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in numbers])
        .unpivot(list(by), numbers, "column", "value")
        .groupBy(*by, "column")
        .agg(
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("stddev"),
        )
    )
    quartiles = exact_quantiles(df, numbers, [0.25, 0.5, 0.75], by).select(
        *by,
        "column",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )
    def attach(left: DataFrame, right: DataFrame) -> DataFrame:
        keys = [*by, "column"]
        same = reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
        rest = [c for c in right.columns if c not in keys]
        return left.alias("a").join(right.alias("b"), same, "left").select("a.*", *[f"b.{c}" for c in rest])

    return attach(attach(general, moments), quartiles)


def null_report(df: DataFrame) -> DataFrame:
    """NULLs per column plus their total in a row named ``*``."""
    per_column = null_counts(df)
    return per_column.unionByName(
        per_column.agg(F.sum("nulls").alias("nulls")).withColumn("column", F.lit("*"))
    )


