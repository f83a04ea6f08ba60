"""The cleaning job: raw extract to canonical table, with its change log."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stayline.operators import clean, quality, services
from stayline.session import staged


@dataclass(frozen=True)
class CleaningResult:
    """Lazy outputs of the cleaning job."""

    cleaned: DataFrame
    log: DataFrame


def typed(raw: DataFrame) -> DataFrame:
    """Standard names and numeric types."""
    return clean.coerce_numeric(clean.standardize_columns(raw))


def _staged_normal(raw: DataFrame) -> DataFrame:
    # The only full-row shuffle. Its result is written once, because two quantile
    # barriers and the final projection follow, each reading few columns.
    return staged(clean.normalize_text(clean.remove_duplicates(typed(raw))), "normalized")


def _finish(normal: DataFrame, approximate: bool):
    filled = clean.fill_missing(normal, approximate=approximate)
    possible = clean.null_impossible(filled)
    capped = clean.winsorize_iqr(possible, approximate=approximate)
    return filled, possible, services.total_services(capped)


def clean_customers(raw: DataFrame, approximate: bool = False) -> DataFrame:
    """Names, types, duplicates, labels, imputation, impossible values, outliers, services.

    The order matters: values found impossible are not imputed again, and the
    outlier bounds ignore them. Text keeps the declared domain of
    :data:`stayline.schema.DOMAIN_COLUMNS`; model-specific encoding happens later.
    """
    return _finish(_staged_normal(raw), approximate)[2]


def clean_with_log(raw: DataFrame, approximate: bool = False) -> CleaningResult:
    """The cleaned table and its change log.

    The log is one row per fact: step, column, metric, value. Row counts before and
    after deduplication are read from a column of the written deduplicated table, so
    the source is scanned once. (An ``Observation`` would leave the session with a
    part that no task can serialise, and summaries of fitted models carry their session.)
    """
    counted = staged(clean.normalize_text(clean.distinct_with_copies(typed(raw))), "normalized")
    copies = F.coalesce(F.sum("_copies"), F.lit(0))
    rows, distinct = counted.agg(copies, F.count(F.lit(1))).first()
    filled, possible, result = _finish(counted.drop("_copies"), approximate)
    spark = raw.sparkSession

    def entries(df: DataFrame, step: str, *metrics: str, column: str | None = "column") -> DataFrame:
        name = F.col(column) if column else F.lit(None).cast("string")
        wide = df.select(
            F.lit(step).alias("step"), name.alias("column"), *[F.col(m).cast("double").alias(m) for m in metrics]
        )
        return wide.unpivot(["step", "column"], list(metrics), "metric", "value")

    facts = [
        ("initial_shape", "rows", rows),
        ("initial_shape", "columns", len(raw.columns)),
        ("remove_duplicates", "initial_rows", rows),
        ("remove_duplicates", "duplicates_removed", rows - distinct),
        ("remove_duplicates", "final_rows", distinct),
        ("final_shape", "rows", distinct),
        ("final_shape", "columns", len(result.columns)),
    ]
    observed = spark.createDataFrame(
        [(step, None, metric, float(value)) for step, metric, value in facts],
        "step string, column string, metric string, value double",
    )
    final_columns = spark.createDataFrame(
        [("final_columns", c, "position", float(i)) for i, c in enumerate(result.columns, start=1)],
        "step string, column string, metric string, value double",
    )
    summary = quality.validation_summary(result).withColumn("is_valid", F.col("is_valid").cast("int"))
    parts = [
        observed,
        entries(
            clean.impossible_counts(filled), "impossible_values", "before", "invalid_replaced", "below_min",
            "above_max", "after",
        ),
        entries(
            clean.iqr_report(possible, approximate=approximate), "outliers_capped", "lower_bound",
            "upper_bound", "lower_capped", "upper_capped",
        ),
        entries(
            summary, "validation", "is_valid", "issues", "warnings", "missing_value_columns",
            "duplicate_rows", column=None,
        ),
        final_columns,
    ]
    return CleaningResult(result, reduce(DataFrame.unionByName, parts))


CLEANED_SCHEMA = (
    "customer_id string, gender string, senior_citizen double, partner string, dependents string, "
    "tenure double, phone_service string, multiple_lines string, internet_service string, "
    "online_security string, online_backup string, device_protection string, tech_support string, "
    "streaming_tv string, streaming_movies string, contract string, paperless_billing string, "
    "payment_method string, monthly_charges double, total_charges double, churn string, total_services int"
)
