"""Exploratory statistics by demographic group and number of services.

Groups with a NULL key are left out, as is usual for such statistics; a count
of a column skips NULL while a group size does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stayline.functions.numeric import nan_to_null, round_to
from stayline.functions.quantiles import exact_quantiles
from stayline.functions.text import to_number
from stayline.operators.services import (
    DEMOGRAPHICS,
    SENIOR_LABEL,
    YES_NO_LABEL,
    demographic_label,
    money_label,
    recode,
    recode_demographics,
    service_flags,
)
from stayline.session import lookup


def prepared(raw: DataFrame) -> DataFrame:
    """Raw extract with recoded demographics, service counts and numeric totals."""
    return service_flags(recode_demographics(raw)).withColumn(
        "TotalCharges", to_number(F.col("TotalCharges"))
    )


def grouped(df: DataFrame, keys: Sequence[str], *aggregates) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*aggregates)


def demographic_groups(df: DataFrame) -> DataFrame:
    """Customers, mean services and charges, and revenue per demographic group."""
    return grouped(
        df,
        DEMOGRAPHICS,
        F.count("customerID").alias("customer_count"),
        round_to(F.avg("total_services"), 2).alias("avg_services"),
        round_to(F.avg("MonthlyCharges"), 2).alias("avg_monthly_charges"),
        round_to(F.avg("TotalCharges"), 2).alias("avg_total_charges"),
        round_to(F.coalesce(F.sum("TotalCharges"), F.lit(0.0)), 2).alias("total_revenue"),
    )


def demographic_services(df: DataFrame) -> DataFrame:
    """Mean services per labelled demographic group, from the grouped table."""
    labelled = demographic_groups(df).withColumn("demo_label", demographic_label())
    return grouped(labelled, [*DEMOGRAPHICS, "demo_label"], F.avg("avg_services").alias("avg_services"))


def partner_dependents(df: DataFrame) -> DataFrame:
    """Mean services by partner and dependents, with readable labels."""
    stats = grouped(df, ["Partner", "Dependents"], F.avg("total_services").alias("mean_services"))
    return stats.withColumns(
        {c: recode(F.col(c), YES_NO_LABEL) for c in ("Partner", "Dependents")}
    )


def senior_statistics(df: DataFrame) -> DataFrame:
    """Mean services and charges of senior and other customers."""
    stats = grouped(
        df,
        ["SeniorCitizen"],
        F.avg("total_services").alias("mean_services"),
        F.avg("MonthlyCharges").alias("mean_monthly"),
        F.avg("TotalCharges").alias("mean_total"),
    )
    return stats.withColumn("SeniorCitizen", recode(F.col("SeniorCitizen"), SENIOR_LABEL))


def revenue_ranking(df: DataFrame) -> DataFrame:
    """Revenue per demographic group with labels, highest first."""
    totals = grouped(
        df, DEMOGRAPHICS, F.coalesce(F.sum("TotalCharges"), F.lit(0.0)).alias("total_charges")
    )
    return totals.withColumns(
        {"demo_label": demographic_label(), "money_label": money_label(F.col("total_charges"))}
    ).orderBy(F.desc("total_charges"), *DEMOGRAPHICS)


def monthly_by_services(df: DataFrame) -> DataFrame:
    return grouped(
        df, ["total_services"], F.avg("MonthlyCharges").alias("mean_monthly_charges")
    ).orderBy("total_services")


def tenure_by_services(df: DataFrame, value: str = "tenure") -> DataFrame:
    """Mean, exact median and size of ``value`` per number of services."""
    rows = df.dropna(subset=["total_services"])
    stats = rows.groupBy("total_services").agg(
        F.avg(value).alias(f"mean_{value}"), F.count(F.lit(1)).alias("count")
    )
    medians = exact_quantiles(rows, [value], [0.5], ["total_services"]).select(
        "total_services", F.col("quantiles")[0].alias(f"median_{value}")
    )
    return stats.join(medians, "total_services", "left").orderBy("total_services")


def mean_interval(df: DataFrame, value: str, by: Sequence[str], z: float = 1.96) -> DataFrame:
    """Mean with a normal 95 % interval per group; undefined for fewer than two values."""
    stats = grouped(
        df,
        by,
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("_sd"),
    )
    half = F.when(F.col("n") > 1, z * F.col("_sd") / F.sqrt(F.col("n")))
    return stats.select(
        *by, "n", "mean", (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high")
    )


def quartiles(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Count and exact quartiles of ``value`` per group, missing values left out."""
    rows = df.dropna(subset=list(by))
    return exact_quantiles(rows, [value], [0.25, 0.5, 0.75], by).select(
        *by,
        "n",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )


def box_statistics(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers and outlier count per group.

    A whisker is the most extreme value within 1.5 interquartile ranges of the box.
    """
    rows = df.dropna(subset=list(by)).select(*by, nan_to_null(F.col(value).cast("double")).alias("_v"))
    rows = rows.where(F.col("_v").isNotNull())
    boxes = quartiles(rows, "_v", by)
    iqr = F.col("q3") - F.col("q1")
    fenced = boxes.withColumns({"_low": F.col("q1") - 1.5 * iqr, "_high": F.col("q3") + 1.5 * iqr})
    joined = rows.join(lookup(fenced), list(by))
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    return joined.groupBy(*by, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("n_outliers"),
    )


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``column`` values per ``row`` value, 0 for empty cells."""
    return (
        df.dropna(subset=[row, column])
        .groupBy(row)
        .agg(*[F.count(F.when(F.col(column) == v, 1)).alias(str(v)) for v in values])
    )


def scatter_points(df: DataFrame) -> DataFrame:
    """Services, total charges and label of every customer with all three."""
    return (
        df.withColumn("demo_label", demographic_label())
        .select("total_services", "TotalCharges", "demo_label")
        .dropna()
    )


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 10) -> DataFrame:
    return df.orderBy(*order_by).limit(rows)


