"""Service counts, recoded demographics and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stayline import schema
from stayline.operators.columns import present

# Demographic codes and their labels.
GENDER_CODES = {"Female": 1, "Male": 0}
YES_NO_CODES = {"Yes": 1, "No": 0}
GENDER_MARK = {1: "F", 0: "M"}
SENIOR_MARK = {1: "Sr", 0: "Jr"}
PARTNER_MARK = {1: "P", 0: "NP"}
DEPENDENTS_MARK = {1: "D", 0: "ND"}
SENIOR_LABEL = {0: "Non-Senior", 1: "Senior"}
YES_NO_LABEL = {1: "Yes", 0: "No"}
GENDER_LABEL = {1: "Female", 0: "Male"}

DEMOGRAPHICS = ("gender", "SeniorCitizen", "Partner", "Dependents")


def recode(column: Column, mapping: Mapping) -> Column:
    """Replace values by a short fixed mapping; anything unmapped becomes NULL."""
    result = None
    for key, value in mapping.items():
        hit = column == F.lit(key)
        result = F.when(hit, F.lit(value)) if result is None else result.when(hit, F.lit(value))
    return result


def total_services(
    df: DataFrame,
    columns: Sequence[str] = schema.SERVICE_COLUMNS,
    name: str = "total_services",
) -> DataFrame:
    """Count the service columns whose value is not "no" in any case.

    A missing value counts as a service. Without any service column the table
    is returned unchanged.
    """
    columns = present(df, columns)
    if not columns:
        return df
    flags = [F.when(F.lower(F.col(c)) == "no", 0).otherwise(1) for c in columns]
    return df.withColumn(name, reduce(lambda a, b: a + b, flags))


def service_flags(
    df: DataFrame,
    columns: Sequence[str] = schema.RAW_SERVICE_COLUMNS,
    absent: Sequence[str] = ("No", *schema.NO_SERVICE_LABELS),
    name: str = "total_services",
) -> DataFrame:
    """``<column>_flag`` per raw service column and their sum; NULL counts as a service."""
    flags = {f"{c}_flag": F.when(F.col(c).isin(*absent), 0).otherwise(1) for c in columns}
    return df.withColumns(flags).withColumn(
        name, reduce(lambda a, b: a + b, [F.col(f) for f in flags])
    )


def recode_demographics(df: DataFrame) -> DataFrame:
    """Gender, partner and dependents as 1/0; unmapped labels become NULL."""
    return df.withColumns(
        {
            "gender": recode(F.col("gender"), GENDER_CODES),
            "Partner": recode(F.col("Partner"), YES_NO_CODES),
            "Dependents": recode(F.col("Dependents"), YES_NO_CODES),
        }
    )


def demographic_label() -> Column:
    """``F/Sr/P/D`` style label of recoded demographics; NULL if any part is NULL."""
    parts = [
        recode(F.col("gender"), GENDER_MARK),
        recode(F.col("SeniorCitizen"), SENIOR_MARK),
        recode(F.col("Partner"), PARTNER_MARK),
        recode(F.col("Dependents"), DEPENDENTS_MARK),
    ]
    slashed = [parts[0]] + [x for p in parts[1:] for x in (F.lit("/"), p)]
    return F.concat(*slashed)


def money_label(value: Column) -> Column:
    """Amount in whole thousands, such as ``$12K``."""
    return F.concat(F.lit("$"), F.round(value / 1000, 0).cast("bigint").cast("string"), F.lit("K"))
