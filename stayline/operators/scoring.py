"""Decisions, risk bands, lineage and enrichment of scored batches."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from stayline import schema
from stayline.functions.numeric import nan_to_null
from stayline.functions.times import utc_literal
from stayline.operators.columns import require


def risk_group(
    probability: Column, low: float = schema.RISK_LOW, high: float = schema.RISK_HIGH
) -> Column:
    """High at or above ``high``, Medium at or above ``low``, else Low; missing is Low."""
    usable = ~F.isnan(probability)
    return (
        F.when(usable & (probability >= high), "High")
        .when(usable & (probability >= low), "Medium")
        .otherwise("Low")
    )


def add_decision(
    df: DataFrame,
    probability: str = "churn_probability",
    threshold: float = schema.DECISION_THRESHOLD,
    low: float = schema.RISK_LOW,
    high: float = schema.RISK_HIGH,
) -> DataFrame:
    """``churn_prediction`` 1/0, ``churn_label`` Yes/No and ``risk_group``."""
    p = F.col(probability)
    churns = F.coalesce(~F.isnan(p) & (p >= threshold), F.lit(False))
    return df.withColumns(
        {
            "churn_prediction": churns.cast("int"),
            "churn_label": F.when(churns, "Yes").otherwise("No"),
            "risk_group": risk_group(p, low, high),
        }
    )


def batch_id(at: datetime) -> str:
    """Compact id of a batch started at ``at``."""
    return at.strftime("%Y%m%dT%H%M%S")


def batch_id_column(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyyMMdd'T'HHmmss")


def add_metadata(
    df: DataFrame, model_uri: str, batch: str, at: datetime, model_version: int | None = None
) -> DataFrame:
    """Lineage columns; one timestamp, fixed by the caller, for the whole batch."""
    return df.withColumns(
        {
            "prediction_timestamp": utc_literal(at),
            "model_uri": F.lit(model_uri),
            "model_version": F.lit(model_version).cast("int"),
            "batch_id": F.lit(batch),
        }
    )


def probability_columns(df: DataFrame, prefix: str = schema.PROBABILITY_PREFIX) -> list[str]:
    """Per-model score columns; the primary's own column has no model suffix."""
    return [c for c in df.columns if c.startswith(prefix)]


def probabilities_long(df: DataFrame, id_column: str = schema.ID_COLUMN) -> DataFrame:
    """(id, model, probability): one row per customer and model."""
    names = probability_columns(df)
    short = [F.col(c).alias(c.removeprefix(schema.PROBABILITY_PREFIX)) for c in names]
    models = [c.removeprefix(schema.PROBABILITY_PREFIX) for c in names]
    return df.select(id_column, *short).unpivot([id_column], models, "model", "probability")


def probability_spread(columns: Sequence[str]) -> Column:
    """Largest minus smallest score of a customer; NULL and NaN are no scores."""
    scores = [nan_to_null(F.col(c)) for c in columns]
    if len(scores) == 1:
        return scores[0] - scores[0]
    return F.greatest(*scores) - F.least(*scores)


def uri_parts(uri: Column) -> Column:
    """Struct of name, alias and version of a ``models:/`` uri; NULL for other forms."""
    by_alias = r"^models:/([^@/]+)@(.+)$"
    by_version = r"^models:/([^@/]+)/(.+)$"
    alias = uri.rlike(by_alias)
    version = uri.rlike(by_version)
    return F.when(
        alias | version,
        F.struct(
            F.when(alias, F.regexp_extract(uri, by_alias, 1))
            .otherwise(F.regexp_extract(uri, by_version, 1))
            .alias("name"),
            F.when(alias, F.regexp_extract(uri, by_alias, 2)).alias("alias"),
            F.when(version, F.regexp_extract(uri, by_version, 2)).alias("version"),
        ),
    )


def feature_projection(
    df: DataFrame,
    id_columns: Sequence[str] = (schema.ID_COLUMN,),
    target: str = schema.TARGET_COLUMN,
    strict: bool = False,
) -> DataFrame:
    """Drop ids and target. ``strict`` requires them, for training; inference tolerates their absence."""
    if strict:
        require(df, [*id_columns, target])
    return df.drop(*id_columns, target)


def enrich(
    predictions: DataFrame,
    source: DataFrame | None,
    id_column: str = schema.ID_COLUMN,
    target: str = schema.TARGET_COLUMN,
) -> DataFrame:
    """Attach each scored customer's cleaned row; source columns come first.

    Every scored row is kept. ``churn_actual`` holds the source's target. An ordinal
    among the scored columns passes through, to restore the batch's order at the sink
    (``functions/ordinal.py``). The join side to broadcast, if any, is left to Spark,
    since either table may be the large one.
    """
    if source is None:
        return predictions
    renamed = source.withColumnRenamed(target, "churn_actual")
    ours = [c for c in predictions.columns if c != id_column]
    return predictions.join(renamed, id_column, "left").select(*renamed.columns, *ours)


def unmatched(predictions: DataFrame, source: DataFrame, id_column: str = schema.ID_COLUMN) -> DataFrame:
    """One row, ``unmatched``: scored customers without a labelled source row."""
    labelled = source.where(F.col(schema.TARGET_COLUMN).isNotNull()).select(id_column)
    return predictions.join(labelled, id_column, "left_anti").agg(F.count(F.lit(1)).alias("unmatched"))


