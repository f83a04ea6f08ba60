"""Model comparison, per-customer agreement and batch summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stayline import schema
from stayline.functions.numeric import count_if, nan_to_null, ratio
from stayline.functions.quantiles import exact_quantiles
from stayline.operators.scoring import probability_columns, probability_spread, risk_group


def _votes(columns, threshold: float) -> dict[str, Column]:
    return {c: F.coalesce(F.col(c) >= threshold, F.lit(False)) for c in columns}


def _vote_count(votes: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a + b, [v.cast("int") for v in votes.values()])


def _usable(predictions: DataFrame, *columns: str) -> DataFrame:
    """``predictions`` with NaN scores as NULL: no score, hence no vote and no part in a mean."""
    return predictions.withColumns({c: nan_to_null(F.col(c)) for c in columns})


def customer_agreement(
    predictions: DataFrame,
    threshold: float = schema.DECISION_THRESHOLD,
    id_column: str = schema.ID_COLUMN,
) -> DataFrame:
    """Per customer: churn votes, lowest and highest score, spread, agreement, majority.

    A score that is NULL or NaN is no vote for churn.
    """
    columns = _required(predictions)
    predictions = _usable(predictions, *columns)
    count = _vote_count(_votes(columns, threshold))
    scores = [F.col(c) for c in columns]
    low = F.least(*scores) if len(scores) > 1 else scores[0]
    high = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return predictions.select(
        id_column,
        count.alias("churn_votes"),
        low.alias("min_probability"),
        high.alias("max_probability"),
        (high - low).alias("probability_spread"),
        F.when(count == len(columns), "all_churn")
        .when(count == 0, "all_no_churn")
        .otherwise("disagree")
        .alias("agreement"),
        (count * 2 > len(columns)).alias("consensus_churn"),
    )


def _required(predictions: DataFrame) -> list[str]:
    columns = probability_columns(predictions)
    if not columns:
        raise ValueError(f"no '{schema.PROBABILITY_PREFIX}*' column to compare")
    return columns


def model_comparison(
    predictions: DataFrame,
    lineage: DataFrame | None = None,
    threshold: float = schema.DECISION_THRESHOLD,
    low: float = schema.RISK_LOW,
    high: float = schema.RISK_HIGH,
    approximate: bool = False,
) -> DataFrame:
    """One row per model: lineage, distribution, churn and risk counts, agreement.

    Batch-level agreement repeats on every row in ``batch_*`` columns. A tie of
    an even number of models is no churn. All counts of all models come from
    one aggregation; only the exact medians need a pass of their own.
    ``lineage`` holds model, model_uri, model_version.
    """
    columns = _required(predictions)
    predictions = _usable(predictions, *columns)
    votes = _votes(columns, threshold)
    count = _vote_count(votes)
    consensus = count * 2 > len(columns)
    per_model = [
        F.struct(
            F.lit(c.removeprefix(schema.PROBABILITY_PREFIX)).alias("model"),
            F.avg(c).alias("mean_churn_probability"),
            count_if(votes[c]).alias("n_predicted_churn"),
            *[
                count_if(risk_group(F.col(c), low, high) == g).alias(f"risk_{g.lower()}")
                for g in schema.RISK_GROUPS
            ],
            count_if(votes[c] == consensus).alias("_agreeing"),
        )
        for c in columns
    ]
    one = predictions.agg(
        F.count(F.lit(1)).alias("batch_n_customers"),
        count_if(count == len(columns)).alias("batch_all_agree_churn"),
        count_if(count == 0).alias("batch_all_agree_no_churn"),
        F.avg(probability_spread(columns)).alias("batch_mean_probability_spread"),
        *[s.alias(f"_{i}") for i, s in enumerate(per_model)],
    )
    batch = [c for c in one.columns if c.startswith("batch_")]
    rows = one.select(*batch, F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))
    short = predictions.select(
        *[F.col(c).alias(c.removeprefix(schema.PROBABILITY_PREFIX)) for c in columns]
    )
    medians = exact_quantiles(short, short.columns, [0.5], approximate=approximate).select(
        F.col("column").alias("model"), F.col("quantiles")[0].alias("median_churn_probability")
    )
    result = rows.join(medians, "model", "left")
    if lineage is None:
        uri, version = F.lit(None).cast("string"), F.lit(None).cast("int")
    else:
        result = result.join(lineage.select("model", "model_uri", "model_version"), "model", "left")
        uri, version = F.col("model_uri"), F.col("model_version")
    customers = F.col("batch_n_customers")
    agreed = F.col("batch_all_agree_churn") + F.col("batch_all_agree_no_churn")
    return result.select(
        "model",
        uri.alias("model_uri"),
        version.alias("model_version"),
        "mean_churn_probability",
        "median_churn_probability",
        "n_predicted_churn",
        ratio(F.col("n_predicted_churn"), customers).alias("churn_rate"),
        *[f"risk_{g.lower()}" for g in schema.RISK_GROUPS],
        ratio(F.col("_agreeing"), customers).alias("agreement_with_consensus"),
        "batch_n_customers",
        "batch_all_agree_churn",
        "batch_all_agree_no_churn",
        (customers - agreed).alias("batch_disagree"),
        ratio(agreed, customers).alias("batch_agreement_rate"),
        "batch_mean_probability_spread",
    )


def batch_summary(predictions: DataFrame, output_path: str | None = None) -> DataFrame:
    """(metric, key, value): customers, churners, risk split, mean scores, segment sizes."""
    models = probability_columns(predictions)
    predictions = _usable(predictions, "churn_probability", *models)

    def entry(metric: str, value: Column, key: str | None = None) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            F.lit(key).cast("string").alias("key"),
            value.cast("double").alias("value"),
        )

    wide = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("churn_prediction"), F.lit(0)).alias("churners"),
        F.avg("churn_probability").alias("mean"),
        *[count_if(F.col("risk_group") == g).alias(f"risk_{g}") for g in schema.RISK_GROUPS],
        *[F.avg(c).alias(f"mean_{c}") for c in models],
    )
    entries = [
        entry("n_customers", F.col("n")),
        entry("n_predicted_churn", F.col("churners")),
        entry("avg_churn_probability", F.col("mean")),
        *[entry("risk_group", F.col(f"risk_{g}"), g) for g in schema.RISK_GROUPS],
        *[
            entry("avg_churn_probability_per_model", F.col(f"mean_{c}"), c.removeprefix(schema.PROBABILITY_PREFIX))
            for c in models
        ],
    ]
    if output_path is not None:
        entries.append(entry("output_path", F.lit(None), output_path))
    summary = wide.select(F.inline(F.array(*entries)))
    if "segment" in predictions.columns:
        sizes = predictions.where(F.col("segment").isNotNull()).groupBy("segment").count()
        summary = summary.unionByName(
            sizes.select(
                F.lit("segment").alias("metric"),
                F.col("segment").cast("string").alias("key"),
                F.col("count").cast("double").alias("value"),
            )
        )
    return summary
