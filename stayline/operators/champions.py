"""Champion selection over a table of training runs."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from stayline.functions.numeric import nan_to_null
from stayline.functions.ranking import cut_blocks, running_before


def champion_history(
    runs: DataFrame, model: str = "model_name", order: str = "run_seq", score: str = "cv_score"
) -> DataFrame:
    """Every run with ``promoted`` and the ``version`` in force after it.

    A run is promoted if it is the model's first, or if its score is greater
    than every earlier score. A tie keeps the incumbent, a run without a score
    (NULL or NaN) never replaces one, and versions count promotions only. Runs
    may not be removed from the table afterwards; a model that holds most of
    the runs is still spread over many tasks.
    """
    clean = runs.withColumn(score, nan_to_null(F.col(score)))
    blocks = cut_blocks(clean.withColumn("_one", F.lit(1)), order)
    seen = running_before(
        blocks,
        order,
        {
            "_best": (score, F.max, F.greatest),
            "_earlier": ("_one", F.sum, operator.add),
        },
        [model],
    )
    beats = F.col(score).isNotNull() & (F.col("_best").isNull() | (F.col(score) > F.col("_best")))
    judged = seen.withColumn("promoted", F.col("_earlier").isNull() | beats).withColumn(
        "_won", F.col("promoted").cast("int")
    )
    counted = running_before(judged, order, {"_wins": ("_won", F.sum, operator.add)}, [model])
    version = (F.coalesce(F.col("_wins"), F.lit(0)) + F.col("_won")).cast("bigint")
    return counted.select(*runs.columns, "promoted", version.alias("version"))


def current_champions(
    runs: DataFrame, model: str = "model_name", order: str = "run_seq", score: str = "cv_score"
) -> DataFrame:
    """The run each model's champion alias points at.

    That is the earliest run with the best score, or the first run of a model
    without any score: one aggregation, no history needed.
    """
    value = nan_to_null(F.col(score))
    rank = F.struct(
        F.coalesce(-value, F.lit(float("inf"))).alias("loss"), F.col(order).alias("run")
    )
    best = runs.groupBy(model).agg(F.min(rank).alias("_best"), F.count(F.lit(1)).alias("runs"))
    return best.select(
        model,
        F.col("_best.run").alias(order),
        F.when(F.col("_best.loss") != float("inf"), -F.col("_best.loss")).alias(score),
        "runs",
    )


def best_run(
    runs: DataFrame,
    candidates: Sequence[str] | None = None,
    by: Sequence[str] = (),
    model: str = "model_name",
    order: str = "run_seq",
    score: str = "cv_score",
) -> DataFrame:
    """The best scored run among ``candidates`` (per ``by``); the earlier one wins a tie.

    Nothing is returned where no candidate has a score.
    """
    value = nan_to_null(F.col(score))
    pool = runs.where(value.isNotNull())
    if candidates is not None:
        pool = pool.where(F.col(model).isin(*candidates))
    rank = F.struct((-value).alias("loss"), F.col(order).alias("run"), F.col(model).alias("model"))
    best = pool.groupBy(*by).agg(F.min(rank).alias("_best")).where(F.col("_best").isNotNull())
    return best.select(
        *by,
        F.col("_best.model").alias(model),
        F.col("_best.run").alias(order),
        (-F.col("_best.loss")).alias(score),
    )


def metrics_long(runs: DataFrame, ids: Sequence[str]) -> DataFrame:
    """(ids…, metric, value) of the numeric columns; anything nested or textual is left out."""
    numeric = [
        f.name for f in runs.schema if isinstance(f.dataType, T.NumericType) and f.name not in set(ids)
    ]
    wide = runs.select(*ids, *[F.col(c).cast("double").alias(c) for c in numeric])
    return wide.unpivot(list(ids), numeric, "metric", "value").where(F.col("value").isNotNull())
