"""The weekly run: clean, train, register, score the held-out batch, compare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from stayline import schema
from stayline.operators import split
from stayline.plans.batch import run_batch
from stayline.plans.etl import prepare_batch, run_etl
from stayline.plans.registry import RunStore, log_search
from stayline.plans.training import (
    CLASSIFIERS,
    CLUSTERING,
    SPACES,
    TrainingSet,
    default_trials,
    evaluate,
    search,
    space_params,
)
from stayline.sources.readers import read_batch


@dataclass(frozen=True)
class WeeklyResult:
    predictions: DataFrame
    comparison: DataFrame
    summary: DataFrame


def full_search() -> dict[str, list[dict]]:
    """All four models with their full parameter searches."""
    return {name: default_trials(name) for name in (*CLASSIFIERS, CLUSTERING)}


def train_and_register(
    cleaned: DataFrame,
    store: RunStore,
    models: Mapping[str, Sequence[Mapping]],
    folds: int = schema.FOLDS,
    parallelism: int = 8,
    spaces: Mapping[str, Sequence[Mapping]] | None = None,
) -> dict[str, tuple[int, bool]]:
    """Search every model on the training part, log the runs, and contest the champions.

    ``spaces`` are the search spaces the trials were drawn from, for the log;
    the default ones unless given.
    """
    marked = split.stratified_split(cleaned)
    train = marked.where(~F.col("is_test")).drop("is_test")
    test = marked.where("is_test").drop("is_test")
    results = search(TrainingSet.of(train, folds=folds), models, parallelism)
    runs = {
        n: log_search(
            store,
            r,
            evaluate(r.fitted, test),
            space_params(SPACES[n] if spaces is None else spaces.get(n, ()), folds, len(models[n])),
        )
        for n, r in results.items()
    }
    return store.register_models(runs)


def run_weekly(
    raw: DataFrame,
    root: str,
    models: Mapping[str, Sequence[Mapping]],
    at: datetime,
    folds: int = schema.FOLDS,
    parallelism: int = 8,
    with_csv: bool = False,
    settings: Mapping | None = None,
) -> WeeklyResult:
    """Run all stages in order below ``root``; a failing stage stops the run.

    ``with_csv`` also exports the batch's predictions and comparison as
    delimited files with a header. ``settings`` go to the batch job: threshold,
    risk bounds, models.
    """
    spark = raw.sparkSession
    path, _ = run_etl(raw, root, at)
    cleaned = spark.read.parquet(f"{path}/cleaned")

    store = RunStore(spark, f"{root}/registry")
    train_and_register(cleaned, store, models, folds, parallelism)

    batch, _ = prepare_batch(cleaned, root, at)
    scored = run_batch(store, read_batch(spark, batch), root, at, cleaned, with_csv=with_csv, **(settings or {}))
    return WeeklyResult(scored.predictions, scored.comparison, scored.summary)
