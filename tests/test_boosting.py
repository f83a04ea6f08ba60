"""Boosting over all folds at once against MLlib's one-by-one fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline import schema
from stayline.operators import boosting as B
from stayline.plans import training
from stayline.plans.training import TrainingSet, search


@pytest.fixture(scope="module")
def data(spark):
    columns = ", ".join(
        [f"{c} {'double' if c in ('tenure', 'senior_citizen') else 'string'}" for c in schema.CATEGORICAL_FEATURES]
        + [f"{c} double" for c in schema.NUMERIC_FEATURES]
        + ["label double", "fold int", "plain_fold int"]
    )
    random = np.random.default_rng(5)
    rows = []
    for i in range(600):
        codes = random.integers(0, 4, len(schema.CATEGORICAL_FEATURES))
        own = [
            None if k == 3 and c == "tenure" else float(k) if c in ("tenure", "senior_citizen") else f"v{k}"
            for c, k in zip(schema.CATEGORICAL_FEATURES, codes.tolist())
        ]
        if i == 7:
            own[0] = "once"  # a category that one fold alone has
        x = random.normal(size=3).tolist()
        churns = x[0] + (codes[0] == 1) - (codes[5] == 2) + 0.5 * random.normal() > 0.3
        rows.append((*own, *x, float(churns), i % 3, i % 3))
    return TrainingSet(spark.createDataFrame(rows, columns).repartition(3), 3)


PARAMS = {"max_iter": 25, "max_depth": 3, "learning_rate": 0.1, "min_samples_leaf": 10}


def test_search_scores_are_those_of_single_fits(data):
    found = search(data, {"gradient_boosting": [PARAMS]}, refit=False)["gradient_boosting"]
    for _, _, fold, value in found.scores:
        frames = training._fold(data, "fold", fold, 1).get()
        single = training.fit("gradient_boosting", PARAMS, frames[1], frames[3])
        assert value == pytest.approx(training.score("gradient_boosting", single, frames[2]), abs=1e-6)
        training._released(frames)


def test_passes_do_not_multiply_with_folds(spark, data):
    """All folds share a chain of passes: three a round, not three a round and fold."""
    group = "boosting-passes"
    prepared = B.prepare(data.rows, 3, schema.CATEGORICAL_FEATURES, schema.NUMERIC_FEATURES)
    spark.sparkContext.setJobGroup(group, group)
    try:
        B.margins(prepared, 6, 3, 0.1, 10).unpersist()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs <= 3 * 6 + 4


def test_written_states_change_nothing(data, monkeypatch):
    prepared = B.prepare(data.rows, 3, schema.CATEGORICAL_FEATURES, schema.NUMERIC_FEATURES)
    whole = B.fold_scores(prepared, 7, 2, 0.1, 10)
    monkeypatch.setattr(B, "WRITTEN_EVERY", 2)
    assert B.fold_scores(prepared, 7, 2, 0.1, 10) == pytest.approx(whole, abs=1e-12)


def test_thresholds_lie_between_values():
    assert B.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 32).tolist() == [1.5, 2.5]
    assert len(B.thresholds(np.arange(1000.0), 32)) == 31 and not len(B.thresholds(np.ones(9), 32))


def test_unusable_rows_are_refused(data):
    for column in ("label", "monthly_charges"):
        rows = data.rows.withColumn(column, F.when(F.col("fold") == 1, F.col(column)))
        with pytest.raises(Exception, match="boosting needs"):
            B.prepare(rows, 3, schema.CATEGORICAL_FEATURES, schema.NUMERIC_FEATURES)
