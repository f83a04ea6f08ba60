"""Chains of small jobs: few rows take few tasks, and codes take a byte each where they fit."""

import numpy as np
import pytest

from stayline import schema
from stayline.operators import boosting as B
from stayline.plans import training
from tests.test_boosting import data  # noqa: F401


@pytest.fixture
def prepared(data):  # noqa: F811
    return B.prepare(data.rows, 3, schema.CATEGORICAL_FEATURES, schema.NUMERIC_FEATURES)


def test_few_rows_take_one_task_a_pass(prepared, monkeypatch):
    state = B._spread(prepared.blocks, prepared.layout, prepared.rows)
    assert prepared.rows == 600 and state.getNumPartitions() == 1
    monkeypatch.setattr(B, "TASK_ROWS", 200)
    assert B._spread(prepared.blocks, prepared.layout, prepared.rows).getNumPartitions() == 3
    monkeypatch.setattr(B, "TASK_ROWS", 1)
    cores = prepared.blocks.sparkSession.sparkContext.defaultParallelism
    assert B._spread(prepared.blocks, prepared.layout, prepared.rows).getNumPartitions() == cores


def test_wide_codes_hold_every_category(prepared):
    row = prepared.blocks.first()
    assert len(row["codes"]) == row["rows"] * len(schema.CATEGORICAL_FEATURES) and len(row["sides"]) == row["rows"]
    wide = B.Layout(0, [[str(i) for i in range(300)]], [[]])
    assert wide.code_type is np.int32 and B.Layout(0, [["a"] * 256], [[]]).code_type is np.uint8


def test_refits_of_few_rows_run_in_few_tasks(spark, monkeypatch):
    rows = spark.range(0, 100, 1, 8)
    assert training._dealt(rows, 100).rdd.getNumPartitions() == 1
    assert training._dealt(rows, 100).count() == 100
    monkeypatch.setattr(training, "TASK_ROWS", 10)
    assert training._dealt(rows, 100) is rows


def test_forests_do_not_walk_from_the_roots_again(spark):
    assert training._forest({}, 0).getCacheNodeIds()
