"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from stayline.queries import QUERIES as STAR_QUERIES
from tests.compare import DATA, compare, connect

ORACLES = entry_module.oracle_sql()
QUERIES = entry_module.queries()
SF = f"{DATA}/sf0.001"
# Fitted models: behaviour is tested in test_training.
UNCHECKED = {"lr_scores", "rf_scores", "gbt_scores", "kmeans_k_selection"}
# Whole training runs: minutes each, left to the comparison script and the driver.
SLOW = {"train_all", "score_batch", "weekly_summary"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql_unless_it_fits_models():
    assert set(STAR_QUERIES) - set(ORACLES) == UNCHECKED
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_query_equals_sql(spark, duck, name):
    problems = compare(spark, duck, QUERIES[name], ORACLES[name], SF)
    assert [p for p in problems if "empty" not in p] == []
