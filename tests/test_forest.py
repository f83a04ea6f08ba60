"""Forests over coded blocks: the same kind of forest as MLlib's, and exact counts."""

from statistics import fmean

import numpy as np
import pytest

from stayline import schema
from stayline.operators import boosting as B, forest as R
from stayline.plans import training
from stayline.plans.training import search
from tests.test_boosting import data  # noqa: F401

SETTING = R.Setting(40, 5, 2, "sqrt", True, 42)


@pytest.fixture(scope="module")
def prepared(data):  # noqa: F811
    found = B.prepare(data.rows, 3, schema.CATEGORICAL_FEATURES, schema.NUMERIC_FEATURES)
    return found, R.class_counts(found)


def test_search_grows_forests_over_blocks(data, monkeypatch):  # noqa: F811
    """No fold is fitted by MLlib, and scores are near those of its forests."""
    params = {"n_estimators": 60, "max_depth": 5, "max_features": "sqrt", "class_weight": "balanced"}
    single = [training._one_fold(data, "random_forest", params, i) for i in range(3)]
    monkeypatch.setattr(training, "fit", lambda *_: pytest.fail("fitted one by one"))
    found = search(data, {"random_forest": [params]}, refit=False)["random_forest"]
    assert fmean(s[3] for s in found.scores) == pytest.approx(fmean(single), abs=0.02)


def test_counts_in_turns_and_again_are_the_same(prepared, monkeypatch):
    whole = R.grow(*prepared, 1, SETTING)
    assert (whole.left >= 0).sum() > 40
    again = R.grow(*prepared, 1, SETTING)
    assert (again.left == whole.left).all() and (again.share == whole.share).all()
    monkeypatch.setattr(R, "COUNT_BYTES", 1)  # a chunk of trees a pass
    turns = R.grow(*prepared, 1, SETTING)
    assert len(turns.left) == pytest.approx(len(whole.left), rel=0.2) and (turns.left >= 0).any()


def test_a_stump_without_draws_splits_where_gini_falls_most(prepared, monkeypatch):
    monkeypatch.setattr(R, "_DRAWS", np.ones(1 << 16, np.uint8))
    monkeypatch.setattr(R.Forest, "prune", lambda self: None)
    found = R.grow(*prepared, 0, R.Setting(1, 1, 1, "all", False, 42))
    wide, label = [], []
    for row in prepared[0].blocks.collect():
        codes, bins, sides, fold, _ = B._block(row, prepared[0].layout)
        wide.append(R._matrix(prepared[0].layout, codes, bins[0])[fold != 0])
        label.append(sides[fold != 0] > 0)
    wide, label = np.concatenate(wide), np.concatenate(label)
    best = max(
        (label.mean() * (1 - label.mean()) - sum(side.mean() * label[side].mean() * (1 - label[side].mean()) for side in (above, ~above)))
        for f in range(wide.shape[1]) for b in range(31) for above in [wide[:, f] > b] if above.any() and not above.all()
    )
    above = wide[:, found.feature[0]] > found.bin[0]
    got = label.mean() * (1 - label.mean()) - sum(side.mean() * label[side].mean() * (1 - label[side].mean()) for side in (above, ~above))
    assert got == pytest.approx(best)
    assert found.share[:3].tolist() == pytest.approx([label.mean(), label[~above].mean(), label[above].mean()])


def test_alike_leaves_are_merged():
    tree = R.Forest(np.zeros(5, int), np.zeros(5, np.uint8), np.array([1, 3, -1, -1, -1]), np.array([0.4, 0.3, 0.7, 0.2, 0.4]))
    tree.prune()
    assert tree.left.tolist() == [1, -1, -1, -1, -1]
    assert R.SUBSETS["log2"](83) == 7 and R.SUBSETS["sqrt"](83) == 10
