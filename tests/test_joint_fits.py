"""Joint fits against one-by-one ones, and the queue of units."""

import threading
import time

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stayline.operators import kmeans as K
from stayline.operators import logistic as L
from stayline.plans import training
from stayline.plans.queue import Shared, Unit, interleaved, run_units
from stayline.plans.training import CLUSTERING, TrainingSet, search


def frame(spark, x, y, w=None):
    rows = [(float(a), 1.0, float(v), [float(c) for c in r]) for a, v, r in zip(y, w if w is not None else np.ones(len(y)), x)]
    df = spark.createDataFrame(rows, "label double, one double, uneven double, x array<double>")
    return df.withColumn("features", array_to_vector("x")).repartition(3)


@pytest.fixture(scope="module")
def sample(spark):
    random = np.random.default_rng(2)
    hot = np.eye(3)[random.integers(0, 3, 400)]  # collinear with the intercept
    x = np.column_stack([random.normal(size=(400, 3)) * [1, 50, 0.01] + [0, 900, 3], hot, np.ones(400)])
    y = random.random(400) < 1 / (1 + np.exp(-(x[:, 0] + 2 * hot[:, 1] - 0.5)))
    return x, y.astype(float), random.uniform(0.5, 2, 400)


PENALTIES = [L.Penalty(s, m, w) for s in (0.3, 0.01, 0.0005) for m in (0.0, 0.5, 1.0) for w in ("one", "uneven")]


def test_joint_logistic_fits_reach_the_minimum_of_single_ones(spark, sample):
    x, y, w = sample
    train = frame(spark, x, y, w)
    found = L.fit_all(L.row_blocks(train, ["one", "uneven"]), 7, ["one", "uneven"], PENALTIES)

    def objective(p, b):
        m, own = b[0] + x @ b[1:], w if p.weight == "uneven" else np.ones(len(y))
        penalty = p.mix * np.abs(b[1:]).sum() + (1 - p.mix) / 2 * (b[1:] ** 2).sum()
        return float(own @ (np.logaddexp(0, m) - y * m) / own.sum() + p.strength * penalty)

    for p, b in list(zip(PENALTIES, found))[::3]:
        single = LogisticRegression(
            weightCol=p.weight, regParam=p.strength, elasticNetParam=p.mix, standardization=False, maxIter=500, tol=1e-9
        ).fit(train)
        other = np.r_[single.intercept, single.coefficients.toArray()]
        assert objective(p, b) <= objective(p, other) + 1e-9
        assert np.abs(x @ (b - other)[1:] + (b - other)[0]).max() < 0.02
    for p, b in zip(PENALTIES, found):  # no direction leads further down
        for step in np.random.default_rng(0).normal(size=(30, 8)) * 1e-4:
            assert objective(p, b) <= objective(p, b + step) + 1e-12


def test_areas_equal_brute_force(spark, sample):
    x, y, _ = sample
    coefficients = np.array([[0, 1, 0, 0, 0, 0, 0, 0], [0, 0, 0, 0, 1, 2, 2, 0], [1, 0, 0, 0, 0, 0, 0, 0.0]])
    got = L.areas(L.with_margins(frame(spark, x, y), coefficients), 3)
    for area, b in zip(got, coefficients):
        s = b[0] + x @ b[1:]
        pos, neg = s[y == 1], s[y == 0]
        wins = (pos[:, None] > neg).sum() + (np.isclose(pos[:, None], neg, rtol=0, atol=0)).sum() / 2
        assert area == pytest.approx(wins / (len(pos) * len(neg)))
    assert L.areas(L.with_margins(frame(spark, x, np.ones(400)), coefficients), 3) == [0.0] * 3


def test_no_rows_and_hard_data(spark, sample):
    x, y, _ = sample
    none = frame(spark, x[:5], y[:5]).where("false")
    assert not L.fit_all(L.row_blocks(none, ["one"]), 7, ["one"], [L.Penalty(0.1, 0.0, "one")]).any()
    assert K.fit_runs(K.feature_blocks(none), 7, [K.Run(2, 1)])[0][0] == 0.0
    separable = np.column_stack([np.r_[np.zeros(50), np.ones(50)] * 1e4, np.zeros(100)])
    label = np.r_[np.zeros(50), np.ones(50)]
    b = L.fit_all(L.row_blocks(frame(spark, separable, label), ["one"]), 2, ["one"], [L.Penalty(1e-4, 1.0, "one")])[0]
    assert np.isfinite(b).all() and ((b[0] + separable @ b[1:] > 0) == (label == 1)).all()


def test_joint_kmeans_finds_planted_groups(spark):
    random = np.random.default_rng(1)
    centres = np.array([[0, 0], [40, 0], [0, 40], [40, 40.0]])
    x = np.vstack([c + random.normal(size=(60, 2)) for c in centres])
    train = frame(spark, x, np.zeros(240)).withColumn("label", F.lit(None).cast("double"))
    runs = [K.Run(k, seed) for k in (1, 4, 6) for seed in range(4)]
    found = K.fit_runs(K.feature_blocks(train), 2, runs)
    for run, (cost, own) in zip(runs, found):
        nearest = np.square(x[:, None] - own).sum(axis=2)
        assert cost == pytest.approx(nearest.min(axis=1).sum(), rel=1e-9) and len(own) == run.clusters
    best = min((f for r, f in zip(runs, found) if r.clusters == 4), key=lambda f: f[0])
    assert np.abs(np.sort(best[1].round(), axis=0) - np.sort(centres, axis=0)).max() <= 1
    again = K.fit_runs(K.feature_blocks(train.repartition(1)), 2, runs[:4])
    assert [round(c, 6) for c, _ in again] == [round(c, 6) for c, _ in found[:4]]
    labels = [r.clusters for r in K.with_clusters(train, [best[1], best[1][:1]]).collect()]
    assert len(labels) == 240 and {l[1] for l in labels} == {0} and len({l[0] for l in labels}) == 4


def test_equal_fits_are_fitted_once(monkeypatch, customers):
    trials, which = training._distinct(training.default_trials("logistic_regression"))
    assert len(trials) == 40 and len(which) == 48 and which[0] == which[8]


def test_units_interleave_and_share(spark):
    a, b = [Unit("a", lambda: 1)] * 3, [Unit("b", lambda: 2)]
    assert [u.pool for u in interleaved([a, b])] == ["a", "b", "a", "a"]
    made, released = [], []
    shared = Shared(lambda: made.append(1) or "value", released.append, 3)

    def use():
        try:
            return shared.get()
        finally:
            shared.done()

    assert run_units(spark, [Unit("a", use)] * 3, 3) == ["value"] * 3
    assert made == [1] and released == ["value"]
    with pytest.raises(ZeroDivisionError):
        run_units(spark, [Unit("a", lambda: 1), Unit("b", lambda: 1 / 0)], 2)


def test_jobs_of_different_models_overlap_in_their_pools(spark, customers):
    """Read from the status tracker while a search runs: jobs of several models are active at once."""
    seen, stop, running, pools = set(), threading.Event(), [], set()
    status = spark.sparkContext.statusTracker()
    original = training.fit

    def noting(name, *rest):
        running.append(name)
        pools.add((name, spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
        try:
            return original(name, *rest)
        finally:
            running.remove(name)

    def watch():
        while not stop.is_set():
            if len(status.getActiveJobsIds()) > 1:
                seen.add(frozenset(running))
            time.sleep(0.005)

    watcher = threading.Thread(target=watch)
    watcher.start()
    training.fit = noting
    try:
        models = {
            "random_forest": [{"n_estimators": 5, "max_depth": 4}],
            "gradient_boosting": [{"max_iter": 5, "max_depth": 2, "min_samples_leaf": 1}],
            CLUSTERING: [{"n_clusters": 2, "restarts": 2}],
        }
        results = search(TrainingSet.of(customers(120, lambda i: i % 3 == 0), folds=2), models)
    finally:
        training.fit = original
        stop.set()
        watcher.join()
    assert any({"random_forest", "gradient_boosting"} <= names for names in seen)
    assert pools == {("random_forest", "random_forest"), ("gradient_boosting", "gradient_boosting")}
    assert {n: len(r.scores) for n, r in results.items()} == dict.fromkeys(models, 2)
    assert all(r.fitted is not None for r in results.values()) and results[CLUSTERING].fitted.clusters


def test_newton_steps_are_found_in_tasks(spark, sample, monkeypatch):
    x, y, w = sample
    descended = L._descended

    def in_task(*arrays):
        assert L.TaskContext.get() is not None
        return descended(*arrays)

    monkeypatch.setattr(L, "_descended", in_task)
    found = L.fit_all(L.row_blocks(frame(spark, x, y, w), ["one"]), 7, ["one"], [L.Penalty(0.01, 0.5, "one")])
    assert found.shape == (1, 8) and np.abs(found).max() > 0.1


def test_races_measure_a_block_once(monkeypatch):
    x = np.random.default_rng(1).normal(size=(50, 3))
    matrix = np.column_stack([np.zeros(50), np.ones(50), x])
    batch = L.pa.RecordBatch.from_arrays([L.pa.array([5]), L.pa.array([matrix.tobytes()], L.pa.binary())], ["width", "block"])
    calls, measured = [], K._distances
    monkeypatch.setattr(K, "_distances", lambda *a: calls.append(1) or measured(*a))
    centres = [x[:1], x[3:5], np.empty((0, 3))]
    (out,) = K._races([4, 7, 9], [1, 2, 3], centres)(iter([batch]))
    assert len(calls) == 1 and out.column("fit").to_pylist() == [4, 7, 9]
    for seed, own, sums in zip([1, 2, 3], centres, out.column("sums").to_pylist()):
        weight = measured(x, own).min(axis=1) if len(own) else np.ones(50)
        with np.errstate(divide="ignore"):
            times = np.random.default_rng([seed, len(own), K.zlib.crc32(x)]).standard_exponential(50) / weight
        assert np.allclose(np.frombuffer(sums), [times.min(), *x[times.argmin()]])


def test_newton_step_is_the_exact_minimum():
    """Collinear indicators and an L1 penalty, where sweeps over the coordinates did not settle."""
    random = np.random.default_rng(5)
    hot = [np.eye(k)[random.integers(0, k, 600)] for k in (2, 2, 3, 3, 4, 40)]
    x = np.column_stack([np.ones(600), random.normal(size=(600, 2)), *hot, hot[0]])
    size = x.shape[1]
    curvature, gradient = x.T @ x / 2400, x.T @ random.normal(size=600) / 600
    free = np.arange(size) > 0
    strengths = (0.03, 0.003, 0.0003)
    l1, l2 = np.array([s * 0.75 * free for s in strengths]), np.array([s * 0.25 * free for s in strengths])
    at = np.zeros((3, size))
    at[1] = random.normal(size=size)
    point = at + L._descended(at, np.array([gradient] * 3), np.array([curvature] * 3), l1, l2)
    for a, z, one, two in zip(at, point, l1, l2):
        slope = gradient + curvature @ (z - a) + (two + 1e-12) * z
        assert (np.abs(slope + one * np.sign(z))[(z != 0) | (one == 0)] < 1e-9).all()
        assert (np.abs(slope) <= one + 1e-9)[z == 0].all()
    assert (point == 0).any() and (point != 0).any()


def test_assignment_takes_the_first_of_equally_near_centres():
    x = np.random.default_rng(4).normal(size=(40, 3))
    matrix = np.column_stack([np.zeros(40), np.ones(40), x])
    batch = L.pa.RecordBatch.from_arrays([L.pa.array([5]), L.pa.array([matrix.tobytes()], L.pa.binary())], ["width", "block"])
    centres = [x[[1, 1, 7]], x[:2]]
    (out,) = K._assigned([3, 8], centres)(iter([batch]))
    assert out.column("fit").to_pylist() == [3, 8]
    for own, sums in zip(centres, out.column("sums").to_pylist()):
        distances = np.square(x[:, None] - own).sum(axis=2)
        member = np.eye(len(own))[distances.argmin(axis=1)]
        expected = np.concatenate([[distances.min(axis=1).sum()], member.sum(axis=0), (member.T @ x).reshape(-1)])
        assert np.allclose(np.frombuffer(sums), expected)


def test_workers_leave_imports_out_of_collections(spark, sample):
    x, y, _ = sample
    blocks = L.row_blocks(frame(spark, x, y), ["one"])

    def counted(batches):
        import gc

        list(L._matrices(batches))
        yield L.pa.RecordBatch.from_arrays([L.pa.array([gc.get_freeze_count()])], ["frozen"])

    assert all(r.frozen > 1_000 for r in blocks.mapInArrow(counted, "frozen long").collect())
