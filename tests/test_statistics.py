import operator
import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stayline.functions import quantiles, ranking
from stayline.functions.numeric import clip, ratio, round_to
from stayline.operators import clusters, explore, metrics, split
from stayline.session import lookup, scratch_path


#: Doubles at every kind of edge: zeros, subnormals, neighbours of powers of two, the ends.
EDGES = [0.0, -0.0, 5e-324, 2.0**-1074 * 7, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf")]
EDGES += [float(np.nextafter(2.0**e, to)) for e in range(-1021, 1024, 31) for to in (0.0, np.inf)] + [2.0**e for e in range(-1074, 1024, 53)]


def test_ordered_keys_are_the_bits_of_the_double(spark):
    random_bits = np.random.default_rng(8).integers(0, 2047 << 52, 3_000).astype(np.int64).view(np.float64)
    values = [v for e in [*EDGES, *random_bits.tolist()] for v in (e, -e)]
    rows = quantiles.with_ordered_key(spark.createDataFrame([(v,) for v in values], "x double"), "x", "k").collect()
    for r in rows:
        bits = int(np.float64(abs(r.x)).view(np.int64))
        assert r.k == (-bits if r.x < 0 else bits)


def test_quantiles_at_the_edges_of_doubles(spark):
    values = sorted(v for e in EDGES if np.isfinite(e) for v in (e, -e))
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    probabilities = [i / (len(values) - 1) for i in range(0, len(values), 9)]
    found = quantiles.ranked_values(quantiles.numeric_long(df, ["x"]), ["column"], probabilities).collect()
    assert len(found) >= len(probabilities) and all(r.value == values[r.rank] for r in found)


def test_a_million_values_shuffle_histograms_only(spark):
    """Whatever the values, what leaves the map side is counts of digits: no task sees the rows."""
    n, tasks = 1_000_000, 8
    df = spark.range(0, n, 1, tasks).select((F.xxhash64("id") / 1e3).alias("x"), (F.rand(3) * 1e-3).alias("y"))
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quantiles", "quantiles")
    found = quantiles.quantile_values(df, ["x", "y"], [0.1, 0.5])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    frame = df.toPandas()
    for column in ("x", "y"):
        assert found[column] == pytest.approx(list(frame[column].quantile([0.1, 0.5])), rel=1e-12)
    assert status.getJobIdsForGroup("quantiles")
    rows = quantiles.with_ordered_key(quantiles.numeric_long(df, ["x", "y"]), "value", "key")
    first = quantiles._histogram(rows.withColumn("digit", F.shiftright("key", 48)), ["column"])
    sizes = {r["column"]: r["s"] for r in first.select("column", F.size("entries").alias("s")).collect()}
    assert all(s <= 2**quantiles.DIGIT_BITS for s in sizes.values()) and sum(sizes.values()) < n / 100
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count" in plan


@pytest.mark.parametrize("shape", ["normal", "hot", "heavy_tail", "two_values", "constant"])
def test_quantiles_equal_brute_force(spark, shape):
    rng = np.random.default_rng(5)
    n = 30_000
    data = {
        "normal": rng.normal(size=n),
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(5, 3, n)),
        "heavy_tail": rng.pareto(0.5, n),
        "two_values": rng.integers(0, 2, n).astype(float),
        "constant": np.full(n, 3.0),
    }[shape]
    probabilities = [0.9, 0.0, 0.25, 0.5, 0.75, 1.0, 0.123]
    df = spark.createDataFrame(pd.DataFrame({"x": data})).repartition(7)
    found = quantiles.quantile_values(df, ["x"], probabilities)["x"]
    assert found == pytest.approx(list(np.quantile(data, probabilities)), rel=1e-12)


def test_grouped_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(9)
    frame = pd.DataFrame({"g": rng.choice(["hot", "a", "b", None], 20_000, p=[0.7, 0.2, 0.09, 0.01]), "x": rng.exponential(size=20_000)})
    frame.loc[::50, "x"] = np.nan
    rows = quantiles.exact_quantiles(spark.createDataFrame(frame), ["x"], [0.25, 0.5], ["g"]).collect()
    assert len(rows) == 4
    for row in rows:
        part = frame[frame.g.isna() if row.g is None else frame.g == row.g].x.dropna()
        assert row.n == len(part)
        assert row.quantiles == pytest.approx(list(part.quantile([0.25, 0.5])), rel=1e-12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=12))
def test_small_quantiles_interpolate(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    found = quantiles.quantile_values(df, ["x"], [0.25, 0.5, 0.75])["x"]
    assert found == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_quantiles_ignore_missing_and_absent_columns(make):
    df = make([(1.0, None), (float("nan"), None), (3.0, None)], "x double, y double")
    assert quantiles.quantile_values(df, ["x", "y"], [0.5]) == {"x": [2.0]}
    assert quantiles.quantile_values(df, ["x"], [0.5], approximate=True)["x"][0] in (1.0, 3.0)


@pytest.mark.parametrize("blocks", [2, 16])
def test_running_totals_with_a_hot_key(spark, blocks):
    random.seed(3)
    rows = [(i, "hot" if random.random() < 0.6 else f"k{i % 4}", random.randint(0, 9)) for i in range(2_000)]
    frame = pd.DataFrame(rows, columns=["i", "k", "v"])
    df = spark.createDataFrame(frame).repartition(5)
    cut = ranking.cut_blocks(df, "i", blocks)
    totals = {"total": ("v", F.sum, operator.add), "top": ("v", F.max, F.greatest)}
    found = ranking.running_before(cut, "i", totals, ["k"]).toPandas().sort_values("i")
    frame["total"] = frame.groupby("k").v.cumsum() - frame.v
    frame["top"] = frame.groupby("k").v.transform(lambda s: s.cummax().shift())
    assert found.total.fillna(0).tolist() == frame.total.tolist()
    assert found.top.fillna(-1).tolist() == frame.top.fillna(-1).tolist()


def test_rounding_clip_and_ratio(make):
    df = make([(0.125, 5.0, 0), (2.675, None, 2)], "x double, c double, d int")
    row = df.select(
        round_to(F.col("x"), 2).alias("r"), clip(F.col("c"), F.lit(0), F.lit(3)).alias("c"), ratio(F.lit(4), F.col("d")).alias("q")
    ).collect()
    assert [tuple(r) for r in row] == [(0.13, 3.0, 0.0), (2.68, None, 2.0)]


def test_lookup_broadcasts_only_what_fits(spark):
    assert "ResolvedHint" in lookup(spark.range(5), 5)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in lookup(spark.range(6), 5)._jdf.queryExecution().analyzed().toString()


class FakeSession:
    """Just the settings that choose a scratch folder."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master)


def test_scratch_follows_the_session_setting():
    shared = FakeSession("yarn", "hdfs://shared/scratch/")
    assert scratch_path(shared, "x").startswith("hdfs://shared/scratch/stayline/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")


def test_scratch_falls_back_to_the_warehouse():
    """Whatever the session that runs the tests has set: only these settings count."""
    local, cluster = FakeSession("local[4]"), FakeSession("yarn")
    for session, warehouse in ((local, "file:/here/spark-warehouse"), (cluster, "hdfs://shared/warehouse/")):
        session.conf["spark.sql.warehouse.dir"] = warehouse
        first, second = scratch_path(session, "x"), scratch_path(session, "y")
        assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0] == f"{warehouse.rstrip('/')}/stayline"


def test_scratch_refuses_a_folder_of_one_machine_on_a_cluster():
    session = FakeSession("spark://master:7077")
    session.conf["spark.sql.warehouse.dir"] = "file:/here/spark-warehouse"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session, "x")


# -- splits --------------------------------------------------------------------


def test_split_is_exact_stratified_and_stable(customers):
    df = customers(100, lambda i: i % 4 == 0)
    once = split.stratified_split(df)
    test = {r.customer_id for r in once.where("is_test").collect()}
    assert len(test) == 20 and once.where("is_test and churn = 'Yes'").count() == 5
    assert once.count() == 100
    again = split.stratified_split(df.repartition(13).orderBy(F.desc("customer_id")))
    assert {r.customer_id for r in again.where("is_test").collect()} == test
    other = split.stratified_split(df, seed=7)
    assert {r.customer_id for r in other.where("is_test").collect()} != test


def test_split_rounds_the_quota_up_and_keeps_missing_classes(make):
    df = make([(str(i), None if i < 3 else "x") for i in range(9)], "customer_id string, churn string")
    marked = split.stratified_split(df)
    assert marked.where("is_test and churn is null").count() == 1
    assert marked.where("is_test and churn = 'x'").count() == 2


@pytest.mark.parametrize("target", ["churn", None])
def test_folds_are_balanced(customers, target):
    folded = split.kfold(customers(50), target=target)
    sizes = folded.groupBy("fold").count().collect()
    assert sorted(r.fold for r in sizes) == [0, 1, 2, 3, 4]
    assert {r["count"] for r in sizes} == {10}
    assert folded.columns[-1] == "fold"


def test_holdout_batch_has_no_target(customers):
    batch = split.holdout_batch(customers(100, lambda i: i % 4 == 0))
    assert batch.count() == 20 and "churn" not in batch.columns


# -- metrics -------------------------------------------------------------------


def test_confusion_counts(make):
    kinds = {(0, 0): 7, (0, 1): 3, (1, 0): 5, (1, 1): 10}
    rows = [pair for pair, times in kinds.items() for _ in range(times)]
    row = metrics.confusion_metrics(make(rows, "label int, prediction int")).first()
    assert (row.true_negatives, row.false_positives, row.false_negatives, row.true_positives) == (7, 3, 5, 10)
    assert row.accuracy == pytest.approx(17 / 25) and row.f1_score == pytest.approx(20 / 28)


def test_metrics_without_positives_are_zero(make):
    row = metrics.confusion_metrics(make([(0, 0)] * 3 + [(1, 0)], "label int, prediction int")).first()
    assert (row.precision, row.recall, row.f1_score, row.accuracy) == (0.0, 0.0, 0.0, 0.75)
    empty = metrics.confusion_metrics(make([], "label int, prediction int")).first()
    assert empty.accuracy == 0.0


def auc(make, rows):
    return metrics.roc_auc(make(rows, "label int, score double")).first().roc_auc


def test_auc(make):
    ladder = [(i % 2, i / 10) for i in range(1, 8)]
    assert auc(make, ladder) == pytest.approx(6 / 12)
    assert auc(make, [(y, s + 5 * y) for y, s in ladder]) == 1.0
    assert auc(make, [(y, 3.0) for y, _ in ladder]) == 0.5
    assert auc(make, [(0, s) for _, s in ladder]) is None


def test_auc_equals_pairwise_count_with_a_hot_score(make):
    random.seed(4)
    rows = [(random.randint(0, 1), 0.5 if random.random() < 0.35 else random.random()) for _ in range(600)]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert auc(make, rows) == pytest.approx(wins / len(pos) / len(neg))


def test_report_has_class_and_average_rows(make):
    rows = list(zip([0, 0, 0, 1], [0, 0, 1, 1]))
    report = {r["class"]: r for r in metrics.classification_report(make(rows, "label int, prediction int")).collect()}
    assert report["0"].precision == 1.0 and report["1"].recall == 1.0
    assert report["accuracy"].f1_score == 0.75
    assert report["macro avg"].recall == pytest.approx((2 / 3 + 1) / 2)
    assert report["weighted avg"].support == 4


# -- clusters ------------------------------------------------------------------


def silhouette_by_pairs(points, labels, square):
    total = 0.0
    for i, p in enumerate(points):
        gap = np.sqrt(((points - p) ** 2).sum(axis=1))
        gap = gap**2 if square else gap
        own = labels == labels[i]
        if own.sum() == 1:
            continue
        a = gap[own].sum() / (own.sum() - 1)
        b = min(gap[labels == c].mean() for c in set(labels) if c != labels[i])
        total += 0.0 if max(a, b) == 0 else (b - a) / max(a, b)
    return total / len(points)


def test_silhouettes_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(60, 3)) + np.repeat([[0, 0, 0], [4, 0, 0], [0, 5, 5]], 20, axis=0)
    labels = np.append(rng.integers(0, 3, 59), 9)
    df = spark.createDataFrame([(i, p.tolist(), int(c)) for i, (p, c) in enumerate(zip(points, labels))], "id int, v array<double>, c int")
    squared = clusters.silhouette_squared(df, "v", "c").first()
    exact = clusters.silhouette_exact(df, "id", "v", "c", tile=17).first()
    assert squared.silhouette == pytest.approx(silhouette_by_pairs(points, labels, True))
    assert (exact.points, exact.silhouette) == (60, pytest.approx(silhouette_by_pairs(points, labels, False)))


def test_exact_silhouette_measures_each_pair_of_tiles_once(spark):
    """Far from the origin, with equal and nearly equal points, ids that repeat not at all, tiles of uneven size."""
    rng = np.random.default_rng(3)
    points = np.repeat(rng.normal(size=(30, 4)), 2, axis=0) + 1000.0
    points[::4] += 1e-5
    gaps = clusters._gaps(points, points)
    assert np.allclose(gaps, np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2)), rtol=1e-6, atol=0)
    labels = rng.integers(0, 3, 60)
    df = spark.createDataFrame([(i, p.tolist(), f"c{c}") for i, (p, c) in enumerate(zip(points, labels))], "id int, v array<double>, c string")
    exact = clusters.silhouette_exact(df, "id", "v", "c", tile=13).first()
    assert (exact.points, exact.silhouette) == (60, pytest.approx(silhouette_by_pairs(points, labels, False)))


def test_single_cluster_scores_minus_one(make):
    df = make([(1, [0.0], 0), (2, [1.0], 0)], "id int, v array<double>, c int")
    assert clusters.silhouette_squared(df, "v", "c").first().silhouette == -1.0
    assert clusters.silhouette_exact(df, "id", "v", "c").first().silhouette == -1.0


def test_nearest_centroid(make):
    df = make([(1, [0.0, 1.0]), (2, [9.0, 0.0]), (3, [5.0, 0.0])], "id int, v array<double>")
    found = clusters.assign_nearest(df, "v", [(0, [0.0, 0.0]), (1, [10.0, 0.0])]).orderBy("id").collect()
    assert [(r.segment, r.segment_distance) for r in found] == [(0, 1.0), (1, 1.0), (0, 5.0)]
    sizes = {r.cluster: (r.size, r.inertia) for r in clusters.cluster_metrics(clusters.assign_nearest(df, "v", [(0, [0.0, 0.0]), (1, [10.0, 0.0])])).collect()}
    assert sizes == {0: (2, 26.0), 1: (1, 1.0)}
    total = clusters.cluster_totals(spark_frame(make, sizes)).first()
    assert (total.n_clusters, total.points, total.inertia) == (2, 3, 27.0)


def spark_frame(make, sizes):
    return make([(c, n, i) for c, (n, i) in sizes.items()], "cluster int, size bigint, inertia double")


# -- exploration ---------------------------------------------------------------


def test_demographic_groups_leave_out_missing_keys(raw):
    unknown = raw.limit(1).withColumn("gender", F.lit("other"))
    groups = explore.demographic_groups(explore.prepared(raw.union(unknown))).collect()
    assert sum(r.customer_count for r in groups) == 3
    senior = next(r for r in groups if r.SeniorCitizen == 1)
    assert senior.avg_total_charges is None and senior.total_revenue == 0.0


def test_labels_and_ranking(raw):
    ranked = explore.revenue_ranking(explore.prepared(raw)).collect()
    assert [r.demo_label for r in ranked] == ["M/Jr/NP/ND", "F/Jr/P/ND", "M/Sr/NP/D"]
    assert ranked[0].money_label == "$2K"


def test_box_statistics(make):
    df = make([("g", float(x)) for x in [1, 2, 3, 4, 5, 50]] + [("g", None), (None, 1.0)], "k string, v double")
    row = explore.box_statistics(df, "v", ["k"]).first()
    assert (row.n, row.median, row.whisker_low, row.whisker_high, row.n_outliers) == (6, 3.5, 1.0, 5.0, 1)


def test_interval_needs_two_values(make):
    rows = {r.k: r for r in explore.mean_interval(make([("a", 1.0), ("b", 1.0), ("b", 3.0)], "k string, v double"), "v", ["k"]).collect()}
    assert rows["a"].ci_low is None
    assert rows["b"].ci_high == pytest.approx(2 + 1.96)


def test_crosstab_has_zero_cells(make):
    df = make([(0, "No"), (0, "No"), (1, "Yes"), (1, None)], "s int, y string")
    assert sorted(map(tuple, explore.crosstab(df, "s", "y", ["No", "Yes"]).collect())) == [(0, 2, 0), (1, 0, 1)]
