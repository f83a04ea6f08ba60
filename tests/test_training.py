from datetime import datetime

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayline import schema
from stayline.fixtures import churn_raw
from stayline.operators import features
from stayline.plans import training
from stayline.plans.batch import generate_predictions, load_models, run_batch
from stayline.plans.registry import PRIMARY, RunStore
from stayline.plans.training import CLUSTERING, TrainingSet, search
from stayline.plans.weekly import full_search, run_weekly
from stayline.session import scratch_path
from tests.compare import DATA

# Settings for tests only.
SMALL = {
    "logistic_regression": [{"C": 1.0, "iterations": 20}],
    "random_forest": [{"n_estimators": 8, "max_depth": 5, "class_weight": "balanced"}],
    "gradient_boosting": [{"max_iter": 4, "max_depth": 3, "min_samples_leaf": 10}],
    CLUSTERING: [{"n_clusters": 3, "restarts": 2}],
}


def test_search_sizes():
    sizes = {name: len(trials) for name, trials in full_search().items()}
    assert sizes == {"logistic_regression": 48, "random_forest": 25, "gradient_boosting": 25, "kmeans": 7}
    assert training.sampled(training.FOREST_SPACE) == training.sampled(training.FOREST_SPACE)
    assert len(training.grid(training.FOREST_SPACE)) == 432 and len(training.grid(training.BOOSTING_SPACE)) == 324


def test_no_two_trials_are_the_same_fit():
    for name in ("random_forest", "gradient_boosting"):
        trials = training.default_trials(name)
        assert len({training.effective(t) for t in trials}) == len(trials) == 25
    assert training.effective({"max_iter": 9, "max_depth": None}) == training.effective({"max_iter": 9, "max_depth": 5, "l2_regularization": 1.0})
    assert len(training.sampled({"max_iter": (1,), "max_depth": (5, None)})) == 1


def test_unknown_models_are_refused(customers):
    with pytest.raises(ValueError, match="unsupported"):
        training.default_trials("svm")
    with pytest.raises(ValueError, match="unsupported"):
        search(TrainingSet(customers(4), 2), {"svm": [{}]})
    with pytest.raises(ValueError, match="unsupported"):
        training.fit("svm", {}, customers(4), 4)


@pytest.mark.parametrize(
    "params, regularization, mix",
    [
        ({"C": 0.5}, 0.02, 0.0),
        ({"C": 0.5, "l1_ratio": 0.25}, 0.02, 0.25),
        ({"C": 0.5, "penalty": "l1"}, 0.02, 1.0),
        ({"C": 0.5, "penalty": None}, 0.0, 0.0),
    ],
)
def test_regularization_scale(spark, params, regularization, mix):
    estimator = training._logistic(params, 100)
    assert estimator.getRegParam() == pytest.approx(regularization)
    assert estimator.getElasticNetParam() == mix


def test_unlimited_depth_maps_to_the_deepest_tree(spark):
    assert training._forest({"max_depth": None}, 10).getMaxDepth() == 30
    assert training._forest({"class_weight": "balanced"}, 10).getWeightCol() == "weight_balanced"
    assert training._boosting({"max_depth": None}, 10).getMaxDepth() == 5


def test_preprocessor_matches_population_scaling_and_keeps_every_category(make):
    train = make([(1.0, "a"), (2.0, "b"), (4.0, None), (4.0, "a")], "x double, k string")
    fitted = features.preprocessor(4, ["k"], ["x"]).fit(train)
    other = make([(1.0, "a"), (2.0, "new"), (4.0, None)], "x double, k string")
    rows = [r.v for r in features.transformed(fitted, other).select(vector_to_array("features").alias("v")).collect()]
    mean, deviation = 2.75, (sum((x - 2.75) ** 2 for x in (1, 2, 4, 4)) / 4) ** 0.5
    assert [r[0] for r in rows] == pytest.approx([(x - mean) / deviation for x in (1, 2, 4)])
    # columns a, b, nan: an unseen value sets none, a missing one has its own
    assert [r[1:] for r in rows] == [[1.0, 0.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 1.0]]


def test_relational_scaling_uses_training_statistics(make):
    train = make([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    statistics = features.scale_statistics(train, ["x", "c"])
    row = features.standard_scale(make([(5.0, 6.0)], "x double, c double"), ["x", "c"], statistics).first()
    assert (row.x, row.c) == (3.0, 1.0)


def test_one_hot_long(make):
    rows = features.one_hot_long(make([(1, "a", None)], "id int, k string, t double"), "id", ["k", "t"])
    assert sorted(r.feature for r in rows.collect()) == ["k=a", "t=nan"]


@pytest.fixture(scope="module")
def results(spark):
    """All four models fitted on customers whose churn follows from two columns."""
    columns = ", ".join(
        ["customer_id string"]
        + [f"{c} {'double' if c in ('tenure', 'senior_citizen') else 'string'}" for c in schema.CATEGORICAL_FEATURES]
        + [f"{c} double" for c in schema.NUMERIC_FEATURES]
        + ["churn string"]
    )
    rows = []
    for i in range(160):
        churns = i % 3 == 0
        rows.append(
            (f"id-{i}", *[float(i % 4) if c in ("tenure", "senior_citizen") else f"v{(i * 7 + k) % 3}" for k, c in enumerate(schema.CATEGORICAL_FEATURES)],
             80.0 + i % 10 if churns else 20.0 + i % 10, float(i), float(i % 9), "Yes" if churns else "No")
        )
    data = spark.createDataFrame(rows, columns)
    return data, search(TrainingSet.of(data, folds=2), SMALL)


def test_search_finds_the_planted_signal(results):
    _, found = results
    assert list(found) == list(SMALL)
    for name in training.CLASSIFIERS:
        assert found[name].best_score > 0.9
        assert len(found[name].scores) == 2
    assert -1.0 <= found[CLUSTERING].best_score <= 1.0
    assert len({r.fitted.preprocessor.uid for r in found.values()}) == 1


def test_evaluation_routes_by_model(results):
    data, found = results
    held = training.evaluate(found["random_forest"].fitted, data)
    assert held["roc_auc"] > 0.9 and held["true_positives"] + held["false_negatives"] == 54
    sizes = training.evaluate(found[CLUSTERING].fitted, data)
    assert sizes["n_clusters"] >= 2 and "silhouette_squared" in sizes and sizes["inertia"] > 0
    with pytest.raises(ValueError, match="target"):
        training.evaluate(found["random_forest"].fitted, data.drop("churn"))


def test_predictions(results):
    data, found = results
    fitted = {n: r.fitted for n, r in found.items()}
    models = {PRIMARY: fitted["logistic_regression"], **fitted}
    out = generate_predictions(models, data.drop("churn"))
    assert out.columns == [
        "customer_id", "churn_probability_logistic_regression", "churn_probability_random_forest",
        "churn_probability_gradient_boosting", "segment", "segment_distance", "churn_probability",
        "churn_prediction", "churn_label", "risk_group",
    ]
    rows = out.collect()
    assert len({r.customer_id for r in rows}) == len(rows) == 160
    assert all(0.0 <= r.churn_probability <= 1.0 and r.segment_distance >= 0 for r in rows)
    assert all(r.churn_probability == r.churn_probability_logistic_regression for r in rows)
    agreeing = sum((r.churn_prediction == 1) == (int(r.customer_id[3:]) % 3 == 0) for r in rows)
    assert agreeing > 150


def test_prediction_errors(results):
    data, found = results
    fitted = {n: r.fitted for n, r in found.items()}
    with pytest.raises(ValueError, match="missing among"):
        generate_predictions(fitted, data, primary="absent")
    with pytest.raises(ValueError, match="segmentation"):
        generate_predictions(fitted, data, primary="random_forest", segmentation=None)
    alone = generate_predictions({"random_forest": fitted["random_forest"]}, data, primary="random_forest", segmentation=None)
    assert alone.columns == ["customer_id", "churn_probability", "churn_prediction", "churn_label", "risk_group"]


def test_saved_models_score_alike(spark, results):
    data, found = results
    store = RunStore(spark, scratch_path(spark, "saved"))
    fitted = found["gradient_boosting"].fitted
    run_id = store.log_run("gradient_boosting", {}, {"cv_score": 1.0}, fitted.save(f"{store.root}/artifacts"))
    store.register_champion("gradient_boosting", run_id)
    loaded = store.load_champion("gradient_boosting")
    before, after = [
        {r.customer_id: r.probability for r in training.predict(m, data).select("customer_id", "probability").collect()}
        for m in (fitted, loaded)
    ]
    assert before == after


def test_batch_job_with_its_own_settings(spark, results):
    data, found = results
    root = scratch_path(spark, "batch-job")
    store = RunStore(spark, f"{root}/registry")
    for score in (0.5, 0.7):  # two versions of the logistic model, the second is champion
        fitted = found["logistic_regression"].fitted
        run_id = store.log_run("logistic_regression", {}, {"cv_score": score}, fitted.save(f"{root}/artifacts"))
        store.register_champion("logistic_regression", run_id)
    store.register_champion(PRIMARY, run_id)
    saved = found["random_forest"].fitted.save(f"{root}/artifacts")
    broken = store.log_run("random_forest", {}, {"cv_score": 0.6}, (saved[0], f"{root}/artifacts/gone"))
    store.register_champion("random_forest", broken)

    loaded = load_models(store)
    assert list(loaded.models) == [PRIMARY, "logistic_regression"]
    assert loaded.models[PRIMARY].model.uid == loaded.models["logistic_regression"].model.uid
    assert set(loaded.absent) == {"random_forest", "gradient_boosting", CLUSTERING}
    assert load_models(store, ["models:/logistic_regression/1"], "models:/logistic_regression/1").primary_version == 1
    for wrong in ("models:/logistic_regression/9", "absent"):
        with pytest.raises(ValueError, match="not in the registry"):
            load_models(store, primary=wrong)
    with pytest.raises(ValueError, match="alias"):
        store.resolve("models:/primary@other")

    out = run_batch(store, data.drop("churn"), root, datetime(2024, 1, 1, 9), threshold=0.3, low=0.2, high=0.9)
    rows = out.predictions.collect()
    assert all((r.churn_prediction == 1) == (r.churn_probability >= 0.3) for r in rows) and len(rows) == 160
    assert {r.risk_group for r in rows if r.churn_probability >= 0.9} <= {"High"}
    compared = out.comparison.first()
    assert compared.n_predicted_churn == sum(r.churn_prediction for r in rows)
    assert compared.risk_high == sum(r.risk_group == "High" for r in rows)
    summary = {(r.metric, r.key) for r in out.summary.collect()}
    assert {("output_path", out.predictions_path), ("comparison_path", out.comparison_path), ("absent_model", "random_forest")} <= summary
    assert store.table("run_params").where("param = 'threshold' AND value = '0.3'").count() == 1


def test_weekly_run(spark):
    root = scratch_path(spark, "weekly")
    raw = churn_raw(spark, f"{DATA}/sf0.001")
    small = {
        "logistic_regression": [{"C": 1.0, "iterations": 5}],
        "random_forest": [{"n_estimators": 3, "max_depth": 3}],
        CLUSTERING: [{"n_clusters": 2, "restarts": 1}],
    }
    first = run_weekly(raw, root, small, datetime(2024, 1, 1, 9), folds=2, with_csv=True)
    summary = {(r.metric, r.key): r.value for r in first.summary.collect()}
    customers = summary["n_customers", None]
    assert customers == sum(summary["risk_group", g] for g in schema.RISK_GROUPS)
    assert customers == pytest.approx(0.2 * 150, abs=2)
    compared = first.comparison.collect()
    assert {r.model for r in compared} == {"logistic_regression", "random_forest"}
    for r in compared:
        assert r.batch_n_customers == customers == r.risk_low + r.risk_medium + r.risk_high
        assert r.model_version == 1 and r.batch_all_agree_churn + r.batch_all_agree_no_churn + r.batch_disagree == customers
    predicted = first.predictions
    assert predicted.where(F.col("churn_actual").isNull()).count() == 0
    assert predicted.select("batch_id").distinct().first().batch_id == "20240101T090000"

    # The same data again: no champion changes hands, the new batch is added.
    run_weekly(raw, root, small, datetime(2024, 1, 3, 9), folds=2)
    store = RunStore(spark, f"{root}/registry")
    assert store.table("versions").groupBy("registry").count().where("count > 1").count() == 0
    assert spark.read.parquet(f"{root}/predictions").select("batch_id").distinct().count() == 2
    # Cleaning and the batch were reused, the runs were not.
    assert spark.read.parquet(f"{root}/etl/manifest").count() == 1
    assert spark.read.parquet(f"{root}/batches/manifest").count() == 1
    assert store.table("runs").count() == 8
    assert spark.read.option("header", True).csv(f"{root}/export/predictions-20240101T090000.csv").count() == customers
    assert store.table("run_params").where("param = 'search.1.l1_ratio'").count() == 2
    logged = store.table("run_metrics").where("metric = 'n_customers'").collect()
    assert [r.value for r in logged] == [customers, customers]


def test_search_settings_are_flattened():
    many = training.space_params(training.LOGISTIC_GRIDS, 5, 48)
    assert many["search.0.C"] == many["search.1.C"] == [0.01, 0.1, 1.0, 10.0]
    assert "search.0.l1_ratio" not in many and many["cv.folds"] == 5
    assert training.space_params((training.KMEANS_SPACE,), 5, 7)["search.n_clusters"] == [2, 3, 4, 5, 6, 7, 8]


def test_models_score_after_a_logged_cleaning(raw, customers):
    """Fitted models carry their session: nothing that the log needs may make it unfit for tasks."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from stayline.plans.cleaning import clean_with_log

    clean_with_log(raw.union(raw)).cleaned.count()
    frame = customers(40).select(
        array_to_vector(F.array("tenure")).alias("features"), F.col("tenure").alias("label"),
        F.lit(1.0).alias("weight_none"), F.lit(1.0).alias("weight_balanced"),
    )
    for name, params in (("logistic_regression", {}), ("random_forest", {"n_estimators": 1, "max_depth": 2})):
        assert training.fit(name, params, frame, 40).transform(frame).select("prediction").distinct().count() == 2
