"""Queries that fit models, and incremental scoring.

Scores of fitted models have no SQL counterpart, but a right fit must meet some
totals that do: an unpenalised logistic model on one category gives its class
shares, k-means on far-apart groups their means, and so on.

The logistic and clustering searches are the full ones, in the whole-run queries
too. Forests and boosting are not: they search the two and one trials listed here, with
as many trees and rounds as their spaces ask for at least. The full lists of 25 trials
are ``default_trials`` of the same search.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from stayline import schema
from stayline.fixtures import churn_raw, scored, table
from stayline.operators import scoring, split
from stayline.operators.encode import target_code
from stayline.plans import training
from stayline.plans.batch import run_batch
from stayline.plans.cleaning import clean_customers
from stayline.plans.registry import RunStore
from stayline.plans.training import CLUSTERING, TrainingSet, default_trials, score_table, search
from stayline.plans.weekly import run_weekly, train_and_register
from stayline.queries.learning import HELD
from stayline.queries.registry import SCORED, clean_sql, query, rounded, rounded_columns
from stayline.session import scratch_path
from stayline.sources import writers
from stayline.streaming.incremental import score_new_files

AT = datetime(2024, 1, 1, 9, 0, 0)
FOREST = [
    {"n_estimators": 200, "max_depth": 5, "max_features": "sqrt", "class_weight": "balanced"},
    {"n_estimators": 200, "max_depth": 10, "max_features": "log2", "min_samples_leaf": 4},
]
BOOSTING = [{"max_iter": 200, "max_depth": 3, "learning_rate": 0.05, "min_samples_leaf": 20}]
#: What the queries about whole runs search.
RUN_TRIALS = {
    "logistic_regression": default_trials("logistic_regression"),
    "random_forest": FOREST,
    "gradient_boosting": BOOSTING,
    CLUSTERING: default_trials(CLUSTERING),
}


def _training_part(spark, sf_dir):
    marked = split.stratified_split(clean_customers(churn_raw(spark, sf_dir)))
    return TrainingSet.of(marked.where(~F.col("is_test")))


def _scores(spark, sf_dir, name, trials):
    return score_table(spark, search(_training_part(spark, sf_dir), {name: trials}, refit=False))


@query("lr_scores")
def lr_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "logistic_regression", default_trials("logistic_regression"))


@query("rf_scores")
def rf_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "random_forest", FOREST)


@query("gbt_scores")
def gbt_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "gradient_boosting", BOOSTING)


@query("kmeans_k_selection")
def kmeans_k_selection(spark, sf_dir):
    return _scores(spark, sf_dir, CLUSTERING, default_trials(CLUSTERING))


# -- what a right fit must meet --------------------------------------------------

_CONTRACTS = ("Month-To-Month", "One Year", "Two Year")


def _by_contract(spark, sf_dir, name, params):
    """Score and class that a model fitted on the contract alone gives each contract."""
    cleaned = clean_customers(churn_raw(spark, sf_dir))
    indicator = F.array(*[(F.col("contract") == c).cast("double") for c in _CONTRACTS])
    one = F.lit(1.0)
    frame = cleaned.select(
        "contract", array_to_vector(indicator).alias("features"), target_code(F.col("churn")).cast("double").alias("label"),
        one.alias("weight_none"), one.alias("weight_balanced"),
    )
    fitted = training.fit(name, params, frame, frame.count())
    return fitted.transform(frame.select("contract", "features").distinct()).select(
        "contract", vector_to_array("probability")[1].alias("probability"), F.col("prediction").cast("int").alias("prediction")
    )


_SHARES = "SELECT contract, AVG(CASE WHEN churn = 'Yes' THEN 1.0 ELSE 0.0 END) AS share FROM cleaned GROUP BY contract"


@query("lr_class_shares", clean_sql(f"SELECT contract, {rounded('share', 4)} AS probability FROM ({_SHARES}) s"))
def lr_class_shares(spark, sf_dir):
    fitted = _by_contract(spark, sf_dir, "logistic_regression", {"penalty": None})
    return rounded_columns(fitted.drop("prediction"), 4, "probability")


@query(
    "gbt_first_round",
    clean_sql(f"SELECT contract, {rounded('1 / (1 + exp(-2 * (2 * share - 1)))', 6)} AS probability FROM ({_SHARES}) s"),
)
def gbt_first_round(spark, sf_dir):
    fitted = _by_contract(spark, sf_dir, "gradient_boosting", {"max_iter": 1, "max_depth": 3, "min_samples_leaf": 1})
    return rounded_columns(fitted.drop("prediction"), 6, "probability")


@query(
    "rf_single_tree",
    clean_sql(f"SELECT contract, CAST(CASE WHEN share > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM ({_SHARES}) s"),
)
def rf_single_tree(spark, sf_dir):
    fitted = _by_contract(spark, sf_dir, "random_forest", {"n_estimators": 1, "max_depth": 5, "max_features": "all"})
    return fitted.drop("probability")


@query(
    "kmeans_planted_groups",
    f"""SELECT COUNT(*) AS size, {rounded('AVG(1000.0 * (c_nationkey % 5))', 4)} AS x,
    {rounded('AVG(CAST(c_custkey % 7 AS DOUBLE))', 4)} AS y FROM customer GROUP BY c_nationkey % 5""",
)
def kmeans_planted_groups(spark, sf_dir):
    group = (F.col("c_nationkey") % 5).cast("double")
    point = F.array(group * 1000.0, (F.col("c_custkey") % 7).cast("double"))
    frame = table(spark, sf_dir, "customer").select(array_to_vector(point).alias("features"))
    fitted = training.fit(CLUSTERING, {"n_clusters": 5}, frame, frame.count())
    sizes = fitted.transform(frame).groupBy("prediction").agg(F.count(F.lit(1)).alias("size"))
    centers = [(i, float(c[0]), float(c[1])) for i, c in enumerate(fitted.clusterCenters())]
    found = sizes.join(spark.createDataFrame(centers, "prediction int, x double, y double"), "prediction")
    return rounded_columns(found.select("size", "x", "y"), 4, "x", "y")


_HELD_OUT = "SELECT COUNT(*) AS n FROM held WHERE is_test"


@query(
    "train_all",
    clean_sql(
        f"""SELECT model, CAST(n AS DOUBLE) AS held_out, TRUE AS in_range FROM ({_HELD_OUT}) h,
        (VALUES ('gradient_boosting'), ('logistic_regression'), ('random_forest'), ('kmeans')) m(model)""",
        HELD,
    ),
)
def train_all(spark, sf_dir):
    """Per model: held-out rows that its run counted, and whether its scores are scores."""
    store = RunStore(spark, scratch_path(spark, "registry"))
    train_and_register(clean_customers(churn_raw(spark, sf_dir)), store, RUN_TRIALS)
    runs = store.table("runs").select("run_id", "model")
    counts = ["true_negatives", "false_positives", "false_negatives", "true_positives"]
    counted = F.col("metric").isin(*counts) | F.col("metric").rlike("^cluster_[0-9]+$")
    bounded = F.col("metric").isin("roc_auc", "accuracy", "precision", "recall", "f1_score", "cv_score", "silhouette_squared")
    return store.table("run_metrics").join(runs, "run_id").groupBy("model").agg(
        F.sum(F.when(counted, F.col("value"))).alias("held_out"),
        F.min(~bounded | F.col("value").between(-1.0, 1.0)).alias("in_range"),
    )


_THRESHOLD, _LOW, _HIGH = 0.35, 0.25, 0.6
_SETTINGS = {"threshold": _THRESHOLD, "low": _LOW, "high": _HIGH}


@query(
    "score_batch",
    clean_sql("SELECT customer_id, TRUE AS decided, TRUE AS banded, TRUE AS primary_is_one FROM held WHERE is_test", HELD),
)
def score_batch(spark, sf_dir):
    """The held-out customers through the batch job with settings of its own: are all decisions theirs?"""
    cleaned = clean_customers(churn_raw(spark, sf_dir))
    root = scratch_path(spark, "batch")
    store = RunStore(spark, f"{root}/registry")
    train_and_register(cleaned, store, RUN_TRIALS)
    batch = split.stratified_split(cleaned).where("is_test").drop("is_test", "churn")
    out = run_batch(store, batch, root, AT, **_SETTINGS).predictions
    p = F.col("churn_probability")
    band = F.when(p >= _HIGH, "High").when(p >= _LOW, "Medium").otherwise("Low")
    models = [F.col(c) for c in scoring.probability_columns(out)]
    return out.select(
        "customer_id", ((F.col("churn_prediction") == 1) == (p >= _THRESHOLD)).alias("decided"),
        (F.col("risk_group") == band).alias("banded"), F.array_contains(F.array(*models), p).alias("primary_is_one"),
    )


@query(
    "weekly_summary",
    clean_sql(
        f"""SELECT metric, CAST(n AS DOUBLE) AS value FROM ({_HELD_OUT}) h,
        (VALUES ('n_customers'), ('risk_group'), ('segment')) m(metric)""",
        HELD,
    ),
)
def weekly_summary(spark, sf_dir):
    """A whole weekly run; its customers, risk groups and segments must each add up to the held-out part."""
    root = scratch_path(spark, "weekly")
    summary = run_weekly(churn_raw(spark, sf_dir), root, RUN_TRIALS, AT, settings=_SETTINGS).summary
    totals = summary.groupBy("metric").agg(F.sum("value").alias("value"))
    return totals.where(F.col("metric").isin("n_customers", "risk_group", "segment"))


@query("report_sinks", f"WITH {SCORED} SELECT 'n_customers' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM scored")
def report_sinks(spark, sf_dir):
    """A report written as JSON lines and read back."""
    rows = scored(spark, sf_dir).agg(F.count(F.lit(1)).cast("double").alias("value"))
    path = writers.write_report(rows.select(F.lit("n_customers").alias("metric"), "value"), scratch_path(spark, "report"))
    return spark.read.schema("metric string, value double").json(path)


_DECIDED = """SELECT *, CAST(CASE WHEN churn_probability >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS churn_prediction,
CASE WHEN churn_probability >= 0.5 THEN 'Yes' ELSE 'No' END AS churn_label,
CASE WHEN churn_probability >= 0.7 THEN 'High' WHEN churn_probability >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_group"""


@query("incremental_scoring", f"WITH {SCORED} {_DECIDED} FROM scored")
def incremental_scoring(spark, sf_dir):
    """Two deliveries, each scored once; a call without new files changes nothing."""
    root = scratch_path(spark, "incremental")
    rows = scored(spark, sf_dir)
    for delivery in (F.col("segment") < 2, F.col("segment") >= 2):
        rows.where(delivery).write.mode("append").parquet(f"{root}/inbox")
        for _ in range(2):
            score_new_files(
                spark, f"{root}/inbox", rows.schema, scoring.add_decision, f"{root}/out", f"{root}/progress"
            )
    decided = scoring.add_decision(rows)
    return writers.read_history(spark, f"{root}/out", decided.schema).drop("batch_id")
