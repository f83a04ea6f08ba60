from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stayline import schema
from stayline.functions.times import utc_literal
from stayline.operators import champions, compare, scoring
from stayline.plans.registry import PRIMARY, RunStore
from stayline.session import scratch_path
from stayline.sources import fingerprint, readers, writers
from stayline.streaming.incremental import score_new_files


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


# -- decisions -----------------------------------------------------------------


@pytest.mark.parametrize(
    "probability, band",
    [(0.0, "Low"), (0.3999, "Low"), (0.4, "Medium"), (0.6999, "Medium"), (0.7, "High"), (1.0, "High"), (None, "Low"), (float("nan"), "Low")],
)
def test_risk_bands(make, probability, band):
    df = make([(probability,)], "p double").select(scoring.risk_group(F.col("p")).alias("g"))
    assert column(df, "g") == [band]


def test_custom_bands(make):
    df = make([(0.2,), (0.3,)], "p double").select(scoring.risk_group(F.col("p"), 0.1, 0.3).alias("g"))
    assert column(df, "g") == ["Medium", "High"]


def test_decision_threshold(make):
    df = scoring.add_decision(make([(0.5,), (0.49,), (None,)], "churn_probability double"))
    assert column(df, "churn_prediction") == [1, 0, 0]
    assert column(df, "churn_label") == ["Yes", "No", "No"]


def test_metadata_has_one_utc_timestamp(make):
    at = datetime(2024, 1, 1, 10, 0, tzinfo=timezone(timedelta(hours=1)))
    df = scoring.add_metadata(make([("a",), ("b",)], "customer_id string"), "models:/m@champion", "b1", at, 3)
    assert {tuple(r)[1:] for r in df.collect()} == {(datetime(2024, 1, 1, 9, 0), "models:/m@champion", 3, "b1")}
    assert scoring.batch_id(datetime(2024, 1, 2, 3, 4, 5)) == "20240102T030405"


@pytest.mark.parametrize(
    "uri, parts",
    [
        ("models:/churn@champion", ("churn", "champion", None)),
        ("models:/churn/7", ("churn", None, "7")),
        ("runs:/abc/model", None),
        (None, None),
    ],
)
def test_uri_parts(make, uri, parts):
    found = make([(uri,)], "u string").select(scoring.uri_parts(F.col("u")).alias("p")).first().p
    assert (tuple(found) if found else None) == parts


def test_feature_projection(customers):
    df = customers(2)
    assert set(scoring.feature_projection(df).columns) == set(schema.FEATURES)
    assert set(scoring.feature_projection(df.drop("churn")).columns) == set(schema.FEATURES)
    with pytest.raises(ValueError, match="churn"):
        scoring.feature_projection(df.drop("churn"), strict=True)


def test_enrichment(customers, make):
    source = customers(3)
    predictions = make([("id-2", 0.9), ("id-0", 0.1), ("gone", 0.5)], "customer_id string, churn_probability double")
    enriched = scoring.enrich(predictions, source)
    assert enriched.columns == [*[c if c != "churn" else "churn_actual" for c in source.columns], "churn_probability"]
    rows = {r.customer_id: r for r in enriched.collect()}
    assert len(rows) == 3 and rows["gone"].churn_actual is None and rows["gone"].churn_probability == 0.5
    assert (rows["id-2"].churn_actual, rows["id-2"].monthly_charges) == ("Yes", 2.0)
    assert scoring.unmatched(predictions, source).first().unmatched == 1
    assert scoring.enrich(predictions, None) is predictions


def test_enrichment_keeps_duplicate_source_rows(customers, make):
    source = customers(1).union(customers(1))
    predictions = make([("id-0", 0.1)], "customer_id string, churn_probability double")
    assert scoring.enrich(predictions, source).count() == 2


# -- comparison ----------------------------------------------------------------


@pytest.fixture
def batch(make):
    return make(
        [("a", 0.9, 0.8, 0.7), ("b", 0.1, 0.2, 0.3), ("c", 0.9, 0.1, 0.6), ("d", 0.2, 0.45, 0.55)],
        "customer_id string, churn_probability_lr double, churn_probability_rf double, churn_probability_gb double",
    ).withColumn("churn_probability", F.col("churn_probability_gb"))


def test_comparison(batch, make):
    lineage = make([("lr", "models:/lr@champion", 4)], "model string, model_uri string, model_version int")
    rows = {r.model: r for r in compare.model_comparison(batch, lineage).collect()}
    assert sorted(rows) == ["gb", "lr", "rf"]
    lr, rf, gb = rows["lr"], rows["rf"], rows["gb"]
    assert lr.mean_churn_probability == pytest.approx(0.525)
    assert lr.median_churn_probability == pytest.approx(0.55)
    assert (lr.n_predicted_churn, rf.n_predicted_churn, gb.n_predicted_churn) == (2, 1, 3)
    assert (rf.risk_low, rf.risk_medium, rf.risk_high) == (2, 1, 1)
    assert (lr.agreement_with_consensus, rf.agreement_with_consensus, gb.agreement_with_consensus) == (1.0, 0.75, 0.75)
    assert (lr.batch_all_agree_churn, lr.batch_all_agree_no_churn, lr.batch_disagree) == (1, 1, 2)
    assert lr.batch_agreement_rate == 0.5
    assert lr.batch_mean_probability_spread == pytest.approx((0.2 + 0.2 + 0.8 + 0.35) / 4)
    assert (lr.model_uri, lr.model_version, rf.model_uri) == ("models:/lr@champion", 4, None)


def test_even_tie_is_no_churn(batch):
    two = batch.drop("churn_probability_gb")
    agreement = {r.customer_id: r for r in compare.customer_agreement(two).collect()}
    assert not agreement["c"].consensus_churn and agreement["c"].agreement == "disagree"
    assert agreement["a"].agreement == "all_churn" and agreement["b"].agreement == "all_no_churn"


def test_comparison_edge_cases(batch):
    with pytest.raises(ValueError, match="no 'churn_probability_"):
        compare.model_comparison(batch.select("customer_id", "churn_probability"))
    empty = compare.model_comparison(batch.where("false")).collect()
    assert len(empty) == 3 and {r.batch_agreement_rate for r in empty} == {0.0}
    single = compare.model_comparison(batch.select("customer_id", "churn_probability_lr")).first()
    assert (single.batch_disagree, single.batch_mean_probability_spread) == (0, 0.0)


def test_batch_summary_adds_up(make):
    rows = [(f"k{i}", i / 11, None if i == 3 else (10 - i) / 11, int(i > 6), schema.RISK_GROUPS[i % 3], i // 4) for i in range(11)]
    rows.append(("nan", float("nan"), float("nan"), 0, "Low", None))
    df = make(
        rows,
        "customer_id string, churn_probability double, churn_probability_rf double, churn_prediction int, risk_group string, segment int",
    )
    found = {(r.metric, r.key): r.value for r in compare.batch_summary(df, "/out").collect()}
    assert found["n_customers", None] == 12 and found["n_predicted_churn", None] == 4
    assert [found["risk_group", g] for g in schema.RISK_GROUPS] == [5, 4, 3]
    assert found["avg_churn_probability", None] == pytest.approx(5 / 11)
    assert found["avg_churn_probability_per_model", "rf"] == pytest.approx((55 - 7) / 110)
    assert [found["segment", str(s)] for s in range(3)] == [4, 4, 3] and ("output_path", "/out") in found
    assert ("segment", "0") not in {(r.metric, r.key) for r in compare.batch_summary(df.drop("segment")).collect()}


def test_nan_is_no_vote(make):
    nan = float("nan")
    df = make(
        [("a", nan, 0.9, 0.2), ("b", None, nan, 0.7)],
        "customer_id string, churn_probability_x double, churn_probability_y double, churn_probability_z double",
    )
    found = {r.customer_id: r for r in compare.customer_agreement(df).collect()}
    assert (found["a"].churn_votes, found["b"].churn_votes) == (1, 1)
    assert found["a"].probability_spread == pytest.approx(0.7) and found["b"].max_probability == 0.7
    models = {r.model: r for r in compare.model_comparison(df).collect()}
    assert models["y"].n_predicted_churn == 1 and models["y"].mean_churn_probability == pytest.approx(0.9)
    assert models["x"].mean_churn_probability is None
    assert models["x"].batch_mean_probability_spread == pytest.approx(0.35)


def test_long_probabilities(batch):
    long = scoring.probabilities_long(batch)
    assert long.count() == 12 and set(column(long, "model")) == {"lr", "rf", "gb"}


# -- champions -----------------------------------------------------------------


def sequential(rows):
    """The promotion rule applied run by run."""
    best, seen, versions, out = {}, set(), {}, {}
    for run, model, value in sorted(rows):
        score = None if value is None or value != value else value
        wins = model not in seen or (score is not None and (best[model] is None or score > best[model]))
        if wins:
            best[model] = score
            versions[model] = versions.get(model, 0) + 1
        seen.add(model)
        out[run] = (wins, versions[model])
    return out


def test_history_equals_sequential_rule(make):
    rows = [
        (i, "hot" if i % 3 else f"m{i % 5}", None if i % 7 == 0 else float("nan") if i % 11 == 0 else (i * 37 % 100) / 100)
        for i in range(400)
    ]
    history = champions.champion_history(make(rows, "run_seq int, model_name string, cv_score double"))
    found = {r.run_seq: (r.promoted, r.version) for r in history.collect()}
    assert found == sequential(rows)
    current = {r.model_name: r.run_seq for r in champions.current_champions(make(rows, "run_seq int, model_name string, cv_score double")).collect()}
    last = {}
    for run, model, _ in sorted(rows):
        if found[run][0]:
            last[model] = run
    assert current == last


def test_best_run_prefers_the_earlier_on_ties(make):
    rows = [(1, "lr", 0.8), (2, "rf", 0.9), (3, "gb", 0.9), (4, "kmeans", 0.99), (5, "lr", None)]
    df = make(rows, "run_seq int, model_name string, cv_score double")
    best = champions.best_run(df, ("lr", "rf", "gb")).first()
    assert (best.model_name, best.run_seq) == ("rf", 2)
    assert champions.best_run(df.where("run_seq = 5")).count() == 0


@pytest.fixture
def store(spark):
    return RunStore(spark, scratch_path(spark, "store"))


def run(store, value):
    return store.log_run("m", {"C": 1}, {} if value is None else {"cv_score": value})


@pytest.mark.parametrize(
    "first, second, promoted",
    [
        (0.8, 0.9, True),
        (0.8, 0.7, False),
        (0.8, 0.8, False),
        (0.8, None, False),
        (None, 0.1, True),
        (None, None, False),
        (0.8, float("nan"), False),
    ],
)
def test_promotion_rule(store, first, second, promoted):
    assert store.register_champion("r", run(store, first)) == (1, True)
    challenger = run(store, second)
    assert store.register_champion("r", challenger) == (2 if promoted else 1, promoted)
    assert (store.champion("r")[1] == challenger) is promoted


def test_another_metric_can_rank(store):
    weak = store.log_run("m", {}, {"cv_score": 0.1, "f1": 0.9, "note": "x", "matrix": [[1]]})
    strong = store.log_run("m", {}, {"cv_score": 0.9, "f1": 0.1})
    assert store.register_champion("r", strong, "f1") == (1, True)
    assert store.register_champion("r", weak, "f1") == (2, True)
    assert sorted(column(store.table("run_metrics"), "metric")) == ["cv_score", "cv_score", "f1", "f1"]


def test_only_classifiers_contest_the_primary(store):
    def log(model, value):
        return store.log_run(model, {}, {"cv_score": value})

    runs = {m: log(m, v) for m, v in [("logistic_regression", 0.8), ("random_forest", 0.85), ("gradient_boosting", 0.85), ("kmeans", 0.99)]}
    results = store.register_models(runs)
    assert results[PRIMARY] == (1, True) and store.champion(PRIMARY)[1] == runs["random_forest"]
    assert len(results) == 5
    unscored = RunStore(store.spark, store.root + "-2")
    assert PRIMARY not in unscored.register_models({"random_forest": unscored.log_run("random_forest", {}, {})})
    assert unscored.load_champion(PRIMARY) is None
    assert {r.model: r.model_version for r in store.lineage().collect()}[PRIMARY] == 1


# -- sources and sinks -----------------------------------------------------------


def test_raw_csv_tokens(spark, raw, tmp_path):
    lines = [",".join(schema.RAW_SCHEMA.names)]
    values = ["NA", "null", "", "None", "x", " ", "7", "  y "]
    cells = values + ["No"] * (len(schema.RAW_SCHEMA) - len(values))
    cells[2], cells[5] = "N/A", "3"
    lines.append(",".join(cells[:18] + ["NaN", " ", "Yes"]))
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    row = readers.read_raw_csv(spark, str(tmp_path / "raw.csv")).first()
    assert (row.customerID, row.gender, row.SeniorCitizen, row.Partner) == (None, None, None, None)
    assert (row.tenure, row.MultipleLines, row.MonthlyCharges, row.TotalCharges) == (3, "  y ", None, " ")


def test_batch_reader_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_batch(spark, str(tmp_path / "none.parquet"))
    (tmp_path / "batch.xlsx").write_text("x")
    with pytest.raises(ValueError, match="xlsx"):
        readers.read_batch(spark, str(tmp_path / "batch.xlsx"))
    (tmp_path / "batch.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="schema"):
        readers.read_batch(spark, str(tmp_path / "batch.csv"))


def test_batch_reader_formats(spark, customers):
    df = customers(5)
    for suffix, write in ((".parquet", lambda p: df.write.parquet(p)), (".csv", lambda p: df.write.option("header", True).csv(p))):
        path = scratch_path(spark, "batch") + suffix
        write(path)
        back = readers.read_batch(spark, path, df.schema)
        assert back.dtypes == df.dtypes and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_fingerprint_ignores_order_but_not_content(make):
    rows = [("a", 1), ("b", None), ("b", None)]

    def print_of(r):
        return fingerprint.dataset_fingerprint(make(r, "k string, v int")).first().fingerprint

    assert len(print_of(rows)) == 32
    assert print_of(rows) == print_of(rows[::-1])
    assert print_of(rows) != print_of(rows[:2])
    assert print_of(rows) != print_of([("a", 2), *rows[1:]])
    assert print_of([("a", 1)]) != print_of([("a", 1)] * 3)


def test_extraction_profile(raw):
    rows = {r["column"]: r for r in fingerprint.extraction_profile(raw).collect()}
    assert len(rows) == 21 and rows["tenure"].type == "int" and rows["customerID"].rows == 3


def test_gate_expires(make):
    manifest = make([("old",), ("new",)], "fingerprint string").withColumn(
        "created_at", F.when(F.col("fingerprint") == "old", utc_literal(datetime(2024, 1, 1))).otherwise(utc_literal(datetime(2024, 1, 9)))
    )
    inputs = make([("old",), ("new",), ("unseen",)], "fingerprint string")
    assert sorted(column(fingerprint.pending(inputs, manifest, datetime(2024, 1, 10)), "fingerprint")) == ["old", "unseen"]


def test_cleaned_and_report_sinks(spark, make):
    df = make([("a", 1.5), ("b", None)], "k string, v double")
    path = writers.write_cleaned(df, scratch_path(spark, "sink"), with_csv=True)
    assert spark.read.parquet(path).count() == 2
    assert spark.read.option("header", True).csv(f"{path}.csv").columns == ["k", "v"]
    with pytest.raises(Exception, match="already exists"):
        writers.write_cleaned(df, path)
    report = writers.write_report(df, scratch_path(spark, "report"))
    assert spark.read.json(report).count() == 2


def test_batches_append_once_and_latest_wins(spark, make):
    path = scratch_path(spark, "history")
    df = make([("a", 1)], "customer_id string, v int")
    for batch in ("b1", "b2", "b2"):
        writers.append_batch(df.withColumn("v", F.lit(len(batch))), path, batch)
    history = writers.read_history(spark, path, df.schema)
    assert sorted(column(history, "batch_id")) == ["b1", "b2"]
    assert column(writers.latest_batch(history), "batch_id") == ["b2"]


def test_new_files_are_scored_once(spark, make):
    root = scratch_path(spark, "stream")
    df = make([("a", 0.9), ("b", 0.1)], "customer_id string, churn_probability double")

    def deliver(rows):
        rows.write.mode("append").parquet(f"{root}/in")
        score_new_files(spark, f"{root}/in", df.schema, scoring.add_decision, f"{root}/out", f"{root}/ck")
        decided = scoring.add_decision(df)
        return writers.read_history(spark, f"{root}/out", decided.schema)

    assert deliver(df).count() == 2
    later = deliver(df.withColumn("customer_id", F.concat("customer_id", F.lit("2"))))
    assert sorted(column(later, "customer_id")) == ["a", "a2", "b", "b2"]
    assert later.where("churn_prediction = 1").count() == 2
