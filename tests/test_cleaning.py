from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stayline.functions import text
from stayline.operators import clean, encode, quality, services
from stayline.plans.cleaning import CLEANED_SCHEMA, clean_customers, clean_with_log, typed
from stayline.plans.etl import prepare_batch, run_etl
from stayline.session import scratch_path


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("customerID", "customer_id"),
        ("SeniorCitizen", "senior_citizen"),
        ("StreamingTV", "streaming_tv"),
        ("HTTPServer", "http_server"),
        ("total charges", "total_charges"),
        ("monthly-charges", "monthly_charges"),
        ("price ($)", "price"),
        ("__a__b__", "a_b"),
        ("already_snake", "already_snake"),
        ("tenure", "tenure"),
    ],
)
def test_snake_case(make, name, expected):
    assert text.snake_case(name) == expected
    values = make([(name,)], "v string").select(text.snake_case_column(F.col("v")).alias("v"))
    assert column(values, "v") == [expected]


def test_columns_are_renamed(raw):
    renamed = clean.standardize_columns(raw)
    assert renamed.columns[:3] == ["customer_id", "gender", "senior_citizen"]
    assert renamed.count() == 3


def test_colliding_names_are_refused(make):
    with pytest.raises(ValueError, match="collide"):
        clean.standardize_columns(make([(1, 2)], "`A b` int, A_b int"))


@pytest.mark.parametrize(
    "value, expected",
    [
        ("month-to-month", "Month-To-Month"),
        ("BANK TRANSFER (automatic)", "Bank Transfer (Automatic)"),
        ("7590-VHVEG", "7590-Vhveg"),
        ("3rd floor", "3Rd Floor"),
        ("it's", "It'S"),
        ("éCLAIR au lait", "Éclair Au Lait"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(make, value, expected):
    df = make([(value,)], "v string").select(text.title_case(F.col("v")).alias("v"))
    assert column(df, "v") == [expected]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("12.5", 12.5),
        (" 7 ", 7.0),
        ("-3", -3.0),
        (".5", 0.5),
        ("1e3", 1000.0),
        ("1d", None),
        (" ", None),
        ("", None),
        ("abc", None),
        ("nan", None),
        (None, None),
    ],
)
def test_number_reading(make, value, expected):
    df = make([(value,)], "v string").select(text.to_number(F.col("v")).alias("v"))
    assert column(df, "v") == [expected]


def test_numeric_coercion_keeps_ids_as_text(make):
    df = clean.coerce_numeric(make([(7, "29.85"), (8, "bad")], "customer_id int, total_charges string"))
    assert dict(df.dtypes) == {"customer_id": "string", "total_charges": "double"}
    assert sorted(column(df, "total_charges"), key=str) == [29.85, None]


def test_full_duplicates_count_missing_as_equal(make):
    df = make([("a", None), ("a", None), ("b", 1)], "k string, v int")
    assert clean.remove_duplicates(df).count() == 2
    info = clean.duplicate_info(df).first()
    assert (info.initial_rows, info.duplicates_removed, info.final_rows) == (3, 1, 2)


def test_subset_keeps_the_first_row(make):
    df = make([(3, "a", "x"), (1, "a", "y"), (2, "b", None)], "i int, k string, v string")
    kept = clean.remove_duplicates(df, ["k"], "i")
    assert sorted(map(tuple, kept.collect())) == [(1, "a", "y"), (2, "b", None)]
    with pytest.raises(ValueError, match="order_by"):
        clean.remove_duplicates(df, ["k"])
    info = clean.duplicate_info(df, ["k"]).first()
    assert (info.duplicates_removed, info.subset_columns) == (1, "k")


def test_text_is_trimmed_unified_and_titled(make):
    df = make(
        [("  female ", "No internet service"), ("MALE\t", "no internet service"), (None, "No phone service")],
        "g string, s string",
    )
    rows = [tuple(r) for r in clean.normalize_text(df).collect()]
    assert rows == [("Female", "No"), ("Male", "No Internet Service"), (None, "No")]


def test_excluded_columns_stay(make):
    df = clean.normalize_text(make([("ab-CD", "x")], "id string, v string"), exclude=["id"])
    assert tuple(df.first()) == ("ab-CD", "X")


def test_normalization_changes(make):
    df = make([("Yes", "yes"), ("No", "No"), (None, None)], "same string, other string")
    assert {r["column"]: r["changed"] for r in clean.normalization_changes(df).collect()} == {
        "same": False,
        "other": True,
    }


def test_median_and_mean_fill(make):
    df = make([(10.0, "a"), (20.0, None), (None, "b"), (60.0, "b")], "x double, t string")
    assert column(clean.fill_missing(df), "x") == [10.0, 20.0, 20.0, 60.0]
    mean = clean.fill_missing(df, strategy="mean")
    assert column(mean, "x") == [10.0, 20.0, 30.0, 60.0]
    assert column(mean, "t") == ["a", "Unknown", "b", "b"]
    assert column(clean.fill_missing(df, text_fill="?"), "t") == ["a", "?", "b", "b"]


def test_median_interpolates_and_empty_column_stays_missing(make):
    df = make([(1, None), (2, None), (4, None), (9, None), (None, None)], "x int, e double")
    filled = clean.fill_missing(df)
    assert column(filled, "x") == [1.0, 2.0, 4.0, 9.0, 3.0]
    assert column(filled, "e") == [None] * 5


def test_fill_uses_rows_left_after_dropping(make):
    df = make([(1.0, "a", "b"), (3.0, "a", None), (100.0, None, None)], "x double, s string, t string")
    kept = clean.fill_missing(df, strategy="mean", drop_threshold=0.5)
    assert column(kept, "x") == [1.0, 3.0]


def test_sparse_row_threshold_is_strict(make):
    df = make([(1, None), (None, None), (1, 2)], "a int, b int")
    assert clean.drop_sparse_rows(df, 0.5).count() == 2


def test_impossible_values_become_null(make):
    df = make(
        [(-5.0, 5.0, 10.0), (3.0, 1.0, -1.0), (None, None, 2.0)],
        "tenure double, senior_citizen double, total_charges double",
    )
    fixed = clean.null_impossible(df)
    assert column(fixed, "tenure") == [None, 3.0, None]
    assert column(fixed, "senior_citizen") == [None, 1.0, None]
    assert column(fixed, "total_charges") == [10.0, None, 2.0]
    counts = {r["column"]: r for r in clean.impossible_counts(df).collect()}
    assert (counts["tenure"].before, counts["tenure"].below_min, counts["tenure"].after) == (1, 1, 2)
    assert counts["senior_citizen"].invalid_replaced == 1
    assert "monthly_charges" not in counts


def test_upper_bound_rule(make):
    df = make([(5,), (50,)], "x int")
    rules = {"x": {"max": 10}}
    assert column(clean.null_impossible(df, rules), "x") == [5, None]
    assert clean.impossible_counts(df, rules).first().above_max == 1


def test_outliers_are_capped_and_missing_stays(make):
    df = make([(float(x),) for x in [10, 11, 12, 13, 14, 1000]] + [(None,)], "tenure double")
    capped = column(clean.winsorize_iqr(df), "tenure")
    assert capped == [10.0, 11.0, 12.0, 13.0, 14.0, 17.5, None]
    report = clean.iqr_report(df).first()
    assert (report.lower_capped, report.upper_capped, report.upper_bound) == (0, 1, 17.5)


def test_nothing_to_cap_gives_an_empty_report(make):
    assert clean.iqr_report(make([(1.0,), (2.0,)], "tenure double")).count() == 0
    assert clean.winsorize_iqr(make([(1,)], "other int")).collect()[0].other == 1


def test_grouped_winsorizing(make):
    rows = [("a", float(x)) for x in [1, 2, 3, 4, 100]] + [("b", float(x)) for x in [100, 101, 102, 103]]
    df = clean.winsorize_iqr(make(rows, "g string, x double"), ["x"], ["g"])
    assert max(column(df.where("g = 'a'"), "x")) == 7.0
    assert sorted(column(df.where("g = 'b'"), "x")) == [100.0, 101.0, 102.0, 103.0]


def test_total_services(make):
    df = make(
        [("Yes", "No", "Fiber Optic"), ("no", "NO", "No"), (None, "Unknown", "Dsl")],
        "phone_service string, multiple_lines string, internet_service string",
    )
    assert column(services.total_services(df), "total_services") == [2, 0, 3]
    assert services.total_services(make([(1,)], "x int")).columns == ["x"]


def test_raw_service_flags(raw):
    flagged = services.service_flags(raw).orderBy("customerID")
    assert column(flagged, "total_services") == [2, 4, 2]
    assert column(flagged, "MultipleLines_flag") == [0, 0, 1]


def test_binary_flags(make):
    df = make(
        [("1", "Yes", "Male", "b", "x"), ("2", "No", "Female", "a", "y"), ("3", None, "Male", "b", "z")],
        "customer_id string, p string, gender string, other string, three string",
    )
    flagged = encode.binary_flags(df).orderBy("customer_id")
    assert column(flagged, "p_flag") == [1, 0, None]
    assert column(flagged, "gender_flag") == [1, 0, 1]
    assert column(flagged, "other_flag") == [1, 0, 1]
    assert "three_flag" not in flagged.columns and "customer_id_flag" not in flagged.columns


def test_multiclass_codes(make):
    df = make([("1", "c", "Yes"), ("2", "a", "No"), ("3", "b", None), ("4", None, None)], "customer_id string, k string, p string")
    coded = encode.multiclass_codes(df).orderBy("customer_id")
    assert column(coded, "k_encoded") == [3, 1, 2, None]
    assert "p_encoded" not in coded.columns
    assert encode.multiclass_mappings(df, max_unique=2) == {}
    assert encode.multiclass_mappings(df, exclude=["customer_id", "k"]) == {}


def test_wide_text_columns_are_not_coded(make):
    df = make([(f"v{i}", "ab"[i % 2]) for i in range(300)], "t string, k string")
    assert encode.low_cardinality(df, 10, ()) == {"k": ["a", "b"]}


def test_domain_is_sorted(make):
    domain = encode.category_domain(make([("Male",), ("Female",), (None,), ("Male",)], "gender string"))
    assert sorted((r.ordinal, r.value) for r in domain.collect()) == [(1, "Female"), (2, "Male")]


def test_schema_inspection(make):
    rows = [("1", "a", str(i) if i < 8 else "x", f"id{i}") for i in range(12)]
    found = {r["column"]: r for r in quality.inspect_schema(make(rows, "c string, k string, n string, i string")).collect()}
    assert found["c"].kind == "numeric_as_text"
    assert found["k"].kind == "categorical"
    assert (found["n"].kind, found["n"].numeric_values, found["n"].failed_conversions) == ("numeric_as_text", 8, 4)
    assert found["i"].kind is None
    assert quality.inspect_schema(make([], "a string")).count() == 0


def test_validation_of_a_clean_table(raw):
    cleaned = clean_customers(raw)
    summary = quality.validation_summary(cleaned).first()
    assert summary.is_valid and summary.issues == 0 and summary.total_rows == 3
    assert summary.total_columns == 22 and summary.duplicate_rows == 0


def test_validation_findings(make):
    df = make(
        [("a", -1.0, 600.0, "Male", 12), ("a", 5.0, 10.0, "Robot", -1), ("a", 5.0, 10.0, "Robot", -1), (None, None, 1.0, "male", 3)],
        "customer_id string, tenure double, monthly_charges double, gender string, total_services int",
    )
    found = {(r.check, r["column"]): r for r in quality.validation_report(df).collect()}
    assert found["missing_values", "tenure"].observed == 1
    assert found["below_minimum", "tenure"].severity == "issue"
    assert found["above_maximum", "monthly_charges"].severity == "warning"
    assert found["unexpected_values", "gender"].observed == 1
    assert found["services_negative", "total_services"].observed == -1
    assert found["services_above_limit", "total_services"].observed == 12
    assert found["duplicate_rows", None].observed == 1
    assert (found["id_not_unique", "customer_id"].observed, found["id_not_unique", "customer_id"].expected) == (1, 4)


def test_wrong_type_is_a_warning(make):
    report = quality.validation_report(make([("a", "1")], "customer_id string, tenure string"))
    assert [(r.check, r["column"], r.detail) for r in report.collect()] == [("type", "tenure", "string")]


def test_batch_contract(customers, make):
    batch = customers(4).drop("churn")
    assert quality.validate_batch(batch).count() == 4
    with pytest.raises(ValueError, match="not_empty"):
        quality.validate_batch(batch.where("false"))
    with pytest.raises(ValueError, match="id_present"):
        quality.validate_batch(batch.drop("customer_id"))
    with pytest.raises(ValueError, match="features_present"):
        quality.validate_batch(batch.drop("tenure"))
    with pytest.raises(ValueError, match="ids_unique"):
        quality.validate_batch(batch.union(batch.limit(1)))


def test_cleaning_job(raw):
    cleaned = clean_customers(raw.union(raw.limit(1))).orderBy("customer_id")
    assert cleaned.count() == 3
    assert ", ".join(f"{n} {t}" for n, t in cleaned.dtypes) == CLEANED_SCHEMA
    rows = cleaned.collect()
    assert rows[0].customer_id == "1111-Aaaaa" and rows[0].contract == "Month-To-Month"
    assert rows[2].total_charges == pytest.approx((29.85 + 1889.5) / 2)
    assert rows[2].online_security == "No" and rows[2].total_services == 2


def test_impossible_values_are_not_imputed_again(raw):
    dirty = raw.withColumn("tenure", F.when(F.col("tenure") == 34, -3).otherwise(F.col("tenure")))
    result = clean_with_log(dirty)
    assert sum(v is None for v in column(result.cleaned, "tenure")) == 1
    log = {(r.step, r["column"], r.metric): r.value for r in result.log.collect()}
    assert log["impossible_values", "tenure", "below_min"] == 1
    assert log["validation", None, "is_valid"] == 0
    assert log["final_shape", None, "columns"] == 22
    assert log["final_columns", "total_services", "position"] == 22


def test_counts_of_the_log_are_observed_by_the_write(spark, raw, tmp_path):
    raw.union(raw).union(raw.limit(1)).repartition(5).write.parquet(f"{tmp_path}/raw")
    source, reads = spark.read.parquet(f"{tmp_path}/raw"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    log = clean_with_log(source.mapInArrow(counted, source.schema)).log
    found = {(r.step, r.metric): r.value for r in log.where("step in ('remove_duplicates', 'initial_shape', 'final_shape')").collect()}
    assert found == {
        ("initial_shape", "rows"): 7, ("initial_shape", "columns"): 21, ("remove_duplicates", "initial_rows"): 7,
        ("remove_duplicates", "duplicates_removed"): 4, ("remove_duplicates", "final_rows"): 3,
        ("final_shape", "rows"): 3, ("final_shape", "columns"): 22,
    }
    assert reads.value == 7  # every row of the source was read once
    empty = {(r.step, r.metric): r.value for r in clean_with_log(source.where("false")).log.collect()}
    assert empty["initial_shape", "rows"] == empty["remove_duplicates", "final_rows"] == 0


def test_etl_skips_known_input_until_it_expires(spark, raw):
    root = scratch_path(spark, "etl")
    monday = datetime(2024, 1, 1, 9)
    first, built = run_etl(raw, root, monday)
    assert built and spark.read.parquet(f"{first}/cleaned").count() == 3
    assert spark.read.json(f"{first}/extraction").count() == 21
    assert spark.read.json(f"{first}/log").where("step = 'final_columns'").count() == 22
    assert run_etl(raw.orderBy(F.desc("customerID")), root, monday + timedelta(days=2)) == (first, False)
    again, built = run_etl(raw, root, monday + timedelta(days=4))
    assert built and again != first


def test_batch_is_rebuilt_only_for_a_new_source(spark, customers):
    root = scratch_path(spark, "batches")
    cleaned = customers(20)
    first, built = prepare_batch(cleaned, root, datetime(2024, 1, 1))
    assert built and spark.read.parquet(first).count() == 4
    assert prepare_batch(cleaned, root, datetime(2025, 1, 1)) == (first, False)
    other, built = prepare_batch(customers(25), root, datetime(2025, 1, 2))
    assert built and spark.read.parquet(other).count() == 6


def test_typed_does_not_depend_on_missing_columns(make):
    assert typed(make([("a",)], "customerID string")).columns == ["customer_id"]
