"""Inputs that the star-schema tables do not hold."""

from datetime import datetime

import pytest

from stayline.operators import champions, clean
from stayline.plans import etl
from stayline.sources import fingerprint, readers, writers


def digest(make, *rows):
    return fingerprint.dataset_fingerprint(make(rows, "a string, b string")).first()["fingerprint"]


def test_fingerprints_of_different_rows_differ(make):
    assert digest(make, ("a|b", "c")) != digest(make, ("a", "b|c"))
    assert digest(make, (None, "x")) != digest(make, ("\u2205", "x"))
    assert digest(make, (None, "x")) != digest(make, ("-", "x"))
    assert digest(make, ("1", "2"), ("3", "4")) == digest(make, ("3", "4"), ("1", "2"))


def test_settings_belong_to_the_reuse_key(make, tmp_path):
    source, built = make([(1,)], "a int"), []
    for settings in ("exact", "approximate", "exact"):
        etl.build_if_changed(source, str(tmp_path), built.append, datetime(2024, 1, 1), settings=settings)
    assert len(built) == 2 and len(set(built)) == 2


def test_whole_numbers_with_a_point(spark, make, tmp_path):
    path = str(tmp_path / "in.csv")
    make([("34.0", "x"), ("7", "y"), ("2.5", "z"), (" 8. ", "w"), ("NaN", "v")], "n string, s string").coalesce(1).write.option(
        "header", True
    ).csv(path)
    rows = readers.read_raw_csv(spark, path, make([], "n int, s string").schema).collect()
    assert {r["s"]: r["n"] for r in rows} == {"x": 34, "y": 7, "z": None, "w": 8, "v": None}


def test_reports_without_rule_columns_are_empty(make):
    other = make([(1,)], "other int")
    assert clean.impossible_counts(other).count() == 0 and clean.iqr_report(other).count() == 0
    nulls = make([(None, None)], "tenure double, monthly_charges double")
    assert clean.iqr_report(nulls).count() == 0 and clean.impossible_counts(nulls).count() == 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_champions_over_times(make, kind):
    rows = [("m", i, score) for i, score in enumerate([0.5, 0.4, 0.6, 0.6])]
    runs = make(rows, "model_name string, n int, cv_score double").selectExpr(
        "model_name", "cv_score", f"CAST(TIMESTAMP '2024-01-01' + make_dt_interval(0, n) AS {kind}) AS run_seq"
    )
    found = champions.champion_history(runs).orderBy("run_seq").collect()
    assert [(r.promoted, r.version) for r in found] == [(True, 1), (False, 1), (True, 2), (False, 2)]


def test_an_empty_batch_replaces_its_old_rows(spark, make, tmp_path):
    path, rows = str(tmp_path / "t"), make([(1,)], "a int")
    writers.append_batch(rows, path, "b1")
    writers.append_batch(rows, path, "b2")
    writers.append_batch(rows.where("false"), path, "b1")
    assert [r["batch_id"] for r in writers.read_history(spark, path, rows.schema).collect()] == ["b2"]


def test_normalization_changes_without_values(make):
    df = make([("No phone service", "Ok", None), ("No", "Fine", None)], "a string, b string, c string")
    assert {r["column"]: r["changed"] for r in clean.normalization_changes(df).collect()} == {"a": True, "b": False}
