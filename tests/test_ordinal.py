import random

import pytest
from pyspark.sql import functions as F

from stayline.functions import ordinal
from stayline.operators import scoring


def test_ordinals_are_dense_and_in_order(make):
    rng = random.Random(2)
    # One value holds a third of the rows: ties may come in any order, numbers still occur once.
    rows = [(rng.choice([5, rng.randint(0, 9), None]), i) for i in range(3_000)]
    found = ordinal.with_ordinal(make(rows, "x int, id int").repartition(9), [F.col("x").desc(), "id"]).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert sorted((r["ordinal"], r["x"], r["id"]) for r in found) == [(n, *r) for n, r in enumerate(want)]
    assert ordinal.with_ordinal(make([], "x int"), ["x"]).count() == 0


def test_read_back_in_batch_order(spark, make, tmp_path):
    """Shuffled by a join in between, split into many files and blocks: the sink holds the batch's order."""
    ids = random.Random(3).sample(range(2_000), 2_000)
    batch = make([(n, f"id-{i}", 0.5) for n, i in enumerate(ids)], "ordinal long, customer_id string, churn_probability double")
    source = make([(f"id-{i}", "Yes", i) for i in range(0, 2_000, 2)], "customer_id string, churn string, tenure int")
    enriched = scoring.enrich(batch.repartition(8, "customer_id"), source.hint("merge"))
    ordinal.write_in_order(enriched, f"{tmp_path}/sink")
    back = ordinal.read_in_order(spark, f"{tmp_path}/sink").collect()
    assert [r["customer_id"] for r in sorted(back, key=lambda r: r["ordinal"])] == [f"id-{i}" for i in ids]
    assert sorted(r["ordinal"] for r in back) == list(range(2_000))
    assert sum(r["churn_actual"] is None for r in back) == 1_000


def test_text_files_split_into_blocks_keep_their_order(spark, tmp_path):
    (tmp_path / "b.csv").write_text("n\n" + "".join(f"{i}\n" for i in range(5_000)))
    (tmp_path / "a.csv").write_text("n\n" + "".join(f"{i}\n" for i in range(-70, 0)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = ordinal.with_file_order(spark.read.option("header", True).schema("n int").csv(str(tmp_path))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["n"] for r in sorted(rows, key=lambda r: r["ordinal"])] == list(range(-70, 5_000))


@pytest.mark.parametrize("names", [["part-99999-x.parquet", "part-100000-x.parquet"], ["x-1", "x-2", "part-00000-a"]])
def test_files_follow_their_numbers(names):
    assert sorted(names, key=ordinal._part_number) == names
