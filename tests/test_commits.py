"""Commit logs: numbers without gaps, one winner each; registry and batches on top of them."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from stayline.plans.registry import RunStore
from stayline.session import scratch_path
from stayline.sources import writers
from stayline.sources.commits import CommitLog


@pytest.fixture
def log(spark):
    return CommitLog(spark, scratch_path(spark, "log"))


@pytest.mark.parametrize("entries", [0, 1, 2, 3, 7, 8, 9])
def test_newest_without_a_listing(log, entries):
    for n in range(1, entries + 1):
        assert log.put(n, {"n": n})
    assert log.newest() == entries
    assert log.read(entries) == ({"n": entries} if entries else None)
    assert log.read(entries + 1) is None and log.read(0) is None


def test_an_entry_is_never_replaced(log):
    assert log.put(1, {"by": "first"}) and not log.put(1, {"by": "second"})
    assert log.read(1) == {"by": "first"}


def test_writers_at_once_leave_no_gap_and_lose_nothing(log):
    def write(i):
        return log.append(lambda n, last: {"sum": (last or {"sum": 0})["sum"] + i})[0]

    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(write, range(1, 25)))
    assert sorted(numbers) == list(range(1, 25)) and log.newest() == 24
    assert log.read(24) == {"sum": sum(range(1, 25))}


def test_no_entry_means_no_commit(log):
    assert log.append(lambda n, last: None) == (0, None)
    log.put(1, {"a": 1})
    assert log.append(lambda n, last: None) == (1, {"a": 1})


def test_two_registrations_at_once(spark, monkeypatch):
    """Both see an empty registry; the one that comes second to version 1 challenges the first."""
    store = RunStore(spark, scratch_path(spark, "store"))
    good, better = (store.log_run("m", {}, {"cv_score": v}) for v in (0.8, 0.9))
    both_read, first_done = threading.Barrier(2), threading.Event()
    put, tries = CommitLog.put, []

    def raced(self, number, entry):
        tries.append((number, entry["run_id"]))
        if number == 1:
            both_read.wait(60)
            if entry["run_id"] == better:
                first_done.wait(60)
        placed = put(self, number, entry)
        first_done.set()
        return placed

    monkeypatch.setattr(CommitLog, "put", raced)
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(lambda r: store.register_champion("r", r), (good, better)))
    assert results == [(1, True), (2, True)]
    assert sorted(tries) == sorted([(1, good), (1, better), (2, better)])
    assert store.champion("r") == (2, better) and store.version("r", 1) == (1, good)
    rows = store.table("versions").orderBy("version").collect()
    assert [(r.registry, r.version, r.run_id) for r in rows] == [("r", 1, good), ("r", 2, better)]
    assert all(r.promoted_at is not None for r in rows)


def test_a_loser_that_is_worse_stays_out(spark, monkeypatch):
    store = RunStore(spark, scratch_path(spark, "store"))
    good, better = (store.log_run("m", {}, {"cv_score": v}) for v in (0.8, 0.9))
    put = CommitLog.put

    def overtaken(self, number, entry):
        monkeypatch.setattr(CommitLog, "put", put)
        assert store.register_champion("r", better) == (1, True)
        return put(self, number, entry)

    monkeypatch.setattr(CommitLog, "put", overtaken)
    assert store.register_champion("r", good) == (1, False)
    assert store.champion("r") == (1, better)


def test_names_of_registries_survive_as_folders(spark):
    store = RunStore(spark, scratch_path(spark, "store"))
    run = store.log_run("m", {}, {})
    assert store.register_champion("a/b=c d", run) == (1, True)
    assert [r.model for r in store.lineage().collect()] == ["a/b=c d"]


def test_the_latest_batch_opens_one_partition(spark, make):
    path, rows = scratch_path(spark, "batches"), make([("a", 1), ("b", 2)], "id string, v int")
    for v, batch in enumerate(["b1", "b3", "b2"]):
        writers.append_batch(rows.withColumn("v", F.lit(v)), path, batch)
    latest = writers.read_latest(spark, path, rows.schema)
    assert sorted(map(tuple, latest.collect())) == [("a", 1, "b3"), ("b", 1, "b3")]
    assert all("/batch_id=b3/" in f for f in latest.inputFiles())
    same = writers.latest_batch(writers.read_history(spark, path, rows.schema))
    assert same.schema == latest.schema and sorted(same.collect()) == sorted(latest.collect())


def test_the_latest_batch_may_become_empty(spark, make):
    path, rows = scratch_path(spark, "batches"), make([("a", 1)], "id string, v int")
    none = rows.where("false")
    assert writers.append_batch(none, path, "b0") == path
    assert writers.read_latest(spark, path, rows.schema).count() == 0
    for batch in ("b1", "b2", "b3"):
        writers.append_batch(rows, path, batch)
    writers.append_batch(none, path, "b2")
    writers.append_batch(none, path, "b3")
    assert [r.batch_id for r in writers.read_latest(spark, path, rows.schema).collect()] == ["b1"]
    writers.append_batch(rows, path, "b2")
    assert [r.batch_id for r in writers.read_latest(spark, path, rows.schema).collect()] == ["b2"]


def test_an_uncommitted_batch_is_not_the_latest(spark, make):
    path, rows = scratch_path(spark, "batches"), make([("a", 1)], "id string, v int")
    writers.append_batch(rows, path, "b1")
    rows.write.parquet(f"{path}/batch_id=b2")
    assert [r.batch_id for r in writers.read_latest(spark, path, rows.schema).collect()] == ["b1"]


def test_a_table_without_a_log(spark, make):
    path, rows = scratch_path(spark, "batches"), make([("a", 1)], "id string, v int")
    rows.write.parquet(f"{path}/batch_id=b7")
    assert [r.batch_id for r in writers.read_latest(spark, path, rows.schema).collect()] == ["b7"]


def test_by_rename_where_links_are_not_at_hand(log, monkeypatch):
    monkeypatch.setattr(CommitLog, "_local", staticmethod(lambda path: None))
    assert log.put(1, {"by": "first"}) and not log.put(1, {"by": "second"})
    assert log.append(lambda n, last: {"by": last["by"] + ", then another"}) == (2, {"by": "first, then another"})
    assert log.newest() == 2 and log.read(2) == {"by": "first, then another"}
