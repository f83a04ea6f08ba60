"""Line keys, range-partitioned runs with hot keys, bitmaps and texts against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stayline.llm.line_dedup import drop_repeated_lines, keep_bitmaps, kept_lines, line_keys
from stayline.llm.runs import repeated_rows


def brute(rows, min_docs, keep_first):
    """{(doc_id, text): kept lines} over distinct rows; null ids order first."""
    where = defaultdict(set)
    distinct = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for row in distinct:
        for key in line_keys((row[1] or "").encode()):
            if key:
                where[key].add(row)
    place = {row: i for i, row in enumerate(distinct)}
    out = {}
    for row in distinct:
        lines = (row[1] or "").encode().split(b"\n")
        keys = line_keys((row[1] or "").encode())
        stays = []
        for line, key in zip(lines, keys):
            seen = where[key] if key else set()
            first = min((r[0] is not None, r[0] or 0) for r in seen) if seen else None
            gone = len(seen) >= min_docs and not (keep_first and (row[0] is not None, row[0] or 0) == first)
            if not gone:
                stays.append(line)
        out[row] = b"\n".join(stays).decode()
    return out


def random_rows(seed):
    rng = random.Random(seed)
    lines = [f"Line {i}" for i in range(12)] + ["", "  ", "\tHot line ", "HOT LINE", "é ", "x" * 3000]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))) for i in range(80)]
    rows += [(i, "hot line\n" * rng.randint(1, 3) + f"own {i}") for i in range(100, 220)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, "hot line\nof no id"), (None, None)]
    return rows + rows[3:6]  # repeated rows


@pytest.mark.parametrize("min_docs, keep_first", [(2, True), (10, False), (10, True), (3, False)])
def test_against_brute_force(documents, rows_of, min_docs, keep_first):
    rows = random_rows(min_docs)
    want = brute(rows, min_docs, keep_first)
    got = rows_of(drop_repeated_lines(documents(rows), min_docs, keep_first), "doc_id", "text")
    expected = sorted(((d, want[d, t] if t is not None else None) for d, t in rows), key=repr)
    assert got == expected


def test_other_columns_stay(documents):
    docs = documents([(1, "a\nb"), (2, "a\nc")])
    out = drop_repeated_lines(docs)
    assert out.columns == docs.columns
    assert {r["text"] for r in out.collect()} == {"a\nb", "c"}
    assert {r["keep"] for r in out.collect()} == {"k"}


def test_bitmaps_hold_the_lines(documents):
    text = "A \nb\n a\nc"
    got = keep_bitmaps(documents([(1, text), (2, "a\nz")]), min_docs=2, keep_first=False).where("doc = 1").first()
    assert (got["n_lines"], got["n_dropped"]) == (4, 2)
    assert kept_lines(text.encode(), bytes(got["keep"])) == b"b\nc"


def test_empty_table(documents, rows_of):
    assert rows_of(drop_repeated_lines(documents([])), "doc_id", "text") == []
    assert keep_bitmaps(documents([])).count() == 0


def test_only_ascii_is_folded():
    assert line_keys("\x0bÀB\x0c\nſK".encode()) == ["Àb".encode(), "ſk".encode()]


@pytest.mark.parametrize("keep_first", [True, False])
def test_a_hot_key_spans_partitions(spark, keep_first):
    """One key holds most rows: runs are cut by partitions, yet every row is judged by the whole."""
    hot = [(5, 5, doc, position) for doc in range(3000) for position in (0, 1)]
    rare = [(k, 1, k, 0) for k in range(-500, 500)] + [(9, 9, 1, 0), (9, 9, 2, 0)]
    keyed = spark.createDataFrame(hot + rare, "k1 long, k2 long, doc long, at long").withColumn("tag", F.col("doc") % 7).repartition(5)
    got = {(r["doc"], r["at"]) for r in repeated_rows(keyed, "test", 2, keep_first).collect()}
    want = {(d, p) for _, _, d, p in hot if not keep_first or d != 0} | ({(2, 0)} if keep_first else {(1, 0), (2, 0)})
    assert got == want
    many = repeated_rows(keyed, "test", 3001, keep_first)
    assert many.count() == 0


def test_first_documents_connect_a_hot_key(spark):
    hot = [(5, 5, doc, 0) for doc in range(3000)]
    keyed = spark.createDataFrame(hot, "k1 long, k2 long, doc long, at long").withColumn("tag", F.col("doc") % 7).repartition(5)
    rows = repeated_rows(keyed, "test", 2, with_first=True).collect()
    assert {r["doc"] for r in rows} == set(range(3000))
    firsts = {r["doc"]: r["first_doc"] for r in rows if r["first_doc"] != r["doc"]}

    def least(doc):
        while doc in firsts:
            doc = firsts[doc]
        return doc

    assert {least(d) for d in range(3000)} == {0}
