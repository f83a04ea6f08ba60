"""Rows without an id, or with one id, whose texts share a short checksum stay apart."""

import hashlib
import zlib

import corpus_pipeline
from stayline.llm.line_dedup import drop_repeated_lines
from stayline.llm.near_dedup import near_classes, one_of_each_class
from stayline.llm.substring_dedup import without_repeated_windows


def colliding(pattern):
    """Two different texts with the same CRC-32 but for its last bit."""
    seen = {}
    for i in range(10**6):
        text = pattern.format(hashlib.md5(str(i).encode()).hexdigest())
        other = seen.setdefault(zlib.crc32(text.encode()) >> 1, text)
        if other != text:
            return other, text
    raise AssertionError("no collision")


FIRST, SECOND = colliding("common line\nnote number {} of the day\n tail")
LONG = " ".join(f"w{i}" for i in range(60))


def test_lines_of_documents_without_an_id(documents):
    for doc in (None, 7):
        rows = [(doc, FIRST), (doc, SECOND), (9, "common line\nother"), (None, None)]
        got = drop_repeated_lines(documents(rows), min_docs=3, keep_first=False)
        drop = lambda t: "\n".join(x for x in t.split("\n") if x != "common line")
        want = [(doc, drop(FIRST)), (doc, drop(SECOND)), (9, "other"), (None, None)]
        assert sorted(map(repr, map(tuple, got.select("doc_id", "text").collect()))) == sorted(map(repr, want))


def test_near_duplicates_without_an_id(spark, documents):
    for doc in (None, 7):
        rows = [(doc, FIRST), (doc, SECOND), (8, "something else")]
        assert near_classes(documents(rows)).where("kept").count() == 3
        for kept in (one_of_each_class(documents(rows)), corpus_pipeline.near_dedup(spark, documents(rows), "")):
            assert {r["text"] for r in kept.collect()} == {t for _, t in rows} and kept.count() == 3


def test_windows_of_documents_with_one_id(documents):
    first, second = colliding(LONG + " and {}")
    rows = [(1, LONG), (7, first), (7, "x " + second[: len(LONG)]), (7, second), (None, LONG), (None, first)]
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in without_repeated_windows(documents(rows)).collect() if r["doc_id"])
    assert got == [(1, 60, 0), (7, 61, 60), (7, 62, 60), (7, 62, 60)]


def test_the_line_stage_keeps_its_rows(spark, documents):
    rows = [(None, FIRST), (None, SECOND), (None, FIRST)]
    got = corpus_pipeline.line_dedup(spark, documents(rows), "")
    assert sorted(r["text"] for r in got.collect()) == sorted(t for _, t in rows)
