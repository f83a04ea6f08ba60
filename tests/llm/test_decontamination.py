"""The positional index and decontamination against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stayline.llm import decontamination as D
from stayline.llm import positional_index as I

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(lowered)


def near(doc, phrase, at, slop):
    return all(any(doc[p] == w for p in range(max(0, at + o - slop), min(len(doc), at + o + slop + 1))) for o, w in enumerate(phrase))


def brute(docs, items, window=10, slop=0):
    """Per document: words, hit words, ids."""
    phrases = []
    for item, text in items:
        w = words(text)
        phrases += [(item, w[i : i + window]) for i in range(max(1, len(w) - window + 1))] if w else []
    out = []
    for doc, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for item, phrase in phrases:
            for at in range(len(w) - len(phrase) + 1):
                if near(w, phrase, at, slop):
                    hit |= set(range(at, at + len(phrase)))
                    ids |= {str(item)} - {"None"}
        out.append((doc, len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


def corpus(seed, n_docs, vocabulary="a b c d e f".split()):
    r = random.Random(seed)
    items = [(i % 9 if i else None, " ".join(r.choices(vocabulary, k=r.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(14)]
    items += [(20, None), (21, "?!"), (22, items[5][1]), (22, items[6][1]), (10, "Zebra, ZEBRA; zebra! " * 8)]
    docs = []
    for i in range(n_docs):
        text = " ".join(r.choices(vocabulary, k=r.randrange(60)))
        if i % 3 == 0:
            text += " - " + (r.choice(items)[1] or "") + " " + " ".join(r.choices(vocabulary, k=5))
        docs.append((i if i % 7 else None, text))
    return docs + [(5, None), (5, ""), (6, "zebra " * 300), (6, "zebra " * 300), (8, "x Çé ñ1 \x00 A")], items


def table(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "item_id long, text string, segment string, item int")


def result(df):
    return sorted((tuple(r[:3]) + (list(r[3]), r[4]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("slop", [0, 2])
def test_against_brute_force(spark, documents, slop):
    docs, items = corpus(slop, 80)
    got = D.contamination(documents(docs), table(spark, items), window=4 if slop else 10, slop=slop)
    assert result(got) == brute(docs, items, 4 if slop else 10, slop)
    assert any(r[4] for r in result(got)) and not all(r[4] for r in result(got))


def test_small_segments_turns_and_rounds_change_nothing(spark, documents, monkeypatch):
    docs, items = corpus(3, 60)
    docs = documents(docs)
    spread = lambda index, slop: sorted(
        I.phrase_matches(index, asked, slop)
        .join(I.indexed_documents(index), ["segment", "row"])
        .select(F.coalesce("doc_id", F.lit(-1)), "n_words", "item", "start", "stop")
        .collect()
    )
    numbered = D.numbered_items(table(spark, items))
    asked = numbered.select("item", "text").mapInArrow(D._windows(6), "item long, words array<binary>")
    whole = [spread(I.positional_index(docs), slop) for slop in (0, 1)]
    monkeypatch.setattr(I, "TURN_BYTES", 4_000)
    index = I.positional_index(docs, segment_words=50)
    assert index.select("segment").distinct().count() > 20
    assert [spread(index, slop) for slop in (0, 1)] == whole and whole[0] and len(whole[1]) > len(whole[0])


def test_candidates_in_rounds(monkeypatch):
    """Many candidates are intersected a bounded number at a time."""
    r = random.Random(5)
    doc = r.choices(b"abc", k=4_000)
    text = [bytes([c]) for c in doc]
    segment = I._Segment()
    segment.add(1, text)
    rows = segment.rows(0).to_pydict()
    phrases = [tuple(bytes([c]) for c in r.choices(b"abc", k=4)) for _ in range(30)]
    phrases = sorted(set(phrases))
    counts = {w: n for w, n in zip(rows["word"][1:], rows["n"][1:])}
    built = I.Phrases(phrases, counts)
    own = np.array([built.words.index(w) for w in rows["word"][1:]])
    lists = I.Lists(np.array([4_000]), own, rows["places"][1:], np.array(rows["n"][1:]), len(built.words))
    want = sorted((i, at) for i, p in enumerate(phrases) for at in range(3_997) if tuple(text[at : at + 4]) == p)
    for bound in (1 << 20, 500):
        monkeypatch.setattr(I, "CANDIDATES", bound)
        assert sorted(zip(*(c.tolist() for c in I.search_segment(built, lists, 0)))) == want


def test_no_documents_no_items(spark, documents):
    docs, items = corpus(1, 5)
    assert D.contamination(documents(docs).where("false"), table(spark, items)).collect() == []
    got = D.contamination(documents(docs), table(spark, items).where("false")).collect()
    assert len(got) == len(docs) and not any(r["contaminated"] for r in got)


def test_a_very_long_document(spark, documents):
    r = random.Random(2)
    filler = " ".join(f"w{r.randrange(3_000)}" for _ in range(200_000))
    item = " ".join(f"q{i}" for i in range(30))
    docs = [(1, f"{filler} {item}. {filler}"), (2, f"{item[:-4]} {filler}"), (3, "short")]
    got = {x["doc_id"]: (x["n_hit"], x["item_ids"]) for x in D.contamination(documents(docs), table(spark, [(7, item)])).collect()}
    assert got == {1: (30, ["7"]), 2: (29, ["7"]), 3: (0, [])}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=50))
def test_gap_bytes_come_back(numbers):
    gaps = np.array(numbers, dtype=np.int64)
    data, widths = I.encode_gaps(gaps)
    assert I.decode_gaps(data).tolist() == numbers and int(widths.sum()) == len(data)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ09 é\n@[`{~\x7f日_-", max_size=40))
def test_words(text):
    assert [w.decode() for w in I.words_of(text.encode())] == words(text)
