"""Exact groups, substring windows and near-duplicate classes against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from stayline.llm import near_dedup, substring_dedup
from stayline.llm.components import components
from stayline.llm.exact_dedup import exact_groups, frequent_digests, misra_gries
from stayline.llm.substring_dedup import Windows, covered, sketch_bits, without_repeated_windows


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_exact_groups(documents):
    rows = [(i, "hot") for i in range(300)] + [(i, f"text {i % 40}") for i in range(300, 500)]
    rows += [(900, None), (901, ""), (None, "only null"), (None, "text 1"), (7, "hot"), (299, "hot"), (None, None)]
    groups = defaultdict(list)
    for doc, text in rows:
        groups[sha(text)].append(doc)
    for counters in (4, 1000):  # few counters: hot text split off; many: everything
        got = exact_groups(documents(rows), counters).collect()
        assert sorted((r["doc_id"], r["text_sha256"]) for r in got if r["doc_id"] is not None) == sorted(
            (d, sha(t)) for d, t in rows if d is not None
        )
        kept = Counter()
        for r in got:
            members = groups[r["text_sha256"]]
            largest = max((d for d in members if d is not None), default=None)
            assert (r["keep_id"], r["group_size"]) == (largest, len(members))
            if r["kept"]:
                kept[r["text_sha256"]] += 1
                assert r["doc_id"] == largest
        assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert exact_groups(documents([])).count() == 0


def test_frequent_digests_are_few_and_complete(spark):
    rng = random.Random(3)
    digests = [b"hot"] * 500 + [b"warm"] * 150 + [str(rng.random()).encode() for _ in range(350)]
    rng.shuffle(digests)
    df = spark.createDataFrame([(bytearray(d),) for d in digests], "digest binary").repartition(7)
    found = {bytes(r["digest"]) for r in frequent_digests(df, 16).collect()}
    assert {b"hot", b"warm"} <= found and len(found) <= 16


def test_misra_gries_underestimates_within_its_bound():
    rng = random.Random(5)
    stream = [rng.choice("aaaabbbcdefghijklmnopqrstuvwxyz") for _ in range(2000)]
    counts = Counter()
    for at in range(0, 2000, 100):
        counts = misra_gries(counts, Counter(stream[at : at + 100]), 5)
        assert len(counts) <= 5
    for letter, true in Counter(stream).items():
        assert true - 2000 / 6 <= counts[letter] <= true


def brute_windows(rows, window):
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        if doc is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i : i + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if doc is not None and first[tuple(words[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        out.append((doc, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window, bits", [(4, 16), (4, 3), (50, 16)])
def test_substrings_against_brute_force(documents, monkeypatch, window, bits):
    """With 3 bits the sketch lets everything through: the result is the same."""
    monkeypatch.setattr(substring_dedup, "sketch_bits", lambda n: bits)
    rng = random.Random(window)
    passages = [" ".join(rng.choice("abcdefg") + str(rng.randint(0, 9)) for _ in range(70)) for _ in range(3)]
    rows = []
    for i in range(90):
        own = lambda: " ".join(f"u{i}x{rng.randint(0, 999)}" for _ in range(rng.randint(0, 30)))  # noqa: B023, E731
        rows.append((i, f"{own()} {rng.choice(passages)}\t{own()}" if i % 3 else own()))
    rows += [(200, None), (201, ""), (202, " \n"), (None, passages[0]), (203, passages[1]), (203, passages[1])]
    rows += [(204, passages[0] + " one"), (204, passages[0] + " two"), (-5, passages[2])]
    got = sorted(
        ((r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept"]).decode())
         for r in without_repeated_windows(documents(rows), window).collect()), key=repr
    )
    assert got == brute_windows(rows, window)
    assert without_repeated_windows(documents([]), window).count() == 0


def test_window_keys_agree_exactly_with_their_words():
    rng = random.Random(1)
    words = [rng.choice("ab") for _ in range(6000)]
    keys = Windows(5).keys(" ".join(words).encode())
    by_words = defaultdict(set)
    for i, pair in enumerate(zip(*(k.tolist() for k in keys))):
        by_words[tuple(words[i : i + 5])].add(pair)
    assert all(len(v) == 1 for v in by_words.values())
    assert len({next(iter(v)) for v in by_words.values()}) == len(by_words)
    assert Windows(5).keys(b"too short") is None


def test_covered_words_and_sketch_size():
    assert covered(6, np.array([1, 2]), 3).tolist() == [False, True, True, True, True, False]
    assert sketch_bits(0) == substring_dedup.MIN_BITS and sketch_bits(10**12) == substring_dedup.MAX_BITS


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**9)}"
        out.append(" ".join(words))
    return out


def near_rows():
    rng = random.Random(11)
    rows, at = [], 0
    for group in range(6):
        base = [f"g{group}w{rng.randint(0, 400)}" for _ in range(120)]
        for text in variants(rng, base, 40, 6):
            rows.append((at, text))
            at += 1
    rows += [(at + i, " ".join(f"r{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 90)))) for i in range(60)]
    copy = rows[5][1]
    rows += [(1000 + i, copy.replace(" ", "\n")) for i in range(50)]
    rows += [(2000, None), (2001, ""), (2002, "a b"), (2003, "a b"), (2004, "a b c"), (None, "a b"), (None, copy)]
    return rows + [rows[0], (2005, "x " * 5000)]


def brute_similarity(a, b):
    """Probability Jaccard of weights 1 + ln(count), by its defining double sum."""
    union = list(a.keys() | b.keys())
    x, y = (np.array([1 + np.log(c[s]) if s in c else 0 for s in union]) for c in (a, b))
    shared = (x > 0) & (y > 0)
    return (1 / np.maximum(x / x[shared, None], y / y[shared, None]).sum(axis=1)).sum()


def brute_classes(rows):
    texts = sorted({tuple((t or "").encode().split()) for _, t in rows})
    counts = [Counter(t[i : i + 5] for i in range(len(t) - 4)) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if not counts[i].keys().isdisjoint(counts[j]) and brute_similarity(counts[i], counts[j]) >= 0.8 - 1e-9:
                parent[root(i)] = root(j)
    of = {t: root(i) for i, t in enumerate(texts)}
    return {(d, t): of[tuple((t or "").encode().split())] for d, t in rows}


@pytest.mark.parametrize("family, tile", [(8192, 512), (1, 16)])
def test_near_classes_against_brute_force(documents, monkeypatch, family, tile):
    """Once by whole families in one tile, once bucket by bucket in many tiles."""
    monkeypatch.setattr(near_dedup, "TILE", tile)
    rows = near_rows()
    want = brute_classes(rows)
    members = defaultdict(list)
    for doc, text in rows:
        members[want[doc, text]].append(doc)
    least = {c: min((d for d in m if d is not None), default=None) for c, m in members.items()}
    got = near_dedup.near_classes(documents(rows), family).collect()
    assert sorted((r["doc_id"], r["class_id"], r["class_size"]) for r in got if r["doc_id"] is not None) == sorted(
        (d, least[want[d, t]], len(members[want[d, t]])) for d, t in rows if d is not None
    )
    assert sum(r["kept"] for r in got) == len(members)


def test_near_classes_of_texts_that_repeat_a_passage(documents):
    """A passage one text repeats often weighs more and parts the texts; one that both repeat does not."""
    rows = []
    for group, (left, right) in enumerate([(0, 1), (1, 2), (0, 100), (90, 100), (1, 1000), (500, 1000)]):
        words = [f"p{group}w{i}" for i in range(240)]
        line = [f"p{group}l{i}" for i in range(14)]
        rows += [(10 * group, " ".join(words + line * left)), (10 * group + 1, " ".join(words + line * right))]
    want = brute_classes(rows)
    linked = [want[rows[2 * g]] == want[rows[2 * g + 1]] for g in range(6)]
    assert linked == [True, True, False, True, False, True]
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in near_dedup.near_classes(documents(rows)).collect()}
    assert got == {10 * g + i: (10 * g, 2) if linked[g] else (10 * g + i, 1) for g in range(6) for i in range(2)}


def test_probability_jaccard_against_its_double_sum():
    rng = random.Random(8)
    for _ in range(200):
        a, b = (Counter({i: rng.choice([1, 1, 1, 2, 3, 50]) for i in rng.sample(range(40), 30)}) for _ in range(2))
        assert near_dedup.probability_jaccard(a, b) == pytest.approx(brute_similarity(a, b), abs=1e-12)
    assert near_dedup.probability_jaccard(Counter(), Counter("a")) == 0
    plain = near_dedup.probability_jaccard(Counter(range(9)), Counter(range(1, 10)))
    assert plain == pytest.approx(8 / 10)  # without repeats: of the sets


def test_signatures_of_weighted_elements():
    rng = np.random.default_rng(4)
    elements = rng.integers(1, 2**62, 200).astype(np.uint64)
    x, y = (rng.choice([1.0, 1.7, 5.6], 200) for _ in range(2))
    found = near_dedup.signatures(np.tile(elements, 2), np.concatenate([x, y]), np.repeat([0, 1], 200), 2)
    exact = (1 / np.maximum(x / x[:, None], y / y[:, None]).sum(axis=1)).sum()
    assert abs((found[0] == found[1]).mean() - exact) < 0.12


def test_one_of_each_class_keeps_columns(documents):
    rows = near_rows()
    docs = documents(rows)
    out = near_dedup.one_of_each_class(docs)
    assert out.columns == docs.columns
    assert out.count() == len(set(brute_classes(rows).values()))
    assert near_dedup.one_of_each_class(documents([])).count() == 0


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(2)
    common, left, right = (rng.integers(1, 2**62, n).astype(np.uint64) for n in (300, 60, 60))
    elements = np.concatenate([common, left, common, right])
    owner = np.repeat([0, 1], 360)
    found = near_dedup.signatures(elements, np.ones(720), owner, 2)
    assert abs((found[0] == found[1]).mean() - 300 / 420) < 0.12
    again = near_dedup.signatures(elements[:360], np.full(360, 3.0), np.zeros(360, int), 1)
    assert (again[0] == found[0]).all()  # only proportions of weights matter


def test_components(spark, rows_of):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 400)]
    links = spark.createDataFrame(chain + star + [(7, 7), (900, 900), (501, 500), (40, 39)], "a long, b long")
    want = [(i, 0) for i in range(41)] + [(i, 100) for i in range(100, 400)] + [(500, 500), (501, 500)]
    assert rows_of(components(links, "test"), "node", "root") == sorted(want, key=repr)
    assert components(links.where("a < 0"), "test").count() == 0
