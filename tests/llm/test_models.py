"""Toxicity chain, piece transducer, mixing and exact top-k."""

import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import stayline.llm as llm
from stayline.llm import pieces as P
from stayline.llm import topk_search as K
from stayline.llm import toxicity as T
from stayline.llm.mixing import mixed, mixture

# -- toxicity ------------------------------------------------------------------


def labelled(n, seed=3):
    """Documents whose toxic ones hold some of six words; junk ones hold marks; some labels are missing."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    docs, labels, toxic = [], [], set()
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        if rng.random() < 0.25:
            toxic.add(i)
            own += [rng.choice(("vile", "Awful!", "nasty", "rotten", "dreadful", "hateful,")) for _ in range(3)]
        junk = rng.random() < 0.2
        own += ["zzz###"] * (3 * junk)
        rng.shuffle(own)
        docs.append((i, " ".join(own)))
        if i % 3:
            labels.append((i, int(not junk), int(i in toxic), "extra"))
    return docs, labels, toxic


@pytest.fixture
def label_table(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_chain_finds_held_out_documents(documents, label_table):
    docs, labels, toxic = labelled(900)
    docs += [(2000, None), (2001, ""), (None, "vile nasty rotten awful"), docs[0]]
    labels += [(None, 1, 1, "x"), (5, None, 1, "x"), (10**6, 1, 1, "x"), labels[0]]
    got = T.toxicity_scores(documents(docs), label_table(labels)).collect()
    assert len(got) == len(docs)
    held_out = {r["doc_id"]: r["rejected"] for r in got if r["doc_id"] is not None and r["doc_id"] % 3 == 0}
    wrong = sum(rejected != (i in toxic) for i, rejected in held_out.items())
    assert wrong <= 0.03 * len(held_out)
    by_id = {r["doc_id"]: r for r in got}
    assert not by_id[2000]["rejected"] and by_id[2000]["p_toxic"] == by_id[2001]["p_toxic"]
    assert by_id[None]["rejected"]


def test_filter_keeps_columns_and_reruns_agree(documents, label_table, rows_of):
    docs, labels, toxic = labelled(500)
    table = documents(docs)
    out = T.without_toxic(table, label_table(labels))
    assert out.columns == table.columns
    kept = rows_of(out, "doc_id")
    assert kept == rows_of(T.without_toxic(table.repartition(7), label_table(labels[::-1])), "doc_id")
    assert abs(len(kept) - (500 - len(toxic))) <= 15


def brute_fit(x, extra, y):
    """The same ridge logistic regression on dense matrices: accelerated steps, weights of words not negative."""
    n, width = x.shape
    every = np.hstack([x, extra, np.ones((n, 1))])
    if not n:
        return np.zeros(every.shape[1])
    size = np.maximum(x.sum(axis=1), 1)
    bound = np.concatenate([
        (x * size[:, None]).sum(axis=0) / (4 * n) + T.PENALTY + 1e-9,
        (extra**2 * size[:, None]).mean(axis=0) / 2 + T.PENALTY + 1e-9, [size.mean() / 4],
    ])
    w = np.zeros(every.shape[1])
    w[-1] = math.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    penalty = np.append(np.full(len(w) - 1, T.PENALTY), 0)
    ahead, t = w, 1.0
    for _ in range(T.STEPS):
        p = 1 / (1 + np.exp(-every @ ahead))
        new = ahead - (every.T @ (p - y) / n + penalty * ahead) / bound
        new[:width] = new[:width].clip(0)
        u = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / u * (new - w), new, u
    return w


def brute_chain(sample, texts):
    """Rows (row, fold, labels, words) to probabilities of all texts and the cut, one fold and category at a time."""
    words = sorted({w for *_, own in sample for w in own})
    words = [w for w in words if sum(w in own for *_, own in sample) >= T.MIN_DOCUMENTS]
    x = np.array([[w in own for w in words] for *_, own in sample], dtype=float)
    z = np.array([[w in T.words_of(t) for w in words] for t in texts], dtype=float)
    fold = np.array([f for _, f, _, _ in sample])
    of_sample, of_texts = np.empty((len(sample), 0)), np.empty((len(texts), 0))
    answer = lambda w, a, b: 1 / (1 + np.exp(-np.hstack([a, b, np.ones((len(a), 1))]) @ w))
    for place in range(2):
        y = np.array([np.nan if r[2][place] is None else r[2][place] for r in sample])
        own = np.empty(len(sample))
        for k in range(T.FOLDS):
            taught, out = (fold != k) & ~np.isnan(y), fold == k
            own[out] = answer(brute_fit(x[taught], of_sample[taught], y[taught]), x[out], of_sample[out])
        taught = ~np.isnan(y)
        whole = brute_fit(x[taught], of_sample[taught], y[taught])
        found = answer(whole, z, of_texts)
        of_sample, of_texts = np.column_stack([of_sample, own - 0.5]), np.column_stack([of_texts, found - 0.5])
    cuts = sorted(set(own[taught]))
    score = {c: 2 * ((own >= c) & (y == 1)).sum() / (((own >= c) & taught).sum() + (y == 1).sum()) for c in cuts}
    return of_texts + 0.5, cuts, score


@pytest.mark.parametrize("missing", ["none", "some", "all of quality"])
def test_chain_against_a_dense_one(documents, label_table, missing):
    docs, labels, _ = labelled(260)
    rng = random.Random(6)
    if missing == "some":
        labels = [(d, None if rng.random() < 0.4 else q, None if rng.random() < 0.3 else t, x) for d, q, t, x in labels]
    elif missing == "all of quality":
        labels = [(d, None, t, x) for d, _, t, x in labels]
    docs = docs + [(5000, None), (5001, ""), (5002, "none of these words is known")]
    rows = T.training_rows(documents(docs), label_table(labels), T.CATEGORIES, T.SAMPLE_ROWS).collect()
    usable = {d for d, q, t, _ in labels if d is not None and (q, t) != (None, None)} & {r[0] for r in docs}
    assert {r["row"] for r in rows} == usable
    sample = [(r["row"], r["fold"], (r["y0"], r["y1"]), set(r["words"])) for r in rows]
    want, cuts, score = brute_chain(sample, [r[1] or "" for r in docs])
    got = {r["doc_id"]: r for r in T.toxicity_scores(documents(docs), label_table(labels)).collect()}
    for (doc, *_), (quality, toxic) in zip(docs, want):
        assert got[doc]["p_low_quality"] == pytest.approx(quality, abs=1e-6)
        assert got[doc]["p_toxic"] == pytest.approx(toxic, abs=1e-6)
    if missing == "all of quality":
        assert {r["p_low_quality"] for r in got.values()} == {0.5}
    chain = T.fit_chain(documents(docs), label_table(labels))
    odds = want[-2][1] / (1 - want[-2][1])  # of the empty text
    least = odds * math.exp(T.MARGIN) / (1 + odds * math.exp(T.MARGIN))
    if chain.threshold > least + 1e-6:  # the cut decides: nothing scores a better F1
        above = min(c for c in cuts if c >= chain.threshold)
        assert score[above] == pytest.approx(max(score.values()))
    else:
        assert chain.threshold == pytest.approx(least, abs=1e-6)


def test_without_labels_nothing_is_rejected(documents, label_table):
    got = T.toxicity_scores(documents([(1, "a b")]), label_table([])).collect()
    assert [(r["p_toxic"], r["rejected"]) for r in got] == [(None, False)]
    assert T.without_toxic(documents([(1, "a b")]), label_table([])).count() == 1
    assert T.toxicity_scores(documents([]), label_table([(1, 1, 1, "x")])).count() == 0


def test_later_models_use_earlier_probabilities():
    rng = np.random.default_rng(0)
    earlier = rng.random(4000)
    y = (rng.random(4000) < earlier).astype(float)
    none = np.empty(0, dtype=np.int64)
    w = T.fit_logistic(none, none, (earlier - 0.5)[:, None], y, 0)
    assert w[0] > 3 and abs(w[1]) < 0.3


def test_sample_is_bounded(documents, label_table):
    docs, labels, _ = labelled(200)
    sample = T.training_rows(documents(docs), label_table(labels), T.CATEGORIES, 40)
    assert sample.count() == 40


def test_cut_and_model_text():
    assert T.best_cut(np.array([0.9, 0.2, 0.3, 0.1]), np.array([1, 0, 1, 0])) == pytest.approx(0.25)
    assert T.best_cut(np.array([0.9, 0.2]), np.array([0, 0])) == 0.5
    chain = T.Chain(("a", "b"), {"x": 0}, np.array([[1.0], [2.0]]), [[], [0.5]], [0.0, -1.0], 0.4)
    again = T.Chain.from_json(chain.as_json())
    known = T.KnownWords(again.index)
    p = again.probabilities("X, y", known)
    assert p[0] == pytest.approx(1 / (1 + math.exp(-1)))
    assert p[1] == pytest.approx(1 / (1 + math.exp(-(2 - 1 + 0.5 * (p[0] - 0.5)))))


# -- pieces --------------------------------------------------------------------


@pytest.fixture(scope="module")
def machine():
    return P.Transducer(P.read_model())


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=P.MODEL)


ODD = ["", " ", "   ", "a  b", " lead", "trail ", "\t\n\r\v\f", "<s> </s> <unk> <0x41>", "▁a▁▁b", "\x00\x7f", "日本語テスト", "🎉👩‍👩‍👧", "é" "e\u0301",
       "ﬁſKİ", "\u3000x\u00a0y", "a" * 5000, "▁" * 40, "x" + " " * 50 + "y", "1234567890" * 9, "The the THE tHe"]


def numbers(ids):
    return np.frombuffer(ids, dtype="<i4").tolist()


def test_encoding_equals_the_library(machine, library):
    rng = random.Random(2)
    alphabet = "abcdefghit  neo\nrsü日.,▁0AB"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 70))) for _ in range(1500)]
    con = duckdb.connect()
    texts += [r[0] or "" for r in con.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    for text in texts:
        ids = numbers(machine.encode(text))
        assert ids == library.encode(text), text
        assert machine.decode(ids) == library.decode(ids) == machine.plain(text)


def test_ranks_that_do_not_tell_time():
    """A part that ranks behind its whole: the acceptor falls back to merging the pair."""
    machine = P.Transducer(P.read_model())
    slow = P.Transducer(P.read_model())
    slow.spines = lambda piece: ([], []) if P.Transducer.spines(slow, piece) is not None else None
    for text in ("retitioning ouen", "therethere", "unhappiness  is"):
        assert slow.encode(text) == machine.encode(text)


def unigram_model(pieces, byte_fallback=True):
    """A small unigram model in the file format."""

    def field(number, kind, data):
        return bytes([number << 3 | kind]) + (bytes([len(data)]) if kind == 2 else b"") + data

    def piece(name, score, kind):
        body = field(1, 2, name.encode()) + field(2, 5, np.float32(score).tobytes()) + field(3, 0, bytes([kind]))
        return field(1, 2, body)

    out = piece("<unk>", 0, 2)
    out += b"".join(piece(f"<0x{b:02X}>", 0, 6) for b in range(256)) if byte_fallback else b""
    out += b"".join(piece(n, s, 1) for n, s in pieces.items())
    return out + field(2, 2, field(3, 0, bytes([1]))) + field(3, 2, field(3, 0, b"\x01") + field(4, 0, b"\x00"))


def test_unigram_models_take_the_best_scores():
    scores = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -3.5, "▁ab": -4.0, "▁a": -5.5, "bb": -4.5}
    machine = P.Transducer(unigram_model(scores))
    rng = random.Random(6)

    def best(text):
        cost = {0: (0.0, ())}
        for end in range(1, len(text) + 1):
            ways = [(cost[a][0] - scores[text[a:end]], cost[a][1] + (text[a:end],)) for a in range(end) if text[a:end] in scores]
            cost[end] = min(ways)
        return cost[len(text)][0]

    for _ in range(200):
        text = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 12)))
        names = [machine.names[i] for i in numbers(machine.encode(text))]
        assert "".join(names) == machine.normalised(text)
        assert -sum(scores[n] for n in names) == pytest.approx(best(machine.normalised(text)))
    assert machine.decode(numbers(machine.encode("é a"))) == "é a"
    assert P.Transducer(unigram_model(scores, False)).encode("é")[-4:] == b"\x00" * 4  # no bytes: the unknown piece


def test_a_character_map_is_refused():
    with pytest.raises(ValueError, match="character map"):
        P.Transducer(unigram_model({"a": -1.0}) + bytes([3 << 3 | 2, 4, 2 << 3 | 2, 2, 1, 1]))


def test_columns_of_encoded_and_decoded(documents):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, None), (None, "x y"), (1, " ")]
    docs = documents(rows)
    out = P.decoded(P.encoded(docs))
    assert out.columns == [c for c in docs.columns if c != "piece_ids"] + ["piece_ids", "decoded"]
    for r in out.collect():
        assert r["decoded"] == (r["text"] or "").replace("▁", " ")
    assert P.encoded(documents([])).count() == 0
    trips = P.round_trips(docs).collect()
    assert len(trips) == len(rows) and all(r["round_trip"] for r in trips)


def test_memory_forgets_by_generation():
    memory = P.Memory(2)
    for key in "abc":
        memory.put(key, key)
    assert memory.again("a") == "a" and memory.again("z") is None
    memory.put("d", "d")
    memory.put("e", "e")
    assert memory.again("b") is None


# -- mixing --------------------------------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        for s in open_:
            target[s] += left * w[s] / total
        left = sum(max(0.0, target[s] - most * sizes[s]) for s in open_)
        open_ = {s for s in open_ if target[s] < most * sizes[s]}
        target = {s: min(t, float(most * sizes[s])) for s, t in target.items()}
    return target


def mixing_rows():
    rng = random.Random(8)
    names = ["hot", "a", "B", "é", "\U0001f389", "\uffff", "", None, "tiny"]
    rows = []
    for i in range(4000):
        source = "hot" if i % 3 == 0 else rng.choice(names)
        n = rng.randint(0, 3) if source == "tiny" else rng.randint(0, 40)
        rows.append((i, " \t".join(["w"] * n) + "\n", source))
    return rows + [(None, "a b", "a"), (None, "a c", None), (5000, None, "a"), (5001, "", "empty source"), rows[7]]


def test_mixing(documents):
    rows = mixing_rows()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    target = brute_targets(sizes)
    got = mixture(documents(rows).withColumnRenamed("target", "rate")).collect()
    source_of = {(d, len((t or "").split())): s for d, t, s in rows}
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        source = source_of[r["doc_id"], r["size"]]
        if r["doc_id"] is not None:
            assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(target[source], rel=1e-9)
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert math.floor(rate) <= r["copies"] <= min(3, math.floor(rate) + 1)
        assert r["taken"] == r["size"] * r["copies"]
        taken[source] += r["taken"]
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), rel=0.03)
    assert taken["hot"] == pytest.approx(target["hot"], rel=0.1)
    again = mixture(documents(rows, parts=9)).collect()
    assert sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in again) == sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in got)


def test_mixed_repeats_rows(documents):
    docs = documents(mixing_rows())
    out = mixed(docs)
    assert out.columns == docs.columns
    want = sum(r["copies"] for r in mixture(docs).collect())
    assert out.count() == want
    assert mixed(documents([])).count() == 0 and mixture(documents([(1, None)])).first()["taken"] == 0


# -- top-k ---------------------------------------------------------------------


def brute_top(rows, every, k):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.setdefault((i, len(v)), []).append([min(2**63 - 1, max(-(2**63), math.floor(1024 * float(np.float32(x))))) for x in v])
    out = []
    for q in sorted({i for i, _ in whole if i % every == 0}):
        found = []
        for n in {n for i, n in whole if i == q}:
            for (i, m), vectors in whole.items():
                for c in vectors if m == n and i != q else []:
                    for own in whole[q, n]:
                        found.append((i, min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(own, c))))))
        ranked = sorted(found, key=lambda b: (-b[1], b[0]))[:k]
        out += [(q, r + 1, i, s) for r, (i, s) in enumerate(ranked)]
    return out


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string").repartition(3)


@pytest.mark.parametrize("block, query_bytes", [(8192, 8 << 20), (64, 2000)])
def test_top_k_against_brute_force(vectors, rows_of, monkeypatch, block, query_bytes):
    monkeypatch.setattr(K, "BLOCK_ROWS", block)
    monkeypatch.setattr(K, "QUERY_BYTES", query_bytes)
    rng = np.random.default_rng(1)
    hot = rng.normal(size=20).tolist()
    rows = [(i, hot if i % 3 == 0 else (rng.normal(size=20) * rng.choice([0.1, 1])).tolist()) for i in range(600)]
    rows += [(1000, None), (1001, [None] + hot[1:]), (1002, [float("nan")] + hot[1:]), (1010, [float("inf")] + hot[1:])]
    rows += [(1020, []), (1021, []), (1030, [1.0, 2.0]), (1031, [3.0, -1.0]), (None, hot), rows[10], (10, hot), (-20, hot)]
    got = rows_of(K.top_k(vectors(rows), "vec_id % 10 = 0", 7), "query_id", "rank", "vec_id", "score")
    assert got == sorted(brute_top(rows, 10, 7), key=repr)


@pytest.mark.parametrize("block", [8192, 64])
def test_top_k_of_repeated_ids(vectors, rows_of, monkeypatch, block):
    """Ten copies of the best candidate, ids that hold several vectors, and repeated query rows: rows take places."""
    monkeypatch.setattr(K, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    hot = [2.0] * 20
    rows = [(0, hot), (10, (-np.array(hot)).tolist())]
    rows += [(1, hot)] * 10 + [(2, (np.array(hot) * 0.9**i).tolist()) for i in range(12)]
    rows += [(10, rng.normal(size=20).tolist()) for _ in range(3)] + [(20, hot)] * 9 + [(30, [-1.0] * 20)] * 3
    rows += [(i, rng.normal(size=20).tolist()) for i in range(3, 300) for _ in range(1 + i % 2)]
    got = rows_of(K.top_k(vectors(rows).coalesce(1), "vec_id % 10 = 0", 7), "query_id", "rank", "vec_id", "score")
    assert got == sorted(brute_top(rows, 10, 7), key=repr)


def test_top_k_of_repeated_ids_as_in_sql(vectors, rows_of, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(i % 150, rng.normal(size=8).round(1).tolist()) for i in range(400)]
    rows += rows[:40] + [(100, [1.0] * 8)] * 12 + [(7, [3.0] * 8)] * 12
    vectors(rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = con.execute(llm.ORACLES["op10_top_k"]).fetchall()
    got = rows_of(K.top_k(vectors(rows), "vec_id % 100 = 0", 10), "query_id", "rank", "vec_id", "score")
    assert got == sorted(want, key=repr)


def test_top_k_of_huge_components(vectors, rows_of):
    rng = random.Random(2)
    rows = [(i, [rng.choice([1e17, -3e38, 5.0, 2e13]) for _ in range(5)]) for i in range(30)]
    got = rows_of(K.top_k(vectors(rows), "vec_id % 10 = 0", 3), "query_id", "rank", "vec_id", "score")
    assert got == sorted(brute_top(rows, 10, 3), key=repr)


def test_top_k_of_few_or_no_vectors(vectors):
    assert K.top_k(vectors([]), "vec_id % 10 = 0").count() == 0
    assert K.top_k(vectors([(10, [1.0])]), "vec_id % 10 = 0").count() == 0
    assert K.top_k(vectors([(10, [1.0]), (3, [2.0])]), "vec_id % 10 = 0").count() == 1
