"""Registered queries on the smallest tables: against brute force where SQL has no say."""

from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry_module
from stayline.llm import host_reputation as H
from stayline.llm import pieces as P
from tests.compare import DATA, connect
from tests.llm.test_dedup import brute_classes
from tests.llm.test_models import brute_targets
from tests.llm.test_scans import brute_base, brute_parts, brute_reputation, brute_rule

SF = f"{DATA}/sf0.001"
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def texts(con):
    return {d: t or "" for d, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}


def run(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def test_url_filter(spark, con):
    pages = con.execute("SELECT page_id, url FROM pages").fetchall()
    outcomes = con.execute("SELECT doc_id, quality FROM labels").fetchall()
    bounds = brute_reputation(pages, outcomes)
    got = {r["page_id"]: r for r in run(spark, "op2_url_filter")}
    assert len(got) == len(pages)
    for page, url in pages:
        host, path = brute_parts(url)
        rule, r = brute_rule(host, path), got[page]
        verdict = rule.action if rule else "allow" if bounds[host] >= H.LEAST_RATE else "block"
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule and rule.host + rule.path, verdict)


def test_secret_scan(spark, texts):
    got = {r["doc_id"]: r["spans"].split(",") if r["spans"] else [] for r in run(spark, "op4_secret_scan")}
    assert {d: [s for s in spans if s.split(":")[0] in ("assign", "access", "hex")] for d, spans in got.items()} == {
        d: brute_base(t) for d, t in texts.items()
    }


def test_near_dedup(spark, texts):
    want = brute_classes(list(texts.items()))
    members = defaultdict(list)
    for (doc, _), c in want.items():
        members[c].append(doc)
    got = {r["doc_id"]: (r["class_id"], r["class_size"], r["kept"]) for r in run(spark, "op5_near_dedup")}
    assert got == {d: (min(m), len(m), d == min(m)) for m in members.values() for d in m}


def test_toxicity(spark, con):
    labels = dict(con.execute("SELECT doc_id, toxic FROM labels").fetchall())
    rows = run(spark, "op6_toxicity")
    assert len(rows) == con.execute("SELECT COUNT(*) FROM documents").fetchone()[0]
    clean = [r for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(r["toxic"] for r in clean) <= 0.04 * len(clean)  # a few dozen labels to learn from


def test_toxicity_on_held_out_documents(spark):
    """Fitted on a third of the labels, judged on the others."""
    from stayline.llm.toxicity import toxicity_scores

    sf = f"{DATA}/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = toxicity_scores(spark.read.parquet(f"{sf}/documents.parquet"), labels.where("doc_id % 3 != 0"))
    held_out = scores.join(labels.where("doc_id % 3 = 0"), "doc_id").selectExpr("CAST(rejected AS INT) AS r", "toxic").collect()
    caught = [r["r"] for r in held_out if r["toxic"]]
    clean = [r["r"] for r in held_out if not r["toxic"]]
    assert np.mean(caught) > 0.85 and np.mean(clean) < 0.01


def test_mixing(spark, con, texts):
    sizes, source_of = defaultdict(int), dict(con.execute("SELECT doc_id, source FROM documents").fetchall())
    for doc, text in texts.items():
        sizes[source_of[doc]] += len(text.encode().split())
    target = brute_targets(sizes)
    rows = run(spark, "op7_mixing")
    assert len(rows) == len(texts)
    for r in rows:
        source = source_of[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (len(texts[r["doc_id"]].encode().split()), sizes[source])
        assert r["target"] == pytest.approx(target[source]) and r["taken"] in {r["size"] * k for k in range(4)}


def test_pieces(spark, texts):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    import hashlib

    got = {r["doc_id"]: (r["n_pieces"], r["ids_sha256"], r["round_trip"]) for r in run(spark, "op9_pieces")}
    want = {}
    for doc, text in texts.items():
        ids = library.encode(text)
        want[doc] = (len(ids), hashlib.sha256(np.array(ids, dtype="<i4").tobytes()).hexdigest(), True)
    assert got == want
