"""The corpus pipeline, stage by stage, against brute force on what its predecessor kept."""

import math
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from stayline.llm.pieces import MODEL
from tests.compare import DATA
from tests.llm.test_dedup import brute_classes
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_models import brute_targets

SF = f"{DATA}/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's output, written and read again."""
    root, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        docs = out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "pieces"]
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == COLUMNS
    assert stages["pieces"].columns == [*COLUMNS, "piece_ids", "decoded"]


def test_toxicity_only_drops(stages, spark):
    before, after = set(pairs(stages["documents"])), set(pairs(stages["toxicity"]))
    assert after < before
    clean = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    gone = {d for d, _ in before - after}
    assert len(gone & clean) <= 0.04 * len(clean)  # a few dozen labels to learn from


def test_line_dedup(stages):
    rows = pairs(stages["toxicity"])
    want = brute_lines(rows, corpus_pipeline.LINE_DOCUMENTS, True)
    assert sorted(pairs(stages["line_dedup"])) == sorted((d, want[d, t]) for d, t in rows)


def test_near_dedup(stages):
    rows = pairs(stages["line_dedup"])
    members = defaultdict(list)
    for (doc, text), c in brute_classes(rows).items():
        members[c].append((doc, text))
    assert sorted(pairs(stages["near_dedup"])) == sorted(min(m) for m in members.values())


def test_mixing(stages):
    rows = [(r["doc_id"], r["source"], len(r["text"].encode().split())) for r in stages["near_dedup"].collect()]
    sizes = defaultdict(int)
    for _, source, n in rows:
        sizes[source] += n
    target = brute_targets(sizes)
    copies = Counter(d for d, _ in pairs(stages["mixing"]))
    for doc, source, _ in rows:
        rate = target[source] / sizes[source]
        assert copies[doc] in (math.floor(rate + 1e-12), math.floor(rate - 1e-12) + 1)
    assert set(copies) <= {d for d, _, _ in rows}


def test_pieces(stages):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = stages["pieces"].collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted(pairs(stages["mixing"]))
    assert all(r["piece_ids"] == library.encode(r["text"]) for r in rows)
    assert all(r["decoded"] == library.decode(r["piece_ids"]) for r in rows)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted(pairs(stages["pieces"]))


def test_odd_rows_pass_every_stage(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, and an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "word " * 40_000, None, "a", 7), (3, "x\n\n", "en", None, 3)] * 2
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns[:5] == COLUMNS
            count = docs.count()
            assert count >= (1 if table and name != "pieces" and name != "mixing" else 0), name
