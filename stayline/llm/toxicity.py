"""Toxicity by a classifier chain of linear models over words.

The categories are predicted in a fixed order. Each model sees the words and the
probabilities of the categories before it. So that a later model is trained on
probabilities as honest as those it will meet, they come from out-of-fold fits:
the model of a fold never saw the rows it predicts.

Training uses a bounded, hashed sample of labelled rows; every fit of a fold is
one task over that sample. Scoring is one pass over whole texts.
"""

from __future__ import annotations

import json
import string
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayline.llm.common import text_of, texts_of
from stayline.session import staged


class Category(NamedTuple):
    """A category of the chain: the label column, and the value that means it applies."""

    name: str
    label: str
    applies: int


#: The order of the chain: what is of low quality, then what is toxic.
CATEGORIES = (Category("low_quality", "quality", 0), Category("toxic", "toxic", 1))
#: The bound of the training sample, in labelled documents.
SAMPLE_ROWS = 8_000
#: Folds of the out-of-fold predictions; documents of the sample a word must occur in: with
#: fewer, a fold may have never seen it, so its out-of-fold probabilities would not be those of the model.
FOLDS, MIN_DOCUMENTS = 5, 5
#: Gradient steps, ridge penalty per sample.
STEPS, PENALTY = 100, 1e-4
#: Log-odds by which a document must exceed a text without a known word to be rejected.
MARGIN = 0.5
#: Letters of a prefix that is a feature beside the word; words that a scorer remembers.
PREFIX, REMEMBERED = 5, 150_000

_EDGES = string.punctuation + "¡¿«»“”„’‘…–—"


def features_of(word: str) -> tuple[str, ...]:
    """A lower-cased word without punctuation at its ends, and its prefix if it is longer than that."""
    word = word.strip(_EDGES)
    return (word, word[:PREFIX] + "~") if len(word) > PREFIX else (word,) if word else ()


def words_of(text: str) -> set[str]:
    """The distinct features of all words of a text."""
    return {f for w in set(text.lower().split()) for f in features_of(w)}


class KnownWords(dict):
    """Raw words to the model columns of their features; forgets all when it holds too many."""

    def __init__(self, index: dict[str, int]):
        self.index = index

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = tuple(self.index[f] for f in features_of(word) if f in self.index)
        return found


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold with the best F1 on out-of-fold probabilities, midway between its neighbours.


    0.5 where one class is missing.
    """
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    f = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    ends = np.append(p[1:] < p[:-1], True)  # a cut cannot part equal probabilities
    at = int(np.argmax(np.where(ends, f, -1)))
    return float((p[at] + p[at + 1]) / 2) if at + 1 < len(p) else float(p[at] / 2)


def training_rows(docs: DataFrame, labels: DataFrame, categories: Sequence[Category], rows: int) -> DataFrame:
    """At most ``rows`` labelled documents: row, fold, one 0/1 column per category, words.

    Documents are taken in the order of a hash of their id. A document needs a
    label of one category at least; the columns of the others are null. Rows of
    ``labels`` with a null id are left out; of several rows of an id the largest
    label counts, and of several texts of an id any one is used (the largest).
    """
    marks = [
        F.max((F.col(c.label) == c.applies).cast("int")).alias(f"y{i}") for i, c in enumerate(categories)
    ]
    whole = labels.dropna(subset=["doc_id"]).dropna("all", subset=list({c.label for c in categories}))
    chosen = (
        whole.groupBy(F.col("doc_id").cast("long").alias("row")).agg(*marks).orderBy(F.xxhash64("row"), "row").limit(rows)
    )
    chosen = staged(chosen, "labelled")
    texts = docs.select(F.col("doc_id").cast("long").alias("row"), text_of().alias("text"))
    # Bounded by ``rows``, so the documents are filtered where they are read.
    found = texts.join(F.broadcast(chosen), "row").groupBy("row", *[f"y{i}" for i in range(len(categories))])
    fold = F.pmod(F.xxhash64(F.lit("fold"), "row"), F.lit(FOLDS)).cast("int").alias("fold")
    sample = found.agg(F.max("text").alias("text")).withColumn("fold", fold)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted(words_of(t)) for t in texts_of(batch)]
            at = batch.schema.get_field_index("text")
            columns = list(batch.columns)
            columns[at] = pa.array(words, pa.list_(pa.string()))
            names = list(batch.schema.names)
            names[at] = "words"
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ", ".join(f"y{i} int" for i in range(len(categories)))
    ordered = sample.select("row", "fold", *[f"y{i}" for i in range(len(categories))], "text")
    return staged(ordered.mapInArrow(split, f"row long, fold int, {kinds}, words array<string>"), "chain-sample")


def fit_logistic(rows: np.ndarray, columns: np.ndarray, extra: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """Ridge logistic regression on 0/1 features given as (row, column) pairs, plus dense columns ``extra``.

    Accelerated gradient steps, scaled per feature by its curvature bound. Weights
    of features are not negative: words speak for a category or not at all, so a
    text never counts as toxic for being short or new.
    Returns weights of the features, then of ``extra``, then the intercept; all 0 without a row.
    """
    n, dense = len(y), extra.shape[1]
    if not n:
        return np.zeros(width + dense + 1)
    size = np.maximum(np.bincount(rows, minlength=n), 1)
    counts = np.bincount(columns, weights=size[rows], minlength=width) / (4 * n)
    scale = np.concatenate([
        1 / (counts + PENALTY + 1e-9), 1 / ((np.square(extra) * size[:, None]).mean(axis=0) / 2 + PENALTY + 1e-9),
        [1 / (size.mean() / 4)],
    ])
    share = (y.sum() + 0.5) / (n + 1)
    w = np.zeros(width + dense + 1)
    w[-1] = np.log(share / (1 - share))
    ahead, t = w.copy(), 1.0
    for _ in range(STEPS):
        score = np.bincount(rows, weights=ahead[columns], minlength=n) + extra @ ahead[width:-1] + ahead[-1]
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y) / n
        slope = np.concatenate([
            np.bincount(columns, weights=error[rows], minlength=width), extra.T @ error, [error.sum()]
        ])
        slope[:-1] += PENALTY * ahead[:-1]
        step = ahead - slope * scale
        step[:width] = np.maximum(step[:width], 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = step + (before - 1) / t * (step - w), step
    return w


def _pairs(words: Sequence, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    rows, columns = [], []
    for row, own in enumerate(words):
        at = [index[w] for w in own if w in index]
        rows.append(np.full(len(at), row))
        columns.append(np.array(at, dtype=np.int64))
    return np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), np.concatenate([*columns, np.empty(0, np.int64)])


def _chain_step(index, place: int, earlier: Sequence[str]):
    """Fit category ``place`` for one fold (or, fold -1, for all rows) and predict the rows of the fold.

    It is fitted on the rows that have its label, and predicts all: a later
    category may have a label where this one has none.
    """

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row")
        held_out = (group["fold"] == group["model"]).to_numpy()
        vocabulary = index.value
        y = group[f"y{place}"].to_numpy(dtype=float)
        extra = group[list(earlier)].to_numpy(dtype=float).reshape(len(group), len(earlier)) - 0.5
        rows, columns = _pairs(group["words"], vocabulary)
        model = int(group["model"].iloc[0])
        taught = ~held_out & ~np.isnan(y)
        fitted = np.flatnonzero(taught)
        place_of = np.full(len(group), -1)
        place_of[fitted] = np.arange(len(fitted))
        used = taught[rows]
        w = fit_logistic(place_of[rows[used]], columns[used], extra[fitted], y[fitted], len(vocabulary))
        if model < 0:
            return pd.DataFrame({"row": [-1], "p": [0.0], "weights": [w.astype("<f8").tobytes()]})
        score = np.bincount(rows, weights=w[columns], minlength=len(group)) + extra @ w[len(vocabulary) : -1] + w[-1]
        p = 1 / (1 + np.exp(-np.clip(score[held_out], -30, 30)))
        return pd.DataFrame({"row": group["row"].to_numpy()[held_out], "p": p, "weights": None})

    return fit


class Chain(NamedTuple):
    """A fitted chain: words, and per category the weights of words, earlier probabilities and intercept."""

    categories: tuple[str, ...]
    index: dict[str, int]
    weights: np.ndarray  # categories x words
    links: list[list[float]]  # per category the weights of the probabilities before it
    intercepts: list[float]
    threshold: float  # of the last category

    def probabilities(self, text: str, known: KnownWords) -> list[float]:
        at = {i for w in set(text.lower().split()) for i in known[w]}
        sums = self.weights[:, sorted(at)].sum(axis=1) if at else np.zeros(len(self.categories))
        found: list[float] = []
        for total, link, intercept in zip(sums.tolist(), self.links, self.intercepts):
            score = total + intercept + sum(w * (p - 0.5) for w, p in zip(link, found))
            found.append(float(1 / (1 + np.exp(-min(30.0, max(-30.0, score))))))
        return found

    def as_json(self) -> str:
        """The model as text, for keeping."""
        return json.dumps(self._asdict() | {"weights": self.weights.tolist()})

    @classmethod
    def from_json(cls, text: str) -> Chain:
        data = json.loads(text)
        return cls(**data | {"weights": np.array(data["weights"]), "categories": tuple(data["categories"])})


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: Sequence[Category] = CATEGORIES, rows: int = SAMPLE_ROWS
) -> Chain | None:
    """Fit the chain on at most ``rows`` labelled documents; None if there is none."""
    sample = training_rows(docs, labels, categories, rows)
    frequent = (
        sample.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
        .where(F.col("n") >= MIN_DOCUMENTS).orderBy(F.desc("n"), "word")
    )
    words = [r["word"] for r in frequent.select("word").collect()]  # a fifth of the words of ``rows`` documents at most
    if not sample.limit(1).collect():
        return None
    index = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})
    weights, links, intercepts, earlier = [], [], [], []
    for place in range(len(categories)):
        models = sample.withColumn("model", F.explode(F.sequence(F.lit(-1), F.lit(FOLDS - 1))))
        fitted = staged(
            models.groupBy("model").applyInPandas(
                _chain_step(index, place, earlier), "row long, p double, weights binary"
            ),
            "chain-step",
        )
        w = np.frombuffer(fitted.where("weights IS NOT NULL").first()["weights"], dtype="<f8")
        weights.append(w[: len(words)])
        links.append(w[len(words) : -1].tolist())
        intercepts.append(float(w[-1]))
        out_of_fold = fitted.where("weights IS NULL").select("row", "p")
        if place + 1 < len(categories):
            sample = sample.join(out_of_fold.withColumnRenamed("p", f"p{place}"), "row")
            earlier.append(f"p{place}")
    # At most ``rows`` numbers.
    judged = sample.select("row", F.col(f"y{len(categories) - 1}").alias("y")).dropna()
    judged = out_of_fold.join(judged, "row").toPandas()
    cut = best_cut(judged["p"].to_numpy(dtype=float), judged["y"].to_numpy(dtype=float))
    table = np.array(weights).reshape(len(categories), -1)
    chain = Chain(tuple(c.name for c in categories), index.value, table, links, intercepts, cut)
    empty = chain.probabilities("", KnownWords(chain.index))[-1]
    least = 1 / (1 + (1 - empty) / empty * np.exp(-MARGIN))
    return chain._replace(threshold=max(cut, float(least)))


def _scored(chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = chain.value
        known = KnownWords(model.index)
        for batch in batches:
            found = [model.probabilities(t, known) for t in texts_of(batch)]
            columns = list(zip(*found)) if found else [()] * len(model.categories)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.float64()) for c in columns]],
                ["doc_id", *[f"p_{c}" for c in model.categories]],
            )

    return run


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, categories: Sequence[Category] = CATEGORIES, threshold: float | None = None
) -> DataFrame:
    """Per row: doc_id, the probability of each category (``p_`` and its name), ``rejected``.

    ``rejected`` asks the last category for ``threshold``, by default the one with
    the best F1 on the out-of-fold predictions of the training sample, but at
    least :data:`MARGIN` above what a text without a known word scores. A null or empty text is
    scored by the intercepts alone. A label that is null teaches nothing about its
    own category, but the others of its row do; a category without any label is
    0.5 for all. Without a labelled document probabilities are
    null and nothing is rejected. Repeated rows are scored alike.
    """
    chain = fit_chain(docs, labels, categories)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    names = [f"p_{c.name}" for c in categories]
    if chain is None:
        none = [F.lit(None).cast("double").alias(n) for n in names]
        return texts.select("doc_id", *none, F.lit(False).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # bounded by the words of the training sample
    schema = ", ".join(["doc_id long", *[f"{n} double" for n in names]])
    scored = texts.mapInArrow(_scored(shared), schema)
    return scored.withColumn("rejected", F.col(names[-1]) >= (chain.threshold if threshold is None else threshold))


def without_toxic(
    docs: DataFrame, labels: DataFrame, categories: Sequence[Category] = CATEGORIES, threshold: float | None = None
) -> DataFrame:
    """``docs`` without the rows that :func:`toxicity_scores` rejects; same columns."""
    chain = fit_chain(docs, labels, categories)
    if chain is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    cut = chain.threshold if threshold is None else threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = KnownWords(model.index)
        for batch in batches:
            stays = [model.probabilities(t or "", known)[-1] < cut for t in texts_of(batch)]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
