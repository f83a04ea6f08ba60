"""Benchmark decontamination over the positional index of the training documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayline.llm.common import text_of, texts_of
from stayline.llm.positional_index import indexed_documents, phrase_matches, positional_index, words_of
from stayline.session import staged

#: Words of a window; a shorter item is one window.
WINDOW = 10


def windows_of(words: list[bytes], size: int = WINDOW) -> list[list[bytes]]:
    return [words[at : at + size] for at in range(max(1, len(words) - size + 1))] if words else []


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), texts_of(batch)):
                found = windows_of(words_of(text), size)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(found), pa.int64()), pa.array(found, pa.list_(pa.binary()))],
                        ["item", "words"],
                    )

    return run


def numbered_items(benchmark: DataFrame) -> DataFrame:
    """``benchmark`` as a written table (item, item_id, text): rows numbered, so that null and repeated ids stay apart."""
    return staged(
        benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", text_of().cast("binary").alias("text")),
        "items",
    )


def benchmark_matches(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """(segment, row, item, start, stop): stretches of indexed documents that hold windows of :func:`numbered_items`."""
    return phrase_matches(index, items.select("item", "text").mapInArrow(_windows(window), "item long, words array<binary>"), slop)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, item_ids, contaminated.

    ``docs`` is (doc_id, text), ``benchmark`` (item_id, text); other columns are
    not read. ``n_hit`` counts the document's words inside any occurrence of a
    window of ``window`` consecutive words of an item (of all its words, if it has
    fewer); with ``slop``, occurrences are near ones as in :func:`phrase_matches`.
    ``item_ids`` are the distinct ids of those items as sorted strings. An item
    with a null id marks words and has no entry there. Null and empty texts have
    no words; equal rows get equal results; without items nothing is hit; an empty
    table of documents gives no rows.
    """
    index = positional_index(docs)
    items = numbered_items(benchmark)
    matches = benchmark_matches(index, items, window, slop)
    hits = (
        matches.select("segment", "row", "start", "stop")
        .groupBy("segment", "row")
        .agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("runs"))
        .select("segment", "row", _covered("runs").alias("n_hit"))
    )
    named = (
        matches.select("segment", "row", "item").distinct()
        .join(items.select("item", F.col("item_id").cast("string").alias("item_id")), "item")
        .groupBy("segment", "row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    found = hits.join(named, ["segment", "row"])
    none = F.array().cast("array<string>")
    return indexed_documents(index).join(found, ["segment", "row"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def _covered(runs: str):
    """Length of the union of sorted [start, stop) runs."""
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("reach"))
    return F.aggregate(
        runs,
        zero,
        lambda a, r: F.struct(
            (a["sum"] + F.greatest(F.lit(0).cast("long"), r["stop"] - F.greatest(r["start"], a["reach"]))).alias("sum"),
            F.greatest(a["reach"], r["stop"]).alias("reach"),
        ),
        lambda a: a["sum"],
    )
