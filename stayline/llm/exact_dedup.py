"""Exact deduplication with a split for heavy hitters.

Misra-Gries summaries of the partitions name every digest that may be frequent.
Their exact counts and winners (at most :data:`COUNTERS` rows) are broadcast and
settle the frequent groups on the map side; only the remaining digests shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayline.llm.common import text_of
from stayline.session import staged

#: Counters of a partition's summary, and the most winners that are broadcast.
COUNTERS = 1_000


def misra_gries(counts: Counter, arrivals: Counter, counters: int) -> Counter:
    """Add ``arrivals`` to a summary and shrink it back to ``counters`` entries.

    Every entry loses the same amount, the largest count that does not fit, so a
    digest is underestimated by at most n / (counters + 1) after n arrivals.
    """
    counts.update(arrivals)
    if len(counts) <= counters:
        return counts
    excess = sorted(counts.values(), reverse=True)[counters]
    return Counter({k: v - excess for k, v in counts.items() if v > excess})


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts = misra_gries(counts, Counter(batch.column("digest").to_pylist()), counters)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["digest", "seen"]
            )

    return run


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that may hold more than 2 / ``counters`` of the rows; never more than ``counters``.

    The summed lower bounds of a digest of frequency f exceed f - n / (counters +
    1). Asking them to exceed n / counters keeps every digest with f > 2 n /
    counters, and as lower bounds sum to n at most, no more than ``counters``.
    """
    bound = digests.count() / counters
    return (
        digests.select("digest")
        .mapInArrow(_summaries(counters), "digest binary, seen long")
        .groupBy("digest")
        .agg(F.sum("seen").alias("seen"))
        .where(F.col("seen") > bound)
        .select("digest")
    )


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. Of a group the row with
    the largest ``doc_id`` stays (null ids are smallest); of rows that tie even in
    ``doc_id`` exactly one stays. Other columns are not read. An empty table gives
    no rows.
    """
    digests = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    best = F.max(F.struct("doc_id", "row")).alias("best")
    frequent = frequent_digests(digests, counters)
    winners = staged(
        digests.join(F.broadcast(frequent), "digest")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), best),
        "winners",
    )
    settled = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    shuffled = rest.join(rest.groupBy("digest").agg(F.count("*").alias("group_size"), best), "digest")
    return settled.unionByName(shuffled).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
