"""Mixing sources to target weights with DataFrame functions only.

Words per source give a repetition rate per source; a document is emitted
floor(rate) times plus once more with probability equal to the fraction, drawn
from a seeded hash of the row, so reruns agree under any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from stayline.llm.common import sized_broadcast, text_of
from stayline.session import staged

#: A word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: A source is never taken more often than this.
MAX_REPEATS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0) in code point order, null last, without a one-task window.

    Range partitions are numbered inside by ``monotonically_increasing_id``; what
    precedes a partition is a sum over one row per partition.
    """
    numbered = staged(
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("_id", F.monotonically_increasing_id()),
        "sources",
    )
    part = F.shiftright("_id", 33).alias("_part")
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = numbered.groupBy(part).agg(F.count("*").alias("n"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # over one row per partition
    before = counts.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .select("source", "source_size", (F.col("before") + inside).alias("rank"))
    )


def source_targets(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS
) -> DataFrame:
    """Per source: source, source_size, target, rate (target / size; 0 for an empty source).

    The targets share the words of all sources by weight; a target stops at
    ``max_repeats`` times its source, and the excess is shared again by weight
    among the others until none is above. Each round is one small aggregate.
    """
    sizes = docs.groupBy("source").agg(F.sum(word_count(text_of())).alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = staged(
        _ranked(sizes).select(
            "source",
            "source_size",
            F.get(cycle, (F.col("rank") % len(weights)).cast("int")).alias("w"),
            (F.col("source_size") * float(max_repeats)).alias("most"),
        ),
        "source-weights",
    )
    level, full = None, -1
    while True:
        capped = F.lit(False) if level is None else F.col("w") * level > F.col("most")
        row = sources.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(capped, F.col("most"))).alias("fixed"),
            F.sum(F.when(~capped, F.col("w"))).alias("open"),
            F.count(F.when(capped, True)).alias("full"),
        ).first()
        if row["full"] == full or not row["open"]:
            break
        level, full = ((row["words"] or 0) - (row["fixed"] or 0.0)) / row["open"], row["full"]
    shared = F.col("w") * F.lit(float(level or 0.0))
    target = F.when(shared > F.col("most"), F.col("most")).otherwise(shared)
    return sources.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def _draw(seed: int) -> Column:
    """A number in [0, 1) from a seeded hash of id and text."""
    mixed = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    return F.shiftrightunsigned(mixed, 11) / float(1 << 53)


def _with_copies(docs: DataFrame, weights: Sequence[float], max_repeats: float, seed: int) -> DataFrame:
    """The row as struct ``d``, ``copies``, and its source's ``source_size`` and ``target``."""
    rates = staged(source_targets(docs, weights, max_repeats), "source-rates")
    sized = sized_broadcast(rates, F.coalesce(F.length("source"), F.lit(0)) * 4 + 64)
    # A source may hold a third of all rows: beyond a broadcast, adaptive execution splits its partition.
    rows = docs.select(F.struct("*").alias("d"), F.col("source").alias("_source"), _draw(seed).alias("draw"))
    joined = rows.join(sized, F.col("_source").eqNullSafe(F.col("source")))
    whole = F.floor("rate")
    copies = whole + F.when(F.col("draw") < F.col("rate") - whole, 1).otherwise(0)
    return joined.select("d", copies.cast("int").alias("copies"), "source_size", "target")


def mixture(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS, seed: int = 1
) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, copies, taken.

    ``size`` is the number of words (null text: 0), ``copies`` how often the mix
    takes the document, ``taken`` the words it takes. Rows that agree in id and
    text draw alike; no document is taken more than ``max_repeats`` times. Sources
    are ordered by code point, null last. Empty tables give no rows.
    """
    size = word_count(F.coalesce(F.col("d.text"), F.lit("")))
    return (
        _with_copies(docs, weights, max_repeats, seed)
        .select(F.col("d.doc_id").alias("doc_id"), size.alias("size"), "source_size", "target", "copies")
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def mixed(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS, seed: int = 1
) -> DataFrame:
    """``docs`` with every row repeated as the mix takes it; same columns."""
    taken = _with_copies(docs, weights, max_repeats, seed).where(F.col("copies") > 0)
    return taken.select("d", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("d.*")
