"""Row order as a column: dense ordinals without a global sort in one task.

A table has no order, but a batch file has. The ordinal is found once, when the batch
is read, travels through joins and shuffles as a plain column, and decides again when
the result is written. Only one row per block or partition reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayline.session import lookup, staged

_BLOCK, _PLACE = ("_order_file", "_order_start"), "_order_place"


def _numbered(marked: DataFrame, block: Sequence[str], order: Callable, name: str) -> DataFrame:
    """Number rows by block, in the sequence that ``order`` gives the blocks, then by place in the block."""
    spark = marked.sparkSession
    blocks = marked.groupBy(*block).agg(F.min(_PLACE).alias("_order_first"), F.count(F.lit(1)).alias("_order_rows"))
    before, offsets = 0, []
    for row in sorted(blocks.collect(), key=order):
        # Rows of a block are consecutive, so its first place stands for the start.
        offsets.append((*(row[b] for b in block), before - row["_order_first"]))
        before += row["_order_rows"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.select(*block).schema)
    table = spark.createDataFrame(offsets, f"{kinds}, _order_shift long")
    placed = marked.join(lookup(table), list(block))
    return placed.withColumn(name, F.col(_PLACE) + F.col("_order_shift")).drop(*block, _PLACE, "_order_shift")


def with_ordinal(df: DataFrame, order_by: Sequence[Column | str], name: str = "ordinal") -> DataFrame:
    """``df`` with its rank from 0 by ``order_by``, each number once.

    Range partitions are sorted on their own and offset by the sizes of the partitions
    before. Ties are broken at will but once and for all, as the marked rows are written.
    """
    part = "_order_part"
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    marked = ranged.withColumn(_PLACE, F.monotonically_increasing_id()).withColumn(part, F.spark_partition_id())
    return _numbered(staged(marked, "ordinal"), [part], lambda r: r[part], name)


def _part_number(path: str) -> tuple[int, str]:
    """Files of one write by their number, which outgrows its padding at 100,000 files; others by name."""
    found = re.search(r"part-(\d+)", path.rsplit("/", 1)[-1])
    return (int(found[1]) if found else -1, path)


def with_file_order(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """``df``, a scan of files, with each row's place in them: files by part number or name, then as they are read.

    Within a block of a file rows are read in order and by one task, so their order is
    known without sorting. The scan is staged once, for its marks must not change.
    """
    marked = df.select(
        "*",
        F.col("_metadata.file_path").alias(_BLOCK[0]),
        F.col("_metadata.file_block_start").alias(_BLOCK[1]),
        F.monotonically_increasing_id().alias(_PLACE),
    )
    return _numbered(staged(marked, "file-order"), _BLOCK, lambda r: (*_part_number(r[_BLOCK[0]]), r[_BLOCK[1]]), name)


def write_in_order(df: DataFrame, path: str, name: str = "ordinal") -> None:
    """Write Parquet whose files, read by :func:`with_file_order`, hold the rows by ``name``, which is not written."""
    df.repartitionByRange(name).sortWithinPartitions(name).drop(name).write.parquet(path)


def read_in_order(spark: SparkSession, path: str, name: str = "ordinal") -> DataFrame:
    """A Parquet table with each row's place in it."""
    return with_file_order(spark.read.parquet(path), name)
