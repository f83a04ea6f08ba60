"""Running totals and ranks over inputs too large for one sorted window.

A window without a partition key, or with one hot key, sorts everything in one
task. These helpers cut the order into blocks, total the blocks, and run the
window inside each block only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame, functions as F, types as T, Window as W

from stayline.session import lookup

#: Blocks the order is cut into; each holds about this fraction of the rows.
BLOCKS = 512
#: Leading hash bits used as the block of a hashed order.
HASH_BITS = 16


def _as_number(df: DataFrame, order: str) -> Column:
    """An order as a double; times and dates through their microseconds."""
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(order).cast("timestamp_ntz")).cast("double")
    return F.col(order).cast("double")


def cut_blocks(df: DataFrame, order: str, blocks: int = BLOCKS) -> DataFrame:
    """Add ``_block``: which of about ``blocks`` even, ordered slices ``order`` falls into.

    The edges are approximate quantiles of a numeric ``order``, found in one
    pass; at most ``blocks`` numbers reach the driver.
    """
    keyed = df.withColumn("_order", _as_number(df, order))
    cutter = QuantileDiscretizer(
        numBuckets=blocks, inputCol="_order", outputCol="_block", relativeError=0.25 / blocks
    )
    return cutter.fit(keyed).transform(keyed).drop("_order")


def running_before(
    df: DataFrame,
    order: str,
    totals: dict[str, tuple[str, Callable[[Column], Column], Callable[[Column, Column], Column]]],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add, per row, an aggregate over all rows that come before it in ``order``.

    ``df`` comes from :func:`cut_blocks` on the same ``order``, which must be
    unique within ``by``. ``totals`` maps an output name to (input column,
    aggregate, combine), for example ``("neg", F.sum, operator.add)``. The sorted
    windows run per block, so one hot group is spread over many tasks; across
    blocks only their totals are accumulated.
    """
    keys = [*by, "_block"]
    block_totals = df.groupBy(*keys).agg(
        *[aggregate(F.col(source)).alias(name) for name, (source, aggregate, _) in totals.items()]
    )
    earlier = W.partitionBy(*by).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = block_totals.select(
        *keys,
        *[aggregate(F.col(name)).over(earlier).alias(f"_o_{name}") for name, (_, aggregate, _) in totals.items()],
    )
    within = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    local = df.withColumns(
        {f"_w_{name}": aggregate(F.col(source)).over(within) for name, (source, aggregate, _) in totals.items()}
    )
    joined = local.join(lookup(offsets), keys, "left")
    return joined.select(
        *df.columns,
        *[
            F.coalesce(
                combine(F.col(f"_o_{name}"), F.col(f"_w_{name}")),
                F.col(f"_o_{name}"),
                F.col(f"_w_{name}"),
            ).alias(name)
            for name, (_, _, combine) in totals.items()
        ],
    )


def salted_hash(id_column: str, seed: int) -> Column:
    """Hex md5 of id and seed: an order that no partitioning can change."""
    return F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f"|{seed}")).cast("binary"))


def hash_block(hash_column: Column) -> Column:
    """First ``HASH_BITS`` bits of a hex hash as an integer block number."""
    return F.conv(F.substring(hash_column, 1, HASH_BITS // 4), 16, 10).cast("int")
