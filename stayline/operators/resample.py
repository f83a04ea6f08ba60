"""Intervals by Poisson bootstrap.

Instead of drawing n rows with replacement, every row draws a Poisson(1) weight per
replicate, from an md5 of its key, so a row needs no other row and any partitioning
gives the same interval. The weights are folded before the shuffle: what leaves a
task is, per group, one sum and one weight per replicate, never a resampled row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayline.functions.numeric import nan_to_null
from stayline.operators.explore import grouped

#: Draws are numbers of 32 bits, four to an md5.
DRAW_BITS, DRAWS = 32, 4


def poisson_cuts() -> list[int]:
    """Draws below the k-th cut and not below the one before weigh k; draws at or above the last weigh one more."""
    cuts, total, term = [], 0.0, math.exp(-1)
    while (1 - total) * 2**DRAW_BITS >= 1:
        total += term
        cuts.append(math.floor(total * 2**DRAW_BITS))
        term /= len(cuts)
    return cuts


def poisson_weights(key: Column, replicates: int, seed: int) -> Column:
    """One Poisson(1) weight per replicate, from the row's key: an array of ints."""
    last = -(-replicates // DRAWS) - 1
    digests = F.transform(
        F.sequence(F.lit(0), F.lit(last)), lambda c: F.md5(F.concat(key, F.lit(f":{seed}:"), c.cast("string")))
    )
    digits = DRAW_BITS // 4

    def draws(digest: Column) -> Column:
        return F.array(
            *[F.conv(F.substring(digest, 1 + digits * i, digits), 16, 10).cast("long") for i in range(DRAWS)]
        )

    cuts = poisson_cuts()

    def weight(draw: Column) -> Column:
        found = F.when(draw < cuts[0], 0)
        for k, cut in enumerate(cuts[1:], start=1):
            found = found.when(draw < cut, k)
        return found.otherwise(len(cuts))

    return F.slice(F.transform(F.flatten(F.transform(digests, draws)), weight), 1, replicates)


def quantile_of(values: Column, probability: float) -> Column:
    """Interpolated quantile of a sorted array; null where it is empty."""
    place = (F.size(values) - 1) * F.lit(probability)
    low, high = F.get(values, F.floor(place).cast("int")), F.get(values, F.ceil(place).cast("int"))
    return low + (high - low) * (place - F.floor(place))


def bootstrap_mean(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    key: str,
    replicates: int = 200,
    level: float = 0.95,
    seed: int = 0,
) -> DataFrame:
    """Mean of ``value`` per group with a percentile interval over resampled means.

    Rows with a null group are left out; null and NaN values have no part. Rows that
    share ``key`` are drawn together, which is right for repeated measurements of one
    thing; keys should otherwise be unique. A null key counts as the empty text. A
    replicate in which a group got no row has no mean and is left out of its interval.
    """
    rows = df.select(
        *by, F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), nan_to_null(F.col(value)).alias("_x")
    )
    drawn = rows.withColumn("_w", poisson_weights(F.col("_key"), replicates, seed))
    folds = []
    for i in range(replicates):
        weight = F.when(F.col("_x").isNotNull(), F.col("_w")[i].cast("long"))
        folds += [F.sum(weight * F.col("_x")).alias(f"_s{i}"), F.sum(weight).alias(f"_n{i}")]
    stats = grouped(drawn, by, F.count("_x").alias("n"), F.avg("_x").alias("mean"), *folds)
    means = F.array(*[F.when(F.col(f"_n{i}") > 0, F.col(f"_s{i}") / F.col(f"_n{i}")) for i in range(replicates)])
    found = stats.select(*by, "n", "mean", F.array_sort(F.filter(means, lambda m: m.isNotNull())).alias("_means"))
    tail = (1 - level) / 2
    return found.select(
        *by,
        "n",
        "mean",
        quantile_of(F.col("_means"), tail).alias("ci_low"),
        quantile_of(F.col("_means"), 1 - tail).alias("ci_high"),
    )
