"""Exact interpolated quantiles by radix descent.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which does not survive a wide-range double column at scale.
Here a double becomes a 64-bit integer of the same order, and wanted ranks are
found digit by digit: one aggregation counts the rows per 16-bit digit (combined
on the map side, so at most 65,536 rows leave a task for a group), the rank walks
down to the digit that holds it, and the next round looks only at rows that share
the digits found so far. After four rounds at most, sooner where a digit holds a
single value, the value is known. No rank can be missed, and nothing is sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayline.session import BROADCAST_ROWS, staged

#: Sketch accuracy of the approximate form: its rank error is at most rows / ACCURACY.
ACCURACY = 10_000
#: Bits of a digit and of a whole key.
DIGIT_BITS, KEY_BITS = 16, 64


def numeric_long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by…, column, value) with one row per non-missing number."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(by), list(columns), "column", "value").where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def with_ordered_key(df: DataFrame, value: str, key: str) -> DataFrame:
    """``df`` with the bits of a double as a long of the same order; both zeros are 0, NaN is not defined.

    The bits are computed with exact arithmetic: scaling by a power of two loses
    nothing, and an exponent that the logarithm rounds wrongly is put right.
    """
    size = F.abs(F.col(value))
    exponent = F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(F.col("_size")))))
    steps = df.withColumn("_size", size)
    steps = steps.withColumn("_exponent", F.when((F.col("_size") > 0) & (F.col("_size") < float("inf")), exponent))
    steps = steps.withColumn("_scaled", F.col("_size") / F.pow(F.lit(2.0), F.col("_exponent")))
    shift = F.when(F.col("_scaled") >= 2, 1).when(F.col("_scaled") < 1, -1).otherwise(0)
    steps = steps.withColumn("_shift", shift)
    fraction = F.col("_scaled") / F.pow(F.lit(2.0), F.col("_shift")) - 1
    normal = ((F.col("_exponent") + F.col("_shift") + 1023) * 2.0**52).cast("long") + (fraction * 2.0**52).cast("long")
    bits = (
        F.when(F.col("_size") == 0, F.lit(0).cast("long"))
        .when(F.col("_size") == float("inf"), F.lit(2047 << 52).cast("long"))
        .when(F.col("_size") < 2.0**-1022, (F.col("_size") * 2.0**1000 * 2.0**74).cast("long"))
        .otherwise(normal)
    )
    signed = F.when(F.col(value) < 0, -bits).otherwise(bits)
    return steps.withColumn(key, signed).drop("_size", "_exponent", "_scaled", "_shift")


def _held(df: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], int]:
    """The open ranks computed once, how to hint joins with them, and the most rows that one of them is among (0: none open).

    With at most :data:`BROADCAST_ROWS` rows it is a local table to be broadcast,
    else it is written and joined by shuffle.
    """
    head = df.limit(BROADCAST_ROWS + 1).toArrow()
    if head.num_rows > BROADCAST_ROWS:
        written = staged(df, "ranks")
        most = written.where(F.col("found").isNull()).agg(F.max("among")).first()[0]
        return written, lambda part: part, most or 0
    among = head.filter(head.column("found").is_null()).column("among").to_pylist()
    return df.sparkSession.createDataFrame(head, schema=df.schema), F.broadcast, max(among, default=0)


def _same(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition &= F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return condition


def _walked(histogram: Column, rank: Column) -> Column:
    """The entry of a histogram sorted by digit that holds ``rank`` (from 0), with the rank inside it as ``left``."""
    start = F.struct(rank.alias("left"), F.lit(None).cast("struct<digit:long,c:long,low:double,high:double>").alias("at"))

    def step(state: Column, entry: Column) -> Column:
        here = state["at"].isNull() & (state["left"] < entry["c"])
        passed = state["at"].isNull() & ~here
        return F.struct(
            F.when(passed, state["left"] - entry["c"]).otherwise(state["left"]).alias("left"),
            F.when(here, entry).otherwise(state["at"]).alias("at"),
        )

    return F.aggregate(histogram, start, step)


def _histogram(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per ``keys``: entries (digit, c, low, high) sorted by digit, at most 2^DIGIT_BITS of them."""
    counted = rows.groupBy(*keys, "digit").agg(
        F.count(F.lit(1)).alias("c"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    entries = F.array_sort(F.collect_list(F.struct("digit", "c", "low", "high")))
    return counted.groupBy(*keys).agg(entries.alias("entries"))


def _settled_ranks(found: DataFrame, keys: Sequence[str], digit_bits: int = DIGIT_BITS) -> DataFrame:
    """The walked ranks: a value where the digit holds only one, else the digits so far and the rank among them."""
    at = F.col("walked.at")
    prefix = F.coalesce(F.shiftleft("prefix", digit_bits), F.lit(0).cast("long")) + at["digit"]
    return found.select(
        *keys,
        "n",
        "rank",
        prefix.alias("prefix"),
        F.col("walked.left").alias("left"),
        at["c"].alias("among"),
        F.when(at["low"] == at["high"], at["low"]).alias("found"),
    )


def ranked_values(long: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(keys…, n, rank, value) for the ranks next to (n - 1) p of every probability, per group of ``keys``.

    ``long`` holds the keys and ``value``, without missing numbers.
    """
    rows = with_ordered_key(long, "value", "key")
    low_bits = KEY_BITS - DIGIT_BITS
    first = _histogram(rows.withColumn("digit", F.shiftright("key", low_bits)), keys)
    n = F.aggregate("entries", F.lit(0).cast("long"), lambda s, e: s + e["c"])
    exact = [(F.col("n") - 1) * F.lit(float(p)) for p in sorted(set(probabilities))]
    wanted = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(h), F.ceil(h)) for h in exact])))
    ranks = first.withColumn("n", n).select(*keys, "n", "entries", F.explode(wanted).alias("rank"))
    state, hinted, among = _held(
        _settled_ranks(
            ranks.select(*keys, "n", "rank", F.lit(None).cast("long").alias("prefix"),
                         _walked(F.col("entries"), F.col("rank")).alias("walked")),
            keys,
        )
    )
    done = [state.where(F.col("found").isNotNull())]
    left_bits = low_bits
    while among:
        state = state.where(F.col("found").isNull())
        digit_bits = left_bits if among <= 2**DIGIT_BITS else DIGIT_BITS
        digits = rows.withColumn("prefix", F.shiftright("key", left_bits)).withColumn(
            "digit", F.pmod(F.shiftright("key", left_bits - digit_bits), F.lit(2**digit_bits))
        )
        left_bits -= digit_bits
        own = [*keys, "prefix"]
        near = digits.alias("l").join(hinted(state.select(*own)).alias("r"), _same(own), "left_semi")
        state, hinted, among = _held(
            _settled_ranks(
                _histogram(near, own).alias("l")
                .join(hinted(state).alias("r"), _same(own))
                .select(*[f"r.{k}" for k in keys], "r.n", "r.rank", "r.prefix",
                        _walked(F.col("l.entries"), F.col("r.left")).alias("walked")),
                keys,
                digit_bits,
            )
        )
        done.append(state.where(F.col("found").isNotNull()))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select(*keys, "n", "rank", F.col("found").alias("value"))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    approximate: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles of several numeric columns, optionally per group.

    Returns ``by…, column, n, quantiles`` where ``quantiles`` is an array in
    the order of ``probabilities``. Groups without a value are absent.
    ``approximate=True`` returns sketch quantiles (elements of the data) in one pass.

    The rows are scanned once per round, at most four times; what is shuffled
    are histograms, so neither a hot group nor a hot value makes a large task.
    """
    probabilities = [float(p) for p in probabilities]
    keys = [*by, "column"]
    long = numeric_long(df, columns, by)
    if approximate:
        return long.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx("value", probabilities, ACCURACY).alias("quantiles"),
        )
    values = ranked_values(long, keys, probabilities)
    by_rank = F.map_from_entries(F.collect_list(F.struct("rank", "value")))
    picked = values.groupBy(*keys, "n").agg(by_rank.alias("_values"))

    def result(p: float) -> Column:
        exact = (F.col("n") - 1) * F.lit(p)
        low, high = F.element_at("_values", F.floor(exact)), F.element_at("_values", F.ceil(exact))
        fraction = exact - F.floor(exact)
        return F.when(fraction == 0, low).otherwise(low + (high - low) * fraction)

    return picked.select(*keys, "n", F.array(*[result(p) for p in probabilities]).alias("quantiles"))


def quantile_values(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], approximate: bool = False
) -> dict[str, list[float]]:
    """Whole-table quantiles per column as driver values: one bounded row per column.

    A column without any value is absent from the result.
    """
    if not columns:
        return {}
    rows = exact_quantiles(df, columns, probabilities, approximate=approximate).collect()
    return {row["column"]: list(row["quantiles"]) for row in rows}
