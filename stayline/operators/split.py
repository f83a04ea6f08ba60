"""Deterministic stratified splits that no partitioning can change."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from stayline import schema
from stayline.functions.ranking import hash_block, salted_hash
from stayline.session import lookup

_NO_CLASS = "\x00"


def _hashed(df: DataFrame, id_column: str, seed: int) -> DataFrame:
    return df.withColumn("_h", salted_hash(id_column, seed)).withColumn("_b", hash_block(F.col("_h")))


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    )


def stratified_split(
    df: DataFrame,
    id_column: str = schema.ID_COLUMN,
    target: str = schema.TARGET_COLUMN,
    share: float = schema.TEST_SHARE,
    seed: int = schema.SPLIT_SEED,
) -> DataFrame:
    """Add ``is_test``: per class, the ``ceil(share * n)`` rows with the smallest id hash.

    Ids must be unique. A histogram over the leading hash bits finds the block
    that holds each class's last test row, only that block is ranked, and the
    table is then marked by comparing each hash with one cut-off per class. The
    whole table is never shuffled or sorted.
    """
    hashed = _hashed(df, id_column, seed)
    upto = W.partitionBy(target).orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    histogram = hashed.groupBy(target, "_b").agg(F.count(F.lit(1)).alias("_n"))
    filled = histogram.withColumn("_cum", F.sum("_n").over(upto)).withColumn(
        "_quota", F.ceil(F.round(F.sum("_n").over(W.partitionBy(target)) * F.lit(share), 9))
    )
    edge = filled.where(
        (F.col("_cum") >= F.col("_quota")) & (F.col("_cum") - F.col("_n") < F.col("_quota"))
    ).select(target, "_b", (F.col("_quota") - F.col("_cum") + F.col("_n")).alias("_need"))

    inside = (
        hashed.select(id_column, target, "_h", "_b")
        .alias("l")
        .join(lookup(edge).alias("r"), _same("l", "r", [target, "_b"]))
        .select(F.col(f"l.{target}").alias(target), "_h", F.col(f"l.{id_column}").alias("_id"), "_need")
    )
    place = F.row_number().over(W.partitionBy(target).orderBy("_h", "_id"))
    cut = (
        inside.withColumn("_place", place)
        .where(F.col("_place") == F.col("_need"))
        .select(target, F.struct("_h", "_id").alias("_cut"))
    )
    marked = hashed.alias("l").join(lookup(cut).alias("r"), _same("l", "r", [target]), "left")
    own = F.struct(F.col("l._h").alias("_h"), F.col(f"l.{id_column}").alias("_id"))
    return marked.select(
        *[F.col(f"l.{c}").alias(c) for c in df.columns],
        F.coalesce(own <= F.col("r._cut"), F.lit(False)).alias("is_test"),
    )


def kfold(
    df: DataFrame,
    id_column: str = schema.ID_COLUMN,
    target: str | None = schema.TARGET_COLUMN,
    folds: int = schema.FOLDS,
    seed: int = schema.SPLIT_SEED,
    name: str = "fold",
) -> DataFrame:
    """Add a fold number 0..folds-1 from the id-hash rank within each class.

    Without ``target`` the rank runs over the whole table. Ranks are taken
    inside hash blocks, with the block's offset joined on the same key, so that
    a class is spread over tens of thousands of groups and one shuffle serves
    both the window and the join.
    """
    stratum = F.coalesce(F.col(target).cast("string"), F.lit(_NO_CLASS)) if target else F.lit("")
    hashed = _hashed(df, id_column, seed).withColumn("_c", stratum)
    before = W.partitionBy("_c").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("_c", "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_c", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.row_number().over(W.partitionBy("_c", "_b").orderBy("_h", id_column))
    joined = hashed.withColumn("_place", place).join(offsets, ["_c", "_b"])
    fold = ((F.col("_offset") + F.col("_place") - 1) % folds).cast("int")
    return joined.select(*df.columns, fold.alias(name))


def holdout_batch(
    cleaned: DataFrame,
    id_column: str = schema.ID_COLUMN,
    target: str = schema.TARGET_COLUMN,
    share: float = schema.TEST_SHARE,
    seed: int = schema.SPLIT_SEED,
) -> DataFrame:
    """The held-out customers without their target: a batch no model was fitted on."""
    keys = cleaned.select(id_column, target)
    held = stratified_split(keys, id_column, target, share, seed).where("is_test").select(id_column)
    return cleaned.join(held, id_column, "left_semi").drop(target)
