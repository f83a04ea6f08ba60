"""Dataset fingerprints, extraction profile, and the gate that skips known input."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from stayline.functions.times import utc_literal

#: How long a transform of the same input stays valid.
EXPIRY = timedelta(days=3)


def row_digest(df: DataFrame) -> Column:
    """Hex md5 over all columns of a row.

    Every value is led by its length, and NULL is a mark without one, so no two
    different rows read alike.
    """

    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.md5(F.concat(*[part(c) for c in df.columns]).cast("binary"))


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    """One row: ``rows``, ``xor``, ``total``, ``fingerprint``.

    Row digests are combined by xor and by a modular sum, so the result does
    not depend on row order or partitioning and needs no sort. Xor alone would
    cancel repeated rows, hence the count and the sum.
    """
    number = F.conv(F.substring(row_digest(df), 1, 15), 16, 10).cast("bigint")
    combined = df.select(number.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("xor"),
        F.coalesce(F.sum(F.col("h") % 1_000_000_007), F.lit(0)).alias("total"),
    )
    joined = F.concat_ws("|", *[F.col(c).cast("string") for c in ("rows", "xor", "total")])
    return combined.withColumn("fingerprint", F.md5(joined.cast("binary")))


def extraction_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-missing values, table size."""
    fields = df.schema.fields
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(f.name).alias(f"_n_{f.name}") for f in fields])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("type"),
                        F.col(f"_n_{f.name}").alias("non_null"),
                        F.col("_rows").alias("rows"),
                        F.lit(len(fields)).alias("columns"),
                    )
                    for i, f in enumerate(fields, start=1)
                ]
            )
        )
    )


def pending(
    fingerprints: DataFrame, manifest: DataFrame, now: datetime, expiry: timedelta = EXPIRY
) -> DataFrame:
    """Fingerprints without an unexpired entry in the manifest: the inputs to transform.

    ``manifest`` holds fingerprint, output_path, created_at and is append-only.
    """
    fresh = manifest.where(F.col("created_at") > utc_literal(now - expiry)).select("fingerprint").distinct()
    return fingerprints.join(fresh, "fingerprint", "left_anti")
