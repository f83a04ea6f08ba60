"""Raw extract to cleaned table, skipped when the input is already known."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline import schema
from stayline.functions.times import utc_literal
from stayline.operators.split import holdout_batch
from stayline.plans.cleaning import clean_with_log
from stayline.sources import fingerprint, writers
from stayline.sources.readers import path_exists

_MANIFEST = "fingerprint string, output_path string, created_at timestamp_ntz"


@dataclass(frozen=True)
class Manifest:
    """Append-only table of what was built from which input."""

    spark: SparkSession
    root: str

    def table(self) -> DataFrame:
        if path_exists(self.spark, self.root):
            return self.spark.read.schema(_MANIFEST).parquet(self.root)
        return self.spark.createDataFrame([], _MANIFEST)

    def find(self, print_: str, now: datetime, expiry: timedelta | None) -> str | None:
        """Newest output for a fingerprint, unless it has expired."""
        known = self.table().where(F.col("fingerprint") == print_)
        if expiry is not None:
            known = known.where(F.col("created_at") > utc_literal(now - expiry))
        top = known.agg(F.max(F.struct("created_at", "output_path")).alias("top")).first()["top"]
        return top["output_path"] if top else None

    def record(self, print_: str, path: str, now: datetime) -> None:
        row = self.spark.createDataFrame([(print_, path)], "fingerprint string, output_path string")
        row.withColumn("created_at", utc_literal(now)).coalesce(1).write.mode("append").parquet(self.root)


def build_if_changed(
    source: DataFrame,
    root: str,
    build: Callable[[str], None],
    now: datetime,
    expiry: timedelta | None = None,
    settings: str = "",
) -> tuple[str, bool]:
    """(output path, whether it was built): reuse the output of identical input and ``settings``.

    The fingerprint is one narrow pass without a shuffle, far cheaper than the
    build. Every build gets a new path, so nothing is overwritten in place.
    """
    spark = source.sparkSession
    print_ = fingerprint.dataset_fingerprint(source).first()["fingerprint"] + (f"-{settings}" if settings else "")
    manifest = Manifest(spark, f"{root}/manifest")
    known = manifest.find(print_, now, expiry)
    if known is not None:
        return known, False
    path = f"{root}/{now.strftime('%Y%m%dT%H%M%S')}-{print_[:12]}{print_[32:]}"
    build(path)
    manifest.record(print_, path, now)
    return path, True


def run_etl(raw: DataFrame, root: str, now: datetime, approximate: bool = False) -> tuple[str, bool]:
    """Profile, clean and store the extract below ``root``; the log is stored beside it.

    Identical input within the expiry time is not cleaned again.
    """

    def build(path: str) -> None:
        writers.write_report(fingerprint.extraction_profile(raw), f"{path}/extraction")
        result = clean_with_log(raw, approximate)
        writers.write_cleaned(result.cleaned, f"{path}/cleaned")
        writers.write_report(result.log, f"{path}/log")

    settings = "approximate" if approximate else "exact"
    return build_if_changed(raw, f"{root}/etl", build, now, fingerprint.EXPIRY, settings)


def prepare_batch(
    cleaned: DataFrame, root: str, now: datetime, share: float = schema.TEST_SHARE, seed: int = schema.SPLIT_SEED
) -> tuple[str, bool]:
    """Write the held-out customers as a batch, anew only when their source, share or seed changed."""

    def build(path: str) -> None:
        holdout_batch(cleaned, share=share, seed=seed).write.parquet(f"{path}.parquet")

    path, built = build_if_changed(cleaned, f"{root}/batches", build, now, settings=f"share{share:g}-seed{seed}")
    return f"{path}.parquet", built
