"""Sinks: cleaned table, reports, batch outputs with a history and a latest view."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stayline.functions.times import utc_literal
from stayline.sources.commits import CommitLog


def write_cleaned(df: DataFrame, path: str, with_csv: bool = False) -> str:
    """Write the cleaned table to a new path; the delimited twin is optional.

    The path must be new: overwriting a path that the same plan reads would
    destroy the input.
    """
    df.write.parquet(path)
    if with_csv:
        df.sparkSession.read.schema(df.schema).parquet(path).write.option("header", True).csv(f"{path}.csv")
    return path


def write_report(df: DataFrame, path: str) -> str:
    """Write a small long-form report as JSON lines."""
    df.write.json(path)
    return path


def append_batch(df: DataFrame, path: str, batch_id: str) -> str:
    """Append one batch to a table partitioned by ``batch_id``.

    Writing the same batch again replaces only its own partition, so a
    repeated run does not double it; an empty batch leaves none of its old rows.
    The schema must not change between batches. The finished batch is committed
    to the table's log, which names the newest one for :func:`read_latest`.
    """
    empty = df.isEmpty()
    if empty:
        _drop_partition(df.sparkSession, path, batch_id)
    (
        df.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )
    log = _batches(df.sparkSession, path)
    log.append(lambda _, last: {"batch_id": batch_id, "empty": empty, "latest": _latest(log, last, batch_id, empty)})
    return path


def _batches(spark: SparkSession, path: str) -> CommitLog:
    """The log of a table's batches; readers of the table pass over folders of such names."""
    return CommitLog(spark, f"{path}/_batches")


def _latest(log: CommitLog, last: dict | None, batch_id: str, empty: bool) -> str | None:
    """The greatest id of a batch with rows, after this batch."""
    before = last["latest"] if last else None
    if not empty:
        return max(before or batch_id, batch_id)
    if before != batch_id:
        return before
    # The newest batch lost its rows: the last word of every other batch is asked.
    entries = log.spark.read.schema("batch_id string, empty boolean").json(log.root)
    number = F.col("_metadata.file_name")
    ends = entries.where(F.col("batch_id") != batch_id).groupBy("batch_id").agg(F.max_by("empty", number).alias("empty"))
    return ends.where(~F.col("empty")).agg(F.max("batch_id")).first()[0]


def _drop_partition(spark: SparkSession, path: str, batch_id: str) -> None:
    """Delete the folder of one batch, which a dynamic overwrite by no rows would leave."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"batch_id={batch_id}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_history(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """All batches; ``batch_id`` is text and comes from the partition folders."""
    fields = [f for f in columns if f.name != "batch_id"] + [T.StructField("batch_id", T.StringType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def latest_batch(history: DataFrame) -> DataFrame:
    """Rows of the greatest batch id, as a view rather than a second copy.

    The id is a scalar subquery over the partition column, so only the newest
    partition is read for the rows, but every file is opened for its count of
    rows. :func:`read_latest` does without.
    """
    return history.where(F.col("batch_id") == history.agg(F.max("batch_id")).scalar())


def read_latest(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """Rows of the greatest committed batch id: a snapshot of the log, then that one partition.

    Batches that are still being written do not count. A table without a log,
    written by other means, is read as a whole history.
    """
    log = _batches(spark, path)
    entry = log.read(log.newest())
    if entry is None:
        return latest_batch(read_history(spark, path, columns))
    fields = [f for f in columns if f.name != "batch_id"] + [T.StructField("batch_id", T.StringType())]
    kind = T.StructType(fields)
    if entry["latest"] is None:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).option("basePath", path).parquet(f"{path}/batch_id={entry['latest']}")


def export_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


def with_comparison_lineage(comparison: DataFrame, batch_id: str, at: datetime) -> DataFrame:
    """Batch id first, report time last."""
    return comparison.select(
        F.lit(batch_id).alias("batch_id"), "*", utc_literal(at).alias("comparison_timestamp")
    )
