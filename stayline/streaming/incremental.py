"""Score only the batch files that have not been scored yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from stayline.sources.writers import append_batch


def score_new_files(
    spark: SparkSession,
    inbox: str,
    columns: T.StructType,
    score: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    files_per_batch: int = 1_000,
) -> None:
    """Score the files that arrived in ``inbox`` since the last call, then stop.

    The stream's checkpoint remembers which files were taken. Each micro-batch
    replaces its own ``batch_id`` partition, so a batch repeated after a failure
    is not appended twice. All folders must be on shared storage, and a lost
    checkpoint needs a new ``output``, because its files are then scored anew.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        append_batch(score(batch), output, f"stream-{epoch:010d}")

    arriving = (
        spark.readStream.schema(columns).option("maxFilesPerTrigger", files_per_batch).parquet(inbox)
    )
    running = (
        arriving.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
