"""Session-level helpers: shared scratch space, staged tables, size-checked broadcasts."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows a lookup table may have before it is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 20_000


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, the session's warehouse folder takes its place, if
    executors reach it: a folder of one machine is refused unless the master is
    local. No machine-local temporary folder is ever used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {root} is on one machine")
    return f"{root.rstrip('/')}/stayline/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and return a scan of it.

    Used where several passes follow one expensive shuffle: the passes read
    only the columns they need, and a lost executor costs a re-read, not a
    re-run of the shuffle.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_settled = False


def settle_worker() -> None:
    """Called in tasks of passes that come by the hundred: leaves what is imported out of garbage collections.

    A Python worker collects its garbage after every task, and with the objects of all
    imported modules that costs more than a small pass itself.
    """
    global _settled
    if not _settled:
        _settled = True
        gc.collect()
        gc.freeze()


def lookup(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if it really is small, else leave the join strategy to Spark.

    At most ``max_rows + 1`` rows are fetched to measure it. A table within the
    bound is joined as a local relation, so it is not computed a second time.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(head, schema=df.schema))
