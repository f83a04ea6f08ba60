"""What the training-data operators share: columns, text batches, sized broadcasts.

Row identity. ``doc_id`` may be null or repeat, so a row is told apart by the
pair (``row_doc``, ``row_tag``): the id and 64 bits of a hash of its text. In
place of a null id stand 62 bits of another hash, below all ids from -2^62 on, so
126 bits tell rows without an id apart. Rows that agree in id and text get the same results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Stands for a null id inside keys.
NO_ID = -(2**63)
#: Upper bound of what is broadcast after its size was measured.
BROADCAST_BYTES = 16 << 20


def text_of(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def row_doc() -> Column:
    """The id; for null a number of the text in [-2^63, -2^62)."""
    unnamed = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(text_of().cast("binary")), 2)
    return F.coalesce(F.col("doc_id").cast("long"), unnamed)


def row_tag() -> Column:
    return F.xxhash64(F.lit(1), text_of().cast("binary"))


def id_and_text(docs: DataFrame) -> DataFrame:
    """What the Python stages read: ``doc_id`` (long, nullable), ``doc``, ``tag``, ``text`` (UTF-8 bytes)."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_doc().alias("doc"), row_tag().alias("tag"),
        text_of().cast("binary").alias("text"),
    )


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator:
    """The values of a text column, turned into Python objects a few at a time."""
    values = batch.column(column)
    for at in range(0, len(values), 256):
        yield from values.slice(at, 256).to_pylist()


def sized_broadcast(df: DataFrame, width: Column, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if its measured size is within ``max_bytes``.

    ``width`` is the size of a row in bytes. ``df`` should be a staged table, as
    it is read for the measurement; beyond the bound the join shuffles.
    """
    total = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(df) if total <= max_bytes else df
