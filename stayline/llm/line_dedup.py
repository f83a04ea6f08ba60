"""Line deduplication by range-partitioned line hashes and per-document keep bitmaps.

A line's key is its text stripped of ASCII white space at both ends, with A-Z
lower-cased. The 128-bit hashes of the keys are range-partitioned with document
and position as secondary sort (:mod:`stayline.llm.runs`); the stream finds first
occurrences and repeated keys, and only (document, position) pairs travel back.
The result per document is a compressed bitmap, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stayline.llm.common import id_and_text, row_doc, row_tag, text_of, texts_of
from stayline.llm.runs import KEYED, KEYED_SQL, places_by_document, repeated_rows

#: ASCII white space: space and the five controls 9 to 13.
SPACE = b" \t\n\v\f\r"


def line_keys(text: bytes) -> list[bytes]:
    return [line.strip(SPACE).lower() for line in text.split(b"\n")]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, counts, places = bytearray(), [], []
        for text in texts_of(batch):
            before = len(places)
            for position, key in enumerate(line_keys(text)):
                if key:
                    hashes += xxhash.xxh3_128_digest(key)
                    places.append(position)
            counts.append(len(places) - before)
        pairs = np.frombuffer(bytes(hashes), dtype="<i8").reshape(-1, 2)
        doc, tag = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), counts) for c in ("doc", "tag"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(doc), pa.array(tag), pa.array(places, pa.int64())],
            schema=KEYED,
        )


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dropped, bitmaps = [], []
        lines = batch.column("n_lines").to_pylist()
        for n, places in zip(lines, batch.column("places").to_pylist()):
            keep = np.ones(n, dtype=bool)
            if places:
                keep[np.frombuffer(places, dtype="<i4")] = False
            dropped.append(int(n - keep.sum()))
            bitmaps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(dropped, pa.int64()), pa.array(bitmaps, pa.binary())],
            ["doc", "tag", "n_lines", "n_dropped", "keep"],
        )


def keep_bitmaps(docs: DataFrame, min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    """Which lines of each document stay: (doc, tag, n_lines, n_dropped, keep).

    A key of at least one code point that occurs in at least ``min_docs``
    documents loses its lines; with ``keep_first`` all its lines in the document
    with the smallest id stay. ``keep`` is a zlib-compressed bitmap, one bit per
    line. One row per distinct (``doc_id``, text); such a pair is one document
    however often its row is repeated. A null or empty text is one empty line,
    which is never dropped; null ids order first, among them by a hash of the text.
    An empty table gives no rows.
    """
    keyed = id_and_text(docs).mapInArrow(_hashed, KEYED_SQL)
    dropped = places_by_document(repeated_rows(keyed, "line-runs", min_docs, keep_first))
    text = text_of()
    documents = docs.select(
        row_doc().alias("doc"),
        row_tag().alias("tag"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long").alias("n_lines"),
    ).distinct()
    return (
        documents.join(dropped, ["doc", "tag"], "left")
        .select("doc", "tag", "n_lines", "places")
        .mapInArrow(_bitmaps, "doc long, tag long, n_lines long, n_dropped long, keep binary")
    )


def kept_lines(text: bytes, keep: bytes) -> bytes:
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8), count=len(lines)).tolist()
    return b"\n".join(line for line, stays in zip(lines, bits) if stays)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [
            None if text is None else kept_lines(text, keep) if dropped else text
            for text, dropped, keep in zip(
                texts_of(batch, "_text"), texts_of(batch, "_dropped"), texts_of(batch, "_keep")
            )
        ]
        at = batch.schema.get_field_index("_text")
        columns = [pa.array(kept, pa.binary()).cast(pa.string()), *batch.columns[:at], *batch.columns[at + 3 :]]
        names = ["_kept", *batch.schema.names[:at], *batch.schema.names[at + 3 :]]
        yield pa.RecordBatch.from_arrays(columns, names)


def with_kept_text(docs: DataFrame, bitmaps: DataFrame, *measures: str) -> DataFrame:
    """``docs`` with every text replaced by its lines that stay, other columns as they are.

    ``measures`` names columns of ``bitmaps`` to add. A null text stays null.
    """
    inner = [f"_c{i}" for i in range(len(docs.columns))]
    renamed = docs.select(row_doc().alias("_doc"), row_tag().alias("_tag"), *[
        F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, inner)
    ])
    by_doc = bitmaps.select(
        F.col("doc").alias("_doc"), F.col("tag").alias("_tag"), F.col("n_dropped").alias("_dropped"),
        F.col("keep").alias("_keep"), *[F.col(m).alias(f"_m_{m}") for m in measures],
    )
    text_at = docs.columns.index("text")
    others = [n for i, n in enumerate(inner) if i != text_at] + [f"_m_{m}" for m in measures]
    joined = renamed.join(by_doc, ["_doc", "_tag"]).select(
        *others, F.col(inner[text_at]).cast("binary").alias("_text"), "_dropped", "_keep"
    )
    types = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    schema = ", ".join(["_kept string", *[f"{n} {types[n]}" for n in others]])
    done = joined.mapInArrow(_applied, schema)
    back = [
        F.col("_kept" if i == text_at else n).alias(c) for i, (c, n) in enumerate(zip(docs.columns, inner))
    ]
    return done.select(*back, *[F.col(f"_m_{m}").alias(m) for m in measures])


def drop_repeated_lines(docs: DataFrame, min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    """``docs`` with repeated lines taken out of the texts; same columns, same number of rows."""
    return with_kept_text(docs, keep_bitmaps(docs, min_docs, keep_first))
