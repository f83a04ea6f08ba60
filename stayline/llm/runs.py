"""Streaming over runs of equal keys in range-partitioned, sorted rows.

A key that a third of all rows share would fill one task of a hash shuffle. Here
rows are range-partitioned by (key, document, tag), so such a key spreads over many
neighbouring partitions; each partition streams its sorted rows once. Only the
first and the last run of a partition can continue elsewhere: their rows wait,
and a summary of at most two rows per partition, added up by key, decides them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayline.session import staged

#: Columns of the input: a 128-bit key, the document and its tag, and a position
#: inside it. A document is a distinct (doc, tag).
KEYED = pa.schema([(c, pa.int64()) for c in ("k1", "k2", "doc", "tag", "at")])
KEYED_SQL = "k1 long, k2 long, doc long, tag long, at long"

_FINAL, _WAITS, _SUMMARY = 0, 1, 2
_OUT = pa.schema(
    [
        ("kind", pa.int8()), ("k1", pa.int64()), ("k2", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()),
        ("at", pa.int64()), ("first_doc", pa.int64()), ("n_docs", pa.int64()),
    ]
)
_OUT_SQL = f"kind byte, {KEYED_SQL}, first_doc long, n_docs long"


def _rows(kind: int, key, doc, tag, at, first, n_docs, with_first: bool) -> pa.RecordBatch:
    n = len(doc)
    none = pa.nulls(n, pa.int64())
    of = lambda v: pa.array(np.broadcast_to(np.asarray(v, dtype=np.int64), n))
    keep = with_first or kind != _FINAL
    columns = [
        pa.array(np.full(n, kind, dtype=np.int8)),
        of(key[0]) if keep else none, of(key[1]) if keep else none,
        *[none if kind == _SUMMARY else of(column) for column in (doc, tag, at)],
        of(first) if with_first or kind == _SUMMARY else none, of(n_docs) if kind == _SUMMARY else none,
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_OUT)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """True where any column differs from the row before; the first row counts."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new) > 1:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _stream(min_docs: int, keep_first: bool, with_first: bool):
    def chosen(first, doc, n_docs):
        return (n_docs >= min_docs) & ((doc != first) if keep_first else True)

    def edge(k1, k2, doc, tag, at):
        """A run at an end of the partition.

        What is out already stays out, whatever the neighbours hold: all rows if
        enough documents are here, but for those of the first document where the
        first is kept. The others, of fewer than ``min_docs`` documents, wait.
        """
        first, n_docs = doc[0], int(_starts(doc, tag).sum())
        out = np.full(len(doc), n_docs >= min_docs)
        if keep_first or with_first:
            out &= doc != first
        if out.any():
            yield _rows(_FINAL, (k1[out], k2[out]), doc[out], tag[out], at[out], first, 0, with_first)
        yield _rows(_WAITS, (k1[0], k2[0]), doc[~out], tag[~out], at[~out], first, 0, with_first)
        yield _rows(_SUMMARY, (k1[0], k2[0]), doc[:1], tag[:1], at[:1], first, n_docs, with_first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # rows of the run that has not ended
        parts: list[list[np.ndarray]] = []
        first_run = True
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            starts = np.flatnonzero(_starts(now[0], now[1]))
            if parts and now[0][0] == parts[-1][0][-1] and now[1][0] == parts[-1][1][-1] and len(starts) == 1:
                parts.append(now)
                continue
            parts.append(now)
            held = [np.concatenate([p[i] for p in parts]) for i in range(5)] if len(parts) > 1 else now
            starts = np.flatnonzero(_starts(held[0], held[1]))
            last = starts[-1]
            parts = [[c[last:] for c in held]]
            if last == 0:
                continue
            done = [c[:last] for c in held]
            starts = starts[:-1]
            if first_run:
                cut = starts[1] if len(starts) > 1 else last
                yield from edge(*[c[:cut] for c in done])
                done, starts, first_run = [c[cut:] for c in done], starts[1:] - cut, False
                if not len(done[0]):
                    continue
            k1, k2, doc, tag, at = done
            which = np.cumsum(_starts(k1, k2)) - 1
            n_docs = np.add.reduceat(_starts(k1, k2, doc, tag).astype(np.int64), starts)[which]
            first = doc[starts][which]
            out = np.flatnonzero(chosen(first, doc, n_docs))
            if len(out):
                yield _rows(_FINAL, (k1[out], k2[out]), doc[out], tag[out], at[out], first[out], 0, with_first)
        if parts:
            yield from edge(*[np.concatenate([p[i] for p in parts]) for i in range(5)])

    return run


def repeated_rows(
    keyed: DataFrame, label: str, min_docs: int = 2, keep_first: bool = False, with_first: bool = False
) -> DataFrame:
    """Rows of ``keyed`` (:data:`KEYED`, no nulls) whose key occurs in at least ``min_docs`` documents.

    With ``keep_first`` the rows of the key's smallest ``doc`` are left out. The
    result is (doc, tag, at), with ``with_first`` also k1, k2 and ``first_doc``, a
    smallest document of the key: where a run spans partitions, that of the rows
    of one partition, which in turn is paired with the smallest of all. It is
    written once to shared storage. No rows in, no rows out; repeated rows come back repeated.
    """
    marked = (
        keyed.select(*KEYED.names)
        .repartitionByRange("k1", "k2", "doc", "tag")
        .sortWithinPartitions(*KEYED.names)
        .mapInArrow(_stream(min_docs, keep_first, with_first), _OUT_SQL)
    )
    table = staged(marked, label)
    totals = (  # at most two rows per partition
        table.where(F.col("kind") == _SUMMARY)
        .groupBy("k1", "k2")
        .agg(F.sum("n_docs").alias("n_docs"), F.min("first_doc").alias("first_doc"))
        .where(F.col("n_docs") >= min_docs)
    )
    waiting = table.where(F.col("kind") == _WAITS).select(*KEYED.names)
    late = waiting.join(F.broadcast(totals), ["k1", "k2"])
    if keep_first:
        late = late.where(F.col("doc") != F.col("first_doc"))
    columns = ["doc", "tag", "at", *(["k1", "k2", "first_doc"] if with_first else [])]
    return table.where(F.col("kind") == _FINAL).select(*columns).unionByName(late.select(*columns))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (doc, tag, at) rows to one row per document with its positions as little-endian int32."""
    doc = tag = None
    places: list[np.ndarray] = []

    def row():
        return (int(doc), int(tag), np.concatenate(places).astype("<i4").tobytes())

    out: list[tuple] = []
    for batch in batches:
        docs, tags, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(docs):
            continue
        starts = np.flatnonzero(_starts(docs, tags))
        for a, b in zip(starts, np.append(starts[1:], len(docs))):
            if (docs[a], tags[a]) != (doc, tag):
                if places:
                    out.append(row())
                doc, tag, places = docs[a], tags[a], []
            places.append(at[a:b])
        if len(out) >= 2_000:
            yield _found(out)
            out = []
    if places:
        out.append(row())
    if out:
        yield _found(out)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    doc, tag, places = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(tag, pa.int64()), pa.array(places, pa.binary())], ["doc", "tag", "places"]
    )


def places_by_document(rows: DataFrame) -> DataFrame:
    """(doc, tag, at) rows as one row (doc, tag, places) per document; a group is no larger than its document."""
    return (
        rows.select("doc", "tag", "at")
        .repartition("doc", "tag")
        .sortWithinPartitions("doc", "tag", "at")
        .mapInArrow(_gather, "doc long, tag long, places binary")
    )
