"""Substring deduplication: a count-min prefilter, then exact grouping of what it leaves.

Pass one counts all windows of consecutive words in a count-min sketch, merged
from the partitions' sketches block by block. A cell never underestimates, so a
window that repeats is always estimated repeated. Pass two gives only those
windows to the exact grouping by 128-bit key (:mod:`stayline.llm.runs`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from stayline.llm.common import id_and_text, row_doc, row_tag, text_of, texts_of
from stayline.llm.runs import KEYED, KEYED_SQL, places_by_document, repeated_rows
from stayline.session import staged

#: Words of a window.
WINDOW = 50
#: Rows of the sketch; bits of cells per row: least, and most (2^28 cells: 32 MB per row, which bounds the broadcast).
DEPTH, MIN_BITS, MAX_BITS = 2, 16, 28
#: Cells of a block, the unit in which sketches are shuffled and merged.
BLOCK_BITS = 20
#: Windows collected before a partition hands on what it has counted.
FLUSH = 1 << 21

# Odd multipliers of the two polynomial hashes, and of a 64-bit finaliser.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hash of a word, remembered; forgets all when it holds too many."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


class Windows:
    """Two independent 64-bit rolling hashes of every window of a word list."""

    def __init__(self, words: int):
        self.words, self.hashes = words, WordHashes()
        self.powers: list[tuple[np.ndarray, np.ndarray]] = []
        self._grow(4096)

    def _grow(self, n: int) -> None:
        self.powers = []
        for base in _BASES:
            inverse = pow(base, -1, 1 << 64)
            up, down = (np.cumprod(np.full(n, b, dtype=np.uint64)) for b in (base, inverse))
            self.powers.append((up, down))

    def keys(self, text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        words = text.split()
        n = len(words)
        if n < self.words:
            return None
        if n > len(self.powers[0][0]):
            self._grow(2 * n)
        h = np.fromiter(map(self.hashes.__getitem__, words), dtype=np.uint64, count=n)
        keys = []
        for up, down in self.powers:
            prefix = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(h * up[:n], out=prefix[1:])
            keys.append(_mixed((prefix[self.words :] - prefix[: n + 1 - self.words]) * down[: n + 1 - self.words]))
            h = _mixed(h)
        return keys[0], keys[1]


def _packed(cells: np.ndarray) -> bytes:
    """Sorted cell numbers as compressed differences."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(cells, prepend=np.uint32(0)).astype("<u4").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype="<u4"), dtype=np.uint32)


_PARTS = pa.schema([("block", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])


def _partial_sketches(window: int, bits: int):
    """Per partition and block: the cells it hit once, and more often."""
    block_bits = min(BLOCK_BITS, bits)
    blocks = 1 << (bits - block_bits)

    def parts(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for row in range(DEPTH):
            cells = np.concatenate([k[row] for k in held]) >> np.uint64(64 - bits)
            cells, counts = np.unique(cells.astype(np.uint32), return_counts=True)
            edges = np.searchsorted(cells, np.arange(blocks + 1, dtype=np.uint64) << np.uint64(block_bits))
            for block in range(blocks):
                a, b = edges[block], edges[block + 1]
                if a == b:
                    continue
                local = cells[a:b] & np.uint32((1 << block_bits) - 1)
                twice = counts[a:b] > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row * blocks + block], pa.int32()), pa.array([_packed(local[~twice])]),
                     pa.array([_packed(local[twice])])],
                    schema=_PARTS,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, held, n = Windows(window), [], 0
        for batch in batches:
            for named, text in zip(batch.column("doc_id").is_valid().to_pylist(), texts_of(batch)):
                if named and (keys := windows.keys(text)):
                    held.append(keys)
                    n += len(keys[0])
                    if n >= FLUSH:
                        yield from parts(held)
                        held, n = [], 0
        if held:
            yield from parts(held)

    return run


def _merged(bits: int):
    """Sorted partial sketches to one bitmap per block: cells counted at least twice."""
    cells = 1 << min(BLOCK_BITS, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts = None, np.zeros(cells, dtype=np.uint8)

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())],
                ["block", "bits"],
            )

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(3))
            for now, once, more in zip(*columns):
                if now != block:
                    if block is not None:
                        yield done()
                    block = now
                    counts[:] = 0
                at = _unpacked(once)  # a part names a cell once, so counting is plain indexing
                counts[at] = np.minimum(counts[at] + 1, 2)
                counts[_unpacked(more)] = 2
        if block is not None:
            yield done()

    return run


def repeated_cells(docs: DataFrame, window: int, bits: int) -> np.ndarray:
    """The merged sketch as one bitmap, rows one after another: ``DEPTH`` x 2^bits bits, at most 64 MB."""
    merged = (
        docs.mapInArrow(_partial_sketches(window, bits), "block int, once binary, more binary")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_merged(bits), "block int, bits binary")
    )
    size = (1 << min(BLOCK_BITS, bits)) // 8
    table = np.zeros(DEPTH * (1 << bits) // 8, dtype=np.uint8)
    for row in staged(merged, "sketch").toLocalIterator():
        table[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["bits"], dtype=np.uint8)
    return table


def _candidates(window: int, bits: int, sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, table = Windows(window), np.frombuffer(sketch.value, dtype=np.uint8)
        for batch in batches:
            found: list[list[np.ndarray]] = [[], [], [], [], []]
            named = batch.column("doc_id").is_valid().to_pylist()
            docs, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag"))
            for known, doc, tag, text in zip(named, docs, tags, texts_of(batch)):
                if not known or not (keys := windows.keys(text)):
                    continue
                at = np.arange(len(keys[0]))
                for row in range(DEPTH):
                    cells = (keys[row][at] >> np.uint64(64 - bits)) + np.uint64(row << bits)
                    at = at[(table[cells >> np.uint64(3)] >> (7 - (cells & np.uint64(7))).astype(np.uint8)) & 1 == 1]
                if len(at):
                    columns = (keys[0][at].view(np.int64), keys[1][at].view(np.int64), np.full(len(at), doc),
                               np.full(len(at), tag), at)
                    for column, values in zip(found, columns):
                        column.append(values)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], schema=KEYED)

    return run


def sketch_bits(windows: int) -> int:
    """Bits of cells per row: at least 1.5 cells per window, within the bounds.

    Beyond the upper bound the sketch lets more windows through; none is lost.
    """
    return min(MAX_BITS, max(MIN_BITS, (3 * max(windows, 1) // 2).bit_length()))


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Starts of windows that also start in a document with a smaller id: (doc, tag, places).

    ``places`` are word positions as little-endian int32. Words are what ASCII
    white space separates, unchanged. Null ids neither repeat nor are repeated;
    rows with one id are not earlier than each other. Texts shorter than a window
    have none.
    """
    texts = id_and_text(docs)
    letters = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    bits = sketch_bits(letters // 6)
    sketch = docs.sparkSession.sparkContext.broadcast(repeated_cells(texts, window, bits).tobytes())
    keyed = texts.mapInArrow(_candidates(window, bits, sketch), KEYED_SQL)
    return places_by_document(repeated_rows(keyed, "window-runs", min_docs=2, keep_first=True))


def covered(n_words: int, places: np.ndarray, window: int) -> np.ndarray:
    """Which words a window that starts at one of ``places`` covers."""
    change = np.zeros(n_words + 1, dtype=np.int32)
    np.add.at(change, places, 1)
    np.add.at(change, places + window, -1)
    return np.cumsum(change[:-1]) > 0


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, places in zip(texts_of(batch), texts_of(batch, "places")):
                words = text.split()
                n_words.append(len(words))
                if places:
                    gone = covered(len(words), np.frombuffer(places, dtype="<i4"), window)
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def without_repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (UTF-8 bytes: the words that stay, joined by one space).

    A word goes if a window that covers it also starts in a document with a
    smaller id; all windows are judged on the input. Null and empty texts have no
    words. Repeated rows are treated alike. Only ``doc_id`` and ``text`` are read.
    """
    removed = repeated_windows(docs, window)
    rows = docs.select(
        row_doc().alias("doc"), row_tag().alias("tag"), F.col("doc_id").cast("long").alias("doc_id"),
        text_of().cast("binary").alias("text"),
    )
    return (
        rows.join(removed, ["doc", "tag"], "left")
        .select("doc_id", "text", "places")
        .mapInArrow(_kept(window), "doc_id long, n_words long, n_removed long, kept binary")
    )
