"""A positional inverted index over documents, and phrase and proximity search in it.

The index is partitioned by documents: a task turns its rows into segments of
about a million words and writes one row per segment and word with the places of
the word, as variable-length differences, and one directory row per segment.
Nothing is shuffled, and no row grows with the corpus, however common its word.

A search asks for phrases (runs of words). Words are ordered by their frequency
in the whole corpus. In each segment the places of a phrase's rarest word, moved
back by its offset, are the candidates; the list of the next word, moved likewise,
cuts them down, and so on. With ``slop`` > 0 each word may stand up to that many
places off. All phrases of a segment are searched at once, list by list.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from stayline.llm.common import text_of, texts_of
from stayline.session import staged

#: Words after which a segment is closed; a longer document is a segment of its own.
SEGMENT_WORDS = 1 << 20
#: Bytes of phrases that a search holds in the driver and its tasks at a time.
TURN_BYTES = 8 << 20
#: Candidates that are intersected at a time.
CANDIDATES = 1 << 20

#: A-Z as a-z, digits, letters and all bytes from 0x80 as they are, anything else a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, letters a-z (A-Z lower-cased) and code points from U+0080."""
    return text.translate(_WORD_BYTES).split()


def encode_gaps(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative numbers as base-128 bytes, low digits first, the last byte below 128: (bytes, bytes per number)."""
    widths = np.ones(len(gaps), dtype=np.int64)
    for digits in range(1, 9):
        widths += gaps >= (1 << (7 * digits))
    ends = np.cumsum(widths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    left, at, open_ = gaps, ends - widths, np.arange(len(gaps))
    while len(open_):
        more = left >= 128
        out[at] = (left & 127) | (more.astype(np.uint8) << 7)
        left, at, open_ = left[more] >> 7, at[more] + 1, open_[more]
    return out, widths


def decode_gaps(data: np.ndarray) -> np.ndarray:
    """The numbers behind :func:`encode_gaps`."""
    if not len(data):
        return np.empty(0, dtype=np.int64)
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(starts) == len(data):
        return data.astype(np.int64)
    digit = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * digit), starts)


def _restart(values: np.ndarray, starts: np.ndarray, back: bool) -> np.ndarray:
    """Differences within lists that begin at ``starts`` (the first value stays), or running sums of such."""
    if back:
        sums = np.cumsum(values)
        return sums - np.repeat(sums[starts] - values[starts], np.diff(np.append(starts, len(values))))
    gaps = np.diff(values, prepend=0)
    gaps[starts] = values[starts]
    return gaps


_INDEX = pa.schema([("segment", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("places", pa.binary())])
INDEX_SQL = "segment long, word binary, n long, places binary"


class _Segment:
    """Documents on their way into one segment; positions run on through all of them."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.parts: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.ids: list[int | None] = []
        self.size = 0

    def add(self, doc: int | None, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int32, count=len(words)))
        self.lengths.append(len(words))
        self.ids.append(doc)
        self.size += len(words)

    def rows(self, segment: int) -> pa.RecordBatch:
        numbers = np.concatenate(self.parts)
        order = np.argsort(numbers, kind="stable")
        counts = np.bincount(numbers, minlength=len(self.numbers)) if len(numbers) else np.empty(0, dtype=np.int64)
        starts = np.cumsum(counts) - counts
        data, widths = encode_gaps(_restart(order, starts, back=False)) if len(order) else (np.empty(0, np.uint8), order)
        ends = np.cumsum(np.add.reduceat(widths, starts)) if len(starts) else np.empty(0, dtype=np.int64)
        directory = pa.RecordBatch.from_arrays(
            [pa.array(self.ids, pa.int64()), pa.array(self.lengths, pa.int64())], ["doc_id", "n_words"]
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, directory.schema) as stream:
            stream.write_batch(directory)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        lists = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(starts) + 1, segment)),
                pa.array([None, *self.numbers], pa.binary()),
                pa.array(np.concatenate([[len(self.ids)], counts]).astype(np.int64)),
                pa.concat_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()), lists]),
            ],
            schema=_INDEX,
        )


def _indexing(segment_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        segments = count(first)
        now = _Segment()
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for doc, text in zip(docs, texts_of(batch)):
                now.add(doc, words_of(text))
                if now.size >= segment_words:
                    yield now.rows(next(segments))
                    now = _Segment()
        if now.ids:
            yield now.rows(next(segments))

    return run


def positional_index(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written to shared storage: (segment, word, n, places).

    The row of a segment whose ``word`` is null is its directory: ids (null ones
    too) and word counts of its documents, in order. Null and empty texts are
    documents without words. Every row is a document, repeated or not; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    return staged(rows.mapInArrow(_indexing(segment_words), INDEX_SQL), "positions")


def _directory(places: bytes) -> tuple[list[int | None], np.ndarray]:
    table = pa.ipc.open_stream(places).read_all()
    return table.column("doc_id").to_pylist(), table.column("n_words").to_numpy()


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for segment, places in zip(batch.column("segment").to_pylist(), batch.column("places").to_pylist()):
            ids, lengths = _directory(places)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), segment)), pa.array(np.arange(len(ids), dtype=np.int32)),
                 pa.array(ids, pa.int64()), pa.array(lengths)],
                ["segment", "row", "doc_id", "n_words"],
            )


def indexed_documents(index: DataFrame) -> DataFrame:
    """(segment, row, doc_id, n_words) of every document in the index; (segment, row) names a document."""
    return index.where(F.col("word").isNull()).mapInArrow(_listed, "segment long, row int, doc_id long, n_words long")


def word_counts(index: DataFrame, words: DataFrame) -> DataFrame:
    """(word, n): how often each of ``words`` (word: binary, distinct) occurs in the corpus; absent ones do not appear."""
    held = index.where(F.col("word").isNotNull()).select("word", "n").join(words, "word", "left_semi")
    return held.groupBy("word").agg(F.sum("n").alias("n"))


class Phrases:
    """Distinct phrases, each with its words as numbers and the order in which to intersect them."""

    def __init__(self, phrases: list[tuple[bytes, ...]], counts: dict[bytes, int]):
        #: Phrases with a word that no document has cannot occur exactly; nor nearby, as all words must be there.
        self.kept = [i for i, p in enumerate(phrases) if all(w in counts for w in p)]
        self.words = sorted({w for i in self.kept for w in phrases[i]})
        number = {w: i for i, w in enumerate(self.words)}
        self.lengths = np.array([len(phrases[i]) for i in self.kept], dtype=np.int64)
        width = int(self.lengths.max(initial=0))
        #: Per phrase and step: word and offset of its next rarest word; -1 beyond its end.
        self.step_words = np.full((len(self.kept), width), -1, dtype=np.int64)
        self.step_offsets = np.zeros((len(self.kept), width), dtype=np.int64)
        for at, i in enumerate(self.kept):
            order = sorted(range(len(phrases[i])), key=lambda o: (counts[phrases[i][o]], o))
            self.step_words[at, : len(order)] = [number[phrases[i][o]] for o in order]
            self.step_offsets[at, : len(order)] = order


class Lists:
    """Position lists of one segment, one after another, keyed by word number and place."""

    def __init__(self, lengths: np.ndarray, words: np.ndarray, data: list[bytes], counts: np.ndarray, n_words: int):
        self.doc_starts = np.cumsum(lengths) - lengths
        self.doc_ends = np.cumsum(lengths)
        order = np.argsort(words)
        counts = counts[order]
        self.first, self.last = np.zeros(n_words, dtype=np.int64), np.zeros(n_words, dtype=np.int64)
        ends = np.cumsum(counts)
        self.first[words[order]], self.last[words[order]] = ends - counts, ends
        gaps = decode_gaps(np.frombuffer(b"".join(data[i] for i in order), dtype=np.uint8))
        self.places = _restart(gaps, ends - counts, back=True) if len(gaps) else gaps
        #: Lists are sorted and follow each other by word number, so these keys are sorted too.
        self.keys = (np.repeat(words[order], counts) << 32) | self.places

    def has(self, words: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the list of each word holds a place in [low, high]."""
        at = np.searchsorted(self.keys, (words << 32) | low)
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return (at < len(self.keys)) & (found >= ((words << 32) | low)) & (found <= ((words << 32) | high))


def search_segment(phrases: Phrases, lists: Lists, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """All (phrase, start place) in a segment, phrases as places in ``phrases.kept``."""
    if not len(lists.keys) or not len(phrases.lengths):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    rarest = phrases.step_words[:, 0]
    sizes = (lists.last - lists.first)[rarest] * (2 * slop + 1)
    sizes[((lists.last - lists.first)[np.maximum(phrases.step_words, 0)] * (phrases.step_words >= 0)
           + (phrases.step_words < 0)).min(axis=1) == 0] = 0  # a word is not in this segment
    open_ = np.flatnonzero(sizes)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rounds = np.cumsum(sizes[open_]) // CANDIDATES
    for turn in np.unique(rounds):
        found.append(_intersect(phrases, lists, open_[rounds == turn], slop))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(column) for column in zip(*found))


def _intersect(phrases: Phrases, lists: Lists, chosen: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    rarest = phrases.step_words[chosen, 0]
    counts = lists.last[rarest] - lists.first[rarest]
    phrase = np.repeat(chosen, counts)
    within = np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = lists.places[np.repeat(lists.first[rarest], counts) + within] - phrases.step_offsets[phrase, 0]
    if slop:
        moved = np.arange(-slop, slop + 1)
        phrase, start = np.repeat(phrase, len(moved)), (start[:, None] + moved).reshape(-1)
        pairs = np.unique(np.stack([phrase, start]), axis=1)
        phrase, start = pairs[0], pairs[1]
    fits = start >= 0
    phrase, start = phrase[fits], start[fits]
    doc = np.searchsorted(lists.doc_ends, start, side="right")
    fits = doc < len(lists.doc_ends)
    phrase, start, doc = phrase[fits], start[fits], doc[fits]
    fits = start + phrases.lengths[phrase] <= lists.doc_ends[doc]
    phrase, start, doc = phrase[fits], start[fits], doc[fits]
    for step in range(0 if slop else 1, phrases.step_words.shape[1]):
        if not len(phrase):
            break
        words = phrases.step_words[phrase, step]
        place = start + phrases.step_offsets[phrase, step]
        low = np.maximum(place - slop, lists.doc_starts[doc])
        high = np.minimum(place + slop, lists.doc_ends[doc] - 1)
        stays = (words < 0) | lists.has(np.maximum(words, 0), low, high)
        phrase, start, doc = phrase[stays], start[stays], doc[stays]
    return phrase, start


def _runs(group: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching [start, stop) of one group merged."""
    order = np.lexsort((start, group))
    group, start, stop = group[order], start[order], stop[order]
    # Groups are kept apart by a shift larger than any place.
    shift = group * (int(stop.max(initial=0)) + 2)
    reach = np.maximum.accumulate(stop + shift)
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] + shift[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return group[first], start[first], np.maximum.reduceat(stop, first) if len(first) else stop


def _searching(phrases: Phrases, item_of: tuple[np.ndarray, np.ndarray], slop: int):
    """``item_of``: per kept phrase where its items begin, and the items, one after another."""
    numbers = {w: i for i, w in enumerate(phrases.words)}
    begins, items = item_of

    def matches(segment: int, directory: bytes, words: list, data: list, counts: list) -> pa.RecordBatch:
        _, lengths = _directory(directory)
        own = np.array([numbers[w] for w in words], dtype=np.int64)
        lists = Lists(lengths, own, data, np.array(counts, dtype=np.int64), len(numbers))
        phrase, start = search_segment(phrases, lists, slop)
        doc = np.searchsorted(lists.doc_ends, start, side="right")
        many = begins[phrase + 1] - begins[phrase]
        within = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        item = items[np.repeat(begins[phrase], many) + within]
        doc, start = np.repeat(doc, many), np.repeat(start, many)
        stop = start + np.repeat(phrases.lengths[phrase], many)
        low, high = start - lists.doc_starts[doc], stop - lists.doc_starts[doc]
        width = int(items.max(initial=0)) + 1
        group, low, high = _runs(doc * width + item, low, high)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(group), segment)), pa.array((group // width).astype(np.int32)),
             pa.array(group % width), pa.array(low), pa.array(high)],
            ["segment", "row", "item", "start", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = directory = None
        words, data, counts = [], [], []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for owner, word, n, places in zip(*columns):
                if word is None:  # first of its segment
                    if words:
                        yield matches(segment, directory, words, data, counts)
                    segment, directory, words, data, counts = owner, places, [], [], []
                else:
                    words.append(word)
                    data.append(places)
                    counts.append(n)
        if words:
            yield matches(segment, directory, words, data, counts)

    return run


def phrase_matches(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """Where phrases occur: (segment, row, item, start, stop), written to shared storage.

    ``phrases`` is a table (item long from 0, words array<binary>, not empty). An
    item may have many phrases. A phrase occurs at a place of a document if all its
    words follow from there; with ``slop``, if for every word of it some equal word
    of the document stands at most ``slop`` places from where it would, and the
    whole stretch lies in the document. ``start`` and ``stop`` are word positions
    of maximal stretches that occurrences of the item's phrases cover or touch.

    Phrases are taken in turns of whole items, about :data:`TURN_BYTES` each; each
    turn reads the lists of its own words only and is written before the next.
    """
    spark = index.sparkSession
    phrases = staged(phrases.select("item", "words"), "phrases")
    counted = staged(
        word_counts(index, phrases.select(F.explode("words").alias("word")).distinct()), "phrase-words"
    )
    size = phrases.agg(F.coalesce(F.sum(F.size("words") * 24 + 32), F.lit(0)).alias("b")).first()["b"]
    turns = max(1, -(-int(size) // TURN_BYTES))
    found = None
    for turn in range(turns):
        mine = phrases.where(F.pmod(F.xxhash64("item"), F.lit(turns)) == turn)
        words = mine.select(F.explode("words").alias("word")).distinct()
        counts = {r["word"]: r["n"] for r in counted.join(words, "word", "left_semi").toLocalIterator()}
        rows = mine.toArrow().to_pydict()
        owners: defaultdict[tuple, set] = defaultdict(set)
        for item, phrase in zip(rows["item"], rows["words"]):
            owners[tuple(phrase)].add(item)
        distinct = sorted(owners)
        table = Phrases(distinct, {bytes(w): n for w, n in counts.items()})
        kept = [sorted(owners[distinct[i]]) for i in table.kept]
        begins = np.cumsum([0, *map(len, kept)])
        items = np.array([i for group in kept for i in group], dtype=np.int64)
        asked = spark.createDataFrame(pa.table({"word": pa.array(table.words, pa.binary())}))
        needed = (
            index.where(F.col("word").isNotNull())
            .join(F.broadcast(asked), "word", "left_semi")
            .unionByName(index.where(F.col("word").isNull()))
            .repartition("segment")
            .sortWithinPartitions("segment", F.col("word").asc_nulls_first())
            .select("segment", "word", "n", "places")
        )
        part = staged(
            needed.mapInArrow(
                _searching(table, (begins, items), slop), "segment long, row int, item long, start long, stop long"
            ),
            "matches",
        )
        found = part if found is None else found.unionByName(part)
    return found
