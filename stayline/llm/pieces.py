"""SentencePiece encoding and decoding by weighted finite-state transduction.

Three machines are compiled from a model file: the normaliser (dummy prefix,
space to U+2581), the pieces with byte fallback, and, for byte-pair models, an
adjacency acceptor. Their composition with a text is a lattice; the encoding is
its shortest path in the tropical semiring (costs add along a path, the least
wins).

Unigram models weigh a piece by its negative score. In byte-pair models pieces
weigh nothing, and the acceptor gives a pair of neighbours the weight 0 if the
merges of the two together would leave them as they are, else infinity: a piece
sequence is the encoding exactly if all its neighbours pass. So one path of
finite weight is left, and one state per position is enough for either kind.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stayline.llm.common import text_of, texts_of

#: Default model file; any SentencePiece unigram or BPE model without a character map will do.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: U+2581, which stands for a space.
MARK = "▁"
# Numbers of the model file's format.
_UNIGRAM, _BPE = 1, 2
_NEVER = float("inf")
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer message: integers, 4-byte and 8-byte values, byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class Memory:
    """A bounded memory of two generations: what is not met for one of them is forgotten."""

    def __init__(self, limit: int):
        self.limit, self.recent, self.older = limit, {}, {}

    def again(self, key):
        """A value of the older generation, made recent; None if unknown."""
        value = self.older.get(key)
        return value if value is None else self.put(key, value)

    def put(self, key, value):
        if len(self.recent) >= self.limit:
            self.older, self.recent = self.recent, {}
        self.recent[key] = value
        return value


class Transducer:
    """The compiled machines of one model."""

    #: Words remembered per generation, and pairs whose adjacency is.
    REMEMBERED = 250_000

    def __init__(self, model: bytes):
        self.names: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        self.kind, self.prefix, self.squeeze, charsmap = _UNIGRAM, True, True, b""
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.names.append(piece[1].decode("utf-8"))
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, _NORMAL))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, _UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                self.prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
                charsmap = spec.get(2, b"")
        if charsmap or self.kind not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models without a character map can be compiled")
        self.arcs = {n: i for i, (n, t) in enumerate(zip(self.names, self.types)) if t in (_NORMAL, _USER)}
        self.bytes = {int(n[1:-1], 16): i for i, (n, t) in enumerate(zip(self.names, self.types)) if t == _BYTE}
        self.unknown = self.types.index(_UNKNOWN)
        self.lowest = min((self.scores[i] for i in self.arcs.values()), default=0.0)
        self._words = Memory(self.REMEMBERED)
        self._pairs: dict[int, bool] = {}
        self._spines: dict[int, tuple[list, list] | None] = {}

    @cached_property
    def trie(self) -> list:
        """The piece machine read backwards: a state is [number of the piece that starts here or None, states by character]."""
        root: list = [None, {}]
        for name, piece in self.arcs.items():
            state = root
            for character in reversed(name):
                state = state[1].setdefault(character, [None, {}])
            state[0] = piece
        return root

    @cached_property
    def chunks(self) -> re.Pattern:
        """Cuts a normalised text where no piece reaches across: before marks, and around white space in no piece."""
        if any(MARK in name.lstrip(MARK) for name in self.arcs):
            return re.compile("(?s).+")
        known = set().union(*self.arcs) if self.arcs else set()
        alone = "".join(c for c in "\t\n\r\v\f" if c not in known)
        return re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else ""))

    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = " ".join(w for w in text.split(" ") if w)
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)

    def merged(self, text: str) -> list[tuple[str, ...]]:
        """The byte-pair merges of a short text, state after state: the best-scoring neighbours first, leftmost on ties."""
        parts = list(text)
        states = [tuple(parts)]
        while len(parts) > 1:
            joined = [(self.arcs.get(a + b), at) for at, (a, b) in enumerate(zip(parts, parts[1:]))]
            ranked = [(-self.scores[piece], at) for piece, at in joined if piece is not None]
            if not ranked:
                break
            at = min(ranked)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            states.append(tuple(parts))
        return states

    def spines(self, piece: int) -> tuple[list, list] | None:
        """What stands at the left and at the right end of a piece while it is merged together.

        Each is a list of (text, rank at which it is absorbed into the next), from a
        character to the piece itself. None if merging never gives the piece;
        empty lists if a part ranks behind the whole, so that ranks don't tell time.
        """
        known = self._spines.get(piece, False)
        if known is not False:
            return known
        name = self.names[piece]
        states = self.merged(name)
        found: tuple[list, list] | None
        if len(states[-1]) > 1:
            found = None
        elif len(states) == 1:
            found = ([(name, _NEVER)], [(name, _NEVER)])
        else:
            left, right = states[-2]
            rank = -self.scores[piece]
            sides = []
            for side, part in ((0, left), (1, right)):
                below = self.spines(self.arcs[part]) if part in self.arcs else ([(part, _NEVER)],) * 2
                late = len(part) > 1 and -self.scores[self.arcs[part]] >= rank
                ok = below and below[side] and not late
                sides.append([*below[side][:-1], (part, rank), (name, _NEVER)] if ok else [])
            found = (sides[0], sides[1]) if all(sides) else ([], [])
        self._spines[piece] = found
        return found

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether two canonical pieces are left as they are when merged side by side.

        Only what meets at the border can differ from the merges of each alone: at
        any time one end of either spine. They join there if their rank comes
        before either is absorbed; on equal ranks the merge further left goes first.
        """
        a, b = self.spines(left), self.spines(right)
        if a is None or b is None:
            return False
        x, y = a[1], b[0]
        if not x or not y:
            pair = (self.names[left], self.names[right])
            return self.merged("".join(pair))[-1] == pair
        i = j = 0
        while True:
            (end, end_rank), (start, start_rank) = x[i], y[j]
            joined = self.arcs.get(end + start)
            if joined is not None:
                rank = -self.scores[joined]
                if rank < end_rank and rank <= start_rank:
                    return False
            if end_rank <= start_rank:
                if end_rank == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    def adjacent(self, left: int, right: int) -> bool:
        """Whether the acceptor lets ``right`` follow ``left``; -1 stands for the start or a fallback."""
        key = left * len(self.names) + right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= self.REMEMBERED:
                self._pairs.clear()
            known = self.spines(right) is not None if left < 0 else self._stay_apart(left, right)
            self._pairs[key] = known
        return known

    def fallback(self, character: str) -> tuple[int, ...]:
        if not self.bytes:
            return (self.unknown,)
        return tuple(self.bytes[b] for b in character.encode("utf-8"))

    def shortest_path(self, text: str) -> tuple[int, ...]:
        """Piece ids on the shortest path through the lattice of one chunk.

        For every position the arcs that end there are found by walking the piece
        machine backwards; what is in front of them has its final cost already.
        """
        n, bpe, start_state = len(text), self.kind == _BPE, self.trie
        pairs, size, scores = self._pairs, len(self.names), self.scores
        cost, last, since = [0.0] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            state, start = start_state, end
            best, by, of = _NEVER, -1, end - 1
            while start:
                start -= 1
                state = state[1].get(text[start])
                if state is None:
                    break
                piece = state[0]
                if piece is None:
                    continue
                if not bpe:
                    if cost[start] - scores[piece] < best:
                        best, by, of = cost[start] - scores[piece], piece, start
                    continue
                passes = pairs.get(last[start] * size + piece)
                if self.adjacent(last[start], piece) if passes is None else passes:
                    best, by, of = cost[start], piece, start
                    break  # no other path to this position is finite
            if by < 0 or (not bpe and text[end - 1] not in self.arcs):
                fallen = cost[end - 1] + 10.0 - self.lowest  # byte fallback, dearer than any piece
                if fallen < best:
                    best, by, of = fallen, -1, end - 1
            cost[end], last[end], since[end] = best, by, of
        found: list[tuple[int, ...]] = []
        while n:
            found.append((last[n],) if last[n] >= 0 else self.fallback(text[since[n] : n]))
            n = since[n]
        return tuple(i for ids in reversed(found) for i in ids)

    def encode(self, text: str) -> bytes:
        """Piece ids as little-endian int32."""
        words, out = self._words, bytearray()
        for chunk in self.chunks.findall(self.normalised(text)):
            ids = words.recent.get(chunk) or words.again(chunk)
            if ids is None:
                path = self.shortest_path(chunk)
                ids = struct.pack(f"<{len(path)}i", *path)
                if len(chunk) <= 64:
                    words.put(chunk, ids)
            out += ids
        return bytes(out)

    @cached_property
    def surfaces(self) -> list[bytes]:
        """What a piece turns back into; control pieces into nothing."""
        special = {_BYTE: lambda n: bytes([int(n[1:-1], 16)]), _CONTROL: lambda n: b"", _UNKNOWN: lambda n: " ⁇ ".encode()}
        plain = lambda n: n.replace(MARK, " ").encode("utf-8")
        return [special.get(t, plain)(n) for n, t in zip(self.names, self.types)]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surfaces.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def plain(self, text: str) -> str:
        """What decoding the encoding of ``text`` gives: the text as the normaliser leaves it."""
        done = self.normalised(text).replace(MARK, " ")
        return done[1:] if self.prefix and done.startswith(" ") else done


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _encoder(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer(model.value)
        for batch in batches:
            rows = [machine.encode(t or "") for t in texts_of(batch)]
            offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
            values = np.frombuffer(b"".join(rows), dtype="<i4")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "piece_ids"])

    return run


def _decoder(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer(model.value)
        for batch in batches:
            ids = batch.column("piece_ids")
            # Row by row from the buffers: a batch of ids as Python numbers would be many times its size.
            values, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            texts = [
                machine.decode(values[ends[r] : ends[r + 1]].tolist()) if ids[r].is_valid else None for r in range(len(ids))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
            )

    return run


def _both(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decode = _encoder(model), _decoder(model)
        yield from decode(encode(batches))

    return run


def _mapped(rows: DataFrame, run, *added: T.StructField) -> DataFrame:
    kept = rows.drop(*[f.name for f in added])
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


_IDS = T.StructField("piece_ids", T.ArrayType(T.IntegerType()))
_DECODED = T.StructField("decoded", T.StringType())


def _shared(spark: SparkSession, path: str):
    """The model file, read by the driver and broadcast: its size is that of a vocabulary, not of the data."""
    return spark.sparkContext.broadcast(read_model(path))


def encoded(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` with ``piece_ids``, the encoding of ``text``; a column of that name is replaced.

    A null or empty text has no pieces. Whole texts are encoded, each row alone,
    without a shuffle.
    """
    return _mapped(docs, _encoder(_shared(docs.sparkSession, path)), _IDS)


def decoded(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """``rows`` with ``decoded``, the text of ``piece_ids``; null ids give null, ids outside the model an error."""
    return _mapped(rows, _decoder(_shared(rows.sparkSession, path)), _DECODED)


def coded(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """:func:`encoded` and then :func:`decoded` in one pass; columns of their names are replaced."""
    return _mapped(docs, _both(_shared(docs.sparkSession, path)), _IDS, _DECODED)


def _round_trips(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer(model.value)
        for batch in batches:
            counts, digests, same = [], [], []
            for text in texts_of(batch):
                ids = machine.encode(text)
                counts.append(len(ids) // 4)
                digests.append(ids)
                same.append(machine.decode(np.frombuffer(ids, dtype="<i4").tolist()) == machine.plain(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(same)],
                ["doc_id", "n_pieces", "ids", "round_trip"],
            )

    return run


def round_trips(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """Per row: doc_id, n_pieces, ids (little-endian int32) and whether decoding them gives the normalised text back."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    run = _round_trips(_shared(docs.sparkSession, path))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, ids binary, round_trip boolean")
