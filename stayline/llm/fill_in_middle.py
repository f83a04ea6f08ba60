"""Fill-in-the-middle rearrangement of documents with a piece table.

A document is a list of descriptors (buffer, start, end) over two buffers that
never change: the bytes of its text and the sentinels. Cutting splits the text's
descriptor, an arrangement is a permutation of sentinels and parts, and the
inverse permutation gives the text back. Bytes are only touched when a result is
written out or hashed, descriptor by descriptor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stayline.llm.common import text_of, texts_of

#: Sentinels before prefix, suffix and middle.
SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
#: Where the parts of a cut document stand in an arrangement; numbers are places in (prefix, middle, suffix).
PARTS = ("prefix", "middle", "suffix")
ARRANGEMENTS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
#: In hundredths: documents left plain, and suffix-first ones among the others.
PLAIN_FROM, SPM_BELOW = 90, 20

_TEXT, _MARKS = 0, 1
_MARK_BYTES = b"".join(SENTINELS.values())


class Descriptor(NamedTuple):
    """A run of bytes of one of the two buffers."""

    buffer: int
    start: int
    end: int


#: The sentinels as descriptors over their buffer.
MARKS = {
    part: Descriptor(_MARKS, at, at + len(mark))
    for part, mark in SENTINELS.items()
    for at in [_MARK_BYTES.index(mark)]
}


def split(descriptors: list[Descriptor], at: int) -> tuple[list[Descriptor], list[Descriptor]]:
    """Cut a list of descriptors ``at`` bytes from its start; the descriptor that is hit splits in two."""
    before: list[Descriptor] = []
    for i, (buffer, start, end) in enumerate(descriptors):
        if at < end - start:
            head = [Descriptor(buffer, start, start + at)] if at else []
            return before + head, [Descriptor(buffer, start + at, end), *descriptors[i + 1 :]]
        before.append(descriptors[i])
        at -= end - start
    return before, []


def arranged(parts: list[list[Descriptor]], form: str) -> list[Descriptor]:
    """Descriptors of the output: every part after its sentinel, in the order of ``form``."""
    return [d for part in ARRANGEMENTS[form] for d in (MARKS[PARTS[part]], *parts[part])]


def parts_of(output: bytes, form: str) -> list[list[Descriptor]]:
    """The parts of an arranged output as descriptors over it, put back by the inverse permutation.

    A cut text holds no sentinel, and none can arise where a part meets one
    ("<" only begins and ">" only ends a sentinel), so each is found once.
    """
    order = ARRANGEMENTS[form]
    marks = [SENTINELS[PARTS[part]] for part in order]
    starts, at = [], 0
    for mark in marks:
        at = output.index(mark, at) + len(mark)
        starts.append(at)
    ends = [start - len(mark) for start, mark in zip(starts[1:], marks[1:])] + [len(output)]
    found = [[Descriptor(_TEXT, start, end)] for start, end in zip(starts, ends)]
    return [found[place] for place in np.argsort(order)]


def streamed(descriptors: list[Descriptor], text: bytes) -> Iterator[memoryview]:
    """The bytes behind the descriptors, without copying."""
    buffers = (memoryview(text), memoryview(_MARK_BYTES))
    for buffer, start, end in descriptors:
        yield buffers[buffer][start:end]


def digest(descriptors: list[Descriptor], text: bytes) -> str:
    found = hashlib.sha256()
    for run in streamed(descriptors, text):
        found.update(run)
    return found.hexdigest()


def unit_starts(text: bytes) -> np.ndarray | None:
    """Byte offsets of the code points; None where every byte is one."""
    if text.isascii():
        return None
    return np.flatnonzero((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)


class Cut(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    parts: list[list[Descriptor]]

    @property
    def output(self) -> list[Descriptor]:
        return self.parts[0] if self.form == "plain" else arranged(self.parts, self.form)


def cut(text: bytes, key: bytes) -> Cut:
    """Form and parts of a text; ``key`` (here ``1:`` and the id) seeds the two cuts and the form."""
    starts = unit_starts(text)
    n = len(text) if starts is None else len(starts)
    h = np.frombuffer(hashlib.sha256(key).digest()[:16], dtype=">u4").tolist()
    whole = [Descriptor(_TEXT, 0, len(text))]
    if not text or h[2] % 100 >= PLAIN_FROM or any(mark in text for mark in SENTINELS.values()):
        return Cut(n, "plain", None, None, [whole])
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    at = [u if starts is None else int(starts[u]) if u < n else len(text) for u in (first, second)]
    prefix, rest = split(whole, at[0])
    middle, suffix = split(rest, at[1] - at[0])
    return Cut(n, "spm" if h[3] % 100 < SPM_BELOW else "psm", first, second - first, [prefix, middle, suffix])


def joined(descriptors: list[Descriptor], text: bytes) -> bytes:
    return b"".join(streamed(descriptors, text))


def restored(output: bytes, form: str) -> list[Descriptor]:
    """The text behind an output, as descriptors over the output."""
    if form == "plain":
        return [Descriptor(_TEXT, 0, len(output))]
    return [d for part in parts_of(output, form) for d in part]


def _key() -> Column:
    return F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null"))).cast("binary")


_MEASURES = "n long, form string, prefix_chars long, middle_chars long"


def _measures(cuts: list[Cut]) -> list[pa.Array]:
    long = pa.int64()
    return [
        pa.array([c.n for c in cuts], long), pa.array([c.form for c in cuts], pa.string()),
        pa.array([c.prefix_chars for c in cuts], long), pa.array([c.middle_chars for c in cuts], long),
    ]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cuts, outputs, backs = [], [], []
        for text, key in zip(texts_of(batch), texts_of(batch, "key")):
            found = cut(text, key)
            cuts.append(found._replace(parts=[]))
            outputs.append(digest(found.output, text))
            output = joined(found.output, text)
            backs.append(digest(restored(output, found.form), output))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *_measures(cuts), pa.array(outputs, pa.string()), pa.array(backs, pa.string())],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
        )


def digests(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    ``n`` counts code points. A null text is empty and so plain; plain documents
    have null part lengths. A null id is seeded by the word ``null``. Rows with equal id
    and text get equal results; an empty table gives no rows; columns other than
    ``doc_id`` and ``text`` are not read. The output is hashed straight from the
    descriptors; the restored text is hashed over the written output, cut at its sentinels.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"), _key().alias("key"))
    return rows.mapInArrow(_digests, f"doc_id long, {_MEASURES}, output_sha256 string, restored_sha256 string")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cuts, outputs = [], []
        for text, key in zip(texts_of(batch), texts_of(batch, "key")):
            found = cut(text, key)
            cuts.append(found._replace(parts=[]))
            outputs.append(joined(found.output, text))
        held = [batch.column(i) for i in range(2, batch.num_columns)]
        yield pa.RecordBatch.from_arrays(
            [*_measures(cuts), pa.array(outputs, pa.binary()).cast(pa.string()), *held],
            ["n", "form", "prefix_chars", "middle_chars", "output", *batch.schema.names[2:]],
        )


def _backs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [joined(restored(o, f), o) for o, f in zip(texts_of(batch, "output"), batch.column("form").to_pylist())]
        held = [batch.column(i) for i in range(2, batch.num_columns)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.binary()).cast(pa.string()), *held], ["restored", *batch.schema.names[2:]]
        )


def _carried(df: DataFrame) -> tuple[list[Column], list[str], str]:
    """Columns of ``df`` under names that clash with nothing, those names, and their schema."""
    names = [f"_c{i}" for i in range(len(df.columns))]
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)]
    return columns, names, ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, df.schema.fields))


def rearranged(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` in its fill-in-the-middle form and ``fim_form`` as last column.

    Other columns stay as they are, a column named ``fim_form`` is replaced; the text is
    never null afterwards. Same rows, same order of columns.
    """
    columns, names, schema = _carried(docs)
    rows = docs.select(text_of().cast("binary").alias("text"), _key().alias("key"), *columns)
    done = rows.mapInArrow(_texts, f"{_MEASURES}, output string, {schema}")
    back = [F.col("output" if c == "text" else n).alias(c) for c, n in zip(docs.columns, names) if c != "fim_form"]
    return done.select(*back, F.col("form").alias("fim_form"))


def put_back(docs: DataFrame) -> DataFrame:
    """The inverse of :func:`rearranged`: the texts as they were (null as empty), without ``fim_form``."""
    columns, names, schema = _carried(docs)
    rows = docs.select(F.col("text").cast("binary").alias("output"), F.col("fim_form").alias("form"), *columns)
    done = rows.mapInArrow(_backs, f"restored string, {schema}")
    return done.select(
        *[F.col("restored" if c == "text" else n).alias(c) for c, n in zip(docs.columns, names) if c != "fim_form"]
    )
