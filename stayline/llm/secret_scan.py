"""Secret scan: keyword automaton, anchored patterns near its hits, embedded checksums.

One Aho-Corasick pass finds keyword positions; a pattern is only tried where its
keyword stands. Hex runs have no keyword: their prefilter is a byte map and a
search for the shortest run that counts. Tokens that carry a checksum of
themselves are reported only if it fits.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from stayline.llm.common import id_and_text, texts_of

# Kinds in their order, keywords, patterns, shortest lengths.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "xprv")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("AKIA",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "xprv": ("xprv",),
}
PATTERNS = {
    "assign": re.compile(
        rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE
    ),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "npm": re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "xprv": re.compile(rb"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![0-9A-Za-z])"),
}
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

_HEX_MAP = bytes(49 if c in b"0123456789abcdef" else 48 for c in range(256))
_HEX_RUN = b"1" * MIN_HEX


def base62_crc(body: bytes) -> str:
    """CRC-32 as six base-62 digits: the last six characters of the token formats that use it."""
    value, digits = zlib.crc32(body), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def base58_check(text: str) -> bool:
    """Whether base-58 text ends in the first four bytes of the double SHA-256 of what precedes."""
    value = 0
    for character in text:
        value = value * 58 + BASE58.index(character)
    raw = value.to_bytes(max(4, (value.bit_length() + 7) // 8), "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


@cache
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            automaton.add_word(word.lower(), (kind, len(word)))
    automaton.make_automaton()
    return automaton


def _accepted(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= MIN_VALUE
    if kind == "access":
        return len(match[0]) >= MIN_ACCESS
    if kind == "xprv":
        return base58_check(match[0].decode("ascii"))
    return base62_crc(match[1]) == match[2].decode("ascii")


def byte_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of every secret in UTF-8 bytes, ordered by start and kind.

    Per kind matches are leftmost and do not overlap; a match that fails its
    length or checksum still uses up its text.
    """
    found: list[tuple[int, int, int]] = []
    # One character per byte, so that positions are byte positions.
    lowered = text.lower().decode("latin-1")
    hits = sorted((end - n + 1, kind) for end, (kind, n) in _automaton().iter(lowered))
    used = dict.fromkeys(KINDS, 0)
    for start, kind in hits:
        if start >= used[kind] and (match := PATTERNS[kind].match(text, start)):
            used[kind] = match.end()
            if _accepted(kind, match):
                found.append((start, match.end(), KINDS.index(kind)))
    mapped = text.translate(_HEX_MAP)
    start = mapped.find(_HEX_RUN)
    while start >= 0:
        end = mapped.find(b"0", start)
        end = len(mapped) if end < 0 else end
        found.append((start, end, BASE_KINDS.index("hex")))
        start = mapped.find(_HEX_RUN, end)
    return sorted(found, key=lambda span: (span[0], span[2], span[1]))


def code_point_spans(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte spans as code point spans; one walk over the text, as starts only grow."""
    out, at, points = [], 0, 0
    for start, end, kind in spans:
        points += len(text[at:start].decode("utf-8", "replace"))
        at = start
        out.append((points, points + end - start, kind))  # a match is ASCII
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
        ("base_sha256", pa.string()), ("spans", pa.string()),
    ]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in texts_of(batch):
            spans = code_point_spans(text, byte_spans(text))
            base = [s for s in spans if s[2] < len(BASE_KINDS)]
            counts = [sum(s[2] == k for s in base) for k in range(len(BASE_KINDS))]
            rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
        columns = zip(*rows) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, type=f.type) for c, f in zip(columns, list(_OUT)[1:])]], schema=_OUT
        )


def secret_spans(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` lists kind:start:end in code points, end exclusive, by start and
    then kind. A null or empty text has no spans. Rows are judged alone, in one
    pass without a shuffle, so repeated rows and null ids need no rule.
    """
    return id_and_text(docs).mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
