"""Secrets in texts: keyword automaton, anchored patterns near its hits, embedded checksums.

An Aho-Corasick automaton of all keywords reads each text once. Only where it reports a keyword
is a pattern tried, anchored at the hit. Token formats that carry a checksum count only if the
checksum holds. Plain hex runs have no keyword: the runs of their alphabet are the prefilter.

Offsets are code points, ends exclusive. Null and empty texts have no spans. Every text is
scanned whole; repeated rows are scanned like any other; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeline.llm.common import as_bytes, batch

# Kinds in the order that breaks ties at one start.
ASSIGN, ACCESS, HEX, TOKEN = "assign", "access", "hex", "token"
KINDS = (ASSIGN, ACCESS, HEX, TOKEN)
# Words before an assigned value, and the prefix of access ids.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_PREFIX = "AKIA"
# Public token formats of prefix + random part + six base-62 digits of its CRC-32.
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
CHECKED_RANDOM = 30
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
# Least lengths.
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE,
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{%d,}" % LEAST_HEX)
_CHECKED = re.compile(
    rb"(?:%s)([A-Za-z0-9]{%d})([0-9A-Za-z]{6})(?![A-Za-z0-9])"
    % (b"|".join(p.encode() for p in CHECKED_PREFIXES), CHECKED_RANDOM)
)

Span = tuple[int, int, str]

FOUND = pa.schema(
    [
        ("id", pa.int64()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
        ("redacted", pa.string()),
    ]
)
FOUND_DDL = (
    "id bigint, n_assign bigint, n_access bigint, n_hex bigint,"
    " base_sha256 string, spans string, redacted string"
)


def checksum62(random: bytes) -> bytes:
    """CRC-32 of the random part as six base-62 digits."""
    left, digits = zlib.crc32(random), ""
    for _ in range(6):
        left, digit = divmod(left, 62)
        digits = BASE62[digit] + digits
    return digits.encode()


def _automaton() -> ahocorasick.Automaton:
    """Keywords in lower case, each with its length and the kind it announces."""
    words = ahocorasick.Automaton()
    for kind, keys in (
        (ASSIGN, ASSIGN_WORDS),
        (ACCESS, (ACCESS_PREFIX,)),
        (TOKEN, CHECKED_PREFIXES),
    ):
        for key in keys:
            words.add_word(key.lower(), (len(key), kind))
    words.make_automaton()
    return words


def _valid(kind: str, match: re.Match) -> bool:
    if kind == ASSIGN:
        return len(match[2]) >= LEAST_ASSIGN
    if kind == ACCESS:
        return len(match[0]) >= LEAST_ACCESS
    return checksum62(match[1]) == match[2]


_PATTERNS = {ASSIGN: _ASSIGN, ACCESS: _ACCESS, TOKEN: _CHECKED}


def scan(text: bytes, words: ahocorasick.Automaton) -> list[Span]:
    """Spans of one text in bytes, by start, then kind.

    Hits of a keyword come in order of their ends; for one kind that is the order of their
    starts too, as no keyword of a kind lies inside another. A hit inside the match before it
    is passed over, which leaves what a search from the left would find.
    """
    spans = []
    # One character per byte, so that the automaton's positions are byte offsets.
    lowered = text.lower().decode("latin-1")
    after = dict.fromkeys(_PATTERNS, 0)
    for end, (length, kind) in words.iter(lowered):
        start = end + 1 - length
        if start < after[kind]:
            continue
        match = _PATTERNS[kind].match(text, start)
        if match:
            after[kind] = match.end()
            if _valid(kind, match):
                spans.append((start, match.end(), kind))
    spans += [(m.start(), m.end(), HEX) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def in_code_points(text: bytes, spans: list[Span]) -> list[Span]:
    """Byte offsets turned into code points."""
    if not spans or text.isascii():
        return spans
    leads = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    place = np.concatenate([[0], leads])
    return [(int(place[a]), int(place[b]), kind) for a, b, kind in spans]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redact(text: bytes, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]".encode()]
        at = max(at, b)
    return b"".join([*out, text[at:]]).decode()


def _scan_batches(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    words = _automaton()
    for rows in batches:
        columns = [[] for _ in FOUND]
        for doc_id, text in zip(rows[0].to_pylist(), as_bytes(rows[1]), strict=True):
            found = scan(text, words)
            spans = in_code_points(text, found)
            base = [s for s in spans if s[2] != TOKEN]
            kinds = [s[2] for s in spans]
            row = (
                doc_id,
                *(kinds.count(kind) for kind in (ASSIGN, ACCESS, HEX)),
                hashlib.sha256(listed(base).encode()).hexdigest(),
                listed(spans),
                redact(text, found) if keep_text and found else None,
            )
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        yield batch(FOUND, *columns)


def find_secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", redacted: bool = False
) -> DataFrame:
    """One row per document: its id, counts per kind, digest of the base spans, all spans.

    With ``redacted`` the column of that name holds the text without its secrets (null where
    there are none). Other columns of ``docs`` are not read. A null id stays null.
    """
    return (
        docs.select(F.col(doc_id).cast("bigint"), text)
        .mapInArrow(lambda batches: _scan_batches(batches, redacted), FOUND_DDL)
        .withColumnRenamed("id", doc_id)
    )


def _redact_batches(
    batches: Iterator[pa.RecordBatch], at: int, length_at: int | None
) -> Iterator[pa.RecordBatch]:
    words = _automaton()
    for rows in batches:
        columns, texts = list(rows.columns), rows[at].to_pylist()
        changed = {}
        for i, data in enumerate(as_bytes(rows[at])):
            found = scan(data, words)
            if found:
                changed[i] = redact(data, found)
        if changed:
            new = [changed.get(i, text) for i, text in enumerate(texts)]
            columns[at] = pa.array(new, columns[at].type)
            if length_at is not None:
                lengths = columns[length_at].to_pylist()
                for i, text in changed.items():
                    lengths[i] = len(text)
                columns[length_at] = pa.array(lengths, columns[length_at].type)
        yield pa.RecordBatch.from_arrays(columns, schema=rows.schema)


def redact_secrets(
    docs: DataFrame, text: str = "text", length: str | None = None
) -> DataFrame:
    """The documents with every secret in ``text`` replaced by its kind; all columns stay.

    Texts without secrets, nulls among them, are unchanged. ``length`` names a column that holds
    the number of characters, to be kept right where a text changes; it may be missing.
    """
    at = docs.columns.index(text)
    length_at = docs.columns.index(length) if length in docs.columns else None
    return docs.mapInArrow(lambda batches: _redact_batches(batches, at, length_at), docs.schema)
