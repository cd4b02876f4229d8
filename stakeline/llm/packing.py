"""Packing of tokenised documents into sequences: large items matched, small ones best-fit.

Items above a third of the capacity come first: at most two of them fit one sequence, so each
is matched with the largest other one that still fits beside it. Smaller items then go, longest
first, to the sequence with the least gap that holds them, or open a new one.

Lengths are whole numbers up to the capacity, so all of this needs only the number of items per
length. The plan is made from that table, which has at most one row per token of capacity, and
says in runs which items of a length go to which sequences. Items are numbered in parallel and
look up their run. Neither texts nor items pass through the driver or one task, and the packing
is that of one sequential pass over all items.

Null and empty texts are a document of the end token alone. Documents longer than the capacity
are cut into pieces of it, of which the last may be shorter. Repeated rows and ids are packed
like any others; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeline.llm.common import batch, numbered, slices
from stakeline.sources.sinks import stage_table

CAPACITY = 4096
END = 1
VOCABULARY = "word_bpe_49k.json"

# Parts of texts whose ids a worker remembers from batch to batch.
REMEMBERED = 150_000
# How the vocabulary's tokenizer splits lower-cased text, for characters up to
# U+00FF: endings after an apostrophe, letters, single digits, runs of all else but white space.
_SPLIT = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^\t-\r \x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+"
)
_WORD = re.compile(
    r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
)
# Strings that the tokenizer takes for tokens of their own.
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")
# How the vocabulary's file says that, so that any other file is known to differ.
_KNOWN = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {
                    "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
                },
                "behavior": "Removed",
                "invert": True,
            },
            {
                "type": "ByteLevel",
                "add_prefix_space": False,
                "trim_offsets": True,
                "use_regex": False,
            },
        ],
    },
}


def _byte_characters() -> dict[int, int]:
    """The character by which byte-level vocabularies write each byte.

    Visible ones stand for themselves, the others for those from U+0100 on, in order.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 0x100 + i for i, b in enumerate(others)}


def _narrow(text: str) -> bool:
    """Whether all characters are up to U+00FF."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Ids of texts as little-endian 32-bit numbers.

    The tokenizer splits a text into parts and merges bytes within a part only, so a text's ids
    are those of its parts in order, and ids of parts can be remembered. Parts of characters up to
    U+00FF, where splitting and lower-casing are simple, go to the tokenizer's merges directly;
    words with others, and texts with its special strings, go through the tokenizer whole. So do
    all texts where the file splits in another way.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not os.path.isabs(vocabulary):
            import public_tokenizers

            vocabulary = public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        written = json.loads(self.tokenizer.to_str())
        special = {t["content"] for t in written["added_tokens"]}
        self.known = special == {*_SPECIAL} and all(written[k] == v for k, v in _KNOWN.items())
        self.merges = self.tokenizer.model
        self.characters = _byte_characters()
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _simple(self, text: str) -> bytes:
        """Ids of a text of characters up to U+00FF."""
        found = _SPLIT.findall(text.lower())
        for part in set(found).difference(self.parts):
            written = part.encode().decode("latin-1").translate(self.characters)
            ids = [token.id for token in self.merges.tokenize(written)]
            self.parts[part] = np.array(ids, "<u4").tobytes()
        return b"".join(map(self.parts.__getitem__, found))

    def _word(self, word: str) -> bytes:
        if _narrow(word):
            return self._simple(word)
        if word not in self.words:
            self.words[word] = self._whole(word)
        return self.words[word]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        for known in (self.parts, self.words):
            if len(known) > REMEMBERED:
                known.clear()
        if not self.known or any(s in text for s in _SPECIAL):
            return self._whole(text)
        if _narrow(text):
            return self._simple(text)
        # Nothing is merged across white space.
        return b"".join(map(self._word, _WORD.findall(text)))


@cache
def _encoder(vocabulary: str) -> Encoder:
    """One per worker process, which serves many tasks."""
    return Encoder(vocabulary)


PIECES = pa.schema(
    [
        ("id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)
PIECES_DDL = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


def _piece_batches(
    batches: Iterator[pa.RecordBatch], vocabulary: str, capacity: int, keep_ids: bool
) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(vocabulary)
    end = np.array([END], "<u4").tobytes()
    for rows in batches:
        columns = [[] for _ in PIECES]
        texts = map(encoder.encode, rows[1].to_pylist())
        for doc_id, ids in zip(rows[0].to_pylist(), texts, strict=True):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                own = ids[at : at + 4 * capacity]
                row = (doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own))
                for column, value in zip(columns, (*row, own if keep_ids else None), strict=True):
                    column.append(value)
        yield batch(PIECES, *columns)


# --- the plan ---------------------------------------------------------------------------------


class Plan:
    """Runs of items of one length and the sequences they go to.

    ``counts`` holds the number of items per length. Items are numbered from 0 in order of their
    length. A run says: items ``begin`` to ``end`` go to sequences from ``first`` on, ``each`` to
    a sequence, from ``offset`` on.
    """

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = {length: n for length, n in counts.items() if n}
        self.next, at = {}, 0
        for length in sorted(self.left):
            self.next[length] = at
            at += self.left[length]
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        # Sequences with room, by gap: runs of their numbers.
        self.gaps: list[int] = []
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        large = sorted((n for n in self.left if 3 * n > capacity), reverse=True)
        self._match(large)
        for length in sorted((n for n in self.left if 3 * n <= capacity), reverse=True):
            self._fit(length)

    def _place(self, length: int, items: int, first: int, each: int, offset: int) -> None:
        begin = self.next[length]
        self.runs.append((length, begin, begin + items, first, each, offset))
        self.next[length] += items
        self.left[length] -= items

    def _offer(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if not self.open[gap]:
                insort(self.gaps, gap)
            self.open[gap].append((first, n))

    def _match(self, large: list[int]) -> None:
        ascending = large[::-1]
        for length in large:
            while items := self.left[length]:
                room = bisect_left(ascending, self.capacity - length + 1)
                while room and not self.left[ascending[room - 1]]:
                    room -= 1
                partner = ascending[room - 1] if room else None
                first = self.sequences
                if partner == length and items > 1:
                    n = items // 2
                    self._place(length, 2 * n, first, 2, 0)
                    gap = self.capacity - 2 * length
                elif partner is not None and partner != length:
                    n = min(items, self.left[partner])
                    self._place(length, n, first, 1, 0)
                    self._place(partner, n, first, 1, length)
                    gap = self.capacity - length - partner
                else:
                    smaller = [m for m in ascending[: max(room - 1, 0)] if self.left[m]]
                    if partner == length and smaller:
                        # The last of its length goes beside the next smaller one.
                        self._place(length, 1, first, 1, 0)
                        self._place(smaller[-1], 1, first, 1, length)
                        n, gap = 1, self.capacity - length - smaller[-1]
                    else:
                        n, gap = items, self.capacity - length
                        self._place(length, n, first, 1, 0)
                self.sequences += n
                self._offer(gap, first, n)

    def _fit(self, length: int) -> None:
        while items := self.left[length]:
            at = bisect_left(self.gaps, length)
            if at < len(self.gaps):
                gap = self.gaps[at]
                first, n = self.open[gap].pop()
                if not self.open[gap]:
                    self.gaps.pop(at)
            else:
                gap, first = self.capacity, self.sequences
                n = -(-items // (gap // length))
                self.sequences += n
            each = min(gap // length, items)
            full = min(n, items // each)
            self._place(length, full * each, first, each, self.capacity - gap)
            self._offer(gap - each * length, first, full)
            self._offer(gap, first + full, n - full)


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    ``keep_ids`` adds the ids as little-endian 32-bit numbers, for ``sequences``. ``vocabulary``
    is a file every executor has, by its path or by its name among the public ones. Other columns
    are not read. Pieces are written to the shared folder, as texts are encoded once.
    """
    spark = docs.sparkSession
    pieces = docs.select(F.col(doc_id).cast("bigint"), text).mapInArrow(
        lambda batches: _piece_batches(batches, vocabulary, capacity, keep_ids), PIECES_DDL
    )
    pieces = stage_table(pieces if keep_ids else pieces.drop("ids"), "pieces")
    # At most one row per token of capacity.
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    plan = Plan({row["length"]: row["n"] for row in counts}, capacity)
    runs = spark.createDataFrame(
        plan.runs,
        "run_length bigint, begin bigint, end bigint, first bigint, each bigint, at bigint",
    )
    order = ["length", "id", "piece", "start", "ids_crc32"]
    place = F.col("__rank") - F.col("begin")
    found = numbered(pieces, order, slices(spark), "numbered_pieces").join(
        F.broadcast(runs),
        (F.col("length") == F.col("run_length"))
        & (F.col("__rank") >= F.col("begin"))
        & (F.col("__rank") < F.col("end")),
    )
    return found.select(
        F.col("id").alias(doc_id),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.floor(place / F.col("each"))).alias("sequence_id"),
        (F.col("at") + place % F.col("each") * F.col("length")).alias("offset"),
        *(["ids"] if keep_ids else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from a result with ids: sequence_id, n_tokens, ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"]))).alias("ids"),
    ).withColumn("ids", F.unhex("ids"))
