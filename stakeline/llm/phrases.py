"""Collocations: phrases of two to four words whose words keep together.

Phrases are found by dynamic itemset counting. The rows are dealt to a few shards, which are
scanned in turn, round and round. Words are counted from the first scan on. As soon as both
phrases that a longer one is made of (all but its last, all but its first word) have reached the
threshold in the shards scanned so far, the longer one is counted too, beginning with the next
scan, until it has seen every shard once. So lengths are counted side by side, and nothing is
counted that has an infrequent part.

A task learns what has reached the threshold from a table of ``SLOTS`` bytes, whatever the size
of the corpus: a phrase's slot holds the latest scan in which one of the slot reached it. Two
phrases in one slot only make a task count more than it needs to, or count a shard again. Each
scan stores its counts, and a phrase's count is the sum over the shards, each taken once.

Counts are moved, added up and stored as arrays, one for thousands of phrases, in buckets by the
phrases' 64 bits. Single rows are made only of those that may have reached the threshold: a bitmap
tells the tasks that read the stored arrays which these are, and a join then drops the others.

Inside the scans a word stands for 64 bits of its text and language, a phrase for the pair of
what it begins with and its last word; words that reach the threshold are checked to differ.

Null texts are empty, a null language is ``und``. Repeated rows count as often as they occur. A very
long text is cut between words, and each part brings the words before it. An empty table gives an
empty result. Columns other than text and language are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from stakeline.llm import common
from stakeline.llm.common import as_bytes, batch, mix, prepare, slices
from stakeline.sources.sinks import stage_table, staging_folder

LEAST = 30
LONGEST = 4
MOST_LISTED = 2000
# A longer phrase this often (percent) as frequent makes its parts redundant.
COVERED_PERCENT = 80
SHARDS = 4
# Slots of the table of frequent phrases, a byte each.
SLOTS = 1 << 24
# Text whose counts are added up in a task before they are handed on.
HELD_BYTES = 16 << 20
# Text of a shard for each bucket of its counts, or less. A bucket is added up at a time.
BUCKET_BYTES = 8 << 20
# Most bits of a place in the bitmap of phrases to be looked up, which has 16 places for each.
WANTED_BITS = 27
# Text scanned at a time: arrays of 8 bytes for each of its own stay in a core's cache.
SCANNED_BYTES = 1 << 17
# Rows of a task that keeps book of the frequent phrases between two scans.
KEPT_ROWS = 1 << 16
# Whether the files of a shuffle go with the query they are for.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Stored counts that a task looks through.
SEARCHED_ROWS = 1 << 19

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IN_WORD, _BETWEEN, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BETWEEN
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK

_PHRASE = ["n", "head", "last"]
# Arrays of the phrases of a bucket: 64 bits of their beginnings (none for words) and last words,
# places as the narrowest unsigned type that holds them, lengths and UTF-8 of words.
_ARRAYS = ["heads", "lasts", "places", "sizes", "words"]
_PACKED = f"bucket int, n int, lang string, {', '.join(f'{name} binary' for name in _ARRAYS)}"
_PACKED_SCHEMA = pa.schema(
    [
        ("bucket", pa.int32()),
        ("n", pa.int32()),
        ("lang", pa.string()),
        *[(name, pa.binary()) for name in _ARRAYS],
    ]
)
# A bucket added up: its places, and the phrases that a scan found often, apart from the others.
_OFTEN = ["often_heads", "often_lasts"]
_COUNTS = (
    f"n int, lang string, {', '.join(f'{name} binary' for name in _ARRAYS)}, "
    f"total long, often long, {', '.join(f'{name} binary' for name in _OFTEN)}"
)
_COUNT_SCHEMA = pa.schema(
    [
        ("n", pa.int32()),
        ("lang", pa.string()),
        *[(name, pa.binary()) for name in _ARRAYS],
        ("total", pa.int64()),
        ("often", pa.int64()),
        *[(name, pa.binary()) for name in _OFTEN],
    ]
)

# Exact beyond 64 bits.
_WIDE = "DECIMAL(20, 0)"
SHARE = (
    f"CAST(CAST(2000000 AS {_WIDE}) * a DIV (CAST(l AS {_WIDE}) + CAST(r AS {_WIDE})) AS BIGINT)"
)


def _joined(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64 bits for the phrase of a beginning and a last word."""
    return mix(head * np.uint64(0x9E3779B97F4A7C15) + mix(last ^ np.uint64(0xD6E8FEB86659FD93)))


def _slots(names: np.ndarray, slots: int) -> np.ndarray:
    return (names & np.uint64(slots - 1)).astype(np.int64)


def _parts(texts: list[bytes]) -> Iterator[list[tuple[int, bytes, int]]]:
    """Texts in buffers of bounded size: number, bytes, and how many words lead in.

    A longer text is cut behind a word; the next part begins ``LONGEST`` - 1 words earlier.
    """
    held, size, most = [], 0, min(SCANNED_BYTES, common.PIECE_BYTES)
    for i, text in enumerate(texts):
        if len(text) > most:
            yield from ([(i, *part)] for part in _cut(text, most))
            continue
        if size + len(text) > most and held:
            yield held
            held, size = [], 0
        held.append((i, text, 0))
        size += len(text)
    if held:
        yield held


def _cut(text: bytes, most: int) -> Iterator[tuple[bytes, int]]:
    at, leading, size = 0, 0, most
    while at + size < len(text):
        begins, ends = _words(np.frombuffer(text, np.uint8, size, at))
        whole = int(np.count_nonzero(ends < size))
        if whole <= leading + LONGEST:
            size *= 2
            continue
        yield text[at : at + int(ends[whole - 1])], leading
        at += int(begins[whole - LONGEST + 1])
        leading, size = LONGEST - 1, most
    yield text[at:], leading


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _KIND[data] == _IN_WORD
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


class _Held:
    """Occurrences found in a task, added up before they are handed on."""

    def __init__(self) -> None:
        self.words: list[tuple] = []
        self.buffers: list[bytes] = []
        self.phrases: dict[int, list[tuple]] = {n: [] for n in range(2, LONGEST + 1)}
        self.size = 0

    def rows(self, langs: list[str], bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Arrays of each bucket; ``bounds`` has the least name of each but the first."""
        if self.words:
            yield from self._word_rows(langs, bounds)
        for n, found in self.phrases.items():
            if found:
                head, last = (np.concatenate(c) for c in zip(*found, strict=True))
                found.clear()
                name, head, last, places = _added(head, last)
                yield _dealt(n, None, name, bounds, head, last, places)

    def _word_rows(self, langs: list[str], bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        names, places, begins, sizes, tongue = (
            np.concatenate(column) for column in zip(*self.words, strict=True)
        )
        data = np.frombuffer(b"".join(self.buffers), np.uint8)
        self.words, self.buffers = [], []
        order = np.argsort(names)
        first = np.flatnonzero(_fresh(names[order]))
        places = np.add.reduceat(places[order], first)
        pick = order[first]
        by_lang = np.argsort(tongue[pick], kind="stable")
        pick, places = pick[by_lang], places[by_lang]
        tongue = tongue[pick]
        starts = np.flatnonzero(_fresh(tongue))
        for a, b in zip(starts, np.append(starts[1:], len(pick)), strict=True):
            own = pick[a:b]
            yield _dealt(
                1, langs[tongue[a]], names[own], bounds, None, names[own], places[a:b],
                sizes[own], _gathered(data, begins[own], sizes[own]),
            )


def _dealt(
    n: int, lang: str | None, name: np.ndarray, bounds: np.ndarray, head: np.ndarray | None,
    last: np.ndarray, places: np.ndarray, sizes: np.ndarray | None = None,
    words: np.ndarray | None = None,
) -> pa.RecordBatch:
    """Columns in the order of their names, as a row of arrays for each bucket that has some."""
    edges = np.concatenate([[0], np.searchsorted(name, bounds), [len(name)]])
    full = np.flatnonzero(edges[1:] > edges[:-1])
    edges = np.append(edges[full], len(name))

    def cut(values: np.ndarray | None, at: np.ndarray = edges) -> pa.Array:
        if values is None:
            return pa.nulls(len(full), pa.binary())
        offsets = pa.py_buffer((at * values.itemsize).astype(np.int32))
        return pa.Array.from_buffers(
            pa.binary(), len(full), [None, offsets, pa.py_buffer(np.ascontiguousarray(values))]
        )

    text_edges = edges if sizes is None else np.append(0, np.cumsum(sizes, dtype=np.int64))[edges]
    return batch(
        _PACKED_SCHEMA, full.astype(np.int32), np.full(len(full), n, np.int32),
        pa.array([lang] * len(full), pa.string()), cut(head), cut(last), cut(_narrow(places)),
        cut(None if sizes is None else sizes.astype(np.uint32)), cut(words, text_edges),
    )


def _narrow(places: np.ndarray) -> np.ndarray:
    return places.astype(np.min_scalar_type(int(places.max())))


def _wide(places: pa.Buffer, rows: int) -> np.ndarray:
    return np.frombuffer(places, f"u{places.size // rows}").astype(np.int64)


def _gathered(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of some stretches, one behind another."""
    ends = np.cumsum(sizes)
    return data[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _fresh(ordered: np.ndarray) -> np.ndarray:
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


def _added(
    head: np.ndarray, last: np.ndarray, places: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64 bits of different pairs, in their order, these pairs, and the sums of their places.

    Without places, each pair has one.
    """
    name = _joined(head, last)
    order = np.argsort(name)
    fresh_name, fresh = _fresh(name[order]), _fresh(head[order]) | _fresh(last[order])
    if (fresh & ~fresh_name).any():
        # Pairs that share their 64 bits.
        order = np.lexsort((last, head, name))
        fresh = _fresh(head[order]) | _fresh(last[order])
    first = np.flatnonzero(fresh)
    pick = order[first]
    if places is None:
        total = np.diff(np.append(first, len(order)))
    else:
        total = np.add.reduceat(places[order], first)
    return name[pick], head[pick], last[pick], total


def _added_words(
    last: np.ndarray, places: np.ndarray, sizes: np.ndarray, data: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different words in the order of their 64 bits, sums of their places, lengths and bytes."""
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(last, kind="stable")
    fresh = _fresh(last[order])
    of = order[fresh][np.cumsum(fresh) - 1]
    again, of = order[~fresh], of[~fresh]
    if not np.array_equal(sizes[again], sizes[of]) or not np.array_equal(
        _gathered(data, begins[again], sizes[again]), _gathered(data, begins[of], sizes[of])
    ):
        # Words that share their 64 bits stay apart.
        spelled = [data[a : a + k].tobytes() for a, k in zip(begins, sizes, strict=True)]
        _, kind = np.unique(np.array(spelled, object), return_inverse=True)
        order = np.lexsort((kind, last))
        fresh = _fresh(last[order]) | _fresh(kind[order])
    first = np.flatnonzero(fresh)
    pick = order[first]
    words = _gathered(data, begins[pick], sizes[pick])
    return last[pick], np.add.reduceat(places[order], first), sizes[pick], words


def _scan(
    part: list[tuple[int, bytes, int]], seeds: np.ndarray, tongues: np.ndarray,
    reached: np.ndarray, step: int, shards: int, held: _Held,
) -> None:
    """Adds the words (in the first round) and open phrases of some texts to ``held``."""
    number = np.array([i for i, _, _ in part])
    lengths = [len(t) + 1 for _, t, _ in part]
    begin_of = np.concatenate([[0], np.cumsum(lengths)])
    buffer = b"\n".join(t for _, t, _ in part).translate(_LOWER)
    data = np.frombuffer(buffer, np.uint8)
    begins, ends = _words(data)
    if not len(begins):
        return
    owner = np.searchsorted(begin_of, begins, side="right") - 1
    name = _word_names(data, begins, ends, seeds[number[owner]])
    leading = np.zeros(len(name), bool)
    if part[0][2]:
        leading[: part[0][2]] = True
    piece = np.cumsum(_KIND[data] == _BREAK, dtype=np.int32)[begins]
    if step < shards:
        own = np.flatnonzero(~leading)
        order = own[np.argsort(name[own])]
        first = np.flatnonzero(_fresh(name[order]))
        pick = order[first]
        places = np.diff(np.append(first, len(order)))
        begin, size = begins[pick], ends[pick] - begins[pick]
        held.words.append(
            (name[pick], places, begin + held.size, size, tongues[number[owner[pick]]])
        )
        held.buffers.append(buffer)
    held.size += len(buffer)
    # Phrases of n - 1 words by their first word: 64 bits, and the scan (plus 1) in which
    # they reached the threshold, 0 if they did not.
    known, names = reached[_slots(name, len(reached))], name
    same = np.append(piece[1:] == piece[:-1], False)
    for n in range(2, LONGEST + 1):
        later = np.append(known[1:], np.uint8(0))
        both = (known > 0) & (later > 0)
        at = np.flatnonzero(both & same if n == 2 else both)
        latest = np.maximum(known[at], later[at]).astype(np.int64)
        head, last = names[at], name[at + n - 1]
        counted = (step <= latest - 1 + shards) & ~leading[at + n - 1]
        if counted.any():
            held.phrases[n].append((head[counted], last[counted]))
        if n == LONGEST or not len(at):
            break
        found = _joined(head, last)
        names = np.zeros(len(name), np.uint64)
        names[at] = found
        known = np.zeros(len(name), np.uint8)
        known[at] = reached[_slots(found, len(reached))]


def _word_names(
    data: np.ndarray, begins: np.ndarray, ends: np.ndarray, seeds: np.ndarray
) -> np.ndarray:
    common._grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * common._UP[: len(data)], out=sums[1:])
    return mix(mix((sums[ends] - sums[begins]) * common._DOWN[begins]) + seeds)


def _counted(
    shard: DataFrame, reached: np.ndarray, step: int, shards: int, folder: str, often: int,
    buckets: int,
) -> tuple[int, int]:
    """Stores the counts of one scan: all words in the first round, and the phrases that are open.

    Returns their number, and how many of them are ``often`` or more.
    """
    # Most slots are empty, and a step's table is of no use after it.
    table = shard.sparkSession.sparkContext.broadcast(zlib.compress(reached, 1))
    held_bytes = HELD_BYTES
    bounds = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, held = np.frombuffer(zlib.decompress(table.value), np.uint8), _Held()
        langs, seeds, place = [], [], {}
        for rows in batches:
            if not rows.num_rows:
                continue
            own = rows.column(0).to_pylist()
            for lang in own:
                if lang not in place:
                    place[lang] = len(langs)
                    langs.append(lang)
                    seeds.append(xxhash.xxh64_intdigest(lang.encode(), 1))
            tongues = np.array([place[lang] for lang in own])
            own_seeds = np.array([seeds[k] for k in tongues], np.uint64)
            for part in _parts(as_bytes(rows.column(1))):
                _scan(part, own_seeds, tongues, flags, step, shards, held)
                if held.size >= held_bytes:
                    yield from held.rows(langs, bounds)
                    held = _Held()
        yield from held.rows(langs, bounds)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, n, lang), found in _buckets(batches):
            yield _summed(n, lang, found, often)

    rows = shard.mapInArrow(scan, _PACKED)
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "n", "lang")
    summed = rows.mapInArrow(add, _COUNTS)
    seen = Observation()
    different = F.sum(F.octet_length("lasts") / 8).cast("long")
    summed = summed.observe(seen, different.alias("rows"), F.sum("often").alias("often"))
    stage_table(summed, f"step={step}", folder)
    table.destroy()
    return seen.get["rows"] or 0, seen.get["often"] or 0


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[list]]]:
    """Bucket, length and language, and the arrays of each row of these, which lie together."""
    key, held = None, []
    for rows in batches:
        keys = zip(*(rows.column(k).to_pylist() for k in range(3)), strict=True)
        for i, own in enumerate(keys):
            if held and own != key:
                yield key, held
                held = []
            key = own
            held.append([rows.column(k)[i].as_buffer() for k in range(3, rows.num_columns)])
    if held:
        yield key, held


def _summed(n: int, lang: str | None, found: list[list], often: int) -> pa.RecordBatch:
    heads, lasts, counts, sizes, words = zip(*found, strict=True)
    head, size, spelled = None, None, None
    last = np.concatenate([np.frombuffer(x, np.uint64) for x in lasts])
    places = np.concatenate(
        [_wide(c, x.size // 8) for c, x in zip(counts, lasts, strict=True)]
    )
    if n == 1:
        size = np.concatenate([np.frombuffer(x, np.uint32) for x in sizes]).astype(np.int64)
        spelled = np.concatenate([np.frombuffer(x, np.uint8) for x in words])
        last, places, size, spelled = _added_words(last, places, size, spelled)
    else:
        head = np.concatenate([np.frombuffer(x, np.uint64) for x in heads])
        _, head, last, places = _added(head, last, places)
    pick = places >= often
    often_head = np.zeros(np.count_nonzero(pick), np.uint64) if head is None else head[pick]
    return batch(
        _COUNT_SCHEMA, [n], [lang], [head if head is None else head.tobytes()], [last.tobytes()],
        [_narrow(places).tobytes()], [size if size is None else size.astype(np.uint32).tobytes()],
        [spelled if spelled is None else spelled.tobytes()], [int(places.sum())],
        [len(often_head)], [often_head.tobytes()], [last[pick].tobytes()],
    )


_KEY_SCHEMA = pa.schema([("n", pa.int32()), ("head", pa.int64()), ("last", pa.int64())])
_LISTED_SCHEMA = pa.schema(
    [*_KEY_SCHEMA, ("places", pa.int64()), ("step", pa.int32()), ("lang", pa.string()),
     ("word", pa.string())]
)


def _often(counts: DataFrame) -> DataFrame:
    """A row for each phrase that a scan has found often."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i, n in enumerate(rows.column(0).to_pylist()):
                head, last = (np.frombuffer(rows.column(k)[i].as_buffer(), np.int64) for k in (1, 2))
                yield batch(_KEY_SCHEMA, np.full(len(head), n, np.int32), head, last)

    return counts.where("often > 0").select("n", *_OFTEN).mapInArrow(each, "n int, head long, last long")


def _wanted(phrases: DataFrame, bits: int) -> np.ndarray:
    """A bitmap with the places of some phrases."""
    mixed = F.shiftrightunsigned("head", 1).bitwiseXOR(F.col("last"))
    place = F.shiftrightunsigned(mixed, 64 - bits)
    parts = (
        phrases.groupBy(F.shiftright(place, 15).alias("part"))
        .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros((1 << (bits - 15), 1 << 12), np.uint8)
    for part, own in zip(parts.column("part").to_pylist(), parts.column("bits"), strict=True):
        bitmap[part] = np.frombuffer(own.as_buffer(), np.uint8)
    return bitmap.reshape(-1)


def _listed(
    counts: DataFrame, stored: int, phrases: DataFrame, spelled: bool = False
) -> tuple[DataFrame, Broadcast]:
    """Of ``stored`` counts, those of some phrases and a few others as rows.

    Also returns the table that these rows are read with, to be dropped after that.
    """
    wanted = phrases.count()
    bits = min(WANTED_BITS, max(15, (16 * wanted).bit_length()))
    table = counts.sparkSession.sparkContext.broadcast(zlib.compress(_wanted(phrases, bits), 1))
    counts = counts.coalesce(1 + stored // SEARCHED_ROWS)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(zlib.decompress(table.value), np.uint8)
        for rows in batches:
            for i, (n, step, lang) in enumerate(
                zip(*(rows.column(k).to_pylist() for k in range(3)), strict=True)
            ):
                head, last, places, *text = (
                    rows.column(k)[i].as_buffer() for k in range(3, rows.num_columns)
                )
                last = np.frombuffer(last, np.uint64)
                head = np.zeros(len(last), np.uint64) if n == 1 else np.frombuffer(head, np.uint64)
                at = ((head >> np.uint64(1)) ^ last) >> np.uint64(64 - bits)
                at = at.astype(np.int64)
                pick = np.flatnonzero(bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                if not len(pick):
                    continue
                words = pa.nulls(len(pick), pa.string())
                if n == 1 and text:
                    words = _strings(*text, pick)
                yield batch(
                    _LISTED_SCHEMA, np.full(len(pick), n, np.int32), head[pick].view(np.int64),
                    last[pick].view(np.int64), _wide(places, len(last))[pick],
                    np.full(len(pick), step, np.int32),
                    pa.array([lang] * len(pick), pa.string()), words,
                )

    arrays = _ARRAYS if spelled else _ARRAYS[:3]
    columns = "n int, head long, last long, places long, step int, lang string, word string"
    return counts.select("n", "step", "lang", *arrays).mapInArrow(each, columns), table


def _strings(sizes: pa.Buffer, words: pa.Buffer, pick: np.ndarray) -> pa.Array:
    size = np.frombuffer(sizes, np.uint32).astype(np.int64)
    begins = np.cumsum(size) - size
    data = _gathered(np.frombuffer(words, np.uint8), begins[pick], size[pick])
    offsets = np.append(0, np.cumsum(size[pick])).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.string(), len(pick), buffers)


_REACHED = "n int, head long, last long, name long, slot int"
_REACHED_SCHEMA = pa.schema(
    [
        ("n", pa.int32()),
        *[(name, pa.int64()) for name in ("head", "last", "name")],
        ("slot", pa.int32()),
    ]
)


def _named(phrases: DataFrame, slots: int) -> DataFrame:
    """Adds a phrase's 64 bits and its slot."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            head, last = (rows.column(k).to_numpy().view(np.uint64) for k in (1, 2))
            one = rows.column(0).to_numpy() == 1
            name = np.where(one, last, _joined(head, last))
            columns = [*rows.columns, name.view(np.int64), _slots(name, slots).astype(np.int32)]
            yield batch(_REACHED_SCHEMA, *columns)

    return phrases.select(*_PHRASE).mapInArrow(add, _REACHED)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def frequent_phrases(
    docs: DataFrame,
    least: int = LEAST,
    shards: int = SHARDS,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """All phrases of up to four words that occur ``least`` times or more in a language.

    Rows (lang, phrase, n, places): n words, joined by spaces, and the number of places.
    """
    return _frequent(docs, least, shards, text, lang)[0]


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """What is staged inside the block leaves no shuffle files behind.

    Else those of all scans would stay until the driver happens to collect its garbage.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _frequent(
    docs: DataFrame, least: int, shards: int, text: str, lang: str
) -> tuple[DataFrame, DataFrame]:
    """``frequent_phrases`` and the number of word places per language."""
    spark = prepare(docs.sparkSession)
    with _cleaned(spark):
        return _searched(docs, least, shards, text, lang)


def _searched(
    docs: DataFrame, least: int, shards: int, text: str, lang: str
) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int"))
    seen = Observation()
    dealt = dealt.observe(seen, F.sum(F.octet_length("text")).alias("bytes"))
    dealt = stage_table(dealt, "shards", by="shard")
    buckets = max(slices(spark), (seen.get["bytes"] or 0) // (shards * BUCKET_BYTES))
    reached = np.zeros(SLOTS, np.uint8)
    counts_folder, found_folder = staging_folder(spark), staging_folder(spark)
    often = -(-least // shards)
    likely: DataFrame | None = None
    stored: list[int] = []
    numbers: list[int] = []
    step, end = 0, shards
    while step < end:
        turn = step % shards
        shard = dealt.where(F.col("shard") == turn).drop("shard")
        different, number = _counted(
            shard, reached, step, shards, counts_folder, often, buckets
        )
        stored.append(different)
        numbers.append(number)
        # The lists between two scans are short beside the counts: as many tasks as they need, not
        # one for each slice of the counts. A phrase on them is counted in one of these numbers.
        tasks = min(slices(spark), 1 + sum(numbers[-shards:]) // KEPT_ROWS)
        counts = _steps(spark, counts_folder, _COUNTS)
        # The latest scans hold every shard once. Who reaches the threshold in them has a
        # share of it in one of them at least, so only those are added up.
        latest = F.col("step") > step - shards
        new = _often(counts.where(F.col("step") == step)).withColumn("step", F.lit(step))
        if likely is not None:
            found = _steps(spark, found_folder, _REACHED).select(*_PHRASE)
            new = new.unionByName(likely.where(latest)).join(found, _PHRASE, "left_anti")
        likely = new.groupBy(*_PHRASE).agg(F.max("step").alias("step"))
        likely = stage_table(likely.coalesce(tasks), "likely")
        listed, table = _listed(counts.where(latest), sum(stored[-shards:]), likely)
        sums = (
            listed.groupBy(*_PHRASE)
            .agg(F.sum("places").alias("places"))
            .where(F.col("places") >= least)
            .join(likely.select(*_PHRASE), _PHRASE)
        )
        new = _named(sums.coalesce(tasks), SLOTS)
        new = stage_table(new, f"step={step}", found_folder)
        table.destroy()
        slots = new.where(F.col("n") < LONGEST).select("slot").distinct().coalesce(tasks).toArrow()
        if slots.num_rows:
            reached[slots.column(0).to_numpy()] = step + 1
            end = max(end, step + 1 + shards)
        step += 1
    counts = _steps(spark, counts_folder, _COUNTS)
    found = _steps(spark, found_folder, _REACHED).drop("step")
    listed, table = _listed(counts, sum(stored), found, spelled=True)
    spelled = _spelled(found, listed, shards, least)
    table.destroy()
    return spelled, _places(counts.where(F.col("step") < shards))


def _steps(spark: SparkSession, folder: str, columns: str) -> DataFrame:
    """What the scans so far have stored, with the number of the scan."""
    return spark.read.schema(f"{columns}, step int").parquet(folder)


def _places(counts: DataFrame) -> DataFrame:
    words = counts.where("n = 1")
    return words.groupBy("lang").agg(F.sum("total").alias("n_words"))


def _spelled(found: DataFrame, counts: DataFrame, shards: int, least: int) -> DataFrame:
    """Counts of the phrases found, over each shard once, with their words."""
    of_shard = [F.max(F.when(F.col("step") % shards == k, F.col("places"))) for k in range(shards)]
    places = sum((F.coalesce(c, F.lit(0)) for c in of_shard[1:]), F.coalesce(of_shard[0], F.lit(0)))
    totals = counts.groupBy(*_PHRASE, "lang", "word").agg(places.alias("places"))
    totals = stage_table(totals.join(found, _PHRASE).drop("slot"), "totals")
    words = totals.where("n = 1").select("name", "lang", F.col("word").alias("phrase"), "places")
    # Words that share their 64 bits would be taken for one another.
    single = F.when(F.count(F.lit(1)).over(Window.partitionBy("name")) == 1, F.col("phrase"))
    clash = F.raise_error(F.lit("two frequent words share a 64-bit name"))
    words = words.withColumn("phrase", F.coalesce(single, clash.cast("string")))
    words = stage_table(words, "words")
    last = words.select(F.col("name").alias("last"), F.col("phrase").alias("last_word"))
    levels = [words]
    for n in range(2, LONGEST + 1):
        heads = levels[-1].select(F.col("name").alias("head"), "lang", "phrase")
        longer = (
            totals.where(F.col("n") == n)
            .select("name", "head", "last", "places")
            .join(heads, "head")
            .join(last, "last")
            .select("name", "lang", F.concat_ws(" ", "phrase", "last_word").alias("phrase"), "places")
        )
        levels.append(stage_table(longer, "spelled"))
    return _union(
        [
            level.select("lang", "phrase", F.lit(n).alias("n"), "places")
            for n, level in enumerate(levels, 1)
        ]
    ).where(F.col("places") >= least)


def _stretch(first: Column, count: Column) -> Column:
    return F.array_join(F.slice("_words", first, count), " ")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    listed: int = MOST_LISTED,
    shards: int = SHARDS,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The best phrases of each language by the share their places have in those of their parts.

    Rows (lang, rank, phrase, a, l, r, n, score): places of the phrase and of both parts of its
    weakest cut, words of the language, and score. Phrases that lie in a longer one which is
    nearly as frequent are left out.
    """
    phrases, words = _frequent(docs, least, shards, text, lang)
    candidates = phrases.where("n > 1").withColumn("_words", F.split("phrase", " "))
    cuts = candidates.select(
        "lang", "phrase", "n", "_words", F.col("places").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k",
        _stretch(F.lit(1), F.col("k")).alias("_left"),
        _stretch(F.col("k") + 1, F.col("n") - F.col("k")).alias("_right"),
    )
    left = phrases.select("lang", F.col("phrase").alias("_left"), F.col("places").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("_right"), F.col("places").alias("r"))
    scored = (
        cuts.join(left, ["lang", "_left"])
        .join(right, ["lang", "_right"])
        .withColumn("score", F.expr(SHARE))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    )
    inner = candidates.where("n > 2").select(
        "lang", "_words", "n", F.col("places").alias("_most"),
        F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("_size"),
    ).select(
        "lang", "_words", "_size", "_most",
        F.explode(F.sequence(F.lit(1), F.col("n") - F.col("_size") + 1)).alias("_first"),
    )
    covering = (
        inner.select("lang", _stretch(F.col("_first"), F.col("_size")).alias("phrase"), "_most")
        .groupBy("lang", "phrase")
        .agg(F.max("_most").alias("_most"))
    )
    covered = F.expr(f"CAST(_most AS {_WIDE}) * 100 >= CAST(a AS {_WIDE}) * {COVERED_PERCENT}")
    left_over = (
        scored.join(covering, ["lang", "phrase"], "left")
        .where(~F.coalesce(covered, F.lit(False)))
        .select("lang", "phrase", "a", "_cut.*")
    )
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # The best of each part of a language first, so that no language meets in one task.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    for keys in (["lang", part], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        left_over = left_over.withColumn("rank", rank.cast("long")).where(F.col("rank") <= listed)
    return left_over.join(words, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("n_words").alias("n"), "score"
    )
