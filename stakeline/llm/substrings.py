"""Removal of long byte strings that occur more than once, by distributed prefix doubling.

Strings of doubled length are named by the pair of names of their halves: inside a task from 8
bytes (whose name is the bytes themselves) up to the largest power of two within the threshold,
then by Spark, which groups the name pairs of all documents at growing lengths up to the
threshold. Only equality matters, so names stand in for ranks. Two things keep the rows few:

* A window of ``length`` bytes is looked at through the least name among the shorter strings in it.
  Equal windows pick the same place in them, so all windows whose picked string is unique are
  settled by one row, and drop out.
* The windows that pick one place (their *run*) are settled together where the whole stretch they
  cover is repeated. Only runs that share the picked string but not the whole stretch go on to
  the next length, each different stretch once. At the full length a run is one window.

Null texts are empty; texts shorter than the threshold keep everything; an empty table gives an
empty one. Rows with the same text count as places of their own, so a repeated row loses all it
holds. A very long text is named in pieces that overlap. Other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeline.llm.common import as_bytes, batch, prepare, sized
from stakeline.sources.sinks import stage_table

LENGTH = 400
# Bytes of text named at a time.
PIECE = 1 << 20

TEXT_KEY = "text_key"
_CLASS = ["gram", "stretch"]
_RUNS = "text_key binary, gram long, stretch long, lo long, hi long, weight long"
_RUN_SCHEMA = pa.schema(
    [
        ("text_key", pa.binary()),
        *[(name, pa.int64()) for name in ("gram", "stretch", "lo", "hi", "weight")],
    ]
)
_PLACE = np.uint64((1 << 22) - 1)


def lengths(length: int) -> list[int]:
    """Lengths at which Spark compares names: the first, one near the threshold, the threshold."""
    if length < 8:
        raise ValueError("the threshold has to be 8 bytes or more")
    top = _top(length)
    # A stretch is named by three strings of length ``top``, so they have to cover it.
    first = top // 2 if top >= 16 and 2 * length - top // 2 <= 3 * top else top
    return sorted({first, max(top, length - (length - first) // 8), length})


def _top(length: int) -> int:
    return 1 << (length.bit_length() - 1)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of a string from the names of two strings that cover it."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += b
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _names(data: np.ndarray, first: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all strings of ``first`` and of ``top`` bytes."""
    name = data.astype(np.uint64)
    for size in (1, 2, 4):
        name = name[:-size] | (name[size:] << np.uint64(8 * size))
    found, size = name, 8
    while size < top:
        name = _pair(name[:-size], name[size:])
        size *= 2
        if size == first:
            found = name
    return found, name


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _runs(data: np.ndarray, weight: np.ndarray, size: int, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that pick the same string of ``size`` bytes: name, stretch, ends, weight.

    ``weight`` is 0 where a window is not asked for; windows of different weight are never in
    one run.
    """
    top = _top(length)
    known, long = _names(data, min(size, top), top)
    gram = known if size <= top else _pair(long[: len(data) - size + 1], long[size - top :])
    places = np.arange(len(gram), dtype=np.uint64)
    picked = (_least((gram & ~_PLACE) | places, length - size + 1) & _PLACE).astype(np.int64)
    asked = np.flatnonzero(weight[: len(picked)])
    if not len(asked):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty
    at, kind = picked[asked], weight[asked]
    new = np.ones(len(asked), bool)
    new[1:] = (at[1:] != at[:-1]) | (kind[1:] != kind[:-1]) | (asked[1:] != asked[:-1] + 1)
    begin = np.flatnonzero(new)
    lo, at, kind = asked[begin], at[begin], kind[begin]
    hi = asked[np.append(begin[1:], len(asked)) - 1] + 1
    covered = hi - lo + length - 1
    stretch = _pair(long[lo], long[lo + (covered - top) // 2])
    stretch = _pair(stretch, long[lo + covered - top])
    inside = (covered << 32) + (at - lo)
    stretch = _pair(stretch, inside.astype(np.uint64))
    return gram[at].view(np.int64), stretch.view(np.int64), lo, hi, kind.astype(np.int64)


def _buffers(texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
    """Parts (text, from, to) of texts in buffers of bounded size."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, len(text), PIECE):
            part = (i, start, min(start + PIECE, len(text)))
            if held and size + part[2] - start > PIECE:
                yield held
                held, size = [], 0
            held.append(part)
            size += part[2] - start
    if held:
        yield held


def _text_runs(
    texts: list[bytes], asked: list[list[tuple[int, int, int]]] | None, size: int, length: int
) -> Iterator[tuple[np.ndarray, ...]]:
    """Number of the text and run, for all windows or for those in the ``asked`` ranges."""
    for held in _buffers(texts):
        # A part brings the bytes its last windows reach into.
        parts = [texts[i][start : end + length - 1] for i, start, end in held]
        begins = np.cumsum([0, *map(len, parts)])
        if begins[-1] < length:
            continue
        weight = np.zeros(begins[-1], np.uint8)
        for (i, start, end), base in zip(held, begins, strict=False):
            end = min(end, len(texts[i]) - length + 1)
            for lo, hi, kind in [(start, end, 1)] if asked is None else asked[i]:
                lo, hi = max(lo, start), min(hi, end)
                if lo < hi:
                    weight[base + lo - start : base + hi - start] = kind
        data = np.frombuffer(b"".join(parts), np.uint8)
        gram, stretch, lo, hi, kind = _runs(data, weight, size, length)
        part = np.searchsorted(begins, lo, side="right") - 1
        shift = np.array([start for _, start, _ in held]) - begins[:-1]
        owner = np.array([i for i, _, _ in held])
        yield owner[part], gram, stretch, lo + shift[part], hi + shift[part], kind


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.md5(text))


def _keyed(docs: DataFrame, text: str, length: int) -> DataFrame:
    """Key and text of the rows long enough to lose anything."""
    rows = docs.select(F.col(text).alias("text")).where(F.octet_length("text") >= length)
    return rows.select(text_key(F.col("text")).alias(TEXT_KEY), "text")


def _first_runs(texts: DataFrame, size: int, length: int) -> DataFrame:
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys, values = rows.column(0), as_bytes(rows.column(1))
            for owner, *columns in _text_runs(values, None, size, length):
                yield batch(_RUN_SCHEMA, keys.take(pa.array(owner)), *columns)

    return texts.mapInArrow(runs, _RUNS)


def _with_ranges(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each distinct text with its ranges, for the texts that have any.

    ``ranges`` holds a row per text; copies of a text are reduced to one before they meet.
    """
    wanted = texts.join(sized(ranges.select(TEXT_KEY)), TEXT_KEY, "left_semi")
    return wanted.groupBy(TEXT_KEY).agg(F.first("text").alias("text")).join(ranges, TEXT_KEY)


def _ranges_of(rows: pa.RecordBatch) -> list[list[tuple[int, ...]]]:
    """Ranges of a batch as tuples, per row."""
    column = rows.column(2)
    parts = [part.to_pylist() for part in column.flatten().flatten()]
    flat, ends = list(zip(*parts, strict=True)), column.offsets.to_pylist()
    return [
        flat[a - ends[0] : b - ends[0]] for a, b in zip(ends, ends[1:], strict=False)
    ]


def _next_runs(texts: DataFrame, ranges: DataFrame, size: int, length: int) -> DataFrame:
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys, values, asked = rows.column(0), as_bytes(rows.column(1)), _ranges_of(rows)
            for owner, *columns in _text_runs(values, asked, size, length):
                yield batch(_RUN_SCHEMA, keys.take(pa.array(owner)), *columns)

    listed = ranges.groupBy(TEXT_KEY).agg(
        F.collect_list(F.struct("lo", "hi", "weight")).alias("ranges")
    )
    return _with_ranges(texts, listed).mapInArrow(runs, _RUNS)


def _judged(runs: DataFrame) -> DataFrame:
    """The runs that share their picked string: ``many``, whether the whole stretch occurs more
    than once, and ``open``, whether the string is shared by stretches of which some do not."""
    classes = runs.groupBy(*_CLASS).agg(F.sum("weight").alias("places"))
    strings = classes.groupBy("gram").agg(
        F.count(F.lit(1)).alias("stretches"), F.min("places").alias("fewest")
    )
    # A string with one stretch in one place is unique.
    shared = strings.where("stretches > 1 OR fewest > 1").select(
        "gram", (F.col("fewest") == 1).alias("open")
    )
    verdicts = classes.join(shared, "gram").select(
        *_CLASS, (F.col("places") > 1).alias("many"), "open"
    )
    return runs.join(verdicts, _CLASS)


def _one_of_each(runs: DataFrame) -> DataFrame:
    """The least run of each class. The ranges are read more than once, so it may not depend on
    the order in which rows arrive."""
    least = runs.groupBy(*_CLASS, "weight").agg(F.min(F.struct(TEXT_KEY, "lo", "hi")).alias("run"))
    return least.select("run.*", "weight")


def repeated_ranges(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Starts of repeated strings: rows (text_key, lo, hi) of distinct texts.

    The ``length`` bytes from each of the places lo to hi - 1 also start somewhere else in the
    table. Ranges of one text do not overlap; rows of one text share its ``text_key``.
    """
    prepare(docs.sparkSession)
    texts = _keyed(docs, text, length)
    found, ranges = [], None
    for size in lengths(length):
        runs = (
            _first_runs(texts, size, length)
            if ranges is None
            else _next_runs(texts, ranges, size, length)
        )
        judged = stage_table(_judged(stage_table(runs, "runs")), "judged")
        # Runs of weight 2 were found repeated before; they are there to compare with.
        found.append(judged.where("many AND weight = 1").select(TEXT_KEY, "lo", "hi").distinct())
        going = judged.where("open").select(
            TEXT_KEY, "lo", "hi", *_CLASS, F.when(F.col("many"), 2).otherwise(1).alias("weight")
        )
        alone = going.where("weight = 1")
        known = _one_of_each(going.where("weight = 2"))
        ranges = alone.select(*known.columns).unionByName(known)
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


_CUT = "text_key binary, n_removed long, n_spans long, spans string, kept binary"
_CUT_SCHEMA = pa.schema(
    [
        ("text_key", pa.binary()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("spans", pa.string()),
        ("kept", pa.binary()),
    ]
)


def merged(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Byte spans covered by the strings that start in the ranges; touching spans are one."""
    spans: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        end = hi - 1 + length
        if spans and lo <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((lo, end))
    return spans


def cut_texts(
    docs: DataFrame, ranges: DataFrame, text: str = "text", length: int = LENGTH
) -> DataFrame:
    """One row per distinct text that loses bytes: the spans removed and the bytes kept.

    ``spans`` lists them as ``start:end``, end exclusive. The bytes kept need not be whole
    characters, so they are binary.
    """
    prepare(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: list[list] = [[] for _ in _CUT_SCHEMA]
            for key, value, own in zip(
                rows.column(0).to_pylist(), as_bytes(rows.column(1)), _ranges_of(rows), strict=True
            ):
                spans = merged(own, length)
                ends = [0, *(p for span in spans for p in span), len(value)]
                kept = b"".join(value[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                listed = ",".join(f"{a}:{b}" for a, b in spans)
                row = (key, len(value) - len(kept), len(spans), listed, kept)
                for column, item in zip(out, row, strict=True):
                    column.append(item)
            yield batch(_CUT_SCHEMA, *out)

    listed = ranges.groupBy(TEXT_KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    return _with_ranges(_keyed(docs, text, length), listed).mapInArrow(cut, _CUT)


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document what its text loses: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    cuts = cut_texts(docs, stage_table(repeated_ranges(docs, text, length), "ranges"), text, length)
    digests = cuts.select(
        TEXT_KEY, "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.octet_length(value).cast("long").alias("n_bytes"),
        text_key(value).alias(TEXT_KEY),
        F.sha2(value, 256).alias("whole_sha256"),
    )
    # Stored: read back the digests are a join side of their own, so Spark can split hot texts.
    return rows.join(stage_table(digests, "digests"), TEXT_KEY, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


