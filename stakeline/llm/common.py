"""Helpers shared by the text operators: settings, Arrow batches, token hashing, row numbers."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stakeline.session import tune
from stakeline.sources.sinks import stage_table

# Arrow batches stay small: a task holds one batch of texts and some arrays over its bytes.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20),
}
PIECE_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of the text operators."""
    tune(spark)
    for name, value in BATCH_SETTINGS.items():
        spark.conf.set(name, value)
    _ship(spark)
    return spark


def _ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application: their tasks import it."""
    sc = spark.sparkContext
    if getattr(sc, "_stakeline_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / "stakeline.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._stakeline_shipped = True


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{table}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with a number behind it, so that no column of the table is called that."""
    taken = {c.lower() for c in df.columns}
    found, n = name, 0
    while found.lower() in taken:
        n += 1
        found = f"{name}_{n}"
    return found


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, field.type)
        for c, field in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


# --- token hashing ----------------------------------------------------------------------------

_SPACE, _WORD, _SYMBOL = 0, 1, 2
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[:33] = _SPACE
_CLASS[127] = _SPACE
for _range in (b"09", b"AZ", b"az"):
    _CLASS[_range[0] : _range[1] + 1] = _WORD
_CLASS[128:] = _WORD

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)


def _grow(n: int) -> None:
    global _UP, _DOWN
    if len(_UP) < n:
        _UP, _DOWN = _powers(_BASE, n), _powers(_INVERSE, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_tokens(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each token of a buffer.

    A token is a run of letters and digits (bytes above ASCII count as letters) or a run of one
    symbol. Hashes of all tokens come from one running polynomial over the buffer.
    """
    data = np.frombuffer(buffer, np.uint8)
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    _grow(len(data) + 1)
    kind = _CLASS[data]
    cut = np.empty(len(data), bool)
    cut[0] = True
    cut[1:] = (kind[1:] != kind[:-1]) | ((kind[1:] == _SYMBOL) & (data[1:] != data[:-1]))
    bounds = np.append(np.flatnonzero(cut), len(data))
    starts, ends = bounds[:-1], bounds[1:]
    inside = kind[starts] != _SPACE
    starts, ends = starts[inside], ends[inside]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * _DOWN[starts])


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Texts in buffers of bounded size; a longer text is cut at white space."""
    piece, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        if len(text) > PIECE_BYTES and piece:
            yield piece
            piece, size = [], 0
        while len(text) - at > PIECE_BYTES:
            end = at + PIECE_BYTES
            space = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
            end = space + 1 if space > at else end
            yield [(i, text[at:end])]
            at = end
        if size + len(text) - at > PIECE_BYTES and piece:
            yield piece
            piece, size = [], 0
        piece.append((i, text[at:]))
        size += len(text) - at
    if piece:
        yield piece


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts in order, and the number of the text each lies in."""
    hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for piece in _pieces(texts):
        begins = np.cumsum([0, *(len(t) + 1 for _, t in piece)])
        starts, found = _hash_tokens(b"\n".join(t for _, t in piece))
        number = np.array([i for i, _ in piece])
        hashes.append(found)
        owners.append(number[np.searchsorted(begins, starts, side="right") - 1])
    return np.concatenate(hashes), np.concatenate(owners)


# --- global row numbers -----------------------------------------------------------------------

CHUNK = "__chunk"


def numbered(df: DataFrame, order: list[str], chunks: int, name: str) -> DataFrame:
    """Adds ``__rank``, the row's place from 0 in the global order, without a global sort task.

    Rows are range-partitioned on the order and written with the number of their slice; ranks
    are the place inside the slice plus the sizes of the slices before it. What is broadcast is
    one row per slice.
    """
    sliced = df.repartitionByRange(chunks, *order).withColumn(CHUNK, F.spark_partition_id())
    stored = stage_table(sliced, name)
    sizes = stored.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        CHUNK, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before")
    )
    place = F.row_number().over(Window.partitionBy(CHUNK).orderBy(*order)) - 1
    return (
        stored.withColumn("__place", place)
        .join(F.broadcast(offsets), CHUNK)
        .withColumn("__rank", F.col("__before") + F.col("__place"))
        .drop(CHUNK, "__before", "__place")
    )


def slices(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BROADCAST_ROWS = 1_000_000


def sized(narrow: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a table of a few narrow columns for broadcast if a count shows it is small.

    A larger one is left to Spark, which then shuffles both sides of a join.
    """
    return F.broadcast(narrow) if narrow.count() <= most else narrow
