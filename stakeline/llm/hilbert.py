"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised into cells by quantiles over all rows (strings by their whole values,
in byte order), the cells of a row are a point
of a grid, and the rows are put in the order in which a Hilbert curve visits the points. Runs of
that order are the shards: rows close in all dimensions lie close together, so each shard covers a
small box of the dimensions and readers can skip files by any of them.

The law is ``rows``: shards are equal runs, so their counts are at most one apart whatever the
sizes of texts or of groups of equal texts; what is equal in all dimensions may be cut anywhere.

Nulls are a dimension's lowest cell. Rows tied on the curve are ordered by id, then text. Null
texts have size 8 and the checksum of an empty text. An empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakeline.functions.times import ntz, seconds_between
from stakeline.llm.common import numbered, slices, unused
from stakeline.sources.sinks import stage_table

SHARDS = 24
LAW = "rows"
# Bits per dimension: cells are the 2^BITS quantiles.
BITS = 6
# Bytes added to the size of a row beside its text.
ROW_BYTES = 8


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid point (one row each) along the curve.

    Works from the highest bit down: the quadrant so far turns and mirrors the axes of the ones
    below it, which leaves a Gray code whose bits, taken in turns, are the place.
    """
    axes = points.astype(np.int64).copy()
    n = axes.shape[1]
    for bit in range(bits - 1, 0, -1):
        top, below = 1 << bit, (1 << bit) - 1
        for i in range(n):
            high = (axes[:, i] & top) != 0
            swap = np.where(high, 0, (axes[:, 0] ^ axes[:, i]) & below)
            axes[:, 0] ^= np.where(high, below, swap)
            axes[:, i] ^= swap
    for i in range(1, n):
        axes[:, i] ^= axes[:, i - 1]
    flip = np.zeros(len(axes), np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(axes[:, n - 1] & (1 << bit), (1 << bit) - 1, 0)
    axes ^= flip[:, None]
    place = np.zeros(len(axes), np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((axes[:, i] >> bit) & 1)
    return place


def _is_string(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() == "string"


def _measure(df: DataFrame, dimension: str) -> Column:
    """What orders the values of a dimension: a number, a time, or the whole string."""
    value, kind = F.col(dimension), df.schema[dimension].dataType.typeName()
    if kind == "string":
        return value
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind == "timestamp":
        return F.unix_micros(value).cast("double")
    if kind == "timestamp_ntz":
        return seconds_between(ntz("1970-01-01 00:00:00"), value)
    return value.cast("double")


def _string_cuts(measured: DataFrame, column: str, parts: int) -> list[str]:
    """The values at which each further 1/parts of the rows that have one is reached.

    Rows are counted per value, and counts added up in slices of the values' order; the driver
    receives a row per slice, and one per cut at most.
    """
    spark = measured.sparkSession
    counts = measured.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).count()
    sliced = counts.repartitionByRange(slices(spark), "value")
    stored = stage_table(sliced.withColumn("slice", F.spark_partition_id()), "value_counts")
    sizes = stored.groupBy("slice").agg(F.sum("count")).orderBy("slice").collect()
    if not sizes:
        return []
    totals = np.cumsum([0, *(rows for _, rows in sizes)]).tolist()
    begins = spark.createDataFrame(
        [(number, before) for (number, _), before in zip(sizes, totals, strict=False)],
        "slice int, before bigint",
    )
    running = Window.partitionBy("slice").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    n = totals[-1]
    # Cuts reached with this value's rows, and before them.
    reached = (
        stored.withColumn("own", F.sum("count").over(running))
        .join(F.broadcast(begins), "slice")
        .withColumn("upto", F.col("own") + F.col("before"))
        .selectExpr(
            "value",
            f"least(upto * {parts} DIV {n}, {parts - 1}) AS reached",
            f"(upto - count) * {parts} DIV {n} AS reached_before",
        )
        .where("reached > reached_before")
        .collect()
    )
    return sorted(r["value"] for r in reached for _ in range(r["reached"] - r["reached_before"]))


PLACED = pa.schema([("place", pa.int64())])


def _place_batches(
    batches: Iterator[pa.RecordBatch], cuts: list[list[float] | list[str]], bits: int
) -> Iterator[pa.RecordBatch]:
    n = len(cuts)
    for rows in batches:
        cells = []
        for column, edges in zip(rows.columns[:n], cuts, strict=True):
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                found = column.dictionary_encode()
                cell = [bisect_left(edges, v) for v in found.dictionary.to_pylist()]
                which = found.indices.fill_null(len(cell)).to_numpy()
                cells.append(np.array([*cell, 0], np.int64)[which])
                continue
            values = column.to_numpy(zero_copy_only=False).astype(np.float64)
            cells.append(np.searchsorted(np.array(edges), values, side="left"))
            cells[-1][np.isnan(values)] = 0
        place = hilbert_index(np.stack(cells, axis=1), bits)
        yield pa.RecordBatch.from_arrays(
            [*rows.columns[n:], pa.array(place)], names=[*rows.schema.names[n:], "place"]
        )


def shard(
    docs: DataFrame,
    dimensions: list[str],
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard, place.

    ``dimensions`` are columns of ``docs``, or the word ``size``. Texts are read once, for size
    and checksum, and never moved; the narrow rows are written to the shared folder.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    size = (F.octet_length(content) + ROW_BYTES).cast("bigint")
    measured = stage_table(
        docs.select(
            *[
                (size.cast("double") if d == "size" else _measure(docs, d)).alias(f"d{i}")
                for i, d in enumerate(dimensions)
            ],
            F.col(doc_id).cast("bigint").alias("id"),
            size.alias("size"),
            F.crc32(content.cast("binary")).alias("text_crc32"),
        ),
        "measured",
    )
    levels = [k / (1 << bits) for k in range(1, 1 << bits)]
    names = [f"d{i}" for i in range(len(dimensions))]
    found = measured.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.percentile_approx(c, levels, 10_000).alias(c)
            for c in names
            if not _is_string(measured, c)
        ],
    ).first()
    # Equal quantiles stay: a frequent value takes up as much of its axis as it has rows, so few
    # values are spread over the whole axis.
    cuts = [
        _string_cuts(measured, c, 1 << bits)
        if _is_string(measured, c)
        else sorted(found[c] or [])
        for c in names
    ]
    placed = measured.mapInArrow(
        lambda batches: _place_batches(batches, cuts, bits),
        "id bigint, size bigint, text_crc32 bigint, place bigint",
    )
    order = ["place", "id", "text_crc32", "size"]
    ranked = numbered(placed, order, slices(docs.sparkSession), "on_the_curve")
    n = found["n"]
    # Run s holds the places from s * n / shards on, rounded up.
    number = F.expr(f"CAST(__rank * {shards} DIV {max(n, 1)} AS INT)")
    begin = F.expr(f"(CAST(__shard AS BIGINT) * {n} + {shards - 1}) DIV {shards}")
    return ranked.withColumn("__shard", number).select(
        F.col("id").alias(doc_id),
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        F.col("__shard").alias("shard"),
        (F.col("__rank") - begin).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "place",
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """Writes documents in a folder per shard, in the order of the curve.

    Ids have to be unique here. A shard of more rows than a task takes is written by several.
    Folders are named by ``shard``, or ``shard_1`` and so on where documents have such a column.
    """
    key, shard, slot = (unused(docs, name) for name in ("shard_key", "shard", "slot"))
    places = assigned.select(
        F.col(doc_id).alias(key), F.col("shard").alias(shard), F.col("slot").alias(slot)
    )
    (
        docs.join(places, docs[doc_id] == places[key])
        .drop(key)
        .repartitionByRange(shard, slot)
        .sortWithinPartitions(shard, slot)
        .drop(slot)
        .write.partitionBy(shard)
        .parquet(path)
    )
