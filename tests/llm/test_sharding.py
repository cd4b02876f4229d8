from __future__ import annotations

import zlib

import numpy as np
import pytest
from fixtures import FOLDER, documents

from stakeline.llm import hilbert
from stakeline.llm.common import prepare, read

DIMENSIONS = ["lang", "source", "size"]


@pytest.mark.parametrize(("axes", "bits"), [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_point_by_single_steps(axes, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1)
    grid = grid.reshape(-1, axes)
    place = hilbert.hilbert_index(grid, bits)
    assert sorted(place) == list(range(len(grid)))
    steps = np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


@pytest.mark.parametrize("source", ["table", "odd", "copies"])
def test_law(spark, source):
    prepare(spark)
    if source == "table":
        docs = read(spark, FOLDER, "documents")
    elif source == "odd":
        docs = documents(spark)
    else:
        docs = documents(spark, [(i % 7, "same") for i in range(500)])
    rows = hilbert.shard(docs, DIMENSIONS).collect()
    want = []
    for r in docs.collect():
        data = (r.text or "").encode()
        want.append((r.doc_id, len(data) + 8, zlib.crc32(data)))
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in rows], key=str) == sorted(want, key=str)
    counts = np.bincount([r.shard for r in rows], minlength=24)
    assert len(counts) == 24 and counts.max() - counts.min() <= 1
    for s in range(24):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    # Shards are runs of the curve.
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.place for r in ordered] == sorted(r.place for r in rows)


def test_shards_cover_small_boxes(spark):
    docs = read(spark, FOLDER, "documents")
    found = hilbert.shard(docs, DIMENSIONS).select("doc_id", "shard").join(docs, "doc_id").collect()
    langs = [len({r.lang for r in found if r.shard == s}) for s in range(24)]
    sources = [len({r.source for r in found if r.shard == s}) for s in range(24)]
    # Spread at random a shard would hold all four languages and most of the twenty sources.
    assert np.mean(langs) < 3 and np.mean(sources) < 13


def test_strings_are_cut_by_their_whole_values(spark):
    prepare(spark)
    values = [f"https://example.org/{'é' * 30}/{k:02}" for k in range(16)]
    rows = [(i, "same", values[i % 16]) for i in range(640)] + [(i, "same", None) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = hilbert.shard(docs, ["source"], shards=11).join(
        docs.select("doc_id", "source"), "doc_id"
    )
    of_source = found.where("doc_id >= 64").groupBy("source").agg({"place": "min"}).collect()
    # Sixteen sources of equal size: every fourth of 64 cells, in the order of the sources.
    assert [place for _, place in sorted(of_source)] == list(range(0, 64, 4))


@pytest.mark.parametrize("rows", [[], [None], ["b"], ["a"] * 3 + ["b"] * 40 + ["c"] + [None] * 9])
def test_string_cuts_by_brute_force(spark, rows):
    prepare(spark)
    table = spark.createDataFrame([(v,) for v in rows], "d string")
    values = sorted(v for v in rows if v is not None)
    want = [values[-(-k * len(values) // 8) - 1] for k in range(1, 8)] if values else []
    assert hilbert._string_cuts(table, "d", 8) == want


def test_written_shards_hold_all_rows_in_order(spark, tmp_path):
    docs = read(spark, FOLDER, "documents")
    hilbert.write_shards(docs, hilbert.shard(docs, DIMENSIONS, shards=3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("shard").exceptAll(docs).isEmpty() and back.count() == docs.count()
    assert back.select("shard").distinct().count() == 3


def test_times_are_dimensions(spark):
    prepare(spark)
    docs = spark.range(480).selectExpr(
        "id AS doc_id", "'same' AS text",
        "date_add(DATE'2024-01-01', CAST(pmod(id * 7, 480) AS INT)) AS day",
        "TIMESTAMP_NTZ'1969-12-01 00:00:00' + make_dt_interval(0, pmod(id * 7, 480)) AS hour",
        "TIMESTAMP'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, pmod(id * 7, 480)) AS second",
    )
    for dimension in ("day", "hour", "second"):
        rows = hilbert.shard(docs, [dimension]).collect()
        # Shards follow time, but for the rows of one cell of the axis.
        for s in range(24):
            places = [r.doc_id * 7 % 480 for r in rows if r.shard == s]
            assert len(places) == 20 and max(places) - min(places) < 60


def test_written_shards_keep_all_columns(spark, tmp_path):
    prepare(spark)
    docs = spark.range(100).selectExpr(
        "id AS doc_id", "'t' AS text", "'own' AS shard", "'own' AS slot", "'own' AS __id",
        "'own' AS __slot", "'own' AS shard_key",
    )
    assigned = hilbert.shard(docs, ["doc_id"])
    hilbert.write_shards(docs, assigned, str(tmp_path / "out"))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(found.columns) == sorted([*docs.columns, "shard_1"])
    want = {(r.doc_id, r.shard) for r in assigned.collect()}
    assert {(r.doc_id, r.shard_1) for r in found.where("shard = 'own' AND slot = 'own'").collect()} == want
