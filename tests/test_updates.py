"""Updates of stored tables: right values, and untouched folders keep their files."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pytest
from ledger import at, ledger

from stakeline.operators import enrich
from stakeline.plans import updates
from stakeline.sources import sinks
from test_enrich import BETS, games


def files(path):
    """Data files by folder, with the time they were written."""
    found = {}
    for file in Path(path).rglob("*.parquet"):
        found.setdefault(file.parent.name, set()).add((file.name, file.stat().st_mtime_ns))
    return found


@pytest.fixture()
def stored(spark, tmp_path):
    rows = [
        (i, i % 4, at("10:00:00") + timedelta(hours=6 * i), [1, 2, 3][i % 3], 1, [None, 5][i % 2])
        for i in range(40)
    ]
    rows += [(90, 1, None, 1, 1, None), (91, None, "10:00:00", 1, 1, None)]
    table = ledger(spark, rows)
    path = str(tmp_path / "ledger")
    sinks.append_table(sinks.with_day(table), path, by=sinks.DAY)
    return table, path


def bets(spark, *rows):
    return spark.createDataFrame([(c, g, p, u) for c, g, p, u in rows], BETS)


def test_only_days_with_changed_rows_are_rewritten(spark, stored):
    table, path = stored
    early, late = at("10:00:00"), at("10:00:00") + timedelta(hours=6 * 24)
    found = bets(
        spark,
        (0, 7, early, None),  # a bet: overwritten
        (0, 8, None, late),  # a bet without a game: filled
        (3, 9, early + timedelta(days=3), None),  # matches no row
        (1, 5, early + timedelta(hours=6 * 9), None),  # the bet has that game already
        (None, 5, early, early),
    )
    before = files(path)
    days = updates.update_stored_games(spark, path, found)
    assert days == [date(2024, 10, 7), date(2024, 10, 13)]
    after = files(path)
    assert {d for d in before if before[d] != after[d]} == {f"business_day={d}" for d in days}
    want = games(enrich.fill_from_bets(table, found))
    assert games(spark.read.parquet(path)) == want and want[0] == 7 and want[24] == 8
    # Repeated, it finds nothing to change.
    assert updates.update_stored_games(spark, path, found) == []
    assert files(path) == after


def test_no_bets_touch_nothing(spark, stored):
    before = files(stored[1])
    assert updates.update_stored_games(spark, stored[1], bets(spark).limit(0)) == []
    assert files(stored[1]) == before


DIM = "csn_game_id long, game_category string, vendor_name string"


def attributes(spark, path):
    return {
        r.sessionid: (r.category, r.vendor_game_name) for r in spark.read.parquet(path).collect()
    }


def test_lookup_rewrites_buckets_of_changed_games(spark, tmp_path):
    path, applied = str(tmp_path / "facts"), str(tmp_path / "applied")
    facts = spark.createDataFrame(
        [(i, None if i % 10 == 9 else i % 10, "old", "old") for i in range(100)],
        "sessionid long, csn_game_id long, category string, vendor_game_name string",
    )
    updates.store_by_game(facts, path, 8)
    dim = [(g, f"c{g}", f"v{g}") for g in range(6)] + [(50, "no", "facts"), (None, "x", "x")]
    first = updates.apply_lookup(spark, path, spark.createDataFrame(dim, DIM), applied, 8)
    assert first
    want = {i: (f"c{i % 10}", f"v{i % 10}") if i % 10 < 6 else ("old", "old") for i in range(100)}
    assert attributes(spark, path) == want
    # Unchanged: nothing is written, neither facts nor lookup.
    before, logged = files(path), files(applied)
    assert updates.apply_lookup(spark, path, spark.createDataFrame(dim, DIM), applied, 8) == []
    assert files(path) == before and files(applied) == logged
    # One game changes to a null, one leaves the lookup, one comes.
    dim = [(0, None, "v0"), *dim[1:5], (6, "c6", "v6")]
    third = updates.apply_lookup(spark, path, spark.createDataFrame(dim, DIM), applied, 8)
    after = files(path)
    assert {f for f in before if before[f] != after[f]} == {f"game_bucket={b}" for b in third}
    assert 0 < len(third) <= 2
    for i in range(100):
        want[i] = {0: (None, "v0"), 6: ("c6", "v6")}.get(i % 10, want[i])
    assert attributes(spark, path) == want
    # The game that left is still known: it comes back unchanged.
    dim.append((5, "c5", "v5"))
    assert updates.apply_lookup(spark, path, spark.createDataFrame(dim, DIM), applied, 8) == []


def test_facts_need_the_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="vendor_game_name"):
        updates.store_by_game(spark.sql("SELECT 1L AS csn_game_id, '' AS category"), str(tmp_path), 2)
