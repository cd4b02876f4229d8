"""Chunked work on hot keys against plain Python, and the properties of session ids."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import timedelta

import pytest
from ledger import at, ledger
from pyspark.sql import functions as F

from stakeline.operators import asof, enrich, lanes, sessions
from stakeline.operators.asof import asof_last
from stakeline.operators.enrich import fill_forward
from stakeline.operators.quality import duplicate_report
from stakeline.params import SkewPolicy, TimeWindow
from stakeline.plans.jobs import session_summary_job

ALL = TimeWindow.of("2024-01-01 00:00:00", "2025-12-31 23:59:59")
TINY = SkewPolicy(max_rows=40)


def make_rows(seed: int, spread_minutes: int, count: int = 600):
    """Customer 1 has a third of the rows, customer 2 a sixth; few distinct times make ties."""
    rng = random.Random(seed)
    rows = []
    for txn in range(count):
        customer = rng.choice([1, 1, 2, *rng.sample(range(3, 60), 3)])
        time = at("06:00:00") + timedelta(minutes=rng.randrange(spread_minutes) * 7)
        kind = rng.choice([1, 2, 8, 15, 3, None])
        game = rng.choice([None, 1, 1, 2, 3])
        rows.append((txn, customer, time, kind, rng.choice([None, 0, 5]), game))
    return rows


def expected_sessions(rows, shared: bool, gap: float = 1200):
    rows = sorted((r for r in rows if r[5] is not None), key=lambda r: (r[1], r[2], r[0]))
    number, ids, last, previous = 0, {}, {}, None
    for row in rows:
        if (
            previous is None
            or previous[1] != row[1]
            or (row[2] - previous[2]).total_seconds() > gap
            or previous[5] != row[5]
        ):
            number += 1
        ids[row[0]] = number
        last[row[1], row[2]] = number
        previous = row
    if shared:
        return {r[0]: last[r[1], r[2]] for r in rows}
    return ids


CASES = [(1, 400), (2, 30), (3, 5), (4, 1)]


@pytest.mark.parametrize("seed, spread", CASES)
@pytest.mark.parametrize("shared", [True, False])
@pytest.mark.parametrize("skew", [TINY, SkewPolicy()], ids=["split", "whole"])
def test_session_ids(spark, seed, spread, shared, skew):
    rows = make_rows(seed, spread)
    df = ledger(spark, rows)
    if shared:
        got = sessions.process_sessions(df, ALL, skew=skew)
        ids = {r.transaction_id: r.id_sessao for r in got.collect()}
    else:
        got = sessions.frame_sessions(df, ALL, 0, skew=skew)
        ids = {r.customer_transaction_id: r.sessionid for r in got.collect()}
    assert ids == expected_sessions(rows, shared)


def test_summary_job_split_equals_whole(spark):
    df = ledger(spark, make_rows(5, 30))
    split = session_summary_job(df, ALL, 7, skew=TINY)
    whole = session_summary_job(df, ALL, 7)
    for one, other in zip(split, whole):
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    ids = sessions.frame_sessions(df, ALL, 7).select("csn_customer_id", "sessionid").distinct()
    assert whole.summary.select("csn_customer_id", "sessionid").exceptAll(ids).isEmpty()
    assert whole.summary.count() == ids.count()


def test_numbering_does_not_move_chunked_rows(spark):
    """The rows of a hot customer are joined to its shift where they are."""
    df = ledger(spark, make_rows(5, 30))
    plan = sessions.process_sessions(df, ALL, skew=TINY)._jdf.queryExecution().toString()
    for line in plan.split("== Physical Plan ==")[1].splitlines():
        assert "SortMergeJoin" not in line or "_chunk" not in line
    hot_side = [part for part in plan.split("Union") if "_chunk" in part]
    assert hot_side and "BroadcastHashJoin" in hot_side[-1]


def test_known_hot_customers(spark):
    rows = make_rows(6, 20)
    hot = lanes.HotKeys(sessions.CUSTOMER, [(1,), (2,), (999,)])
    got = sessions.process_sessions(ledger(spark, rows), ALL, hot=hot)
    ids = {r.transaction_id: r.id_sessao for r in got.collect()}
    assert ids == expected_sessions(rows, shared=True)


def test_session_id_properties(spark):
    rows = sessions.process_sessions(ledger(spark, make_rows(9, 50)), ALL, skew=TINY).collect()
    rows.sort(key=lambda r: (r.csn_customer_id, r.transaction_date))
    ids = [r.id_sessao for r in rows]
    assert ids == sorted(ids)
    owners = defaultdict(set)
    for row in rows:
        owners[row.id_sessao].add(row.csn_customer_id)
    assert all(len(found) == 1 for found in owners.values())
    assert max(ids) == sum(r.nova_sessao for r in rows)


def test_ids_equal_those_of_one_global_window(spark):
    df = ledger(spark, make_rows(11, 40))
    numbered = sessions.process_sessions(df, ALL, skew=TINY)
    whole = sessions.Window.orderBy("csn_customer_id", "transaction_date")
    again = numbered.withColumn("again", F.sum(F.col("nova_sessao").cast("int")).over(whole))
    assert again.where("again <> id_sessao").isEmpty()


@pytest.mark.parametrize("seed, spread", CASES)
@pytest.mark.parametrize("skew", [SkewPolicy(max_rows=12), SkewPolicy()], ids=["split", "whole"])
def test_fill_forward(spark, seed, spread, skew):
    rows = make_rows(seed, spread)
    want = {}
    for txn, customer, time, kind, _, game in rows:
        if game is None and kind in (1, 2, 8, 15):
            donors = [
                (r[2], r[5])
                for r in rows
                if r[1] == customer and r[3] == kind and r[2] < time and r[5] is not None
            ]
            game = max(donors)[1] if donors else None
        want[txn] = game
    got = fill_forward(ledger(spark, rows), skew).collect()
    assert {r.customer_transaction_id: r.csn_game_id for r in got} == want


@pytest.mark.parametrize("seed, spread", CASES)
@pytest.mark.parametrize("skew", [TINY, SkewPolicy()], ids=["split", "whole"])
def test_asof(spark, seed, spread, skew):
    rng = random.Random(seed)
    start = at("06:00:00")

    def moments(count):
        return [
            (i, rng.choice([None, 1, 1, 2, 3]), start + timedelta(minutes=rng.randrange(spread)))
            for i in range(count)
        ]

    bets = moments(200)
    logins = [(*m, rng.choice([None, "a", "b", "c"])) for m in moments(300)]
    want = {}
    for i, customer, time in bets:
        hits = [(m[2], m[0], m[3]) for m in logins if m[1] == customer and m[2] <= time]
        want[i] = max(hits)[2] if hits and customer is not None else None
    left = spark.createDataFrame(bets, "bet long, customer long, made timestamp_ntz")
    right = spark.createDataFrame(logins, "log long, customer long, at timestamp_ntz, ip string")
    got = asof_last(left, right, "customer", "made", "at", "ip", "found", "log", skew)
    assert {r.bet: r.found for r in got.collect()} == want
    assert got.count() == len(bets)


@pytest.mark.parametrize("skew", [TINY, SkewPolicy()], ids=["split", "whole"])
def test_duplicates(spark, skew):
    rows = [(i, 1 if i < 100 else i // 2 if i < 120 else i) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, key long")
    got = {r.id for r in duplicate_report(df, ("key",), skew).collect()}
    assert got == set(range(120))


def test_duplicates_with_known_hot_keys(spark):
    rows = [(i, 1 if i < 100 else 2, i % 90) for i in range(130)]
    df = spark.createDataFrame(rows, "id long, owner long, part long")
    hot = lanes.find_hot(df, ("owner",), TINY)
    assert hot.values == [(1,)]
    got = {r.id for r in duplicate_report(df, ("owner", "part"), hot=hot).collect()}
    assert got == {i for i in range(100) if i % 90 < 10}


def test_find_hot_ignores_nulls_and_small_keys(spark):
    df = spark.createDataFrame([(None,)] * 100 + [(1,)] * 41 + [(2,)] * 40, "key long")
    assert lanes.find_hot(df, ("key",), TINY).values == [(1,)]


def test_chunks_split_one_time(spark):
    """All rows of a customer at one time still spread over chunks of similar size."""
    df = ledger(spark, [(i, 1, "10:00:00", 1, 1, 1) for i in range(400)])
    (_, split) = lanes.lanes(df, sessions.CUSTOMER, sessions.TIME_ORDER, TINY)
    sizes = [r["count"] for r in split.df.groupBy(lanes.CHUNK).count().collect()]
    assert sum(sizes) == 400 and len(sizes) >= 10 and max(sizes) <= 80


def sizes_of(split) -> list[int]:
    return [r["count"] for r in split.df.groupBy(lanes.CHUNK).count().collect()]


def test_chunks_of_the_other_orders_split_one_time(spark, monkeypatch):
    """Fill-forward and as-of rows of a customer at one time spread over chunks as well."""
    seen = []
    whole = lanes.lanes

    def watch(*args, **options):
        found = whole(*args, **options)
        seen.extend(sizes_of(lane) for lane in found if lane.chunked)
        return found

    monkeypatch.setattr(enrich, "lanes", watch)
    monkeypatch.setattr(asof, "lanes", watch)
    rows = [(i, 1, "10:00:00", 1, 1, 5 if i == 7 else None) for i in range(400)]
    filled = enrich.fill_forward(ledger(spark, rows), TINY)
    assert [r.csn_game_id for r in filled.collect()].count(None) == 399
    bets = spark.createDataFrame([(i, 1, at("10:00:00")) for i in range(400)],
                                 "bet long, customer long, made timestamp_ntz")
    logins = spark.createDataFrame([(1, 1, at("10:00:00"), "a")],
                                   "log long, customer long, at timestamp_ntz, ip string")
    got = asof_last(bets, logins, "customer", "made", "at", "ip", "found", "log", TINY)
    assert [r.found for r in got.collect()] == ["a"] * 400
    assert len(seen) == 2
    for sizes in seen:
        assert sum(sizes) >= 400 and max(sizes) <= 2 * TINY.max_rows


@pytest.mark.parametrize("skew", [TINY, SkewPolicy()], ids=["split", "whole"])
def test_repeated_ids_of_a_customer(spark, skew):
    """Rows of one customer, time and id but other games: the order stays total."""
    rng = random.Random(4)
    rows = [
        (i // 4, rng.choice([1, 1, 2, 3]), at("10:00:00") + timedelta(minutes=i // 40), 1, 1,
         rng.randrange(3))
        for i in range(600)
    ]
    df = ledger(spark, rows).repartition(16)
    found = sessions.frame_sessions(df, ALL, 0, skew=skew).collect()
    assert max(r.sessionid for r in found) == sum(r.nova_sessao for r in found)
    owners = defaultdict(set)
    for r in found:
        owners[r.sessionid].add(r.csn_customer_id)
    assert all(len(x) == 1 for x in owners.values()) and len(owners) == max(owners)


def test_hot_keys_are_found_on_a_sample(spark):
    skew = SkewPolicy(max_rows=20_000, sample_rows=1_000)
    assert skew.fraction < 1
    df = spark.range(100_000).selectExpr("CASE WHEN id < 60000 THEN 1 ELSE id END AS key")
    hot = lanes.find_hot(df, ("key",), skew)
    assert hot.values == [(1,)] and 50_000 < hot.rows < 70_000


def test_hot_keys_among_others(spark):
    hot = lanes.HotKeys(("key",), [(1,), (2,), (3,)], 99.0)
    df = spark.createDataFrame([(2,), (2,), (5,), (None,)], "key bigint")
    assert hot.among(df) == lanes.HotKeys(("key",), [(2,)], 99.0)


def test_long_lists_of_hot_keys_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lanes, "MOST_LISTED", 2)
    df = spark.range(10).withColumnRenamed("id", "key")
    for n, sent in ((2, True), (3, False)):
        hot = lanes.HotKeys(("key",), [(i,) for i in range(n)])
        cold, rest = hot.split(df)
        assert ("rightHint=(strategy=broadcast" in cold._jdf.queryExecution().toString()) == sent
        assert cold.count() == 10 - n and rest.count() == n


@pytest.mark.parametrize("seed", [1, 2])
def test_running_total_over_any_ids(spark, seed):
    rng = random.Random(seed)
    keys = {rng.randrange(-(2**62), 2**62) for _ in range(50)}
    keys |= {rng.randrange(0, 2**43) for _ in range(50)} | set(range(2**20 - 20, 2**20 + 20))
    values = {key: rng.randrange(1, 9) for key in keys}
    df = spark.createDataFrame(list(values.items()), "key long, n long")
    got = {r.key: r.upto for r in sessions.running_total(df, "key", "n", "upto").collect()}
    want, total = {}, 0
    for key in sorted(values):
        total += values[key]
        want[key] = total
    assert got == want
