from __future__ import annotations

import pytest
from ledger import at, ledger

from stakeline.operators import enrich
from stakeline.operators.asof import asof_last
from stakeline.plans.jobs import attach_dims_job

BETS = "customer_id long, csn_game_id long, played_date timestamp_ntz, update_date timestamp_ntz"


def games(df):
    return {r.customer_transaction_id: r.csn_game_id for r in df.collect()}


@pytest.fixture()
def bets(spark):
    rows = [
        (1, 7, at("10:00:00"), at("10:30:00")),
        (1, 9, at("10:00:00"), at("10:30:00")),
        (1, 4, at("11:00:00"), at("11:30:00")),
        (None, 5, at("12:00:00"), at("12:00:00")),
        (2, 6, None, None),
    ]
    return spark.createDataFrame(rows, BETS)


@pytest.fixture()
def rows(spark):
    return ledger(
        spark,
        [
            (1, 1, "10:00:00", 1, 1, 3),  # bet with a game: overwritten
            (2, 1, "10:00:00", 2, 1, 3),  # not a bet: kept
            (3, 1, "10:30:00", 2, 1, None),  # filled from the update time
            (4, 1, "10:30:00", 2, 1, 3),  # has a game: kept
            (5, 1, "10:30:00", 3, 1, None),  # not a core type: stays null
            (6, 1, "10:30:00", None, 1, None),
            (7, 2, "10:00:00", 1, 1, None),  # other customer
            (8, None, "12:00:00", 1, 1, None),
            (9, 2, None, 1, 1, None),
        ],
    )


def test_overwrite(rows, bets):
    want = {1: 9, 2: 3, 3: None, 4: 3, 5: None, 6: None, 7: None, 8: None, 9: None}
    assert games(enrich.update_overwrite(rows, bets)) == want


def test_overwrite_with_a_missing_game(spark, rows):
    bets = spark.createDataFrame([(1, None, at("10:00:00"), at("10:30:00"))], BETS)
    assert games(enrich.update_overwrite(rows, bets))[1] is None
    assert games(enrich.update_fill_null(rows, bets))[4] == 3


def test_fill_null(rows, bets):
    want = {1: 3, 2: 3, 3: 9, 4: 3, 5: None, 6: None, 7: None, 8: None, 9: None}
    assert games(enrich.update_fill_null(rows, bets)) == want


def test_one_join_equals_two(rows, bets):
    two = enrich.update_fill_null(enrich.update_overwrite(rows, bets), bets)
    assert games(enrich.fill_from_bets(rows, bets)) == games(two)


def test_fill_forward_cases(spark):
    rows = ledger(
        spark,
        [
            (1, 1, "10:00:00", 1, 1, 5),
            (2, 1, "10:00:00", 1, 1, None),  # donor at the same time only
            (3, 1, "10:01:00", 1, 1, None),
            (4, 1, "10:02:00", 1, 1, None),  # chain: both take the donor's
            (5, 1, "10:03:00", 2, 1, None),  # donor of another type
            (6, 2, "10:03:00", 1, 1, None),  # donor of another customer
            (7, 1, "10:04:00", 3, 1, 8),
            (8, 1, "10:05:00", 3, 1, None),  # not a core type
            (9, 1, "10:00:00", 1, 1, 2),  # tie among donors: greatest game
        ],
    )
    want = {1: 5, 2: None, 3: 5, 4: 5, 5: None, 6: None, 7: 8, 8: None, 9: 2}
    assert games(enrich.fill_forward(rows)) == want


def test_attach_dims(spark):
    sessions = spark.createDataFrame(
        [(1, 10, "old", "old"), (2, 11, "old", "old"), (3, None, "old", "old"), (4, 12, "old", "old")],
        "sessionid long, csn_game_id long, category string, vendor_game_name string",
    )
    names = spark.createDataFrame(
        [(10, "g10", 1), (11, "g11", 99), (12, "a", 1), (12, "b", 2)],
        "csn_game_id long, vendor_game_name string, csn_category_id long",
    )
    categories = spark.createDataFrame([(1, "slots"), (2, "cards")], "category_id long, category_name string")
    got = {
        r.sessionid: (r.category, r.vendor_game_name)
        for r in attach_dims_job(sessions, names, categories).collect()
    }
    # A game without category overwrites with null; no dimension row keeps the old values.
    assert got == {1: ("slots", "g10"), 2: (None, "g11"), 3: ("old", "old"), 4: ("cards", "b")}
    with pytest.raises(ValueError, match="vendor_game_name"):
        attach_dims_job(sessions.drop("vendor_game_name"), names, categories)


def test_dim_lookup_only_wanted_ids(spark):
    names = spark.createDataFrame(
        [(1, "a", 1), (1, "a", 1), (2, "b", None), (3, "c", 1)],
        "csn_game_id long, vendor_game_name string, csn_category_id long",
    )
    categories = spark.createDataFrame([(1, "slots")], "category_id long, category_name string")
    ids = spark.createDataFrame([(1,), (2,), (None,), (77,)], "csn_game_id long")
    got = {tuple(r) for r in enrich.dim_lookup(names, categories, ids).collect()}
    assert got == {(1, "slots", "a"), (2, None, "b")}


def test_asof_equal_time_and_null_value(spark):
    logins = spark.createDataFrame(
        [(1, 1, at("10:00:00"), "a"), (2, 1, at("11:00:00"), None), (3, 2, at("12:00:00"), "z")],
        "log_id long, customer_id long, date_time timestamp_ntz, ip string",
    )
    bets = spark.createDataFrame(
        [(1, 1, at("10:00:00")), (2, 1, at("11:30:00")), (3, 1, at("09:00:00")), (4, None, at("12:00:00"))],
        "bet long, customer_id long, made timestamp_ntz",
    )
    got = asof_last(bets, logins, "customer_id", "made", "date_time", "ip", "ip_address", "log_id")
    assert {r.bet: r.ip_address for r in got.collect()} == {1: "a", 2: None, 3: None, 4: None}
    # Without a tiebreak the greatest value of equally late rows is taken.
    tied = logins.union(spark.createDataFrame([(4, 1, at("10:00:00"), "b")], logins.schema))
    got = asof_last(bets, tied, "customer_id", "made", "date_time", "ip", "ip_address")
    assert {r.bet: r.ip_address for r in got.collect()}[1] == "b"
