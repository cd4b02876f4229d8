from __future__ import annotations

import json
from datetime import timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from ledger import at, ledger
from pyspark.sql import functions as F

from stakeline.operators import summary
from stakeline.params import FIRST_SESSION_ID, TimeWindow
from stakeline.plans.jobs import (
    OTHER,
    SUMMARY,
    load_sessions,
    loaded_sessions,
    session_summary_job,
)
from stakeline.sources.commits import Load, LoadedTables, LoadTaken
from stakeline.sources.sinks import keep, stage_table, staging

DAY = TimeWindow.of("2024-10-07 06:00:00", "2024-10-08 05:59:59")


def one(spark, rows):
    return session_summary_job(ledger(spark, rows), DAY, 10).summary.collect()


def test_counts_and_money(spark):
    rows = [
        (1, 1, "10:00:00", 1, 9, 5),
        (2, 1, "10:01:00", 2, 3, 5),
        (3, 1, "10:02:00", 8, 2, 5),
        (4, 1, "10:03:00", 15, 0, 5),
        (5, 1, "10:04:00", 15, None, 5),
        (6, 1, "10:05:00", 15, 5, 5),
        (7, 1, "10:06:00.5", 3, 100, 5),
        (8, 1, "10:06:00.5", None, 100, 5),
    ]
    (row,) = one(spark, rows)
    assert (row.csn_customer_id, row.sessionid, row.csn_game_id) == (1, 11, 5)
    assert (row.quantidade_apostas, row.quantidade_ganhos) == (1, 2)
    assert (row.quantidade_recompensas_pagas, row.quantidade_recompensas_nao_pagas) == (1, 1)
    assert (row.total_apostas, row.total_ganhos, row.total_recompensas) == (9.0, 5.0, 5.0)
    assert row.quantidade_recompensas == '["6"]'
    assert row.session_start == at("10:00:00") and row.session_duration_seconds == 360.5
    # Net loss, yet the label looks at gross wins.
    assert (row.ganhos_jogador, row.perda_jogador) == (0.0, 4.0)
    assert row.result_session == "ganho"


def test_rewards_are_listed_in_time_order(spark):
    rows = [(i, 1, f"10:{59 - i}:00", 15, 1, 5) for i in (30, 4, 12)]
    (row,) = one(spark, rows)
    assert json.loads(row.quantidade_recompensas) == ["30", "12", "4"]


def test_unknown_amounts(spark):
    (row,) = one(spark, [(1, 1, "10:00:00", 1, None, 5), (2, 1, "10:01:00", 15, None, 5)])
    assert (row.total_apostas, row.total_ganhos, row.total_recompensas) == (0.0, 0.0, 0.0)
    assert row.result_session == "perda" and row.quantidade_recompensas == "[]"
    assert row.quantidade_recompensas_pagas == row.quantidade_recompensas_nao_pagas == 0


def test_other_types_keep_rows_without_type(spark):
    rows = [
        (1, 1, "10:00:00", 1, 1, 5),
        (2, 1, "10:01:00", 3, 7, 5),
        (3, 1, "10:02:00", None, 8, 5),
    ]
    df = ledger(spark, rows)
    other = session_summary_job(df, DAY, 10).other.collect()
    assert {(r.csn_customer_id, r.sessionid, r.type, r.total_amount) for r in other} == {
        (1, 11, 3, 7.0),
        (1, 11, None, 8.0),
    }
    flags = summary.with_type_flags(df).where("csn_cust_transaction_type_id is null").first()
    assert not any(flags[c] for c in ("is_aposta", "is_ganho", "is_recompensa"))


@pytest.mark.parametrize(
    ("kind", "amounts", "want"),
    [
        ("double", [0.29] * 10, "2.90"),
        ("double", [1.15, 4.35, None], "5.50"),
        ("float", [0.5, 0.25], "0.75"),
        ("float", [0.29] * 10, "2.90"),
        ("float", [16777216.0, 1e-3], "16777216.001"),
        ("double", [1e15, 0.1234567891], "1000000000000000.1234567891"),
        ("decimal(18,4)", ["0.0050"] * 100 + [None], "0.50"),
        ("decimal(18,2)", ["0.29", None, "-0.01"], "0.28"),
        ("decimal(9,3)", ["0.001"] * 7, "0.007"),
        ("decimal(38,18)", ["0.000000000000000001", "1"], "1.000000000000000001"),
        ("decimal(18,18)", ["0.999999999999999999"] * 20, "19.99999999999999998"),
        ("long", [3, None, 4], "7"),
        ("double", [None], "0"),
    ],
)
def test_sums_are_exact(spark, kind, amounts, want):
    exact = kind.startswith("decimal")
    rows = [(i, Decimal(a) if exact and a is not None else a) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, f"customer_transaction_id long, amount_from_balance {kind}")
    for column in ("csn_customer_id", "sessionid", "csn_game_id", "csn_cust_transaction_type_id"):
        df = df.withColumn(column, F.lit(1).cast("long"))
    df = df.withColumn("transaction_date", F.lit(at("10:00:00")))
    row = summary.with_session_metrics(summary.session_summary(df)).first()
    assert row.total_apostas == row.perda_jogador == Decimal(want)
    assert row.total_ganhos == row.ganhos_jogador == 0


def test_digits_that_amounts_have_no_room_for(spark):
    df = ledger(spark, [(1, 1, "10:00:00", 1, 1, 1)])
    for kind, amount in (("double", 0.12345678901), ("float", 1e-12), ("double", float("nan"))):
        odd = df.withColumn("amount_from_balance", F.lit(amount).cast(kind))
        with pytest.raises(Exception, match="does not fit|CAST_INVALID_INPUT"):
            session_summary_job(odd, DAY).summary.collect()


def test_amounts_must_be_numbers(spark):
    df = ledger(spark, [(1, 1, "10:00:00", 1, 1, 1)])
    text = df.withColumn("amount_from_balance", F.col("amount_from_balance").cast("string"))
    with pytest.raises(TypeError, match="must be a number"):
        session_summary_job(text, DAY)


def test_loads_in_a_row(spark, tmp_path):
    rows = [(i, i % 3, at("10:00:00") + timedelta(hours=i), [1, 3][i % 2], 1, 1) for i in range(12)]
    rows.append((50, 1, "10:30:00", 1, 1, None))
    table = ledger(spark, rows)
    root = str(tmp_path / "sessions")
    empty = TimeWindow.of("2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert load_sessions(table, empty, root) == (0, dict.fromkeys(
        ("transaction_date", "csn_customer_id", "csn_game_id"), 0), 0, None, False)
    assert not (tmp_path / "sessions").exists()
    one = TimeWindow.of("2024-10-07 06:00:00", "2024-10-07 14:59:59")
    two = TimeWindow.of("2024-10-07 15:00:00", "2024-10-08 05:59:59")
    first = load_sessions(table, one, root)
    assert first.rows == 6 and first.nulls["csn_game_id"] == 1 and first.repeated == 0
    assert first.start_id == FIRST_SESSION_ID
    assert load_sessions(table, one, root) == first._replace(known=True)
    second = load_sessions(table, two, root)
    assert second.start_id == FIRST_SESSION_ID + 5 + 1
    found = loaded_sessions(spark, root)
    ids = sorted(r.sessionid for r in found.summary.collect())
    assert ids == [FIRST_SESSION_ID + n for n in (1, 2, 3, 4, 5, 7, 8, 9, 10, 11, 12, 13)]
    assert found.other.count() == 6
    assert LoadedTables(spark, root).greatest_id() == ids[-1]
    # Rows of one session share customer and session.
    again = ledger(spark, [(i, 1, f"10:0{i}:00", 1, 1, 1) for i in range(4)])
    assert load_sessions(again, DAY, str(tmp_path / "more")).repeated == 4


def test_load_after_a_crash(spark, tmp_path, monkeypatch):
    table = ledger(spark, [(i, i, "10:00:00", [1, 3][i % 2], 1, 1) for i in range(6)])
    root = str(tmp_path / "sessions")
    write = Load.write

    def crash(load, df, name):
        if name == OTHER:
            raise RuntimeError("lost")
        write(load, df, name)

    with monkeypatch.context() as patched:
        patched.setattr(Load, "write", crash)
        with pytest.raises(RuntimeError, match="lost"):
            load_sessions(table, DAY, root)
    tables = LoadedTables(spark, root)
    assert tables.commits() == [] and len(list((tmp_path / "sessions" / SUMMARY).iterdir())) == 1
    assert not load_sessions(table, DAY, root).known
    found = loaded_sessions(spark, root)
    assert (found.summary.count(), found.other.count()) == (6, 3)
    assert tables.discard_unpublished(SUMMARY) == 1
    assert loaded_sessions(spark, root).summary.count() == 6


def test_overlapping_and_simultaneous_loads(spark, tmp_path):
    table = ledger(spark, [(i, i, "10:00:00", 1, 1, 1) for i in range(3)])
    root = str(tmp_path / "sessions")
    tables = LoadedTables(spark, root)
    slow = tables.begin("slow")
    slow.write(table, SUMMARY)
    load_sessions(table, DAY, root)
    with pytest.raises(LoadTaken):
        slow.publish()
    assert [c.number for c in tables.commits()] == [0]
    late = TimeWindow.of(str(DAY.start), "2024-12-31 00:00:00")
    with pytest.raises(ValueError, match="overlaps"):
        load_sessions(table, late, root)


def test_the_mark_of_loads_reads_no_table(spark, tmp_path):
    table = ledger(spark, [(i, i, "10:00:00", 1, 1, 1) for i in range(3)])
    root = str(tmp_path / "sessions")
    load_sessions(table, DAY, root)
    for folder in (SUMMARY, OTHER):
        (tmp_path / "sessions" / folder).rename(tmp_path / folder)
    assert LoadedTables(spark, root).greatest_id() == FIRST_SESSION_ID + 3


def test_a_load_leaves_nothing_staged(spark, tmp_path):
    table = ledger(spark, [(i, i, "10:00:00", 1, 1, 1) for i in range(3)])
    others = stage_table(spark.range(3), "of_another_job")
    with staging(spark) as folder:
        inner = stage_table(spark.range(2), "inner")
        result = keep(inner, "result")
        assert Path(folder).exists()
    assert not Path(folder).exists()
    assert result.count() == 2 and others.count() == 3
    load_sessions(table, DAY, str(tmp_path / "sessions"))
    assert not list(Path(folder).parent.glob("job-*"))
