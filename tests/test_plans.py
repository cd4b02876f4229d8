"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from stakeline import registry
from stakeline.bindings import Tables
from stakeline.operators import sessions
from stakeline.operators.quality import drilldown
from stakeline.operators.sports import id_range, only_ids
from stakeline.params import SkewPolicy
from stakeline.plans import jobs
from stakeline.registry import ALL, SOME
from stakeline.sources import sinks, tables

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.queries()
# Reports whose result is a single row, or rows per table, end in one task by nature.
ONE_ROW = {"session_hwm", "null_report", "row_counts"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "Python" not in text and "Pandas" not in text and "InArrow" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ONE_ROW))
def test_rows_never_meet_in_one_task(spark, name):
    """The only single-task step is the top level of the running total, at most 2^22 rows."""
    text = plan(QUERIES[name](spark, FOLDER))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert re.search(r"_bucket1|\(keys=\[region#", lines[i + 1]), lines[i : i + 3]


def test_range_and_columns_reach_the_scan(spark):
    df = tables.extract_transactions(Tables(spark, FOLDER).txn, SOME).select("customer_transaction_id")
    text = df._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2024-01-05T06:00)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(schema.split(",")) == {"event_id:bigint", "ts:timestamp_ntz"}


def test_session_rows_are_shuffled_once(spark):
    df = sessions.process_sessions(Tables(spark, FOLDER).txn, ALL)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    by_customer = re.findall(r"(?<!Reused)Exchange hashpartitioning\(csn_customer_id", final)
    # One for the full rows, one for the narrow rows the totals come from.
    assert len(by_customer) == 2
    assert final.count("FileScan") == 2 and final.count("ReusedExchange") == 2


def test_customer_filter_reaches_the_scan(spark):
    text = QUERIES["drilldown"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "EqualTo(user_id,7)" in text


def test_first_per_group_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["first_per_group"](spark, FOLDER))
    assert text.count("WindowGroupLimit") >= 2


def scans(df, table: str) -> int:
    """Scans of a test table in the plan that is not yet run."""
    text = plan(df)
    return len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", text))


def test_summary_outputs_do_not_read_the_ledger_again(spark):
    out = jobs.session_summary_job(Tables(spark, FOLDER).txn, ALL, 5)
    for df in out:
        assert scans(df, "events") == 0 and "numbered_rows" in plan(df)


def test_stored_routing_reads_the_view_once(spark, tmp_path):
    out = jobs.store_online_games(Tables(spark, FOLDER).txn, ALL, str(tmp_path / "games"))
    for df in out:
        assert scans(df, "events") == 0 and "PartitionFilters: [isnotnull(branch" in plan(df)


def test_a_hot_key_does_not_repeat_the_bets_join(spark):
    t = Tables(spark, FOLDER)
    df = jobs.enrich_game_job(
        t.txn_hot, t.casino_customer_bets_hot, t.csn_games, t.csn_categories, ALL, ALL,
        SkewPolicy(max_rows=20),
    )
    # Bets and dimensions are in the stored lookup, and the hot rows in stored chunks.
    text = plan(df)
    assert "bets_lookup" in text and "chunks" in text
    assert scans(df, "events") == 1 and scans(df, "part") == scans(df, "nation") == 0


def test_bets_report_counts_on_stored_bets(spark):
    text = plan(QUERIES["bets_report"](spark, FOLDER))
    assert "chosen_bets" in text and len(re.findall(r"FileScan parquet [^\n]*orders", text)) == 1


def test_customer_filter_reaches_the_scan_of_the_table_function(spark):
    text = QUERIES["sessions_between_customer"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "EqualTo(user_id,7)" in text


def rows_scanned(df) -> int:
    """Rows that the scans of a plan without a shuffle gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(
        leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())
    )


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "sessions")
    rows = spark.range(60_000).selectExpr("id * 2 % 4000 AS csn_customer_id", "id AS sessionid")
    sinks.store_for_lookup(rows, path, "csn_customer_id", ("sessionid",), group_rows=500)
    found = drilldown(spark.read.parquet(path), 700)
    assert found.count() == 30 and rows_scanned(found) <= 1000
    # A customer between others that does not occur: the Bloom filter answers.
    assert rows_scanned(drilldown(spark.read.parquet(path), 701)) == 0


def test_ids_filter_the_history_before_its_shuffle(spark, tmp_path):
    for name, count in (("history", 200_000), ("ids", 400)):
        made = spark.range(count).selectExpr("id * 7 % 200003 AS sport_bet_master_id", "id AS x")
        made.write.parquet(str(tmp_path / name))
    history = spark.read.parquet(str(tmp_path / "history"))
    ids = spark.read.parquet(str(tmp_path / "ids")).select("sport_bet_master_id")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        near = id_range(ids)
        df = only_ids(history.where(near), ids.where(near))
        text = plan(df)
        assert "might_contain" in text and "GreaterThanOrEqual(sport_bet_master_id,0)" in text
        assert "might_contain" not in plan(only_ids(history, ids))
        assert df.count() == 400
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_no_ids_choose_nothing(spark):
    ids = spark.range(0).toDF("sport_bet_master_id")
    assert spark.range(5).toDF("sport_bet_master_id").where(id_range(ids)).count() == 0
