"""Domain tables laid over the test tables.

Each view is one SQL text that Spark and DuckDB both run. ``*_hot`` views give one customer a
third of all rows, all at the start of their day, so many rows of it share a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stakeline.sources import schemas as S
from stakeline.sources.tables import conform, read_table

# Columns of the test tables the views read; naming them spares a look into the files.
BASE_TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double,"
    " props string",
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
    " l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "customer": "c_custkey long, c_acctbal double",
    "part": "p_partkey long, p_name string, p_size int",
    "nation": "n_nationkey int, n_name string",
}

EVENT_ROWS = """SELECT event_id, user_id, event_type, value, ts,
 CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events"""

HOT_EVENT_ROWS = """SELECT event_id, CASE WHEN k < 34 THEN 1 ELSE user_id END AS user_id, event_type,
 value, CASE WHEN k < 34 THEN date_trunc('day', ts) ELSE ts END AS ts, k FROM event_rows"""

TIED_EVENT_ROWS = """SELECT event_id, user_id, event_type, value, date_trunc('day', ts) AS ts, k
 FROM event_rows"""

TXN = """SELECT event_id AS customer_transaction_id, user_id AS csn_customer_id, ts AS transaction_date,
 CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'view' THEN 8 WHEN 'signup' THEN 15
  ELSE CASE WHEN event_id % 2 = 0 THEN 3 END END AS BIGINT) AS csn_cust_transaction_type_id,
 CASE WHEN k % 10 = 0 THEN NULL WHEN k % 4 = 0 THEN CAST(0 AS DECIMAL(18,2))
  ELSE CAST(value AS DECIMAL(18,2)) END AS amount_from_balance,
 CAST(CASE WHEN k % 10 = 7 THEN NULL ELSE k % 3 END AS BIGINT) AS csn_game_id,
 CAST(user_id AS VARCHAR(20)) AS customer_code, event_type AS tipo_name,
 CASE WHEN k % 10 = 7 THEN NULL ELSE concat('game-', CAST(k % 3 AS VARCHAR(4))) END AS game_name,
 CAST(value AS DECIMAL(18,2)) AS current_balance, ts + INTERVAL '1' DAY AS etl_date FROM {rows}"""

# Four customers with one game most of the time: sessions of several rows.
DENSE_EVENT_ROWS = """SELECT event_id, user_id % 4 AS user_id, event_type, value, ts,
 CASE WHEN k < 90 THEN 33 ELSE k END AS k FROM event_rows"""

# Amounts of four places.
FINE_TXN = """SELECT l_orderkey * 10 + l_linenumber AS customer_transaction_id,
 l_suppkey AS csn_customer_id, l_shipdate AS transaction_date,
 CAST(CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 8 WHEN 4 THEN 15 ELSE 3 END AS BIGINT)
  AS csn_cust_transaction_type_id,
 CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4))
  AS amount_from_balance,
 l_partkey % 3 AS csn_game_id, CAST(0 AS DECIMAL(18,2)) AS current_balance FROM lineitem"""

BETS = """SELECT user_id AS customer_id, CAST(k AS BIGINT) AS csn_game_id,
 CASE WHEN event_type = 'click' AND event_id % 2 = 0 THEN ts ELSE ts - INTERVAL '1' SECOND END AS played_date,
 CASE WHEN event_id % 4 = 0 THEN ts ELSE ts + INTERVAL '1' SECOND END AS update_date FROM {rows}"""

LOGINS = """SELECT event_id AS log_id, user_id AS customer_id, ts AS date_time,
 CASE WHEN k % 20 = 0 THEN NULL ELSE concat('10.0.0.', CAST(k AS VARCHAR(4))) END AS ip FROM {rows}"""

SPORT_BETS = """SELECT o_orderkey AS sport_bet_master_id, {customer} AS customer_id,
 CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS total_play,
 CASE o_orderkey % 6 WHEN 0 THEN 'O' WHEN 1 THEN 'W' WHEN 2 THEN 'L' WHEN 3 THEN 'V' WHEN 4 THEN 'C'
  ELSE 'X' END AS status,
 CAST(1 + (o_orderkey % 100) / CAST(100 AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS bet_rate,
 CAST(o_totalprice AS DECIMAL(18,2)) AS return_amount,
 o_orderdate + INTERVAL '24' YEAR AS create_user_date,
 o_orderdate + INTERVAL '24' YEAR + INTERVAL '1' DAY AS update_date FROM orders"""

# name -> (SQL, tables and views it reads, schema to conform to)
VIEWS = {
    "event_rows": (EVENT_ROWS, ("events",), None),
    "event_rows_hot": (HOT_EVENT_ROWS, ("event_rows",), None),
    "event_rows_tied": (TIED_EVENT_ROWS, ("event_rows",), None),
    "event_rows_dense": (DENSE_EVENT_ROWS, ("event_rows",), None),
    "txn": (TXN.format(rows="event_rows"), ("event_rows",), S.LEDGER_VIEW),
    "txn_dense": (TXN.format(rows="event_rows_dense"), ("event_rows_dense",), S.LEDGER_VIEW),
    "txn_fine": (FINE_TXN, ("lineitem",), None),
    "txn_hot": (TXN.format(rows="event_rows_hot"), ("event_rows_hot",), S.LEDGER_VIEW),
    "txn_tied": (TXN.format(rows="event_rows_tied"), ("event_rows_tied",), S.LEDGER_VIEW),
    "casino_customer_bets": (BETS.format(rows="event_rows"), ("event_rows",), S.BETS),
    "casino_customer_bets_hot": (BETS.format(rows="event_rows_hot"), ("event_rows_hot",), S.BETS),
    "csn_games": (
        "SELECT p_partkey AS csn_game_id, p_name AS vendor_game_name,"
        " CAST(p_size AS BIGINT) AS csn_category_id FROM part",
        ("part",),
        S.GAMES,
    ),
    "csn_categories": (
        "SELECT CAST(n_nationkey AS BIGINT) AS category_id, n_name AS category_name FROM nation",
        ("nation",),
        S.CATEGORIES,
    ),
    "customer_login_logs": (LOGINS.format(rows="event_rows"), ("event_rows",), S.LOGINS),
    "customer_login_logs_hot": (
        LOGINS.format(rows="event_rows_hot"),
        ("event_rows_hot",),
        S.LOGINS,
    ),
    "sport_bets": (SPORT_BETS.format(customer="o_custkey"), ("orders",), S.SPORT_BETS),
    "sport_bets_hot": (
        SPORT_BETS.format(customer="CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END"),
        ("orders",),
        S.SPORT_BETS,
    ),
    "sport_bet_masters": (
        "SELECT o_orderkey AS sport_bet_master_id,"
        " CAST(o_totalprice AS DECIMAL(18,2)) AS initial_played_amount,"
        " o_orderkey % 2 AS is_system_bet FROM orders",
        ("orders",),
        S.SPORT_BET_MASTERS,
    ),
    "customers_tdt": ("SELECT c_custkey AS customer_id FROM customer", ("customer",), S.CUSTOMERS),
    "customer_details_tdt": (
        "SELECT c_custkey AS customer_id FROM customer WHERE c_acctbal >= 0",
        ("customer",),
        S.CUSTOMERS,
    ),
    "sport_selection": (
        """SELECT l_orderkey AS sport_bet_master_id, l_orderkey*10+l_linenumber AS sport_bet_detail_id,
 l_partkey AS fixture_id, l_suppkey % 7 AS sport_type_id, l_returnflag AS league_name,
 l_linestatus AS fixture_information, l_shipdate AS fixture_start_date,
 CAST(l_discount AS DECIMAL(10,2)) AS played_odd, CAST(l_extendedprice AS DECIMAL(18,2)) AS played_amount,
 concat('type-', CAST(l_linenumber AS VARCHAR(4))) AS bet_type_name,
 CASE l_linenumber WHEN 1 THEN 'O' WHEN 2 THEN 'C' WHEN 3 THEN 'W' WHEN 4 THEN 'L' WHEN 5 THEN 'V'
  WHEN 6 THEN 'X' END AS status FROM lineitem""",
        ("lineitem",),
        S.SPORT_SELECTION,
    ),
    "customer_transactions_sb": (
        "SELECT o_orderkey AS customer_transaction_id,"
        " CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS sport_bet_master_id FROM orders",
        ("orders",),
        S.SPORT_TRANSACTIONS,
    ),
    "customer_transaction_details": (
        "SELECT o_orderkey AS customer_transaction_id, o_orderdate AS transaction_date FROM orders",
        ("orders",),
        S.TRANSACTION_DETAILS,
    ),
    "session_summary_existing": (
        """SELECT o_orderkey AS sessionid, o_custkey AS csn_customer_id,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 2500 END AS csn_game_id,
 'old' AS category, 'old' AS vendor_game_name FROM orders""",
        ("orders",),
        None,
    ),
}


class Tables:
    """The views over one data folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            path = f"{self._folder}/{name}.parquet"
            return read_table(self._spark, path, BASE_TABLES[name])
        if name not in VIEWS:
            raise AttributeError(name)
        sql, reads, schema = VIEWS[name]
        for source in reads:
            sql = sql.replace(f"FROM {source}", f"FROM {{{source}}}")
        view = self._spark.sql(sql, **{source: getattr(self, source) for source in reads})
        return conform(view, schema) if schema else view


def with_views(steps: dict[str, str], body: str) -> str:
    """One statement: the views that ``steps`` and ``body`` mention, the steps, the body."""
    text = " ".join([*steps.values(), body])
    needed: dict[str, str] = {}

    def add(name: str) -> None:
        if name in VIEWS and name not in needed:
            sql, reads, _ = VIEWS[name]
            for source in reads:
                add(source)
            needed[name] = sql

    words = set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())
    for name in VIEWS:
        if name in words:
            add(name)
    parts = [f"{name} AS ({sql})" for name, sql in {**needed, **steps}.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
