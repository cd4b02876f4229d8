"""Sessions as a table function of SQL texts.

A SQL function body is one statement, so it cannot count customers first and treat the largest ones
apart, as ``process_sessions`` does. ``sessions_between`` therefore has a name of its own: it is
for ledgers in which the window's rows of one customer fit a task. Ids over all customers still come
without a global sort, from running totals over one row per customer in three levels of buckets.
Filters on the customer reach the scan of the rows; only the totals read all customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stakeline.operators.sessions import (
    FIRST_ROW,
    GAME_ONLY,
    GAP,
    GAP_AND_GAME,
    GAP_ONLY,
    SAME_SESSION,
)
from stakeline.params import ESSENTIALS, SESSION_GAP_SECONDS
from stakeline.sources.sinks import stage_view

NAME = "sessions_between"
_COLUMNS = f"""transaction_id BIGINT, csn_customer_id BIGINT, transaction_date TIMESTAMP_NTZ,
 game_name STRING, tipo_name STRING, csn_game_id BIGINT, {GAP} DOUBLE, anterior_game_id BIGINT,
 anterior_data TIMESTAMP_NTZ, nova_sessao BOOLEAN, motivo_nova_sessao STRING, id_sessao BIGINT"""
_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _body(view: str, gap: float) -> str:
    complete = " AND ".join(f"{column} IS NOT NULL" for column in ESSENTIALS)
    late, moved = f"{GAP} > {gap}", "csn_game_id <> anterior_game_id"
    return f"""WITH typed AS (
 SELECT CAST(customer_transaction_id AS BIGINT) AS transaction_id,
  CAST(csn_customer_id AS BIGINT) AS csn_customer_id,
  CAST(transaction_date AS TIMESTAMP_NTZ) AS transaction_date,
  CAST(game_name AS STRING) AS game_name, CAST(tipo_name AS STRING) AS tipo_name,
  CAST(csn_game_id AS BIGINT) AS csn_game_id
 FROM {view} WHERE transaction_date BETWEEN start_time AND end_time AND {complete}),
seen AS (
 SELECT *, lag(transaction_date) OVER own AS anterior_data, lag(csn_game_id) OVER own AS anterior_game_id
 FROM typed
 WINDOW own AS (PARTITION BY csn_customer_id ORDER BY transaction_date, transaction_id, csn_game_id)),
timed AS (
 SELECT *, CAST(CAST(CAST(transaction_date - anterior_data AS INTERVAL SECOND) AS DECIMAL(18, 6))
  AS DOUBLE) AS {GAP} FROM seen),
flagged AS (
 SELECT *, anterior_data IS NULL OR {late} OR coalesce({moved}, false) AS nova_sessao,
  CASE WHEN anterior_data IS NULL THEN '{FIRST_ROW}' WHEN {late} AND {moved} THEN '{GAP_AND_GAME}'
   WHEN {late} THEN '{GAP_ONLY}' WHEN {moved} THEN '{GAME_ONLY}' ELSE '{SAME_SESSION}'
  END AS motivo_nova_sessao FROM timed),
numbered AS (
 SELECT *, sum(CAST(nova_sessao AS BIGINT)) OVER (PARTITION BY csn_customer_id ORDER BY transaction_date)
  AS own_session FROM flagged),
totals AS (
 SELECT csn_customer_id AS customer, shiftright(csn_customer_id, 20) AS bucket,
  max(own_session) AS sessions FROM numbered GROUP BY csn_customer_id),
near AS (
 SELECT *, coalesce(sum(sessions) OVER (PARTITION BY bucket ORDER BY customer {_BEFORE}), 0)
  AS before_near FROM totals),
buckets AS (
 SELECT bucket, shiftright(bucket, 22) AS region, sum(sessions) AS sessions FROM totals GROUP BY bucket),
middle AS (
 SELECT *, coalesce(sum(sessions) OVER (PARTITION BY region ORDER BY bucket {_BEFORE}), 0)
  AS before_middle FROM buckets),
regions AS (SELECT region, sum(sessions) AS sessions FROM buckets GROUP BY region),
far AS (
 SELECT region, coalesce(sum(sessions) OVER (ORDER BY region {_BEFORE}), 0) AS before_far FROM regions),
shifts AS (
 SELECT customer, before_near + before_middle + before_far AS before
 FROM near JOIN middle USING (bucket) JOIN far USING (region))
SELECT transaction_id, csn_customer_id, transaction_date, game_name, tipo_name, csn_game_id, {GAP},
 anterior_game_id, anterior_data, nova_sessao, motivo_nova_sessao, own_session + before AS id_sessao
FROM numbered JOIN shifts ON csn_customer_id = customer"""


def register_sessions(
    spark: SparkSession,
    ledger: DataFrame | str,
    name: str = NAME,
    gap: float = SESSION_GAP_SECONDS,
) -> str:
    """Makes ``SELECT * FROM name(start, end)`` known to the session; returns the name.

    ``ledger`` is a frame, or the name of a table or view. Both times belong to the window. The
    function is plain SQL, so filters and column lists of the query that calls it are pushed into it.
    """
    if isinstance(ledger, DataFrame):
        view = f"{name}_ledger"
        stage_view(ledger, view)
    else:
        view = ledger
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}"
        "(start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ)"
        f" RETURNS TABLE ({_COLUMNS}) RETURN {_body(view, gap)}"
    )
    return name
