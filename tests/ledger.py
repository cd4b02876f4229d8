"""Small ledgers for tests: rows of (txn, customer, time, type, amount, game)."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "customer_transaction_id long, csn_customer_id long, transaction_date timestamp_ntz,"
    " csn_cust_transaction_type_id long, amount_from_balance decimal(18,2), csn_game_id long,"
    " game_name string, tipo_name string, current_balance decimal(18,2)"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2024-10-07 {text}")


def ledger(spark: SparkSession, rows) -> DataFrame:
    full = []
    for txn, customer, time, kind, amount, game in rows:
        time = at(time) if isinstance(time, str) else time
        amount = None if amount is None else Decimal(str(amount))
        full.append((txn, customer, time, kind, amount, game, None, None, None))
    return spark.createDataFrame(full, SCHEMA)
