"""Table schemas. Ids are 64-bit, money is DECIMAL(18,2), times carry no zone."""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.LongType()
MONEY = T.DecimalType(18, 2)
TEXT = T.StringType()
TIME = T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TRANSACTIONS = _schema(
    customer_transaction_id=ID,
    csn_customer_id=ID,
    csn_cust_transaction_type_id=ID,
    amount_from_balance=MONEY,
    transaction_date=TIME,
    customer_code=TEXT,
    current_balance=MONEY,
)
LEDGER = _schema(
    customer_transaction_id=ID,
    csn_customer_id=ID,
    csn_cust_transaction_type_id=ID,
    amount_from_balance=MONEY,
    transaction_date=TIME,
    customer_code=ID,
    current_balance=MONEY,
    csn_game_id=ID,
)
LEDGER_VIEW = _schema(
    customer_transaction_id=ID,
    csn_cust_transaction_type_id=ID,
    csn_customer_id=ID,
    amount_from_balance=MONEY,
    transaction_date=TIME,
    customer_code=TEXT,
    etl_date=TIME,
    csn_game_id=ID,
    game_name=TEXT,
    tipo_name=TEXT,
    current_balance=MONEY,
)
BETS = _schema(customer_id=ID, csn_game_id=ID, played_date=TIME, update_date=TIME)
GAMES = _schema(csn_game_id=ID, vendor_game_name=TEXT, csn_category_id=ID)
CATEGORIES = _schema(category_id=ID, category_name=TEXT)
SPORT_BETS = _schema(
    sport_bet_master_id=ID,
    customer_id=ID,
    total_play=ID,
    status=TEXT,
    bet_rate=T.DecimalType(10, 2),
    return_amount=MONEY,
    create_user_date=TIME,
    update_date=TIME,
)
SPORT_BET_MASTERS = _schema(
    sport_bet_master_id=ID, initial_played_amount=MONEY, is_system_bet=ID
)
SPORT_SELECTION = _schema(
    sport_bet_master_id=ID,
    sport_bet_detail_id=ID,
    fixture_id=ID,
    sport_type_id=ID,
    league_name=TEXT,
    fixture_information=TEXT,
    fixture_start_date=TIME,
    status=TEXT,
    bet_type_name=TEXT,
    played_odd=T.DecimalType(10, 2),
    played_amount=MONEY,
)
SPORT_TRANSACTIONS = _schema(customer_transaction_id=ID, sport_bet_master_id=ID)
TRANSACTION_DETAILS = _schema(customer_transaction_id=ID, transaction_date=TIME)
CUSTOMERS = _schema(customer_id=ID)
LOGINS = _schema(log_id=ID, customer_id=ID, ip=TEXT, date_time=TIME)
