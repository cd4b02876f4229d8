"""Registered queries: each operator over the test tables, with an independent SQL statement."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeline.bindings import Tables, with_views
from stakeline.functions import codes
from stakeline.functions.times import parse_timestamp, tz_shift, within
from stakeline.functions.values import convert, int_floor
from stakeline.operators import enrich, lanes, quality, routing, sessions, sports, summary
from stakeline.params import (
    CORE_TYPES,
    DEFAULT_SKEW,
    FIRST_SESSION_ID,
    WINS,
    SkewPolicy,
    TimeWindow,
)
from stakeline.plans import jobs, sql_functions, updates
from stakeline.session import shared_dir, tune
from stakeline.sources import commits, schemas, sinks, tables

# Spans all events / all orders.
ALL = TimeWindow.of("2023-12-31 06:00:00", "2024-02-01 05:59:59")
ORDERS = TimeWindow.of("1994-12-31 00:00:00", "2002-12-31 23:59:59")
# For the queries that are about the range itself.
SOME = TimeWindow.of("2024-01-05 06:00:00", "2024-01-20 05:59:59")
SOME_ORDERS = TimeWindow.of("1995-06-01 00:00:00", "2001-03-31 23:59:59")
LONG_GAP = 21_600
# Makes the customer of the *_hot views, a third of the rows, count as too large for a task.
SMALL_TASKS = SkewPolicy(max_rows=1_000)

KIND = "csn_cust_transaction_type_id"
TXN = "customer_transaction_id"

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def query(name: str, body: str | None = None, steps: dict[str, str] | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        _queries[name] = lambda spark, folder: build(Tables(tune(spark), folder))
        if body is not None:
            _oracles[name] = with_views(steps or {}, body)
        return build

    return register


def _range(column: str, window: TimeWindow) -> str:
    return f"{column} BETWEEN TIMESTAMP '{window.start}' AND TIMESTAMP '{window.end}'"


# --- scans, sources, sinks -------------------------------------------------------------------

_EXTRACT = f"""SELECT customer_transaction_id, csn_customer_id, csn_cust_transaction_type_id,
 CAST(amount_from_balance AS DOUBLE) AS amount_from_balance, transaction_date,
 CAST(customer_code AS BIGINT) AS customer_code, CAST(current_balance AS DOUBLE) AS current_balance
 FROM txn WHERE {_range("transaction_date", SOME)}"""


@query("extract_txn", _EXTRACT)
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(tables.extract_transactions(t.txn, SOME))


_VIEW_COLUMNS = """customer_transaction_id, csn_cust_transaction_type_id, csn_customer_id,
 CAST(amount_from_balance AS DOUBLE) AS amount_from_balance, transaction_date, customer_code, etl_date,
 csn_game_id, game_name, tipo_name, CAST(current_balance AS DOUBLE) AS current_balance"""


@query("scan_params", f"SELECT {_VIEW_COLUMNS} FROM txn WHERE {_range('transaction_date', SOME)}")
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(tables.scan_view(t.txn, SOME))


_BETS_EXTRACT = f"""SELECT customer_id, csn_game_id, played_date, update_date, vendor_game_name,
 csn_category_id, category_name AS csn_category_name FROM casino_customer_bets
 JOIN (SELECT * FROM csn_games, csn_categories WHERE csn_category_id = category_id) AS named_games
 USING (csn_game_id) WHERE {_range("played_date", ALL)}"""


def _bets(t: Tables, hot: bool = False) -> DataFrame:
    bets = t.casino_customer_bets_hot if hot else t.casino_customer_bets
    return enrich.bets_extract(bets, t.csn_games, t.csn_categories, ALL)


@query("bets_extract", _BETS_EXTRACT)
def _(t: Tables) -> DataFrame:
    return _bets(t)


def _fresh_path(t: Tables, name: str) -> str:
    return f"{shared_dir(t._spark)}/{name}-{uuid4().hex}"


@query("copy_roundtrip", _BETS_EXTRACT)
def _(t: Tables) -> DataFrame:
    return sinks.copy_query(_bets(t), _fresh_path(t, "casino_customer_bets_filtered"))


_WHOLE = _EXTRACT.replace(_range("transaction_date", SOME), _range("transaction_date", ALL))


@query("append_roundtrip", f"{_WHOLE} UNION ALL {_WHOLE}")
def _(t: Tables) -> DataFrame:
    rows = tables.extract_transactions(t.txn, ALL)
    path = _fresh_path(t, "transactions_csn")
    sinks.append_table(rows, path)
    sinks.append_table(rows, path)
    return summary.money_as_double(tables.read_table(t._spark, path, rows.schema))


@query("replace_days_roundtrip", _WHOLE)
def _(t: Tables) -> DataFrame:
    rows = tables.extract_transactions(t.txn, ALL)
    path = _fresh_path(t, "transactions_by_day")
    sinks.replace_days(sinks.with_day(rows), path)
    sinks.replace_days(sinks.with_day(rows), path)
    stored = tables.read_table(t._spark, path)
    return summary.money_as_double(
        tables.extract_transactions(stored, ALL, day_column=sinks.DAY)
    )


# Texts that a line of a sheet cannot hold as they are.
_NOTES = """CASE csn_customer_id % 6 WHEN 0 THEN '' WHEN 1 THEN concat('  ', tipo_name, ' ')
 WHEN 2 THEN concat('a "b", ', tipo_name) WHEN 3 THEN concat(tipo_name, chr(10), chr(13), 'x')
 WHEN 4 THEN concat(chr(92), 'N', chr(92), chr(92), 'n') END"""


@query(
    "export_roundtrip",
    "SELECT CAST(customer_transaction_id AS VARCHAR) AS customer_transaction_id,"
    f" CAST(csn_customer_id AS VARCHAR) AS csn_customer_id, game_name, {_NOTES} AS note FROM txn",
)
def _(t: Tables) -> DataFrame:
    columns = ["customer_transaction_id", "csn_customer_id", "game_name", "note"]
    path = _fresh_path(t, "sheet")
    sinks.export_sheet(t.txn.withColumn("note", F.expr(_NOTES)), path, columns)
    return sinks.read_sheet(t._spark, path, columns)


@query("session_hwm", "SELECT max(sessionid) + 1 AS start_id FROM session_summary_existing")
def _(t: Tables) -> DataFrame:
    return tables.next_session_start(t.session_summary_existing)


# --- projection, cast, filter ----------------------------------------------------------------


@query("conform", f"SELECT {_VIEW_COLUMNS.replace('etl_date', 'etl_date AS loaded_at')} FROM txn")
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(
        tables.conform(t.txn, schemas.LEDGER_VIEW, renames={"etl_date": "loaded_at"})
    )


@query(
    "cast_strict",
    "SELECT customer_transaction_id, CAST(customer_code AS BIGINT) AS customer_code,"
    " CAST(customer_transaction_id AS VARCHAR) AS id_text,"
    " CAST(csn_cust_transaction_type_id AS DOUBLE) AS kind_double FROM txn",
)
def _(t: Tables) -> DataFrame:
    return t.txn.select(
        TXN,
        convert(F.col("customer_code"), "long").alias("customer_code"),
        convert(F.col(TXN), "string").alias("id_text"),
        convert(F.col(KIND), "double").alias("kind_double"),
    )


@query(
    "int_floor",
    "SELECT customer_transaction_id, csn_cust_transaction_type_id AS whole_kind,"
    " CAST(floor(current_balance - 50) AS BIGINT) AS whole_amount FROM txn",
)
def _(t: Tables) -> DataFrame:
    return t.txn.select(
        TXN,
        int_floor(F.col(KIND)).alias("whole_kind"),
        int_floor(F.col("current_balance") - 50).alias("whole_amount"),
    )


@query(
    "parse_ts",
    "SELECT customer_transaction_id,"
    " strptime(substr(CAST(transaction_date AS VARCHAR), 1, 19), '%Y-%m-%d %H:%M:%S') AS parsed FROM txn",
)
def _(t: Tables) -> DataFrame:
    text = F.substring(F.col("transaction_date").cast("string"), 1, 19)
    return t.txn.select(TXN, parse_timestamp(text).alias("parsed"))


@query(
    "time_range",
    f"SELECT customer_transaction_id, transaction_date FROM txn WHERE {_range('transaction_date', SOME)}",
)
def _(t: Tables) -> DataFrame:
    return t.txn.where(within(F.col("transaction_date"), SOME)).select(TXN, "transaction_date")


_COMPLETE = "transaction_date IS NOT NULL AND csn_customer_id IS NOT NULL AND csn_game_id IS NOT NULL"
_BRIEF = "customer_transaction_id, csn_customer_id, transaction_date, csn_cust_transaction_type_id, csn_game_id"
_BRIEF_COLUMNS = [c.strip() for c in _BRIEF.split(",")]
_IS_CORE = "csn_cust_transaction_type_id IN (1, 2, 8, 15)"
_NOT_CORE = "(csn_cust_transaction_type_id IS NULL OR csn_cust_transaction_type_id NOT IN (1, 2, 8, 15))"


@query("essentials", f"SELECT {_BRIEF} FROM txn WHERE {_COMPLETE}")
def _(t: Tables) -> DataFrame:
    return quality.drop_null_essentials(t.txn).select(*_BRIEF_COLUMNS)


@query("route_true", f"SELECT {_BRIEF} FROM txn WHERE {_IS_CORE}")
def _(t: Tables) -> DataFrame:
    return routing.route(t.txn, F.col(KIND).isin(*CORE_TYPES))[0].select(*_BRIEF_COLUMNS)


@query("route_false", f"SELECT {_BRIEF} FROM txn WHERE {_NOT_CORE}")
def _(t: Tables) -> DataFrame:
    return routing.route(t.txn, F.col(KIND).isin(*CORE_TYPES))[1].select(*_BRIEF_COLUMNS)


@query("route_nulls", f"SELECT {_BRIEF} FROM txn WHERE NOT ({_COMPLETE})")
def _(t: Tables) -> DataFrame:
    return routing.route_complete(t.txn)[1].select(*_BRIEF_COLUMNS)


@query("type_regex", f"SELECT {_BRIEF} FROM txn WHERE regexp_matches(CAST(csn_cust_transaction_type_id AS VARCHAR), '^(1|2|8|15)$')")
def _(t: Tables) -> DataFrame:
    return t.txn.where(codes.matches_core_pattern(F.col(KIND))).select(*_BRIEF_COLUMNS)


@query("type_in", f"SELECT {_BRIEF} FROM txn WHERE csn_cust_transaction_type_id IN (2, 8)")
def _(t: Tables) -> DataFrame:
    return t.txn.where(codes.one_of(F.col(KIND), WINS)).select(*_BRIEF_COLUMNS)


@query("other_types", f"SELECT {_BRIEF} FROM txn WHERE {_NOT_CORE}")
def _(t: Tables) -> DataFrame:
    return summary.other_types(t.txn).select(*_BRIEF_COLUMNS)


_FLAGS = """SELECT *, CASE WHEN csn_cust_transaction_type_id = 1 THEN 1 ELSE 0 END AS is_aposta,
 CASE WHEN csn_cust_transaction_type_id IN (2, 8) THEN 1 ELSE 0 END AS is_ganho,
 CASE WHEN csn_cust_transaction_type_id = 15 THEN 1 ELSE 0 END AS is_recompensa,
 CASE WHEN csn_cust_transaction_type_id = 15 AND amount_from_balance > 0 THEN 1 ELSE 0 END AS recompensa_paga,
 CASE WHEN csn_cust_transaction_type_id = 15 AND amount_from_balance = 0 THEN 1 ELSE 0 END AS recompensa_nao_paga
 FROM """
_FLAG_COLUMNS = ["is_aposta", "is_ganho", "is_recompensa", "recompensa_paga", "recompensa_nao_paga"]


@query(
    "type_flags",
    f"SELECT customer_transaction_id, {', '.join(_FLAG_COLUMNS)} FROM flags",
    {"flags": _FLAGS + "txn"},
)
def _(t: Tables) -> DataFrame:
    return summary.with_type_flags(t.txn).select(TXN, *_FLAG_COLUMNS)


@query(
    "masked_amounts",
    """SELECT customer_transaction_id,
 CASE WHEN is_aposta = 1 THEN CAST(amount_from_balance AS DOUBLE) ELSE 0 END AS total_apostas,
 CASE WHEN is_ganho = 1 THEN CAST(amount_from_balance AS DOUBLE) ELSE 0 END AS total_ganhos,
 CASE WHEN is_recompensa = 1 THEN CAST(amount_from_balance AS DOUBLE) ELSE 0 END AS total_recompensas,
 CASE WHEN recompensa_paga = 1 THEN CAST(customer_transaction_id AS VARCHAR) END AS json_recompensas FROM flags""",
    {"flags": _FLAGS + "txn"},
)
def _(t: Tables) -> DataFrame:
    masked = summary.with_masked_amounts(summary.with_type_flags(t.txn))
    return summary.money_as_double(
        masked.select(TXN, "total_apostas", "total_ganhos", "total_recompensas", "json_recompensas")
    )


@query(
    "tz_shift",
    "SELECT customer_transaction_id, transaction_date - INTERVAL '3' HOUR AS report_time,"
    " etl_date - INTERVAL '6' HOUR AS filter_time FROM txn",
)
def _(t: Tables) -> DataFrame:
    return t.txn.select(
        TXN,
        tz_shift(F.col("transaction_date"), -3).alias("report_time"),
        tz_shift(F.col("etl_date"), -6).alias("filter_time"),
    )


@query(
    "null_report",
    """SELECT count(*) AS row_count, count(*) - count(transaction_date) AS transaction_date_nulls,
 count(*) - count(csn_customer_id) AS csn_customer_id_nulls, count(*) - count(csn_game_id) AS csn_game_id_nulls,
 count(csn_game_id) < count(*) AS has_nulls FROM txn""",
)
def _(t: Tables) -> DataFrame:
    return quality.null_report(t.txn)


@query(
    "row_counts",
    "SELECT 'transactions' AS name, count(*) AS row_count FROM txn"
    " UNION ALL SELECT 'bets', count(*) FROM casino_customer_bets"
    " UNION ALL SELECT 'sessions', count(*) FROM session_summary_existing",
)
def _(t: Tables) -> DataFrame:
    return (
        quality.row_count(t.txn, "transactions")
        .union(quality.row_count(t.casino_customer_bets, "bets"))
        .union(quality.row_count(t.session_summary_existing, "sessions"))
    )


@query("game_ids", "SELECT DISTINCT csn_game_id FROM session_summary_existing WHERE csn_game_id IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return quality.distinct_ids(t.session_summary_existing, "csn_game_id")


@query(
    "first_per_group",
    """SELECT DISTINCT ON (csn_customer_id, csn_cust_transaction_type_id, transaction_date) csn_customer_id,
 csn_cust_transaction_type_id, transaction_date, csn_game_id, customer_transaction_id FROM txn_tied
 ORDER BY csn_customer_id, csn_cust_transaction_type_id, transaction_date, csn_game_id DESC NULLS LAST,
 customer_transaction_id""",
)
def _(t: Tables) -> DataFrame:
    keys = ["csn_customer_id", KIND, "transaction_date"]
    rows = t.txn_tied.select(*keys, "csn_game_id", TXN)
    return quality.first_per_group(rows, keys, [F.desc_nulls_last("csn_game_id"), F.asc(TXN)])


@query("sorted_txn", f"SELECT {_BRIEF} FROM txn ORDER BY csn_customer_id, transaction_date, customer_transaction_id")
def _(t: Tables) -> DataFrame:
    return quality.sort_transactions(t.txn.select(*_BRIEF_COLUMNS))


# --- sessions --------------------------------------------------------------------------------


def _session_steps(view: str, window: TimeWindow = ALL, gap: int = 1200) -> dict[str, str]:
    return {
        "base": f"SELECT * FROM {view} WHERE {_COMPLETE} AND {_range('transaction_date', window)}",
        "lagged": """SELECT *, lag(transaction_date) OVER w AS anterior_data, lag(csn_game_id) OVER w AS anterior_game_id
 FROM base WINDOW w AS (PARTITION BY csn_customer_id ORDER BY transaction_date, customer_transaction_id)""",
        "gaps": "SELECT *, date_diff('microsecond', anterior_data, transaction_date) / 1e6"
        " AS dif_data_atual_com_anterior FROM lagged",
        "tests": f"""SELECT *, anterior_data IS NULL AS is_first,
 coalesce(dif_data_atual_com_anterior > {gap}, FALSE) AS is_late,
 coalesce(csn_game_id <> anterior_game_id, FALSE) AS is_other_game FROM gaps""",
        "flagged": """SELECT *, is_first OR is_late OR is_other_game AS nova_sessao,
 CASE WHEN is_first THEN 'Data anterior vazia' WHEN is_late THEN
  concat('Passou 20 minutos', CASE WHEN is_other_game THEN ', mas mudou de jogo' ELSE '' END)
 WHEN is_other_game THEN 'Mudou de jogo' ELSE '-' END AS motivo_nova_sessao FROM tests""",
    }


def _shared_ids(view: str, window: TimeWindow = ALL, gap: int = 1200) -> dict[str, str]:
    return {
        **_session_steps(view, window, gap),
        "numbered": "SELECT *, count(*) FILTER (WHERE nova_sessao) OVER"
        " (ORDER BY csn_customer_id, transaction_date) AS id_sessao FROM flagged",
    }


_START = "(SELECT max(sessionid) + 1 FROM session_summary_existing)"


def _row_ids(view: str, window: TimeWindow = ALL, gap: int = 1200) -> dict[str, str]:
    return {
        **_session_steps(view, window, gap),
        "numbered": "SELECT *, count(*) FILTER (WHERE nova_sessao) OVER"
        " (ORDER BY csn_customer_id, transaction_date, customer_transaction_id ROWS UNBOUNDED PRECEDING)"
        f" + {_START} AS sessionid FROM flagged",
    }


_LAG = "customer_transaction_id, anterior_data, anterior_game_id, dif_data_atual_com_anterior"


def _base(t: Tables) -> DataFrame:
    rows = t.txn.where(within(F.col("transaction_date"), ALL))
    return quality.drop_null_essentials(rows).select(*_BRIEF_COLUMNS)


@query("txn_lag", f"SELECT {_LAG} FROM gaps", _session_steps("txn"))
def _(t: Tables) -> DataFrame:
    return sessions.with_previous(_base(t)).select(*[c.strip() for c in _LAG.split(",")])


@query(
    "session_flags",
    "SELECT customer_transaction_id, nova_sessao, motivo_nova_sessao FROM flagged",
    _session_steps("txn", gap=LONG_GAP),
)
def _(t: Tables) -> DataFrame:
    flagged = sessions.flag_sessions(_base(t), LONG_GAP)
    return flagged.select(TXN, "nova_sessao", "motivo_nova_sessao")


@query(
    "session_flags_frame",
    "SELECT customer_transaction_id, nova_sessao FROM flagged",
    _session_steps("txn"),
)
def _(t: Tables) -> DataFrame:
    return sessions.frame_sessions(t.txn, ALL).select(TXN, "nova_sessao")


@query(
    "session_ids",
    "SELECT customer_transaction_id, id_sessao FROM numbered",
    _shared_ids("txn_tied", gap=LONG_GAP),
)
def _(t: Tables) -> DataFrame:
    rows = quality.drop_null_essentials(t.txn_tied).select(*_BRIEF_COLUMNS)
    return sessions.number_sessions(rows, "id_sessao", LONG_GAP).select(TXN, "id_sessao")


_FRAME = "SELECT customer_transaction_id, csn_customer_id, sessionid FROM numbered"


def _frame(t: Tables, view: DataFrame, gap: int, **options) -> DataFrame:
    start = tables.high_water_mark(t.session_summary_existing)
    return sessions.frame_sessions(view, ALL, start, gap, **options)


@query("session_ids_frame", _FRAME, _row_ids("txn_tied", gap=LONG_GAP))
def _(t: Tables) -> DataFrame:
    return _frame(t, t.txn_tied, LONG_GAP).select(TXN, "csn_customer_id", "sessionid")


_FUNCTION = """SELECT customer_transaction_id AS transaction_id, csn_customer_id, transaction_date, game_name, tipo_name,
 csn_game_id, dif_data_atual_com_anterior, anterior_game_id, anterior_data, nova_sessao, motivo_nova_sessao,
 id_sessao FROM numbered"""


@query("process_sessions", _FUNCTION, _shared_ids("txn"))
def process_sessions(t: Tables) -> DataFrame:
    return sessions.process_sessions(t.txn, ALL)


def _called(t: Tables, window: TimeWindow, gap: int, more: str = "") -> DataFrame:
    name = sql_functions.register_sessions(t._spark, t.txn, gap=gap)
    return t._spark.sql(
        f"SELECT * FROM {name}(TIMESTAMP_NTZ'{window.start}', TIMESTAMP_NTZ'{window.end}') {more}"
    )


@query("sessions_between", _FUNCTION, _shared_ids("txn"))
def _(t: Tables) -> DataFrame:
    return _called(t, ALL, 1200)


@query(
    "sessions_between_customer",
    f"SELECT * FROM ({_FUNCTION}) WHERE csn_customer_id = 7",
    _shared_ids("txn", SOME, LONG_GAP),
)
def _(t: Tables) -> DataFrame:
    return _called(t, SOME, LONG_GAP, "WHERE csn_customer_id = 7")


@query("process_sessions_window", _FUNCTION, _shared_ids("txn", SOME, LONG_GAP))
def _(t: Tables) -> DataFrame:
    return sessions.process_sessions(t.txn, SOME, LONG_GAP)


@query("process_sessions_hot", _FUNCTION, _shared_ids("txn_hot", gap=LONG_GAP))
def _(t: Tables) -> DataFrame:
    return sessions.process_sessions(t.txn_hot, ALL, LONG_GAP, SMALL_TASKS)


_TABLE = """SELECT customer_transaction_id, csn_customer_id, csn_game_id, anterior_game_id, transaction_date,
 anterior_data, dif_data_atual_com_anterior, nova_sessao, id_sessao, motivo_nova_sessao FROM numbered"""


@query("stage_roundtrip", f"{_TABLE} ORDER BY transaction_date", _shared_ids("txn"))
def _(t: Tables) -> DataFrame:
    stored = sinks.stage_table(sessions.session_table(t.txn, ALL), "tab_final_sessao_teste")
    return quality.sort_by_time(sinks.stage_view(stored, "tab_final_sessao_teste"))


@query("drilldown_stored", f"{_TABLE} WHERE csn_customer_id = 7", _shared_ids("txn"))
def _(t: Tables) -> DataFrame:
    path = _fresh_path(t, "sessions_by_customer")
    order = ("transaction_date", TXN)
    sinks.store_for_lookup(sessions.session_table(t.txn, ALL), path, "csn_customer_id", order)
    return quality.drilldown(tables.read_table(t._spark, path), 7)


@query("drilldown", f"{_TABLE} WHERE csn_customer_id = 7", _shared_ids("txn"))
def _(t: Tables) -> DataFrame:
    return quality.drilldown(sessions.session_table(t.txn, ALL), 7)


@query(
    "dup_rows",
    "SELECT customer_transaction_id, csn_customer_id, sessionid FROM"
    " (SELECT *, count(*) OVER (PARTITION BY csn_customer_id, sessionid) AS n FROM numbered) WHERE n > 1",
    _row_ids("txn", gap=LONG_GAP),
)
def _(t: Tables) -> DataFrame:
    rows = _frame(t, t.txn, LONG_GAP).select(TXN, "csn_customer_id", "sessionid")
    hot = lanes.find_hot(t.txn, sessions.CUSTOMER, DEFAULT_SKEW)
    return quality.duplicate_report(rows, ("csn_customer_id", "sessionid"), hot=hot)


@query(
    "other_types_out",
    "SELECT csn_customer_id, sessionid, csn_cust_transaction_type_id AS type,"
    f" CAST(amount_from_balance AS DOUBLE) AS total_amount FROM numbered WHERE {_NOT_CORE}",
    _row_ids("txn"),
)
def _(t: Tables) -> DataFrame:
    start = tables.high_water_mark(t.session_summary_existing)
    return jobs.session_summary_job(t.txn, ALL, start).other


# --- summaries -------------------------------------------------------------------------------

_KEYS = "csn_customer_id, sessionid, csn_game_id"


def _summary_steps(view: str, gap: int = LONG_GAP) -> dict[str, str]:
    return {
        **_row_ids(view, gap=gap),
        "flags": _FLAGS + "numbered",
        "per_session": f"""SELECT {_KEYS}, CAST(sum(is_aposta) AS BIGINT) AS quantidade_apostas,
 CAST(sum(is_ganho) AS BIGINT) AS quantidade_ganhos, CAST(sum(recompensa_paga) AS BIGINT) AS quantidade_recompensas_pagas,
 CAST(sum(recompensa_nao_paga) AS BIGINT) AS quantidade_recompensas_nao_pagas,
 coalesce(sum(amount_from_balance) FILTER (WHERE is_aposta = 1), 0) AS total_apostas,
 coalesce(sum(amount_from_balance) FILTER (WHERE is_ganho = 1), 0) AS total_ganhos,
 coalesce(sum(amount_from_balance) FILTER (WHERE is_recompensa = 1), 0) AS total_recompensas,
 min(transaction_date) AS session_start, max(transaction_date) AS session_end,
 coalesce(CAST(to_json(list(CAST(customer_transaction_id AS VARCHAR) ORDER BY transaction_date, customer_transaction_id)
  FILTER (WHERE recompensa_paga = 1)) AS VARCHAR), '[]') AS quantidade_recompensas FROM flags GROUP BY {_KEYS}""",
    }


_SUMMARY = f"""SELECT {_KEYS}, quantidade_apostas, quantidade_ganhos, quantidade_recompensas_pagas,
 quantidade_recompensas_nao_pagas, CAST(total_apostas AS DOUBLE) AS total_apostas,
 CAST(total_ganhos AS DOUBLE) AS total_ganhos, CAST(total_recompensas AS DOUBLE) AS total_recompensas,
 session_start, session_end"""
_METRICS = """date_diff('microsecond', session_start, session_end) / 1e6 AS session_duration_seconds,
 CAST(greatest(total_ganhos - total_apostas, 0) AS DOUBLE) AS ganhos_jogador,
 CAST(greatest(total_apostas - total_ganhos, 0) AS DOUBLE) AS perda_jogador,
 CASE WHEN total_ganhos > 0 THEN 'ganho' ELSE 'perda' END AS result_session"""
_FULL = f"{_SUMMARY}, quantidade_recompensas, {_METRICS} FROM per_session"


@query("session_summary", f"{_SUMMARY} FROM per_session", _summary_steps("txn"))
def _(t: Tables) -> DataFrame:
    rows = _frame(t, t.txn, LONG_GAP)
    return summary.money_as_double(summary.session_summary(rows, rewards=False))


@query(
    "session_rewards_json",
    f"SELECT {_KEYS}, quantidade_recompensas FROM per_session",
    _summary_steps("txn_tied"),
)
def _(t: Tables) -> DataFrame:
    rows = _frame(t, t.txn_tied, LONG_GAP)
    return summary.session_summary(rows).select(*summary.SESSION_KEYS, "quantidade_recompensas")


@query("session_metrics", f"SELECT {_KEYS}, {_METRICS} FROM per_session", _summary_steps("txn"))
def _(t: Tables) -> DataFrame:
    metrics = summary.with_session_metrics(
        summary.session_summary(_frame(t, t.txn, LONG_GAP), rewards=False)
    )
    return summary.money_as_double(
        metrics.select(
            *summary.SESSION_KEYS,
            "session_duration_seconds",
            "ganhos_jogador",
            "perda_jogador",
            "result_session",
        )
    )


@query("session_summary_full", _FULL, _summary_steps("txn", gap=1200))
def _(t: Tables) -> DataFrame:
    start = tables.high_water_mark(t.session_summary_existing)
    return jobs.session_summary_job(t.txn, ALL, start).summary


@query("session_summary_dense", _FULL, _summary_steps("txn_dense", gap=1200))
def _(t: Tables) -> DataFrame:
    start = tables.high_water_mark(t.session_summary_existing)
    return jobs.session_summary_job(t.txn_dense, ALL, start).summary


@query("process_sessions_dense", _FUNCTION, _shared_ids("txn_dense"))
def _(t: Tables) -> DataFrame:
    return sessions.process_sessions(t.txn_dense, ALL)


_FINE_STEPS = {
    name: sql.replace(_range("transaction_date", ALL), _range("transaction_date", ORDERS))
    for name, sql in _summary_steps("txn_fine").items()
}


@query("session_summary_fine", _FULL, _FINE_STEPS)
def _(t: Tables) -> DataFrame:
    start = tables.high_water_mark(t.session_summary_existing)
    return jobs.session_summary_job(t.txn_fine, ORDERS, start, LONG_GAP).summary


# Two windows in a row, loaded one after the other; the first ends right before the second.
HALVES = (
    TimeWindow(ALL.start, datetime(2024, 1, 15, 5, 59, 59, 999_999)),
    TimeWindow.of("2024-01-15 06:00:00", "2024-02-01 05:59:59"),
)
_LOADED = {
    **_summary_steps("txn", gap=1200),
    "base": f"""SELECT *, CASE WHEN transaction_date > TIMESTAMP '{HALVES[0].end}' THEN 1 ELSE 0 END AS half
 FROM txn WHERE {_COMPLETE}
 AND ({_range("transaction_date", HALVES[0])} OR {_range("transaction_date", HALVES[1])})""",
    "lagged": """SELECT *, lag(transaction_date) OVER w AS anterior_data, lag(csn_game_id) OVER w AS anterior_game_id
 FROM base WINDOW w AS (PARTITION BY half, csn_customer_id ORDER BY transaction_date, customer_transaction_id)""",
    "numbered": "SELECT *, count(*) FILTER (WHERE nova_sessao) OVER (ORDER BY half, csn_customer_id,"
    " transaction_date, customer_transaction_id ROWS UNBOUNDED PRECEDING)"
    f" + half + {FIRST_SESSION_ID} AS sessionid FROM flagged",
}


def _load_halves(t: Tables) -> str:
    root = _fresh_path(t, "sessions")
    for window in HALVES:
        jobs.load_sessions(t.txn, window, root)
    return root


def _load_again(t: Tables) -> str:
    """Loads the windows, the first one twice, and the second one also after a crash that left
    one table written and the load unpublished."""
    root = _fresh_path(t, "sessions")
    loads = commits.LoadedTables(t._spark, root)
    jobs.load_sessions(t.txn, HALVES[0], root)
    jobs.load_sessions(t.txn, HALVES[0], root)
    broken = loads.begin(f"{HALVES[1].start}/{HALVES[1].end}")
    broken.write(loads.read(jobs.SUMMARY), jobs.SUMMARY)
    for _ in range(2):
        jobs.load_sessions(t.txn, HALVES[1], root)
    return root


_OTHER_ROWS = (
    "SELECT csn_customer_id, sessionid, csn_cust_transaction_type_id AS type,"
    f" CAST(amount_from_balance AS DOUBLE) AS total_amount FROM numbered WHERE {_NOT_CORE}"
)


@query("load_sessions_summary", _FULL, _LOADED)
def _(t: Tables) -> DataFrame:
    return jobs.loaded_sessions(t._spark, _load_halves(t)).summary


@query("load_sessions_other", _OTHER_ROWS, _LOADED)
def _(t: Tables) -> DataFrame:
    return jobs.loaded_sessions(t._spark, _load_halves(t)).other


@query("load_sessions_again_summary", _FULL, _LOADED)
def _(t: Tables) -> DataFrame:
    return jobs.loaded_sessions(t._spark, _load_again(t)).summary


@query("load_sessions_again_other", _OTHER_ROWS, _LOADED)
def _(t: Tables) -> DataFrame:
    return jobs.loaded_sessions(t._spark, _load_again(t)).other


@query("session_mark_of_loads", "SELECT max(sessionid) + 1 AS start_id FROM numbered", _LOADED)
def _(t: Tables) -> DataFrame:
    loads = commits.LoadedTables(t._spark, _load_halves(t))
    return t._spark.range(1).select(F.lit(loads.greatest_id() + 1).cast("long").alias("start_id"))


@query("append_once_roundtrip", _WHOLE)
def _(t: Tables) -> DataFrame:
    rows = tables.extract_transactions(t.txn, ALL)
    root = _fresh_path(t, "transactions_once")
    for _ in range(2):
        commits.append_once(rows, root, "transactions", "all")
    stored = commits.LoadedTables(t._spark, root).read("transactions", rows.schema)
    return summary.money_as_double(stored)


@query("session_summary_hot", _FULL, _summary_steps("txn_hot"))
def _(t: Tables) -> DataFrame:
    start = tables.high_water_mark(t.session_summary_existing)
    return jobs.session_summary_job(t.txn_hot, ALL, start, LONG_GAP, SMALL_TASKS).summary


# --- enrichment ------------------------------------------------------------------------------

_LEDGER = """customer_transaction_id, csn_customer_id, transaction_date, csn_cust_transaction_type_id,
 csn_game_id"""


def _fill_steps(view: str, bets: str) -> dict[str, str]:
    others = "t.customer_transaction_id, t.csn_customer_id, t.transaction_date, t.csn_cust_transaction_type_id"
    return {
        "extract_bets": _BETS_EXTRACT.replace("casino_customer_bets", bets),
        "played": "SELECT customer_id, played_date, max(csn_game_id) AS game FROM extract_bets GROUP BY ALL",
        "updated": "SELECT customer_id, update_date, max(csn_game_id) AS game FROM extract_bets GROUP BY ALL",
        "pass1": f"""SELECT {others}, CASE WHEN p.game IS NOT NULL THEN p.game ELSE t.csn_game_id END AS csn_game_id
 FROM {view} t LEFT JOIN played p ON t.csn_customer_id = p.customer_id AND t.transaction_date = p.played_date
 AND t.csn_cust_transaction_type_id = 1""",
        "pass2": f"""SELECT {others}, CASE WHEN t.csn_game_id IS NULL AND t.{_IS_CORE} THEN u.game ELSE t.csn_game_id END
 AS csn_game_id FROM pass1 t LEFT JOIN updated u ON t.csn_customer_id = u.customer_id
 AND t.transaction_date = u.update_date""",
        "pass3": f"""SELECT {others}, CASE WHEN t.csn_game_id IS NULL AND t.{_IS_CORE} THEN
 (SELECT max_by(d.csn_game_id, (d.transaction_date, d.csn_game_id)) FROM pass2 d
  WHERE d.csn_customer_id = t.csn_customer_id AND d.csn_cust_transaction_type_id = t.csn_cust_transaction_type_id
  AND d.transaction_date < t.transaction_date AND d.csn_game_id IS NOT NULL)
 ELSE t.csn_game_id END AS csn_game_id FROM pass2 t""",
    }


def _steps_until(name: str) -> dict[str, str]:
    steps = _fill_steps("txn", "casino_customer_bets")
    names = list(steps)
    return {n: steps[n] for n in names[: names.index(name) + 1]}


def _ledger(t: Tables) -> DataFrame:
    return t.txn.select(*_BRIEF_COLUMNS)


@query("fill_pass1", f"SELECT {_LEDGER} FROM pass1", _steps_until("pass1"))
def _(t: Tables) -> DataFrame:
    return enrich.update_overwrite(_ledger(t), _bets(t))


@query("fill_pass2", f"SELECT {_LEDGER} FROM pass2", _steps_until("pass2"))
def _(t: Tables) -> DataFrame:
    return enrich.update_fill_null(enrich.update_overwrite(_ledger(t), _bets(t)), _bets(t))


def _bets_of_some_days(t: Tables) -> DataFrame:
    return enrich.bets_extract(t.casino_customer_bets, t.csn_games, t.csn_categories, SOME)


_SOME_BETS = {
    **_steps_until("pass2"),
    "extract_bets": _BETS_EXTRACT.replace(_range("played_date", ALL), _range("played_date", SOME)),
}


@query("update_stored_ledger", f"SELECT {_LEDGER} FROM pass2", _SOME_BETS)
def _(t: Tables) -> DataFrame:
    path = _fresh_path(t, "ledger_by_day")
    sinks.append_table(sinks.with_day(_ledger(t)), path, by=sinks.DAY)
    updates.update_stored_games(t._spark, path, _bets_of_some_days(t))
    return tables.read_table(t._spark, path).select(*_BRIEF_COLUMNS)


@query(
    "fill_pass3",
    f"SELECT {_LEDGER} FROM pass3",
    {"pass2": f"SELECT {_LEDGER} FROM txn_tied", "pass3": _fill_steps("", "")["pass3"]},
)
def _(t: Tables) -> DataFrame:
    return enrich.fill_forward(t.txn_tied.select(*_BRIEF_COLUMNS))


@query("enrich_game", f"SELECT {_LEDGER} FROM pass3", _steps_until("pass3"))
def _(t: Tables) -> DataFrame:
    return jobs.enrich_game_job(
        _ledger(t), t.casino_customer_bets, t.csn_games, t.csn_categories, ALL, ALL
    )


@query(
    "enrich_game_hot",
    f"SELECT {_LEDGER} FROM pass3",
    _fill_steps("txn_hot", "casino_customer_bets_hot"),
)
def _(t: Tables) -> DataFrame:
    return jobs.enrich_game_job(
        t.txn_hot.select(*_BRIEF_COLUMNS),
        t.casino_customer_bets_hot,
        t.csn_games,
        t.csn_categories,
        ALL,
        ALL,
        SkewPolicy(max_rows=200),
    )


_GAME_INFO = """SELECT csn_game_id, (SELECT max(category_name) FROM csn_categories
  WHERE category_id = csn_category_id) AS game_category, vendor_game_name AS vendor_name
 FROM csn_games SEMI JOIN session_summary_existing USING (csn_game_id)"""


@query("dim_lookup", _GAME_INFO)
def _(t: Tables) -> DataFrame:
    ids = quality.distinct_ids(t.session_summary_existing, "csn_game_id")
    return enrich.dim_lookup(t.csn_games, t.csn_categories, ids)


_ATTACHED = """SELECT s.sessionid, s.csn_customer_id, s.csn_game_id,
 CASE WHEN i.csn_game_id IS NOT NULL THEN i.game_category ELSE s.category END AS category,
 CASE WHEN i.csn_game_id IS NOT NULL THEN i.vendor_name ELSE s.vendor_game_name END AS vendor_game_name
 FROM session_summary_existing s LEFT JOIN info i ON s.csn_game_id = i.csn_game_id"""


@query("attach_dims", _ATTACHED, {"info": _GAME_INFO})
def _(t: Tables) -> DataFrame:
    return jobs.attach_dims_job(t.session_summary_existing, t.csn_games, t.csn_categories)


@query("attach_dims_stored", _ATTACHED, {"info": _GAME_INFO})
def _(t: Tables) -> DataFrame:
    """First with the lookup of half of the games under other names, then with the real one."""
    path, applied, buckets = _fresh_path(t, "sessions_by_game"), _fresh_path(t, "lookup"), 8
    facts = t.session_summary_existing
    updates.store_by_game(facts, path, buckets)
    lookup = enrich.dim_lookup(t.csn_games, t.csn_categories)
    older = lookup.where("csn_game_id % 2 = 0").withColumn("vendor_name", F.lit("older"))
    for dim in (older, lookup):
        updates.apply_lookup(t._spark, path, dim, applied, buckets)
    return tables.read_table(t._spark, path).select(*facts.columns)


# --- routing job -----------------------------------------------------------------------------

_TREATED = f"{_VIEW_COLUMNS}, csn_cust_transaction_type_id AS csn_cust_transaction_type_id_tratado"


@query("online_games_core", f"SELECT {_TREATED} FROM txn WHERE {_IS_CORE} AND {_COMPLETE}")
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(jobs.online_games_job(t.txn, ALL).core)


@query("online_games_other", f"SELECT {_TREATED} FROM txn WHERE {_NOT_CORE}")
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(jobs.online_games_job(t.txn, ALL).other)


@query("online_games_nulls", f"SELECT {_TREATED} FROM txn WHERE {_IS_CORE} AND NOT ({_COMPLETE})")
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(jobs.online_games_job(t.txn, ALL).nulls)


def _stored_games(t: Tables) -> jobs.OnlineGames:
    return jobs.store_online_games(t.txn, ALL, _fresh_path(t, "online_games"))


@query("online_games_stored_core", f"SELECT {_TREATED} FROM txn WHERE {_IS_CORE} AND {_COMPLETE}")
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(_stored_games(t).core)


@query("online_games_stored_other", f"SELECT {_TREATED} FROM txn WHERE {_NOT_CORE}")
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(_stored_games(t).other)


@query("online_games_stored_nulls", f"SELECT {_TREATED} FROM txn WHERE {_IS_CORE} AND NOT ({_COMPLETE})")
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(_stored_games(t).nulls)


# --- sports reports --------------------------------------------------------------------------


def _ids_sql(window: TimeWindow) -> str:
    return f"""SELECT sport_bet_master_id FROM customer_transactions_sb
  WHERE customer_transaction_id IN (SELECT customer_transaction_id FROM customer_transaction_details
   WHERE {_range("transaction_date - INTERVAL '6' HOUR", window)})
 INTERSECT SELECT sport_bet_master_id FROM sport_bet_masters
 INTERSECT SELECT sport_bet_master_id FROM sport_selection"""


def _ids(t: Tables, window: TimeWindow) -> DataFrame:
    return sports.sport_bet_ids(
        t.customer_transactions_sb,
        t.customer_transaction_details,
        t.sport_bet_masters,
        t.sport_selection,
        window,
    )


@query("sport_bet_ids", _ids_sql(SOME_ORDERS))
def _(t: Tables) -> DataFrame:
    return _ids(t, SOME_ORDERS)


def _login_sql(bets: str, logins: str) -> str:
    return f"""SELECT sport_bet_master_id, (SELECT ip FROM {logins} AS seen
 WHERE seen.customer_id = made.customer_id AND seen.date_time <= made.create_user_date
 ORDER BY seen.date_time DESC, seen.log_id DESC LIMIT 1) AS ip_address FROM {bets} AS made"""


@query("asof_login_ip", _login_sql("sport_bets", "customer_login_logs"))
def _(t: Tables) -> DataFrame:
    bets = t.sport_bets.select(sports.MASTER, "customer_id", "create_user_date")
    found = sports.bets_with_login(bets, t.customer_login_logs)
    return found.select(sports.MASTER, "ip_address")


@query("asof_login_ip_hot", _login_sql("sport_bets_hot", "customer_login_logs_hot"))
def _(t: Tables) -> DataFrame:
    bets = t.sport_bets_hot.select(sports.MASTER, "customer_id", "create_user_date")
    found = sports.bets_with_login(bets, t.customer_login_logs_hot, SMALL_TASKS)
    return found.select(sports.MASTER, "ip_address")


_BETS = """SELECT customer_id, sport_bet_master_id AS bet_master_id, ip_address,
 if(total_play = 1, '1', '2') AS bet_type,
 coalesce(map {'O': '1', 'W': '2', 'L': '3', 'V': '3', 'C': '2'}[status], '2') AS bet_status,
 CAST(bet_rate AS DOUBLE) AS fixed_odds, CAST(initial_played_amount AS DOUBLE) AS bet_amount,
 CAST(return_amount AS DOUBLE) AS return_amount, status IS NOT DISTINCT FROM 'C' AS is_cashout,
 is_system_bet IS NOT DISTINCT FROM 1 AS is_system_bet,
 create_user_date - INTERVAL '3' HOUR AS bet_timestamp, update_date - INTERVAL '3' HOUR AS update_timestamp
 FROM sport_bets JOIN sport_bet_masters USING (sport_bet_master_id) JOIN logged USING (sport_bet_master_id)
 JOIN ids USING (sport_bet_master_id) JOIN customers_tdt USING (customer_id)
 JOIN customer_details_tdt USING (customer_id)"""
_BETS_STEPS = {
    "ids": _ids_sql(ORDERS),
    "logged": _login_sql("sport_bets", "customer_login_logs"),
}


@query("bets_report", _BETS, _BETS_STEPS)
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(
        sports.bets_report(
            t.sport_bets,
            t.sport_bet_masters,
            t.customers_tdt,
            t.customer_details_tdt,
            t.customer_login_logs,
            _ids(t, ORDERS),
        )
    )


_EVENTS = """SELECT fixture_id AS event_id, sport_type_id AS sport_code, league_name AS competition,
 fixture_information AS event_name, if(status = 'O', '4', '5') AS event_status,
 fixture_start_date AS event_start_date FROM sport_selection SEMI JOIN ids USING (sport_bet_master_id)"""


@query("events_report", _EVENTS, {"ids": _ids_sql(ORDERS)})
def _(t: Tables) -> DataFrame:
    return sports.events_report(t.sport_selection, _ids(t, ORDERS))


_MARKETS = """SELECT sport_bet_detail_id AS market_id, fixture_id AS event_id, sport_bet_master_id AS bet_master_id,
 bet_type_name AS market_name, '1' AS market_type, CAST(played_odd AS DOUBLE) AS fixed_odds_market,
 CAST(played_amount AS DOUBLE) AS market_value, coalesce(map {'O': 'PENDING', 'C': 'CASHOUT', 'W': 'WON',
 'L': 'LOST', 'V': 'CANCELLED'}[status], 'SUSPENDED') AS market_result
 FROM sport_selection SEMI JOIN ids USING (sport_bet_master_id)"""


@query("markets_report", _MARKETS, {"ids": _ids_sql(ORDERS)})
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(sports.markets_report(t.sport_selection, _ids(t, ORDERS)))


def _reports(t: Tables) -> jobs.SportsReports:
    return jobs.sports_report_job(
        t.customer_transactions_sb,
        t.customer_transaction_details,
        t.sport_bet_masters,
        t.sport_selection,
        t.sport_bets,
        t.customers_tdt,
        t.customer_details_tdt,
        t.customer_login_logs,
        ORDERS,
    )


@query("sports_report_job", _MARKETS, {"ids": _ids_sql(ORDERS)})
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(_reports(t).markets)


@query("sports_report_job_ids", _ids_sql(ORDERS))
def _(t: Tables) -> DataFrame:
    return _reports(t).ids


@query("sports_report_job_bets", _BETS, _BETS_STEPS)
def _(t: Tables) -> DataFrame:
    return summary.money_as_double(_reports(t).bets)


@query("sports_report_job_events", _EVENTS, {"ids": _ids_sql(ORDERS)})
def _(t: Tables) -> DataFrame:
    return _reports(t).events


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)
