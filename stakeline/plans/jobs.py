"""The jobs: operators composed from source rows to results."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakeline.functions.codes import matches_core_pattern
from stakeline.functions.times import within
from stakeline.functions.values import int_floor
from stakeline.operators.enrich import (
    bets_extract,
    bets_lookup,
    dim_lookup,
    fill_forward,
    fill_from_lookup,
    find_hot_histories,
    update_attributes,
)
from stakeline.operators.lanes import HotKeys, all_present, find_hot, merge
from stakeline.operators.quality import (
    duplicate_report,
    has_rows,
    null_report,
    require_columns,
    row_count,
    sort_transactions,
)
from stakeline.operators.routing import route_complete, route_types
from stakeline.operators.sessions import (
    CUSTOMER,
    LOCAL,
    count_up,
    customer_shift,
    flagged_lanes,
    ledger_rows,
    shifted,
)
from stakeline.operators.sports import (
    bets_report,
    events_report,
    id_range,
    markets_report,
    sport_bet_ids,
)
from stakeline.operators.summary import (
    AMOUNT,
    SESSION_KEYS,
    TYPE,
    money_as_double,
    other_types,
    other_types_output,
    session_summary,
    with_session_metrics,
)
from stakeline.params import (
    DEFAULT_SKEW,
    ESSENTIALS,
    FIRST_SESSION_ID,
    SESSION_GAP_SECONDS,
    SkewPolicy,
    TimeWindow,
)
from stakeline.sources.commits import LoadedTables
from stakeline.sources.schemas import LEDGER_VIEW
from stakeline.sources.sinks import stage_table, staging
from stakeline.sources.tables import conform, scan_view

TREATED_TYPE = "csn_cust_transaction_type_id_tratado"
BRANCH = "branch"


class OnlineGames(NamedTuple):
    core: DataFrame
    other: DataFrame
    nulls: DataFrame


def online_games_job(view: DataFrame, window: TimeWindow) -> OnlineGames:
    """Scan a window, conform, split off other types, then incomplete rows; sort the rest.

    Each output scans the view when it is used; ``store_online_games`` scans it once for all.
    """
    rows = conform(scan_view(view, window), LEDGER_VIEW).withColumn(
        TREATED_TYPE, int_floor(F.col("csn_cust_transaction_type_id"))
    )
    core, other = route_types(rows, TREATED_TYPE)
    complete, nulls = route_complete(core)
    return OnlineGames(sort_transactions(complete), other, nulls)


def store_online_games(view: DataFrame, window: TimeWindow, path: str) -> OnlineGames:
    """The outputs of ``online_games_job`` from one scan, written in a folder per branch."""
    rows = conform(scan_view(view, window), LEDGER_VIEW).withColumn(
        TREATED_TYPE, int_floor(F.col("csn_cust_transaction_type_id"))
    )
    core = matches_core_pattern(F.col(TREATED_TYPE))
    branch = (
        F.when(core & all_present(ESSENTIALS), "core").when(core, "nulls").otherwise("other")
    )
    rows.withColumn(BRANCH, branch).write.partitionBy(BRANCH).parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField(BRANCH, T.StringType())])
    stored = view.sparkSession.read.schema(schema).parquet(path)
    core, other, nulls = (
        stored.where(F.col(BRANCH) == name).drop(BRANCH) for name in ("core", "other", "nulls")
    )
    return OnlineGames(sort_transactions(core), other, nulls)


def enrich_game_job(
    ledger: DataFrame,
    bets: DataFrame,
    games: DataFrame,
    categories: DataFrame,
    ledger_window: TimeWindow,
    bets_window: TimeWindow,
    skew: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Ledger rows of a window with game ids filled from bets, then from earlier rows."""
    rows = ledger.where(within(F.col("transaction_date"), ledger_window))
    extract = bets_extract(bets, games, categories, bets_window)
    hot = find_hot_histories(rows, skew)
    lookup = bets_lookup(extract)
    if hot.values:
        # Read by both parts of the ledger; the ledger itself is split below the join.
        lookup = stage_table(lookup, "bets_lookup")
    return fill_forward(rows, skew, hot, lambda part: fill_from_lookup(part, lookup))


class SessionSummary(NamedTuple):
    summary: DataFrame
    other: DataFrame


def _number_rows(
    ledger: DataFrame, window: TimeWindow, gap: float, skew: SkewPolicy, hot: HotKeys | None
) -> DataFrame:
    """The window's complete rows, stored under their session's number within the customer."""
    found = flagged_lanes(ledger_rows(ledger, window), gap, skew, hot)
    counted = merge([count_up(lane, shared_ties=False).rows() for lane in found])
    return stage_table(
        counted.select(
            "customer_transaction_id", *CUSTOMER, LOCAL, "csn_game_id", TYPE, AMOUNT,
            "transaction_date",
        ),
        "numbered_rows",
    )


def _summaries(numbered: DataFrame, start_id: int) -> SessionSummary:
    """Both outputs from stored numbered rows."""
    totals = numbered.groupBy(*CUSTOMER).agg(F.max(LOCAL).alias("_sessions"))
    shift = customer_shift(totals, "_sessions")
    local = session_summary(numbered, session=LOCAL)
    summary = with_session_metrics(shifted(local.join(shift, [*CUSTOMER]), "sessionid", start_id))
    other = shifted(other_types(numbered).join(shift, [*CUSTOMER]), "sessionid", start_id)
    measures = [c for c in summary.columns if c not in SESSION_KEYS]
    return SessionSummary(
        money_as_double(summary.select(*SESSION_KEYS, *measures)),
        money_as_double(other_types_output(other)),
    )


def session_summary_job(
    ledger: DataFrame,
    window: TimeWindow,
    start_id: int = FIRST_SESSION_ID,
    gap: float = SESSION_GAP_SECONDS,
    skew: SkewPolicy = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> SessionSummary:
    """Sessionize a window, summarise its sessions and list its non-core rows.

    The ledger is read, sorted and numbered once; both outputs come from the narrow rows stored
    then. Sessions are summarised under their number within the customer, and ids over all
    customers are given to the sessions.
    """
    return _summaries(_number_rows(ledger, window, gap, skew, hot), start_id)


class LoadReport(NamedTuple):
    """What a load found: rows in the window, nulls per essential column, rows whose customer and
    session occur more than once, the id it continued from (null if it stored nothing), and
    whether the window had been loaded before."""

    rows: int
    nulls: dict[str, int]
    repeated: int
    start_id: int | None
    known: bool = False


SUMMARY, OTHER = "session_summary", "other_types"


def load_sessions(
    ledger: DataFrame,
    window: TimeWindow,
    root: str,
    gap: float = SESSION_GAP_SECONDS,
    skew: SkewPolicy = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> LoadReport:
    """Append a window's sessions and non-core rows to the tables under ``root``, ids continued.

    Both tables change in one step. A window that was loaded is skipped, and one that overlaps a
    loaded one is refused, so a load can be repeated after a crash at any point. Ids start above
    the greatest one published, which is read from the log of loads. A window without complete
    rows stores nothing. Nulls are counted by the pass that numbers the rows.
    """
    spark = ledger.sparkSession
    tables = LoadedTables(spark, root)
    key = f"{window.start}/{window.end}"
    for commit in tables.commits():
        if commit.key == key:
            counts = dict(commit.details)
            nulls = {c: counts[f"{c}_nulls"] for c in ESSENTIALS}
            return LoadReport(counts["rows"], nulls, counts["repeated"], counts["start_id"], True)
        start, end = commit.key.split("/")
        if start <= str(window.end) and str(window.start) <= end:
            raise ValueError(f"window {key} overlaps the loaded one {commit.key}")
    load = tables.begin(key)
    with staging(spark):
        in_window = ledger.where(within(F.col("transaction_date"), window))
        hot = hot or find_hot(ledger_rows(ledger, window), CUSTOMER, skew)
        seen = Observation()
        nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in ESSENTIALS]
        watched = in_window.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls)
        numbered = _number_rows(watched, window, gap, skew, hot)
        if not has_rows(numbered):
            # Spark drops an empty plan with its observation.
            found = null_report(in_window).first()
            nulls = {c: found[f"{c}_nulls"] for c in ESSENTIALS}
            return LoadReport(found["row_count"], nulls, 0, None)
        counts = dict(seen.get)
        nulls = {c: counts[f"{c}_nulls"] for c in ESSENTIALS}
        by_session = duplicate_report(numbered, (*CUSTOMER, LOCAL), skew, hot)
        counts["repeated"] = row_count(by_session, "repeated").first()["row_count"]
        last = tables.greatest_id()
        counts["start_id"] = FIRST_SESSION_ID if last is None else last + 1
        summary, other = _summaries(numbered, counts["start_id"])
        ids = Observation()
        load.write(summary.observe(ids, F.max("sessionid").alias("greatest")), SUMMARY)
        load.write(other, OTHER)
        load.publish(ids.get["greatest"], **counts)
    return LoadReport(counts["rows"], nulls, counts["repeated"], counts["start_id"])


def loaded_sessions(spark: SparkSession, root: str) -> SessionSummary:
    """Both tables of ``load_sessions``, as far as published."""
    tables = LoadedTables(spark, root)
    return SessionSummary(tables.read(SUMMARY), tables.read(OTHER))


def attach_dims_job(sessions: DataFrame, games: DataFrame, categories: DataFrame) -> DataFrame:
    """Stored sessions with category and vendor name of their game.

    The lookup is not reduced to the game ids in use first: the join drops the others anyway,
    and collecting the ids would read the sessions twice.
    """
    require_columns(sessions, ["category", "vendor_game_name"])
    return update_attributes(sessions, dim_lookup(games, categories))


class SportsReports(NamedTuple):
    ids: DataFrame
    bets: DataFrame
    events: DataFrame
    markets: DataFrame


def sports_report_job(
    transactions: DataFrame,
    details: DataFrame,
    masters: DataFrame,
    selections: DataFrame,
    bets: DataFrame,
    customers: DataFrame,
    customer_details: DataFrame,
    logins: DataFrame,
    window: TimeWindow,
    skew: SkewPolicy = DEFAULT_SKEW,
) -> SportsReports:
    """Bet ids of a window and the three reports on them.

    All reports filter by the ids, so these are stored once instead of computed three times. Their
    range prunes the histories, and lets Spark make a Bloom filter of them.
    """
    ids = stage_table(
        sport_bet_ids(transactions, details, masters, selections, window), "sport_bet_ids"
    )
    near = id_range(ids)
    selections, chosen = selections.where(near), ids.where(near)
    return SportsReports(
        ids,
        bets_report(
            bets.where(near), masters.where(near), customers, customer_details, logins, chosen, skew
        ),
        events_report(selections, chosen),
        markets_report(selections, chosen),
    )
