from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from ledger import at, ledger
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stakeline.functions import codes
from stakeline.functions.times import business_day, parse_timestamp, tz_shift
from stakeline.functions.values import convert, int_floor
from stakeline.operators import quality, routing, sessions, sports
from stakeline.params import TimeWindow
from stakeline.plans.jobs import online_games_job, sports_report_job, store_online_games
from stakeline.session import shared_dir
from stakeline.sources import schemas, sinks, tables

DAY = TimeWindow.of("2024-10-07 06:00:00", "2024-10-08 05:59:59")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_parameters_have_fallbacks():
    assert TimeWindow.from_variables({}).end == datetime(2024, 12, 31, 23, 59, 59)
    given = {"DATA_INI": "2024-12-03 06:00:00", "DATA_FIM": "2024-12-04 05:59:59"}
    window = TimeWindow.from_variables(given, "DATA_INI", "DATA_FIM")
    assert window == TimeWindow.of("2024-12-03 06:00:00", "2024-12-04 05:59:59")
    with pytest.raises(ValueError):
        TimeWindow.of("03/12/2024", "2024-12-04 05:59:59")


def test_scalar_functions(spark):
    assert value(spark, int_floor(F.lit(-1.5))) == -2
    assert value(spark, int_floor(F.lit(7))) == 7
    assert value(spark, parse_timestamp(F.lit("2024-10-07 06:00:01"))) == at("06:00:01")
    assert value(spark, tz_shift(F.lit(at("02:00:00")).cast("timestamp_ntz"), -3)) == datetime(
        2024, 10, 6, 23
    )
    assert str(value(spark, business_day(F.lit(at("05:59:59")).cast("timestamp_ntz")))) == "2024-10-06"


def test_strict_and_lenient_cast(spark):
    assert value(spark, convert(F.lit("12"), "long")) == 12
    assert value(spark, convert(F.lit("x"), "long", strict=False)) is None
    with pytest.raises(PySparkException):
        value(spark, convert(F.lit("x"), "long"))


@pytest.mark.parametrize(
    "status, bet, event, market, cashout",
    [
        ("O", "1", "4", "PENDING", False),
        ("W", "2", "5", "WON", False),
        ("L", "3", "5", "LOST", False),
        ("V", "3", "5", "CANCELLED", False),
        ("C", "2", "5", "CASHOUT", True),
        ("X", "2", "5", "SUSPENDED", False),
        (None, "2", "5", "SUSPENDED", False),
    ],
)
def test_status_labels(spark, status, bet, event, market, cashout):
    code = F.lit(status).cast("string")
    assert value(spark, codes.bet_status(code)) == bet
    assert value(spark, codes.event_status(code)) == event
    assert value(spark, codes.market_result(code)) == market
    assert value(spark, codes.is_cashout(code)) is cashout


@pytest.mark.parametrize("kind, core", [(1, True), (15, True), (115, False), (3, False), (None, False)])
def test_type_tests_agree(spark, kind, core):
    kind = F.lit(kind).cast("long")
    assert value(spark, codes.matches_core_pattern(kind)) is core
    assert value(spark, codes.is_core(kind)) is core
    assert value(spark, codes.none_of(kind, (1, 2, 8, 15))) is not core


def test_bet_type_and_system(spark):
    assert [value(spark, codes.bet_type(F.lit(v).cast("long"))) for v in (1, 2, None)] == ["1", "2", "2"]
    flags = [value(spark, codes.is_system_bet(F.lit(v).cast("long"))) for v in (1, 0, None)]
    assert flags == [True, False, False]


def test_conform_selects_renames_and_types(spark):
    df = spark.createDataFrame([("x", "7", "1.2300")], "extra string, id string, money string")
    schema = schemas._schema(money=schemas.MONEY, id=schemas.ID)
    got = tables.conform(df, schema, renames={"id": "key"})
    assert got.dtypes == [("money", "decimal(18,2)"), ("key", "bigint")]
    assert got.first() == (Decimal("1.23"), 7)
    bad = spark.createDataFrame([("x",)], "id string")
    with pytest.raises(PySparkException):
        tables.conform(bad, schemas._schema(id=schemas.ID)).collect()
    assert tables.conform(bad, schemas._schema(id=schemas.ID), strict=False).first().id is None


def test_routing_is_complete(spark):
    df = ledger(
        spark, [(i, 1 if i % 3 else None, "10:00:00", k, 1, 1) for i, k in enumerate([1, 3, None, 15, 8])]
    )
    for held, other in (
        routing.route(df, F.col("csn_cust_transaction_type_id") > 2),
        routing.route_types(df, "csn_cust_transaction_type_id"),
        routing.route_complete(df),
    ):
        ids = [r.customer_transaction_id for r in held.union(other).collect()]
        assert sorted(ids) == [0, 1, 2, 3, 4]
    assert routing.route_types(df, "csn_cust_transaction_type_id")[1].count() == 2


def test_online_games_job(spark):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.LEDGER_VIEW)
    rows = [
        (3, 1, 9, None, at("10:00:00"), "9", None, 5, "g", "t", None),
        (2, 15, 4, None, at("11:00:00"), "4", None, 5, "g", "t", None),
        (1, 1, 9, None, at("09:00:00"), "9", None, 5, "g", "t", None),
        (4, 8, 9, None, at("09:00:00"), "9", None, None, None, "t", None),
        (5, 3, 9, None, at("09:00:00"), "9", None, 5, "g", "t", None),
        (6, None, 9, None, at("09:00:00"), "9", None, 5, "g", "t", None),
        (7, 1, 9, None, at("05:00:00"), "9", None, 5, "g", "t", None),
    ]
    out = online_games_job(spark.createDataFrame(rows, columns), DAY)
    assert [r.customer_transaction_id for r in out.core.collect()] == [2, 1, 3]
    assert {r.customer_transaction_id for r in out.other.collect()} == {5, 6}
    assert {r.customer_transaction_id for r in out.nulls.collect()} == {4}


def test_strict_conform_loses_no_digits(spark):
    schema = schemas._schema(money=schemas.MONEY)
    for kind, good, bad in (
        ("string", "-1.5", "1.239"),
        ("double", 0.29, 0.291),
        ("decimal(18,4)", Decimal("0.2900"), Decimal("0.0050")),
        ("decimal(38,18)", Decimal("0.29"), Decimal("0.290000000000000001")),
    ):
        df = spark.createDataFrame([(good,), (None,)], f"money {kind}")
        got = [r.money for r in tables.conform(df, schema).collect()]
        assert got == [Decimal(str(good)), None]
        df = spark.createDataFrame([(bad,)], f"money {kind}")
        with pytest.raises(PySparkException, match="does not fit"):
            tables.conform(df, schema).collect()
        assert tables.conform(df, schema, strict=False).first().money is not None


def test_stored_online_games(spark, tmp_path):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.LEDGER_VIEW)
    rows = [
        (i, kind, i % 3 or None, None, at("10:00:00"), "9", None, i % 4 or None, "g", "t", None)
        for i, kind in enumerate([1, 2, 3, None, 8, 15, 1, 4, 2, 8, 1, 2, 15])
    ]
    df = spark.createDataFrame(rows, columns)
    one, other = online_games_job(df, DAY), store_online_games(df, DAY, str(tmp_path / "out"))
    for a, b in zip(one, other, strict=True):
        assert a.dtypes == b.dtypes and a.collect() and sorted(map(str, a.collect())) == sorted(
            map(str, b.collect())
        )


def test_quality_reports(spark):
    df = ledger(spark, [(1, 1, "10:00:00", 1, 1, None), (2, None, "10:00:00", 1, 1, 4)])
    report = quality.null_report(df).first()
    assert (report.row_count, report.csn_game_id_nulls, report.transaction_date_nulls) == (2, 1, 0)
    assert report.has_nulls
    clean = quality.null_report(df.where("csn_game_id = 4"), ["csn_game_id"]).first()
    assert not clean.has_nulls
    assert quality.null_report(df.limit(0)).first().has_nulls is False
    assert quality.has_rows(df) and not quality.has_rows(df.where("false"))
    with pytest.raises(ValueError, match="category"):
        quality.require_columns(df, ["csn_game_id", "category"])
    assert quality.require_columns(df, ["csn_game_id"]) is df


def test_daily_table(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = ledger(
        spark,
        [
            (1, 1, at("06:00:00"), 1, 1, 5),
            (2, 1, at("05:00:00").replace(day=8), 1, 1, 5),
            (3, 1, at("06:00:00").replace(day=8), 1, 1, 5),
        ],
    ).withColumn("customer_code", F.lit("12"))
    daily = sinks.with_day(rows)
    sinks.replace_days(daily, path)
    sinks.replace_days(daily.where("business_day = date'2024-10-08'"), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 3
    got = tables.extract_transactions(stored, DAY, day_column=sinks.DAY)
    assert {r.customer_transaction_id for r in got.collect()} == {1, 2}
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(business_day" in plan
    sinks.append_table(daily, path, by=sinks.DAY)
    assert spark.read.parquet(path).count() == 6


def test_bucketed_ledger_needs_no_shuffle(spark, tmp_path):
    rows = [(i, i % 5, f"10:{i:02d}:00", 1, 1, i % 2) for i in range(40)]
    plain = ledger(spark, rows)
    path = str(tmp_path / "bucketed")
    stored = sinks.store_bucketed(plain, "ledger_by_customer", path, "csn_customer_id", 4)
    try:
        seen = sessions.with_previous(stored)
        assert "hashpartitioning(csn_customer_id" not in seen._jdf.queryExecution().toString()
        assert sorted(seen.collect()) == sorted(sessions.with_previous(plain).collect())
    finally:
        spark.sql("DROP TABLE ledger_by_customer")


def test_append_creates_then_adds(spark, tmp_path):
    path = str(tmp_path / "plain")
    df = spark.range(3)
    sinks.append_table(df, path)
    sinks.append_table(df, path)
    assert spark.read.parquet(path).count() == 6
    assert sinks.copy_query(df, path).count() == 9
    watched, seen = quality.counted(df, "loaded")
    sinks.append_table(watched, path)
    assert seen.get == {"row_count": 3}


def test_staging_replaces(spark, tmp_path):
    folder = str(tmp_path)
    assert sinks.stage_table(spark.range(3), "t", folder).count() == 3
    assert sinks.stage_table(spark.range(2), "t", folder).count() == 2
    assert sinks.stage_view(spark.range(4), "staged").count() == 4
    assert sinks.stage_view(spark.range(5), "staged").count() == 5


def test_sheet_has_header_and_order(spark, tmp_path):
    path = tmp_path / "sheet"
    df = spark.createDataFrame([(1, "a", 2)], "x long, y string, z long").coalesce(1)
    sinks.export_sheet(df, str(path), ["z", "y"])
    (part,) = path.glob("part-*.csv")
    assert part.read_text() == "z,y\n2,a\n"
    sinks.export_sheet(df, str(path), ["x"])
    (part,) = path.glob("part-*.csv")
    assert part.read_text() == "x\n1\n"


def test_sheet_keeps_texts(spark, tmp_path):
    texts = [
        "  padded ", "", None, "two\nlines", "a\r\nb", 'say "hi"', '"', "a,b", "\\N", "\\\\n", "\\",
        "end\\", "#x", "\t", "null", "é漢",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, note string")
    path = str(tmp_path / "sheet")
    sinks.export_sheet(df, path, ["note", "id"])
    back = sinks.read_sheet(spark, path, ["note", "id"])
    assert {int(r.id): r.note for r in back.collect()} == dict(enumerate(texts))
    # A row is one line, so files can be split.
    lines = [x for p in (tmp_path / "sheet").glob("part-*") for x in p.read_text().split("\n")[1:-1]]
    assert len(lines) == len(texts)


def test_staged_tables_can_be_dropped(spark):
    staged = sinks.stage_table(spark.range(3), "t")
    folder = staged.inputFiles()[0].rsplit("/t/", 1)[0]
    assert tables.table_exists(spark, folder)
    sinks.drop_staged(spark)
    assert not tables.table_exists(spark, folder)


class Recorder:
    """Stands in for a reader or writer and keeps the options it is given."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def load(self):
        return self.seen

    def save(self):
        return None


def test_jdbc_options():
    """No database may be opened here, so only what would be asked of it is checked."""

    class Holder:
        read = write = Recorder()

    seen = tables.read_jdbc(
        Holder, "jdbc:x", "t", "transaction_date", "2024-10-07", "2024-10-08", 12, driver="d"
    )
    assert seen == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "t",
        "partitionColumn": "transaction_date",
        "lowerBound": "2024-10-07",
        "upperBound": "2024-10-08",
        "numPartitions": "12",
        "fetchsize": "50000",
        "driver": "d",
    }
    Holder.write = Recorder()
    sinks.append_jdbc(Holder, "jdbc:x", "t")
    assert Holder.write.seen == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "t",
        "batchsize": "50000",
        "mode": "append",
    }


class FakeSession:
    """A session with a given master, named folder and checkpoint folder."""

    def __init__(self, master, named=None, folder=None):
        self.master, self.folder = master, folder
        self.sparkContext = self.conf = self
        self.get = lambda key, default: named or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_dir():
    assert shared_dir(FakeSession("yarn", "hdfs:/shared", "hdfs:/other")) == "hdfs:/shared"
    assert shared_dir(FakeSession("yarn", None, "hdfs:/other")) == "hdfs:/other"
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert shared_dir(local) == shared_dir(local)


def test_sport_bet_ids(spark):
    transactions = spark.createDataFrame(
        [(1, 10), (2, 10), (3, 11), (4, None), (5, 12), (6, 13), (7, 14)],
        "customer_transaction_id long, sport_bet_master_id long",
    )
    # Six hours are taken off, so the window 00:00-23:59:59 means 06:00-05:59:59 stored.
    times = {1: "06:00:00", 2: "07:00:00", 3: "05:59:59", 4: "08:00:00", 5: "09:00:00", 6: "09:00:00"}
    details = spark.createDataFrame(
        [(i, at(t)) for i, t in times.items()],
        "customer_transaction_id long, transaction_date timestamp_ntz",
    )
    masters = spark.createDataFrame([(10,), (11,), (12,)], "sport_bet_master_id long")
    legs = spark.createDataFrame([(10,), (10,), (11,), (13,)], "sport_bet_master_id long")
    window = TimeWindow.of("2024-10-07 00:00:00", "2024-10-07 23:59:59")
    got = sports.sport_bet_ids(transactions, details, masters, legs, window)
    assert [r.sport_bet_master_id for r in got.collect()] == [10]


def test_sports_job_keeps_fan_out(spark):
    master = "sport_bet_master_id long"
    transactions = spark.createDataFrame([(1, 10)], f"customer_transaction_id long, {master}")
    details = spark.createDataFrame(
        [(1, at("12:00:00"))], "customer_transaction_id long, transaction_date timestamp_ntz"
    )
    masters = spark.createDataFrame(
        [(10, 5, 1)], f"{master}, initial_played_amount long, is_system_bet long"
    )
    legs = tables.conform(
        spark.createDataFrame(
            [(10, 100, 7, 3, "l", "f", at("13:00:00"), "W", "b", 1, 2)],
            f"{master}, sport_bet_detail_id long, fixture_id long, sport_type_id long,"
            " league_name string, fixture_information string, fixture_start_date timestamp_ntz,"
            " status string, bet_type_name string, played_odd long, played_amount long",
        ),
        schemas.SPORT_SELECTION,
    )
    bets = spark.createDataFrame(
        [(10, 1, 1, "O", 2, 3, at("12:00:00"), at("12:30:00"))],
        f"{master}, customer_id long, total_play long, status string, bet_rate long,"
        " return_amount long, create_user_date timestamp_ntz, update_date timestamp_ntz",
    )
    customers = spark.createDataFrame([(1,)], "customer_id long")
    twice = spark.createDataFrame([(1,), (1,)], "customer_id long")
    logins = spark.createDataFrame(
        [(1, at("11:00:00"), "a")], "customer_id long, date_time timestamp_ntz, ip string"
    )
    window = TimeWindow.of("2024-10-07 00:00:00", "2024-10-07 23:59:59")
    out = sports_report_job(
        transactions, details, masters, legs, bets, customers, twice, logins, window
    )
    rows = out.bets.collect()
    assert len(rows) == 2 and {r.ip_address for r in rows} == {"a"}
    assert rows[0].bet_timestamp == at("09:00:00") and rows[0].is_system_bet
    assert out.events.first().event_status == "5"
    assert out.markets.first().market_result == "WON"
