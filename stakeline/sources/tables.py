"""Reading tables and bringing them to a known shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakeline.functions.times import business_day, ntz, within
from stakeline.functions.values import all_digits, convert
from stakeline.params import FIRST_SESSION_ID, TimeWindow


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder or file at ``path``, in whatever store it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    fetch_rows: int = 50_000,
    **options: str,
) -> DataFrame:
    """Database table read in parallel ranges, rows streamed in blocks.

    Spark turns later filters and projections on it into the database query. Connection
    options (driver, user, password) come from the caller only.
    """
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=str(partitions),
            fetchsize=str(fetch_rows),
            **options,
        )
        .load()
    )


def extract_transactions(
    src: DataFrame, window: TimeWindow, strict: bool = True, day_column: str | None = None
) -> DataFrame:
    """Seven ledger columns inside the window, customer code as a number.

    ``day_column`` names the business-day partition column of a table written by
    ``append_table``; the window then also prunes whole day folders.
    """
    rows = src.where(within(F.col("transaction_date"), window))
    if day_column:
        rows = rows.where(
            F.col(day_column).between(
                business_day(ntz(window.start)), business_day(ntz(window.end))
            )
        )
    return rows.select(
        "customer_transaction_id",
        "csn_customer_id",
        "csn_cust_transaction_type_id",
        "amount_from_balance",
        "transaction_date",
        convert(F.col("customer_code"), "long", strict).alias("customer_code"),
        "current_balance",
    )


def scan_view(view: DataFrame, window: TimeWindow) -> DataFrame:
    """Whole rows of a view between two positional parameters."""
    return view.sparkSession.sql(
        "SELECT * FROM {view} WHERE transaction_date"
        " BETWEEN CAST(? AS TIMESTAMP_NTZ) AND CAST(? AS TIMESTAMP_NTZ)",
        args=[str(window.start), str(window.end)],
        view=view,
    )


def conform(
    df: DataFrame,
    schema: T.StructType,
    renames: dict[str, str] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Only the schema's columns, in its order and types; ``renames`` maps old to new names.

    A strict conversion to decimals refuses values whose digits would be rounded away.
    """
    renames = renames or {}

    def converted(field: T.StructField) -> Column:
        value, kind = F.col(field.name), field.dataType
        cast = convert(value, kind.simpleString(), strict)
        if not strict or not isinstance(kind, T.DecimalType):
            return cast
        given = df.schema[field.name].dataType
        if isinstance(given, T.IntegralType) or (
            isinstance(given, T.DecimalType) and given.scale <= kind.scale
        ):
            return cast
        return all_digits(value, cast, given, kind)

    return df.select(
        *[
            converted(f).alias(renames.get(f.name, f.name)) for f in schema.fields
        ]
    )


def next_session_start(
    sessions: DataFrame, default: int = FIRST_SESSION_ID, column: str = "sessionid"
) -> DataFrame:
    """One row: stored maximum + 1, or ``default`` where nothing is stored."""
    return sessions.agg(F.coalesce(F.max(column) + 1, F.lit(default)).alias("start_id"))


def high_water_mark(
    sessions: DataFrame | None, default: int = FIRST_SESSION_ID, column: str = "sessionid"
) -> int:
    """``next_session_start`` as a number; a missing table gives ``default``."""
    if sessions is None:
        return default
    return next_session_start(sessions, default, column).first()["start_id"]
