"""Writing results."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeline.functions.times import business_day
from stakeline.session import shared_dir

DAY = "business_day"
# Rows of a row group in tables for lookups: what is read for a key that is there.
GROUP_ROWS = 100_000
# Folder of the innermost ``staging`` block.
_scope: ContextVar[str | None] = ContextVar("staging", default=None)


def with_day(df: DataFrame, ts: str = "transaction_date") -> DataFrame:
    """Adds the business day of ``ts``, the partition column of daily tables.

    A run over one business day then fills exactly one folder.
    """
    return df.withColumn(DAY, business_day(F.col(ts)))


def append_table(df: DataFrame, path: str, by: str | None = None) -> None:
    """Append, creating the table if missing. Running it twice stores the rows twice.

    ``by`` lays the table out in one folder per value. A day is spread over as many tasks as
    its rows need, so a busy day neither overloads a task nor leaves thousands of small files.
    """
    if by is None:
        df.write.mode("append").parquet(path)
    else:
        df.hint("rebalance", by).write.mode("append").partitionBy(by).parquet(path)


def replace_days(df: DataFrame, path: str, by: str = DAY) -> None:
    """Rewrite only the days present in ``df``: a repeated run leaves one copy."""
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def store_bucketed(df: DataFrame, name: str, path: str, by: str, buckets: int) -> DataFrame:
    """Catalog table laid out by a key; windows and joins on the key then need no shuffle.

    Stands in for the ledger's indexes. Each writing task fills one bucket, and a bucket with a
    hot key is shared by several tasks.
    """
    (
        df.hint("rebalance", buckets, by)
        .write.mode("overwrite")
        .bucketBy(buckets, by)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def store_for_lookup(
    df: DataFrame, path: str, key: str, order: tuple[str, ...] = (), group_rows: int = GROUP_ROWS
) -> None:
    """Table for reading the rows of one key: a few row groups of it, whatever its size.

    Rows are sorted by key and ``order`` over all files, so minima and maxima tell row groups and
    pages apart, and Bloom filters answer for keys that do not occur. The range partitioning cuts a
    key with very many rows, so no task has to hold one.
    """
    (
        df.repartitionByRange(key, *order)
        .sortWithinPartitions(key, *order)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.block.row.count.limit", str(group_rows))
        .parquet(path)
    )


def append_jdbc(
    df: DataFrame, url: str, table: str, batch_rows: int = 50_000, **options: str
) -> None:
    """Append to a database table in insert batches, one connection per partition."""
    df.write.format("jdbc").options(
        url=url, dbtable=table, batchsize=str(batch_rows), **options
    ).mode("append").save()


def copy_query(query: DataFrame, path: str) -> DataFrame:
    """Bulk copy of a query result into a table; returns the table."""
    append_table(query, path)
    return query.sparkSession.read.schema(query.schema).parquet(path)


def stage_view(df: DataFrame, name: str) -> DataFrame:
    """Name an intermediate result; a later call under the same name replaces it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def stage_table(
    df: DataFrame, name: str, folder: str | None = None, by: str | None = None
) -> DataFrame:
    """Drop and recreate a stored result and read it back.

    Without a folder it goes to a fresh one of the ``staging`` block around, or else under the
    application's id in the cluster's shared checkpoint folder, which ``drop_staged`` removes.
    ``by`` lays it out in a folder per value of a column of few values.
    """
    spark = df.sparkSession
    path = f"{folder or staging_folder(spark)}/{name}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staging_folder(spark: SparkSession) -> str:
    """A fresh folder that goes with the tables staged around."""
    return f"{_scope.get() or _staging(spark)}/{uuid4().hex}"


# How a sheet writes what a line of text cannot hold.
NULL_TEXT = "\\N"
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))
_SHEET = {"header": "true", "quote": '"', "escape": '"', "nullValue": NULL_TEXT, "emptyValue": ""}


def export_sheet(df: DataFrame, path: str, columns: list[str]) -> None:
    """Chosen columns in fixed order with a header line, replacing earlier output.

    Every task writes its own part file; nothing is gathered into one. Texts keep every
    character: a backslash is written twice, line breaks as ``\\n`` and ``\\r``, null as ``\\N``
    and an empty text as two quotes, so a row is one line and files can be split.
    """

    def escaped(name: str) -> Column:
        value = F.col(name).cast("string")
        for plain, written in _ESCAPES:
            value = F.replace(value, F.lit(plain), F.lit(written))
        return value.alias(name)

    (
        df.select(*[escaped(c) for c in columns])
        .write.mode("overwrite")
        .options(**{**_SHEET, "emptyValue": '""'})
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_sheet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The texts of an exported sheet as they were."""

    def unbroken(part: Column) -> Column:
        for plain, written in _ESCAPES[1:]:
            part = F.replace(part, F.lit(written), F.lit(plain))
        return part

    def restored(name: str) -> Column:
        # Pairs of backslashes from the left are backslashes; those left over begin a break.
        parts = F.transform(F.split(F.col(name), r"\\\\", -1), unbroken)
        return F.array_join(parts, "\\").alias(name)

    rows = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).options(**_SHEET)
    return rows.csv(path).select(*[restored(c) for c in columns])


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Owns the tables staged inside the block and deletes them, and no others, at its end.

    What is to outlive the block has to be stored before, by a sink or ``keep``. Blocks nest,
    and blocks of other threads and applications are left alone.
    """
    folder = f"{_staging(spark)}/job-{uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        _delete(spark, folder)


def keep(df: DataFrame, name: str) -> DataFrame:
    """A result stored outside all staging folders, in a fresh folder of the shared one."""
    return stage_table(df, name, f"{shared_dir(df.sparkSession)}/results/{uuid4().hex}")


def drop_staged(spark: SparkSession) -> None:
    """Deletes all tables this application has staged without a folder of its own.

    For the end of an application: results that still read staged tables have to be stored before.
    """
    _delete(spark, _staging(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _staging(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
