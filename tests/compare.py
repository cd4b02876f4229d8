"""Compares a Spark result with a DuckDB statement on the same files, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        raise ValueError("NaN in output; missing numbers must be null")
    if isinstance(value, Decimal):
        raise TypeError("decimal in output")
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def difference(df, con, sql: str) -> str | None:
    """None where both agree, else a short description."""
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    got_types = {c: DUCK_TYPES.get(t, t) for c, t in df.dtypes}
    if got_types != types:
        return f"types {got_types} != {types}"
    cursor = con.execute(sql)
    names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    got_names, got = rows_of(df.columns, df.collect())
    if got_names != names:
        return f"columns {got_names} != {names}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{got.total()} rows vs {want.total()}; {extra.total()} extra like "
            f"{list(extra)[:2]}, {missing.total()} missing like {list(missing)[:2]}"
        )
    return None if want else "no rows"
