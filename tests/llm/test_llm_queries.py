"""The registered queries of this package."""

from __future__ import annotations

import pytest
from compare import connect, difference
from fixtures import FOLDER

import __spark_entry__ as entry_point
from stakeline.llm import queries

ORACLES = queries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert difference(queries.queries()[name](spark, FOLDER), duck, ORACLES[name]) is None


def test_one_query_per_operator():
    registered = entry_point.queries()
    for n in range(1, 14):
        assert len([q for q in registered if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in registered


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(spark, name, tmp_path):
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        whole = spark.read.parquet(f"{FOLDER}/{table}.parquet")
        whole.limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert queries.queries()[name](spark, str(tmp_path)).count() == 0
