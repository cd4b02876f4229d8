"""Every registered query against its SQL statement on the same files."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry_point
from stakeline import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
ORACLES = registry.oracle_sql()
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None


def test_every_query_has_a_statement_and_is_offered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[0] == "transaction_id" and df.columns[-1] == "id_sessao"
    assert not df.isEmpty()
