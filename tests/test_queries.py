"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.check_oracles import compare, database

FOLDER = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    good, note = compare(spark, connection, FOLDER, queries()[name], ORACLES[name])
    assert good, note


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(queries())


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["win", "srcAddr", "sumOfFlows", "sumOfBytes", "uniqDstIPs",
                             "uniqDstPorts", "numRecords"]
    assert frame.count() > 0
