"""Every query against its SQL check on the whole smallest tables."""

import pytest

import __spark_entry__ as entry_point
from tests.oracle import connect, differences
from trendloom.schema import TREND_SCHEMA
from trendloom.workload import files, operators, plans

FOLDER = "/root/testdata/sf0.001"
OWN = {**operators.QUERIES, **plans.QUERIES, **files.QUERIES}
CHECKS = {name: sql for name, sql in entry_point.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_query_has_a_check():
    assert set(CHECKS) == set(OWN) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_rows(spark, tables, name):
    df = entry_point.queries()[name](spark, FOLDER)
    assert differences(df, CHECKS[name], tables) is None


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_indicators_share_one_schema(spark, name):
    df = plans.QUERIES[name](spark, FOLDER)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TREND_SCHEMA]


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
