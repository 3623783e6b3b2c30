"""Rows dated before and after the years that the SQL checks list."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.oracle import connect, differences
from trendloom.workload import operators, plans
from trendloom.workload.views import with_views

FOLDER = "/root/testdata/sf0.001"
QUERIES, CHECKS = {**operators.QUERIES, **plans.QUERIES}, {**operators.CHECKS, **plans.CHECKS}
LISTED, WIDER = range(1995, 2002), range(1993, 2006)


# What lists the years in the checks, and the same with the years of the wider tables.
LISTS = [
    ("TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01'", "TIMESTAMP '1993-01-01', TIMESTAMP '2005-12-01'"),
    ("range(1995, 2002)", "range(1993, 2006)"),
    ("(1995, 1997, 1996)", "(1993, 1997, 1996)"),
    ("(2000, 2001, 2001)", "(2000, 2005, 2005)"),
    (plans._values((y,) for y in LISTED), plans._values((y,) for y in WIDER)),
    (", ".join(map(str, LISTED)), ", ".join(map(str, WIDER))),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables, with some of their rows again in 1993 and 2005."""
    out = tmp_path_factory.mktemp("years")
    for file in os.listdir(FOLDER):
        if file not in ("lineitem.parquet", "orders.parquet"):
            os.symlink(f"{FOLDER}/{file}", out / file)
    for name, date, key in (("lineitem", "l_shipdate", "l_orderkey"), ("orders", "o_orderdate", "o_orderkey")):
        rows = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        for year in (1993, 2005):
            some = rows.filter(F.col(key) % 100 == 1).withColumn(date, F.lit(dt.datetime(year, 6, 1)).cast(rows.schema[date].dataType))
            rows = rows.unionByName(some)
        rows.toPandas().to_parquet(out / f"{name}.parquet", coerce_timestamps="us", index=False)
    return str(out)


@pytest.mark.parametrize("name", ["melt_headers", "transit_trends", "monthly_jobs", "jobs_trends", "housing_trends", "population_trends", "acs_indicator", "acs_trends"])
def test_no_year_is_lost(spark, folder, name):
    sql = CHECKS[name]
    for old, new in LISTS:
        sql = sql.replace(old, new)
    assert differences(QUERIES[name](spark, folder), with_views(sql), connect(folder)) is None
