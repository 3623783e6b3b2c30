"""Laws the operators keep on arbitrary rows."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from trendloom.operators import aggregate, periods, reshape, series

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.sampled_from(["a", "b", "c", None])
whole = st.integers(0, 1000).map(float)
cells = st.lists(st.tuples(keys, st.sampled_from(["x", "y", "z"]), whole), min_size=1, max_size=30)
months = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.dates(dt.date(2018, 1, 1), dt.date(2021, 12, 31)), whole),
    min_size=1, max_size=40,
)


def frame(spark, data):
    return spark.createDataFrame(data, "k string, geography string, estimate double")


@SLOW
@given(cells)
def test_shares_of_a_group_sum_to_one(spark, data):
    shared = series.share_of_total(frame(spark, data), ["k"])
    assert shared.count() == len(data)
    for total, share in shared.groupBy("k").agg(F.sum("estimate"), F.sum("share")).select("sum(estimate)", "sum(share)").collect():
        assert share is None if total == 0 else abs(share - 1) < 1e-9


@SLOW
@given(cells)
def test_region_is_the_sum_of_its_members(spark, data):
    by_place = aggregate.sum_by(frame(spark, data), ["k", "geography"])
    got = {r.k: r.estimate for r in aggregate.region_rollup(by_place, ["k"]).filter("geography = 'Region'").collect()}
    want = defaultdict(float)
    for k, _, v in data:
        want[k] += v
    assert got == dict(want)


@SLOW
@given(months)
def test_level_minus_change_is_the_previous_level(spark, data):
    df = spark.createDataFrame(data, "k string, date date, estimate double").withColumn("year", F.year("date"))
    yearly = aggregate.sum_by(df, ["k", "year"])
    got = series.lag_change(yearly, ["k"], "year").collect()
    levels = defaultdict(dict)
    for r in got:
        levels[r.k][r.year] = r.estimate
    for r in got:
        before = [y for y in levels[r.k] if y < r.year]
        assert (r.change is None) if not before else r.estimate - r.change == levels[r.k][max(before)]


@SLOW
@given(months)
def test_annual_is_the_sum_of_its_months_and_not_below_year_to_date(spark, data):
    df = spark.createDataFrame(data, "k string, date date, estimate double")
    got = {(r.grouping, r.k, r.year): r.estimate for r in periods.period_summary(df, ["k"], 2020, 6).collect()}
    annual, ytd = defaultdict(float), defaultdict(float)
    for k, d, v in data:
        if d.year <= 2020:
            annual["Annual", k, str(d.year)] += v
        if d.month <= 6:
            ytd["YTD", k, str(d.year)] += v
    assert got == {**annual, **ytd}
    for (grouping, k, year), value in got.items():
        if grouping == "YTD" and ("Annual", k, year) in got:
            assert value <= got["Annual", k, year]


@SLOW
@given(st.dictionaries(st.tuples(st.sampled_from("abc"), st.sampled_from("xyz")), whole, min_size=1))
def test_melt_undoes_spread(spark, data):
    long = spark.createDataFrame([(*k, v) for k, v in data.items()], "id string, variable string, estimate double")
    back = reshape.melt(reshape.spread(long, ["id"], "variable", list("xyz")), ["id"], drop_null=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


@SLOW
@given(st.lists(st.tuples(st.sampled_from(["d1", "d2"]), st.sampled_from(["p", "q", "r"]), whole), min_size=1, max_size=20))
def test_residual_and_parts_make_the_subtotal(spark, data):
    parts = spark.createDataFrame(data, "d string, c string, estimate double")
    total = aggregate.sum_by(parts, ["d"]).withColumn("c", F.lit("All"))
    rest = aggregate.residual_category(parts.unionByName(total), ["d"], "c", "All", ["p", "q"], "Rest")
    want = {}
    for d in {d for d, _, _ in data}:
        listed = [v for dd, c, v in data if dd == d and c in "pq"]
        whole_sum = sum(v for dd, _, v in data if dd == d)
        want[d] = whole_sum - sum(listed) if listed else None
    assert {r.d: r.estimate for r in rest.collect()} == want


@SLOW
@given(st.lists(st.tuples(keys, whole, st.integers(0, 50).map(float)), min_size=1, max_size=20))
def test_margin_of_a_sum_lies_between_largest_and_sum(spark, data):
    df = spark.createDataFrame(data, "k string, estimate double, moe double")
    bounds = defaultdict(list)
    for k, _, m in data:
        bounds[k].append(m)
    for mode in ("total", "per_row"):
        for r in aggregate.moe_sum(df, ["k"], mode=mode).collect():
            assert max(bounds[r.k]) - 1e-9 <= r.moe <= sum(bounds[r.k]) + 1e-9
