"""Operators on hand-made rows, with the edge cases their plans meet."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendloom.operators import aggregate, joins, periods, reshape, series
from trendloom.schema import conform, union_trends


def month(y, m):
    return dt.date(y, m, 1)


def test_region_rollup_keeps_detail_and_picks_members(spark, rows):
    df = spark.createDataFrame(
        [("x", "a", 1.0), ("x", "b", 2.0), ("x", None, 4.0), ("y", "b", 8.0)], "k string, geography string, estimate double"
    )
    got = aggregate.region_rollup(df, ["k"], members=F.col("geography") == "a")
    assert rows(got) == sorted(
        [("x", None, 4.0), ("x", "Region", 1.0), ("x", "a", 1.0), ("x", "b", 2.0), ("y", "b", 8.0)],
        key=lambda r: [(v is not None, str(type(v)), v) for v in r],
    )
    everyone = aggregate.region_rollup(df, ["k"]).filter("geography = 'Region'")
    assert rows(everyone) == [("x", "Region", 7.0), ("y", "Region", 8.0)]


def test_grouped_levels_tells_null_key_from_rolled_up(spark, rows):
    df = spark.createDataFrame([("t", "a", None, 1.0), ("t", "a", "m", 2.0)], "d string, area string, mode string, estimate double")
    got = aggregate.grouped_levels(df, ["d"], {"area": ["area"], "mode": ["area", "mode"]})
    assert rows(got) == [
        ("area", "t", "a", None, 3.0),
        ("mode", "t", "a", None, 1.0),
        ("mode", "t", "a", "m", 2.0),
    ]


@pytest.mark.parametrize(
    "cells, total, per_row",
    [
        ([(10.0, 3.0), (5.0, 4.0)], 5.0, 5.0),
        ([(0.0, 3.0), (0.0, 4.0)], 4.0, 4.0),
        ([(0.0, 3.0), (0.0, 4.0), (7.0, 12.0)], 13.0, (144 + 16) ** 0.5),
        ([(1.0, None), (2.0, 4.0)], None, None),
        ([(None, 3.0), (2.0, 4.0)], None, None),
        ([(None, 5.0), (0.0, 2.0)], None, None),
    ],
)
def test_moe_sum_modes(spark, cells, total, per_row):
    df = spark.createDataFrame([("k", *c) for c in cells], "k string, estimate double, moe double")
    assert aggregate.moe_sum(df, ["k"]).first().moe == total
    assert aggregate.moe_sum(df, ["k"], mode="per_row").first().moe == per_row


def test_moe_sum_rejects_unknown_mode(spark):
    with pytest.raises(ValueError):
        aggregate.moe_sum(spark.createDataFrame([("k", 1.0, 1.0)], "k string, estimate double, moe double"), ["k"], mode="x")


def test_residual_category(spark, rows):
    df = spark.createDataFrame(
        [("d1", "All", 10.0), ("d1", "a", 3.0), ("d1", "b", 2.0), ("d1", "z", 99.0),
         ("d2", "All", 5.0), ("d3", "a", 1.0), ("d4", "All", 5.0), ("d4", "a", None)],
        "d string, c string, estimate double",
    )
    got = aggregate.residual_category(df, ["d"], "c", "All", ["a", "b"], "Other")
    assert rows(got) == [("d1", "Other", 5.0), ("d2", "Other", None), ("d4", "Other", None)]


def test_latest_vintage_only_from_the_given_year(spark, rows):
    df = spark.createDataFrame([(2019, 1), (2019, 2), (2020, 1), (2020, 2), (2021, 3), (2020, 3)], "y int, v int")
    assert rows(aggregate.latest_vintage(df, "y", "v", 2020)) == [(2019, 1), (2019, 2), (2020, 3), (2021, 3)]


def test_sum_whole_cuts_toward_zero(spark):
    df = spark.createDataFrame([("k", 1.7), ("k", 1.2), ("n", -2.9)], "k string, v double")
    assert sorted(map(tuple, aggregate.sum_whole(df, ["k"], "v").collect())) == [("k", 2), ("n", -2)]


MONTHS = [("a", month(2019, m), 1.0) for m in range(1, 13)] + [("a", month(2020, m), 10.0) for m in range(1, 4)]


def test_incomplete_year_has_no_annual_sum(spark, rows):
    df = spark.createDataFrame(MONTHS, "k string, date date, estimate double")
    assert rows(periods.annual_summary(df, ["k"]), "year", "date", "estimate") == [("2019", month(2019, 12), 12.0)]
    whole = df.filter("date < '2020-01-01'")
    assert rows(periods.annual_summary(whole, ["k"]), "year", "estimate") == [("2019", 12.0)]


def test_year_to_date_compares_the_same_months(spark, rows):
    df = spark.createDataFrame(MONTHS, "k string, date date, estimate double")
    assert rows(periods.ytd_summary(df, ["k"]), "date", "estimate") == [(month(2019, 3), 3.0), (month(2020, 3), 30.0)]
    assert rows(periods.ytd_summary(df, ["k"], 3, filter_months=False), "date", "estimate") == [
        (month(2019, 3), 12.0), (month(2020, 3), 30.0)]


def test_period_summary_is_both_in_one(spark, rows):
    df = spark.createDataFrame(MONTHS + [("a", month(2018, 5), 7.0), ("b", month(2019, 5), None)], "k string, date date, estimate double")
    both = periods.period_summary(df, ["k"], 2019, 3)
    apart = periods.annual_summary(df, ["k"], 2019).unionByName(periods.ytd_summary(df, ["k"], 3))
    columns = ["k", "grouping", "date", "estimate"]
    assert rows(both, *columns) == rows(apart, *columns)
    # 2018 has no month up to March, so it has no year-to-date row.
    assert ("YTD", month(2018, 3)) not in rows(both, "grouping", "date")


def test_latest_month_stamp(spark, rows):
    df = spark.createDataFrame([(month(2019, 12),), (month(2020, 2),), (month(2020, 1),)], "date date")
    yearly = spark.createDataFrame([(2019, 1.0), (2020, 2.0), (2021, 3.0)], "year int, estimate double")
    got = periods.stamp_latest_month(yearly, periods.latest_month_by_year(df))
    assert rows(got, "year", "date") == [(2019, month(2019, 12)), (2020, month(2020, 2)), (2021, None)]


def test_missing_months(spark, rows):
    df = spark.createDataFrame([(dt.date(2020, 1, 20),), (dt.date(2020, 3, 2),)], "date date")
    got = periods.missing_months(df, month(2019, 12), month(2020, 4))
    assert rows(got, "month_key") == [("022020",), ("042020",), ("122019",)]


def test_melt_keeps_or_drops_nulls_and_quotes_names(spark, rows):
    df = spark.createDataFrame([("a", "1", None), ("b", "x", "2.5")], "id string, `x.1` string, `y 2` string")
    assert rows(reshape.melt(df, ["id"])) == [
        ("a", "x.1", 1.0), ("a", "y 2", None), ("b", "x.1", None), ("b", "y 2", 2.5)]
    assert rows(reshape.melt(df, ["id"], drop_null=True)) == [("a", "x.1", 1.0), ("b", "y 2", 2.5)]


def test_melt_headers_parses_keys(spark, rows):
    df = spark.createDataFrame([("a", 1, 2)], "id string, `2019.It's` int, `Total` int")
    got = reshape.melt_headers(
        df, ["id"], df.columns[1:], lambda h: {"year": h[:4] if h[0] == "2" else None, "name": h})
    assert rows(got) == [("a", None, "Total", 2.0), ("a", "2019", "2019.It's", 1.0)]


def test_nothing_to_melt_is_an_error(spark):
    with pytest.raises(ValueError):
        reshape.melt_headers(spark.range(1), ["id"], [], lambda h: {})


def test_spread_then_melt_is_identity(spark, rows):
    long = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0)], "id string, variable string, estimate double")
    wide = reshape.spread(long, ["id"], "variable", ["x", "y"])
    assert rows(reshape.melt(wide, ["id"], drop_null=True)) == rows(long)


def test_spread_sums_several_rows_of_a_cell(spark, rows):
    long = spark.createDataFrame(
        [("a", "x", 10.0), ("a", "x", 30.0), ("a", "y", 5.0), ("b", "x", 1.0), ("b", "x", None)],
        "id string, variable string, estimate double",
    )
    assert rows(reshape.spread(long, ["id"], "variable", ["x", "y"])) == [("a", 40.0, 5.0), ("b", None, None)]


def test_drop_containing_ignores_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Place.Code.x` int, `a.b` int, placecode int")
    assert reshape.drop_containing(df, "place.code").columns == ["a.b", "placecode"]


def test_lookup_join_fans_out_and_keeps_unmatched(spark, rows):
    df = spark.createDataFrame([("1", 1.0), ("2", 2.0)], "id string, estimate double")
    lookup = spark.createDataFrame([("1", "A"), ("1", "B")], "code string, area string")
    assert rows(joins.lookup_join(df, lookup, "id", "code")) == [("1", 1.0, "A"), ("1", 1.0, "B"), ("2", 2.0, None)]
    assert rows(joins.keep_known(df, lookup, "id", "code")) == [("1", 1.0)]


def test_shares_treat_null_keys_as_one_group(spark, rows):
    df = spark.createDataFrame([(None, "a", 1.0), (None, "b", 3.0), ("k", "a", 0.0)], "k string, v string, estimate double")
    got = series.share_of_total(df, ["k"])
    assert rows(got, "v", "share") == [("a", None), ("a", 0.25), ("b", 0.75)]


def test_share_of_label(spark, rows):
    df = spark.createDataFrame([("k", "Total", 4.0), ("k", "a", 1.0), ("m", "a", 1.0)], "k string, l string, estimate double")
    assert rows(series.share_of_label(df, ["k"], "l"), "k", "l", "share") == [("k", "Total", 1.0), ("k", "a", 0.25), ("m", "a", None)]


def test_wide_shares_total_is_always_one(spark, rows):
    df = spark.createDataFrame([("d", 1.0, 0.0)], "d string, part double, total double")
    got = series.wide_shares(df, ["d"], {"part": "Part", "total": "All"}, "total")
    assert rows(got, "variable", "share") == [("All", 1.0), ("Part", None)]


def test_first_year_of_a_late_place_has_no_change(spark, rows):
    df = spark.createDataFrame([("a", "2019", 1.0), ("a", "2020", 4.0), ("b", "2020", 9.0)], "k string, year string, estimate double")
    assert rows(series.lag_change(df, ["k"], "year"), "k", "year", "change") == [
        ("a", "2019", None), ("a", "2020", 3.0), ("b", "2020", None)]


@pytest.mark.parametrize(
    "drop_first, want",
    [
        (True, [("2020", "Annual", 4.0), ("2020", "Change", 3.0)]),
        (False, [("2019", "Annual", 1.0), ("2020", "Annual", 4.0), ("2020", "Change", 3.0), ("2022", "Annual", 9.0), ("2022", "Change", 5.0)]),
    ],
)
def test_forecast_first_year_and_gaps(spark, rows, drop_first, want):
    df = spark.createDataFrame([(2019, 1.0), (2020, 4.0), (2021, None), (2022, 9.0)], "y int, v double")
    got = series.forecast_series(df, "y", "v", "M", drop_first=drop_first)
    assert rows(got, "year", "grouping", "estimate") == want


def test_conform_and_union(spark, rows):
    df = spark.createDataFrame([(month(2020, 4), 1)], "date date, estimate int")
    full = conform(df, geography="Region", share=F.lit(0.5))
    assert rows(full) == [("2020", month(2020, 4), "Region", None, None, None, None, 1.0, 0.5, None)]
    both = union_trends(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string"))
    assert rows(both) == [(None, "x"), (1, None)]
