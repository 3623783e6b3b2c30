"""Column rules: NULLs, casts, text, dates, rounding."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendloom.functions import dates, nulls, numbers, text


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


@pytest.mark.parametrize("values, want", [([1.0, 2.0], 3.0), ([1.0, None], None), ([None], None)])
def test_na_sum_is_null_with_any_null(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(nulls.na_sum("v")).first()[0] == want


def test_na_sum_of_sums_equals_sum(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", None), ("b", "x", 2.0)], "k string, g string, v double")
    steps = df.groupBy("k", "g").agg(nulls.na_sum("v").alias("v")).groupBy("k").agg(nulls.na_sum("v").alias("v"))
    assert sorted(map(tuple, steps.collect())) == [("a", None), ("b", 2.0)]


def test_na_sum_if_only_sees_chosen_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, None)], "k int, v double")
    got = df.agg(
        nulls.na_sum_if(F.col("k") == 1, "v").alias("a"),
        nulls.na_sum_if(F.col("k") == 2, "v").alias("b"),
        nulls.na_sum_if(F.col("k") == 3, "v").alias("c"),
    ).first()
    assert tuple(got) == (3.0, None, None)


def test_division_and_casts_give_null(spark):
    got = one(
        spark,
        zero=nulls.safe_ratio(F.lit(1.0), F.lit(0.0)),
        half=nulls.safe_ratio(F.lit(1), F.lit(2)),
        bad=nulls.to_number(F.lit("n/a")),
        good=nulls.to_number(F.lit(" 12.5")),
    )
    assert got == {"zero": None, "half": 0.5, "bad": None, "good": 12.5}


def test_null_is_outside_every_list(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    kept = df.filter(nulls.not_in("v", ["a"])).collect()
    assert sorted(str(r.v) for r in kept) == ["None", "b"]


def test_text(spark):
    got = one(
        spark,
        removed=text.remove_all(F.lit("a b a b"), " b"),
        first=text.replace_first(F.lit("City (part) (part)"), " (part)", ""),
        untouched=text.replace_first(F.lit("City"), " (part)", ""),
        chain=text.recode_chain(F.lit("ab"), [("a", "b"), ("bb", "c")]),
        trimmed=text.trim_blank(F.lit(" \tx \n")),
        long=text.pad_left(F.lit("123456"), 5),
        short=text.pad_left(F.lit(7), 5),
        geoid=text.geoid(F.lit("1"), F.lit("33")),
        unmapped=text.recode_map(F.lit("z"), {"a": "b"}),
        fallback=text.recode_map(F.lit("z"), {"a": "b"}, F.lit("other")),
        ordered=text.case_contains(F.lit("Domestic Freight"), [("Domestic", "D"), ("Freight", "F")]),
    )
    assert got == {
        "removed": "a a", "first": "City (part)", "untouched": "City", "chain": "c", "trimmed": "x",
        "long": "123456", "short": "00007", "geoid": "01033", "unmapped": None, "fallback": "other",
        "ordered": "D",
    }


def test_replace_first_completes_a_complete_name_again(spark):
    got = one(spark, name=text.replace_first(F.lit("Beaux Arts Village"), "Beaux Arts", "Beaux Arts Village"))
    assert got["name"] == "Beaux Arts Village Village"


def test_dates(spark):
    got = one(
        spark,
        ymd=dates.parse_ymd(F.lit("2020-4-1")),
        mdy=dates.parse_mdy(F.lit("04/01/2020")),
        short=dates.parse_mdy(F.lit("4/1/2020")),
        my=dates.parse_my(F.lit("4/2020")),
        bad=dates.parse_mdy(F.lit("April")),
        two_digits=dates.parse_mdy(F.lit("1/1/20")),
        serial=dates.excel_date(F.lit("43466")),
        text=dates.excel_date(F.lit("total")),
        stamp=dates.stamp(F.lit("2021"), 12),
    )
    april = dt.date(2020, 4, 1)
    assert got == {
        "ymd": april, "mdy": april, "short": april, "my": april, "bad": None, "two_digits": None,
        "serial": dt.date(2019, 1, 1), "text": None, "stamp": dt.date(2021, 12, 1),
    }


def test_last_complete_year(spark):
    df = spark.createDataFrame([(dt.date(2020, 12, 1),), (dt.date(2020, 11, 1),)], "d date")
    assert [r[0] for r in df.select(dates.last_complete_year("d")).collect()] == [2020, 2019]


@pytest.mark.parametrize(
    "as_of, want",
    [
        (dt.date(2023, 1, 15), (2022, 11)),
        (dt.date(2023, 2, 15), (2022, 12)),
        (dt.date(2023, 3, 15), (2023, 1)),
        (dt.date(2023, 12, 31), (2023, 10)),
    ],
)
def test_reporting_cutoff_lags_two_months(as_of, want):
    assert dates.reporting_cutoff(as_of) == want


def test_headers():
    assert dates.header_month("3/2021") == dt.date(2021, 3, 1)
    assert dates.header_month("13/2021") is None
    assert dates.header_month("3.Mode") is None
    assert dates.header_serial("43466") == dt.date(2019, 1, 1)
    assert dates.header_serial("...1") is None


def test_halves_round_to_even(spark):
    got = one(
        spark,
        down=numbers.pounds_to_tons(F.lit(2.5) / F.lit(numbers.TONS_PER_POUND)),
        up=numbers.pounds_to_tons(F.lit(3.5) / F.lit(numbers.TONS_PER_POUND)),
        ratio=numbers.guarded_ratio(F.lit(1.0), F.lit(3.0)),
        zero=numbers.guarded_ratio(F.lit(1.0), F.lit(0.0)),
        negative=numbers.guarded_ratio(F.lit(1.0), F.lit(-2.0)),
    )
    assert got == {"down": 2.0, "up": 4.0, "ratio": 0.33, "zero": None, "negative": None}
