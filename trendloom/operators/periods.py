"""Annual and year-to-date summaries of monthly data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendloom.functions.dates import last_complete_year, stamp
from trendloom.functions.nulls import na_sum, na_sum_if


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def period_summary(
    df: DataFrame,
    keys: Sequence[str],
    complete_through: int | Column,
    cutoff_month: int | Column,
    filter_months: bool = True,
    value: str = "estimate",
) -> DataFrame:
    """Annual and year-to-date sums from one aggregation of monthly rows.

    Annual sums cover years up to ``complete_through`` and are filed under December.
    Year-to-date sums cover months up to ``cutoff_month`` of every year (all months if
    ``filter_months`` is off) and are filed under that month. Both limits may be columns
    as long as they are fixed within a key.
    """
    in_annual = F.col("__year") <= F.col("__through")
    in_ytd = (F.month("date") <= F.col("__cutoff")) if filter_months else F.lit(True)
    yearly = (
        df.withColumns(
            {
                "__year": F.year("date"),
                "__through": _column(complete_through),
                "__cutoff": _column(cutoff_month),
            }
        )
        .groupBy(*keys, "__year", "__through", "__cutoff")
        .agg(
            na_sum(value).alias("__annual"),
            na_sum_if(in_ytd, value).alias("__ytd"),
            F.count_if(in_ytd).alias("__ytd_rows"),
        )
    )
    periods = F.array(
        F.when(
            in_annual,
            F.struct(
                F.lit("Annual").alias("grouping"),
                stamp("__year", 12).alias("date"),
                F.col("__annual").alias(value),
            ),
        ),
        F.when(
            F.col("__ytd_rows") > 0,
            F.struct(
                F.lit("YTD").alias("grouping"),
                stamp("__year", "__cutoff").alias("date"),
                F.col("__ytd").alias(value),
            ),
        ),
    )
    return (
        yearly.select(*keys, F.col("__year").cast("string").alias("year"), F.explode(periods).alias("p"))
        .filter(F.col("p").isNotNull())
        .select(*keys, "year", "p.grouping", "p.date", f"p.{value}")
    )


def annual_summary(
    df: DataFrame, keys: Sequence[str], complete_through: int | Column | None = None, value: str = "estimate"
) -> DataFrame:
    """Sums of the complete years only; by default the data's own newest month decides."""
    if complete_through is None:
        complete_through = df.agg(last_complete_year(F.max("date"))).scalar()
    # Compared as dates, a limit given as a number reaches the scan.
    next_year = F.make_date(_column(complete_through) + 1, F.lit(1), F.lit(1))
    return (
        df.filter(F.col("date") < next_year)
        .groupBy(*keys, F.year("date").cast("string").alias("year"))
        .agg(na_sum(value).alias(value))
        .withColumns({"grouping": F.lit("Annual"), "date": stamp("year", 12)})
    )


def ytd_summary(
    df: DataFrame,
    keys: Sequence[str],
    cutoff_month: int | Column | None = None,
    filter_months: bool = True,
    value: str = "estimate",
) -> DataFrame:
    """Sums of months up to the cut-off in every year, so that years compare.

    With ``filter_months`` off the cut-off is only the month the sums are filed under.
    """
    if cutoff_month is None:
        cutoff_month = df.agg(F.month(F.max("date"))).scalar()
    rows = df.withColumn("__cutoff", _column(cutoff_month))
    if filter_months:
        rows = rows.filter(F.month("date") <= F.col("__cutoff"))
    return (
        rows.groupBy(*keys, F.year("date").cast("string").alias("year"), "__cutoff")
        .agg(na_sum(value).alias(value))
        .withColumns({"grouping": F.lit("YTD"), "date": stamp("year", "__cutoff")})
        .drop("__cutoff")
    )


def latest_month_by_year(df: DataFrame, date: str = "date") -> DataFrame:
    """``year`` and the newest month seen in it."""
    return df.groupBy(F.year(date).alias("year")).agg(F.max(F.month(date)).alias("max_month"))


def stamp_latest_month(df: DataFrame, months: DataFrame) -> DataFrame:
    """File yearly rows under the newest month of their year.

    ``months`` holds one row per calendar year, few enough to broadcast whatever the
    size of their source; a shuffle by year would make one partition per year. Years are compared
    NULL-safe, which gives the same dates and puts no filter of its own below ``months``, so that
    both sides can read one shuffle.
    """
    by_year = months.withColumnRenamed("year", "__year")
    return (
        df.join(F.broadcast(by_year), F.col("year").eqNullSafe(F.col("__year")), "left")
        .withColumn("date", stamp("year", "max_month"))
        .drop("__year", "max_month")
    )


def expected_months(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Every month from ``first`` to ``last`` with its ``MMYYYY`` file key."""
    months = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("date")).select(
        "date", F.date_format("date", "MMyyyy").alias("month_key")
    )


def missing_months(df: DataFrame, first: dt.date, last: dt.date, date: str = "date") -> DataFrame:
    """Expected months that have no row at all."""
    present = df.select(F.trunc(date, "month").alias("date")).distinct()
    return expected_months(df.sparkSession, first, last).join(present, "date", "left_anti")
