"""Change over time, shares and level-and-change series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from trendloom.functions.nulls import as_col, na_sum, safe_ratio
from trendloom.operators.joins import with_group_values


def lag_change(
    df: DataFrame, keys: Sequence[str], order: str, value: str = "estimate", name: str = "change"
) -> DataFrame:
    """Difference to the previous period of the same key; NULL in the first.

    ``df`` holds one row per key and period, so a window holds one row per period.
    """
    series = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(name, as_col(value) - F.lag(as_col(value)).over(series))


def level_and_change(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    measures: Mapping[str, str],
    level_label: str = "Annual",
    drop: str | None = "cell",
) -> DataFrame:
    """Each measure as a level row and a change row, all lags in one window pass.

    ``measures`` maps column to metric label. ``drop='cell'`` removes single NULL values,
    ``drop='row'`` removes a period with any NULL before melting (the first period always
    goes), ``drop=None`` keeps everything.
    """
    series = Window.partitionBy(*keys).orderBy(order)
    lagged = df.select(
        *keys, order, *measures,
        *[(as_col(m) - F.lag(as_col(m)).over(series)).alias(f"__d_{m}") for m in measures],
    )
    if drop == "row":
        lagged = lagged.dropna("any")
    cells = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.lit(grouping).alias("grouping"),
            F.col(column).cast("double").alias("estimate"),
        )
        for m, metric in measures.items()
        for grouping, column in ((level_label, m), ("Change", f"__d_{m}"))
    ]
    long = lagged.select(*keys, order, F.inline(F.array(*cells)))
    return long.dropna("any") if drop == "cell" else long


def forecast_series(
    df: DataFrame,
    year: str,
    value: str,
    metric: str,
    level_label: str = "Annual",
    drop_first: bool = True,
) -> DataFrame:
    """Level and change of one forecast, labelled as the region's Forecast.

    ``drop_first`` removes the first year altogether; otherwise only its change, which
    has no year to compare with, is missing. One row per year goes into the window.
    """
    yearly = (
        df.groupBy(as_col(year).alias("year"))
        .agg(na_sum(value).alias("estimate"))
        .withColumn("geography", F.lit("Region"))
    )
    if not drop_first:
        yearly = yearly.dropna("any")
    return (
        level_and_change(
            yearly, ["geography"], "year", {"estimate": metric}, level_label,
            drop="row" if drop_first else "cell",
        )
        .withColumns(
            {
                "geography_type": F.lit("Region"),
                "variable": F.lit("Forecast"),
                "date": F.make_date(F.col("year").cast("int"), F.lit(4), F.lit(1)),
                "year": F.col("year").cast("int").cast("string"),
            }
        )
    )


def share_of_total(
    df: DataFrame, keys: Sequence[str], value: str = "estimate", name: str = "share", staged: bool = False
) -> DataFrame:
    """Each row's part of its group's sum; NULL when the sum is zero or unknown.

    ``staged`` suits detail rows in few groups, see ``with_group_values``.
    """
    return (
        with_group_values(df, keys, staged, __total=na_sum(value))
        .withColumn(name, safe_ratio(value, "__total"))
        .drop("__total")
    )


def share_of_label(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    total_label: str = "Total",
    value: str = "estimate",
    name: str = "share",
) -> DataFrame:
    """Each row's part of the group's own total row, that row included.

    ``df`` holds one row per key and label, so a window holds one row per label.
    """
    group = Window.partitionBy(*[as_col(k) for k in keys])
    total = F.max(F.when(as_col(label) == total_label, as_col(value))).over(group)
    return df.withColumn(name, safe_ratio(value, total))


def wide_shares(df: DataFrame, ids: Sequence[str], parts: Mapping[str, str], total: str) -> DataFrame:
    """Melt a wide row to value-and-share rows, shares taken of its total column.

    ``parts`` maps column to label. The total's own share is 1 whatever its value.
    """
    cells = [
        F.struct(
            F.lit(label).alias("variable"),
            as_col(c).cast("double").alias("estimate"),
            (F.lit(1.0) if c == total else safe_ratio(c, total)).alias("share"),
        )
        for c, label in parts.items()
    ]
    return df.select(*ids, F.inline(F.array(*cells)))


def complement(df: DataFrame, total: str, part: str, name: str) -> DataFrame:
    """The rest of a total beside one part, in the same row."""
    return df.withColumn(name, as_col(total) - as_col(part))
