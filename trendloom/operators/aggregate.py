"""Sums, region roll-ups, margins of error, residual and complement categories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from trendloom.functions.nulls import as_col, na_sum, na_sum_if


def sum_by(df: DataFrame, keys: Sequence[str], *values: str) -> DataFrame:
    """NULL-aware sums of ``values`` (``estimate`` if none is named) per key."""
    return df.groupBy(*keys).agg(*[na_sum(v).alias(v) for v in values or ("estimate",)])


def sum_rest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum every column that is not a key."""
    return sum_by(df, keys, *[c for c in df.columns if c not in set(keys)])


def sum_whole(df: DataFrame, keys: Sequence[str], *values: str) -> DataFrame:
    """Sums cut to whole numbers, toward zero."""
    return df.groupBy(*keys).agg(*[na_sum(v).cast("bigint").alias(v) for v in values])


def region_rollup(
    df: DataFrame,
    keys: Sequence[str],
    *values: str,
    geography: str = "geography",
    members: Column | None = None,
    label: str | Column = "Region",
) -> DataFrame:
    """Add one row per key that sums its member geographies.

    ``df`` holds one row per key and geography. Members are picked inside the aggregate,
    not by a filter, so both branches of the union share the shuffle that built ``df``
    and its source is read once.
    """
    values = values or ("estimate",)
    label = F.lit(label) if isinstance(label, str) else label
    if members is None:
        total = df.groupBy(*keys).agg(*[na_sum(v).alias(v) for v in values])
    else:
        total = (
            df.groupBy(*keys)
            .agg(F.count_if(members).alias("__members"), *[na_sum_if(members, v).alias(v) for v in values])
            .filter(F.col("__members") > 0)
            .drop("__members")
        )
    return df.select(*keys, geography, *values).unionByName(total.withColumn(geography, label))


def grouped_levels(df: DataFrame, fixed: Sequence[str], levels: dict[str, Sequence[str]], value: str = "estimate") -> DataFrame:
    """Sum one table at several levels in one GROUPING SETS pass.

    ``levels`` names each level and the keys it keeps besides ``fixed``. The level is told
    apart by the grouping id, so a NULL key is never taken for a rolled-up one. Output:
    ``level``, ``fixed``, every level key (NULL where rolled up) and the sum.
    """
    rolled = list(dict.fromkeys(k for keys in levels.values() for k in keys))
    every = [*fixed, *rolled]
    sets = [[F.col(k) for k in (*fixed, *keys)] for keys in levels.values()]
    out = df.groupingSets(sets, *[F.col(k) for k in every]).agg(
        F.grouping_id().alias("__gid"), na_sum(value).alias(value)
    )
    level = F
    for name, keys in levels.items():
        gid = sum(1 << (len(every) - 1 - i) for i, k in enumerate(every) if k in rolled and k not in keys)
        level = level.when(F.col("__gid") == gid, F.lit(name))
    return out.withColumn("level", level).select("level", *every, value)


def moe_sum(
    df: DataFrame,
    keys: Sequence[str],
    estimate: str = "estimate",
    moe: str = "moe",
    mode: str = "total",
) -> DataFrame:
    """Sum estimates and combine their margins of error.

    The margin of a sum is the root of the summed squares, except that of several zero
    estimates only the largest margin counts. ``mode='total'`` asks whether the group's
    total is zero, ``mode='per_row'`` asks each row. A NULL margin makes the
    margin NULL, a NULL estimate both.
    """
    e, m = as_col(estimate), as_col(moe)
    if mode == "total":
        combined = F.when(F.sum(e) == 0, F.max(m)).otherwise(F.sqrt(F.sum(m * m)))
    elif mode == "per_row":
        zero = e == 0
        top = F.max(F.when(zero, m))
        combined = F.sqrt(
            F.coalesce(F.sum(F.when(~zero, m * m)), F.lit(0.0)) + F.coalesce(top * top, F.lit(0.0))
        )
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.groupBy(*keys).agg(
        na_sum(e).alias(estimate),
        F.when((F.count(m) == F.count(F.lit(1))) & (F.count(e) == F.count(F.lit(1))), combined).alias(moe),
    )


def residual_category(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    total_label: str,
    parts: Sequence[str],
    out_label: str,
    value: str = "estimate",
) -> DataFrame:
    """The rows of a category the source only implies: a subtotal less its listed parts.

    One row per key that has the subtotal; NULL where the key has no listed part.
    """
    c = as_col(category)
    is_total, is_part = c == total_label, c.isin(*parts)
    return (
        df.filter(is_total | is_part)
        .groupBy(*keys)
        .agg(
            F.count_if(is_total).alias("__totals"),
            (na_sum_if(is_total, value) - na_sum_if(is_part, value)).alias(value),
        )
        .filter(F.col("__totals") > 0)
        .select(*keys, F.lit(out_label).alias(category), value)
    )


def latest_vintage(df: DataFrame, year: str, vintage: str, from_year: int) -> DataFrame:
    """Before ``from_year`` keep every row, from then on only the newest vintage.

    The newest vintage is a scalar subquery over one column; nothing is collected.
    """
    newest = df.agg(F.max(as_col(vintage))).scalar()
    return df.filter(
        (as_col(year) < from_year) | ((as_col(year) >= from_year) & (as_col(vintage) == newest))
    )


def latest_vintage_sums(
    df: DataFrame, keys: Sequence[str], year: str, vintage: str, from_year: int, *values: str
) -> DataFrame:
    """``sum_by`` of ``keys`` and ``year`` over the rows that ``latest_vintage`` keeps, from one scan.

    Recent rows are summed by vintage as well, and the newest is picked among the sums. The pick asks for a
    sum's vintage, not for the key, so that it stays above the sums; finding the newest reads their shuffle again.
    """
    sums = df.groupBy(
        *keys, as_col(year).alias(year), F.when(as_col(year) >= from_year, as_col(vintage)).alias("__vintage")
    ).agg(*[na_sum(v).alias(v) for v in values], F.max(as_col(vintage)).alias("__newest"))
    known = [F.count(as_col(v)).alias(f"__n{i}") for i, v in enumerate(values)]
    found = sums.agg(F.max("__newest").alias("__newest"), *known)
    newest = found.filter(reduce(and_, [F.col(f"__n{i}") >= 0 for i in range(len(values))])).select("__newest").scalar()
    recent = as_col(year) >= from_year
    return sums.filter((as_col(year) < from_year) | (recent & (F.col("__newest") == newest))).select(*keys, year, *values)
