"""Lookups, key filters and joining a group's own value back to its rows.

No join here forces a broadcast. Spark broadcasts a side when its size, known from the
files or measured at run time by AQE, is under the session's threshold, and otherwise
shuffles both sides, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from trendloom.functions.nulls import as_col
from trendloom.session import stage


def keep_known(df: DataFrame, keys: DataFrame, left_on: str, right_on: str | None = None) -> DataFrame:
    """Rows whose key occurs in another table (semi join)."""
    right = keys.select(as_col(right_on or left_on).alias("__known"))
    return df.join(right, as_col(left_on) == F.col("__known"), "left_semi")


def lookup_join(
    df: DataFrame, lookup: DataFrame, left_on: str | Sequence[str], right_on: str | Sequence[str] | None = None
) -> DataFrame:
    """Left join on one or several keys, which may have other names in the lookup; the lookup's keys are not kept.

    A key listed several times in the lookup fans its rows out, which is what counting
    one operator in each of its areas needs.
    """
    left = [left_on] if isinstance(left_on, str) else list(left_on)
    right_on = right_on or left_on
    names = {k: f"__lookup_key{i}" for i, k in enumerate([right_on] if isinstance(right_on, str) else right_on)}
    same = reduce(lambda a, b: a & b, [as_col(k) == F.col(n) for k, n in zip(left, names.values())])
    return df.join(lookup.withColumnsRenamed(names), same, "left").drop(*names.values())


def with_group_values(
    df: DataFrame, keys: Sequence[str], staged: bool = False, **aggregates: Column
) -> DataFrame:
    """Attach aggregates of each row's own group; NULL keys form one group.

    The groups are aggregated map-side first and joined back, so a group of any size is
    never gathered in one task, as a window over it would do. ``staged`` writes the groups
    to the shared folder first, so that Spark chooses the join by the size of their files:
    few groups leave the rows of ``df`` unshuffled. That pays for detail rows, not for an
    already grouped ``df``.
    """
    groups = df.groupBy(*[as_col(k).alias(f"__{k}") for k in keys]).agg(
        *[agg.alias(name) for name, agg in aggregates.items()]
    )
    if staged:
        groups = stage(groups)
    same_group = reduce(
        lambda a, b: a & b, [as_col(k).eqNullSafe(as_col(f"__{k}")) for k in keys]
    )
    return df.join(groups, same_group, "inner").drop(*[f"__{k}" for k in keys])
