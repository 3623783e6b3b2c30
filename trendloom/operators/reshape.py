"""Wide to long and back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from trendloom.functions.nulls import as_col, na_sum_if, to_number


def columns_containing(df: DataFrame, text: str) -> list[str]:
    """Column names holding ``text``, in any letter case."""
    return [c for c in df.columns if text.lower() in c.lower()]


def drop_containing(df: DataFrame, text: str) -> DataFrame:
    unwanted = set(columns_containing(df, text))
    return df.select(*[as_col(c) for c in df.columns if c not in unwanted])


def melt(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None = None,
    name_to: str = "variable",
    value_to: str = "estimate",
    drop_null: bool = False,
) -> DataFrame:
    """Wide to long, one output row per input row and value column, no shuffle.

    Values are read as doubles so that columns of different types can share one column.
    """
    if values is None:
        values = [c for c in df.columns if c not in set(ids)]
    wide = df.select(*[as_col(c) for c in ids], *[to_number(c).alias(c) for c in values])
    long = wide.unpivot([as_col(c) for c in ids], [as_col(c) for c in values], name_to, value_to)
    return long.filter(F.col(value_to).isNotNull()) if drop_null else long


def _sql_literal(value: str | dt.date | None) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, dt.date):
        return f"DATE'{value.isoformat()}'"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def melt_headers(
    df: DataFrame,
    ids: Sequence[str],
    values: Iterable[str],
    parse: Callable[[str], dict],
    value_to: str = "estimate",
    drop_null: bool = False,
) -> DataFrame:
    """Wide to long where a header carries keys, such as a year and a metric.

    ``parse`` turns each header into its keys once, while the plan is built, so no row
    pays for parsing text that only exists in the header. Values are exploded by position
    and the keys looked up there, which keeps the generated code small for sheets with
    hundreds of columns.
    """
    values = list(values)
    if not values:
        raise ValueError("no columns to melt")
    keys = [parse(c) for c in values]
    # One expression text for all columns: building them one by one is slow in Python.
    numbers = ", ".join(f"try_cast(`{c.replace('`', '``')}` AS DOUBLE)" for c in values)
    cells = F.posexplode(F.expr(f"array({numbers})")).alias("__at", value_to)
    long = df.select(*[as_col(c) for c in ids], cells)
    if drop_null:
        long = long.filter(F.col(value_to).isNotNull())
    lookups = {
        name: F.expr(f"get(array({', '.join(_sql_literal(k[name]) for k in keys)}), __at)")
        for name in keys[0]
    }
    return long.select(*[as_col(c) for c in ids], *[c.alias(n) for n, c in lookups.items()], value_to)


def spread(
    df: DataFrame, ids: Sequence[str], names_from: str, names: Sequence[str], values_from: str = "estimate"
) -> DataFrame:
    """Long to wide for a known list of names.

    A conditional aggregate per name: one shuffle, where a pivot groups twice. Several rows of
    one cell are summed, as the measures are counts; a NULL among them makes the cell NULL.
    """
    label = as_col(names_from)
    return df.groupBy(*ids).agg(
        *[na_sum_if(label == n, values_from).alias(n) for n in names]
    )
