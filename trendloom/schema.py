"""The one output shape every plan returns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

TREND_SCHEMA = T.StructType(
    [
        T.StructField("year", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("geography", T.StringType()),
        T.StructField("geography_type", T.StringType()),
        T.StructField("variable", T.StringType()),
        T.StructField("grouping", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("estimate", T.DoubleType()),
        T.StructField("share", T.DoubleType()),
        T.StructField("moe", T.DoubleType()),
    ]
)

TREND_COLUMNS = TREND_SCHEMA.names


def conform(df: DataFrame, **constants) -> DataFrame:
    """Project to the trend columns, in order and with their types.

    ``constants`` are literals or columns that override or supply a field. A missing
    ``year`` comes from ``date``; any other missing field is NULL.
    """
    present = set(df.columns)

    def value(field: T.StructField):
        if field.name in constants:
            given = constants[field.name]
            return given if hasattr(given, "cast") else F.lit(given)
        if field.name in present:
            return F.col(field.name)
        if field.name == "year":
            return F.year("date")
        return F.lit(None)

    return df.select(*[value(f).cast(f.dataType).alias(f.name) for f in TREND_SCHEMA])


def union_trends(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column one frame lacks becomes NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
