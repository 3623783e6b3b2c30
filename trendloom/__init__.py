"""Regional trend indicators as Spark DataFrame transformations."""

from trendloom.schema import TREND_COLUMNS, TREND_SCHEMA, conform, union_trends

__all__ = ["TREND_COLUMNS", "TREND_SCHEMA", "conform", "union_trends"]
