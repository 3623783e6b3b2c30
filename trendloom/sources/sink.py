"""The trend table on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendloom.schema import TREND_SCHEMA, conform


def write_trends(df: DataFrame, path: str, mode: str = "overwrite", whole: bool = False) -> None:
    """Write a trend table partitioned by metric; only the metrics of ``df`` are overwritten.

    ``whole`` replaces the whole table, so that a metric which a run no longer yields does not stay behind.

    The rebalance hint gathers each metric's rows into few files and lets AQE split a
    metric too large for one task.
    """
    conform(df).hint("rebalance", "metric").write.mode(mode).option(
        "partitionOverwriteMode", "static" if whole else "dynamic"
    ).partitionBy("metric").parquet(path)


def read_trends(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.schema(TREND_SCHEMA).parquet(path))
