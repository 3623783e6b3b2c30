"""Reading the test tables and the word rules several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of characters other than the six ASCII white-space ones.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no column name of the input can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def hashed_share(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df``, one for each of the keys whose hash is small enough; all keys where there are fewer.

    The share follows from an estimate of the number of distinct keys, so a key that many rows repeat stands for one, and what is
    left is merged by key on the executors: what a caller collects does not grow with rows or partitions.
    """
    place = F.xxhash64(key)
    known = df.agg(F.approx_count_distinct(place)).first()[0]
    least = F.lit(min(1.0, rows / max(known, 1)) * float(1 << 40))
    return df.withColumn("place", place).filter(F.pmod("place", F.lit(1 << 40)) < least).dropDuplicates(["place"]).sort("place").drop("place")
