"""Tables laid out for a join: both sides in the same buckets of the key, hot keys split over several."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendloom.functions.nulls import as_col
from trendloom.session import stage_path

#: The part of a key that a row is in: 0 unless the key is hot.
SALT = "salt"


def _hot_keys(facts: DataFrame, key: str, buckets: int) -> DataFrame:
    """Keys that alone hold more rows than a bucket should, and into how many parts they go; fewer than ``buckets`` rows."""
    counts = facts.groupBy(as_col(key).alias("hot")).agg(F.count(F.lit(1)).alias("n"))
    fair = max(1, math.ceil((counts.agg(F.sum("n")).first()[0] or 0) / buckets))
    return counts.filter(F.col("hot").isNotNull() & (F.col("n") > fair)).select("hot", F.ceil(F.col("n") / fair).cast("int").alias("parts"))


def write_pair(facts: DataFrame, dims: DataFrame, key: str, tables: tuple[str, str], buckets: int) -> None:
    """Write facts and the dimension they look up as tables bucketed by ``key`` and ``SALT``.

    A key with more than its share of the facts is split: its rows are dealt to as many parts as make each about a
    bucket's share, and its dimension rows are written once for every part. At most ``buckets`` keys
    can be so large, so their list is broadcast whatever the size of the facts. Rows with a NULL key keep part 0.
    The parts go by a row's place in its input partition, so copies of one row spread as well. The files go to
    the shared folder.
    """
    spark: SparkSession = facts.sparkSession
    facts_table, dims_table = tables
    hot = _hot_keys(facts, key, buckets)
    place = F.monotonically_increasing_id()
    dealt = (
        facts.withColumn("__place", place)
        .join(F.broadcast(hot), as_col(key) == F.col("hot"), "left")
        .withColumn(SALT, F.when(F.col("hot").isNotNull(), F.pmod("__place", "parts")).otherwise(0).cast("int"))
        .drop("hot", "parts", "__place")
    )
    every = (
        dims.join(F.broadcast(hot), as_col(key) == F.col("hot"), "left")
        .withColumn(SALT, F.explode(F.when(F.col("hot").isNotNull(), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0)))))
        .drop("hot", "parts")
    )
    for df, name in ((dealt, facts_table), (every, dims_table)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        # One file a bucket: the rows are dealt to the tasks as they are to the buckets.
        dealt_out = df.repartition(buckets, key, SALT).write.format("parquet")
        dealt_out.bucketBy(buckets, key, SALT).sortBy(key, SALT).option("path", stage_path(spark)).saveAsTable(name)
