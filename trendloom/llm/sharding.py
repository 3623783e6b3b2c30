"""Sharding by a two-pass external shuffle.

The first pass scatters the records into buckets that fit in memory, by seeded hashes; the second
shuffles each bucket with Fisher and Yates' method and writes it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from trendloom.llm.tables import whole_row

SEED = 20240611
BUCKET_BYTES = 32 << 20


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """Law ``key``: the shard whose seeded hash with the key is largest.

    It depends on the key and the number of shards alone; one more shard takes rows only into
    itself, as all other hashes stay what they are. NULL keys share one shard.
    """
    draws = F.array(*[F.xxhash64(key, F.lit(seed), F.lit(i)) for i in range(shards)])
    return (F.array_position(draws, F.array_max(draws)) - 1).cast("int")


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (NULL: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write ``docs`` to Parquet folders ``shard=0``.. and return them as written.

    Columns: record (the whole input row), bucket, place (from 0 in its bucket), shard. A shard holds as many buckets
    as keep each near ``bucket_bytes``; the bucket within the shard is drawn from the whole row, so copies of
    one text, and rows of one id, spread. NULL ids and texts are allowed; an empty table writes no shard.
    The same rows, seed and bucket size give the same order: a bucket is sorted by id and row hash before the shuffle.
    """
    placed = docs.select(
        whole_row(docs).alias("record"),
        shard_of(F.col(f"`{id_col}`").cast("long"), shards, seed).alias("shard"),
        F.xxhash64(F.lit(seed + 1), *[F.col(f"`{c}`") for c in docs.columns]).alias("mix"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
    )
    size = record_bytes(F.col(f"record.`{text_col}`").cast("string"))
    largest = placed.groupBy("shard").agg(F.sum(size).alias("n")).agg(F.max("n")).first()[0] or 1
    parts = math.ceil(largest / bucket_bytes)
    bucket = (F.col("shard") * F.lit(parts) + F.pmod("mix", F.lit(parts))).cast("long")
    schema = T.StructType([
        placed.schema["record"],
        T.StructField("bucket", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("shard", T.IntegerType()),
    ])

    def fisher_yates(key: tuple, rows: pa.Table) -> pa.Table:
        number, n = key[0].as_py(), rows.num_rows
        ids = rows.column("id").combine_chunks()
        order = np.lexsort((rows.column("mix").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)))
        draws = np.random.Generator(np.random.PCG64([seed, number])).integers(0, np.arange(1, n + 1))
        for i in range(n - 1, 0, -1):
            j = draws[i]
            order[i], order[j] = order[j], order[i]
        return pa.table(
            [
                rows.column("record").take(pa.array(order)),
                pa.array(np.full(n, number)),
                pa.array(np.arange(n)),
                pa.array(np.full(n, number // parts, np.int32)),
            ],
            names=schema.names,
        )

    shuffled = placed.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(fisher_yates, schema)
    shuffled.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def with_slots(written: DataFrame) -> DataFrame:
    """Add ``slot``: the place in the shard, gapless from 0.

    The table of bucket sizes, one row per bucket, goes to every task, so that the records are not shuffled again.
    """
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        written.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("bucket").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    return written.join(F.broadcast(starts), F.col("bucket") == F.col("of")).drop("of").withColumn("slot", F.col("start") + F.col("place")).drop("start")


def read_order(written: DataFrame, shards: Sequence[int]) -> DataFrame:
    """The records of some shards in the order in which a reader takes them."""
    return with_slots(written.filter(F.col("shard").isin(*shards))).orderBy("shard", "slot").select("shard", "slot", "record.*")
