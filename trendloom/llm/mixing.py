"""Mixing sources to target weights: repetition rates per source, then whole and drawn copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from trendloom.llm.tables import WORD, whole_row
from trendloom.session import stage

SEED = 20240611
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source, source_size, weight, target.

    Sources in code-point order, NULL last, take the weights in turn. ``share`` of all sizes is dealt out by
    weight; no target exceeds ``most`` times its source's size, and what is over goes to the others
    by weight, until none is above. Needs share <= most. The table of sources is small and staged; the driver
    sees four sums of it per round, and the capped sources only grow in number.
    """
    order = F.col("source").asc_nulls_last()
    sums = sizes.groupBy("source").agg(F.sum("size").alias("size")).sort(order)
    schema = T.StructType([*sums.schema.fields, T.StructField("weight", T.LongType())])
    given = tuple(weights)
    numbered = sums.rdd.zipWithIndex().map(lambda x: (*x[0], given[x[1] % len(given)]))
    sources = stage(sums.sparkSession.createDataFrame(numbered, schema))
    level, capped = 0.0, -1
    while True:
        over = F.col("size") * F.lit(float(most)) < F.lit(level) * F.col("weight")
        total, full, rest, n = sources.agg(
            F.sum("size"),
            F.coalesce(F.sum(F.when(over, F.col("size"))), F.lit(0)),
            F.sum(F.when(~over, F.col("weight"))),
            F.count(F.when(over, 1)),
        ).first()
        if n == capped or not rest:
            break
        level, capped = (share * total - most * full) / rest, n
    target = F.least(F.col("size") * F.lit(float(most)), F.lit(level) * F.col("weight"))
    return sources.select("source", F.col("size").alias("source_size"), "weight", target.alias("target"))


def draw(key: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def with_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """Every row of ``docs`` as ``row`` with size, source_size, target and copies.

    copies is floor(rate) plus one where the row's draw is below the fraction of the rate, rate being
    target / source_size (0 for a source without words). Size is the number of words; NULL text has none,
    NULL source is a source of its own, rows with the same id share a draw, an empty table gives no rows.
    """
    sized = docs.select(
        whole_row(docs).alias("row"),
        F.col(f"`{source_col}`").alias("source"),
        words(F.col(f"`{text_col}`")).alias("size"),
        draw(F.col(f"`{id_col}`"), seed).alias("draw"),
    )
    targets = source_targets(sized.select("source", "size"), weights, share, most).withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (F.col("draw") < rate - F.floor(rate)).cast("long")
    return sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "size", "source_size", "target", copies.alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, each as often as ``with_copies`` says, with the columns of ``docs``."""
    counted = with_copies(docs, **options).filter("copies > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
