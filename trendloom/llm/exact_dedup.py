"""Exact duplicates by content sort.

Sampled splitters deal the rows out by (text, id) ranges, an external sort puts equal texts next to
each other, and neighbours are compared in full. The id is part of the range key, so a text that a
third of all rows share is spread over many tasks; a table of one row per partition then joins runs
that cross a boundary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from trendloom.llm.tables import whole_row
from trendloom.session import stage

#: The place of a row: the partition in the upper bits, its index there below.
PART_BITS = 40
SPLITTER_CHARS = 32


def _sorted_runs(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """One staged row per document, in content order, and one ``edge`` row per partition."""
    text, ident = F.coalesce(F.col("row.text"), F.lit("")), F.col("row.id")
    # The order is by content: first bytes, then the digest of all, so that sampled splitters stay short.
    order = [F.substring(text, 1, SPLITTER_CHARS), F.sha2(text, 256), ident]
    columns = [F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")]
    if carry:
        columns.append(whole_row(docs.drop(text_col)).alias("rest"))
    rows = docs.select(F.struct(*columns).alias("row"))
    row_type = rows.schema["row"].dataType
    kept_type = row_type if carry else T.StructType([f for f in row_type if f.name == "id"])
    schema = T.StructType([
        T.StructField("part", T.IntegerType()),
        T.StructField("run", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("opens", T.BooleanType()),
        T.StructField("closes", T.BooleanType()),
        T.StructField("text_sha256", T.StringType()),
        T.StructField("row", kept_type),
        T.StructField("runs", T.LongType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
    ])

    def emit(part, row, opens, closes, digests, run, index):
        n = len(row)
        if not carry:
            row = pa.StructArray.from_arrays([row.field("id")], fields=[row.type.field("id")])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, part, np.int32)),
                pa.array(run),
                pa.array((part << PART_BITS) + index + np.arange(n, dtype=np.int64)),
                pa.array(opens),
                pa.array(closes),
                pa.array(digests, pa.string()),
                row,
                pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.string()),
                pa.nulls(n, pa.string()),
            ],
            names=schema.names,
        )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        run, index, held, first, last, digest, row_arrow = -1, 0, None, None, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            row = batch.column(0)
            text = pc.fill_null(row.field("text"), "")
            opens = np.ones(len(row), bool)
            if len(row) > 1:
                opens[1:] = ~pc.equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
            start = text[0].as_py()
            opens[0] = last is None or start != last
            first = start if first is None else first
            digests = []
            for i, new in enumerate(opens):
                if new:
                    digest = hashlib.sha256(text[i].as_py().encode()).hexdigest()
                digests.append(digest)
            if held:
                held[2][-1] = opens[0]
                yield emit(part, *held)
            numbers = run + np.cumsum(opens, dtype=np.int64)
            held = (row, opens, np.append(opens[1:], True), digests, numbers, index)
            run, index, last = int(numbers[-1]), index + len(row), text[-1].as_py()
            row_arrow = row.type
        if held:
            yield emit(part, *held)
            kept = row_arrow if carry else pa.struct([row_arrow.field("id")])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    *[pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), kept)],
                    pa.array([run + 1], pa.int64()),
                    pa.array([first], pa.string()),
                    pa.array([last], pa.string()),
                ],
                names=schema.names,
            )

    return stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema))


def _numbered(staged: DataFrame) -> DataFrame:
    """Every row with the number of its group over all partitions and with ``first``/``last``: whether
    it opens or closes its group. The side table has one row of numbers per partition."""
    edges, order = staged.filter("runs IS NOT NULL"), Window.orderBy("part")
    places = edges.select("part", "runs", F.lag("part").over(order).alias("before"))
    firsts = edges.select(F.col("part").alias("of"), "first")
    lasts = edges.select(F.col("part").alias("of_before"), "last")
    joined = (
        places.join(firsts, F.col("part") == F.col("of"))
        .join(lasts, F.col("before") == F.col("of_before"), "left")
        .select("part", "runs", F.coalesce(F.col("first") == F.col("last"), F.lit(False)).alias("joined"))
    )
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    bases = joined.select(
        F.col("part").alias("base_part"),
        F.col("runs").alias("part_runs"),
        "joined",
        F.coalesce(F.lead("joined").over(order), F.lit(False)).alias("goes_on"),
        (F.coalesce(F.sum("runs").over(earlier), F.lit(0)) - F.sum(F.col("joined").cast("long")).over(upto)).alias("base"),
    )
    rows = staged.filter("runs IS NULL").drop("runs", "first", "last")
    return rows.join(F.broadcast(bases), F.col("part") == F.col("base_part")).select(
        (F.col("base") + F.col("run")).alias("group"),
        "seq",
        (F.col("opens") & ~((F.col("run") == 0) & F.col("joined"))).alias("first"),
        (F.col("closes") & ~((F.col("run") == F.col("part_runs") - 1) & F.col("goes_on"))).alias("last"),
        "text_sha256",
        "row",
    )


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; NULL counts as empty, and all empty texts form one group.
    ``keep`` names the id that stays, ``smallest`` or ``largest``; NULL ids come before all others.
    Of several rows with that same id and text exactly one stays. An empty table gives no rows;
    columns other than the two are not read.
    """
    rows = _numbered(_sorted_runs(docs, id_col, text_col, carry=False))
    best = F.min if keep == "smallest" else F.max
    groups = (
        rows.groupBy(F.col("group").alias("of"))
        .agg(best(F.struct("seq", "row.id")).alias("best"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
    )
    return rows.join(groups, F.col("group") == F.col("of"), "left").select(
        F.col("row.id").alias("doc_id"),
        F.when(F.col("members").isNull(), F.col("row.id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("members", F.lit(1)).cast("long").alias("group_size"),
        F.col("first" if keep == "smallest" else "last").alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows that stay, with all their columns as they were; see ``content_groups``."""
    rows = _numbered(_sorted_runs(docs, id_col, text_col, carry=True))
    columns = [F.col("row.text" if c == text_col else f"row.rest.`{c}`").cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    return rows.filter(F.col("first" if keep == "smallest" else "last")).select(*columns)
