"""Exact top-k by inner product over a pivot-distance index.

Vectors get one more component that makes all their lengths equal, so that a larger inner product is a
smaller distance. Each is keyed by its nearest pivot and the distance to it and packed, in that order, into blocks:
sorted annuli round the pivots. A first pass over the annuli round a query's own place gives its k-th best
score so far; by the triangle inequality only annuli within the radius of that score can hold better ones, and
they are expanded outwards until the bound passes the best k found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trendloom.llm.tables import hashed_share
from trendloom.session import stage

PIVOTS = 32
PIVOT_SAMPLE = 2048
BLOCK_ROWS = 1024
CHUNK_ROWS = 128
#: Rounding of a distance, as a share of the common length; far above that of doubles.
SLACK = 1e-6
#: Below every score, and safe to negate.
NONE = -(1 << 62)

INDEX = "pivot int, low double, high double, n int, width int, ids binary, data binary"


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not NULL, and without NULL, NaN and infinite components."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """Rows (id, v) that take part, every component turned into floor(scale * x); rows without an id take no part."""
    vector = F.col(f"`{vector_col}`")
    return vectors.filter(F.col(f"`{id_col}`").isNotNull() & usable(vector)).select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("v"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, short ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _distances(rows: np.ndarray, pivots: np.ndarray, square: float) -> np.ndarray:
    """Distances to the pivots in the space with the added component."""
    rows, pivots = rows.astype(float), pivots.astype(float)
    norms, marks = (rows**2).sum(1), (pivots**2).sum(1)
    rest = np.sqrt(np.maximum(square - norms, 0))[:, None] * np.sqrt(np.maximum(square - marks, 0))
    return np.sqrt(np.maximum(2 * square - 2 * (rows @ pivots.T + rest), 0))


def choose_pivots(sample: np.ndarray, square: float, count: int) -> np.ndarray:
    """Farthest-first from the first sampled vector."""
    chosen, nearest = [0], _distances(sample, sample[:1], square)[:, 0]
    while len(chosen) < min(count, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(sample, sample[chosen[-1:]], square)[:, 0])
    return sample[chosen]


def _pack(keyed: DataFrame, rows_each: int) -> DataFrame:
    """Blocks of at most ``rows_each`` vectors of one pivot, by distance."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows and (cut := _cut(held)):
                yield _block(held.slice(0, cut))
                held = held.slice(cut)
        while held is not None and held.num_rows:
            cut = _cut(held, last=True)
            yield _block(held.slice(0, cut))
            held = held.slice(cut)

    def _cut(rows: pa.Table, last: bool = False) -> int:
        pivots = rows.column("pivot").to_numpy()
        same = int(np.argmax(pivots != pivots[0])) if (pivots != pivots[0]).any() else len(pivots)
        return min(same, rows_each) if last or same < len(pivots) or same >= rows_each else 0

    def _block(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        vectors = rows.column("v").chunk(0) if rows.column("v").num_chunks else rows.column("v").combine_chunks()
        width = int(np.diff(vectors.offsets.to_numpy()).max(initial=0))
        data = _matrix(vectors, width)
        small = np.abs(data).max(initial=0) < 1 << 15
        dist = rows.column("dist").to_numpy()
        values = [rows.column("pivot")[0].as_py(), float(dist.min()), float(dist.max()), len(dist), width,
                  rows.column("id").to_numpy().astype(np.int64).tobytes(), (b"s" if small else b"l") + data.astype(np.int16 if small else np.int64).tobytes()]
        kinds = [pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[f.split()[0] for f in INDEX.split(", ")])

    order = ["pivot", "dist", "id"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, INDEX)


def _unpack(ids: bytes, data: bytes, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    kind = np.int16 if data[:1] == b"s" else np.int64
    return np.frombuffer(ids, np.int64), np.frombuffer(data, kind, offset=1).reshape(n, width).astype(np.int64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products; by doubles where these hold them exactly. Sums beyond 64 bits are not supported."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if width * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank from 1, vec_id, score: the ``k`` highest inner products of every query, all where there are fewer.

    ``is_query`` is a condition on ``id`` that picks the queries; every other row is a candidate, and rows with the query's own id are
    not. Ties go to the smaller id. Vectors of unequal length count as filled up with zeros. The result is
    exact; pivots come from about ``PIVOT_SAMPLE`` vectors, picked by the hash of their ids, and only change the work. Query rows that
    repeat an id and its vector are one query; a candidate that stands in several rows is found as often.
    """
    spark = vectors.sparkSession
    plain = quantised(vectors, id_col, vector_col)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    square, width = plain.agg(F.max(norm), F.max(F.size("v"))).first()
    result = "query_id long, rank int, vec_id long, score long"
    if square is None:
        return spark.createDataFrame([], result)
    square, width = max(square, 1.0), max(width, 1)
    slack = SLACK * square**0.5
    sample = hashed_share(plain, F.col("id"), PIVOT_SAMPLE).collect()
    marks = np.zeros((len(sample), width), np.int64)
    for i, row in enumerate(sample):
        marks[i, : len(row.v)] = row.v
    marks = choose_pivots(marks, square, pivots)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = _distances(_matrix(batch.column(1), width), marks, square)
            home = far.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home.astype(np.int32)), pa.array(far[np.arange(len(home)), home])], names=["id", "v", "pivot", "dist"]
            )

    keyed = plain.mapInArrow(key, "id long, v array<long>, pivot int, dist double")
    index = stage(_pack(keyed, block_rows))
    chunks = _pack(keyed.filter(is_query).dropDuplicates(["id", "v"]), CHUNK_ROWS).withColumnsRenamed({c: f"q_{c}" for c in ("low", "high", "n", "width", "ids", "data")})
    chunks = stage(chunks.withColumn("chunk", F.xxhash64("q_ids", "pivot")))

    near = chunks.join(index, "pivot").filter((F.col("low") <= F.col("q_high") + slack) & (F.col("high") >= F.col("q_low") - slack))

    def best(ids, scores, own, keep):
        """Per query the best ``keep`` of a block, ties to smaller ids."""
        scores = np.where(own, NONE, scores)
        order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :keep]
        return np.take_along_axis(np.broadcast_to(ids, scores.shape), order, 1), np.take_along_axis(scores, order, 1)

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, q = _unpack(r["q_ids"], r["q_data"], r["q_n"], r["q_width"])
                ids, data = _unpack(r["ids"], r["data"], r["n"], r["width"])
                own = q_ids[:, None] == ids
                _, scores = best(ids, _products(q, data), own, k)
                row, _ = np.nonzero(valid := scores > NONE)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), r["chunk"])), pa.array(q_ids[row]), pa.array(scores[valid])], names=["of", "query_id", "score"])

    ranked = Window.partitionBy("of", "query_id").orderBy(F.desc("score"))
    so_far = near.mapInArrow(seeds, "of long, query_id long, score long").withColumn("r", F.row_number().over(ranked)).filter(F.col("r") == k)
    limits = so_far.groupBy("of").agg(F.map_from_entries(F.collect_set(F.struct("query_id", "score"))).alias("limits"))
    ready = chunks.join(limits, F.col("chunk") == F.col("of"), "left").drop("of")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each chunk and pivot, the distances at which a better vector can lie."""
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, q = _unpack(r["q_ids"], r["q_data"], r["q_n"], r["q_width"])
                known = dict(r["limits"] or [])
                limit = np.array([known.get(i, np.nan) for i in q_ids.tolist()], float)
                norms = (q.astype(float) ** 2).sum(1)
                radius = np.where(np.isnan(limit), np.inf, np.sqrt(np.maximum(norms + square - 2 * limit, 0))) + slack
                full = np.zeros((len(q), width))
                full[:, : q.shape[1]] = q
                # A query lies in the added component at 0, at distance sqrt(|q|^2 + square - 2 q.p) from a pivot.
                far = np.sqrt(np.maximum(norms[:, None] + square - 2 * (full @ marks.T.astype(float)), 0))
                low, high = (far - radius[:, None]).min(0), (far + radius[:, None]).max(0)
                n = len(marks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["chunk"]] * n), pa.array(np.arange(n, dtype=np.int32)), pa.array(low), pa.array(high), pa.array(far.mean(0)),
                     *[pa.array([r[c]] * n, t) for c, t in (("q_n", pa.int32()), ("q_width", pa.int32()), ("q_ids", pa.binary()), ("q_data", pa.binary()))],
                     pa.array([np.where(np.isnan(limit), -np.inf, limit).tobytes()] * n), pa.array([np.ascontiguousarray(far[:, i]).tobytes() for i in range(n)])],
                    names=["chunk", "pivot", "q_low", "q_high", "q_mid", "q_n", "q_width", "q_ids", "q_data", "q_limits", "q_far"],
                )

    reach = ready.mapInArrow(spread, "chunk long, pivot int, q_low double, q_high double, q_mid double, q_n int, q_width int, q_ids binary, q_data binary, q_limits binary, q_far binary")
    annuli = (
        reach.join(index, "pivot")
        .filter((F.col("low") <= F.col("q_high")) & (F.col("high") >= F.col("q_low")))
        .withColumn("gap", F.greatest(F.col("low") - F.col("q_mid"), F.col("q_mid") - F.col("high")))
        .sortWithinPartitions("pivot", "chunk", "gap")
    )

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Annuli of one pivot from the nearest outwards; the best k so far of each query of the chunk are kept."""
        at = None

        def found():
            row, _ = np.nonzero(valid := (scores > NONE) & (scores >= limits[:, None]))
            return pa.RecordBatch.from_arrays([pa.array(q_ids[row]), pa.array(ids_best[valid]), pa.array(scores[valid])], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for r in batch.to_pylist():
                if (r["chunk"], r["pivot"]) != at:
                    if at is not None:
                        yield found()
                    at = (r["chunk"], r["pivot"])
                    q_ids, q = _unpack(r["q_ids"], r["q_data"], r["q_n"], r["q_width"])
                    limits, far = np.frombuffer(r["q_limits"]), np.frombuffer(r["q_far"])
                    ids_best = np.zeros((len(q), 0), np.int64)
                    scores, norms = np.zeros((len(q), 0), np.int64), (q.astype(float) ** 2).sum(1)
                bound = np.maximum(limits, scores[:, k - 1] if scores.shape[1] >= k else -np.inf)
                gap = np.maximum(np.maximum(r["low"] - far, far - r["high"]) - slack, 0)
                if not ((norms + square - gap**2) / 2 >= bound - 1).any():
                    continue
                ids, data = _unpack(r["ids"], r["data"], r["n"], r["width"])
                own = q_ids[:, None] == ids
                more_ids, more = best(ids, _products(q, data), own, k)
                ids_best, scores = np.concatenate([ids_best, more_ids], 1), np.concatenate([scores, more], 1)
                order = np.lexsort((ids_best, -scores), axis=1)[:, :k]
                ids_best, scores = np.take_along_axis(ids_best, order, 1), np.take_along_axis(scores, order, 1)
        if at is not None:
            yield found()

    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        annuli.mapInArrow(expand, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
