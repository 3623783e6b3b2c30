"""Removal of repeated passages, found through difference-cover anchors.

Every pair of places modulo ``PERIOD`` has a common shift to a cover place. So two equal windows of words share an anchor: a
run of ``window - PERIOD + 1`` words that starts at a cover place of both. Only anchors are hashed for all texts; the windows
round the anchors that occur twice are then extended to their full length and compared by a 96-bit hash.

Hashes are dealt out in packed pieces, one per batch and part. A hash that a batch holds several times is settled there and
sent once, so a passage in a third of all documents costs a part one entry per batch.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trendloom.llm.wordhash import BASES, Runs, Words, mix, slices

#: A perfect difference set: its 20 differences are all the residues but 0, each once.
PERIOD = 21
COVER = (0, 1, 4, 14, 16)
WINDOW = 35
PART_BYTES = 32 << 20
#: Windows of a batch that are packed together.
HELD = 1 << 20

PIECES = "part int, ids binary, sums binary, counts binary, places binary, hashes binary, more binary, held binary, held_more binary"
MARKS = "of int, ids binary, sums binary, counts binary, places binary"
MERGED = "m_id long, m_sum long, marks binary"


def _firsts(values: np.ndarray, more: np.ndarray) -> np.ndarray:
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (more[1:] != more[:-1])
    return new


def _repeats(values: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by value, and for each entry in that order the number of its group."""
    order = np.lexsort((more, values))
    return order, np.cumsum(_firsts(values[order], more[order])) - 1


def _bucket(ids: np.ndarray, sums: np.ndarray, parts: int) -> np.ndarray:
    """Where the marks of a document are brought together."""
    return (mix(ids.view(np.uint64) ^ mix(sums.view(np.uint64))) % np.uint64(parts)).astype(np.int64)


def _marks(parts: int, ids: np.ndarray, sums: np.ndarray, owner: np.ndarray, places: np.ndarray) -> Iterator[tuple]:
    """(bucket, ids, sums, counts, places), packed, for each bucket that gets some; entries are in the order of owners."""
    bucket = _bucket(ids, sums, parts)[owner]
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for mine in np.split(order, cuts) if len(order) else ():
        own, counts = np.unique(owner[mine], return_counts=True)
        yield int(bucket[mine[0]]), ids[own].tobytes(), sums[own].tobytes(), counts.astype(np.uint32).tobytes(), places[mine].tobytes()


def _pieces(parts: int, ids: np.ndarray, sums: np.ndarray, entries: list[tuple]) -> Iterator[pa.RecordBatch]:
    """One row per part with a batch's entries (owner, place, hash, more); entries that repeat within the batch become
    marks (part below 0 means: marks for bucket ~part)."""
    if not sum(len(e[0]) for e in entries):
        return
    owner, places, values, more = (np.concatenate(x) for x in zip(*entries))
    order, group = _repeats(values, more)
    several = (np.bincount(group) > 1)[group]
    local = np.zeros(len(values), bool)
    local[order] = several
    rows = []
    held = order[several & np.r_[True, np.diff(group) > 0]]
    where = values.view(np.uint64) % np.uint64(parts)
    for part in range(parts):
        mine = np.flatnonzero((where == part) & ~local)
        own, counts = np.unique(owner[mine], return_counts=True)
        mark = held[where[held] == part]
        if len(mine) or len(mark):
            rows.append((part, ids[own].tobytes(), sums[own].tobytes(), counts.astype(np.uint32).tobytes(), places[mine].tobytes(),
                         values[mine].tobytes(), more[mine].tobytes(), values[mark].tobytes(), more[mark].tobytes()))
    found = np.flatnonzero(local)
    rows += [(~bucket, *packed, None, None, None, None) for bucket, *packed in _marks(parts, ids, sums, owner[found], places[found])]
    kinds = [pa.int32()] + [pa.binary()] * 8
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in PIECES.split(", ")])


def _resolve(parts: int) -> Callable:
    """Marks: the places in each document whose hash occurs in another piece of the part, or several times in its batch."""

    def resolve(key: tuple, rows: pa.Table) -> pa.Table:
        marks, ids, sums, owner, places, values, more, held, held_more = [], [], [], [], [], [], [], [], []
        start = 0
        for r in rows.to_pylist():
            if r["part"] < 0:
                marks.append((~r["part"], r["ids"], r["sums"], r["counts"], r["places"]))
                continue
            ids.append(np.frombuffer(r["ids"], np.int64))
            sums.append(np.frombuffer(r["sums"], np.int64))
            owner.append(np.repeat(np.arange(start, start + len(ids[-1])), np.frombuffer(r["counts"], np.uint32)))
            start += len(ids[-1])
            for out, name, kind in ((places, "places", np.uint32), (values, "hashes", np.int64), (more, "more", np.uint32), (held, "held", np.int64), (held_more, "held_more", np.uint32)):
                out.append(np.frombuffer(r[name], kind))
        if values:
            own = np.concatenate(owner)
            order, group = _repeats(np.concatenate(values + held), np.concatenate(more + held_more))
            several = np.zeros(len(order), bool)
            several[order] = (np.bincount(group) > 1)[group]
            found = np.flatnonzero(several[: len(own)])
            marks += _marks(parts, np.concatenate(ids), np.concatenate(sums), own[found], np.concatenate(places)[found])
        kinds = [pa.int32()] + [pa.binary()] * 4
        columns = list(zip(*marks)) if marks else [[]] * 5
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in MARKS.split(", ")])

    return resolve


def _merge(key: tuple, rows: pa.Table) -> pa.Table:
    """One row per document of a bucket with all its marks."""
    ids, sums, counts, places = (
        np.concatenate([np.frombuffer(x, kind) for x in rows.column(name).to_pylist()])
        for name, kind in (("ids", np.int64), ("sums", np.int64), ("counts", np.uint32), ("places", np.uint32))
    )
    owner = np.repeat(np.arange(len(ids)), counts)
    order = np.lexsort((places, sums[owner], ids[owner]))
    ids, sums, places = ids[owner[order]], sums[owner[order]], places[order]
    first = np.flatnonzero(_firsts(ids, sums))
    packed = [x.tobytes() for x in np.split(places, first[1:])]
    return pa.table([pa.array(ids[first]), pa.array(sums[first]), pa.array(packed, pa.binary())], names=["m_id", "m_sum", "marks"])


def _marked(pieces: DataFrame, parts: int) -> DataFrame:
    """All marks of a document in one row; a document has at most as many as places."""
    part = F.when(F.col("part") < 0, -1 - F.col("part")).otherwise(F.col("part"))
    return pieces.groupBy(part.alias("dealt")).applyInArrow(_resolve(parts), MARKS).groupBy("of").applyInArrow(_merge, MERGED)


def _places(marks: bytes) -> np.ndarray:
    return np.unique(np.frombuffer(marks, np.uint32)).astype(np.int64)


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("id").to_numpy(), batch.column("sum").to_numpy()


def _anchors(window: int, parts: int) -> Callable:
    length = window - PERIOD + 1
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (ids, sums), entries, base = _arrays(batch), [], 0
            for part in slices(batch):
                words = Words(part.column("text"))
                counts = words.counts()
                owner = np.repeat(np.arange(len(counts)), counts)
                places = np.arange(len(owner)) - words.first[owner]
                at = np.flatnonzero(cover[places % PERIOD] & (places + length <= counts[owner]) & (counts[owner] >= window))
                values = Runs(words.hashes()).at(at, length)
                entries.append((base + owner[at], places[at].astype(np.uint32), values, np.zeros(len(at), np.uint32)))
                base += len(counts)
            yield from _pieces(parts, ids, sums, entries)

    return find


def _windows(window: int, parts: int) -> Callable:
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("marks").is_valid())
            (ids, sums), entries, base, held = _arrays(batch), [], 0, 0
            for part in slices(batch):
                words = Words(part.column("text"))
                counts, edges = words.counts(), np.zeros(len(words.begin) + 1, np.int64)
                for i, marks in enumerate(part.column("marks").to_pylist()):
                    at = _places(marks)
                    np.add.at(edges, words.first[i] + np.maximum(at - PERIOD + 1, 0), 1)
                    np.add.at(edges, words.first[i] + at + 1, -1)
                owner = np.repeat(np.arange(len(counts)), counts)
                places = np.arange(len(owner)) - words.first[owner]
                at = np.flatnonzero((np.cumsum(edges)[:-1] > 0) & (places + window <= counts[owner]))
                hashes = words.hashes()
                values = Runs(hashes).at(at, window)
                more = (Runs(hashes, BASES[1]).at(at, window) & 0xFFFFFFFF).astype(np.uint32)
                entries.append((base + owner[at], places[at].astype(np.uint32), values, more))
                base, held = base + len(counts), held + len(at)
                if held > HELD:
                    yield from _pieces(parts, ids, sums, entries)
                    entries, held = [], 0
            yield from _pieces(parts, ids, sums, entries)

    return extend


def _cut(window: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            words = Words(batch.column("text"))
            counts, edges = words.counts(), np.zeros(len(words.begin) + 1, np.int64)
            for i, marks in enumerate(batch.column("marks").to_pylist()):
                if marks:
                    at = words.first[i] + _places(marks)
                    np.add.at(edges, at, 1)
                    np.add.at(edges, at + window, -1)
            stays = np.cumsum(edges)[:-1] <= 0
            # Kept words with one space after each, then cut per document without the last space.
            size = np.where(stays, words.end - words.begin + 1, 0)
            ends = np.concatenate([[0], np.cumsum(size)])
            source = np.repeat(words.begin - ends[:-1], size) + np.arange(ends[-1])
            last = ends[1:][stays] - 1
            source[last] = 0
            kept = words.data[source] if len(source) else words.data[:0]
            kept[last] = 32
            whole_text, bounds = kept.tobytes(), ends[words.first].tolist()
            gone = np.concatenate([[0], np.cumsum(~stays)])[words.first]
            texts = [whole_text[a : max(a, b - 1)] for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(np.diff(gone)), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return cut


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space) for every row.

    A word goes when a window of ``window`` words covers it whose sequence also starts at any other place of the table, the same
    document included; windows are judged on the input. NULL text has no words, texts with fewer words than a window
    stay whole. Rows may repeat and ids may be NULL: rows are told apart by id and a checksum of the text, and rows equal in
    both are copies of each other. Needs window >= ``PERIOD``.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    ident = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(ident.alias("doc_id"), F.coalesce(ident, F.lit(-1)).alias("id"), F.xxhash64(ident, text).alias("sum"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(total / part_bytes))

    def with_marks(marks: DataFrame) -> DataFrame:
        return rows.join(marks, (F.col("id") == F.col("m_id")) & (F.col("sum") == F.col("m_sum")), "left").drop("m_id", "m_sum")

    anchors = _marked(rows.mapInArrow(_anchors(window, parts), PIECES), parts)
    windows = _marked(with_marks(anchors).mapInArrow(_windows(window, parts), PIECES), parts)
    return with_marks(windows).mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept string")

