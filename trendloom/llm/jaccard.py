"""Near duplicates by a blocked sparse product of the document by n-gram incidence matrix.

Row blocks are documents of like set sizes, column blocks are classes of n-gram hashes. The threshold bounds how many n-grams two sets
of a row block can differ in, and there are more column blocks than that; so two sets that link hold the same n-grams in some block. Blocks
are known by a hash of their n-grams, which brings together the rows that are equal in one; pairs that are equal in none lie below the bound
and are never formed. Sizes and parity sketches discard pairs that cannot reach the threshold, and the overlaps of the rest are
accumulated over the column blocks. Documents with the same set count once, and so do blocks in which the same sets meet.

What is asked for is components, not all links: within a group of documents that are equal in a block, every document
meets the group's centre first, and then only documents still in different components meet each other.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trendloom.llm.components import components
from trendloom.llm.wordhash import Runs, U, Words, lean, mix, slices
from trendloom.session import stage

SHINGLE = 3
#: Threshold in per cent.
LEAST = 90
#: A row block reaches up to this many times its smallest size.
BAND = 1.4
SKETCH = 16
COLUMN_BLOCKS = 4
#: Ids of documents in close pairs are sent to the executors up to this size.
BROADCAST_BYTES = 32 << 20
#: Sets that a task remembers to send once.
MET = 1 << 18
#: Rounds in which the centres of blocks are met; what they leave open is settled by pairs, so only the work depends on it.
ROUNDS = 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Incidence:
    """The rows of the matrix for a batch of texts: ``owner`` and ``tokens``, sorted and distinct in each row."""

    def __init__(self, texts: pa.Array, width: int) -> None:
        words = Words(texts)
        counts = words.counts()
        owner = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(owner)) - words.first[owner]
        length = np.minimum(counts, width)
        start = np.flatnonzero(place + length[owner] <= counts[owner])
        runs = Runs(words.hashes(_LOWER[words.data]))
        tokens = mix(runs.at(start, length[owner[start]]).view(U) + length[owner[start]].astype(U)).view(np.int64)
        owner = owner[start]
        order = np.lexsort((tokens, owner))
        owner, tokens = owner[order], tokens[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (tokens[1:] != tokens[:-1])
        self.owner, self.tokens = owner[new], tokens[new]
        self.sizes = np.bincount(self.owner, minlength=len(counts))
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])

    def _each(self, values: np.ndarray, combine) -> np.ndarray:
        out, full = np.zeros(len(self.sizes), U), np.flatnonzero(self.sizes)
        if len(full):
            out[full] = combine.reduceat(values, self.first[full])
        return out

    def signatures(self) -> np.ndarray:
        """64 bits for the whole set."""
        return mix(self._each(mix(self.tokens.view(U) ^ U(0x5851F42D4C957F2D)), np.add) + self.sizes.astype(U)).view(np.int64)

    def sketches(self) -> list[np.ndarray]:
        """Parity of the tokens that fall on each of 64 * SKETCH bits: two sets differ in at least as many tokens as bits."""
        bits = (mix(self.tokens.view(U) ^ U(0x2545F4914F6CDD1D)) % U(64 * SKETCH)).astype(np.int64)
        odd = np.bincount(self.owner * (64 * SKETCH) + bits, minlength=len(self.sizes) * 64 * SKETCH) & 1
        words = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(self.sizes), SKETCH)
        return [np.ascontiguousarray(words[:, i]) for i in range(SKETCH)]

    def wide(self) -> pa.Array:
        """The same with about a bit per token, a power of two of them, for the sets with more tokens than the sketch has bits; NULL for others."""
        large = self.sizes >= 64 * SKETCH
        bits = np.where(large, 1 << np.ceil(np.log2(np.maximum(self.sizes, 1))).astype(np.int64), 0)
        base = np.concatenate([[0], np.cumsum(bits)])
        used = large[self.owner]
        owner = self.owner[used]
        at = base[owner] + (mix(self.tokens[used].view(U) ^ U(0xE7037ED1A0B428DB)) % bits[owner].astype(U)).astype(np.int64)
        odd = np.bincount(at, minlength=base[-1]) & 1
        offsets = pa.array((base // 64).astype(np.int32), mask=np.append(~large, False))
        return pa.ListArray.from_arrays(offsets, pa.array(np.packbits(odd.astype(np.uint8)).view(np.int64)))


def _first_met(sets: np.ndarray, met: set[int]) -> np.ndarray:
    """Which rows hold a set that was not met before; the sets are then met."""
    out = np.zeros(len(sets), bool)
    for i, value in enumerate(sets.tolist()):
        if value not in met:
            met.add(value)
            out[i] = True
    return out


def _columns(names: list[str], values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v) for v in values], names=names)


SKETCHES = [f"k{i}" for i in range(SKETCH)]


def _survey(rows: DataFrame, width: int) -> DataFrame:
    """One row per document: id, set, n, sketch and wide sketch."""
    names = ["id", "set", "n", *SKETCHES]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            found = Incidence(batch.column("text"), width)
            yield _columns([*names, "wide"], [batch.column("id"), found.signatures(), found.sizes, *found.sketches(), found.wide()])

    return stage(rows.mapInArrow(lean(read), ", ".join(f"{n} long" for n in names) + ", wide array<long>"))


@functools.lru_cache(maxsize=32)
def _bands(largest: int) -> np.ndarray:
    """The smallest sizes of the row blocks, up to the first above ``largest``."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND)))
    return np.array(edges)


@functools.lru_cache(maxsize=4096)
def _blocks(smallest: int, largest: int, least: int) -> tuple[int, int]:
    """How many column blocks there are for a row block, and how many of them are to spare.

    Two linked sets of at most ``largest`` n-grams differ in at most ``apart`` of them, so with ``apart + 1 + spare`` blocks they are equal in
    ``spare + 1`` at least. There are about as many to spare as are empty in a set of the smallest size, and at most ``apart``; only the work
    depends on it.
    """
    apart = 2 * largest * (100 - least) // (100 + least)
    spare = 0
    while spare < apart:
        blocks = apart + 1 + spare
        empty = blocks * (1 - 1 / blocks) ** smallest
        if spare >= empty + 3 * math.sqrt(empty):
            break
        spare += 1
    return apart + 1 + spare, spare


def _equal_blocks(found: Incidence, mine: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, token) for the column blocks of the documents ``mine``: equal tokens for equal blocks.

    A set stands in its own row block and in each that a larger set may be in with which it links. Two sets equal in
    blocks that are all empty in both have more empty ones than there are to spare; so of a set's empty blocks the first
    count, as many as it has beyond the spare ones, and two such sets share the first that both have.
    """
    sizes = found.sizes
    edges = _bands(100 * int(sizes.max(initial=1)) // least + 1)
    own = np.searchsorted(edges, sizes, side="right") - 1
    last = np.searchsorted(edges, 100 * sizes // least, side="right") - 1
    hashes = mix(found.tokens.view(U) ^ U(0x94D049BB133111EB))
    for up in range(int((last - own).max(initial=0)) + 1):
        docs = np.flatnonzero(mine & (sizes > 0) & (own + up <= last))
        if not len(docs):
            return
        band = own[docs] + up
        shape = [_blocks(max(1, -(-int(edges[b]) * least // 100)), int(edges[b + 1]) - 1, least) for b in range(int(band.max()) + 1)]
        blocks, spare = (np.array([x[i] for x in shape])[band] for i in (0, 1))
        # With one block only equal sets would meet.
        docs, band, blocks, spare = (x[blocks > 1] for x in (docs, band, blocks, spare))
        base = np.concatenate([[0], np.cumsum(blocks)])
        at = np.full(len(sizes), -1)
        at[docs] = np.arange(len(docs))
        row = at[found.owner]
        used = row >= 0
        row = row[used]
        cell = base[row] + (hashes[used] % blocks[row].astype(U)).astype(np.int64)
        sums, counts = np.zeros(base[-1], U), np.bincount(cell, minlength=base[-1])
        np.add.at(sums, cell, mix(hashes[used]))
        owner = np.repeat(np.arange(len(docs)), blocks)
        block = np.arange(base[-1]) - base[owner]
        empty = counts == 0
        before = np.cumsum(empty) - empty
        rank = before - before[base[:-1]][owner] if len(docs) else before
        beyond = np.bincount(owner, empty, minlength=len(docs)).astype(np.int64) - spare
        sent = ~empty | (rank < beyond[owner])
        place = (band[owner] * (1 << 32) + block).astype(U)
        tokens = mix(sums + mix(place ^ U(0xD6E8FEB86659FD93)) + counts.astype(U)).view(np.int64)
        yield docs[owner[sent]], tokens[sent]


def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order, those whose token stands beside another set; a batch's last row waits for the next batch."""
    tokens, sets, kept = (np.zeros(0, kind) for kind in (np.int64, np.int64, bool))
    for batch in batches:
        tokens = np.concatenate([tokens[-1:], batch.column("token").to_numpy()])
        sets = np.concatenate([sets[-1:], batch.column("set").to_numpy()])
        gone = np.concatenate([kept[-1:], np.zeros(batch.num_rows, bool)])
        same = tokens[1:] == tokens[:-1]
        new = np.ones(len(tokens), bool)
        new[1:] = ~(same & (sets[1:] == sets[:-1]))
        tokens, sets, gone = tokens[new], sets[new], gone[new]
        same = tokens[1:] == tokens[:-1]
        kept = np.zeros(len(tokens), bool)
        kept[1:] |= same
        kept[:-1] |= same
        out = kept & ~gone
        kept |= gone
        yield _columns(["token", "set"], [tokens[out], sets[out]])


def with_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, with ``whole`` NULL, and after them one row per token: its smallest set and in ``whole`` 64 bits for all its sets.

    Only a sum and the smallest set of the batch's last token wait for the next batch, so a token may have any number of rows.
    """
    last = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U))

    def ended(tokens: np.ndarray, low: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return _columns(["token", "set", "whole"], [tokens, low, mix(sums).view(np.int64)])

    for batch in batches:
        if not batch.num_rows:
            continue
        tokens, sets = batch.column("token").to_numpy(), batch.column("set").to_numpy()
        yield _columns(["token", "set", "whole"], [tokens, sets, pa.nulls(len(sets), pa.int64())])
        tokens, low = np.concatenate([last[0], tokens]), np.concatenate([last[1], sets])
        sums = np.concatenate([last[2], mix(sets.view(U) ^ U(0xA0761D6478BD642F))])
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        groups = tokens[first], low[first], np.add.reduceat(sums, first)
        last = tuple(x[-1:] for x in groups)
        yield ended(*(x[:-1] for x in groups))
    if len(last[0]):
        yield ended(*last)


def _meetings(rows: DataFrame, width: int, least: int) -> DataFrame:
    """(token, set, whole): the sets that are equal in a column block to another set, by the block's token, as ``with_groups`` gives them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in (part for whole in batches for part in slices(whole)):
            found = Incidence(batch.column("text"), width)
            sets = found.signatures()
            met = met if len(met) < MET else set()
            for docs, tokens in _equal_blocks(found, _first_met(sets, met), least):
                yield _columns(["token", "set"], [tokens, sets[docs]])

    blocks = rows.mapInArrow(lean(read), "token long, set long").repartition("token").sortWithinPartitions("token", "set")
    return stage(blocks.mapInArrow(lambda batches: with_groups(shared(batches)), "token long, set long, whole long"))


def _block_rows(rows: DataFrame, width: int) -> DataFrame:
    """(set, block, tokens): the sets of the given rows, cut into column blocks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            found = Incidence(batch.column("text"), width)
            sets, block = found.signatures(), found.tokens.view(U) % U(COLUMN_BLOCKS)
            for b in range(COLUMN_BLOCKS):
                mine = block == U(b)
                sizes = np.bincount(found.owner[mine], minlength=batch.num_rows)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(found.tokens[mine]))
                yield _columns(["set", "block", "tokens"], [sets, np.full(batch.num_rows, b, np.int32), lists])

    return rows.mapInArrow(lean(read), "set long, block int, tokens array<long>")


def _may_link(x: str, y: str, least: int) -> Column:
    """The bound from the sizes."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    return F.least(nx, ny) * 100 >= F.greatest(nx, ny) * least


def _near(x: str, y: str, least: int, bits: list[str]) -> Column:
    """The parity sketches allow the overlap: tokens that differ are at least the bits that differ."""
    apart = reduce(add, [F.bit_count(F.col(f"{x}.{k}").bitwiseXOR(F.col(f"{y}.{k}"))) for k in bits])
    total = F.col(f"{x}.n") + F.col(f"{y}.n")
    return apart * (100 + least) <= total * (100 - least)


def _near_wide(x: str, y: str, least: int) -> Column:
    """The same bound from the wide sketches; true where one is NULL. The longer of two is folded to the other's bits."""

    def to(v: str, other: str) -> Column:
        half = (F.size(v) / 2).cast("int")
        folded = F.zip_with(F.slice(v, F.lit(1), half), F.slice(v, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(v) == 2 * F.size(other), folded).otherwise(F.col(v))

    each = F.zip_with(to(x, y), to(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    apart = F.aggregate(each, F.lit(0), lambda total, n: total + n)
    return F.coalesce(apart * (100 + least) <= F.col("total") * (100 - least), F.lit(True))


def _links(pairs: DataFrame, sets: DataFrame, rows: DataFrame, width: int, least: int) -> DataFrame:
    """Of candidate pairs (x, y: rows that are equal in a block), those that reach the threshold, as links (a, b) of their ids.

    The whole sketches discard most of the others, those of pairs of large sets only the wide ones, as more tokens may differ than a sketch has bits;
    the overlaps of the rest are summed up over the column blocks.
    """
    met = pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).filter("a <> b").distinct()
    one = sets.select(F.struct("set", "id", "n", *SKETCHES).alias("x"))
    two = sets.select(F.struct("set", "id", "n", *SKETCHES).alias("y"))
    close = stage(
        met.join(one, F.col("a") == F.col("x.id")).join(two, F.col("b") == F.col("y.id"))
        .filter(_near("x", "y", least, SKETCHES))
        .select("a", "b", F.col("x.set").alias("low"), F.col("y.set").alias("high"), (F.col("x.n") + F.col("y.n")).alias("total"))
    )
    wide = sets.filter("wide IS NOT NULL")
    wide_x, wide_y = (wide.select(F.col("id").alias(f"of_{v}"), F.col("wide").alias(f"wide_{v}")) for v in "xy")
    met = close.join(wide_x, F.col("a") == F.col("of_x"), "left").join(wide_y, F.col("b") == F.col("of_y"), "left")
    close = stage(met.filter(_near_wide("wide_x", "wide_y", least)).select(*close.columns))
    if close.isEmpty():
        return close.select("a", "b")
    wanted = stage(close.select(F.col("a").alias("of")).union(close.select("b")).distinct())
    # Ids of eight bytes; beyond the limit they meet the texts by a shuffle.
    few = 8 * wanted.count() <= BROADCAST_BYTES
    blocks = stage(_block_rows(rows.join(F.broadcast(wanted) if few else wanted, F.col("id") == F.col("of"), "left_semi"), width))
    row = blocks.select(F.col("set").alias("of_x"), "block", F.col("tokens").alias("tokens_x"))
    column = blocks.select(F.col("set").alias("of_y"), F.col("block").alias("block_y"), F.col("tokens").alias("tokens_y"))
    product = close.join(row, F.col("low") == F.col("of_x")).join(column, (F.col("high") == F.col("of_y")) & (F.col("block") == F.col("block_y")))
    # Repeated rows give a block more than once, with the same count.
    each = product.groupBy("a", "b", "total", "block").agg(F.max(F.size(F.array_intersect("tokens_x", "tokens_y"))).alias("n"))
    overlap = each.groupBy("a", "b", "total").agg(F.sum("n").alias("n"))
    return stage(overlap.filter(F.col("n") * (100 + least) >= F.col("total") * least).select("a", "b"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, least: int = LEAST
) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id reachable by links, for every row.

    A row's set holds its distinct runs of ``width`` words, A-Z lowered; with fewer words the whole text is one run, and without words
    the set is empty and linked with nothing. Two rows link when 100 * overlap >= least * union. NULL text is
    empty; a row with NULL id has no links and component_id NULL; rows with one id are one document. Sets are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    ident = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(ident.alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    every = _survey(rows, width)
    sets = stage(
        every.filter("n > 0 AND id IS NOT NULL").groupBy("set").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n", *SKETCHES, "wide")])
    )
    named = rows.filter("id IS NOT NULL")
    hits = _meetings(named, width, least)
    # Of blocks in which the same sets meet, one is enough.
    one_each = hits.filter("whole IS NOT NULL").groupBy("set", "whole").agg(F.min("token").alias("of"))
    full = stage(hits.filter("whole IS NULL").join(one_each.select("of"), F.col("token") == F.col("of"), "left_semi").select("token", "set"))
    # The texts that meet others in most blocks are the likeliest centres: what was edited in a copy is equal nowhere.
    known = sets.select("set", "id", "n").join(full.groupBy(F.col("set").alias("of")).agg(F.count(F.lit(1)).cast("int").alias("met")), F.col("set") == F.col("of")).drop("of")
    full = stage(full.join(known, "set").select("token", F.struct((-F.col("met")).alias("rank"), "id", F.col("n").cast("int").alias("n")).alias("x")))

    links = spark.createDataFrame([], "a long, b long")
    labels = None
    for turn in range(ROUNDS + 1):
        known = full.withColumn("component", F.col("x.id"))
        if labels is not None:
            known = full.join(labels, F.col("x.id") == F.col("node"), "left").select("token", "x", F.coalesce("component", "x.id").alias("component"))
        # Blocks whose rows are all in one component are settled. Elsewhere the rows outside the centre's component meet a centre of their own.
        open_ = known.groupBy(F.col("token").alias("of")).agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.min(F.struct("x.rank", "x.id", "component")).alias("centre")
        ).filter("low <> high")
        rest = stage(known.join(open_, F.col("token") == F.col("of")).select("token", "x", "component", (F.col("component") != F.col("centre.component")).alias("outside")))
        if turn == ROUNDS:
            break
        centres = (rest.filter("outside") if turn else rest).groupBy(F.col("token").alias("of")).agg(
            F.min(F.struct("x.rank", "x.id", F.col("x").alias("y"), F.col("component").alias("y_component"))).alias("c")
        )
        pairs = (
            rest.join(centres, F.col("token") == F.col("of"))
            .select("x", "component", F.col("c.y").alias("y"), F.col("c.y_component").alias("y_component"))
            .filter((F.col("component") != F.col("y_component")) & _may_link("x", "y", least))
        )
        found = _links(pairs, sets, named, width, least)
        if found.isEmpty():
            break
        links = stage(links.union(found))
        labels = components(links)

    # What the centres left open: rows outside the centre's component against all rows of other components. Sketches come in only here and
    # in _links, so that the many rows of the blocks are shuffled without them.
    row = sets.select(F.col("id").alias("row"), F.struct("id", "n", *SKETCHES).alias("x"))
    rest = rest.select("token", "component", "outside", F.col("x.id").alias("of")).join(row, F.col("of") == F.col("row"))
    one = rest.filter("outside").select("token", "x", "component")
    other = rest.select(F.col("token").alias("of"), F.col("x").alias("y"), F.col("component").alias("y_component"))
    possible = (F.col("component") != F.col("y_component")) & _may_link("x", "y", least) & _near("x", "y", least, SKETCHES)
    found = _links(one.join(other, (F.col("token") == F.col("of")) & possible), sets, named, width, least)
    if not found.isEmpty():
        labels = components(links.union(found))
    if not links.isEmpty() or not found.isEmpty():
        linked = sets.select("set", "id").join(labels, F.col("id") == F.col("node")).select(F.col("set").alias("of"), "component")
    else:
        linked = sets.select(F.col("set").alias("of"), F.col("id").alias("component")).limit(0)
    own = sets.select(F.col("set").alias("mine"), F.col("id").alias("smallest"))
    return (
        every.join(own, (F.col("set") == F.col("mine")) & F.col("id").isNotNull(), "left")
        .join(linked, F.col("set") == F.col("of"), "left")
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "smallest", "id")).alias("component_id"),
        )
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row with the smallest id of every component of texts, unchanged; rows without words or without an id all stay.

    Texts are linked, not ids: of two texts under one id only the one that is a near copy of a kept row goes. Copies of a kept row, with its id
    and its text, stay. Texts are told apart by 64-bit hashes.
    """
    ident, key = F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    rows = docs.filter(ident.isNotNull()).select(key.alias("key"), ident.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = near_duplicates(rows, "key", "text", **options).filter("n_shingles > 0").select(F.col("doc_id").alias("of"), "component_id").distinct()
    members = stage(rows.select("key", "id").distinct().join(found, F.col("key") == F.col("of")).select("key", "id", "component_id"))
    kept = members.groupBy(F.col("component_id").alias("of")).agg(F.min(F.struct("id", "key")).alias("kept"))
    gone = members.join(kept, F.col("component_id") == F.col("of")).filter(F.struct("id", "key") != F.col("kept")).select(F.col("id").alias("__gone"), F.col("key").alias("__text"))
    return docs.join(gone, (ident == F.col("__gone")) & (key == F.col("__text")), "left_anti")
