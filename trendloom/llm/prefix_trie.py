"""Z-fast tries of conversations: every distinct beginning is a node, with its members, children and sums over its subtree.

A turn is known by a digest, a beginning by the chained hash of its turns (128 bits), so equal beginnings have equal keys in every task.
Tasks insert their conversations in batches into a z-fast trie: compacted nodes stand in a hash table under their handles, the key of
the beginning whose length is the two-fattest number of the node's edge, and a fat binary search over these finds the node where a
conversation leaves the trie in a number of look-ups that grows with the logarithm of its turns. A full batch is expanded, edge by
edge, into one row per beginning, and Spark sums the rows of all batches by key. So a first turn that a third of all
conversations share costs one row a batch.

Sums over subtrees take a second pass over the conversations: what a node weighs is given to its smallest member, and a beginning's subtree
is what its members were given, less what the smallest of them was given above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trendloom.llm.wordhash import lean
from trendloom.session import stage

KEY = 16
ROOT = bytes(KEY)
#: Nodes that a batch may hold, counted as expanded; a longer conversation is a batch of its own.
BATCH_NODES = 1 << 18
#: Parts into which the rows that ask for one parent are dealt out.
PARTS = 1 << 12
#: Characters of a packed list of ids.
CHUNK = 1 << 20

ROWS = "key binary, parent binary, depth long, bytes long, n long, conv_id long, leaves long, saved long"


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the largest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """A compacted trie of sequences of chained keys; ``keys[d - 1]`` stands for the first ``d`` turns.

    Node ``i`` ends after ``end[i]`` turns of the sequence ``path[i]`` and hangs below ``above[i]``; its edge begins behind the end of that.
    """

    def __init__(self) -> None:
        self.end, self.path, self.sizes, self.above = [0], [[]], [[]], [-1]
        self.sums: list[list[int]] = [[0, None, 0, 0]]
        self.handles: dict[bytes, int] = {}
        self.firsts: dict[bytes, int] = {}
        self.expanded = 1

    def _enter(self, node: int) -> None:
        """Put a node in the table under its handle, and under the first turn of its edge."""
        low, keys = self.end[self.above[node]], self.path[node]
        self.handles[keys[two_fattest(low, self.end[node]) - 1]] = node
        self.firsts[keys[low]] = node

    def _new(self, above: int, end: int, keys: list[bytes], sizes: list[int]) -> int:
        self.end.append(end)
        self.path.append(keys)
        self.sizes.append(sizes)
        self.above.append(above)
        self.sums.append([0, None, 0, 0])
        return len(self.end) - 1

    def exit_node(self, keys: list[bytes]) -> tuple[int, int]:
        """The deepest node that is a beginning of the sequence, and the node below it whose edge the sequence enters (-1: none)."""
        found, low, high = 0, 0, len(keys)
        while low < high:
            at = two_fattest(low, high)
            node = self.handles.get(keys[at - 1])
            if node is None:
                high = at - 1
            elif self.end[node] <= len(keys) and self.path[node][self.end[node] - 1] == keys[self.end[node] - 1]:
                found, low = node, self.end[node]
            else:
                return self.above[node], node
        return found, self.firsts.get(keys[low], -1) if low < len(keys) else -1

    def insert(self, keys: list[bytes], sizes: list[int], conv: int, leaves: int, saved: int) -> None:
        node, below = self.exit_node(keys)
        if below >= 0:
            # The beginnings agree up to a depth and differ from there on.
            low, high = self.end[node] + 1, min(len(keys), self.end[below] - 1)
            while low < high:
                middle = (low + high + 1) // 2
                low, high = (middle, high) if self.path[below][middle - 1] == keys[middle - 1] else (low, middle - 1)
            old = two_fattest(self.end[node], self.end[below])
            del self.handles[self.path[below][old - 1]]
            split = self._new(node, low, self.path[below], self.sizes[below])
            self.above[below] = split
            self._enter(split)
            self._enter(below)
            node = split
        if self.end[node] < len(keys):
            self.expanded += len(keys) - self.end[node]
            node = self._new(node, len(keys), keys, sizes)
            self._enter(node)
        self._add(node, 1, conv, leaves, saved)

    def _add(self, node: int, n: int, conv: int | None, leaves: int, saved: int) -> None:
        to = self.sums[node]
        to[0] += n
        if conv is not None and (to[1] is None or conv < to[1]):
            to[1] = conv
        to[2] += leaves
        to[3] += saved

    def expand(self) -> pa.RecordBatch:
        """One row per beginning: every edge cut into its turns, all with the sums of the subtree below."""
        # A split stands behind the node below it, so depth gives the order.
        for node in sorted(range(1, len(self.end)), key=self.end.__getitem__, reverse=True):
            self._add(self.above[node], *self.sums[node])
        keys, parents, depths, sizes, owners = [ROOT], [None], [0], [0], [0]
        for node in range(1, len(self.end)):
            low, high, path = self.end[self.above[node]], self.end[node], self.path[node]
            keys += path[low:high]
            parents += [path[low - 1] if low else ROOT, *path[low : high - 1]]
            depths += range(low + 1, high + 1)
            sizes += self.sizes[node][low:high]
            owners += [node] * (high - low)
        sums = [[self.sums[o][i] for o in owners] for i in range(4)]
        names = ["key", "parent", "depth", "bytes", "n", "conv_id", "leaves", "saved"]
        kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 6]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip([keys, parents, depths, sizes, *sums], kinds)], names=names)


def _cut(packed: bytes) -> list[bytes]:
    return [packed[i : i + KEY] for i in range(0, len(packed), KEY)]


def _expanded(paths: DataFrame) -> DataFrame:
    """Rows of ``ROWS`` from (conv_id, keys, sizes, leaves, saved): the tries of all batches, expanded."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = None
        for batch in batches:
            for conv, keys, sizes, leaves, saved in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "keys", "sizes", "leaves", "saved"))):
                trie = trie or ZFastTrie()
                trie.insert(_cut(keys), sizes, conv, leaves, saved)
                if trie.expanded >= BATCH_NODES:
                    yield trie.expand()
                    trie = None
        if trie:
            yield trie.expand()

    return paths.mapInArrow(lean(read), ROWS)


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits for a turn; NULL counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, KEY)


def paths_of(groups: DataFrame, rebuild: Callable[[list], Iterator[tuple[int, list]]]) -> DataFrame:
    """conv_id, keys (chained, packed) and sizes of the conversations that ``rebuild`` makes of each group of turns."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, sizes = [], [], []
            for group in batch.column("turns").to_pylist():
                for conv, turns in rebuild(group):
                    chain = [ROOT]
                    for turn in turns:
                        chain.append(hashlib.blake2b(chain[-1] + turn["digest"], digest_size=KEY).digest())
                    ids.append(conv)
                    keys.append(b"".join(chain[1:]))
                    sizes.append([turn["bytes"] for turn in turns])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.list_(pa.int64()))], names=["conv_id", "keys", "sizes"]
            )

    return groups.mapInArrow(lean(read), "conv_id long, keys binary, sizes array<long>")


def as_they_are(turns: list[dict]) -> Iterator[tuple[int, list]]:
    """Each conversation of a group with its own turns."""
    by_conv: dict[int, list] = {}
    for turn in turns:
        by_conv.setdefault(turn["conv"], []).append(turn)
    yield from by_conv.items()


def _ends(paths: DataFrame) -> DataFrame:
    """node and ends_sha256: the hash of the ids, ascending, of the conversations that end at a node.

    Ids are sorted over all tasks and packed; only the packed lists of a node, in their order, run through one hash.
    """
    last = F.when(F.length("keys") > 0, F.substring("keys", -KEY, KEY)).otherwise(F.lit(ROOT))
    ends = paths.select(last.alias("node"), "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, None, [], 0
        out: list[tuple] = []
        for batch in batches:
            for key, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if key != node or size >= CHUNK:
                    if held:
                        out.append((node, first, ",".join(held)))
                    node, first, held, size = key, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield _rows(out)
                out = []
        if held:
            yield _rows([(node, first, ",".join(held))])

    def _rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)], names=["node", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield _hashes(done)
        if state:
            yield _hashes([(node, state.hexdigest())])

    def _hashes(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in done], pa.binary()), pa.array([r[1] for r in done], pa.string())], names=["node", "ends_sha256"])

    packed = ends.mapInArrow(pack, "node binary, first long, ids string")
    return packed.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def _summed(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.groupBy("key").agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), *more)


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row per distinct beginning of the conversations of ``paths_of``.

    conv_id (the smallest member), depth, parent_conv_id (root: NULL), n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Without
    conversations there is no root and no row. A conversation without turns is a member of the root alone; equal conversations are
    members of the same nodes. Beginnings are told apart by 128-bit hashes.
    """
    paths = stage(paths)
    zero = F.lit(0).cast("long")
    rows = _expanded(paths.withColumns({"leaves": zero, "saved": zero}))
    found = stage(_summed(rows, F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("bytes").alias("bytes")))
    children = found.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    # The nodes whose smallest member is one conversation are the end of its path; within it, sums from the bottom up are local.
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    whole = Window.partitionBy("conv_id")
    nodes = stage(
        found.join(children, F.col("key") == F.col("of"), "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
        .withColumn("leaf", (F.col("n_children") == 0).cast("long"))
        .withColumn("weight", (F.col("n_convs") - 1) * F.col("bytes"))
        .select(
            "key", "parent", "depth", "conv_id", "n_convs", "n_children",
            F.sum("leaf").over(below).alias("own_leaves"), F.sum("weight").over(below).alias("own_saved"),
            F.sum("leaf").over(whole).alias("all_leaves"), F.sum("weight").over(whole).alias("all_saved"),
            (F.min("depth").over(whole) == F.col("depth")).alias("top"),
        )
    )
    given = nodes.filter("top").select(F.col("conv_id").alias("to"), F.col("all_leaves").alias("leaves"), F.col("all_saved").alias("saved"))
    weighed = paths.join(given, F.col("conv_id") == F.col("to"), "left").select(
        "conv_id", "keys", "sizes", F.coalesce("leaves", zero).alias("leaves"), F.coalesce("saved", zero).alias("saved")
    )
    sums = _expanded(weighed).groupBy(F.col("key").alias("of")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    # Within one path's nodes the parent has the same smallest member. The top ones ask for it: once a part, however many they are.
    part = F.pmod(F.xxhash64("conv_id"), F.lit(PARTS)).alias("part")
    tops = nodes.filter("top AND parent IS NOT NULL").select(F.col("key").alias("child"), F.col("parent").alias("asked"), part)
    answers = (
        tops.select("asked", "part").distinct()
        .join(nodes.select("key", F.col("conv_id").alias("parent_conv_id")), F.col("asked") == F.col("key"))
        .select(F.col("asked").alias("answer"), F.col("part").alias("to_part"), "parent_conv_id")
    )
    above = tops.join(answers, (F.col("asked") == F.col("answer")) & (F.col("part") == F.col("to_part"))).select("child", "parent_conv_id")
    ends = _ends(paths)
    return (
        nodes.join(sums, F.col("key") == F.col("of"))
        .join(above, F.col("key") == F.col("child"), "left")
        .join(ends, F.col("key") == F.col("node"), "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("top"), F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            (F.col("leaves") - F.col("all_leaves") + F.col("own_leaves")).alias("n_leaves"),
            (F.col("saved") - F.col("all_saved") + F.col("own_saved")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def turn_groups(conversations: DataFrame, group: Column | None = None) -> DataFrame:
    """turns: for each group of conversations (each alone, if not given) its turns, by conversation and turn, NULL turns first.

    Only digests and sizes are brought together, no texts. Turns of one number stand in the order of their digests. Rows without a conv_id
    belong to no conversation and take no part; other columns are not read.
    """
    conv = F.col("conv_id").cast("long")
    turn = F.struct(
        conv.alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        turn_digest(F.col("role").cast("string"), F.col("text").cast("string")).alias("digest"),
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("bytes"),
    )
    named = conversations.filter(conv.isNotNull()).select((conv if group is None else group).alias("of"), turn.alias("one"))
    return named.groupBy("of").agg(F.sort_array(F.collect_list("one")).alias("turns")).select("turns")
