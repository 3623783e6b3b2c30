"""Sampled SentencePiece segmentations without replacement, and decoding.

The lattice of a text has a node at every character and an edge for every piece of the vocabulary. It falls into units, each a
run of spaces and the word after it, as no piece of the model goes on from a word into a space. A piece of rank r
weighs 1 / (1 + r) to the power ``alpha``; a segmentation's probability is the product of its weights over the sum of all.
Gumbel top-k draws distinct segmentations: a set of segmentations is perturbed as one, with the logarithm of its mass as
location, and the largest set is searched first. Opening a set walks down its lattice to the one segmentation that keeps the
set's value and leaves, at every node on the way, the set of segmentations that turn off there, whose values are drawn below it.
All walks of a batch go side by side.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trendloom.llm.tables import whole_row
from trendloom.llm.wordhash import U, lean, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIT = re.compile(" +[^ ]*")
SEED = 20240611
SAMPLES = 2
ALPHA = 1.0
#: Characters of text that are walked together; a longer text goes alone.
BATCH_CHARS = 1 << 18
#: Edges up to which the lattices of units are kept for the batches that follow; beyond, they are built anew.
KEPT_EDGES = 1 << 19
#: Places of a path that are looked at first for the sets that turn off it.
REACH = 2048
#: -log(-log(u)) of the largest uniform draw, rounded up.
MOST_NOISE = 37.0


class Vocabulary:
    """What a model file says: a trie of its pieces with their weights, the byte pieces, and the bytes of each token."""

    def __init__(self, path: str = MODEL, alpha: float = ALPHA) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes, self.surface = np.zeros(256, np.int32), []
        steps: dict[tuple[int, int], int] = {}
        token, weight = [-1], [0.0]
        self.longest = 1
        #: Whether a piece goes on from a word into a space: then a text is one unit.
        self.crossing = False
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
                continue
            plain = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            self.surface.append(piece.replace(SPACE, " ").encode() if plain else b"")
            if plain:
                self.crossing = self.crossing or SPACE in piece.lstrip(SPACE)
                state = 0
                for c in piece:
                    at = (state, ord(c))
                    if at not in steps:
                        steps[at] = len(token)
                        token.append(-1)
                        weight.append(0.0)
                    state = steps[at]
                token[state], weight[state] = i, -alpha * math.log1p(-model.get_score(i))
                self.longest = max(self.longest, len(piece))
        self._lay(np.array([s * CODES + c for s, c in steps], np.int64), np.array(list(steps.values()), np.int64))
        self.token, self.weight = np.array(token, np.int32), np.array(weight)

    def units(self, text: str) -> list[str]:
        """The text, with the space that stands before it, cut where no piece goes across."""
        if not text:
            return []
        return [" " + text] if self.crossing else UNIT.findall(" " + text)

    def _lay(self, keys: np.ndarray, states: np.ndarray) -> None:
        """Lay the steps of the trie out in an open table that is at most an eighth full: a key stands at its hash or in the next free place."""
        self.shift = U(64 - max(8, int(8 * len(keys) - 1).bit_length()))
        self.keys = np.full(1 << (64 - int(self.shift)), -1, np.int64)
        self.next = np.full(len(self.keys), -1, np.int64)
        for key, state, at in zip(keys.tolist(), states.tolist(), self._home(keys).tolist()):
            while self.keys[at] >= 0:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.next[at] = key, state

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(U) * U(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next state of each, or -1."""
        key = state * CODES + code
        at = self._home(key)
        found, out = self.keys[at], self.next[at]
        missed = found != key
        out[missed] = -1
        rest = np.flatnonzero(missed & (found >= 0))
        at, key = at[rest], key[rest]
        while len(rest):
            at = (at + 1) % len(self.keys)
            found = self.keys[at]
            hit = found == key
            out[rest[hit]] = self.next[at[hit]]
            on = ~hit & (found >= 0)
            rest, at, key = rest[on], at[on], key[on]
        return out


#: More than there are characters; from the first such code on, a code stands for a byte.
CODES = 0x110200
FIRST_BYTE = 0x110000


class Lattices:
    """The lattices of distinct units, each a run of spaces and a word, in flat arrays.

    The edges of a node stand together; ``top`` sums their conditional probabilities up.
    """

    def __init__(self, vocabulary: Vocabulary, words: list[str]) -> None:
        given = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        codes = np.where(given == ord(" "), ord(SPACE), given)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(sizes) - sizes
        distinct = np.flatnonzero(np.bincount(codes, minlength=1))
        alone = vocabulary.step(np.zeros(len(distinct), np.int64), distinct)
        has_piece = np.zeros(CODES, bool)
        has_piece[distinct] = (alone >= 0) & (vocabulary.token[alone] >= 0)
        # A space mark that stands in the text itself is not a space.
        known = has_piece[codes] & (given != ord(SPACE))
        if not known.all():
            strange = np.flatnonzero(~known)
            raw = [chr(c).encode() for c in given[strange].tolist()]
            width = np.ones(len(codes), np.int64)
            width[strange] = [len(x) for x in raw]
            codes, known = np.repeat(codes, width), np.repeat(known, width)
            codes[~known] = FIRST_BYTE + np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
            sizes = np.add.reduceat(width, begin)
            begin = np.cumsum(sizes) - sizes
        # Nodes are numbered by their distance from the end of the unit, so that masses go level by level.
        n = len(codes)
        left = np.repeat(begin + sizes, sizes) - np.arange(n)
        narrow = left.astype(np.uint16) if left.max() < 1 << 16 else left
        order = np.argsort(narrow, kind="stable")
        number = np.empty(n + 1, np.int64)
        number[order], number[n] = np.arange(n), n
        levels = np.cumsum(np.bincount(left)).tolist()
        self.start = number[begin]

        strange = np.flatnonzero(~known)
        count = (~known).astype(np.int64)
        found = [(strange, strange + 1, vocabulary.bytes[codes[strange] - FIRST_BYTE], np.zeros(len(strange)), np.zeros(len(strange), np.int64))]
        node = np.flatnonzero(known)
        state, place = np.zeros(len(node), np.int64), node
        while len(node):
            state = vocabulary.step(state, codes[place])
            on = np.flatnonzero(state >= 0)
            node, place, state = node[on], place[on] + 1, state[on]
            token = vocabulary.token[state]
            hit = np.flatnonzero(token >= 0)
            own = node[hit]
            found.append((own, place[hit], token[hit], vocabulary.weight[state[hit]], count[own]))
            count[own] += 1
            on = np.flatnonzero(place - node < left[node])
            node, place, state = node[on], place[on], state[on]

        # The edges of a node stand together, the longest piece first.
        self.first = np.concatenate([[0], np.cumsum(count[order])])
        total = int(self.first[-1])
        self.token, self.to, self.logp = np.empty(total, np.int32), np.empty(total, np.int64), np.empty(total)
        for own, target, token, weight, index in found:
            at = self.first[number[own]] + count[own] - 1 - index
            self.token[at], self.logp[at] = token, weight
            self.to[at] = np.where(target - own < left[own], number[target], n)

        below, self.top = np.zeros(n + 1), np.empty(total)
        for low, high in zip(levels, levels[1:]):
            span = slice(self.first[low], self.first[high])
            first, size = self.first[low:high] - span.start, np.diff(self.first[low : high + 1])
            value = self.logp[span] + below[self.to[span]]
            peak = np.maximum.reduceat(value, first)
            share = np.exp(value - np.repeat(peak, size))
            mass = np.add.reduceat(share, first)
            below[low:high] = peak + np.log(mass)
            self.logp[span] = value - np.repeat(below[low:high], size)
            share /= np.repeat(mass, size)
            reached = np.cumsum(share)
            self.top[span] = reached - np.repeat(reached[first] - share[first], size)
        self.top[self.first[1:] - 1] = 2.0
        self.to[self.to == n] = -1

    def extend(self, other: Lattices) -> None:
        """Take in the lattices of further units, numbered after the own ones."""
        nodes, edges = len(self.first) - 1, len(self.token)
        self.start = np.concatenate([self.start, other.start + nodes])
        self.to = np.concatenate([self.to, np.where(other.to < 0, -1, other.to + nodes)])
        self.first = np.concatenate([self.first[:-1], other.first + edges])
        for name in ("token", "logp", "top"):
            setattr(self, name, np.concatenate([getattr(self, name), getattr(other, name)]))

    def choose(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node at a uniform draw."""
        edge = self.first[node]
        late = np.flatnonzero(self.top[edge] <= u)
        while len(late):
            edge[late] += 1
            late = late[self.top[edge[late]] <= u[late]]
        return edge

    def walk(self, node: np.ndarray, draw) -> tuple[np.ndarray, np.ndarray]:
        """From each node to the end of its unit: the edges taken, unit by unit, and their number in each unit."""
        where, steps, size, step = np.arange(len(node)), [], np.zeros(len(node), np.int64), 0
        while len(where):
            edge = self.choose(node, draw(where, step))
            steps.append((where, edge))
            size[where] += 1
            node = self.to[edge]
            on = np.flatnonzero(node >= 0)
            where, node, step = where[on], node[on], step + 1
        out, begin = np.empty(int(size.sum()), np.int64), np.cumsum(size) - size
        for i, (at, edge) in enumerate(steps):
            out[begin[at] + i] = edge
        return out, size


class Pool:
    """The lattices of the units met so far, each built once as long as all of them stay within ``KEPT_EDGES``."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.known, self.lattices = vocabulary, {}, None

    def find(self, words: list[str]) -> tuple[Lattices, np.ndarray]:
        """Lattices that hold the given units, and the first node of each."""
        distinct = dict.fromkeys(words)
        new = [w for w in distinct if w not in self.known]
        if self.lattices is None or (new and len(self.lattices.token) > KEPT_EDGES):
            self.known, self.lattices, new = {}, None, list(distinct)
            self.lattices = Lattices(self.vocabulary, new or [" "])
            self.known.update(zip(new, self.lattices.start.tolist()))
        elif new:
            added = Lattices(self.vocabulary, new)
            self.known.update(zip(new, (added.start + len(self.lattices.first) - 1).tolist()))
            self.lattices.extend(added)
        return self.lattices, np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


def _key(key: np.ndarray, number: np.ndarray) -> np.ndarray:
    return mix(key.view(U) ^ (number.astype(U) * U(0x9E3779B97F4A7C15)) + U(1))


def _unit(key: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((key >> U(12)).astype(float) + 0.5) * 2.0**-52


def _below(location: np.ndarray, limit: float | np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values at a location, given that they are below a limit."""
    with np.errstate(over="ignore", divide="ignore"):
        return location - np.log(np.exp(np.minimum(location - limit, 700)) - np.log(u))


class Path:
    """A drawn segmentation: edges and their units, its logarithmic probability and its perturbed value."""

    __slots__ = ("edges", "unit", "logp", "value")

    def __init__(self, edges, unit, logp, value) -> None:
        self.edges, self.unit, self.logp, self.value = edges, unit, logp, value


def _turns(lattices: Lattices, paths: list[Path], begin: list[int], barred: list[tuple], seeds: np.ndarray, number: int, keep: int, reach: int = REACH) -> list[list[tuple]]:
    """For each path the best ``keep`` sets that turn off it at or after place ``begin``: (-value, number, place, barred edges).

    The first ``reach`` places after ``begin`` are looked at for all paths at once, and more only where a later place may be among the best.
    Sums run along each path alone, so the other paths of a batch change nothing.
    """
    out = [[] for _ in paths]
    live = [i for i, path in enumerate(paths) if len(path.edges)]
    if not live or keep < 1:
        return out
    spans = [paths[i].edges[: begin[i] + reach] for i in live]
    lengths = np.fromiter(map(len, spans), np.int64, len(live))
    logp = lattices.logp[np.concatenate(spans)]
    reached, at = np.empty_like(logp), 0
    for n in lengths.tolist():
        np.cumsum(logp[at : at + n], out=reached[at : at + n])
        at += n
    first = np.fromiter((begin[i] for i in live), np.int64, len(live))
    place = np.arange(len(logp)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    if first.any():
        on = place >= np.repeat(first, lengths)
        logp, reached, place = logp[on], reached[on], place[on]
    sizes = lengths - first
    starts, path_of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(live)), sizes)
    left = -np.expm1(logp)
    for n, i in enumerate(live):
        if barred[i]:
            left[starts[n]] -= np.exp(lattices.logp[list(barred[i])]).sum()
    with np.errstate(divide="ignore"):
        location = np.where(left > 1e-12, reached - logp + np.log(np.maximum(left, 1e-300)), -np.inf)
    keys = _key(_key(seeds[live].view(np.int64), np.full(len(live), -2)), np.full(len(live), number))
    limit = np.fromiter((paths[i].value for i in live), float, len(live))
    values = _below(location, limit[path_of], _unit(_key(keys[path_of], place)))
    last = np.full(len(live), -np.inf)
    for _ in range(keep):
        last = np.maximum.reduceat(values, starts)
        hit = np.flatnonzero((values == last[path_of]) & (values > -np.inf))
        hit = hit[np.diff(path_of[hit], prepend=-1) > 0]
        for n, at, value in zip(path_of[hit].tolist(), place[hit].tolist(), values[hit].tolist()):
            i = live[n]
            out[i].append((-value, number, at, (*(barred[i] if at == begin[i] else ()), int(paths[i].edges[at]))))
        values[hit] = -np.inf
    # No draw lies more than MOST_NOISE above its location, and locations only fall along the path.
    more = [i for n, i in enumerate(live) if lengths[n] < len(paths[i].edges) and reached[starts[n] + sizes[n] - 1] + MOST_NOISE >= last[n]]
    if more:
        later = _turns(lattices, [paths[i] for i in more], [begin[i] for i in more], [barred[i] for i in more], seeds[more], number, keep, 16 * reach)
        for i, turns in zip(more, later):
            out[i] = turns
    return out


def sample(pool: Pool, texts: list[str], seeds: np.ndarray, k: int) -> tuple[Lattices, list[tuple[list[Path], float]]]:
    """For every text up to ``k`` distinct segmentations, best first, and the value of the next one (-inf: there is none)."""
    words = [pool.vocabulary.units(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    every = [w for ws in words for w in ws]
    lattices, starts = pool.find(every)
    first = np.concatenate([[0], np.cumsum(sizes)])
    text_of = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(text_of)) - first[text_of]

    def walk(units: np.ndarray, nodes: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        keys = _key(_key(seeds, np.full(len(seeds), number))[text_of[units]], place[units])
        return lattices.walk(nodes, lambda where, step: _unit(_key(keys[where], np.array([step]))))

    edges, size = walk(np.arange(len(text_of)), starts, 0)
    ends = np.concatenate([[0], np.cumsum(size)])
    units = np.repeat(place, size)
    paths = []
    roots = -np.log(-np.log(_unit(_key(seeds, np.full(len(seeds), -1)))))
    for i in range(len(texts)):
        span = slice(ends[first[i]], ends[first[i + 1]])
        path = Path(edges[span], units[span], float(lattices.logp[edges[span]].sum()), float(roots[i]))
        paths.append([path])
    heaps = [sorted(turns) for turns in _turns(lattices, [p for p, in paths], [0] * len(texts), [()] * len(texts), seeds, 0, k)]
    for number in range(1, k):
        chosen, draws = [], _unit(_key(_key(seeds.view(np.int64), np.full(len(seeds), -3)), np.full(len(seeds), number)))
        for i, heap in enumerate(heaps):
            if len(paths[i]) < number or not heap:
                continue
            value, parent, at, barred = heapq.heappop(heap)
            old = paths[i][parent]
            node = int(np.searchsorted(lattices.first, old.edges[at], side="right")) - 1
            options = np.array([e for e in range(lattices.first[node], lattices.first[node + 1]) if e not in barred])
            shares = np.cumsum(np.exp(lattices.logp[options]))
            pick = min(int(np.searchsorted(shares, shares[-1] * draws[i], side="right")), len(options) - 1)
            chosen.append((i, -value, old, at, barred, int(options[pick])))
        if not chosen:
            break
        later = [np.arange(first[i] + old.unit[at] + 1, first[i + 1]) for i, _, old, at, _, _ in chosen]
        inner = np.array([first[i] + old.unit[at] for i, _, old, at, _, _ in chosen])
        nodes = [lattices.to[e] for *_, e in chosen]
        open_ = np.array([n >= 0 for n in nodes])
        units = np.concatenate([inner[open_], *later]).astype(np.int64)
        begin = np.concatenate([np.array(nodes, np.int64)[open_], *[starts[x] for x in later]])
        edges, size = walk(units, begin, number)
        ends = np.concatenate([[0], np.cumsum(size)])
        at_inner, at_later, fresh = 0, int(open_.sum()), []
        for n, (i, value, old, at, barred, edge) in enumerate(chosen):
            rest, rest_units = [np.array([edge])], [old.unit[at : at + 1]]
            if open_[n]:
                span = slice(ends[at_inner], ends[at_inner + 1])
                rest.append(edges[span])
                rest_units.append(np.repeat(old.unit[at], size[at_inner]))
                at_inner += 1
            span = slice(at_later, at_later + len(later[n]))
            rest.append(edges[ends[span.start] : ends[span.stop]])
            rest_units.append(np.repeat(place[later[n]], size[span]))
            at_later = span.stop
            taken = np.concatenate([old.edges[:at], *rest])
            path = Path(taken, np.concatenate([old.unit[:at], *rest_units]), float(lattices.logp[taken].sum()), value)
            paths[i].append(path)
            fresh.append(path)
        own = [c[0] for c in chosen]
        for i, turns in zip(own, _turns(lattices, fresh, [c[3] for c in chosen], [c[4] for c in chosen], seeds[own], number, k - number)):
            for turn in turns:
                heapq.heappush(heaps[i], turn)
    return lattices, [(p, -h[0][0] if h else -math.inf) for p, h in zip(paths, heaps)]


def inclusion(logp: float, threshold: float) -> float:
    """The probability that a segmentation is above the threshold: its inclusion score; 1 where all were drawn."""
    if threshold == -math.inf:
        return 1.0
    return -math.expm1(-math.exp(min(logp - threshold, 700.0)))


SAMPLE_TYPE = T.ArrayType(T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("tokens", T.ArrayType(T.IntegerType())),
    T.StructField("log_prob", T.DoubleType()),
    T.StructField("perturbed", T.DoubleType()),
    T.StructField("inclusion", T.DoubleType()),
]))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES, model: str = MODEL, alpha: float = ALPHA, seed: int = SEED, keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (all columns, or those of ``keep``) and ``samples``: up to ``k`` distinct segmentations of the whole text, from the most perturbed down.

    Each has rank from 1, tokens, log_prob, perturbed and inclusion. Draws depend on the id, the seed and the text alone, so rows with the same
    id and text agree, and reruns do. NULL counts as empty; an empty text has one empty segmentation. Characters without a piece
    become byte pieces; every segmentation decodes to the text. Memory is bounded by the longest text.
    """
    vocabulary = Vocabulary(model, alpha)
    ident = F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.lit(seed))
    row = whole_row(docs) if keep is None else F.struct(*[F.col(f"`{c}`") for c in keep])
    rows = docs.select(row.alias("row"), ident.alias("seed"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("samples", SAMPLE_TYPE)])
    item = pa.struct([("rank", pa.int32()), ("tokens", pa.list_(pa.int32())), ("log_prob", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = Pool(vocabulary)
        for batch in batches:
            sizes = np.cumsum(pc.utf8_length(batch.column("text")).to_numpy()).astype(np.int64)
            begin = 0
            while begin < batch.num_rows:
                done = sizes[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(sizes, done + BATCH_CHARS)))
                part = batch.slice(begin, end - begin)
                begin = end
                lattices, found = sample(pool, part.column("text").to_pylist(), part.column("seed").to_numpy(), k)
                paths = [p for own, _ in found for p in own]
                tokens = lattices.token[np.concatenate([p.edges for p in paths])]
                lengths = np.concatenate([[0], np.cumsum([len(p.edges) for p in paths])]).astype(np.int32)
                values = pa.StructArray.from_arrays(
                    [
                        pa.array([i + 1 for own, _ in found for i in range(len(own))], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(lengths), pa.array(tokens)),
                        pa.array([p.logp for p in paths]),
                        pa.array([p.value for p in paths]),
                        pa.array([inclusion(p.logp, limit) for own, limit in found for p in own]),
                    ],
                    fields=list(item),
                )
                each = np.concatenate([[0], np.cumsum([len(own) for own, _ in found])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.ListArray.from_arrays(pa.array(each), values)], names=schema.names)

    return rows.mapInArrow(lean(read), schema)


def decode(rows: DataFrame, tokens: Column, model: str = MODEL, keep: Sequence[str] | None = None) -> DataFrame:
    """The rows (all columns, or those of ``keep``) with ``decoded``: the text that the tokens stand for. NULL tokens give NULL, none give an empty text."""
    vocabulary = Vocabulary(model)
    row = whole_row(rows) if keep is None else F.struct(*[F.col(f"`{c}`") for c in keep])
    given = rows.select(row.alias("row"), tokens.alias("tokens"))
    schema = T.StructType([given.schema["row"], T.StructField("decoded", T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surface = pa.array(vocabulary.surface, pa.large_binary())
        for batch in batches:
            lists = batch.column("tokens")
            parts = surface.take(lists.flatten())
            # Where the bytes of each list begin and end; the bytes of all lists stand in one buffer.
            counts = pc.fill_null(lists.value_lengths(), 0).to_numpy().astype(np.int64)
            ends = np.frombuffer(parts.buffers()[1], np.int64, len(parts) + 1)[np.concatenate([[0], np.cumsum(counts)])]
            # The first byte is the space before the text.
            begin = np.minimum(ends[:-1] + 1, ends[1:])
            data = memoryview(parts.buffers()[2]) if len(parts) else memoryview(b"")
            valid = lists.is_valid().to_pylist()
            out = [str(data[x:y], "utf-8", "replace") if v else None for x, y, v in zip(begin.tolist(), ends[1:].tolist(), valid)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=schema.names)

    return given.mapInArrow(lean(read), schema).select("row.*", "decoded")
