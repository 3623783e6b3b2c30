"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled windows. It then
labels every byte of every text: texts are cut into blocks of ``BLOCK`` bytes, both directions start afresh in each
block, and the probabilities at all letter bytes of a text are averaged.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trendloom.llm.tables import whole_row
from trendloom.llm.wordhash import lean

#: A language has to be this many times as likely as if all were equally likely.
ABOVE_EVEN = 1.25
UNKNOWN = "und"
HIDDEN = 8
BLOCK = 128
#: The training sample: windows of so many characters, from about so many documents of each language.
WINDOW = 192
SAMPLE_DOCS = 600
STEPS = 120
RATE = 0.02
TRAIN_BYTES = 48
TRAIN_ROWS = 256
SEED = 20240611
#: Blocks that go through the network together.
ROWS = 1024


def _letters() -> np.ndarray:
    """Bytes that stand in letters: ASCII letters, and all bytes of longer UTF-8 sequences."""
    found = np.zeros(256, bool)
    found[ord("A") : ord("Z") + 1] = found[ord("a") : ord("z") + 1] = found[128:] = True
    return found


LETTER = _letters()


def learnable(doc_id: Column) -> Column:
    """Documents that may be learned from; the others are held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) != 1


def sample_windows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_docs: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """(lang, window) of about ``sample_docs`` learnable documents a language, picked by the hash of the id, in a
    fixed order. A window lies at a hashed place of its text. The counts it needs cover all documents."""
    ident, text, lang = (F.col(f"`{c}`") for c in (id_col, text_col, lang_col))
    known = docs.filter(learnable(ident) & lang.isNotNull() & text.rlike(r"\p{L}")).select(
        ident.cast("long").alias("id"), text.alias("text"), lang.cast("string").alias("lang")
    )
    counts = known.groupBy("lang").count().withColumnRenamed("lang", "of")
    place = F.xxhash64("id", F.lit(SEED))
    at = F.pmod(F.xxhash64("id", F.lit(SEED + 1)), F.greatest(F.lit(1), F.length("text") - WINDOW)) + 1
    chosen = known.join(F.broadcast(counts), F.col("lang") == F.col("of")).filter(
        F.pmod(place, F.lit(1 << 40)) < F.least(F.lit(1.0), F.lit(sample_docs) / F.col("count")) * float(1 << 40)
    )
    rows = chosen.select("lang", F.substring(F.col("text"), at.cast("int"), F.lit(WINDOW)).alias("window"), place.alias("place")).collect()
    return sorted((r.lang, r.window) for r in rows if r.window)


class Network:
    """Two gated recurrent layers over bytes, one in each direction, and a softmax at every byte.

    Gates are linear between 0 and 1 and cut there; states are kept row by row.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> None:
        rng, h, c = np.random.default_rng(seed), hidden, max(1, len(languages))
        self.languages, self.hidden = languages, h
        self.weights = {"out_f": rng.normal(0, 0.1, (h, c)), "out_b": rng.normal(0, 0.1, (h, c)), "bias": np.zeros(c)}
        for way in "fb":
            self.weights |= {
                f"gates_{way}": rng.normal(0.5, 0.1, (256, 2 * h)),
                f"input_{way}": rng.normal(0, 0.5, (256, h)),
                f"gate_state_{way}": rng.normal(0, 0.2 * h**-0.5, (h, 2 * h)),
                f"state_{way}": rng.normal(0, h**-0.5, (h, h)),
                f"inner_{way}": np.zeros(h),
            }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def _steps(self, way: str, x: np.ndarray, inside: np.ndarray | None = None):
        """Position by position: bytes, state before, gates, inner value, candidate, state after; ``x`` is (positions, rows)."""
        w, h = self.weights, self.hidden
        state = np.zeros((x.shape[1], h), np.float32)
        for t in range(len(x)):
            gates = w[f"gates_{way}"].take(x[t], 0)
            gates += state @ w[f"gate_state_{way}"]
            np.clip(gates, 0, 1, out=gates)
            inner = state @ w[f"state_{way}"]
            inner += w[f"inner_{way}"]
            new = gates[:, h:] * inner
            new += w[f"input_{way}"].take(x[t], 0)
            np.tanh(new, out=new)
            after = state - new
            after *= gates[:, :h]
            after += new
            if inside is not None:
                after *= inside[t]
            yield x[t], state, gates, inner, new, after
            state = after

    def _backward(self, way: str, kept: list[tuple], grads: list[np.ndarray], total: dict) -> None:
        w, h = self.weights, self.hidden
        flow = np.zeros_like(grads[0])
        for (at, state, gates, inner, new, _), grad in zip(reversed(kept), reversed(grads)):
            flow = flow + grad
            z, r = gates[:, :h], gates[:, h:]
            dn = flow * (1 - z) * (1 - new * new)
            dg = np.concatenate([flow * (state - new), dn * inner], 1) * ((gates > 0) & (gates < 1))
            di = dn * r
            total[f"gate_state_{way}"] += state.T @ dg
            total[f"state_{way}"] += state.T @ di
            total[f"inner_{way}"] += di.sum(0)
            np.add.at(total[f"gates_{way}"], at, dg)
            np.add.at(total[f"input_{way}"], at, dn)
            flow = flow * z + dg @ w[f"gate_state_{way}"].T + di @ w[f"state_{way}"].T

    def train(self, text: np.ndarray, label: np.ndarray, steps: int = STEPS, rate: float = RATE, seed: int = SEED) -> None:
        """Adam on the log-loss at every letter byte; ``text`` is (windows, bytes)."""
        rng, slope, square = np.random.default_rng(seed), {}, {}
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(text), TRAIN_ROWS)
            x, y = np.ascontiguousarray(text[pick].T), label[pick]
            ahead, back = list(self._steps("f", x)), list(self._steps("b", x[::-1]))
            total = {k: np.zeros_like(v) for k, v in self.weights.items()}
            w, n, grads_f, grads_b = self.weights, len(x), [], []
            used = LETTER[x].astype(np.float32) / max(1, LETTER[x].sum())
            for t in range(n):
                f, b = ahead[t][-1], back[n - 1 - t][-1]
                p = _softmax(f @ w["out_f"] + b @ w["out_b"] + w["bias"])
                p[np.arange(len(y)), y] -= 1
                p *= used[t][:, None]
                total["out_f"] += f.T @ p
                total["out_b"] += b.T @ p
                total["bias"] += p.sum(0)
                grads_f.append(p @ w["out_f"].T)
                grads_b.append(p @ w["out_b"].T)
            self._backward("f", ahead, grads_f, total)
            self._backward("b", back, grads_b[::-1], total)
            for k, g in total.items():
                slope[k] = 0.9 * slope.get(k, 0) + 0.1 * g
                square[k] = 0.99 * square.get(k, 0) + 0.01 * g * g
                move = (slope[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                self.weights[k] = (self.weights[k] - rate * (1 - step / (steps + 1)) * move).astype(np.float32)

    def probabilities(self, x: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """(positions, rows, classes) for bytes ``x`` (positions, rows); ``inside`` is False on fill bytes."""
        w, n = self.weights, len(x)
        scores = np.empty((n, x.shape[1], len(w["bias"])), np.float32)
        for t, (*_, state) in enumerate(self._steps("f", x)):
            np.matmul(state, w["out_f"], out=scores[t])
        full = None if inside.all() else inside[::-1, :, None].astype(np.float32)
        for t, (*_, state) in enumerate(self._steps("b", x[::-1], full)):
            scores[n - 1 - t] += state @ w["out_b"]
        scores += w["bias"]
        return _softmax(scores)


def _softmax(x: np.ndarray) -> np.ndarray:
    """Over the last axis; scores of this network are far below the range of float32."""
    x = np.exp(x)
    x /= x.sum(-1, keepdims=True)
    return x


@functools.lru_cache(maxsize=4)
def _trained(windows: tuple[tuple[str, str], ...]) -> Network:
    languages = sorted({lang for lang, _ in windows})
    network, text, label = Network(languages), [], []
    for lang, window in windows:
        raw = np.frombuffer(window.encode(), np.uint8)
        for at in range(0, max(1, len(raw) - TRAIN_BYTES // 2), TRAIN_BYTES):
            piece = np.full(TRAIN_BYTES, 32, np.uint8)
            piece[: len(raw[at : at + TRAIN_BYTES])] = raw[at : at + TRAIN_BYTES]
            text.append(piece)
            label.append(languages.index(lang))
    network.train(np.stack(text), np.array(label))
    return network


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Network:
    """Train on the learnable documents; where none has a language and a letter, the network knows no languages."""
    windows = tuple(sample_windows(docs, id_col, text_col, lang_col, sample_docs))
    return _trained(windows) if windows else Network([])


def pooled(network: Network, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Best class and its averaged probability for every text of a batch; -1 where no byte is a letter."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    sums, counts = np.zeros((len(texts), len(network.languages))), np.zeros(len(texts))
    blocks = -(-np.diff(offsets) // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    starts = offsets[owner] + BLOCK * (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    for at in range(0, len(owner), ROWS):
        own, begin = owner[at : at + ROWS], starts[at : at + ROWS]
        places = begin[:, None] + np.arange(BLOCK)
        inside = places < offsets[own + 1][:, None]
        x, inside = np.ascontiguousarray(data[np.where(inside, places, 0)].T), inside.T
        letters = (LETTER[x] & inside).astype(np.float32)
        found = network.probabilities(x, inside)
        np.add.at(sums, own, np.einsum("tnc,tn->nc", found, letters))
        np.add.at(counts, own, letters.sum(0))
    best = sums.argmax(1)
    return np.where(counts > 0, best, -1), sums[np.arange(len(texts)), best] / np.maximum(counts, 1)


def predict(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """``row`` (all columns), lang_pred and score for every document, from the whole text alone.

    lang_pred is ``und`` and score 0 where the text is NULL or has no letter, and everywhere if the network knows no languages. Long texts go through in blocks, so memory is
    bounded; an empty table gives no rows.
    """
    text = F.col("row").getField(text_col).cast("string")
    lettered = docs.select(whole_row(docs).alias("row")).withColumn("text", F.when(text.rlike(r"\p{L}"), text))
    schema = T.StructType([lettered.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if not network.languages:
        return lettered.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    names = np.array([*network.languages, UNKNOWN], object)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("")
            best, score = pooled(network, texts)
            score = np.where(best < 0, 0.0, np.minimum(score, 1.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(score)], names=schema.names)

    return lettered.mapInArrow(lean(label), schema)


def keep_known(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """The documents, unchanged, whose language the network can tell.

    A text goes that is NULL or has no letter, and one of which no language's pooled probability reaches ``ABOVE_EVEN`` times the even share. A
    network that knows no languages tells none apart, so then every text with a letter stays.
    """
    found = predict(docs, network, text_col)
    if not network.languages:
        return found.filter(F.col("row").getField(text_col).cast("string").rlike(r"\p{L}")).select("row.*")
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= ABOVE_EVEN / len(network.languages))).select("row.*")


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Fit on ``docs`` and label all of them: doc_id, held_out, lang_pred, score."""
    ident = docs.withColumn(id_col, F.col(f"`{id_col}`")).select(id_col, text_col)
    found = predict(ident, fit(docs, id_col, text_col, lang_col), text_col)
    return found.select(
        F.col("row").getField(id_col).cast("long").alias("doc_id"),
        (~learnable(F.col("row").getField(id_col))).alias("held_out"),
        "lang_pred",
        "score",
    )
