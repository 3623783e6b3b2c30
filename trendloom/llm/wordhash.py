"""Words and hashes of word runs, vectorised over the texts of an Arrow batch.

A word is a run of bytes other than the six ASCII white-space ones (all bytes of a longer UTF-8 sequence are above them).
Its hash is a polynomial over its bytes, mixed; the hash of a run of words is a polynomial over the words' hashes. Both
come from running sums modulo 2**64 that are scaled back by powers of the inverse base, so any run costs two look-ups.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd multipliers drawn at random once; fixed so that reruns agree.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
BYTE_BASE = 0xC2B2AE3D27D4EB4F
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The final steps of splitmix64."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@functools.lru_cache(maxsize=8)
def _powers(base: int, upto: int) -> np.ndarray:
    out = np.full(upto, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64, kept for the next call."""
    return _powers(base, 1 << max(12, (max(count, 1) - 1).bit_length()))[:count]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def release() -> None:
    """Give freed memory back to the system: workers stay alive between tasks, beside those of the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(read):
    """``read`` as a function for mapInArrow that releases memory after every batch and at the end."""

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            release()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from read(one_by_one(batches))
        release()

    return run


def slices(batch: pa.RecordBatch, column: str = "text", most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch whose texts take about ``most_bytes`` together; a longer text goes alone."""
    texts = batch.column(column).cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + most_bytes, side="right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


class Words:
    """The words of a batch of texts: ``begin`` and ``end`` in ``data``, and ``first``, the number of a text's first word."""

    def __init__(self, texts: pa.Array) -> None:
        texts = texts.fill_null("").cast(pa.large_binary()) if texts.null_count else texts.cast(pa.large_binary())
        if len(texts):
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        else:
            offsets = np.zeros(1, np.int64)
        whole = texts.buffers()[2] if len(texts) else None
        data = np.frombuffer(whole, np.uint8)[offsets[0] : offsets[-1]] if whole is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        self.data, self.offsets = data, offsets - offsets[0]
        inside = ~SPACE[data]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        # A text's own edges part words as well.
        edge = self.offsets[(self.offsets > 0) & (self.offsets < len(data))]
        starts[edge] |= inside[edge]
        ends[edge - 1] |= inside[edge - 1]
        self.begin, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.begin, self.offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """64 bits for every word; ``data`` may stand in for the bytes, as when letters are lowered."""
        data = self.data if data is None else data
        out = np.empty(len(self.begin), U)
        step = 1 << 22
        for at in range(0, len(self.begin), step):
            begin, end = self.begin[at : at + step], self.end[at : at + step]
            low = begin[0]
            span = data[low : end[-1]].astype(U)
            span += U(1)
            span *= powers(BYTE_BASE, len(span))
            sums = np.concatenate([np.zeros(1, U), np.cumsum(span, dtype=U)])
            out[at : at + step] = (sums[end - low] - sums[begin - low]) * powers(inverse(BYTE_BASE), len(span))[begin - low]
        return mix(out ^ (self.end - self.begin).astype(U))


class Runs:
    """Hashes of runs of words from the words' hashes."""

    def __init__(self, words: np.ndarray, base: int = BASES[0]) -> None:
        self.base = base
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(words ^ U(base)) * powers(base, len(words)), dtype=U)])
        self.back = powers(inverse(base), len(words) + 1)

    def at(self, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """The hash of the ``length`` words from each ``start``; the caller keeps runs within one text."""
        return mix((self.sums[start + length] - self.sums[start]) * self.back[start]).view(np.int64)
