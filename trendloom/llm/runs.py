"""Periodic runs of words, by sparse diagonals.

A run of period q is a stretch on the diagonal "word i equals word i - q". For every word its earlier occurrences name the lags whose match
grows by one; a lag that is not named by the next word ends there, and its diagonal gives a run at once if it is long enough.

Diagonals are sparse because an occurrence counts together with the words before it. Lags are divided into scales of q from ``least`` to
``most``; at a scale an occurrence of a word is the nearest earlier place where the same ``context`` words end, with 2 * most <= context <= 3 * least.
Within a run of smallest period q and four periods this place lies exactly q words back: a nearer one would give the context,
twice as long as q, a smaller period. So a word has one lag a scale, however often it occurs, the work is n log n even if one word fills
a text, and no lag that is only a multiple of a run's smallest period grows. A context that occurs once in its text is not
looked at at larger scales, as longer ones cannot repeat either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trendloom.llm.tables import whole_row
from trendloom.llm.wordhash import Runs, U, Words, lean, mix, slices

#: A run takes this many periods, and this many words.
PERIODS = 4
WORDS = 6

RUN = "struct<start: long, length: long, period: long>"


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(least, most, context) of the scales for texts of so many words."""
    yield 1, 1, WORDS - 1
    least = 2
    while PERIODS * least <= longest:
        most = 3 * least // 2
        yield least, most, 3 * least
        least = most + 1


def occurrences(hashes: np.ndarray, text: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(context, words, lags): at each scale the words that have an earlier occurrence in the scale's reach, and how far back it is.

    ``text`` numbers each word's text, ``first`` is the place of a text's first word.
    """
    if not len(hashes):
        return
    runs = Runs(hashes)
    place = np.arange(len(hashes)) - first[text]
    length = np.bincount(text)
    live = np.arange(len(hashes))
    for least, most, context in scales(int(length.max())):
        live = live[(place[live] >= context - 1) & (length[text[live]] >= max(WORDS, PERIODS * least))]
        if not len(live):
            return
        # Texts are told apart within the hash.
        same = mix(runs.at(live - context + 1, context).view(U) ^ mix(text[live].astype(U)))
        order = np.argsort(same, kind="stable")
        again = same[order[1:]] == same[order[:-1]]
        later, earlier = live[order[1:][again]], live[order[:-1][again]]
        lag = later - earlier
        near = (lag >= least) & (lag <= most)
        at = np.argsort(later[near])
        found = later[near][at]
        if len(found):
            yield context, found, lag[near][at]
        repeated = np.zeros(len(live), bool)
        repeated[order[1:][again]] = True
        repeated[order[:-1][again]] = True
        live = live[repeated]


def diagonals(context: int, words: np.ndarray, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of a scale: word after word the lag's match grows, or it ends and gives its run.

    A match that begins when a context of words agrees has that many words already.
    """
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1] + 1) | (lags[1:] != lags[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(words)) - 1
    period = lags[begin]
    start = words[begin] - context + 1 - period
    length = words[end] + 1 - start
    enough = length >= np.maximum(WORDS, PERIODS * period)
    return start[enough], length[enough], period[enough]


def _outermost(best: tuple | None, run: tuple[int, int, int]) -> tuple[int, int, int]:
    """The run with the larger length / period; ties go to the smaller start, then period."""
    if best is None:
        return run
    left, right = run[1] * best[2], best[1] * run[2]
    return run if left > right or (left == right and (run[0], run[2]) < (best[0], best[2])) else best


def _collapse(data: memoryview, begin: np.ndarray, end: np.ndarray, keep: np.ndarray) -> bytes:
    return b" ".join([data[b:e] for b, e in zip(begin[keep].tolist(), end[keep].tolist())])


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """row (the whole input row), n_words, runs (start, length, period; by start, then period), best (the one with most periods) and collapsed.

    Words are runs of bytes other than the six ASCII white-space ones, numbered from 0. A run is a stretch of words with smallest
    period q, at least ``WORDS`` words and ``PERIODS`` periods long, that no neighbouring word extends. ``collapsed`` is the text without the
    words that some run holds after its first period, joined by one space. NULL and empty texts have no words, no runs, best NULL and
    an empty collapsed text. Every row is treated alone, so repeated rows and ids, NULL or not, do no harm. Words and contexts are told
    apart by 64-bit hashes within a text.
    """
    rows = docs.select(whole_row(docs).alias("row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            words = Words(batch.column("text"))
            counts = words.counts()
            text = np.repeat(np.arange(len(counts)), counts)
            found = [diagonals(*hits) for hits in occurrences(words.hashes(), text, words.first[:-1])]
            start, length, period = (np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]) for i in range(3))
            order = np.lexsort((period, start))
            start, length, period = start[order], length[order], period[order]
            of = text[start] if len(start) else start
            # Words after a run's first period, counted in and out.
            drop = np.zeros(len(text) + 1, np.int64)
            np.add.at(drop, start + period, 1)
            np.add.at(drop, start + length, -1)
            keep = np.cumsum(drop[:-1]) == 0
            runs: list[list] = [[] for _ in counts]
            best: list = [None] * len(counts)
            for i, s, n, q in zip(of.tolist(), (start - words.first[of]).tolist(), length.tolist(), period.tolist()):
                runs[i].append({"start": s, "length": n, "period": q})
                best[i] = _outermost(best[i], (s, n, q))
            data = memoryview(words.data.tobytes())
            collapsed = []
            for low, high in zip(words.first[:-1], words.first[1:]):
                collapsed.append(_collapse(data, words.begin[low:high], words.end[low:high], keep[low:high]).decode())
            columns = [
                batch.column("row"),
                pa.array(counts.astype(np.int64)),
                pa.array(runs, pa.list_(run)),
                pa.array([b and dict(zip(("start", "length", "period"), b)) for b in best], run),
                pa.array(collapsed, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_words", "runs", "best", "collapsed"])

    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_words long, runs array<{RUN}>, best {RUN}, collapsed string"
    return rows.mapInArrow(lean(read), schema)
