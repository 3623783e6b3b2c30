"""Conversations as marked text for training, proved by a grammar.

    conversation = turn*        turn = START role NEWLINE text END NEWLINE

``render`` writes a conversation, ``parse`` reads it back with one deterministic pass. A conversation is first written as it is; if the
parsed turns are not the source's, the turns that do not come back from a text of their own are escaped, and so on until they are the same.

A control string ``<|name|>`` within content is written ``<|\\name|>``, and one that already has backslashes gets one more; reading
takes one away. In roles the new line that ends them counts as a control string ``<|nl|>`` as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trendloom.llm.wordhash import lean

# The marks of the chat template, and the other control string of its vocabulary.
START, END = "<|im_start|>", "<|im_end|>"
CONTROLS = ("im_start", "im_end", "endoftext")
#: The role whose texts are learned from.
LEARNED = "assistant"

_CONTROL = re.compile(r"<\|(\\*)(" + "|".join(CONTROLS) + r")\|>")
_ESCAPED = re.compile(r"<\|\\(\\*)(" + "|".join(CONTROLS) + r")\|>")
_ROLE_CONTROL = re.compile(r"<\|(\\*)(" + "|".join((*CONTROLS, "nl")) + r")\|>")
_ROLE_ESCAPED = re.compile(r"<\|\\(\\*)(" + "|".join((*CONTROLS, "nl")) + r")\|>")
_MARK = re.compile(r"<\|(?:" + "|".join(CONTROLS) + r")\|>")

Turn = tuple[str, str]


def escape(text: str) -> str:
    return _CONTROL.sub(r"<|\\\1\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<|\1\2|>", text)


def escape_role(role: str) -> str:
    return _ROLE_CONTROL.sub(r"<|\\\1\2|>", role).replace("\n", "<|nl|>")


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(r"<|\1\2|>", role.replace("<|nl|>", "\n"))


def parse(text: str) -> list[tuple[str, str, int, int]] | None:
    """role, text and the span of the written text of every turn; None if the text does not follow the grammar."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            return None
        line = text.find("\n", at + len(START))
        if line < 0 or _MARK.search(text, at + len(START), line):
            return None
        # The next control string in the content has to be the one that ends it.
        mark = _MARK.search(text, line + 1)
        if mark is None or mark.group() != END or not text.startswith("\n", mark.end()):
            return None
        role, content = text[at + len(START) : line], text[line + 1 : mark.start()]
        turns.append((unescape_role(role), unescape(content), line + 1, mark.start()))
        at = mark.end() + 1
    return turns


def _written(turn: Turn, escaped: bool) -> str:
    role, text = (escape_role(turn[0]), escape(turn[1])) if escaped else turn
    return f"{START}{role}\n{text}{END}\n"


def _comes_back(written: str, turns: list[Turn]) -> bool:
    parsed = parse(written)
    return parsed is not None and [t[:2] for t in parsed] == turns


def render(turns: list[Turn]) -> str:
    """The conversation as text whose parsed turns are the source's."""
    escaped = [False] * len(turns)
    while True:
        parts = [_written(t, e) for t, e in zip(turns, escaped)]
        written = "".join(parts)
        if _comes_back(written, turns):
            return written
        conflicts = [i for i, (t, p) in enumerate(zip(turns, parts)) if not _comes_back(p, [t])]
        if not conflicts or any(escaped[i] for i in conflicts):
            raise ValueError("a turn cannot be written reversibly")
        for i in conflicts:
            escaped[i] = True


def gather(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (role, text) of each conversation, by turn, NULL first, then by role and text.

    NULL roles and texts are empty. Rows without a conv_id make up one conversation without an id. Other columns are not read.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    named = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), *text).alias("one"))
    sorted_turns = F.sort_array(F.collect_list("one"))
    return named.groupBy("conv_id").agg(sorted_turns.alias("turns")).select("conv_id", F.transform("turns", lambda t: t.dropFields("turn")).alias("turns"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted and loss, the spans (start, end; code points) of the written texts of ``LEARNED`` turns.

    Of ``gather``'s conversations, so one row each; a conversation of empty turns has marks only. An empty table gives no row.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for turns in batch.column("turns").to_pylist():
                texts.append(render([(t["role"], t["text"]) for t in turns]))
                spans.append([{"start": s, "end": e} for role, _, s, e in parse(texts[-1]) if role == LEARNED])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(texts, pa.string()), pa.array(spans, span)], names=["conv_id", "formatted", "loss"])

    return gather(conversations).mapInArrow(lean(read), "conv_id long, formatted string, loss array<struct<start: long, end: long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text) and loss_text, what stands under the loss spans, unescaped, all from the written text.

    A text that does not follow the grammar has turns NULL.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            turns, under = [], []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                parsed = parse(text)
                turns.append(None if parsed is None else [{"role": t[0], "text": t[1]} for t in parsed])
                under.append("".join(unescape(text[s["start"] : s["end"]]) for s in spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("formatted"), pa.array(turns, pair), pa.array(under, pa.string())],
                names=["conv_id", "formatted", "turns", "loss_text"],
            )

    return formatted.mapInArrow(lean(read), "conv_id long, formatted string, turns array<struct<role: string, text: string>>, loss_text string")
