"""CSV files as they were landed, each with a header, a preamble and an order of columns of its own, read in one scan.

A bounded probe reads the first lines of every file; it finds the header and what stands above it. All files are then
one text source: lines of the preambles are dropped file by file, and each line is parsed by the header of its own file.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The most that a probe reads of a file: lines, and bytes of each.
PROBE_LINES, PROBE_BYTES = 50, 1 << 20
#: The table of files goes to every task up to this many characters; a larger one is joined as Spark chooses.
FILES_BROADCAST = 8 << 20

_CSV = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}


class Layout(NamedTuple):
    """One landed file: its path, its lines down to the header and the header's names."""

    file: str
    preamble: tuple[str, ...]
    header: tuple[str, ...]


class Landed(NamedTuple):
    """``rows`` that are sound and, of the same scan, the ``malformed`` lines: file, line and reason."""

    rows: DataFrame
    malformed: DataFrame


def landed_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """path, name, length and modified of the files of folders or globs; the listing alone is read, no file is opened."""
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").load(path).select("path", name.alias("name"), "length", F.col("modificationTime").alias("modified"))


def _files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files behind folders or globs, as ``_metadata.file_path`` spells them; the listing has one short row per file."""
    listed = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    return sorted(r[0] for r in listed.select("_metadata.file_path").collect())


def first_lines(spark: SparkSession, file: str, most: int = PROBE_LINES) -> list[str]:
    """The first lines of one file, through the file system that Spark reads it by."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    path = hadoop.fs.Path(spark._jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        reader = hadoop.util.LineReader(codec.createInputStream(stream) if codec else stream)
        lines, text = [], hadoop.io.Text()
        while len(lines) < most and reader.readLine(text, PROBE_BYTES, PROBE_BYTES) > 0:
            lines.append(text.toString())
    finally:
        stream.close()
    return [line.removeprefix("﻿") if i == 0 else line for i, line in enumerate(lines)]


def _names(line: str) -> tuple[str, ...]:
    """Header names; a blank one, or one that was there before, is named by its place."""
    names: list[str] = []
    for i, cell in enumerate(next(csv.reader([line]), [])):
        taken = {n.lower() for n in names}
        names.append(cell if cell and cell.lower() not in taken else f"{cell}_c{i}")
    return tuple(names)


def layouts(spark: SparkSession, path: str | Sequence[str], header: int | Sequence[str] = 1) -> list[Layout]:
    """The layout of every file: ``header`` is the number of the header's line, or names of which the header's line holds all.

    Files without any line are left out. A file without such a line in the first ``PROBE_LINES`` is an error.
    """
    found = []
    for file in _files(spark, path):
        lines = first_lines(spark, file, header if isinstance(header, int) else PROBE_LINES)
        if not lines:
            continue
        if isinstance(header, int):
            at = header - 1 if len(lines) >= header else None
        else:
            at = next((i for i, line in enumerate(lines) if set(header) <= set(_names(line))), None)
        if at is None:
            raise ValueError(f"no header line in {file}")
        found.append(Layout(file, tuple(lines[: at + 1]), _names(lines[at])))
    return found


def _parsed(spark: SparkSession, path: str | Sequence[str], found: Sequence[Layout], tags: Mapping[str, str] | None) -> tuple[DataFrame, list[tuple[str, ...]]]:
    """file, name, tag, kind, line and one struct per kind of header (cells c0.., and bad: the line, if cells lack or are too many)."""
    kinds = list(dict.fromkeys(layout.header for layout in found))
    rows = [(x.file, kinds.index(x.header), list(x.preamble), (tags or {}).get(x.file)) for x in found]
    table = spark.createDataFrame(rows, "file string, kind int, preamble array<string>, tag string")
    if sum(len(x.file) + sum(map(len, x.preamble)) for x in found) <= FILES_BROADCAST:
        table = F.broadcast(table)
    # A file that landed after the probe has no layout and waits for the next read.
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name")
    )
    kept = lines.join(table, "file").filter((F.trim("line") != "") & ~F.array_contains("preamble", F.col("line")))
    cells = [", ".join(f"c{i} string" for i in range(len(k))) + ", bad string" for k in kinds]
    each = [F.when(F.col("kind") == i, F.from_csv("line", F.lit(s), _CSV)).alias(f"k{i}") for i, s in enumerate(cells)]
    return kept.select("file", "name", "tag", "kind", "line", *each), kinds


def _cell(kinds: Sequence[tuple[str, ...]], place) -> Column:
    """A cell of each line by the place that ``place`` gives in the line's header; NULL where it gives none."""
    found = [(i, place(k)) for i, k in enumerate(kinds)]
    return F.coalesce(*[F.col(f"k{i}.c{at}") for i, at in found if at is not None], F.lit(None).cast("string"))


def _bad(kinds: Sequence[tuple[str, ...]]) -> Column:
    return F.coalesce(*[F.col(f"k{i}.bad") for i in range(len(kinds))])


def read_landed(
    spark: SparkSession, path: str | Sequence[str], header: int | Sequence[str] = 1, tags: Mapping[str, str] | None = None, tag: str = "sheet"
) -> DataFrame:
    """Text columns of all files by header name, those that a file lacks NULL; one scan, whatever the layouts.

    ``tags`` names files and gives the value of the column ``tag``. Blank lines, and lines that repeat one of their file's lines down
    to the header, are dropped. Cells that a line lacks are NULL, cells too many are dropped; ``set_aside`` tells such lines.
    A doubled quote in a quoted field is one quote; a field cannot hold a line end.
    """
    found = layouts(spark, path, header)
    parsed, kinds = _parsed(spark, path, found, tags)
    names = dict.fromkeys(n for k in kinds for n in k)
    columns = [_cell(kinds, lambda k, n=n: k.index(n) if n in k else None).alias(n) for n in names]
    return parsed.select(*columns, *([F.col("tag").alias(tag)] if tags is not None else []))


def read_positions(
    spark: SparkSession, path: str | Sequence[str], positions: Sequence[int], names: Sequence[str], key: Column, header: int | Sequence[str] = 1
) -> DataFrame:
    """Columns of all files by position, counted from 1 in each file's own header, and ``file_key``: ``key`` of the file's name, column ``name``."""
    parsed, kinds = _parsed(spark, path, layouts(spark, path, header), None)
    columns = [_cell(kinds, lambda k, p=p: p - 1 if p <= len(k) else None).alias(n) for p, n in zip(positions, names)]
    return parsed.select(*columns, key.alias("file_key"))


def set_aside(
    spark: SparkSession, path: str | Sequence[str], columns: Mapping[str, str], numbers: Iterable[str] = (), header: int | Sequence[str] = 1
) -> Landed:
    """The rows of all files under new names, and the lines that are malformed.

    ``columns`` gives header name and new name; a file without one of these headers is an error. A line is malformed if it has too few or too many
    cells, or text that is no number in one of ``numbers`` (new names), which become doubles. Blank cells are NULL and sound.
    """
    found = layouts(spark, path, header)
    for layout in found:
        if missing := set(columns) - set(layout.header):
            raise ValueError(f"{layout.file} lacks {sorted(missing)}")
    parsed, kinds = _parsed(spark, path, found, None)
    named = parsed.select("file", "line", _bad(kinds).alias("bad"), *[_cell(kinds, lambda k, n=n: k.index(n)).alias(f"v_{c}") for n, c in columns.items()])
    reason = F.when(F.col("bad").isNotNull(), F.lit("number of cells"))
    for c in numbers:
        text = F.col(f"`v_{c}`")
        reason = reason.when((F.trim(text) != "") & text.try_cast("double").isNull(), F.lit(f"no number: {c}"))
    judged = named.withColumn("reason", reason)
    values = [F.col(f"`v_{c}`").try_cast("double").alias(c) if c in set(numbers) else F.col(f"`v_{c}`").alias(c) for c in columns.values()]
    return Landed(
        judged.filter(F.col("reason").isNull()).select(*values),
        judged.filter(F.col("reason").isNotNull()).select("file", "line", "reason"),
    )


def write_quarantine(landed: Landed, path: str) -> None:
    """Append the malformed lines to a table, by reason."""
    landed.malformed.write.mode("append").partitionBy("reason").parquet(path)


def file_tags(spark: SparkSession, sheets: Mapping[str, str]) -> dict[str, str]:
    """Each file behind the sheets' paths, with its sheet's name."""
    return {file: name for name, path in sheets.items() for file in _files(spark, path)}


def missing_month_files(spark: SparkSession, path: str, months: DataFrame, start: int, length: int) -> DataFrame:
    """The ``months`` (with ``month_key``) of which no landed file carries the key in its name, from the listing alone."""
    names = F.substring("name", start, length)
    present = landed_files(spark, path).select(names.alias("month_key")).distinct()
    return months.join(present, "month_key", "left_anti")

