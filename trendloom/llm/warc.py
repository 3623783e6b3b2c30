"""WARC archives in Zstandard with a shared dictionary: one frame per record.

An archive opens with a skippable frame that holds the dictionary; every record after it is a frame
of its own, so a reader can start at any record. Archives are rolled at a size, and a task names its
files after its attempt; only files in the manifest, which Spark commits as a table, are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from trendloom.llm.tables import hashed_share
from trendloom.session import stage, stage_path

DICTIONARY_FRAME = 0x184D2A5D
ARCHIVE_BYTES = 32 << 20
SAMPLE_ROWS = 256
SAMPLE_BYTES = 64 << 10
DICTIONARY_BYTES = 64 << 10
#: Bytes fetched from an archive at a time, and the most that one header block may take.
CHUNK = 1 << 20
HEADER_BYTES = 64 << 10
PAGE_ID = "urn:page:"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class BadRecord(ValueError):
    """A frame, header or length that does not hold."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def render(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers of the payload and leaves out its bytes."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PAGE_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{PAGE_ID}{refers_to}>", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise BadRecord(f"not a header: {line[:80]!r}")
        found[name.decode().strip().lower()] = value.decode().strip()
    return found


def parse(record: bytes) -> dict:
    """The parts of one record; raises ``BadRecord`` where a header, a length or a digest is wrong."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/1."):
        raise BadRecord("no WARC header")
    fields = _fields(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise BadRecord(f"{name} is missing")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadRecord("Content-Length does not fit the frame")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise BadRecord(f"unknown type {kind}")
    if (kind == "revisit") != ("warc-refers-to" in fields):
        raise BadRecord("WARC-Refers-To does not fit the type")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    web = _fields(http.split(b"\r\n")[1:])
    if not gap or not web.get("content-length", "").isdigit():
        raise BadRecord("no HTTP header")
    size, digest = int(web["content-length"]), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise BadRecord("payload and digest differ")
    if kind == "revisit" and payload:
        raise BadRecord("a revisit with a payload")
    name = lambda x: x.strip("<>").removeprefix(PAGE_ID)
    return {
        "record_id": name(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": name(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def records(stream) -> Iterator[bytes]:
    """The records of one archive, decoded frame by frame; a frame cut short is an error."""
    held = stream.read(8)
    magic, size = struct.unpack("<II", held) if len(held) == 8 else (0, 0)
    dictionary = None
    if magic == DICTIONARY_FRAME:
        held = stream.read(size)
        if len(held) != size:
            raise BadRecord("the dictionary frame is cut short")
        dictionary, held = zstandard.ZstdCompressionDict(held), b""
    codec = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        held = held or stream.read(CHUNK)
        if not held:
            return
        frame, parts = codec.decompressobj(), []
        while not frame.eof:
            if not held:
                raise BadRecord("a frame is cut short")
            parts.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else stream.read(CHUNK)
        yield b"".join(parts)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from sampled records; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def write_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_revisit: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record per page; returns the staged manifest: path, records, bytes.

    Of pages with equal payloads of at least ``least_revisit`` bytes, the one with the largest id is a response
    and the others revisit it; rows that repeat that largest id are responses too. NULL html is an empty payload,
    NULL ids come before all others, NULL urls are left out. An empty table writes no archive. The dictionary is
    trained on about ``SAMPLE_ROWS`` pages, one for each of the ids whose hash is small, ``SAMPLE_BYTES`` of each.
    """
    spark = pages.sparkSession
    folder = stage_path(spark)
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    plain = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    plain = plain.withColumn("sha", F.sha1("payload"))
    heads = plain.select("id", F.substring("payload", 1, SAMPLE_BYTES).alias("head"))
    chosen = hashed_share(heads, F.col("id"), SAMPLE_ROWS).select("head").collect()
    dictionary = train_dictionary([bytes(r[0]) for r in chosen]) if chosen else b""
    best = (
        plain.filter(F.length("payload") >= least_revisit)
        .groupBy(F.col("sha").alias("of"))
        .agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND best IS NOT NULL")
    )
    marked = plain.join(best, F.col("sha") == F.col("of"), "left").select(
        "id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("best")), F.col("best")).alias("refers_to")
    )
    schema = "path string, records long, bytes long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        packed = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        codec = zstandard.ZstdCompressor(level=3, dict_data=packed, write_content_size=True)
        out, done, path, count = None, [], "", 0
        for batch in batches:
            for page, url, body, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path = f"{base}/{context.partitionId()}-{context.taskAttemptId()}-{len(done)}.warc.zst"
                    store.create_dir(base, recursive=True)
                    out, count = store.open_output_stream(path, compression=None), 0
                    if dictionary:
                        out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                out.write(codec.compress(render(page, url, body, payload_digest(body), refers, date)))
                count += 1
                if out.tell() >= archive_bytes:
                    done.append((path, count, out.tell()))
                    out = out.close()
        if out is not None:
            done.append((path, count, out.tell()))
            out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "records", "bytes"])

    return stage(marked.mapInArrow(write, schema).withColumn("path", F.concat(F.lit(_root(folder)), "path")))


def _root(folder: str) -> str:
    """The part of a folder's address that ``pyarrow.fs`` leaves out of its paths."""
    return folder[: folder.index("://") + 3] if "://" in folder and not folder.startswith("file:") else "file://"


READ_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("path", T.StringType()),
    T.StructField("error", T.StringType()),
])


def read_archives(paths: DataFrame, most_tasks: int = 10_000) -> DataFrame:
    """The records of the archives in column ``path``, each archive streamed by one task.

    A record that fails a check has only ``path`` and ``error``; an archive that cannot be decoded further ends
    with such a row. payload is NULL for revisits, whose payload_bytes and payload_digest are those of the page.
    """
    tasks = max(1, min(paths.count(), most_tasks))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.name, {"long": pa.int64(), "binary": pa.binary()}.get(f.dataType.simpleString().replace("bigint", "long"), pa.string())) for f in READ_SCHEMA])
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_stream(place, compression=None) as stream:
                    found = records(stream)
                    while True:
                        try:
                            record = next(found)
                        except StopIteration:
                            break
                        except (BadRecord, zstandard.ZstdError) as e:
                            rows.append({"path": path, "error": str(e)})
                            break
                        try:
                            rows.append(parse(record) | {"path": path})
                        except (BadRecord, UnicodeDecodeError) as e:
                            rows.append({"path": path, "error": str(e)})
                        held += len(record)
                        if held > 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return paths.select("path").repartition(tasks).mapInArrow(read, READ_SCHEMA)
