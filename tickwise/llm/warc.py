"""WARC archives as seekable Zstandard bundles (operator 4).

``write_bundles`` writes one WARC record for each row: a ``response`` for the
first of rows with equal payloads, a ``revisit`` that refers to it for the
others. A task writes one bundle: records are grouped into independent frames,
and a seek table (a skippable frame after the last one) gives every frame's
compressed and plain size. The result is an index table that maps a record's
identifier to its bundle, frame and offset inside the frame.

``read_bundles`` reads the archives back from the index: the seek table gives
the place of a frame, which is fetched and decompressed alone.

Recovery: a bundle is written under a name of its own task attempt, and the
index, which Spark commits, names only bundles of attempts that succeeded; files
of lost attempts are never referred to. Bundles lie in a folder that all
executors share and are written through ``pyarrow.fs``.

Defined cases: a null payload is empty; empty payloads equal each other and are
compared like others if ``min_bytes`` is 0; among rows with equal payloads and
equal ids one (the first in row order) is the response; a null id sorts last and
is kept as null; a null URL leaves the target out; control characters and spaces
in a URL are percent-encoded in the header.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.common import cut, slices, with_row_key, work_dir, written

# Fixed values of the seekable format: magic numbers of its skippable frame and footer.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

READ_BYTES = 16 << 20  # of records that one task reads back
READ_TASKS = 20_000
FRAME_BYTES = 1 << 20
LEVEL = 3
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
EOL = b"\r\n"

INDEX = T.StructType([
    T.StructField("row_key", T.LongType(), False),
    T.StructField("record_id", T.StringType(), False),
    T.StructField("bundle", T.StringType(), False),
    T.StructField("frame", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("length", T.LongType(), False)])

RECORD = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("record_id", T.StringType(), False),
    T.StructField("record_type", T.StringType(), False),
    T.StructField("target", T.StringType()),
    T.StructField("payload_bytes", T.LongType(), False),
    T.StructField("payload_digest", T.StringType(), False),
    T.StructField("refers_to", T.LongType()),
    T.StructField("payload", T.BinaryType())])


class BundleWriter:
    """Frames and the seek table of one bundle, written to a binary stream."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.pending: list[bytes] = []
        self.size = 0
        self.table: list[tuple[int, int]] = []

    def add(self, record: bytes) -> tuple[int, int]:
        """Append a record; its frame number and offset inside the frame."""
        if self.size and self.size + len(record) > self.frame_bytes:
            self.end_frame()
        at = (len(self.table), self.size)
        self.pending.append(record)
        self.size += len(record)
        return at

    def end_frame(self) -> None:
        if self.pending:
            frame = self.zstd.compress(b"".join(self.pending))
            self.stream.write(frame)
            self.table.append((len(frame), self.size))
            self.pending, self.size = [], 0

    def close(self) -> None:
        self.end_frame()
        entries = b"".join(struct.pack("<II", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, file):
        self.file = file
        end = file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end of the bundle")
        width = 12 if flags & 0x80 else 8
        raw = file.read_at(n * width, end - 9 - n * width)
        self.table, at = [], 0
        for i in range(n):
            packed, plain = struct.unpack_from("<II", raw, i * width)
            self.table.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.table[number]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at),
                                                       max_output_size=max(plain, 1))


def record_id(key: int) -> str:
    return f"urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{key}')}"


def _target(url: str) -> str:
    return "".join(c if " " < c < "\x7f" or c > "\xa0" else "".join(f"%{b:02X}" for b in c.encode())
                   for c in url)


def warc_record(key: int, page_id: int | None, url: str | None, payload: bytes,
                first: tuple[int, int | None] | None) -> bytes:
    """One record; ``first`` is the row key and page id of the response a revisit refers to."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first else http + payload
    head = [("WARC-Type", "revisit" if first else "response"),
            ("WARC-Record-ID", f"<{record_id(key)}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("X-Payload-Bytes", str(len(payload))),
            ("X-Page-ID", "" if page_id is None else str(page_id))]
    if url is not None:
        head.append(("WARC-Target-URI", _target(url)))
    if first:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<{record_id(first[0])}>"),
                 ("X-Refers-To-Page-ID", "" if first[1] is None else str(first[1]))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return b"WARC/1.1\r\n" + lines + EOL + block + EOL + EOL


def parse_record(record: bytes) -> dict:
    """The fields of one record; a response's digest and size come from its payload."""
    head, _, rest = record.partition(EOL + EOL)
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    number = lambda k: int(fields[k]) if fields.get(k) else None
    out = {"page_id": number("X-Page-ID"), "record_id": fields["WARC-Record-ID"].strip("<>"),
           "record_type": fields["WARC-Type"], "target": fields.get("WARC-Target-URI"),
           "refers_to": number("X-Refers-To-Page-ID")}
    if out["record_type"] == "response":
        payload = block.partition(EOL + EOL)[2]
        return out | {"payload": payload, "payload_bytes": len(payload),
                      "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode()}
    return out | {"payload": None, "payload_bytes": int(fields["X-Payload-Bytes"]),
                  "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:")}


def open_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
        pafs.LocalFileSystem(), uri)


def write_bundles(rows: DataFrame, folder: str, key: str, page_id: str, url: str, payload: str,
                  min_bytes: int = 0, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write ``rows`` as WARC bundles under ``folder``; returns the index, computed once.

    ``key`` names the column with each row's unique number. Rows with equal
    payloads of at least ``min_bytes`` bytes are one response and revisits.
    """
    data = rows.select(F.col(key).alias("row_key"), F.col(page_id).cast("long").alias("page_id"),
                       F.col(url).alias("url"), F.coalesce(payload, F.lit("")).alias("payload"))
    data = data.withColumn("digest", F.when(F.octet_length("payload") >= min_bytes, F.sha1("payload")))
    # only payloads that repeat; a table of its own, so that the join with the rows
    # broadcasts it while it is small and else splits a payload that many rows share
    firsts = written(data.filter("digest IS NOT NULL").groupBy("digest")
                     .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(
                         F.col("page_id").isNull().alias("late"), "page_id", "row_key")).alias("first"))
                     .filter("n > 1").select("digest", F.col("first.row_key").alias("first_key"),
                                             F.col("first.page_id").alias("first_page")), "firsts")
    data = data.join(firsts, "digest", "left").drop("digest")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{folder}/bundle-{task.partitionId():06d}-{task.taskAttemptId()}.warc.zst"
        writer = stream = None
        index = []
        for batch in batches:
            for piece in slices(batch, "payload", 4 * frame_bytes):
                for r in piece.to_pylist():
                    if writer is None:
                        fs, path = open_uri(name)
                        fs.create_dir(path.rpartition("/")[0], recursive=True)
                        stream = fs.open_output_stream(path, compression=None)
                        writer = BundleWriter(stream, frame_bytes)
                    first = None
                    if r["first_key"] is not None and r["first_key"] != r["row_key"]:
                        first = (r["first_key"], r["first_page"])
                    record = warc_record(r["row_key"], r["page_id"], r["url"], r["payload"].encode(), first)
                    frame, offset = writer.add(record)
                    index.append((r["row_key"], record_id(r["row_key"]), name, frame, offset, len(record)))
        if writer:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*index, strict=True), (
                    pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                INDEX.names)

    return cut(data.mapInArrow(write, INDEX))


def read_bundles(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that ``index`` names, each frame fetched by its place in the seek table."""
    # the rows of the index are few, the records they name are not
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, min(READ_TASKS, -(-size // READ_BYTES)))
    placed = index.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = reader = frame = None
        plain = b""
        schema = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
                            ("target", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                            ("payload", pa.binary())])
        for batch in batches:
            out, size = [], 0
            for r in batch.to_pylist():
                if r["bundle"] != name:
                    name, frame = r["bundle"], None
                    fs, path = open_uri(name)
                    reader = BundleReader(fs.open_input_file(path))
                if r["frame"] != frame:
                    frame, plain = r["frame"], reader.frame(r["frame"])
                record = parse_record(plain[r["offset"]:r["offset"] + r["length"]])
                if record["record_id"] != r["record_id"]:
                    raise ValueError(f"the index points to another record: {r}")
                if not payloads:
                    record["payload"] = None
                out.append(record)
                size += len(record["payload"] or b"")
                if size > 4 * FRAME_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return placed.mapInArrow(read, RECORD)


def archive_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
                  folder: str | None = None) -> DataFrame:
    """Write ``pages`` to bundles and read every record back (columns of RECORD, payloads left out)."""
    keyed, key = with_row_key(pages, page_id)
    folder = folder or work_dir(pages.sparkSession, "warc")
    return read_bundles(write_bundles(keyed, folder, key, page_id, url, payload), payloads=False)
