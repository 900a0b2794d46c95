"""Training-order materialisation of token ids (operator 8).

Documents are tokenized (byte-level BPE). In the order of their ids (null first,
then by a digest of the text) and with an end-of-text id after each they are one
long run of ids, cut into sequences of ``length`` ids. A keyed Feistel network
with cycle-walking permutes the numbers 0..N-1 of all sequences: sequence i gets
global slot ``permute(i)``. Slots lie in shards of ``shard_slots``, one file each,
in which every record has the same size. Slot s is record ``s % shard_slots`` of
shard ``s // shard_slots``: reading in training order is sequential, and goes on
from any slot by one seek. The shards depend on the rows and the key alone, byte
by byte, not on how the rows are dealt to tasks.

Steps: (1) one pass tokenizes; a task writes its ids to one file, a few MB of texts
at a time, and lists the documents and token counts of each such piece; (2) counts
are sorted by document and summed up, first in each range, then (one row for each
range) over the ranges, so that every document knows its first place in the run;
(3) documents are split where sequences end, and the parts are sent to the task
that owns their shard, packed by shard and compressed; (4) that task writes its
shards in slot order and checks that no id is missing; (5) the manifest, which
Spark commits, names the shard files of the attempts that succeeded.

Records, little-endian: sequence number int64, document id int64 and token offset
int32 of its first id, number of ids int32, flags int32 (1: the document id is
null), then ``length`` ids uint16, padded with the end-of-text id (only the last
sequence is shorter).

Defined cases: null and empty texts contribute their end-of-text id alone; a null
document id is flagged, any integer is an id; repeated rows are separate documents;
an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.bpe import read_vocabulary
from tickwise.llm.common import cut, slices, utf8, work_dir, written
from tickwise.llm.warc import open_uri

LENGTH = 1024
SHARD_SLOTS = 1 << 14
ROUNDS = 6
KEY = 20_240_601
HEAD = "<qqiii"
HEAD_BYTES = struct.calcsize(HEAD)
HEAD_TYPE = np.dtype([("sequence", "<i8"), ("doc_id", "<i8"), ("doc_offset", "<i4"), ("n_tokens", "<i4"),
                      ("flags", "<i4")])
NULL_ID = 1
# a part of a document inside one sequence: its slot in the shard and place in the sequence
PART_TYPE = np.dtype([("doc_id", "<i8"), ("doc_offset", "<i4"), ("place", "<i4"), ("at", "<i4"), ("n", "<i4"),
                      ("flags", "<i4")])
PIECE_BYTES = 4 << 20
PACK_LEVEL = 5
TASK_BYTES = 32 << 20  # ids that one task moves, or records that it reads back
MAX_TASKS = 20_000

MANIFEST = T.StructType([
    T.StructField("shard", T.LongType(), False), T.StructField("file", T.StringType(), False),
    T.StructField("first_slot", T.LongType(), False), T.StructField("records", T.LongType(), False),
    T.StructField("stride", T.IntegerType(), False)])

SEQUENCE = T.StructType([
    T.StructField("slot", T.LongType(), False), T.StructField("sequence", T.LongType(), False),
    T.StructField("doc_id", T.LongType()), T.StructField("doc_offset", T.IntegerType(), False),
    T.StructField("n_tokens", T.IntegerType(), False), T.StructField("ids_sha256", T.StringType(), False)])


class Permutation:
    """A keyed permutation of 0..n-1: a Feistel network over the next even number of bits.

    Values that leave the range walk on along their cycle until they are back.
    """

    def __init__(self, n: int, key: int = KEY, rounds: int = ROUNDS):
        self.n, self.half = n, max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = [np.frombuffer(hashlib.blake2b(struct.pack("<qi", key, r), digest_size=8).digest(), "<u8")[0]
                     for r in range(rounds)]

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray, backwards: bool) -> np.ndarray:
        left, right, shift = x >> np.uint64(self.half), x & self.mask, np.uint64(self.half)
        if backwards:
            for key in reversed(self.keys):
                left, right = right ^ self._round(left, key), left
        else:
            for key in self.keys:
                left, right = right, left ^ self._round(right, key)
        return left << shift | right

    def __call__(self, x: np.ndarray, backwards: bool = False) -> np.ndarray:
        out = self._once(x.astype(np.uint64), backwards)
        while (away := out >= np.uint64(self.n)).any():
            out[away] = self._once(out[away], backwards)
        return out.astype(np.int64)


def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The byte-level BPE of a rank file (lines of a base64 token and its rank)."""
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("shards", pat_str=pattern, special_tokens={},
                             mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs})


def token_pieces(docs: DataFrame, doc_id: str, text: str, ranks: str, pattern: str, end_id: int,
                 folder: str) -> DataFrame:
    """(piece, file, place, packed, n, docs, digests, counts): the ids of a few MB of texts in each row.

    ``packed`` bytes of ``file`` from ``place`` on are the compressed ids, ``n`` of
    them, of ``docs`` one after the other, ``counts`` each. Computed once.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    end = struct.pack("<H", end_id)

    def run(batches):
        encode = encoding(*shared.value).encode_ordinary
        packer, task = zstandard.ZstdCompressor(level=PACK_LEVEL), TaskContext.get()
        name = f"{folder}/tokens-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        out, pieces = None, []
        for batch in batches:
            for part in slices(batch, "text", PIECE_BYTES):
                if out is None:
                    fs, path = open_uri(name)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out, place = fs.open_output_stream(path, compression=None), 0
                texts = list(utf8(part.column(1)))
                encoded = [np.array(encode(t.decode("utf-8", "replace")), "<u2").tobytes() + end for t in texts]
                counts = [len(ids) // 2 for ids in encoded]
                packed = packer.compress(b"".join(encoded))
                out.write(packed)
                pieces.append(((task.partitionId() << 32) + len(pieces), name, place, len(packed), sum(counts),
                               part.column(0).to_pylist(), [xxhash.xxh3_128_digest(t) for t in texts], counts))
                place += len(packed)
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*pieces, strict=True), (
                    pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                    pa.list_(pa.binary()), pa.list_(pa.int32())), strict=True)],
                ["piece", "file", "place", "packed", "n", "docs", "digests", "counts"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cut(rows.mapInArrow(run, "piece long, file string, place long, packed long, n long, "
                                    "docs array<long>, digests array<binary>, counts array<int>"))


def first_places(pieces: DataFrame) -> tuple[DataFrame, dict[int, int], int]:
    """Where each document begins in the run of all ids.

    Returns (piece, pos, part, start) for every document of every piece, the first
    place of each ``part``, to which ``start`` is to be added, and the number of ids.
    """
    docs = pieces.select("piece", F.posexplode(F.arrays_zip("docs", "digests", "counts"))).select(
        "piece", "pos", F.col("col.docs").alias("doc"), F.col("col.digests").alias("digest"),
        F.col("col.counts").alias("n"))
    # equal rows have equal ids, so that their order among themselves tells nothing
    order = ("doc", "digest", "piece", "pos")

    def run(batches):
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            ends = start + np.cumsum(batch.column("n").to_numpy().astype(np.int64))
            if len(ends):
                begin = np.concatenate([[start], ends[:-1]])
                start = int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("piece"), batch.column("pos"), pa.array([part] * len(ends), pa.int32()),
                     pa.array(begin, pa.int64()), batch.column("n")], ["piece", "pos", "part", "start", "n"])

    placed = docs.repartitionByRange(*order).sortWithinPartitions(*order).select("piece", "pos", "n")
    starts = written(placed.mapInArrow(run, "piece long, pos int, part int, start long, n int"), "places")
    sizes = starts.groupBy("part").agg(F.sum(F.col("n").cast("long")).alias("n")).collect()  # one row a task
    sizes.sort(key=lambda r: r["part"])
    bases = dict(zip((r["part"] for r in sizes), [0, *accumulate(r["n"] for r in sizes)], strict=False))
    return starts.drop("n"), bases, sum(r["n"] for r in sizes)


def _spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (n[0] numbers), then begin[1], ... and so on."""
    return np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)


def shard_parts(pieces: DataFrame, total: int, length: int, shard_slots: int, key: int,
                starts: DataFrame, bases: dict[int, int]) -> DataFrame:
    """(shard, n, parts): the parts of each piece's documents, packed and compressed by shard."""
    shared = pieces.sparkSession.sparkContext.broadcast(bases)
    slots_in_all = -(-total // length)

    def run(batches):
        permute, packer = Permutation(slots_in_all, key), zstandard.ZstdCompressor(level=PACK_LEVEL)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for r in batch.to_pylist():
                fs, path = open_uri(r["file"])
                with fs.open_input_file(path) as f:
                    ids = np.frombuffer(unpack.decompress(f.read_at(r["packed"], r["place"]),
                                                          max_output_size=2 * r["n"]), "<u2")
                begin = np.array([shared.value[s["part"]] + s["start"] for s in r["starts"]], np.int64)
                counts = np.array(r["counts"], np.int64)
                first = begin // length
                splits = (begin + counts - 1) // length - first + 1
                doc = np.repeat(np.arange(len(counts)), splits)
                sequence = _spread(first, splits)
                low = np.maximum(begin[doc], sequence * length)
                n = np.minimum((begin + counts)[doc], (sequence + 1) * length) - low
                slots = permute(sequence)
                order = np.argsort(slots // shard_slots, kind="stable")
                parts = np.zeros(len(order), PART_TYPE)
                parts["doc_id"] = np.array([i or 0 for i in r["docs"]], np.int64)[doc]
                parts["flags"] = np.array([NULL_ID * (i is None) for i in r["docs"]])[doc]
                parts["doc_offset"], parts["place"] = low - begin[doc], slots % shard_slots
                parts["at"], parts["n"] = low % length, n
                source = (np.cumsum(counts) - counts)[doc] + low - begin[doc]
                parts, source = parts[order], source[order]
                shards, at = np.unique((slots // shard_slots)[order], return_index=True)
                ends = [*at[1:].tolist(), len(order)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards, pa.int64()),
                     pa.array([e - a for a, e in zip(at.tolist(), ends, strict=True)], pa.int32()),
                     pa.array([packer.compress(parts[a:e].tobytes() + ids[_spread(
                         source[a:e], parts["n"][a:e].astype(np.int64))].tobytes())
                         for a, e in zip(at.tolist(), ends, strict=True)], pa.binary())], ["shard", "n", "parts"])

    tasks = max(1, min(MAX_TASKS, 2 * total // TASK_BYTES))
    of_piece = starts.repartition(tasks, "piece").groupBy("piece").agg(
        F.sort_array(F.collect_list(F.struct("pos", "part", "start"))).alias("starts"))  # a few MB of texts
    joined = pieces.drop("digests").repartition(tasks, "piece").join(of_piece, "piece")
    return joined.mapInArrow(run, "shard long, n int, parts binary")


def write_shards(parts: DataFrame, folder: str, total: int, length: int, shard_slots: int, key: int,
                 end_id: int) -> DataFrame:
    """Write every shard in slot order; returns the manifest, computed once."""
    stride, n = HEAD_BYTES + 2 * length, -(-total // length)
    shards = -(-n // shard_slots)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, unpack = TaskContext.get().taskAttemptId(), zstandard.ZstdDecompressor()
        permute, shard, seen, rows = Permutation(n, key), None, np.array([]), []

        def fresh(shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Padded records with the numbers of their sequences; their ids, seen ids."""
            slots = np.arange(shard * shard_slots, min((shard + 1) * shard_slots, n))
            records = np.zeros(len(slots), np.dtype([("head", HEAD_TYPE), ("ids", "<u2", (length,))]))
            records["ids"] = end_id
            records["head"]["sequence"] = permute(slots, backwards=True)
            records["head"]["n_tokens"] = np.minimum(length, total - records["head"]["sequence"] * length)
            return records, records.view("<u2").reshape(-1), np.zeros(len(slots), np.int64)

        def close() -> list[tuple]:
            if shard is None:
                return []
            if (seen != records["head"]["n_tokens"]).any():
                raise ValueError(f"shard {shard} has {seen.sum()} of {records['head']['n_tokens'].sum()} ids")
            name = f"{folder}/shard-{shard:08d}-{attempt}.bin"
            fs, path = open_uri(name)
            fs.create_dir(path.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(path, compression=None) as out:
                out.write(records.view(np.uint8).data)
            return [(shard, name, shard * shard_slots, len(records), stride)]

        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] != shard:
                    rows += close()
                    shard = r["shard"]
                    records, flat, seen = fresh(shard)
                raw = unpack.decompress(r["parts"])
                own = np.frombuffer(raw, PART_TYPE, r["n"])
                sizes = own["n"].astype(np.int64)
                to = own["place"].astype(np.int64) * (stride // 2) + HEAD_BYTES // 2 + own["at"]
                flat[_spread(to, sizes)] = np.frombuffer(raw, "<u2", offset=own.nbytes)
                np.add.at(seen, own["place"], sizes)
                first = own[own["at"] == 0]
                for field in ("doc_id", "doc_offset", "flags"):
                    records["head"][field][first["place"]] = first[field]
        rows += close()
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32()), strict=True)], MANIFEST.names)

    # task k writes a range of shards, usually one
    tasks = max(1, min(shards, MAX_TASKS))
    owner = F.floor(F.col("shard") * tasks / max(shards, 1)).cast("int")
    placed = parts.repartitionById(tasks, owner).sortWithinPartitions("shard")
    return cut(placed.mapInArrow(run, MANIFEST))


def materialise(docs: DataFrame, doc_id: str, text: str, ranks_path: str, pattern: str, end_id: int,
                folder: str | None = None, length: int = LENGTH, shard_slots: int = SHARD_SLOTS,
                key: int = KEY) -> DataFrame:
    """Tokenize ``docs`` and write them as shards in training order; returns the manifest."""
    folder = folder or work_dir(docs.sparkSession, "shards")
    pieces = token_pieces(docs, doc_id, text, read_vocabulary(ranks_path), pattern, end_id,
                          work_dir(docs.sparkSession, "tokens"))
    starts, bases, total = first_places(pieces)
    parts = shard_parts(pieces, total, length, shard_slots, key, starts, bases)
    return write_shards(parts, folder, total, length, shard_slots, key, end_id)


def read_slots(file: str, first_slot: int, records: int, stride: int, start: int = 0,
               step: int = 1024) -> Iterator[tuple[int, bytes]]:
    """(slot, record) of a shard file in slot order, from slot ``start`` on."""
    fs, path = open_uri(file)
    with fs.open_input_file(path) as f:
        at = max(0, start - first_slot)
        while at < records:
            block = f.read_at(min(step, records - at) * stride, at * stride)
            for k in range(0, len(block), stride):
                yield first_slot + at + k // stride, block[k:k + stride]
            at += len(block) // stride


def read_sequences(manifest: DataFrame, start: int = 0) -> DataFrame:
    """The sequences of all shards from global slot ``start`` on, with the digest of their ids."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                out = []
                for slot, raw in read_slots(r["file"], r["first_slot"], r["records"], r["stride"], start):
                    number, doc, offset, n, flags = struct.unpack_from(HEAD, raw)
                    ids = raw[HEAD_BYTES:HEAD_BYTES + 2 * n]
                    out.append((slot, number, None if flags & NULL_ID else doc, offset, n,
                                hashlib.sha256(ids).hexdigest()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                            pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()),
                            strict=True)], SEQUENCE.names)

    # the rows of the manifest are few, the files they name are not
    wanted = manifest.filter(F.col("first_slot") + F.col("records") > start)
    size = wanted.agg(F.sum(F.col("records") * F.col("stride"))).first()[0] or 0
    tasks = max(1, min(MAX_TASKS, -(-size // TASK_BYTES)))
    return wanted.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int")).mapInArrow(run, SEQUENCE)
