"""Line dedup (operator 2): fuzzy lines by MinHash, one line kept per component.

Lines (parted by ``\\n``) link when the Jaccard similarity of their character
shingles is at least ``SIMILARITY``. Steps:

1. Every distinct line gets a signature of ``BANDS * ROWS`` MinHash values in one
   pass over its shingles (one-permutation hashing; bins that got no shingle
   borrow one from a bin chosen by hash).
2. Each band of a signature is a key; lines that share a key are candidates. At
   the threshold a pair shares a band with probability 0.996, above it with more.
   Keys travel in blocks, sorted and cut by key range where they are made; a range
   is put together, counted, and only keys with two lines or more go on. Keys of
   very many lines are taken out where they are made: their lines are dealt on.
3. The lines of a candidate group are fetched and compared exactly, on their
   shingle sets. Links of a group come out as at most one edge fewer than it has
   lines; a group over ``GROUP_LINES`` or ``GROUP_BYTES`` is cut into chunks by hash,
   every pair of which is compared, so no candidate is dropped.
4. Edges go through distributed union-find. Of each component, and of equal lines,
   the line first by (row key, line number) stays and all others go.

Scale. Equal lines are one candidate row each (per task, then in the group).
Texts of candidates only are shuffled, once to verify; the documents are joined
once with the numbers of their dropped lines. Line numbers of one document are
the only thing that is gathered by document.

Defined cases: a null text stays null; lines without a visible character are
never dropped; a line shorter than a shingle is one shingle; a document may
lose all its lines and is then empty; repeated rows count as later copies;
other columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.bits import BitTable, bit_table
from tickwise.llm.common import cut, fresh_name, releasing, slices, utf8, written
from tickwise.llm.components import components

SIMILARITY = 0.8
SHINGLE_CHARS = 7
BANDS = 14
ROWS = 5
GROUP_LINES = 1024
GROUP_BYTES = 4 << 20
SEEN_LINES = 500_000
BLOCK_KEYS = 1 << 20  # band keys that a task holds before it cuts them by range
RANGE_BYTES = 8 << 20  # text for each range of keys
LEAST_RANGES = 256
HELD_KEYS = 1 << 23  # keys of one range that are held at a time
TASK_RANGES = 8  # ranges of a task
SMALL_BYTES = 2048  # groups compared as sets
PIECE_BYTES = 1 << 18
VISIBLE = re.compile(rb"[^\x00-\x20]")

MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x100000001B3
EMPTY = np.uint64((1 << 64) - 1)
SIZE_BIT = 29


def lines_of(text: bytes) -> list[bytes]:
    return text.split(b"\n")


def line_id(line: bytes) -> int:
    """The 64-bit hash by which candidate lines meet; six bits of it tell the line's size."""
    return xxhash.xxh64_intdigest(line) & ~(63 << SIZE_BIT) | len(line).bit_length() << SIZE_BIT


def line_bytes(ids: np.ndarray) -> np.ndarray:
    """At most twice the sizes of lines, from their ids."""
    return np.int64(1) << (ids >> np.uint64(SIZE_BIT) & np.uint64(63)).astype(np.int64)


def line_digest(line: bytes) -> bytes:
    """The 128-bit identity of a line."""
    return xxhash.xxh3_128_digest(line)


def _runs(codes: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of every run of ``size`` codes; runs are doubled, not walked."""
    if len(codes) < size:
        return np.array([], np.uint64)
    if size == 1:
        return codes.copy()
    half = _runs(codes, size // 2)
    step = size // 2
    n = len(codes) - 2 * step + 1
    out = half[:n] * np.uint64(pow(BASE, step, 1 << 64))
    out += half[step:step + n]
    if size % 2:
        out = out[:-1] * np.uint64(BASE)
        out += codes[size - 1:]
    return out


def shingle_hashes(lines: list[bytes], chars: int = SHINGLE_CHARS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``lines``, and the number of the line that each is of."""
    codes = [line.decode("utf-8", "replace").encode("utf-32-le") for line in lines]
    sizes = np.array([len(c) // 4 for c in codes])
    # shorter lines are padded to one shingle; a pad is no character
    padded = np.maximum(sizes, chars)
    flat = np.frombuffer(b"".join(c if n >= 4 * chars else c + b"\xff" * (4 * chars - n)
                                  for c in codes for n in (len(c),)), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(lines)), padded)
    h = _runs(flat, chars)
    whole = owner[:len(h)] == owner[chars - 1:chars - 1 + len(h)]
    h, owner = h[whole], owner[:len(whole)][whole]
    h ^= h >> np.uint64(31)
    h *= MIX
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h, owner


def band_keys(lines: list[bytes], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A matrix with the band keys of every line."""
    bins = bands * rows
    h, owner = shingle_hashes(lines)
    at = owner * bins + ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    flat = np.full(len(lines) * bins, EMPTY, np.uint64)
    np.minimum.at(flat, at, h & np.uint64(0xFFFFFFFF))
    signature = flat.reshape(-1, bins)
    # an empty bin asks other bins, in an order of its own that is the same for all lines
    source = signature.copy()
    line, col = np.nonzero(signature == EMPTY)
    attempt = 0
    while len(line):
        attempt += 1
        ask = ((col.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(attempt)) * MIX >> np.uint64(33)) % np.uint64(bins)
        if attempt > 8 * bins:
            ask = ((col + attempt) % bins).astype(np.uint64)  # then in turn
        got = source[line, ask.astype(np.int64)]
        found = got != EMPTY
        signature[line[found], col[found]] = got[found] + np.uint64(attempt << 32)
        line, col = line[~found], col[~found]
    keys = np.empty((len(lines), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(lines), b + 1, np.uint64)
        for r in range(rows):
            key = (key ^ (key >> np.uint64(30))) * MIX + signature[:, b * rows + r]
        keys[:, b] = key * np.uint64(0xBF58476D1CE4E5B9)
    return keys


def _pieces(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, column, PIECE_BYTES)


def _new_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[int, bytes]]:
    """The visible lines of a task's texts by id, each about once, ``PIECE_BYTES`` at a time."""
    seen: set[int] = set()
    new: dict[int, bytes] = {}
    size = 0
    for piece in _pieces(batches, "text"):
        for raw in utf8(piece.column(0)):
            for line in lines_of(raw):
                if VISIBLE.search(line) and (i := line_id(line)) not in seen and i not in new:
                    new[i] = line
                    size += len(line)
                    if size >= PIECE_BYTES:
                        yield new
                        if len(seen) > SEEN_LINES:
                            seen.clear()
                        seen.update(new)
                        new, size = {}, 0
    if new:
        yield new


def key_ranges(docs: DataFrame, text: str) -> int:
    """How many ranges band keys are cut into: by the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(LEAST_RANGES, total // RANGE_BYTES)


def band_blocks(docs: DataFrame, text: str, ranges: int, group_lines: int = GROUP_LINES) -> DataFrame:
    """(range, kind, key, keys, lines): the band keys of every line, in sorted blocks of one key range.

    Kind 1 holds pairs of key and line. A key of over ``group_lines`` lines in a block is large:
    its lines are kind 2, spread over all ranges, and kind 0 tells its own range of it.
    """

    def cut_up(keys: np.ndarray, lines: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(keys)
        keys, lines = keys[order], lines[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        large = sizes > group_lines
        for s, n in zip(starts[large].tolist(), sizes[large].tolist(), strict=True):
            key = int(keys[s])
            yield _range_of(keys[s:s + 1], ranges)[0], 0, key, b"", b""
            for i in range(s, s + n, group_lines):
                part = lines[i:min(i + group_lines, s + n)].tobytes()
                yield xxhash.xxh64_intdigest(part) % ranges, 2, key, b"", part
        rest = ~np.repeat(large, sizes)
        keys, lines = keys[rest], lines[rest]
        places = _range_of(keys, ranges)  # in order, as the keys are
        edges = np.flatnonzero(np.r_[True, places[1:] != places[:-1]]) if len(keys) else []
        for s, e in zip(edges, np.r_[edges[1:], len(keys)] if len(keys) else [], strict=True):
            yield places[s], 1, 0, keys[s:e].tobytes(), lines[s:e].tobytes()

    def run(batches):
        keys, lines, held = [], [], 0
        for new in _new_lines(batches):
            ids = np.fromiter(new, np.uint64, len(new))
            keys.append(band_keys(list(new.values())).ravel())
            lines.append(np.repeat(ids, BANDS))
            held += len(keys[-1])
            if held >= BLOCK_KEYS:
                yield _block_batch(cut_up(np.concatenate(keys), np.concatenate(lines)))
                keys, lines, held = [], [], 0
        if held:
            yield _block_batch(cut_up(np.concatenate(keys), np.concatenate(lines)))

    return docs.select(F.col(text).alias("text")).mapInArrow(
        releasing(run), "range int, kind int, key long, keys binary, lines binary")


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each key; ranges are in the order of keys."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _block_batch(rows: Iterable[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    types = [pa.int32(), pa.int32(), pa.uint64(), pa.binary(), pa.binary()]
    arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
    arrays[2] = arrays[2].view(pa.int64())
    return pa.RecordBatch.from_arrays(arrays, ["range", "kind", "key", "keys", "lines"])


def _whole_groups(blocks: DataFrame, ranges: int, group_lines: int, group_bytes: int) -> DataFrame:
    """(large, number, line): the lines of keys with two or more, and those of large keys under the key."""
    placed = blocks.repartition(-(-ranges // TASK_RANGES), "range").sortWithinPartitions("range", "kind")

    def run(batches):
        out: list[tuple[bool, int, np.ndarray]] = []
        told: set[int] = set()  # large keys of the range
        keys: list[np.ndarray] = []
        lines: list[np.ndarray] = []

        def batch() -> pa.RecordBatch:
            rows = [np.concatenate([np.full(len(p), v, t) for v, p in ((o[k], o[2]) for o in out)])
                    for k, t in ((0, bool), (1, np.uint64))] if out else [np.array([], bool), np.array([], np.uint64)]
            line = np.concatenate([o[2] for o in out]) if out else np.array([], np.uint64)
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[0]), pa.array(rows[1].view(np.int64)), pa.array(line.view(np.int64))],
                ["large", "number", "line"])

        def pairs() -> tuple[np.ndarray, np.ndarray]:
            """Held pairs by key and line, each once; lone ones of keys that are not large are left out."""
            key, line = np.concatenate(keys), np.concatenate(lines)
            order = np.argsort(key)
            key, line = key[order], line[order]
            same = key[1:] == key[:-1]
            stays = np.r_[False, same] | np.r_[same, False]
            if told:
                stays |= np.isin(key, np.fromiter(told, np.uint64, len(told)))
            key, line = key[stays], line[stays]
            order = np.lexsort((line, key))
            key, line = key[order], line[order]
            if len(key):
                once = np.r_[True, (key[1:] != key[:-1]) | (line[1:] != line[:-1])]
                key, line = key[once], line[once]
            return key, line

        def groups(key: np.ndarray, line: np.ndarray) -> None:
            if not len(key):
                return
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            weight = np.add.reduceat(line_bytes(line), starts)
            for s, e, w in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], weight.tolist(), strict=True):
                k = int(key[s])
                if k in told or e - s > group_lines or (w > group_bytes and e - s > 2):
                    out.append((True, k, line[s:e]))
                elif e - s > 1:
                    out.append((False, xxhash.xxh64_intdigest(line[s:e].tobytes()), line[s:e]))

        def relieve() -> None:
            """Too many pairs of a range: what has become a large key goes on; the rest is kept, each once."""
            key, line = np.concatenate(keys), np.concatenate(lines)
            order = np.lexsort((line, key))
            key, line = key[order], line[order]
            once = np.r_[True, (key[1:] != key[:-1]) | (line[1:] != line[:-1])]
            key, line = key[once], line[once]
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            told.update(key[starts[sizes > group_lines]].tolist())
            big = np.isin(key, np.fromiter(told, np.uint64, len(told)))
            groups(key[big], line[big])
            keys[:], lines[:] = [key[~big]], [line[~big]]

        current, held = None, 0
        for rows in batches:
            for place, kind, k, a, b in zip(*[c.to_pylist() for c in rows.columns], strict=True):
                if place != current:
                    if keys:
                        groups(*pairs())
                    keys, lines, held, current = [], [], 0, place
                    told.clear()
                if kind == 0:
                    told.add(k & (1 << 64) - 1)
                elif kind == 2:
                    out.append((True, k & (1 << 64) - 1, np.frombuffer(b, np.uint64)))
                else:
                    keys.append(np.frombuffer(a, np.uint64))
                    lines.append(np.frombuffer(b, np.uint64))
                    held += len(keys[-1])
                    if held > HELD_KEYS:
                        relieve()
                        held = len(keys[0]) // 2  # so that the next time comes later
            if out:
                yield batch()
        if keys:
            groups(*pairs())
        if out:
            yield batch()

    return placed.mapInArrow(releasing(run), "large boolean, number long, line long").distinct()


def candidate_groups(blocks: DataFrame, ranges: int, group_lines: int = GROUP_LINES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(group, line): distinct lines that share a band key, large groups as pairs of chunks.

    Groups of the same lines, as near-equal lines give in most bands, get the
    same number and are one group.
    """
    found = cut(_whole_groups(blocks, ranges, group_lines, group_bytes))
    small = found.filter("NOT large").select(F.col("number").alias("group"), "line")
    large = found.filter("large")
    size = F.expr(f"shiftleft(1L, cast(shiftright(line, {SIZE_BIT}) & 63 AS int))")
    parts = F.greatest(F.ceil(F.lit(2) * F.count(F.lit(1)) / group_lines),
                       F.ceil(F.lit(2) * F.sum(size) / group_bytes))
    counts = written(large.groupBy("number").agg(parts.cast("int").alias("chunks")), "large")
    chunk = F.pmod(F.xxhash64("line"), F.col("chunks"))
    dealt = (large.join(counts, "number").withColumn("chunk", chunk.cast("int"))
             .select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
             .filter("chunk <> other OR chunks = 1"))
    return small.unionAll(dealt.select(F.xxhash64("number", F.least("chunk", "other"), F.greatest("chunk", "other"))
                                       .alias("group"), "line"))


def lines_in(docs: DataFrame, text: str, table: BitTable) -> DataFrame:
    """(line, content): the distinct lines whose hash the table holds."""
    shared = docs.sparkSession.sparkContext.broadcast(table.parts())

    def run(batches):
        bits, seen = BitTable(*shared.value), set()
        for piece in _pieces(batches, "text"):
            lines = [x for raw in utf8(piece.column(0)) for x in lines_of(raw)]
            ids = np.fromiter((line_id(x) for x in lines), np.uint64, len(lines))
            new = {}
            for k in np.flatnonzero(bits.holds(ids)).tolist():
                if (i := int(ids[k])) not in seen:
                    new[lines[k]] = i
            if len(seen) > SEEN_LINES:
                seen.clear()
            seen.update(new.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.fromiter(new.values(), np.uint64, len(new)).view(np.int64)),
                 pa.array([x.decode("utf-8", "replace") for x in new], pa.string())], ["line", "content"])

    return (docs.select(F.col(text).alias("text")).mapInArrow(releasing(run), "line long, content string")
            .groupBy("line").agg(F.collect_set("content").alias("contents"))
            .select("line", F.explode("contents").alias("content")))


def linked(lines: list[bytes], similarity: float) -> list[tuple[int, int]]:
    """Edges between line numbers that connect the lines as their links do."""
    if sum(map(len, lines)) <= SMALL_BYTES:
        return _linked_sets(lines, similarity)
    return _linked_arrays(lines, similarity)


def _linked_sets(lines: list[bytes], similarity: float) -> list[tuple[int, int]]:
    """``linked`` on sets of shingles: less to set up for a few short lines."""
    sets = []
    for line in lines:
        text = line.decode("utf-8", "replace")
        sets.append({text[i:i + SHINGLE_CHARS] for i in range(max(1, len(text) - SHINGLE_CHARS + 1))})
    edges, alive = [], list(range(len(lines)))
    while alive:
        queue = [alive.pop(0)]
        while queue and alive:
            x = queue.pop()
            own, rest = sets[x], []
            for y in alive:
                common = len(own & sets[y])
                if common >= similarity * (len(own) + len(sets[y]) - common):
                    edges.append((x, y))
                    queue.append(y)
                else:
                    rest.append(y)
            alive = rest
    return edges


def _linked_arrays(lines: list[bytes], similarity: float) -> list[tuple[int, int]]:
    """``linked`` on arrays of shingle hashes."""
    h, owner = shingle_hashes(lines)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
    column, owner = np.unique(h[first], return_inverse=True)[1], owner[first]
    start = np.searchsorted(owner, np.arange(len(lines) + 1))
    size, mark = np.diff(start), np.zeros(column.max() + 1, np.int32)
    edges, own = [], {}

    def columns(x: int) -> np.ndarray:
        return column[start[x]:start[x + 1]]

    def gather(rest: np.ndarray) -> None:
        own["all"] = np.concatenate([columns(x) for x in rest])
        own["start"] = np.r_[0, np.cumsum(size[rest])[:-1]]

    packed = np.arange(len(lines))  # the lines whose columns are gathered
    gather(packed)
    alive = np.ones(len(lines), bool)  # not linked so far
    while alive.any():
        seed = int(np.argmax(alive))
        alive[seed] = False
        queue = [seed]
        while queue and alive.any():
            x = queue.pop()
            if 2 * alive.sum() < len(packed):  # what is linked costs no more
                packed = np.flatnonzero(alive)
                gather(packed)
            mark[columns(x)] = 1
            common = np.add.reduceat(mark[own["all"]], own["start"])
            mark[columns(x)] = 0
            near = alive[packed] & (common >= similarity * (size[packed] + size[x] - common))
            hits = packed[near].tolist()
            alive[hits] = False
            edges += [(x, y) for y in hits]
            queue += hits
    return edges


def group_edges(groups: DataFrame, contents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v): digests of lines whose exact similarity reaches the threshold."""
    placed = (groups.join(contents, "line").select("group", "content")
              .repartition("group").sortWithinPartitions("group"))

    def run(batches):
        number, lines = None, []
        out: list[tuple[bytes, bytes]] = []

        def close() -> None:
            if len(lines) > 1:
                digests = [line_digest(x) for x in lines]
                for a, b in linked(lines, similarity):
                    out.append((min(digests[a], digests[b]), max(digests[a], digests[b])))

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([e[k] for e in out], pa.binary()) for k in (0, 1)], ["u", "v"])
            out.clear()
            return batch

        for batch in batches:
            for g, line in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                if g != number:
                    close()
                    number, lines = g, []
                lines.append(line)
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    return placed.mapInArrow(releasing(run), "u binary, v binary")


def occurrences(docs: DataFrame, row_key: str, text: str) -> DataFrame:
    """(row_key, at, digest) of every line with a visible character."""

    def run(batches):
        for piece in _pieces(batches, "text"):
            keys, places, digests = [], [], []
            for key, raw in zip(piece.column(0).to_pylist(), utf8(piece.column(1)), strict=True):
                for at, line in enumerate(lines_of(raw)):
                    if VISIBLE.search(line):
                        keys.append(key)
                        places.append(at)
                        digests.append(line_digest(line))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(places, pa.int32()), pa.array(digests, pa.binary())],
                ["row_key", "at", "digest"])

    return (docs.select(F.col(row_key).alias("row_key"), F.col(text).alias("text"))
            .mapInArrow(releasing(run), "row_key long, at int, digest binary"))


def line_roots(docs: DataFrame, text: str, similarity: float = SIMILARITY, group_lines: int = GROUP_LINES,
               group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(node, root): digests of lines that link to other lines, and their component."""
    ranges = key_ranges(docs, text)
    blocks = band_blocks(docs, text, ranges, group_lines)
    groups = cut(candidate_groups(blocks, ranges, group_lines, group_bytes))
    contents = lines_in(docs, text, bit_table(groups, "line"))
    return components(group_edges(groups, contents, similarity))


def dropped_lines(docs: DataFrame, row_key: str, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """(row_key, dropped): the numbers of the lines to drop, of rows that lose any."""
    roots = line_roots(docs, text, similarity)
    found = occurrences(docs, row_key, text)
    # written, so that the join below deals its own rows out and a very common line is split
    found = written(found.join(roots, found["digest"] == roots["node"], "left")
                    .select("row_key", "at", F.coalesce("root", "digest").alias("root")), "lines")
    firsts = written(found.groupBy("root").agg(F.count(F.lit(1)).alias("n"),
                                               F.min(F.struct("row_key", "at")).alias("first"))
                     .filter("n > 1").select("root", "first"), "firsts")
    return (found.join(firsts, "root").filter(F.struct("row_key", "at") != F.col("first"))
            .groupBy("row_key").agg(F.collect_set("at").alias("dropped")))


def dedup_lines(docs: DataFrame, row_key: str, text: str, n_dropped: str | None = None,
                similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the dropped lines cut from ``text``; optionally how many, in ``n_dropped``."""
    gone, mask = (fresh_name(n, docs.columns) for n in ("dropped_lines", "dropped_mask"))
    drops = cut(dropped_lines(docs, row_key, text, similarity)
                .select(F.col("row_key").alias(row_key), F.sort_array("dropped").alias(gone)))
    return without_lines(docs.join(drops, row_key, "left"), text, gone, mask, n_dropped).select(
        *docs.columns, *([n_dropped] if n_dropped else []))


def without_lines(rows: DataFrame, text: str, gone: str, mask: str, n_dropped: str | None = None) -> DataFrame:
    """``rows`` with the lines numbered by the sorted array ``gone`` cut from ``text``.

    ``mask`` (a new column) has a byte for each line up to the last that goes, so
    that a line is judged in constant time.
    """
    marks = F.transform(gone, lambda x, i: F.concat(
        F.repeat(F.lit("0"), x - F.coalesce(F.get(gone, i - 1), F.lit(-1)) - 1), F.lit("1")))
    rows = rows.withColumn(mask, F.array_join(marks, "").cast("binary"))
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: F.substring(mask, i + 1, F.lit(1)) != F.lit(b"1")), "\n")
    rows = rows.withColumn(text, F.when(F.col(gone).isNull(), F.col(text)).otherwise(kept))
    return rows.withColumn(n_dropped, F.coalesce(F.size(gone), F.lit(0)).cast("long")) if n_dropped else rows
