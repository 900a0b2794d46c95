"""SimHash near-duplicates (operator 7) by the generalised pigeonhole principle.

A fingerprint has a bit set where over half of a text's shingle hashes have it
set. Texts link when their fingerprints differ in at most ``distance`` bits, and
linked texts form components.

Search. The 64 bits are grouped into partitions of correlated bits. Partition i
gets its own threshold t_i >= -1, and if the thresholds satisfy
``sum(t_i + 1) = distance + 1``, two fingerprints within ``distance`` bits differ
in at most t_i bits of some partition (a partition with -1 is not searched). A
dynamic program picks the thresholds of least estimated work: probe rows plus
candidate pairs, estimated from the joint values of every two bits, counted over
all fingerprints, so that the estimate knows the correlation that groups bits. A fingerprint probes
every partition value within t_i bits of its own; rows that meet in a bucket are
verified on all 64 bits.

Scale. Equal fingerprints are one row, so copies cost nothing. Inside a bucket
candidates are not paired: a search that drops each fingerprint once it is linked
yields at most one edge fewer than the bucket has members, and visits a dense
group about once. A bucket over ``BUCKET_ROWS`` is dealt to chunk pairs by hash,
which together see every pair. Nothing of the corpus reaches the driver but 64
by 64 bit counts.

Defined cases: null and empty texts have fingerprint zero and link like any
other; texts shorter than a shingle have one shingle, their whole word sequence;
repeated rows and repeated or null ids are kept, a component's id is its smallest
id that is not null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.common import append_columns, cut, releasing, written
from tickwise.llm.components import components

BITS = 64
SEED = 42
SHINGLE_WORDS = 3
DISTANCE = 3

# Members of a bucket that one task compares; larger buckets are dealt out.
BUCKET_ROWS = 1024
# Groups up to this size are compared by shifting whole batches against themselves.
SHIFT_ROWS = 8
# Work of one verified candidate in units of one probe row (estimated; any value is correct).
PAIR_COST = 0.05


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a UTF-8 text, as an unsigned number."""
    words = text.lower().split()  # both ASCII only on bytes
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    hash_of = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [hash_of(joined, SEED)]
    else:
        hashes = [hash_of(joined[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=False)]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(rows: DataFrame, text: str, out: str = "fingerprint",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``rows`` with the fingerprint of ``text`` (bigint) in its place."""

    def make():
        return lambda texts: [pa.array(np.array([fingerprint(t, shingle) for t in texts], np.uint64)
                                       .view(np.int64))]

    return append_columns(rows, text, [T.StructField(out, T.LongType(), False)], make)


def bit_statistics(codes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of codes and, for bits i and j, how many codes have both set."""

    def count(batches):
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(raw.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float32)
            both += bits.T @ bits
            n += len(raw)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(BITS * BITS + 1), pa.int32()),
                 pa.array([*both.ravel().astype(np.int64).tolist(), n], pa.int64())], ["cell", "n"])

    cells = codes.mapInArrow(releasing(count), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = {r["cell"]: r["n"] for r in cells.collect()}  # 64 * 64 + 1 numbers
    both = np.array([found.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)
    return found.get(BITS * BITS, 0), both


def correlation(n: int, both: np.ndarray) -> np.ndarray:
    """The absolute correlation of every two bits."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    return np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))


def differences(n: int, both: np.ndarray) -> np.ndarray:
    """For bits i and j: the share of code pairs that differ in both (on the diagonal: in the bit).

    From the counted joint values of the two bits, so correlated bits show as such.
    """
    p11 = both / max(n, 1)
    p = p11.diagonal()
    p10, p01 = p[:, None] - p11, p[None, :] - p11
    return np.clip(2 * (p11 * (1 - p11 - p10 - p01) + p10 * p01), 0.0, 1.0)


def within(differ: np.ndarray, group: list[int], distance: int) -> list[float]:
    """For t up to ``distance``: the estimated share of pairs that differ in at most t bits of ``group``.

    The bits' differences are taken as a tree, in which each depends on the one it shares
    most information with (the best approximation of their joint distribution by counted pairs).
    """
    p = np.clip(differ.diagonal(), 0.0, 1.0)

    def joint(u: int, v: int) -> np.ndarray:
        """Probabilities of (u differs, v differs)."""
        d = min(differ[u, v], p[u], p[v])
        return np.maximum([[1 - p[u] - p[v] + d, p[v] - d], [p[u] - d, d]], 0.0)

    def information(u: int, v: int) -> float:
        cells, even = joint(u, v), np.outer([1 - p[u], p[u]], [1 - p[v], p[v]])
        seen = (cells > 1e-12) & (even > 1e-12)
        return float((cells[seen] * np.log(cells[seen] / even[seen])).sum())

    parent = {group[0]: -1}
    best = {v: (information(group[0], v), group[0]) for v in group[1:]}
    while best:
        v = max(best, key=lambda b: (best[b][0], -b))
        parent[v] = best.pop(v)[1]
        for w in best:
            best[w] = max(best[w], (information(v, w), v), key=lambda x: x[0])
    # counts[v][d]: distribution of the differing bits in v's subtree, given whether v differs
    counts = {v: [np.eye(1, distance + 2, d)[0] for d in (0, 1)] for v in group}
    for v in reversed(parent):
        u = parent[v]
        if u < 0:
            total = (1 - p[v]) * counts[v][0] + p[v] * counts[v][1]
            return [float(total[:t + 1].sum()) for t in range(distance + 1)]
        cells = joint(u, v)
        for d in (0, 1):
            given = cells[d] / cells[d].sum() if cells[d].sum() > 0 else np.array([1 - p[v], p[v]])
            child = given[0] * counts[v][0] + given[1] * counts[v][1]
            counts[u][d] = np.convolve(counts[u][d], child)[:distance + 2]
    return [1.0] * (distance + 1)


def correlated_groups(phi: np.ndarray, parts: int, full: Callable[[list[int]], bool]) -> list[list[int]]:
    """All bits in at most ``parts`` groups, correlated bits together.

    A group starts with the bit most correlated with what is left and takes the bit most
    correlated with it until it is ``full``; the last takes the rest.
    """
    left, groups = set(range(BITS)), []
    while left:
        start = min(left, key=lambda b: (-phi[b, sorted(left)].sum(), b))
        group = [start]
        left.discard(start)
        while left and (len(groups) == parts - 1 or not full(group)):
            best = min(left, key=lambda b: (-phi[b, group].sum(), b))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost with ``sum(t_i + 1) = budget``; costs[i][t + 1] for t >= -1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for k, c in enumerate(row):
                if used + k <= budget and (used + k not in step or cost + c < step[used + k][0]):
                    step[used + k] = (cost + c, [*chosen, k - 1])
        best = step
    return best[budget]


def search_plan(n: int, both: np.ndarray, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the partitions to search, of the least estimated work.

    Groupings of equal sizes and of equal information (minus the logarithm of the share of
    pairs that agree on a group, so that a group of bits that repeat each other gets more of
    them) are weighed against each other.
    """
    phi, differ, plans = correlation(n, both), differences(n, both), []

    def information(group: list[int]) -> float:
        return -np.log(max(within(differ, group, 0)[0], 1e-30))

    whole = information(list(range(BITS)))
    for parts in range(1, 2 * (distance + 1) + 1):
        by_size = correlated_groups(phi, parts, lambda g, k=parts: len(g) * k >= BITS)
        by_information = correlated_groups(phi, parts, lambda g, k=parts: information(g) * k >= whole)
        for groups in (by_size, by_information):
            costs = []
            for g in groups:
                near = within(differ, g, distance)
                costs.append([0.0] + [
                    n * sum(comb(len(g), k) for k in range(t + 1)) + PAIR_COST * n * n / 2 * near[t]
                    for t in range(distance + 1)])
            cost, chosen = allocate(costs, distance + 1)
            plans.append((cost, [(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0]))
    return min(plans, key=lambda x: x[0])[1]


def _mask(bits: tuple[int, ...] | list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def probes(codes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """Rows (part, key, code): every partition value within the threshold of a code's own."""
    parts = F.array(*(F.struct(
        F.lit(i).alias("part"), F.lit(_mask(bits)).alias("mask"),
        F.array(*(F.lit(_mask(c)) for k in range(t + 1) for c in combinations(bits, k))).alias("flips"))
        for i, (bits, t) in enumerate(plan)))
    return (codes.select("code", F.inline(parts))
            .select("code", "part", "mask", F.explode("flips").alias("flip"))
            .select("part", F.col("code").bitwiseAND(F.col("mask")).bitwiseXOR(F.col("flip")).alias("key"),
                    "code"))


def _deal(rows: DataFrame, codes: DataFrame, plan: list[tuple[list[int], int]],
          bucket_rows: int) -> DataFrame:
    """``rows`` as (bucket, code), with the members of large buckets dealt to chunk pairs.

    Values held by over ``bucket_rows`` codes are counted first (one row for
    each code and partition, summed before the shuffle); a large bucket is one
    that such a value probes. Its members go to chunks by hash, and chunk a
    meets chunk b in bucket (a, b).
    """
    own = probes(codes, [(bits, 0) for bits, _ in plan]).groupBy("part", "key").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket_rows)
    large = written(own, "large")
    if large.isEmpty():
        return rows.select(F.xxhash64("part", "key").alias("bucket"), "code")
    hit = None
    for i, (bits, t) in enumerate(plan):
        flips = F.array(*(F.lit(_mask(c)) for k in range(t + 1) for c in combinations(bits, k)))
        one = large.filter(F.col("part") == i).select(
            "part", "n", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("key")))).alias("key"))
        hit = one if hit is None else hit.unionByName(one)
    chunks = written(hit.groupBy("part", "key").agg(
        (F.sum("n") / bucket_rows + 1).cast("int").alias("chunks")), "chunks")
    mine = F.pmod(F.xxhash64("code"), F.col("chunks")).cast("int")
    return (rows.join(chunks, ["part", "key"], "left")
            .withColumn("mine", F.coalesce(mine, F.lit(0)))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
            .select(F.xxhash64("part", "key", F.least("mine", "other"), F.greatest("mine", "other"))
                    .alias("bucket"), "code"))


def spanning_edges(codes: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Edges that connect ``codes`` (unsigned, distinct) as their links do, one fewer at most."""
    u, v, left = [], [], codes
    while left.size > 1:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= distance
            if near.any():
                hits = left[near]
                u += [x] * hits.size
                v += hits.tolist()
                queue += list(hits)
                left = left[~near]
    return u, v


def bucket_edges(buckets: DataFrame, distance: int) -> DataFrame:
    """Verified edges (u, v) of all buckets; rows arrive sorted, so groups are streamed."""
    placed = buckets.repartition("bucket").sortWithinPartitions("bucket")

    def edges_of(bucket: np.ndarray, code: np.ndarray) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[starts, len(bucket)])
        us, vs = [], []
        small = np.repeat((sizes > 1) & (sizes <= SHIFT_ROWS), sizes)
        b, c = bucket[small], code[small]
        for d in range(1, SHIFT_ROWS):
            if len(b) <= d:
                break
            x, y = c[:-d], c[d:]
            hit = (b[:-d] == b[d:]) & (x != y) & (np.bitwise_count(x ^ y) <= distance)
            us.append(x[hit])
            vs.append(y[hit])
        for s, n in zip(starts[sizes > SHIFT_ROWS], sizes[sizes > SHIFT_ROWS], strict=True):
            u, v = spanning_edges(np.unique(code[s:s + n]), distance)
            us.append(np.array(u, np.uint64))
            vs.append(np.array(v, np.uint64))
        u = np.concatenate(us) if us else np.array([], np.uint64)
        v = np.concatenate(vs) if vs else u
        if not u.size:
            return None
        pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(pairs[:, k]).view(np.int64)) for k in (0, 1)], ["u", "v"])

    def run(batches):
        bucket, code = np.array([], np.int64), np.array([], np.uint64)
        for batch in batches:
            bucket = np.concatenate([bucket, batch.column(0).to_numpy(zero_copy_only=False)])
            code = np.concatenate([code, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            # the last group may go on in the next batch
            whole = np.searchsorted(bucket, bucket[-1]) if len(bucket) else 0
            if whole and (out := edges_of(bucket[:whole], code[:whole])):
                yield out
            bucket, code = bucket[whole:], code[whole:]
        if len(bucket) and (out := edges_of(bucket, code)):
            yield out

    return placed.mapInArrow(releasing(run), "u long, v long")


def fingerprint_roots(prints: DataFrame, fingerprint: str = "fingerprint", distance: int = DISTANCE,
                      bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(code, root) of every distinct fingerprint; root names its component."""
    codes = cut(prints.select(F.col(fingerprint).alias("code")).distinct())
    n, both = bit_statistics(codes)
    if n == 0:
        return codes.withColumn("root", F.col("code"))
    plan = search_plan(n, both, distance)
    edges = bucket_edges(_deal(probes(codes, plan), codes, plan, bucket_rows), distance)
    roots = components(edges)
    return codes.join(roots, codes["code"] == roots["node"], "left").select(
        "code", F.coalesce("root", "code").alias("root"))


def simhash_components(docs: DataFrame, doc_id: str, text: str, shingle: int = SHINGLE_WORDS,
                       distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (bigint) and ``component_id`` of every row of ``docs``."""
    prints = cut(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                              "text", shingle=shingle))
    roots = cut(fingerprint_roots(prints, distance=distance))
    lowest = prints.groupBy(F.col("fingerprint").alias("code")).agg(F.min("doc_id").alias("low"))
    members = roots.join(lowest, "code")
    # kept, so that the join deals out both sides and a huge component is split
    ids = cut(members.groupBy("root").agg(F.min("low").alias("component_id")))
    component = cut(roots.join(ids, "root").select("code", "component_id"))
    return (prints.join(component, prints["fingerprint"] == component["code"])
            .select(F.col("doc_id").alias(doc_id), "fingerprint", "component_id"))


def keep_one_of_each(docs: DataFrame, row_key: str, doc_id: str, text: str,
                     shingle: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stand for their component: smallest id, then smallest row key."""
    prints = cut(fingerprints(docs.select(F.col(row_key).alias("row_key"), F.col(doc_id).alias("doc_id"),
                                          F.col(text).alias("text")), "text", shingle=shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row_key")).alias("first")
    lowest = prints.groupBy(F.col("fingerprint").alias("code")).agg(first)
    kept = (fingerprint_roots(prints, distance=distance).join(lowest, "code")
            .groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row_key").alias(row_key)))
    return docs.join(written(kept, "kept"), row_key, "left_semi")
