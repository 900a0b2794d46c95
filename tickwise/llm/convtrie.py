"""Conversation prefix trie (operator 11): burst tries over turn ids.

A node of the trie is a distinct sequence of first turns; its members are the
conversations that start so. A turn is known by a 128-bit id of its role and text.

1. Turns are put in order by one range sort; positions follow from places inside
   partitions and one row per partition, so a long conversation is never gathered.
2. A conversation is cut into segments of ``SEGMENT_TURNS`` turns. The trie head of a
   segment stands for all turns before it, so the segments of a conversation
   are placed side by side, not one after the other. Equal segments under a head
   are one suffix with a count. A conversation that ends where a segment does has
   one more, empty segment, so that every member of a node at that depth is in
   the container of the next head.
3. Every head starts with one container of suffixes. A container over
   ``CONTAINER_TURNS`` turns bursts: the turns that all its suffixes share become
   heads, and its suffixes go to new containers by their next turn id. This is
   repeated until all containers are small; shared runs are skipped in one round.
4. The remaining containers are dealt to tasks, sorted, and swept into nodes.
   Nodes above a burst are aggregated from the suffixes that passed it.
5. Sums over subtrees need no walk up the tree. A node belongs to its smallest
   member; T(c) is the sum of the weights of the nodes that belong to c. A node's
   subtree sum is then the sum of T over its members, less the weights of nodes
   that belong to its own smallest member and lie above it. Leaves likewise.
   So a second sweep of the same containers with T as the value is enough.

A node is named by (smallest member, depth), which is unique.

Bounds: a container is held by one task and has ``CONTAINER_TURNS`` turns at most;
windows run over ``SEGMENT_BLOCK`` segments or ``DEPTH_BLOCK`` depths. The ids of
conversations that end at one node are strung together in many tasks; only the
digest itself, which SHA-256 can compute in order alone, is streamed by one task.

Defined cases: a null role or text is empty; null turns come first; turns of one
number are ordered by role, then by text; rows without a conversation id belong
to none and are left out; repeated rows are turns of their own; an empty table has
no nodes; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import cut, written

SEGMENT_TURNS = 256
CONTAINER_TURNS = 1 << 15
SEGMENT_BLOCK = 12  # as a power of two
DEPTH_BLOCK = 16  # as a power of two
ID_BYTES = 16
CHUNK_IDS = 512
ROOT = bytes(ID_BYTES)
BATCH_ROWS = 20_000


def short_digest(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, 2 * ID_BYTES))


def ordered_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, id, chars): the turns of every conversation by their place in it, from 0."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    by = F.coalesce(F.col(role).cast("string"), F.lit(""))
    told = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), by.alias("role"), said.alias("text"),
        # the length in front keeps role and text apart
        short_digest(F.concat_ws(":", F.octet_length(by), by, said).cast("binary")).alias("id"))
    rows = cut(told.withColumn("chars", F.char_length("text").cast("long")).drop("text"))
    # texts are sorted, and so shuffled, only where turns tie
    tied = written(rows.groupBy("conv", "turn", "role").agg(F.min("id").alias("a"), F.max("id").alias("b"))
                   .filter("a <> b"), "tied")
    place = told["conv"].eqNullSafe(tied["conv"]) & told["turn"].eqNullSafe(tied["turn"]) & (told["role"] == tied["role"])
    texts = told.join(tied, place, "left_semi").select("id", "conv", F.col("text").alias("tie")).distinct()
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]
    placed = rows.join(texts, ["conv", "id"], "left").repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "id", "chars")

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            at = []
            for c in batch.column(0).to_pylist():
                n = n + 1 if c == last else 0
                last = c
                at.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int64())],
                ["conv", "id", "chars", "part", "at"])

    numbered = cut(placed.mapInArrow(number, "conv long, id binary, chars long, part int, at long"))
    # one row per partition: how many turns of its first conversation lie in partitions before
    ends = (numbered.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "at")).alias("last"))
            .orderBy("part").collect())
    carry, before, open_conv = [], 0, None
    for e in ends:
        start = before if e["first"] == open_conv else 0
        if start:
            carry.append((e["part"], e["first"], start))
        before = e["last"]["at"] + 1 + (start if e["first"] == e["last"]["conv"] else 0)
        open_conv = e["last"]["conv"]
    extra = numbered.sparkSession.createDataFrame(carry, "part int, conv long, before long")
    return (numbered.join(F.broadcast(extra), ["part", "conv"], "left")
            .select("conv", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "id", "chars"))


def with_shared_openings(turns: DataFrame, source: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first turns replaced by those of another.

    ``source`` and ``shared`` are expressions over ``conv``: the first ``shared`` (at most
    ``most``) turns of conversation ``source`` come in place of its own. Returns the turns and
    all conversations (``conv``), also those that have no turn left.
    """
    openers = cut(turns.filter(F.col("pos") <= most).groupBy("conv")
                  .agg(F.sort_array(F.collect_list(F.struct("pos", "id", "chars"))).alias("first")))
    given = openers.select(F.col("conv").alias("source"), F.col("first").alias("given"))
    taken = F.slice(F.coalesce("given", F.array().cast(openers.schema["first"].dataType)), 1, F.col("shared"))
    convs = cut(openers.select("conv", source.alias("source"), shared.cast("int").alias("shared"))
                .join(given, "source", "left").select("conv", "shared", taken.alias("opening")))
    opening = convs.select("conv", F.explode("opening").alias("o")).select("conv", "o.*")
    # only conversations whose source is shorter move their own turns forward
    moved = convs.select("conv", (F.size("opening") - F.col("shared")).alias("move")).filter("move <> 0")
    own = (turns.filter(F.col("pos") >= shared).join(moved, "conv", "left")
           .select("conv", (F.col("pos") + F.coalesce("move", F.lit(0))).alias("pos"), "id", "chars"))
    return opening.unionByName(own), convs.select("conv")


def segments(turns: DataFrame, convs: DataFrame, size: int) -> DataFrame:
    """(conv, seg, path, chars, last, head, next, row): the segments of every conversation.

    ``path`` strings turn ids together; ``head`` stands for all turns before, ``next`` (of a
    full segment) for those up to its end; ``row`` names head and path.
    """
    sized = turns.withColumn("seg", F.floor(F.col("pos") / size).cast("long"))
    lists = cut(sized.groupBy("conv", "seg")
                .agg(F.sort_array(F.collect_list(F.struct("pos", "id", "chars"))).alias("t"))
                .select("conv", "seg", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["id"])), ""))
                        .alias("path"), F.transform("t", lambda x: x["chars"]).alias("chars")))
    full = F.size("chars") == size
    # where a conversation may end: at its start and after each full segment
    stops = (convs.select("conv", F.lit(0).cast("long").alias("seg"))
             .unionAll(lists.filter(full).select("conv", F.col("seg") + 1)))
    rows = lists.unionByName(stops.join(lists, ["conv", "seg"], "left_anti").select(
        "conv", "seg", F.lit(b"").alias("path"), F.array().cast("array<bigint>").alias("chars")))
    rows = rows.withColumn("last", ~full)
    for k in (1, 2):
        rows = rows.withColumn(f"s{k}", F.xxhash64(F.lit(k), "seg", "path").cast("decimal(20,0)"))
    single = rows.filter("seg = 0 AND last").withColumn("head", F.lit(ROOT)).withColumn(
        "next", F.lit(None).cast("binary"))
    # segments of longer conversations: running sums, by blocks of segments
    many = rows.filter("seg > 0 OR NOT last").withColumn("block", F.shiftright("seg", SEGMENT_BLOCK))
    deep = many.join(many.filter("block > 0").select("conv").distinct(), "conv", "left_semi")
    blocks = deep.groupBy("conv", "block").agg(F.sum("s1").alias("b1"), F.sum("s2").alias("b2"))
    w = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", F.sum("b1").over(w).alias("b1"), F.sum("b2").over(w).alias("b2"))
    inside = Window.partitionBy("conv", "block").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    wide = "decimal(38,0)"
    many = many.join(blocks, ["conv", "block"], "left")
    for k in (1, 2):
        many = many.withColumn(f"p{k}", F.coalesce(F.sum(f"s{k}").over(inside).cast(wide), F.lit(0).cast(wide))
                               + F.coalesce(F.col(f"b{k}").cast(wide), F.lit(0).cast(wide)))

    def name(seg: Column, *sums: Column) -> Column:
        return short_digest(F.concat_ws(",", seg, *[s.cast(wide) for s in sums]).cast("binary"))

    many = (many.withColumn("head", F.when(F.col("seg") == 0, F.lit(ROOT)).otherwise(
                name(F.col("seg"), F.col("p1"), F.col("p2"))))
            .withColumn("next", F.when(~F.col("last"), name(F.col("seg") + 1, F.col("p1") + F.col("s1"),
                                                            F.col("p2") + F.col("s2")))))
    names = ["conv", "seg", "path", "chars", "last", "head", "next"]
    return (single.select(*names).unionByName(many.select(*names))
            .withColumn("row", short_digest(F.concat("head", "path"))))


def _depth(path: str) -> Column:
    """The number of turns of a path."""
    return F.floor(F.octet_length(path) / ID_BYTES).cast("int")


def burst(suffixes: DataFrame, container_turns: int) -> tuple[DataFrame, DataFrame]:
    """Containers and heads of the suffixes.

    Returns the suffixes with ``container`` (null if they end at a head), ``low`` (the depth of
    the container's top), ``bursts`` (all that they passed) and ``up`` (the last of these), and
    the bursts: one row each with the run of depths ``low`` to ``high`` that its suffixes share.
    """
    none = F.lit(None).cast("binary")
    active = (suffixes.withColumn("container", F.col("head")).withColumn("low", F.lit(0))
              .withColumn("bursts", F.array().cast("array<binary>")).withColumn("up", none))
    done = None
    while True:
        # written tables, as their known sizes decide how they are joined
        big = written(active.filter("container IS NOT NULL").groupBy("container")
                      .agg(F.sum(_depth("path") - F.col("low") + 1).alias("turns"))
                      .filter(F.col("turns") > container_turns).select("container"), "big")
        if big.isEmpty():
            break
        least = F.expr("size(filter(sequence(0, least(octet_length(a), octet_length(b)) div 16), "
                       "i -> substring(a, 1, cast(16 * i AS int)) = substring(b, 1, cast(16 * i AS int)))) - 1")
        shared = ("low", "up", "head", "seg")
        heads = active.join(big, "container").groupBy("container").agg(
            F.min("path").alias("a"), F.max("path").alias("b"),
            *[F.min_by(c, "path").alias(c) for c in ("chars", "row", "next")], *[F.min(c).alias(c) for c in shared])
        # the smallest path is the shared run itself if some suffix ends there
        ends = F.octet_length("a") == 16 * F.col("high")
        heads = written(heads.withColumn("high", least).select(
            F.col("container").alias("burst"), *shared, "high", "chars",
            *[F.when(ends, F.col(c)).alias(c) for c in ("row", "next")]), "heads")
        done = heads if done is None else done.unionByName(heads)
        here = F.col("high").isNotNull()
        onward = F.when(_depth("path") > F.col("high"), short_digest(F.concat(
            "container", F.expr("substring(path, 16 * high + 1, 16)"))))
        active = cut(active.join(heads.select(F.col("burst").alias("container"), "high"), "container", "left").select(
            *suffixes.columns, F.when(here, onward).otherwise(F.col("container")).alias("container"),
            F.when(here, F.col("high") + 1).otherwise(F.col("low")).alias("low"),
            F.when(here, F.array_append("bursts", F.col("container"))).otherwise(F.col("bursts")).alias("bursts"),
            F.when(here, F.col("container")).otherwise(F.col("up")).alias("up")))
    if done is None:
        done = active.limit(0).select(
            F.col("container").alias("burst"), "low", "up", "head", "seg", F.lit(0).alias("high"), "chars", "row", "next")
    return cut(active), done


NODE = "conv long, depth long, n long, value long, leaves long, chars long, parent_conv long, children long"
RECORD = NODE + ", up binary, kids_of binary, head binary, link binary, row binary"


def swept(placed: DataFrame, size: int) -> DataFrame:
    """Records (``RECORD``) of every node below the heads; a container is sorted and swept by one task.

    ``placed`` has the values ``n``, ``conv``, ``value`` and ``leaves`` of every suffix. A record at the
    end of a full segment is a link to the next head, not a node.
    """
    names = ["container", "path", "low", "up", "head", "seg", "chars", "row", "next", "n", "conv", "value", "leaves"]
    rows = (placed.filter("container IS NOT NULL").select(*names)
            .repartition("container").sortWithinPartitions("container", "path"))
    fields = [f.strip().split(" ") for f in RECORD.split(",")]
    types = [{"long": pa.int64(), "binary": pa.binary()}[t] for _, t in fields]

    def sweep(group: list[tuple]) -> Iterator[list]:
        nodes: list[list] = []
        parents: list[int] = []
        opened: list[int] = []  # the open node of each depth from the top
        before = b""
        for _, path, low, up, head, seg, chars, row, link, n, conv, value, leaves in group:
            depth = len(path) // ID_BYTES
            if not opened:
                same = low - 1
            else:
                same = min(depth, len(before) // ID_BYTES)
                while path[:same * ID_BYTES] != before[:same * ID_BYTES]:
                    same -= 1
            del opened[same - low + 1:]
            for d in range(same + 1, depth + 1):
                top = d == low
                if not top:
                    nodes[opened[-1]][7] += 1
                parents.append(-1 if top else opened[-1])
                opened.append(len(nodes))
                nodes.append([conv, seg * size + d, 0, 0, 0, chars[d - 1] if d else None, None, 0,
                              up if top else None, None, head if d == 0 and seg else None, None, None])
            for at in opened:
                node = nodes[at]
                node[0] = min(node[0], conv)
                node[2] += n
                node[3] += value
                node[4] += leaves
            nodes[opened[-1]][11 if depth == size else 12] = link if depth == size else row
            before = path
        for node, parent in zip(nodes, parents, strict=True):
            node[6] = None if parent < 0 else nodes[parent][0]
            yield node

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, out = [], []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                [f[0] for f in fields])
            out.clear()
            return batch

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if group and row[0] != group[0][0]:
                    out.extend(sweep(group))
                    group = []
                    if len(out) >= BATCH_ROWS:
                        yield flush()
                group.append(row)
        if group:
            out.extend(sweep(group))
        if out:
            yield flush()

    return rows.mapInArrow(run, RECORD)


def head_records(placed: DataFrame, heads: DataFrame, size: int) -> DataFrame:
    """Records (``RECORD``) of the nodes above bursts, from the suffixes that passed them."""
    sums = (placed.select(F.explode("bursts").alias("burst"), "n", "conv", "value", "leaves").groupBy("burst")
            .agg(F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n", "value", "leaves")]))
    runs = sums.join(heads, "burst").select("*", F.explode(F.sequence("low", "high")).alias("d"))
    d, top, end = F.col("d"), F.col("d") == F.col("low"), F.col("d") == F.col("high")
    return runs.select(
        "conv", (F.col("seg") * size + d).alias("depth"), "n", "value", "leaves",
        F.when(d > 0, F.try_element_at("chars", F.greatest(d, F.lit(1)))).alias("chars"),
        F.when(~top, F.col("conv")).alias("parent_conv"), F.when(~end, F.lit(1).cast("long")).alias("children"),
        F.when(top, F.col("up")).alias("up"), F.when(end, F.col("burst")).alias("kids_of"),
        F.when((d == 0) & (F.col("seg") > 0), F.col("head")).alias("head"),
        F.when(end & (d == size), F.col("next")).alias("link"), F.when(end & (d < size), F.col("row")).alias("row"))


def linked(records: DataFrame) -> DataFrame:
    """Nodes of all records: those next to a burst or a head get their parents and counts of children."""
    named = F.col("up").isNotNull() | F.col("kids_of").isNotNull()
    kids = records.filter("up IS NOT NULL").groupBy(F.col("up").alias("burst")).agg(
        F.count(F.lit(1)).alias("kids"))
    owners = records.filter("kids_of IS NOT NULL").select(F.col("kids_of").alias("burst"), F.col("conv").alias("owner"))
    ends = records.filter(named).join(kids.withColumnRenamed("burst", "kids_of"), "kids_of", "left")
    ends = ends.join(owners.withColumnRenamed("burst", "up"), "up", "left")
    plain = [c for c in records.columns if c not in ("parent_conv", "children")]
    ends = ends.select(*plain, F.coalesce("parent_conv", "owner").alias("parent_conv"),
                       F.coalesce("children", "kids", F.lit(0)).alias("children"))
    known = records.filter(~named).unionByName(ends)
    above = known.filter("link IS NOT NULL").select(F.col("link").alias("head"), F.col("parent_conv").alias("above"),
                                                    F.col("chars").alias("said"))
    tops = known.filter("head IS NOT NULL").join(above, "head").withColumn(
        "parent_conv", F.col("above")).withColumn("chars", F.col("said")).drop("above", "said")
    nodes = known.filter("link IS NULL AND head IS NULL").unionByName(tops)
    return nodes.select("conv", "depth", "n", F.coalesce("chars", F.lit(0)).alias("chars"), "parent_conv",
                        "children", "row")


def end_digests(ends: DataFrame) -> DataFrame:
    """(row, ends_sha256) of (row, conv): the digest of a row's ids in order, joined by commas."""
    order = ["row", "conv"]

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, ids = None, []
        for batch in batches:
            out = []
            for r, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if r != row or len(ids) == CHUNK_IDS:
                    if ids:
                        out.append((row, ids[0], ",".join(map(str, ids))))
                    row, ids = r, []
                ids.append(c)
            yield _chunk_batch(out)
        if ids:
            yield _chunk_batch([(row, ids[0], ",".join(map(str, ids)))])

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, state = None, None
        for batch in batches:
            out = []
            for r, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if r != row:
                    if state:
                        out.append((row, state.hexdigest()))
                    row, state = r, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield _digest_batch(out)
        if state:
            yield _digest_batch([(row, state.hexdigest())])

    strung = (ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(chunks, "row binary, first long, ids string"))
    return (strung.repartition("row").sortWithinPartitions("row", "first")
            .mapInArrow(digests, "row binary, ends_sha256 string"))


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                       pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows], pa.string())], ["row", "first", "ids"])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                       pa.array([r[1] for r in rows], pa.string())], ["row", "ends_sha256"])


def weight_above(nodes: DataFrame, weight: Column) -> DataFrame:
    """``nodes`` with ``above``: the weights of nodes of the same smallest member that lie above."""
    rows = nodes.withColumn("w", weight).withColumn("block", F.shiftright("depth", DEPTH_BLOCK))
    deep = rows.join(rows.filter("block > 0").select("conv").distinct(), "conv", "left_semi")
    w = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (deep.groupBy("conv", "block").agg(F.sum("w").alias("w"))
              .select("conv", "block", F.sum("w").over(w).alias("before")))
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return (rows.withColumn("above", F.coalesce(F.sum("w").over(inside), zero))
            .join(blocks, ["conv", "block"], "left")
            .withColumn("above", F.col("above") + F.coalesce("before", zero)).drop("w", "block", "before"))


def trie_nodes(turns: DataFrame, convs: DataFrame, segment_turns: int = SEGMENT_TURNS,
               container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The nodes of the prefix trie of all conversations.

    ``turns`` has columns ``conv``, ``pos`` (from 0, without gaps), ``id`` (16 bytes) and ``chars``; ``convs``
    every conversation once. Columns of the result: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    parts = written(segments(turns, convs, segment_turns), "segments")
    suffixes = cut(parts.groupBy("row", "head", "seg", "path", "chars", "next")
                   .agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")))
    placed, heads = burst(suffixes, container_turns)

    def records(values: DataFrame) -> DataFrame:
        return swept(values, segment_turns).unionByName(head_records(values, heads, segment_turns))

    zero = F.lit(0).cast("long")
    first = cut(records(placed.withColumn("value", zero).withColumn("leaves", zero)))
    nodes = cut(linked(first))
    weight = (F.col("n") - 1) * F.col("chars")
    own = nodes.groupBy("conv").agg(F.sum(weight).alias("value"),
                                    F.sum(F.when(F.col("children") == 0, 1).otherwise(0)).alias("leaves"))
    passed = (parts.select("conv", "row").join(own, "conv").groupBy("row")
              .agg(F.sum("value").alias("value"), F.sum("leaves").alias("leaves")))
    valued = placed.join(passed, "row", "left").withColumn("value", F.coalesce("value", zero)).withColumn(
        "leaves", F.coalesce("leaves", zero))
    # (a node's records of both sweeps have the same name; links name no node and find none)
    sums = records(valued).filter("link IS NULL").select("conv", "depth", "value", "leaves")
    digests = end_digests(parts.filter("last").select("row", "conv"))
    empty = hashlib.sha256(b"").hexdigest()
    return (weight_above(nodes, weight).join(sums, ["conv", "depth"]).join(digests, "row", "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
                    F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                    F.col("leaves").alias("n_leaves"), (F.col("value") - F.col("above")).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", **limits: int) -> DataFrame:
    """The trie of a table of turns as it is; see ``trie_nodes``."""
    turns = ordered_turns(conversations, conv_id, turn, role, text)
    return trie_nodes(turns, turns.select("conv").distinct(), **limits)
