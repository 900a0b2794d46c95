"""Filter interaction audit (operator 12): contingency tensors of five filters.

Every document passes or fails each filter; a part of the corpus (a language) is
thus a table of 2 x 2 x 2 x 2 x 2 counts, and so are its good and its toxic
documents. Whatever a filter order does is a contraction of these tensors: along
each axis one selects pass, fail, or all, so no order needs a pass over the rows.

1. One Arrow pass over the texts computes the failure conditions ``A`` to ``D``
   and a digest of the text; the text itself goes no further.
2. Rows are joined to their labels and counted by (digest, conditions, part,
   labels, id). Condition ``E`` (an equal text with a smaller id exists) follows
   per digest from the smallest id of these counts, so that a text with
   very many copies is counted, never gathered.
3. The counts by (part, conditions) have 32 rows a part at most. One task per
   part reshapes them and contracts every step of all 120 orders by ``einsum``.

Defined cases: a null text is empty (it fails ``A`` only, and ``E`` like any
other repeated text); a null part is the empty string; a row without an id has
no smaller or larger id, so it never fails ``E`` nor makes others fail, and has
no labels; repeated rows of one id count each and are not copies of each other;
of several labels of an id any one that is set counts; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.common import append_columns, cut

FILTERS = "ABCDE"
# Fixed values of the contract: the limits of the conditions.
MIN_WORDS = 200
MIN_DISTINCT = 50  # per cent of the words
MAX_CAPITALS = 3  # per cent of the code points
SYMBOLS = re.compile(rb"[#$%&*|]")

CAPITALS = bytes(range(65, 91))
CONTINUATION = bytes(range(0x80, 0xC0))  # the UTF-8 bytes that start no code point

MEASURES = ("n", "good", "toxic")
OUT = T.StructType(
    [T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
     T.StructField("step", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in
       ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])


def conditions(raw: bytes) -> int:
    """The failure conditions ``A`` to ``D`` of a text as bits 0 to 3."""
    words = raw.split()  # bytes are split at the six ASCII blanks
    n, capitals = len(words), len(raw) - len(raw.translate(None, CAPITALS))
    points = len(raw.translate(None, CONTINUATION))
    return ((n < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT * n) << 1
            | (100 * capitals > MAX_CAPITALS * points) << 2 | (SYMBOLS.search(raw) is not None) << 3)


def judged(docs: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    """(doc_id, part, fails, digest) of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.col(text).alias("text"))

    def make():
        def work(texts):
            return [pa.array([conditions(t) for t in texts], pa.int32()),
                    pa.array([hashlib.sha256(t).digest()[:16] for t in texts], pa.binary())]
        return work

    return append_columns(rows, "text", [T.StructField("fails", T.IntegerType()),
                                         T.StructField("digest", T.BinaryType())], make)


def label_flags(labels: DataFrame, doc_id: str, quality: str, toxic: str) -> DataFrame:
    """(doc_id, good, toxic): whether any label of an id says so; one row an id."""
    return (labels.filter(F.col(doc_id).isNotNull())
            .groupBy(F.col(doc_id).alias("doc_id"))
            .agg(F.max(F.coalesce(F.col(quality) == 1, F.lit(False))).alias("good"),
                 F.max(F.coalesce(F.col(toxic) == 1, F.lit(False))).alias("toxic")))


def contingency(rows: DataFrame, flags: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): counts of each combination of all five conditions.

    ``rows`` as from ``judged``, ``flags`` as from ``label_flags``.
    """
    # equal rows of one id are counted before the join, so a repeated id is no hot key
    rows = cut(rows.groupBy("doc_id", "digest", "fails", "part").agg(F.count(F.lit(1)).alias("n")))
    rows = rows.join(flags, "doc_id", "left").select(
        "doc_id", "digest", "fails", "part", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    kind = ["digest", "fails", "part", "good", "toxic"]
    # a row without an id takes part in no comparison
    lone = rows.filter(F.col("doc_id").isNull()).select(*kind[1:], "n")
    numbered = (rows.filter(F.col("doc_id").isNotNull()).groupBy(*kind, "doc_id").agg(F.sum("n").alias("n"))
                .groupBy(*kind).agg(F.sum("n").alias("n"), F.min("doc_id").alias("low"),
                                    F.min_by("n", "doc_id").alias("n_low")))
    # a digest has a few rows here: one for each part and label
    least = numbered.groupBy("digest").agg(F.min("low").alias("least"))
    numbered = numbered.join(least, "digest").withColumn(
        "first", F.when(F.col("low") == F.col("least"), F.col("n_low")).otherwise(F.lit(0)))
    copies = numbered.select("part", "good", "toxic", (F.col("n") - F.col("first")).alias("n"),
                             (F.col("fails") + 16).alias("fails"))
    firsts = numbered.select("part", "good", "toxic", F.col("first").alias("n"), "fails")
    return (copies.unionByName(firsts).unionByName(lone).groupBy("part", "fails")
            .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")))


PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])


def contract(tensor: np.ndarray, select: list[np.ndarray]) -> int:
    """The sum of the cells that the selector of every axis (pass, fail, all) lets through."""
    return int(np.einsum("abcde,a,b,c,d,e->", tensor, *select))


def orders(counts: pd.DataFrame) -> pd.DataFrame:
    """Every step of all orders, from the counts of one part."""
    tensors = {}
    for m in MEASURES:
        cells = np.zeros(2 ** len(FILTERS), np.int64)
        np.add.at(cells, counts["fails"].to_numpy(), counts[m].to_numpy())
        # the lowest bit is the last axis of a reshape, so axes are turned round
        tensors[m] = cells.reshape((2,) * len(FILTERS)).transpose()
    axes = range(len(FILTERS))

    def at(m: str, passed, failed=None) -> int:
        return contract(tensors[m], [FAIL if x == failed else PASS if x in passed else ALL for x in axes])

    fails = [at("n", (), x) for x in axes]
    unique = [at("n", [y for y in axes if y != x], x) for x in axes]
    rows, shapley = [], [0] * len(FILTERS)
    for order in permutations(axes):
        for step, x in enumerate(order):
            removed = at("n", order[:step], x)
            shapley[x] += removed
            rows.append([counts["part"].iat[0], "".join(FILTERS[y] for y in order), step + 1,
                         at("n", order[:step + 1]), removed, fails[x] - removed, unique[x],
                         at("good", order[:step], x), at("toxic", order[:step], x), x])
    out = pd.DataFrame(rows, columns=OUT.names)
    out["shapley"] = [shapley[x] for x in out["shapley"]]
    return out


def filter_audit(docs: DataFrame, doc_id: str, text: str, part: str, labels: DataFrame,
                 label_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """One row per part, filter order and step (columns ``OUT``); see the module."""
    counts = contingency(judged(docs, doc_id, text, part), label_flags(labels, label_id, quality, toxic))
    return counts.groupBy("part").applyInPandas(orders, OUT)
