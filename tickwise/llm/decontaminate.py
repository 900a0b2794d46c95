"""Benchmark decontamination (operator 6): a prefix-filtered join of shingle sets.

Every benchmark item is cut into windows of ``window`` consecutive words (an
item of fewer words is one window). A window occurs in a document where its
words stand in a row. Steps:

1. Windows are made of word shingles. How often each shingle occurs is counted
   over all documents, and a window's shingles are ordered by that rarity.
2. Containment must be whole, so the necessary prefix of a window is its rarest
   shingle alone; a window with a shingle that no document holds is dropped.
3. Documents are scanned for prefix shingles. Each hit is joined with the windows
   of that prefix by hash; positional and length bounds discard pairs whose
   window would not fit around the hit, and the words themselves are compared.
4. Hit words and items are summed up for each document.

Scale. Before the shuffle, document shingles are tested against a bit table of
the benchmark's shingles. The table is at most ``FILTER_BITS`` bits (4 MB),
whatever the benchmark's size; beyond that it lets more rows pass and loses none.
Joins are on hashes, so a passage that a third of the documents share is a skewed
join, which adaptive execution splits.

Defined cases: a null text has no words; an item without words has no window; a
document without words has no hits; repeated documents are judged one by one,
items with equal ids are one item, a null item id counts as the empty string.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.bits import BitTable, bit_table
from tickwise.llm.common import append_columns, cut, releasing, slices, utf8, written

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
MEMO_BYTES = 64
MEMO_WORDS = 400_000
VOCABULARY_WORDS = 200_000
PIECE_BYTES = 1 << 20

# Bytes of words kept, A-Z lower-cased; every other ASCII byte parts words.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) or 1  # 0 stands for a word of no item


class WordHashes(dict):
    """Hashes of words; short ones are kept, and the memo is emptied when full."""

    def __missing__(self, word: bytes) -> int:
        value = word_hash(word)
        if len(word) <= MEMO_BYTES:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = value
        return value


def shingle_hashes(words: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the runs of ``size`` words that start at ``at`` (default: everywhere)."""
    if at is None:
        at = np.arange(max(0, len(words) - size + 1))
    h = np.full(len(at), size, np.uint64)
    for k in range(size):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words[at + k]
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


class Scanner:
    """Finds the shingles of a bit table in many texts at once.

    With a vocabulary, words outside it count as 0 and no shingle with one is
    looked at; without, every word is hashed.
    """

    def __init__(self, parts: tuple, sizes: list[int], vocabulary: dict[bytes, int] | None):
        self.bits, self.sizes, self.vocabulary = BitTable(*parts), sizes, vocabulary
        self.memo = WordHashes()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if self.vocabulary is None:
            memo = self.memo
            return np.array([memo[w] for w in words], np.uint64)
        known = self.vocabulary.get
        return np.array([known(w, 0) for w in words], np.uint64)

    def scan(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """All words, where each text's words begin, and by shingle size (places, hashes)."""
        words, bounds = [], [0]
        for t in texts:
            words += words_of(t)
            bounds.append(len(words))
        hashes, bounds = self.hashes(words), np.array(bounds)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        known, found = hashes != 0, {}
        for size in self.sizes:
            n = max(0, len(words) - size + 1)
            inside = owner[:n] == owner[size - 1:size - 1 + n]
            for k in range(size):
                inside &= known[k:n + k]
            at = np.flatnonzero(inside)
            h = shingle_hashes(hashes, size, at)
            hit = self.bits.holds(h)
            found[size] = at[hit], h[hit]
        return words, bounds, found


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct (item, window, n): the windows of every item, words joined by a space."""

    def cut_up(batches):
        for batch in batches:
            ids, texts, sizes = [], [], []
            for item, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = words_of(raw)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    part = words[i:i + window]
                    ids.append(item)
                    texts.append(b" ".join(part).decode("utf-8", "replace"))
                    sizes.append(len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(sizes, pa.int32())],
                ["item", "window", "n"])

    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                        F.col(text).alias("text"))
    return rows.mapInArrow(releasing(cut_up), "item string, window string, n int").distinct()


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(window, n, at, size, h) of every shingle of every window; at is its place in words."""

    def hash_all(batches):
        for batch in batches:
            memo, out = WordHashes(), []
            for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = np.array([memo[w] for w in text.encode().split(b" ")], np.uint64)
                size = min(shingle, n)
                out += [(text, n, at, size, h) for at, h in
                        enumerate(shingle_hashes(words, size).view(np.int64).tolist())]
            cols = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, (
                    pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
                ["window", "n", "at", "size", "h"])

    return windows.mapInArrow(releasing(hash_all), "window string, n int, at int, size int, h long")


def scanner_parts(shingles: DataFrame) -> tuple:
    """What a task needs to find these shingles; bounded whatever their number.

    The words of their windows are sent along unless there are over
    ``VOCABULARY_WORDS``; then tasks hash every word and find the same.
    """
    sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect())
    words = (shingles.select(F.explode(F.split("window", " ")).alias("word")).distinct()
             .limit(VOCABULARY_WORDS + 1).collect())
    vocabulary = None
    if len(words) <= VOCABULARY_WORDS:
        vocabulary = {(w := r["word"].encode()): word_hash(w) for r in words}
    return bit_table(shingles, "h").parts(), sizes, vocabulary


def shingle_counts(docs: DataFrame, text: str, parts: tuple) -> DataFrame:
    """(h, n): occurrences over all documents of the shingles that the scanner finds."""
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def count(batches):
        scanner = Scanner(*shared.value)
        for batch in batches:
            for piece in slices(batch, "text", PIECE_BYTES):
                _, _, found = scanner.scan(list(utf8(piece.column(0))))
                h, n = np.unique(np.concatenate([np.array([], np.uint64), *(h for _, h in found.values())]),
                                 return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())],
                                                 ["h", "n"])

    return (docs.select(F.col(text).alias("text")).mapInArrow(releasing(count), "h long, n long")
            .groupBy("h").agg(F.sum("n").alias("n")))


HITS = T.ArrayType(T.StructType([
    T.StructField("h", T.LongType()), T.StructField("pos", T.IntegerType()),
    T.StructField("lead", T.IntegerType()), T.StructField("around", T.StringType())]))


def prefix_hits(docs: DataFrame, text: str, parts: tuple, window: int) -> DataFrame:
    """``docs`` with n_words and the places of prefix shingles in place of ``text``.

    A hit holds the words that a window around it could cover; ``lead`` of them
    stand before it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    struct = pa.struct([("h", pa.int64()), ("pos", pa.int32()), ("lead", pa.int32()), ("around", pa.string())])

    def make():
        scanner = Scanner(*shared.value)

        def work(texts: list[bytes]) -> list[pa.Array]:
            words, bounds, found = scanner.scan(texts)
            rows: list[list[dict]] = [[] for _ in texts]
            for size, (places, hashes) in found.items():
                owners = np.searchsorted(bounds, places, "right") - 1
                for p, h, k in zip(places.tolist(), hashes.view(np.int64).tolist(), owners.tolist(), strict=True):
                    low, high = int(bounds[k]), int(bounds[k + 1])
                    start = max(low, p - window + size)
                    rows[k].append({"h": h, "pos": p - low, "lead": p - start, "around": b" ".join(
                        words[start:min(p + window, high)]).decode("utf-8", "replace")})
            return [pa.array(np.diff(bounds), pa.int64()), pa.array(rows, pa.list_(struct))]

        return work

    return append_columns(docs, text, [T.StructField("n_words", T.LongType(), False),
                                       T.StructField("hits", HITS, False)], make, max_bytes=PIECE_BYTES)


def contamination(docs: DataFrame, row_key: str, text: str, items: DataFrame, item_id: str, item_text: str,
                  window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """row_key, n_words, n_hit and items (sorted array of item ids) of every document."""
    spark = docs.sparkSession
    docs = docs.select(F.col(row_key).alias("row_key"), F.col(text).alias("text"))
    places = cut(item_windows(items, item_id, item_text, window))
    shingles = cut(window_shingles(places.select("window", "n").distinct(), shingle))
    counts = shingle_counts(docs, "text", scanner_parts(shingles))
    # rarest shingle first; a window with a shingle that occurs nowhere cannot occur
    prefix = cut(shingles.join(counts.withColumnRenamed("n", "seen"), "h", "left")
                 .groupBy("window", "n")
                 .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "at", "size", "h")).alias("p"))
                 .filter("p.seen > 0").select("window", "n", "p.at", "p.size", "p.h"))
    scanned = cut(prefix_hits(docs, "text", scanner_parts(prefix), window))
    hits = scanned.select("row_key", F.inline("hits"))
    fits = (F.col("lead") >= F.col("at")) & (F.array_join(F.slice(
        F.split("around", " "), F.col("lead") - F.col("at") + 1, F.col("n")), " ") == F.col("window"))
    found = cut(hits.join(prefix, "h").filter(F.when(F.col("lead") >= F.col("at"), fits).otherwise(False))
                .select("row_key", (F.col("pos") - F.col("at")).alias("start"), "n", "window"))
    covered = F.aggregate(
        F.sort_array(F.collect_set(F.struct("start", "n"))),
        F.struct(F.lit(0).alias("words"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["words"] + F.greatest(F.lit(0), x["start"] + x["n"] - F.greatest(a["end"], x["start"])))
            .alias("words"), F.greatest(a["end"], x["start"] + x["n"]).alias("end")),
        lambda a: a["words"].cast("long"))
    words = found.groupBy("row_key").agg(covered.alias("n_hit"))
    held = (found.select("row_key", "window").distinct().join(places.select("item", "window"), "window")
            .groupBy("row_key").agg(F.sort_array(F.collect_set("item")).alias("items")))
    none = F.array().cast("array<string>")
    return (scanned.select("row_key", "n_words")
            .join(words.join(held, "row_key"), "row_key", "left")
            .select("row_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", none).alias("items")))


def remove_contaminated(docs: DataFrame, row_key: str, text: str, items: DataFrame, item_id: str,
                        item_text: str) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item."""
    hit = contamination(docs, row_key, text, items, item_id, item_text).filter("n_hit > 0")
    return docs.join(written(hit.select(F.col("row_key").alias(row_key)), "hit"), row_key, "left_anti")
