"""Toxicity by compression distance (operator 1).

Two zstandard dictionaries are trained, one on toxic and one on ordinary
windows. A window is a word (a piece of at most ``WINDOW_BYTES`` of a longer
one). Its contrast is the compressed length with the ordinary dictionary less
that with the toxic one. How many windows of a text reach a contrast threshold, and
the next higher one, and their share, is what a score is made of; threshold and
score curve are calibrated on all labelled training rows.

Training. Toxic windows are the words that hold a run of bytes which stands in
significantly more contexts of toxic than of ordinary texts, in a bounded sample: ``TOXIC_TEXTS`` and ``ORDINARY_TEXTS``
labelled texts by hash order; the ``TOXIC_WORDS`` strongest runs and most frequent words
of them make the toxic dictionary. The ordinary dictionary is trained on ``DICTIONARY_TEXTS``
ordinary texts of that sample of at most ``SAMPLE_BYTES`` bytes, by hash order. These bounds are parameters; what
reaches the driver is bounded by them. Samples of less than ``TRAINED_FROM`` times a
dictionary's size are too few to train on and are the dictionary themselves, whole.
Scoring and calibration read every text.

A window is compressed between two runs of a padding character, with literals
left uncompressed, so that a length counts what the dictionary did not explain.

Defined cases: null and empty texts have no windows and get the score of a text
without toxic windows; a document with several labels is toxic if any says so;
null labels and labels of unknown documents are ignored; where there is nothing to
tell by (no toxic labels, no ordinary ones, or no run of bytes that is significantly
more frequent in either) no document is called toxic: every score is 0;
repeated documents are scored alike, other columns are dropped.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.common import append_columns, cut, releasing, utf8
from tickwise.llm.decontaminate import words_of

TOXIC_TEXTS = 2000
ORDINARY_TEXTS = 4000
DICTIONARY_TEXTS = 2000
SAMPLE_BYTES = 16_384
TOXIC_WORDS = 20_000
TOXIC_DICTIONARY = 8_192
ORDINARY_DICTIONARY = 112_640
TRAINED_FROM = 4  # samples of so many dictionaries' size are trained on; fewer are taken whole
WINDOW_BYTES = 24
GRAM_BYTES = 5
RATE = 8  # times as frequent among toxic contexts as among ordinary ones
MEMO_WORDS = 400_000
PADDING = b"~" * 20
LEVELS = 6  # contrasts that are counted: 1, 2, ... LEVELS
LOW_CELLS, HIGH_CELLS = 31, 7  # larger counts are one cell of the calibration
RIDGE = 0.05
THRESHOLD = 0.3

# Every literal stays as it is and matches of four bytes count: lengths are then
# comparable between the dictionaries, and one window costs a few microseconds.
COMPRESSION = {"window_log": 18, "hash_log": 17, "chain_log": 6, "search_log": 1, "min_match": 4,
               "target_length": 1, "strategy": zstandard.STRATEGY_FAST, "write_content_size": 0,
               "write_checksum": 0, "write_dict_id": 0}


def windows_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, A-Z lower-cased; longer words in pieces."""
    words = words_of(text)
    if max(map(len, words), default=0) <= WINDOW_BYTES:
        return words
    return [w[i:i + WINDOW_BYTES] for w in words for i in range(0, len(w), WINDOW_BYTES)]


def runs_of(window: bytes) -> set[bytes]:
    """The runs of GRAM_BYTES bytes of a window between spaces; the whole of a shorter one."""
    padded = b" " + window + b" "
    return {padded[i:i + GRAM_BYTES] for i in range(max(1, len(padded) - GRAM_BYTES + 1))}


class Contrast(dict):
    """Contrast of windows, from 0 to LEVELS; emptied when full."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        params = zstandard.ZstdCompressionParameters(**COMPRESSION)
        self.by = []
        for content in (ordinary, toxic):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.by.append(zstandard.ZstdCompressor(compression_params=params, dict_data=d).compress)

    def __missing__(self, window: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        padded = PADDING + b" " + window + b" " + PADDING
        value = self[window] = min(max(len(self.by[0](padded)) - len(self.by[1](padded)), 0), LEVELS)
        return value


def training_labels(labels: DataFrame, doc_id: str, toxic: str, train: Column) -> DataFrame:
    """(doc_id, toxic 0 or 1) of the labelled documents to learn from."""
    return (labels.select(F.col(doc_id).alias("doc_id"), F.col(toxic).cast("int").alias("toxic"))
            .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & train)
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))


def word_counts(sample: DataFrame) -> DataFrame:
    """(window, toxic, ordinary): in how many contexts of texts of either kind a window stands.

    A context is the window's two neighbours, counted once for each kind, so
    that copies of a text weigh little more than the text.
    """

    def distinct(batches):
        for batch in batches:
            for toxic, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = [b"", *windows_of(raw), b""]
                found = list({(w, xxhash.xxh32_intdigest(a + b" " + c))
                              for a, w, c in zip(words, words[1:], words[2:], strict=False)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in found], pa.binary()), pa.array([c for _, c in found], pa.int64()),
                     pa.array([toxic] * len(found), pa.int32())], ["window", "context", "toxic"])

    return (sample.select("toxic", "text").mapInArrow(releasing(distinct), "window binary, context long, toxic int")
            .distinct().groupBy("window")
            .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("ordinary")))


def _grams(window: str) -> Column:
    """``runs_of`` as a column."""
    padded = F.concat(F.lit(b" "), F.col(window), F.lit(b" "))
    runs = F.greatest(F.octet_length(padded) - GRAM_BYTES, F.lit(0)) + 1
    return F.array_distinct(F.transform(F.sequence(F.lit(1), runs),
                                        lambda i: F.substring(padded, i, F.lit(GRAM_BYTES))))


def _dictionary(size: int, samples: list[bytes], segment: int) -> bytes:
    """A dictionary trained on the samples, or all of them where they are too few to train on."""
    joined = b" ".join(samples)
    if len(joined) > TRAINED_FROM * size:
        try:
            return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
        except zstandard.ZstdError:
            pass
    return joined or b" "


def train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> tuple[bytes, bytes] | None:
    """The toxic and the ordinary dictionary; None without labels of both kinds or a run that tells them apart."""
    order = F.xxhash64("doc_id")
    ids = None
    for kind, most in ((1, TOXIC_TEXTS), (0, ORDINARY_TEXTS)):
        part = labels.filter(F.col("toxic") == kind).orderBy(order, "doc_id").limit(most)
        ids = part if ids is None else ids.unionByName(part)
    ids = cut(ids)  # TOXIC_TEXTS + ORDINARY_TEXTS rows at most
    sample = cut(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
                 .join(F.broadcast(ids), "doc_id").select("toxic", "text"))
    counts = cut(word_counts(sample))
    n_toxic, n_ordinary = counts.agg(F.coalesce(F.sum("toxic"), F.lit(0)),
                                     F.coalesce(F.sum("ordinary"), F.lit(0))).first()
    if not n_toxic or not n_ordinary:
        return None
    # Runs of GRAM_BYTES bytes inside words, by the signed log-likelihood ratio of
    # their contexts' kinds against the kinds' shares of all contexts; those above
    # what chance gives any of so many runs mark a word as toxic, so that words
    # seen once count by what they share with others.
    grams = counts.select("window", "toxic", "ordinary", F.explode(_grams("window")).alias("gram"))
    summed = cut(grams.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))
    n_grams = summed.count()
    both = F.col("toxic") + F.col("ordinary")
    share = n_toxic / (n_toxic + n_ordinary)

    def part(seen: Column, of: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (both * of))).otherwise(0.0)

    ratio = part(F.col("toxic"), share) + part(F.col("ordinary"), 1 - share)
    rarely = F.col("toxic") / n_toxic > RATE * F.col("ordinary") / n_ordinary
    marks = cut(summed.filter((F.col("toxic") > 2) & rarely).withColumn("ratio", ratio)
                .filter(F.col("ratio") > math.log(max(n_grams, 2)) + 3)
                .orderBy(F.desc("ratio"), "gram").limit(TOXIC_WORDS).select("gram"))
    hot = (grams.filter(rarely & (F.col("toxic") > 0)).join(F.broadcast(marks), "gram")
           .groupBy("window").agg(F.first("toxic").alias("toxic"))
           .orderBy(F.desc("toxic"), "window").limit(TOXIC_WORDS).collect())
    if not hot:
        return None
    weight = max(1, sum(r["toxic"] for r in hot) // 100_000)
    words = [bytes(r["window"]) for r in hot for _ in range(max(1, r["toxic"] // weight))]
    random.Random(0).shuffle(words)
    toxic = [b" " + b" ".join(words[i:i + 16]) + b" " for i in range(0, len(words), 16)]
    rows = (sample.filter((F.col("toxic") == 0) & (F.octet_length("text") <= SAMPLE_BYTES))
            .orderBy(F.xxhash64("text"), "text").limit(DICTIONARY_TEXTS).collect())
    # what marks a word as toxic is left out of the ordinary windows
    marked = {bytes(r["gram"]) for r in marks.collect()}
    ordinary = [b" " + b" ".join(w for w in windows_of(r["text"].encode())
                                 if marked.isdisjoint(runs_of(w))) + b" " for r in rows]
    return _dictionary(TOXIC_DICTIONARY, toxic, 16), _dictionary(ORDINARY_DICTIONARY, ordinary, 32)


def window_counts(docs: DataFrame, text: str, dictionaries: tuple[bytes, bytes]) -> DataFrame:
    """``docs`` with ``counts`` in place of ``text``: all windows, then those of contrast 1 and more, ..."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def make():
        contrast = Contrast(*shared.value)

        def work(texts: list[bytes]) -> list[pa.Array]:
            rows = []
            for t in texts:
                by = np.bincount([contrast[w] for w in windows_of(t)], minlength=LEVELS + 1)
                rows.append(by[::-1].cumsum()[::-1].tolist())
            return [pa.array(rows, pa.list_(pa.int32()))]

        return work

    return append_columns(docs, text, [T.StructField("counts", T.ArrayType(T.IntegerType()), False)], make)


def evidence(level: Column | int) -> dict[str, Column]:
    """What a text's score is made of, in few values: windows of contrast ``level`` and of
    the next one, and the share of the former among all (in doublings of a tenth of a percent)."""
    low, high = F.element_at("counts", F.lit(level) + 1), F.element_at("counts", F.lit(level) + 2)
    share = F.try_divide(low * 1000.0, F.element_at("counts", 1))
    return {"low": F.least(low, F.lit(LOW_CELLS)), "high": F.least(high, F.lit(HIGH_CELLS)),
            "share": F.floor(F.log2(1 + F.coalesce(share, F.lit(0.0)))).cast("int")}


def _features(low: np.ndarray, high: np.ndarray, share: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(low)), low > 0, np.log1p(low), high > 0, np.log1p(high), share], 1).astype(float)


def _fit(low, high, share, toxic, n) -> tuple[np.ndarray, float]:
    """Logistic curve over cells with counts ``n`` of which ``toxic``; its log-likelihood."""
    x = _features(low, high, share)
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (toxic - n * p) - RIDGE * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return w, float((toxic * np.log(p) + (n - toxic) * np.log(1 - p)).sum())


def calibrate(counted: DataFrame, labels: DataFrame) -> tuple[int, list[float]]:
    """Contrast threshold and curve of most likelihood over all labelled training rows.

    Spark sums the labels over cells of (threshold, evidence), which are all
    that reaches the driver; their number does not depend on the corpus.
    """
    at = F.explode(F.sequence(F.lit(1), F.lit(LEVELS - 1))).alias("level")
    cells = (counted.select("doc_id", "counts").join(labels, "doc_id").select("toxic", "counts", at)
             .withColumns(evidence(F.col("level"))).groupBy("level", "low", "high", "share")
             .agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).collect())
    fits = []
    for level in range(1, LEVELS):
        own = [r for r in cells if r["level"] == level]
        if own:
            w, likelihood = _fit(*(np.array([r[k] for r in own], float)
                                   for k in ("low", "high", "share", "toxic", "n")))
            fits.append((likelihood, -level, w.tolist()))
    if not fits:
        return 1, [-50.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    _, level, w = max(fits)
    return -level, w


def score_column(level: int, w: list[float]) -> Column:
    low, high, share = evidence(level).values()
    terms = (F.lit(1.0), (low > 0).cast("double"), F.log1p(low), (high > 0).cast("double"), F.log1p(high), share)
    return 1 / (1 + F.exp(-sum((t * F.lit(v) for t, v in zip(terms, w, strict=True)), F.lit(0.0))))


def toxicity(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, row_key: str | None = None,
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id (and ``row_key``), score and predicted of every row of ``docs``.

    ``labels`` holds (doc_id, toxic) to learn from, see ``training_labels``.
    """
    labels = cut(labels)
    keys = [F.col(row_key).alias("row_key")] if row_key else []
    rows = docs.select(F.col(doc_id).alias("doc_id"), *keys, F.col(text).alias("text"))
    names = [c for c in rows.columns if c != "text"]
    dictionaries = train(docs, labels, doc_id, text)
    if dictionaries is None:
        scored = rows.select(*names, F.lit(0.0).alias("score"))
    else:
        counted = cut(window_counts(rows, "text", dictionaries))
        scored = counted.select(*names, score_column(*calibrate(counted, labels)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
