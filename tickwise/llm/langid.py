"""Language ID (operator 13): string kernels with Nystroem landmarks and kernel ridge regression.

Kernel. A text is lower-cased and every run of non-letters becomes one space;
its features are the 1-, 2- and 3-grams of code points that are present in it
(a blended spectrum without counts). k(x, y) is the number of grams that both
hold over the root of the product of their numbers of grams. Grams of up to three
code points fit 64 bits, so they are exact, not hashed.

Fit, on a bounded sample (``LANDMARKS`` and ``TRAINING`` texts a language, taken
by a hash of the row key from all labelled rows):

1. Landmarks: of each landmark text one piece of at most ``PIECE`` code points,
   cut at a place chosen by hash, so that the model is bounded whatever the texts.
2. The training texts, whole, become rows of kernel values against the landmarks
   in Spark tasks; K_mm^(-1/2) of the landmarks turns them into Nystroem features.
3. Ridge regression of +1 / -1 targets, one language versus the rest, solved once
   for all languages.

Scoring covers every whole text: the presence vectors of a batch of texts, over
the grams of the landmarks, times one matrix (landmark matrix times weights). A text
is read in windows that overlap by two code points and only its distinct grams
are kept; products are made over ranges of grams, so that no dense matrix follows
the number of landmarks' grams.

The score is the winner's softmax share. Defined cases: a null text, or one without
a letter, is ``UNKNOWN`` with score 0, as is every text when nothing is labelled; a
null language is no label; one learned language is always predicted; ties of the
regression go to the language first by name; rows are scored each on their own,
so repeated rows and ids get equal answers; a null id takes no part in the fit only.
The key given to ``fit`` must be unique, else the sample has no bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.common import append_columns, cut, written
from tickwise.operators.joins import sized_broadcast

UNKNOWN = "und"
LANDMARKS = 48
TRAINING = 600
PIECE = 3000
RIDGE = 0.05
SHARPNESS = 6.0  # of the softmax over regression values
WINDOW = 1 << 20  # code points read at a time
BATCH = 64  # texts of one matrix product
BLOCK = 1 << 16  # grams of one matrix product
POINT_BITS = 21

LETTER = regex.compile(r"\p{L}")
GAP = regex.compile(r"[^\p{L}]+")


def grams(text: str) -> list[np.ndarray]:
    """The distinct grams of 1, 2 and 3 code points of a text, each sorted."""
    found: list[np.ndarray] = []
    for start in range(0, max(len(text), 1), WINDOW):
        # a window holds the two code points before it, so no gram is missed
        piece = text[max(0, start - 2):start + WINDOW]
        codes = np.frombuffer(piece.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
        padded = np.concatenate([codes, np.zeros(2, np.uint64)])
        run = padded[:-2] << np.uint64(2 * POINT_BITS) | padded[1:-1] << np.uint64(POINT_BITS) | padded[2:]
        run = np.unique(run)
        found = [run] if not found else [np.union1d(found[0], run)]
    run = found[0]
    out = []
    for n in (1, 2, 3):
        # a gram's prefixes are grams; what ends in a pad is none. NUL is never a letter, so a pad is unambiguous
        short = run >> np.uint64((3 - n) * POINT_BITS)
        short = short[short & np.uint64((1 << POINT_BITS) - 1) != 0]
        out.append(short[np.r_[True, short[1:] != short[:-1]]] if len(short) else short)
    return out


def features(text: str) -> np.ndarray:
    """All grams of a text in one sorted array; the two top bits tell 1- and 2-grams from 3-grams."""
    one, two, three = grams(GAP.sub(" ", text.lower()))
    return np.concatenate([three, one | np.uint64(1 << 62), two | np.uint64(1 << 63)])


def decode(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


class Landmarks:
    """The grams of the landmarks, and for each which landmarks hold it (pairs ordered by gram)."""

    def __init__(self, pieces: list[str]):
        rows = [features(p) for p in pieces]
        flat = np.concatenate([np.array([], np.uint64), *rows])
        self.vocabulary, gram = np.unique(flat, return_inverse=True)
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        order = np.argsort(gram, kind="stable")
        self.gram, self.owner = gram[order].astype(np.int32), owner[order].astype(np.int32)
        self.scale = np.array([1 / np.sqrt(max(len(r), 1)) for r in rows], np.float32)

    def block(self, start: int, stop: int) -> np.ndarray:
        """The landmark matrix (grams by landmarks) of a range of grams."""
        low, high = np.searchsorted(self.gram, [start, stop])
        out = np.zeros((stop - start, len(self.scale)), np.float32)
        out[self.gram[low:high] - start, self.owner[low:high]] = self.scale[self.owner[low:high]]
        return out

    def gram_weights(self, weights: np.ndarray) -> np.ndarray:
        """The landmark matrix times ``weights``: what every gram adds for each language."""
        return np.concatenate([np.zeros((0, weights.shape[1]), np.float32)] + [
            (self.block(s, e) @ weights).astype(np.float32) for s, e in blocks(len(self.vocabulary))])


def blocks(n: int) -> list[tuple[int, int]]:
    """Ranges of at most ``BLOCK`` grams."""
    return [(s, min(s + BLOCK, n)) for s in range(0, n, BLOCK)]


def product(texts: list[str], vocabulary: np.ndarray, matrix: Callable[[int, int], np.ndarray],
            width: int) -> np.ndarray:
    """The scaled presence vectors of a batch of texts times a matrix with a row for each gram.

    Both are made dense for a range of grams at a time.
    """
    places, sizes = [], []
    for text in texts:
        own = features(text)
        at = np.searchsorted(vocabulary, own)
        at[at == len(vocabulary)] = 0
        places.append(at[vocabulary[at] == own] if len(vocabulary) else at[:0])
        sizes.append(max(len(own), 1))
    out = np.zeros((len(texts), width), np.float32)
    for start, stop in blocks(len(vocabulary)):
        present = np.zeros((len(texts), stop - start), np.float32)
        for i, at in enumerate(places):
            low, high = np.searchsorted(at, [start, stop])
            present[i, at[low:high] - start] = 1
        out += present @ matrix(start, stop)
    return out / np.sqrt(np.array(sizes, np.float32))[:, None]


class Model:
    """Languages, the grams of the landmarks, and what each gram adds for each language.

    A kernel value is linear in the presence vector, so the landmark matrix and the
    regression weights over landmarks are multiplied once, at the fit.
    """

    def __init__(self, languages: list[str], vocabulary: np.ndarray, weights: np.ndarray):
        self.languages, self.vocabulary, self.weights = languages, vocabulary, weights

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts) if self.languages and LETTER.search(t)]
        for start in range(0, len(known), BATCH):
            rows = known[start:start + BATCH]
            values = product([texts[i] for i in rows], self.vocabulary, lambda s, e: self.weights[s:e],
                             len(self.languages)).astype(np.float64)
            best = values.argmax(axis=1)
            share = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
            share /= share.sum(axis=1, keepdims=True)
            for k, i in enumerate(rows):
                out[i] = (self.languages[best[k]], float(share[k, best[k]]))
        return out


def piece_of(text: str, key: int) -> str:
    """At most ``PIECE`` code points of a text, from a place that the key chooses."""
    if len(text) <= PIECE:
        return text
    start = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True)) % (len(text) - PIECE + 1)
    return text[start:start + PIECE]


def sample(rows: DataFrame, per_language: int) -> DataFrame:
    """(key, text, lang, place): the first ``per_language`` rows of each language by hash.

    One aggregate counts the languages; a hash bound then lets about twice the
    wanted rows through, and only these are ordered, so no language is sorted whole.
    """
    counts = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    spread = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    bound = F.ceil((1 << 30) * (2.0 * per_language + 100) / F.col("rows"))
    near = (rows.withColumn("spread", spread).join(sized_broadcast(counts), "lang").filter(F.col("spread") < bound)
            .select("lang", "spread", "key"))
    order = F.struct("spread", "key")
    kept = (near.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(order)), 1, per_language).alias("chosen"))
            .select("lang", F.posexplode("chosen").alias("place", "row"))
            .select("lang", "place", F.col("row.key").alias("key")))
    kept = written(kept, "sample")
    return cut(rows.join(sized_broadcast(kept), ["lang", "key"]).select("key", "text", "lang", "place"))


def kernel_rows(rows: DataFrame, landmarks: Landmarks) -> DataFrame:
    """``key``, ``lang`` and the kernel values of every row against the landmarks."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(landmarks))

    def make():
        own = Landmarks([])
        vars(own).update(shared.value)

        def work(texts):
            values = [product([decode(t)], own.vocabulary, own.block, len(own.scale))[0] for t in texts]
            return [pa.array(values, pa.list_(pa.float32()))]
        return work

    return append_columns(rows, "text", [T.StructField("values", T.ArrayType(T.FloatType()))], make)


def inverse_root(gram: np.ndarray) -> np.ndarray:
    """K^(-1/2) of the landmarks' own kernel; directions that they do not span are left out."""
    values, vectors = np.linalg.eigh(gram)
    good = values > 1e-6 * values.max(initial=0)
    return vectors[:, good] / np.sqrt(values[good])


def regression(features: np.ndarray, targets: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Ridge weights; ``ridge`` is a share of the mean squared feature."""
    square = features.T @ features
    level = ridge * np.trace(square) / max(len(square), 1)
    return np.linalg.solve(square + max(level, 1e-12) * np.eye(len(square)), features.T @ targets)


def fit(docs: DataFrame, key: str, text: str, lang: str) -> Model:
    """The model of labelled rows ``docs``; rows without a key, a text, a letter or a language do not count."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"),
                       F.col(lang).cast("string").alias("lang"))
    rows = rows.filter("key IS NOT NULL AND lang IS NOT NULL").filter(F.col("text").rlike(r"\p{L}"))
    chosen = sample(rows, LANDMARKS + TRAINING)
    marks = cut_pieces(chosen.filter(F.col("place") < LANDMARKS)).orderBy("lang", "key", "piece").collect()
    languages = sorted({r["lang"] for r in marks})
    landmarks = Landmarks([r["piece"] for r in marks])
    if not languages:
        return Model([], landmarks.vocabulary, np.zeros((0, 0), np.float32))
    train = kernel_rows(chosen.select("key", "text", "lang"), landmarks).orderBy("lang", "key").collect()
    own = sum(b.T @ b for b in (landmarks.block(s, e) for s, e in blocks(len(landmarks.vocabulary))))
    root = inverse_root(own.astype(np.float64))
    z = np.array([r["values"] for r in train], np.float64) @ root
    label = np.array([languages.index(r["lang"]) for r in train])
    y = 2.0 * np.eye(len(languages))[label] - 1
    # every language weighs the same, however many rows it has
    weight = 1 / np.sqrt(np.bincount(label, minlength=len(languages)))[label][:, None]
    weights = root @ regression(z * weight, y * weight)
    return Model(languages, landmarks.vocabulary, landmarks.gram_weights(weights))


def cut_pieces(rows: DataFrame) -> DataFrame:
    """(key, lang, piece): the landmark pieces of the chosen rows, cut in the tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [decode(t.as_py()) for t in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([piece_of(t, k) for t, k in zip(texts, keys, strict=True)], pa.string())],
                ["key", "lang", "piece"])

    return rows.select("key", "lang", "text").mapInArrow(run, "key long, lang string, piece string")


def identify(docs: DataFrame, text: str, model: Model, prediction: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """``docs`` without ``text``, with the predicted language and its score."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.vocabulary, model.weights))

    def make():
        scorer = Model(*shared.value)

        def work(texts):
            found = scorer.predict([decode(t) for t in texts])
            return [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
        return work

    return append_columns(docs.drop(prediction, score), text, [T.StructField(prediction, T.StringType()),
                                                               T.StructField(score, T.DoubleType())], make)
