"""BPE encoding and decoding (operator 9).

A vocabulary file in the JSON layout of the ``tokenizers`` library is read on
the driver (its size is bounded by the vocabulary) and broadcast as text. Every
task builds one ``Tokenizer`` from it and encodes whole texts: special tokens
are cut out, the rest is normalised and split into words, and the pieces of a
word are merged with a segment tree over the ranks of adjacent pairs. Words
recur, so the ids of short ones are kept in memos of bounded size.

The library's Unicode tables (letters, digits, lower case, normalisation) are of
other Unicode versions than Python's and the ``regex`` module's. ``unicode_tables``
asks the installed library once on the driver where they differ, over all code
points; a text with such a character is cut by the library's tables.

Defined cases: a null text counts as empty; an empty text has no ids and
decodes to the empty string; rows are independent, so repeated rows and ties
change nothing; other columns pass through unchanged.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterable
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from tickwise.llm.common import append_columns

# White space of the vocabulary's pre-tokenizer, as a class of the split pattern,
# and the control characters that only Python's str.split() adds to it.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NOT_SPACES = "\x1c\x1d\x1e\x1f"

# Bounds of each of a task's memos, which are emptied when full: entries, and bytes of
# an entry, beyond which a word or chunk is not kept.
MEMO_WORDS = 400_000
MEMO_BYTES = 64

# A leaf without a mergeable pair.
NONE = 1 << 62


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(spare)
            spare += 1
    return [symbols[b] for b in range(256)]


def _ranges(codes: Iterable[int]) -> list[tuple[int, int]]:
    """Sorted code points as ranges (first, last)."""
    out: list[tuple[int, int]] = []
    for c in codes:
        if out and c == out[-1][1] + 1:
            out[-1] = out[-1][0], c
        else:
            out.append((c, c))
    return out


def _class(ranges: Iterable[tuple[int, int]]) -> str:
    """The inside of a character class."""
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


@cache
def unicode_tables() -> dict:
    """Where the library's Unicode tables differ from those used here, over all code points.

    ``L``, ``N``: the library's letters and digits as ranges; ``classes``: the code points
    that are in one of them here or there only; ``lower``: the library's lower case of those
    that have another one here; ``inert``: those that normalise here and not in the library.
    """
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, codes))

    def differing(theirs: Callable[[str], str], ours: Callable[[str], str]) -> list[int]:
        return [c for c in codes if theirs(chr(c)) != ours(chr(c))]

    tables: dict = {}
    classes: set[int] = set()
    for name in ("L", "N"):
        split = pre_tokenizers.Split(Regex(rf"\p{{{name}}}"), "removed", invert=True)
        theirs = {ord(every[a]) for _, (a, _) in split.pre_tokenize_str(every)}
        classes |= theirs ^ set(map(ord, regex.findall(rf"\p{{{name}}}", every)))
        tables[name] = _ranges(sorted(theirs))
    tables["classes"] = _ranges(sorted(classes))
    lower = normalizers.Lowercase().normalize_str
    tables["lower"] = {chr(c): lower(chr(c)) for c in differing(lower, str.lower)}

    def nfd(text: str) -> str:
        return unicodedata.normalize("NFD", text)

    # decomposition, composition, and the class of a mark between marks of the lowest and a high one
    their_nfd, their_nfc = normalizers.NFD().normalize_str, normalizers.NFC().normalize_str
    inert = {ord(d) for c in differing(their_nfd, nfd) for d in nfd(chr(c)) + chr(c)}
    for frame in ("%s", "a%s\u0334", "a\u0345%s"):
        inert.update(ord(d) for c in differing(lambda c, f=frame: their_nfc(f % nfd(c)),
                                               lambda c, f=frame: unicodedata.normalize("NFC", f % nfd(c)))
                     for d in nfd(chr(c)) + chr(c))
    tables["inert"] = _ranges(sorted(inert))
    return tables


def merge_pairs(symbols: list[int], ranks: dict[int, int], merged: list[int]) -> list[int]:
    """Merge ``symbols`` by rank until no adjacent pair is mergeable.

    ``ranks`` maps ``left << 32 | right`` to a rank, ``merged`` a rank to the
    new symbol. Leaf i of the segment tree holds ``rank * n + i`` of the pair
    that starts at symbol i; the root is the leftmost pair of lowest rank. A
    merge changes three leaves and their paths to the root.
    """
    n = len(symbols)
    rank_of = ranks.get
    leaves = [NONE if (r := rank_of(symbols[i] << 32 | symbols[i + 1])) is None else r * n + i
              for i in range(n - 1)]
    if n < 2 or min(leaves) == NONE:
        return symbols
    size = 1 << (n - 2).bit_length()
    tree = [NONE] * size + leaves + [NONE] * (size - n + 1)
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (best := tree[1]) < NONE:
        rank, i = divmod(best, n)
        j = after[i]
        k = after[i] = after[j]
        symbols[i], symbols[j] = merged[rank], -1
        changed = []
        if k < n:
            before[k] = i
            r = rank_of(symbols[i] << 32 | symbols[k])
            changed.append((j, NONE))
            changed.append((i, NONE if r is None else r * n + i))
        else:
            changed.append((i, NONE))
        if (h := before[i]) >= 0:
            r = rank_of(symbols[h] << 32 | symbols[i])
            changed.append((h, NONE if r is None else r * n + h))
        for at, value in changed:
            at += size
            if tree[at] == value:
                continue
            tree[at] = value
            while at > 1:
                a, b = tree[at], tree[at ^ 1]
                low = a if a < b else b
                at >>= 1
                if tree[at] == low:
                    break
                tree[at] = low
    return [s for s in symbols if s >= 0]


class Tokenizer:
    """Encoder and decoder of one vocabulary; ``encode`` returns little-endian uint32 ids."""

    def __init__(self, text: str, tables: dict):
        data = json.loads(text)
        model = data["model"]
        vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.first = [vocab[s] for s in byte_symbols()]
        self.last = [vocab[s + self.suffix] for s in byte_symbols()]
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special = {k: np.array([v], "<u4").tobytes() for k, v in special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        by_id = {i: t for t, i in (vocab | special).items()}
        self.tokens = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        split = next(p["pattern"]["Regex"] for p in data["pre_tokenizer"]["pretokenizers"]
                     if p["type"] == "Split")
        self.words = regex.compile(split.replace(r"\s", WHITE_SPACE))
        self.spaces = regex.compile(f"[{WHITE_SPACE}]+")
        # the same by the library's own tables, for what holds a character that they see otherwise
        self.their_words = regex.compile(split.replace(r"\s", WHITE_SPACE).replace(r"\p{L}", _class(tables["L"]))
                                         .replace(r"\p{N}", _class(tables["N"])))
        self.lower = tables["lower"]
        self.classes, self.inert, self.lowered = (
            regex.compile(f"([{_class(ranges)}])" if ranges else "(?!)")
            for ranges in (tables["classes"], tables["inert"], _ranges(sorted(map(ord, tables["lower"])))))
        self.by_word: dict[str, bytes] = {}
        self.by_chunk: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        """The normalised text between white space; no word of the split pattern holds any."""
        if not text.isascii():
            # a character that does nothing in the library's normalisation ends what others compose
            parts = self.inert.split(text) if self.inert.search(text) else [text]
            text = "".join(p if k % 2 else unicodedata.normalize("NFC", p) for k, p in enumerate(parts))
        # character by character: no rule for a sigma at the end of a word
        if "Σ" in text or (not text.isascii() and self.lowered.search(text)):
            text = "".join([self.lower[c] if c in self.lower else c.lower() for c in text])
        else:
            text = text.lower()
        if any(c in text for c in NOT_SPACES):
            return [c for c in self.spaces.split(text) if c]
        return text.split()

    def word(self, word: str) -> bytes:
        raw = word.encode("utf-8")
        symbols = [self.first[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        ids = np.array(merge_pairs(symbols, self.ranks, self.merged), "<u4").tobytes()
        if len(raw) <= MEMO_BYTES:
            if len(self.by_word) >= MEMO_WORDS:
                self.by_word.clear()
            self.by_word[word] = ids
        return ids

    def chunk(self, chunk: str) -> bytes:
        known = self.by_word.get
        words = self.words if chunk.isascii() or not self.classes.search(chunk) else self.their_words
        ids = b"".join([known(w) or self.word(w) for w in words.findall(chunk)])
        if len(chunk) <= MEMO_BYTES:
            if len(self.by_chunk) >= MEMO_WORDS:
                self.by_chunk.clear()
            self.by_chunk[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        out, known = [], self.by_chunk.get
        parts = self.cut.split(text) if self.cut and "<" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part])
            else:
                out += [known(c) or self.chunk(c) for c in self.chunks(part)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        tokens = self.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def bpe_encode(df: DataFrame, text: str, path: str, ids: str = "ids",
               decoded: str | None = None) -> DataFrame:
    """``df`` with the ids of ``text`` (binary, little-endian uint32) in its place.

    With ``decoded``, a second column holds the text that the ids decode to.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast((read_vocabulary(path), unicode_tables()))
    fields = [T.StructField(ids, T.BinaryType(), False)]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType(), False))

    def make():
        tokenizer = Tokenizer(*vocabulary.value)

        def work(texts: list[bytes]) -> list[pa.Array]:
            encoded = [tokenizer.encode(t.decode("utf-8", "replace")) for t in texts]
            out = [pa.array(encoded, pa.binary())]
            if decoded:
                out.append(pa.array([tokenizer.decode(e) for e in encoded], pa.string()))
            return out

        return work

    return append_columns(df, text, fields, make)


def bpe_decode(df: DataFrame, ids: str, path: str, text: str = "text") -> DataFrame:
    """``df`` with the text that the binary column ``ids`` decodes to in its place."""
    vocabulary = df.sparkSession.sparkContext.broadcast((read_vocabulary(path), unicode_tables()))

    def make():
        tokenizer = Tokenizer(*vocabulary.value)
        return lambda values: [pa.array([tokenizer.decode(v) for v in values], pa.string())]

    return append_columns(df, ids, [T.StructField(text, T.StringType(), False)], make)
