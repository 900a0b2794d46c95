"""Quality rules (operator 3): a threshold table compiled into one projection.

``metrics`` computes counts over a text; ``RULES`` is the table of thresholds
over their ratios. ``quality_rules`` turns both into one Spark
projection of built-in functions; nothing is shuffled and no user function runs.

Defined cases: a null text has no words, like an empty one; both fail the base
rule. Ratios over zero count as 0. Rows are independent of each other. Columns
of the input that clash with a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import fresh_name

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

# Frequent words of the languages that the corpus is written in.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with by on are this be at from",
    "fr": "le la les de des du et en un une est pour que qui dans par au sur avec pas",
    "de": "der die das und in den von zu mit ist auf für des dem im ein eine als auch sich nicht",
    "es": "el la los las de del y en un una que por con para se es no su al lo como",
}


@dataclass(frozen=True)
class Rule:
    """Keep a text while ``low <= numerator / denominator <= high``."""

    name: str
    numerator: str
    denominator: str | None
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        value = F.col(self.numerator).cast("double")
        if self.denominator:
            value = F.coalesce(F.try_divide(value, F.col(self.denominator)), F.lit(0.0))
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low)
        if self.high is not None:
            ok = ok & (value <= self.high)
        return ok


# A text whose ratios break any of these is rejected.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 20.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.4),
    Rule("exclamations", "n_exclamations", "n_words", high=0.1),
)


def metrics(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the columns that the rules are stated over.

    n_words, word_chars (code points in words), n_symbols, n_stop_words,
    n_exclamations (words that end in an exclamation mark), n_lines (lines with
    a word), n_dup_lines (of these, equal to an earlier one), n_repeat_words
    (words inside a 3-word window that the text holds twice or more).
    """
    out = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_exclamations", "n_lines",
           "n_dup_lines", "n_repeat_words")
    df = df.drop(*(c for c in df.columns if c in out and c != text))
    t, w, lines, windows, ordered, repeated = (fresh_name(n, df.columns) for n in (
        "q_text", "q_words", "q_lines", "q_windows", "q_ordered", "q_repeated"))
    stop = sorted({x for words in STOP_WORDS.values() for x in words.split()})
    df = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    df = df.withColumns({
        w: F.regexp_extract_all(t, F.lit(f"({WORD})"), F.lit(1)),
        lines: F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))})
    # windows as hashes by position; words are compared wherever hashes agree
    df = df.withColumn(windows, F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                    lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))))
    # most texts repeat no window and skip the sort
    df = df.withColumn(ordered, F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def same(a: Column, b: Column) -> Column:
        equal = a["h"] == b["h"]
        for k in range(3):
            equal = equal & (F.get(w, a["i"] + k) == F.get(w, b["i"] + k))
        return F.coalesce(equal, F.lit(False))

    df = df.withColumn(repeated, F.sort_array(F.transform(
        F.filter(ordered, lambda s, j: same(s, F.get(ordered, j - 1)) | same(s, F.get(ordered, j + 1))),
        lambda s: s["i"])))
    # each repeated window adds the words that the one before it does not cover
    covered = F.aggregate(
        F.coalesce(repeated, F.array().cast("array<int>")),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"])
    kept = [c for c in df.columns if c not in (t, w, lines, windows, ordered, repeated)]
    values = {
        "n_words": F.size(w),
        "word_chars": F.char_length(F.array_join(w, "")),
        "n_symbols": F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOL, "")),
        "n_stop_words": F.size(F.filter(w, lambda x: x.isin(stop))),
        "n_exclamations": F.size(F.filter(w, lambda x: x.endswith("!"))),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": covered,
    }
    return df.select(*kept, *(v.cast("long").alias(k) for k, v in values.items()))


def quality_rules(df: DataFrame, text: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` without ``text``, with the metrics, one flag for each rule, base_failed and kept."""
    df = metrics(df, text).drop(text)
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    df = df.withColumns({"base_failed": base} | {f"ok_{r.name}": r.passes() for r in rules})
    verdict = ~F.col("base_failed")
    for r in rules:
        verdict = verdict & F.col(f"ok_{r.name}")
    return df.withColumn("kept", verdict)
