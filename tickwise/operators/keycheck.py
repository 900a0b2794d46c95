"""CHK-2/3 on load: keys of new rows that a stored table already holds.

The stored side is the large one, so it is not shuffled. The new keys make a
blocked Bloom filter: a table (word, bits) where a key sets ``KEY_BITS`` bits of
one 64-bit word. The stored rows are scanned once, between the least and the
greatest new key, and keep those whose bits are all set (a broadcast semi join
on the word). What is left, the true conflicts and a small share of false ones,
is compared with the new keys themselves, so the result is exact.

The filter takes ``BITS_PER_KEY`` bits a key whatever a key's width. It is
broadcast behind the size check of ``operators.joins``; where even the filter
is too large, the keys are joined as they are.

Defined cases: a key with a NULL part conflicts with nothing (SQL's UNIQUE);
repeated new keys are one key with a count; without new keys or stored rows
there is no conflict. Key columns are compared in the stored table's types.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.operators import joins
from tickwise.session import checkpoint_root

BITS_PER_KEY = 16
KEY_BITS = 4
WORD_BITS = 64


def _hash(keys: list[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def word_of(keys: list[str], words: int) -> Column:
    """The number of a key's word in a filter of ``words`` words."""
    return F.pmod(_hash(keys, 0), F.lit(words).cast("long"))


def bits_of(keys: list[str]) -> Column:
    """The bits that a key sets in its word: ``KEY_BITS`` six-bit parts of a second hash."""
    second = _hash(keys, 1)
    ones = [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int"))
            for i in range(KEY_BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), ones)


def key_filter(new_keys: DataFrame, keys: list[str], words: int) -> DataFrame:
    """The blocked Bloom filter of the keys: (word, bits), at most ``words`` rows."""
    return (new_keys.groupBy(word_of(keys, words).alias("word"))
            .agg(F.bit_or(bits_of(keys)).alias("bits")))


def may_hold(stored: DataFrame, keys: list[str], bloom: DataFrame, words: int) -> DataFrame:
    """The rows of ``stored`` whose key the filter ``bloom`` may hold; never fewer than it holds."""
    bloom = bloom.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    own = bits_of(keys)
    return stored.join(F.broadcast(bloom),
                       (word_of(keys, words) == F.col("_word")) & (F.col("_bits").bitwiseAND(own) == own),
                       "left_semi")


def stored_conflicts(new: DataFrame, stored: DataFrame, keys) -> DataFrame:
    """(keys, n_new, n_stored) of the new keys that ``stored`` holds.

    ``new`` is read once: its distinct keys with their counts are checkpointed to the
    shared folder, and the key range, the filter and the comparison come from them.
    """
    ks = [keys] if isinstance(keys, str) else list(keys)
    checkpoint_root(new.sparkSession)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ks])
    types = {f.name: f.dataType for f in stored.schema.fields}
    fresh = (new.select(*[F.col(k).cast(types[k]).alias(k) for k in ks]).filter(whole)
             .groupBy(*ks).agg(F.count(F.lit(1)).alias("n_new")).checkpoint(eager=True))
    n, low, high = fresh.agg(F.count(F.lit(1)), F.min(ks[0]), F.max(ks[0])).first()
    old = stored.select(*ks).filter(whole)
    if n:
        old = old.filter(F.col(ks[0]).between(F.lit(low).cast(types[ks[0]]), F.lit(high).cast(types[ks[0]])))
        words = -(-n * BITS_PER_KEY // WORD_BITS)
        bloom = key_filter(fresh, ks, words)
        if joins.is_broadcastable(bloom):
            old = may_hold(old, ks, bloom, words)
    held = old.groupBy(*ks).agg(F.count(F.lit(1)).alias("n_stored"))
    return fresh.join(held, ks)
