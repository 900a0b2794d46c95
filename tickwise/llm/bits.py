"""A bounded bit table for hashes, to leave out rows that a join would drop anyway."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 25  # as a power of two


class BitTable:
    """Membership test of two bits for each hash; it can err only towards yes."""

    def __init__(self, power: int, slots: np.ndarray):
        self.power, self.slots = power, slots

    def parts(self) -> tuple[int, np.ndarray]:
        return self.power, self.slots

    def holds(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in (h >> np.uint64(64 - self.power), h & np.uint64((1 << self.power) - 1)):
            out &= (self.slots[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) == 1
        return out


def bit_table(hashes: DataFrame, column: str) -> BitTable:
    """The table over a bigint column.

    It has 64 bits for each hash but 2 ** FILTER_BITS (4 MB) at most, which
    bounds what the driver gets and sends. A table that is too small for its
    hashes lets more rows pass and loses none.
    """
    h = F.col(column)
    n = hashes.agg(F.approx_count_distinct(h)).first()[0]
    power = min(FILTER_BITS, max(16, (64 * n).bit_length()))
    at = F.explode(F.array(F.shiftrightunsigned(h, 64 - power), h.bitwiseAND(F.lit((1 << power) - 1))))
    rows = (hashes.select(at.alias("at"))
            .groupBy(F.shiftright("at", 6).alias("slot"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits")).collect())
    slots = np.zeros(1 << (power - 6), np.int64)
    slots[[r["slot"] for r in rows]] = [r["bits"] for r in rows]
    return BitTable(power, slots.view(np.uint64))
