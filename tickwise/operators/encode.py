"""SNK-1 / JOB-3: ticks -> snapshot envelopes (one JSON array per poll).

Ticks of one poll share a ``timestamp`` and are one record, as the reference
sends them; within it they keep their store order (``seq``). Without the
options below a record holds its whole poll in one value: bounded where a poll
holds one tick per listed symbol, else by the 2 GB of a value.

``max_ticks`` is for ticks whose timestamp is no poll: a record takes the ticks
of one timestamp in one range of that many numbers ``seq``. As ``seq`` is
unique, no record holds more, and it needs no pass that counts polls first.

Where a broker limits the size of a record, ``max_bytes`` splits larger polls:
one of B bytes and N ticks gets ceil(max(B / max_bytes, N / HASHED_TICKS))
records and a tick goes to one of them by the hash of ``seq`` and its fields, so
neither one symbol nor small ticks fill a record beyond the positions that an
ingest order has; order is kept within a record only, and ticks without ``seq``
that are equal in all fields stay together.

Either split depends on the poll alone, never on the order or partitioning of
the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.order import POSITION_LIMIT
from tickwise.schemas import TICK_FIELDS

RECORD_TICKS = 4096                 # about a megabyte
HASHED_TICKS = POSITION_LIMIT // 2  # on average, as hashing fills records unevenly


def encode_snapshots(ticks: DataFrame, max_bytes: int | None = None,
                     max_ticks: int | None = None) -> DataFrame:
    """Envelopes ``(timestamp, value)``; ``value`` is the JSON array text."""
    order = [F.col("seq")] if "seq" in ticks.columns else []
    t = ticks.select(F.col("timestamp").alias("_ts"),
                     F.struct(*order, F.struct(*TICK_FIELDS).alias("tick")).alias("_e"))
    keys = ["_ts"]
    if max_ticks is not None:
        if not order or not 0 < max_ticks <= POSITION_LIMIT:
            raise ValueError(f"max_ticks needs seq and a value from 1 to {POSITION_LIMIT}")
        t = t.withColumn("_range", F.col("_e.seq") - F.pmod(F.col("_e.seq"), F.lit(max_ticks)))
        keys.append("_range")
    if max_bytes is not None:
        size = F.octet_length(F.to_json("_e.tick")) + F.lit(1)
        parts = t.groupBy("_ts").agg(F.ceil(F.greatest(
            F.sum(size) / F.lit(max_bytes), F.count(F.lit(1)) / F.lit(HASHED_TICKS))).alias("_parts"))
        t = (t.join(parts, t["_ts"].eqNullSafe(parts["_ts"])).drop(parts["_ts"])
             .withColumn("_part", F.pmod(F.xxhash64("_e"), F.col("_parts"))))
        keys.append("_part")
    grouped = t.groupBy(*keys).agg(F.sort_array(F.collect_list("_e")).alias("_es"))
    return grouped.select(
        F.col("_ts").alias("timestamp"),
        F.to_json(F.transform("_es", lambda e: e["tick"])).alias("value"))
