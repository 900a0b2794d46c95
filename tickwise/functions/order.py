"""The ingest order of ticks: one exact number from a record's place in its source.

``seq`` packs (source time, partition, offset, position in the envelope) into a
decimal(38,0), most significant first, so it is the same whichever query reads
the record and however often. A single numeric key keeps ``max_by`` in a
HashAggregate. Values outside the packed ranges fail the query.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickwise.schemas import SEQ_TYPE

# 53 + 14 + 43 + 16 = 126 bits, below 10 ** 38.
TIME_LIMIT = 1 << 53       # microseconds since 1970: until the year 2255
PARTITION_LIMIT = 1 << 14
OFFSET_LIMIT = 1 << 43
POSITION_LIMIT = 1 << 16

ORDER_COLUMNS = ("timestamp", "partition", "offset")


def _dec(n: int) -> Column:
    return F.lit(str(n)).cast(SEQ_TYPE)


def ingest_seq(time: Column, partition: Column, offset: Column, position: Column) -> Column:
    """``seq`` of a tick; ``time`` is a timestamp, the others integers."""
    parts = ((F.unix_micros(time.cast("timestamp")), TIME_LIMIT), (partition.cast("long"), PARTITION_LIMIT),
             (offset.cast("long"), OFFSET_LIMIT), (position.cast("long"), POSITION_LIMIT))
    out, ok = _dec(0), F.lit(True)
    for value, limit in parts:
        ok = ok & (value >= 0) & (value < limit)
        out = (out * _dec(limit) + value.cast(SEQ_TYPE)).cast(SEQ_TYPE)
    return F.when(ok, out).otherwise(F.raise_error(F.lit("a record's place is out of the range of seq")).cast(SEQ_TYPE))
