"""BAR-1: daily open/high/low/close/volume bars with the closing-mark rule.

Semantics (reference behaviour):
* a (company, day) gets a bar only if a tick is stamped exactly at the close;
* open and close come from the closing tick with the highest ingest ``seq``
  (the last one stored wins); open is that tick's own ``open`` field;
* high / low = max / min of ``current_price`` over the session [open, close],
  both ends inclusive; volume = max of the truncated volumes (not a sum);
* absent prices / volumes count as 0; ticks without symbol or with a bad
  timestamp are rejected (see ``ticks.tick_rejects``), unknown symbols skipped.

Plan: scan -> filter to session ticks -> partial HashAggregate by (symbol, day)
-> one hash exchange -> final aggregate -> lookup of company ids on the (small)
bar set. Every aggregate is partial-able, so a hot symbol costs one row per map
partition, not one task holding all its ticks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.prices import to_price, truncate_volume
from tickwise.operators.joins import lookup
from tickwise.operators.ticks import (
    DEFAULT_CLOSE_TIME, DEFAULT_OPEN_TIME, company_keys, in_session, is_closing, valid_ticks,
)


def session_aggregates(ticks: DataFrame, open_time: str = DEFAULT_OPEN_TIME,
                       close_time: str = DEFAULT_CLOSE_TIME) -> DataFrame:
    """Per (symbol, date): closing-mark values and session extremes (no company join)."""
    t = valid_ticks(ticks)
    t = t.filter(in_session(F.col("ts"), open_time, close_time))
    mark_seq = F.when(is_closing(F.col("ts"), close_time), F.col("seq"))
    # trade_date is to_date(ts) by construction of the store; grouping on the
    # partition column lets a filter on the bar date prune tick partitions
    return (t.groupBy("symbol", F.col("trade_date").alias("date"))
             .agg(F.max_by("open", mark_seq).alias("open_raw"),
                  F.max_by("current_price", mark_seq).alias("close_raw"),
                  F.max("current_price").alias("high_raw"),
                  F.min("current_price").alias("low_raw"),
                  F.max(truncate_volume("volume")).alias("volume"),
                  F.max(mark_seq).alias("mark_seq")))


def daily_bars(ticks: DataFrame, companies: DataFrame,
               open_time: str = DEFAULT_OPEN_TIME,
               close_time: str = DEFAULT_CLOSE_TIME) -> DataFrame:
    """Bars ``(company_id, date, open, high, low, close, volume)``."""
    return bars_of(session_aggregates(ticks, open_time, close_time), companies)


def bars_of(aggregates: DataFrame, companies: DataFrame) -> DataFrame:
    """The bars of ``session_aggregates`` rows: those with a closing mark and a listed symbol."""
    agg = aggregates.filter(F.col("mark_seq").isNotNull())
    bars = lookup(agg, company_keys(companies), "symbol", "inner")
    return bars.select(
        "company_id", "date",
        to_price("open_raw").alias("open"),
        to_price("high_raw").alias("high"),
        to_price("low_raw").alias("low"),
        to_price("close_raw").alias("close"),
        "volume")
