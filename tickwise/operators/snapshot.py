"""MKT-1: live market snapshot -- the latest tick per symbol with display columns.

"Latest" = highest ingest ``seq``. Each value is picked with ``max_by(value,
seq)`` on numeric columns only, so the whole aggregate stays a partial +
final HashAggregate (a hot symbol is reduced map-side to one row per
partition); the company name is looked up on the small per-symbol result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.display import change_class, money, percent, present, thousands
from tickwise.functions.time import format_tick_ts, parse_tick_ts
from tickwise.operators.joins import lookup


# The "last updated" line of the live market table.
LAST_UPDATED_PREFIX = "Last Updated: "
LAST_UPDATED_SUFFIX = " UTC"


def latest_ticks(ticks: DataFrame) -> DataFrame:
    """Latest numeric tick fields per symbol (ticks without symbol are skipped)."""
    t = ticks.filter(F.col("symbol").isNotNull())
    if "ts" not in t.columns:
        t = t.withColumn("ts", parse_tick_ts("timestamp"))
    return (t.groupBy("symbol")
             .agg(*[F.max_by(present(c), "seq").alias(c)  # NaN is a missing number
                    for c in ("open", "current_price", "percent_change", "volume")],
                  F.max_by("ts", "seq").alias("ts"),
                  F.max("seq").alias("seq")))


def market_snapshot(ticks: DataFrame, companies: DataFrame) -> DataFrame:
    """Rows of the market table: symbol, name, prices, change, volume, display text."""
    latest = latest_ticks(ticks)
    named = lookup(latest, companies.select("symbol", "name"), "symbol", "inner")
    return named.select(
        "symbol", "name", "open", "current_price", "percent_change", "volume",
        format_tick_ts("ts").alias("timestamp"),
        money("open").alias("open_display"),
        money("current_price").alias("price_display"),
        percent("percent_change").alias("change_display"),
        thousands("volume").alias("volume_display"),
        change_class("percent_change").alias("change_class"))


def last_updated(snapshot: DataFrame) -> DataFrame:
    """One row: ``Last Updated: <latest timestamp> UTC`` (a global max, partial-able).

    The max is taken on the parsed time (a fixed-width value, so the aggregate
    stays a HashAggregate) and formatted once.
    """
    latest = snapshot.agg(F.max(parse_tick_ts("timestamp")).alias("ts"))
    return latest.select(
        F.concat(F.lit(LAST_UPDATED_PREFIX), format_tick_ts("ts"), F.lit(LAST_UPDATED_SUFFIX)).alias("last_updated"))
