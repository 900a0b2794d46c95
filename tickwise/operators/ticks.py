"""Tick-level operators: validation, rejects, company resolution and range scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.prices import clean_number, fits_price, fits_volume
from tickwise.functions.time import at_time, parse_tick_ts
from tickwise.operators.joins import sized_broadcast
from tickwise.session import checkpoint_root

# Default session bounds (closing mark at 18:00:00, session from 08:00:00).
DEFAULT_OPEN_TIME = "08:00:00"
DEFAULT_CLOSE_TIME = "18:00:00"

NO_SYMBOL = "no_symbol"
MISSING_TIMESTAMP = "missing_timestamp"
BAD_TIMESTAMP = "bad_timestamp"
UNKNOWN_SYMBOL = "unknown_symbol"
PRICE_OUT_OF_RANGE = "price_out_of_range"
VOLUME_OUT_OF_RANGE = "volume_out_of_range"


def prepare_ticks(ticks: DataFrame) -> DataFrame:
    """Add parsed ``ts`` (unless present), ``trade_date`` and ``reject_reason``.

    Absent / NULL / NaN numbers take the reference defaults (0) so they enter
    min/max exactly as an absent field would. A price or volume that the
    ``prices`` table cannot hold is a reject reason, so no bar gets a silent NULL.
    """
    ts = F.col("ts") if "ts" in ticks.columns else parse_tick_ts("timestamp")
    # the timestamp text is only inspected for rows whose time did not parse
    reason = (F.when(F.col("symbol").isNull(), F.lit(NO_SYMBOL))
              .when(ts.isNull(),
                    F.when(F.coalesce(F.col("timestamp"), F.lit("")) == "",
                           F.lit(MISSING_TIMESTAMP)).otherwise(F.lit(BAD_TIMESTAMP)))
              .when(~fits_price(clean_number("open")) | ~fits_price(clean_number("current_price")),
                    F.lit(PRICE_OUT_OF_RANGE))
              .when(~fits_volume(clean_number("volume")), F.lit(VOLUME_OUT_OF_RANGE)))
    cleaned = {"open", "current_price", "volume", "ts", "trade_date", "reject_reason"}
    return ticks.select(
        *[c for c in ticks.columns if c not in cleaned],
        clean_number("open").alias("open"),
        clean_number("current_price").alias("current_price"),
        clean_number("volume").alias("volume"),
        ts.alias("ts"),
        (F.col("trade_date") if "trade_date" in ticks.columns else F.to_date(ts)).alias("trade_date"),
        reason.alias("reject_reason"))


def valid_ticks(ticks: DataFrame) -> DataFrame:
    return prepare_ticks(ticks).filter(F.col("reject_reason").isNull())


def company_keys(companies: DataFrame) -> DataFrame:
    """The (id, symbol) lookup side; a symbol listed twice resolves to its lowest id.

    One row per symbol whatever the table holds, so a duplicated symbol cannot
    duplicate ticks or bars.
    """
    return companies.groupBy("symbol").agg(F.min("id").alias("company_id"))


def unknown_symbols(ticks: DataFrame, companies: DataFrame) -> DataFrame:
    """JOIN-5: valid ticks whose symbol is not a listed company."""
    known = sized_broadcast(companies.select("symbol"))
    valid = valid_ticks(ticks)
    return valid.join(known, "symbol", "left_anti").select(*valid.columns)


def tick_rejects(ticks: DataFrame, companies: DataFrame) -> DataFrame:
    """Every tick the bar job skips, with its reason (no row is dropped silently).

    One pass over the ticks: a left lookup of a ``listed`` flag in the
    distinct company symbols (broadcast behind the size check; distinct, so a
    duplicated symbol cannot duplicate ticks), then the first reason that
    applies.
    """
    prepared = prepare_ticks(ticks)
    listed = companies.select("symbol").distinct().withColumn("_listed", F.lit(True))
    j = prepared.join(sized_broadcast(listed), "symbol", "left")
    reason = F.coalesce(F.col("reject_reason"),
                        F.when(F.col("_listed").isNull(), F.lit(UNKNOWN_SYMBOL)))
    return (j.withColumn("reject_reason", reason)
             .filter(F.col("reject_reason").isNotNull())
             .select(*prepared.columns))


def is_closing(ts: Column, close_time: str = DEFAULT_CLOSE_TIME) -> Column:
    """FLT-4: the wall-clock time of day is exactly the closing mark."""
    return ts == at_time(F.to_date(ts), close_time)


def in_session(ts: Column, open_time: str = DEFAULT_OPEN_TIME,
               close_time: str = DEFAULT_CLOSE_TIME) -> Column:
    """FLT-5: open <= time of day <= close (both ends inclusive)."""
    d = F.to_date(ts)
    return ts.between(at_time(d, open_time), at_time(d, close_time))


def closing_ticks(ticks: DataFrame, close_time: str = DEFAULT_CLOSE_TIME) -> DataFrame:
    """Valid ticks stamped exactly at the closing mark."""
    return valid_ticks(ticks).filter(is_closing(F.col("ts"), close_time))


def session_scan(ticks: DataFrame, symbol: str, day: str,
                 open_time: str = DEFAULT_OPEN_TIME,
                 close_time: str = DEFAULT_CLOSE_TIME) -> DataFrame:
    """SRC-4: ticks of one symbol within one day's session (closed range).

    The trade-date equality prunes tick-store partitions; the symbol filter is
    pushed to the Parquet scan.
    """
    d = F.lit(day).cast("date")
    t = ticks.filter(F.col("symbol") == F.lit(symbol))
    if "trade_date" in ticks.columns:
        t = t.filter(F.col("trade_date") == d)
    t = valid_ticks(t)
    return t.filter(F.col("ts").between(at_time(d, open_time), at_time(d, close_time)))


def session_ticks(ticks: DataFrame, open_time: str = DEFAULT_OPEN_TIME,
                  close_time: str = DEFAULT_CLOSE_TIME) -> DataFrame:
    """JOIN-6 over the whole store: for every (symbol, day) with a closing mark,
    all of that symbol's ticks in that day's session.

    Written as a semi join on (symbol, trade_date) instead of one range query
    per closing tick. The marks (one row per symbol and day at most) are
    materialized first in the shared checkpoint folder (a partial-aggregate
    pass); when their size check passes they are broadcast and the session
    scan stays map-only, so the tick side is never shuffled and a hot symbol
    cannot land in one task. Building the plan runs that marks job. Beyond the bound it is a shuffle semi join whose
    skewed partitions adaptive execution splits.
    """
    t = valid_ticks(ticks)
    checkpoint_root(ticks.sparkSession)
    marks = (t.filter(is_closing(F.col("ts"), close_time))
              .select("symbol", "trade_date").distinct()
              .checkpoint(eager=True))
    sess = t.filter(in_session(F.col("ts"), open_time, close_time))
    return sess.join(sized_broadcast(marks), ["symbol", "trade_date"], "left_semi").select(*sess.columns)
