"""Adapters from the driver's test tables onto the market data model.

| market table | built from |
| sectors      | nation (n_nationkey -> id, n_name -> name) |
| exchanges    | region (r_regionkey -> id, r_name -> name) |
| companies    | supplier left join nation: id = s_suppkey, symbol = 'S' || s_suppkey |
| prices       | daily bars of ticks (the bar job's output table) |
| ticks        | events: symbol = 'S' || user_id, price = value, volume = props.k,
|              | seq = event_id, name = s_name (NULL when no supplier), timestamp truncated |
|              | to the hour, open = first value                                     |
|              | of the user by (ts, event_id) |

About a third of event users have no supplier, which exercises the
unknown-symbol path; several ticks share an exact 18:00:00 mark, which
exercises last-wins.
"""

from __future__ import annotations

import functools
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.prices import tick_pct_change
from tickwise.functions.time import at_time, format_tick_ts, order_key
from tickwise.operators.joins import lookup
from tickwise.schemas import SEQ_TYPE
from tickwise.session import checkpoint_root


def _per_session(build):
    """Build each view once per (session, folder), like registering a view once.

    The driver's tables are read-only. Views hold plans, except ``ticks``, which
    is a table written on first use (see there).
    """
    cache: dict[tuple, DataFrame] = {}

    @functools.wraps(build)
    def get(spark: SparkSession, sf_dir: str, *args) -> DataFrame:
        # the session's own id: Python may reuse the id() of a collected object
        key = (spark._jsparkSession.sessionUUID(), spark.sparkContext.applicationId, sf_dir, args)
        if key not in cache:
            cache[key] = build(spark, sf_dir, *args)
        return cache[key]
    return get


@_per_session
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@_per_session
def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


@_per_session
def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"),
        F.lit(None).cast("string").alias("code"))


@_per_session
def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    # nation is keyed by n_nationkey; stating it (distinct on the key) lets the
    # optimizer drop this left join from every plan that does not use
    # exchange_id, e.g. all symbol -> id lookups
    nation = (table(spark, sf_dir, "nation")
              .select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey"))
              .dropDuplicates(["s_nationkey"]))
    joined = lookup(supplier, nation, "s_nationkey", "left")
    return joined.select(
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("sector_id"),
        F.lit(None).cast("int").alias("industry_id"),
        F.col("n_regionkey").alias("exchange_id"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("int").alias("founded_year"))


@_per_session
def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick-store shaped table made of ``events`` (includes ``seq``, ``ts``, ``trade_date``).

    Written once per session to the shared checkpoint folder, partitioned by
    trade date like the tick store it stands in for; every query reads that
    table. A date filter prunes partitions and a symbol filter is pushed down.
    """
    events = table(spark, sf_dir, "events")
    # Each user's first value by (ts, event_id): a partial-able aggregate (one
    # row per user), joined back; no per-user window, so a hot user never
    # lands in one task.
    first = (events.groupBy("user_id")
             .agg(F.min_by("value", order_key("ts", "event_id")).alias("open")))
    # per-user attributes (first value, supplier name) joined once to the ticks
    names = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("name"))
    t = events.join(first.join(names, "user_id", "left"), "user_id", "left")
    # wall-clock hour of the (zone-less) event time, independent of the session zone
    hour = at_time(F.to_date("ts"), "00:00:00") + F.make_dt_interval(
        F.lit(0), F.hour("ts"), F.lit(0), F.lit(0))
    t = t.select(
        F.col("value").alias("current_price"),
        F.col("user_id").try_cast("int").alias("id"),
        F.col("name"),
        F.col("open"),
        tick_pct_change("value", "open").alias("percent_change"),
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("symbol"),
        format_tick_ts(hour).alias("timestamp"),
        F.get_json_object("props", "$.k").try_cast("double").alias("volume"),
        F.col("event_id").cast(SEQ_TYPE).alias("seq"),
        hour.alias("ts"),
        F.to_date(F.col("ts")).alias("trade_date"))
    path = os.path.join(checkpoint_root(spark), f"ticks-{uuid.uuid4().hex}")
    t.hint("rebalance", "trade_date").write.partitionBy("trade_date").parquet(path)
    return spark.read.schema(t.schema).parquet(path)


@_per_session
def dirty_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks with text time only, spoilt by rules on their number (``seq``).

    Missing, empty and malformed times, years of two and five digits, a day that
    does not exist, unpadded parts, no symbol, NULL and zero opens, NULL and too
    large prices and volumes.
    """
    t = ticks(spark, sf_dir)
    n = F.col("seq").cast("long")
    text = F.col("timestamp")

    time = (F.when(n % 11 == 0, F.lit(None).cast("string"))
            .when(n % 11 == 1, F.lit(""))
            .when(n % 11 == 2, F.concat(F.lit("2"), text))
            .when(n % 11 == 3, F.substring(text, 3, 20))
            .when(n % 11 == 4, F.translate(text, " ", "T"))
            .when(n % 11 == 5, F.concat(F.lit("2024-02-30"), F.substring(text, 11, 10)))
            .when(n % 11 == 6, F.regexp_replace(text, "-0", "-"))
            .otherwise(text))
    return t.select(
        F.when(n % 19 == 0, F.lit(1e9)).when(n % 23 != 0, F.col("current_price")).alias("current_price"),
        "id", "name",
        F.when(n % 7 == 1, F.lit(0.0)).when(n % 7 != 0, F.col("open")).alias("open"),
        "percent_change",
        F.when(n % 13 != 0, F.col("symbol")).alias("symbol"),
        time.alias("timestamp"),
        F.when(n % 29 == 0, F.lit(1e19)).when(n % 31 != 0, F.col("volume")).alias("volume"),
        "seq")


@_per_session
def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``prices`` table: daily bars of the tick view (a plan, recomputed on every run)."""
    from tickwise.operators.bars import daily_bars
    return daily_bars(ticks(spark, sf_dir), companies(spark, sf_dir))
