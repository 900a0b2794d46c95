"""RPT-1..5: the five daily reports over ``prices`` joined to the dimensions.

Reference ordering rules kept explicitly: descending sorts put NULLs first and
ascending sorts NULLs last (the reference database's defaults, not Spark's);
``symbol`` / the group name is added as a tie-break so a top-5 is deterministic.

Each report filters ``prices`` to one date first (partition-pruned when
``prices`` is partitioned by date), so the joins only see one day's bars; the
dimension sides are broadcast behind a size check. ``orderBy + limit`` plans as
TakeOrderedAndProject (per-partition top-k, no full sort).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.prices import bar_pct_change, exact_avg, wide_sum
from tickwise.operators.joins import lookup

# Report size and the report file names (``<name><date>.csv``).
TOP_N = 5
REPORTS = {
    "top_volume_companies": "top_volume",
    "top_gainer_companies": "top_gainers",
    "avg_close_by_sector": "avg_close_by_sector",
    "total_volume_by_exchange": "volume_by_exchange",
    "top_loser_companies": "top_losers",
}


def _on_date(prices: DataFrame, report_date) -> DataFrame:
    if isinstance(report_date, (_dt.date, _dt.datetime)):
        report_date = report_date.isoformat()[:10]
    return prices.filter(F.col("date") == F.lit(report_date).cast("date"))


def _with_company(day: DataFrame, companies: DataFrame, *cols: str) -> DataFrame:
    dim = companies.select(F.col("id").alias("company_id"), *cols)
    return lookup(day, dim, "company_id", "inner")


def top_volume(prices: DataFrame, companies: DataFrame, report_date, n: int = TOP_N) -> DataFrame:
    """RPT-1: name, symbol, volume of the ``n`` largest volumes of the day."""
    j = _with_company(_on_date(prices, report_date), companies, "name", "symbol")
    return (j.select("name", "symbol", "volume")
             .orderBy(F.col("volume").desc_nulls_first(), F.col("symbol").asc())
             .limit(n))


def _pct(prices: DataFrame, companies: DataFrame, report_date) -> DataFrame:
    j = _with_company(_on_date(prices, report_date), companies, "name", "symbol")
    return j.withColumn("pct_change", bar_pct_change("close", "open"))


def top_gainers(prices: DataFrame, companies: DataFrame, report_date, n: int = TOP_N) -> DataFrame:
    """RPT-2: largest percent change; a zero open (NULL change) ranks first."""
    return (_pct(prices, companies, report_date)
            .select("name", "symbol", "pct_change")
            .orderBy(F.col("pct_change").desc_nulls_first(), F.col("symbol").asc())
            .limit(n))


def top_losers(prices: DataFrame, companies: DataFrame, report_date, n: int = TOP_N) -> DataFrame:
    """RPT-5: smallest percent change among bars with open > 0 and close < open."""
    p = prices.filter((F.col("open") > 0) & (F.col("close") < F.col("open")))
    return (_pct(p, companies, report_date)
            .select("name", "symbol", "pct_change")
            .orderBy(F.col("pct_change").asc_nulls_last(), F.col("symbol").asc())
            .limit(n))


def avg_close_by_sector(prices: DataFrame, companies: DataFrame, sectors: DataFrame,
                        report_date) -> DataFrame:
    """RPT-3: exact ``ROUND(AVG(close), 2)`` per sector name (NULL sector dropped)."""
    j = _with_company(_on_date(prices, report_date), companies, "sector_id")
    j = lookup(j, sectors.select(F.col("id").alias("sector_id"), F.col("name").alias("sector")),
               "sector_id", "inner")
    return (j.groupBy("sector").agg(exact_avg("close").alias("avg_close"))
             .orderBy(F.col("avg_close").desc_nulls_first(), F.col("sector").asc()))


def volume_by_exchange(prices: DataFrame, companies: DataFrame, exchanges: DataFrame,
                       report_date) -> DataFrame:
    """RPT-4: ``SUM(volume)`` per exchange name, widened so it cannot overflow."""
    j = _with_company(_on_date(prices, report_date), companies, "exchange_id")
    j = lookup(j, exchanges.select(F.col("id").alias("exchange_id"),
                                   F.col("name").alias("exchange")),
               "exchange_id", "inner")
    return (j.groupBy("exchange").agg(wide_sum("volume").alias("total_volume"))
             .orderBy(F.col("total_volume").desc_nulls_first(), F.col("exchange").asc()))
