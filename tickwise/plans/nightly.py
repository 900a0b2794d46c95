"""The nightly chain: ticks -> bars -> upsert into prices -> daily report.

Failures propagate (the reference swallowed them, so reports ran on stale
data and retries never started).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwise.operators.bars import daily_bars
from tickwise.plans.daily_report import daily_report
from tickwise.sinks.prices import upsert_bars
from tickwise.sources.tables import read_prices, read_ticks


def nightly(spark: SparkSession, ticks_path: str, companies: DataFrame, sectors: DataFrame,
            exchanges: DataFrame, prices_path: str, report_date, out_dir: str,
            since: str | None = None) -> dict[str, str]:
    """BAR-2 over the tick store (optionally only trade dates >= ``since``), then RPT-6."""
    ticks = read_ticks(spark, ticks_path, start_date=since)
    upsert_bars(spark, daily_bars(ticks, companies), prices_path, companies)
    prices = read_prices(spark, prices_path)
    return daily_report(prices, companies, sectors, exchanges, report_date, out_dir)
