"""RPT-6: all five reports of one date, each written as a CSV."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators import reports as R
from tickwise.sinks.reports import write_report_csv


def build_reports(prices: DataFrame, companies: DataFrame, sectors: DataFrame,
                  exchanges: DataFrame, report_date) -> dict[str, DataFrame]:
    """The five reports by file name (``reports.REPORTS``), in the reference's order."""
    built = {
        "top_volume": R.top_volume(prices, companies, report_date),
        "top_gainers": R.top_gainers(prices, companies, report_date),
        "avg_close_by_sector": R.avg_close_by_sector(prices, companies, sectors, report_date),
        "volume_by_exchange": R.volume_by_exchange(prices, companies, exchanges, report_date),
        "top_losers": R.top_losers(prices, companies, report_date),
    }
    return {name: built[kind] for name, kind in R.REPORTS.items()}


def daily_report(prices: DataFrame, companies: DataFrame, sectors: DataFrame,
                 exchanges: DataFrame, report_date, out_dir: str) -> dict[str, str]:
    """Write the five CSVs; the one-day slice of ``prices`` is read once and shared."""
    day = prices.filter(F.col("date") == F.lit(str(report_date)).cast("date"))
    day = day.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {name: write_report_csv(df, out_dir, name, report_date)
                for name, df in build_reports(day, companies, sectors, exchanges,
                                              report_date).items()}
    finally:
        day.unpersist()
