"""SNK-4: one CSV per report, named ``<report><date>.csv``, with a header row."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame


def report_path(out_dir: str, name: str, report_date) -> str:
    return os.path.join(out_dir, f"{name}{report_date}.csv")


def write_report_csv(df: DataFrame, out_dir: str, name: str, report_date) -> str:
    """Write a (small, bounded: top-n or one row per dimension member) report.

    ``coalesce(1)`` keeps the sorted order in one part file inside the
    ``<report><date>.csv`` folder.
    """
    path = report_path(out_dir, name, report_date)
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
