"""The latest tick of every symbol, kept as a small versioned table (MKT-1, JOB-3).

A version holds one row per symbol: the tick of highest ``seq`` among the version before
and the new ticks. ``seq`` is the record's place in its source, so versions are
ordered by what they hold, not by the batch numbers of whichever query writes: a
query restarted on a new checkpoint goes on from the newest version, ticks that
are read again change nothing, and a re-run batch is harmless. A version is read
when its job has finished. One query writes to the table at a time.

A poll costs the number of listings, not the history.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.functions.display import present
from tickwise.schemas import SEQ_TYPE
from tickwise.sinks.files import child_names, finished_versions, remove

VALUES = ("open", "current_price", "percent_change", "volume", "ts")
LATEST_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in VALUES[:-1]],
    T.StructField("ts", T.TimestampNTZType()), T.StructField("seq", SEQ_TYPE)])
KEPT_VERSIONS = 8


def _read(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(LATEST_SCHEMA).parquet(os.path.join(path, f"version={version}"))


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest version; empty before the first batch."""
    versions = finished_versions(spark, path)
    return _read(spark, path, versions[-1]) if versions else spark.createDataFrame([], LATEST_SCHEMA)


def newest_values() -> list[Column]:
    """The aggregates of the newest tick of a group, on numbers and times only."""
    return [*[F.max_by(c, "seq").alias(c) for c in VALUES], F.max("seq").alias("seq")]


def quoted(ticks: DataFrame) -> DataFrame:
    """What the table holds of a tick; ticks without a symbol are left out, NaN is a missing number."""
    return ticks.filter(F.col("symbol").isNotNull()).select(
        "symbol", *[present(c).alias(c) for c in VALUES[:-1]], "ts", F.col("seq").cast(SEQ_TYPE).alias("seq"))


def update_latest(new: DataFrame, path: str) -> bool:
    """Add a version with the ticks ``new`` (columns of the table); False if they change nothing."""
    spark = new.sparkSession
    versions = finished_versions(spark, path)
    old = read_latest(spark, path)
    newest = new.groupBy("symbol").agg(*newest_values()).checkpoint()
    known = old.select("symbol", F.col("seq").alias("known"))
    later = newest.join(known, "symbol", "left").filter("known IS NULL OR seq > known")
    if later.isEmpty():
        return False
    merged = old.unionByName(newest).groupBy("symbol").agg(*newest_values())
    number = max([int(n.split("=")[1]) for n in child_names(spark, path) if n.startswith("version=")], default=-1) + 1
    merged.coalesce(1).write.mode("overwrite").parquet(os.path.join(path, f"version={number}"))
    for v in versions[:-KEPT_VERSIONS]:  # long superseded
        remove(spark, os.path.join(path, f"version={v}"))
    return True
