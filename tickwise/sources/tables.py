"""SRC-3/5/6/8: typed table scans, tick-store scans and previews."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.schemas import LANDING_SCHEMA, PRICES_SCHEMA, TABLES
from tickwise.sinks.dated import read_dated
from tickwise.sinks.files import read_or_empty
from tickwise.sinks.ticks import finished_runs, landed_batches


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Scan a table; with ``schema`` the result is conformed to it (``DataFrame.to``)."""
    df = spark.read.format(fmt).load(path)
    return df.to(schema) if schema is not None else df


def read_reference_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One of sectors / industries / exchanges / companies / prices, typed."""
    return read_table(spark, path, TABLES[name].schema)


def quantile_bounds(keys: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list:
    """At most ``parts - 1`` increasing values that cut ``column`` into ranges of like row counts.

    ``keys`` is any table with the key, say the copy that the last load left. One
    aggregate with partial sketches; ``parts - 1`` numbers reach the driver.
    """
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    cuts = keys.agg(F.percentile_approx(column, at, accuracy)).first()[0] or []
    return sorted(set(cuts))


def range_predicates(column: str, bounds: list) -> list[str]:
    """SQL conditions that every row meets exactly one of, NULL keys and rows beyond the bounds too."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:], strict=False)]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *inner, f"{column} >= {bounds[-1]}"]


def read_jdbc_table(spark: SparkSession, url: str, table: str, schema: T.StructType | None = None,
                    key: str | None = None, bounds: list | None = None, **options: str) -> DataFrame:
    """The same table read through JDBC (needs the driver jar on the classpath).

    With a numeric ``key`` and ``bounds`` (``quantile_bounds``) the read is one task and
    connection for each range; otherwise it is a single one. Ranges of like row counts
    hold where ids have gaps, which equal strides between two ends would not.
    """
    if key is not None:
        df = spark.read.jdbc(url, table, predicates=range_predicates(key, bounds or []), properties=options)
    else:
        df = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()
    return df.to(schema) if schema is not None else df


def read_ticks(spark: SparkSession, path: str, start_date: str | None = None,
               end_date: str | None = None) -> DataFrame:
    """SRC-3: scan the tick store (layout: ``sinks.ticks``); a trade-date range prunes partitions."""
    compacted = read_or_empty(spark, os.path.join(path, "compacted"),
                              T.StructType([*LANDING_SCHEMA.fields, T.StructField("run", T.StringType())]))
    runs = finished_runs(spark, path).select("run").distinct()
    df = (compacted.join(runs, "run", "left_semi").select(*LANDING_SCHEMA.names)
          .unionByName(landed_batches(spark, path)))
    if start_date is not None:
        df = df.filter(F.col("trade_date") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        df = df.filter(F.col("trade_date") <= F.lit(end_date).cast("date"))
    return df


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """The prices table as the last finished upsert left it; empty if there was none."""
    prices = read_dated(spark, path, PRICES_SCHEMA)
    return prices if prices is not None else spark.createDataFrame([], PRICES_SCHEMA)


def preview(df: DataFrame, n: int = 1, order: str = "seq") -> DataFrame:
    """SRC-5: the first ``n`` rows by ``order`` (the reference logs the first document)."""
    return df.orderBy(order).limit(n)
