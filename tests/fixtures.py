"""Hand-written tick and dimension rows for edge-case tests."""

from __future__ import annotations

from pyspark.sql import types as T

from tickwise.schemas import SEQ_TYPE, TICK_SCHEMA

TICK_WITH_SEQ = T.StructType(TICK_SCHEMA.fields + [T.StructField("seq", SEQ_TYPE, True)])

COMPANIES = [
    # id, symbol, name, sector_id, industry_id, exchange_id, country, founded_year
    (1, "AAAA", "Alpha", 1, 1, 1, "USA", 1990),
    (2, "BBBB", "Beta", 1, 1, 2, "USA", 1991),
    (3, "CCCC", "Gamma", 2, 2, 1, "Japan", 1992),
    (4, "DDDD", "Delta", None, None, None, None, None),
]


def tick(symbol, timestamp, price, open_=10.0, volume=1000.0, seq=0, name=None, pct=None, id_=None):
    from decimal import Decimal
    return (price, id_, name, open_, pct, symbol, timestamp, volume,
            None if seq is None else Decimal(seq))


def companies_df(spark):
    from tickwise.schemas import COMPANIES_SCHEMA
    return spark.createDataFrame(COMPANIES, COMPANIES_SCHEMA)


def ticks_df(spark, rows):
    return spark.createDataFrame(rows, TICK_WITH_SEQ)
