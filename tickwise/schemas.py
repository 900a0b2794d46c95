"""Typed schemas of the relational tables, the tick record and the tick store.

The table schemas follow the reference DDL (types mapped to Spark); the key and
reference constraints are kept as data so that ``operators.checks`` can verify
a whole table in one pass instead of row by row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Tick record as decoded from a snapshot envelope; every field nullable, the
# timestamp stays a string ("yyyy-MM-dd HH:mm:ss", UTC) as produced upstream.
TICK_SCHEMA = T.StructType([
    T.StructField("current_price", T.DoubleType(), True),
    T.StructField("id", T.IntegerType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("percent_change", T.DoubleType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("volume", T.DoubleType(), True),
])

TICK_FIELDS = [f.name for f in TICK_SCHEMA.fields]

# Ingest sequence: an exact total order over stored ticks ("later wins").
# decimal(38,0) keeps aggregates keyed on it in HashAggregate (a struct key
# would force a sort-based aggregate).
SEQ_TYPE = T.DecimalType(38, 0)

# Tick store = tick + ingest sequence + parsed wall-clock time + partition column.
TICK_STORE_SCHEMA = T.StructType(TICK_SCHEMA.fields + [
    T.StructField("seq", SEQ_TYPE, True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("trade_date", T.DateType(), True),
])

# Stored with each tick: the query and micro-batch that wrote it.
LANDING_SCHEMA = T.StructType(TICK_STORE_SCHEMA.fields + [
    T.StructField("writer", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
])

# In the landed files also: the place of the tick's record in its source.
PLACE_FIELDS = [
    T.StructField("source", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
]

# One row for each finished compaction run, and the batches that it has merged.
RUN_SCHEMA = T.StructType([
    T.StructField("run", T.StringType(), True),
    T.StructField("finished", T.TimestampType(), True),
])
MERGED_SCHEMA = T.StructType([
    T.StructField("writer", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("run", T.StringType(), True),
])

PRICE_TYPE = T.DecimalType(10, 2)

SECTORS_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
])

INDUSTRIES_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("sector_id", T.IntegerType(), True),
    T.StructField("name", T.StringType(), False),
])

EXCHANGES_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("code", T.StringType(), True),
])

COMPANIES_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("sector_id", T.IntegerType(), True),
    T.StructField("industry_id", T.IntegerType(), True),
    T.StructField("exchange_id", T.IntegerType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("founded_year", T.IntegerType(), True),
])

PRICES_SCHEMA = T.StructType([
    T.StructField("company_id", T.IntegerType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open", PRICE_TYPE, True),
    T.StructField("high", PRICE_TYPE, True),
    T.StructField("low", PRICE_TYPE, True),
    T.StructField("close", PRICE_TYPE, True),
    T.StructField("volume", T.LongType(), True),
])

BAR_VALUE_COLUMNS = ["open", "high", "low", "close", "volume"]
BAR_KEY = ["company_id", "date"]


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    not_null: tuple[str, ...] = field(default=())


# Constraints of the reference DDL, as data.
TABLES: dict[str, TableSpec] = {
    "sectors": TableSpec("sectors", SECTORS_SCHEMA, ("id",), unique=(("name",),),
                         not_null=("name",)),
    "industries": TableSpec("industries", INDUSTRIES_SCHEMA, ("id",),
                            unique=(("sector_id", "name"),),
                            foreign_keys=(ForeignKey(("sector_id",), "sectors", ("id",)),),
                            not_null=("name",)),
    "exchanges": TableSpec("exchanges", EXCHANGES_SCHEMA, ("id",),
                           unique=(("name",), ("code",)), not_null=("name",)),
    "companies": TableSpec("companies", COMPANIES_SCHEMA, ("id",), unique=(("symbol",),),
                           foreign_keys=(ForeignKey(("sector_id",), "sectors", ("id",)),
                                         ForeignKey(("industry_id",), "industries", ("id",)),
                                         ForeignKey(("exchange_id",), "exchanges", ("id",))),
                           not_null=("symbol", "name")),
    "prices": TableSpec("prices", PRICES_SCHEMA, ("company_id", "date"),
                        foreign_keys=(ForeignKey(("company_id",), "companies", ("id",)),),
                        not_null=("date",)),
}
