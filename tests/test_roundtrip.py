"""JOB-3 then JOB-1 returns the original ticks; records respect the size bound."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SF001
from tickwise.operators.decode import decode_ticks
from tickwise.functions.order import POSITION_LIMIT
from tickwise.operators.encode import encode_snapshots
from tickwise.schemas import TICK_FIELDS
from tickwise.sources import adapters as A


def test_round_trip_sf0001(spark):
    ticks = A.ticks(spark, SF001).select(*TICK_FIELDS, "seq")
    env = encode_snapshots(ticks)
    back = decode_ticks(env)
    assert ticks.select(*TICK_FIELDS).exceptAll(back).count() == 0
    assert back.exceptAll(ticks.select(*TICK_FIELDS)).count() == 0
    # one timestamp per record
    n_ts = ticks.select("timestamp").distinct().count()
    assert env.count() == n_ts


def test_record_size_bound(spark):
    ticks = A.ticks(spark, SF001).select(*TICK_FIELDS, "seq").withColumn(
        "timestamp", F.lit("2024-01-01 18:00:00"))      # one hot timestamp
    whole = encode_snapshots(ticks).select(F.json_array_length("value").alias("n")).collect()
    assert [r.n for r in whole] == [ticks.count()]          # one poll is one record
    env = encode_snapshots(ticks, max_bytes=16_000)
    sizes = env.select(F.json_array_length("value").alias("n")).collect()
    assert len(sizes) > 1 and sum(r.n for r in sizes) == ticks.count()


def test_one_symbol_and_small_ticks_are_split_too(spark):
    ticks = A.ticks(spark, SF001).select(*TICK_FIELDS, "seq").withColumns(
        {"timestamp": F.lit("2024-01-01 18:00:00"), "symbol": F.lit("S1")})
    records = encode_snapshots(ticks, max_bytes=16_000).select(F.octet_length("value").alias("n")).collect()
    assert len(records) > 5 and max(r.n for r in records) < 32_000
    empty = spark.range(100_000).select(
        *[F.lit(None).cast(ticks.schema[c].dataType).alias(c) for c in TICK_FIELDS], F.col("id").alias("seq"))
    lengths = [r.n for r in encode_snapshots(empty, max_bytes=900_000)
               .select(F.json_array_length("value").alias("n")).collect()]
    assert sum(lengths) == 100_000 and max(lengths) < POSITION_LIMIT


def test_ranges_of_seq_bound_the_ticks_of_a_record(spark):
    ticks = A.ticks(spark, SF001).select(*TICK_FIELDS, "seq").withColumn("timestamp", F.lit("2024-01-01 18:00:00"))
    env = encode_snapshots(ticks, max_ticks=64)
    sizes = [r.n for r in env.select(F.json_array_length("value").alias("n")).collect()]
    assert max(sizes) <= 64 and sum(sizes) == ticks.count()
    assert decode_ticks(env).exceptAll(ticks.select(*TICK_FIELDS)).count() == 0
    # the numbers that an ingest order makes have up to 38 digits
    top = ticks.withColumn("seq", F.col("seq") + F.lit("85070591730234615865843651857942052863").cast("decimal(38,0)"))
    assert encode_snapshots(top, max_ticks=4096).count() < ticks.count()
