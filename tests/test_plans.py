"""Plan-shape checks: shuffles, partial aggregation, pushdown, broadcast."""

from __future__ import annotations

import os
import re
import shutil

from pyspark.sql import functions as F

from tests.conftest import SF01, plan_text
from tickwise.operators.bars import daily_bars
from tickwise.operators.joins import is_broadcastable, sized_broadcast
from tickwise.operators.snapshot import market_snapshot
from tickwise.operators.ticks import session_scan
from tickwise.sources import adapters as A


def test_bars_single_hash_exchange_with_partial_aggregate(spark):
    # on a tick-store shaped input (no adapter joins)
    t = A.ticks(spark, SF01).select("symbol", "timestamp", "open", "current_price", "volume",
                                    "seq", "ts", "trade_date")
    t = spark.createDataFrame(t.collect(), t.schema)  # a leaf relation
    txt = plan_text(daily_bars(t, A.companies(spark, SF01)))
    # the (symbol, date) aggregate, and the one that makes symbols of the lookup unique
    assert len(re.findall(r"\(\d+\) Exchange\b", txt)) == 2, txt
    assert "partial_max_by" in txt and "SortAggregate" not in txt
    assert "BroadcastHashJoin" in txt


def test_snapshot_stays_hash_aggregate(spark):
    txt = plan_text(market_snapshot(A.ticks(spark, SF01), A.companies(spark, SF01)))
    assert "SortAggregate" not in txt and "partial_max_by" in txt


def test_session_scan_pushes_symbol_filter(spark):
    ev = A.table(spark, SF01, "events")
    t = ev.select(F.col("value").alias("current_price"), F.lit(None).cast("int").alias("id"),
                  F.lit(None).cast("string").alias("name"), F.col("value").alias("open"),
                  F.lit(None).cast("double").alias("percent_change"),
                  F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("symbol"),
                  F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
                  F.lit(1.0).alias("volume"), F.col("event_id").cast("decimal(38,0)").alias("seq"))
    out = session_scan(t, "S7", "2024-01-22")
    assert out.filter(F.col("symbol") != "S7").count() == 0


def test_sized_broadcast_checks_bound(spark):
    small = spark.range(10)
    assert is_broadcastable(small)
    assert not is_broadcastable(spark.range(1000), max_bytes=100)
    assert "BroadcastHashJoin" in plan_text(spark.range(100).join(sized_broadcast(small), "id"))


def test_report_date_reaches_the_tick_scan(spark):
    from tickwise.operators.reports import top_volume
    c = A.companies(spark, SF01)
    txt = plan_text(top_volume(daily_bars(A.ticks(spark, SF01), c), c, "2024-01-22"))
    assert re.search(r"PartitionFilters: \[[^\]]*trade_date[^\]]*2024-01-22", txt), txt


def test_queries_read_the_stored_tick_table(spark):
    # the per-user aggregate of the adapter ran when the table was written
    txt = plan_text(daily_bars(A.ticks(spark, SF01), A.companies(spark, SF01)))
    assert "min_by" not in txt and "events.parquet" not in txt


def test_size_probe_has_no_limit_and_one_row_per_partition(spark, monkeypatch):
    # the measuring aggregate must not gather rows in one task
    from pyspark.sql.classic.dataframe import DataFrame
    from tickwise.operators import joins
    seen = []
    first = DataFrame.first
    monkeypatch.setattr(DataFrame, "first", lambda self: (seen.append(plan_text(self)), first(self))[1])
    assert joins.is_broadcastable(spark.range(1000).withColumn("s", F.lit("x")))
    assert seen and "Limit" not in seen[0] and "partial_count" in seen[0]


def test_rewritten_table_is_measured_again(spark, scratch):
    path = scratch + "/t"
    spark.range(10).coalesce(1).write.parquet(path)
    (name,) = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert is_broadcastable(spark.read.parquet(path + "/" + name), max_bytes=1000)
    spark.range(100_000).coalesce(1).write.parquet(scratch + "/u")
    (other,) = [f for f in os.listdir(scratch + "/u") if f.endswith(".parquet")]
    shutil.copy(f"{scratch}/u/{other}", f"{path}/{name}")  # the same name, other content
    crc = f"{path}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert not is_broadcastable(spark.read.parquet(path + "/" + name), max_bytes=1000)


def test_bar_date_prunes_tick_store_partitions(spark, scratch):
    from tests.fixtures import tick, ticks_df
    from tickwise.sinks.ticks import write_tick_batch
    from tickwise.sources.tables import read_ticks
    path = scratch + "/ticks"
    rows = [tick("AAAA", f"2024-01-0{d} 18:00:00", 10.0 + d, seq=d) for d in (1, 2, 3)]
    write_tick_batch(ticks_df(spark, rows), 0, path, "w")
    bars = daily_bars(read_ticks(spark, path), A.companies(spark, SF01))
    one_day = bars.filter(F.col("date") == F.lit("2024-01-02").cast("date"))
    txt = plan_text(one_day)
    assert re.search(r"PartitionFilters: \[[^\]]*trade_date", txt), txt


def test_every_registered_query_has_a_scalable_plan(spark):
    """Plan hygiene over all of ``queries()``: no all-pairs join, no Python
    UDF, no sort-based aggregate, one scan of the fact table, and column
    pruning reaches the scans."""
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    for name, fn in E.queries().items():
        if name in E.LLM_QUERIES:
            continue
        txt = plan_text(fn(spark, sf))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                    "ArrowEvalPython", "SortAggregate"):
            assert bad not in txt, (name, bad)
        # one pass over the fact table
        assert txt.count("events.parquet") + len(re.findall(r"Location:.*/ticks-", txt)) <= 1, name
        if name != "check_foreign_key":  # returns whole child rows by definition
            # (plans that start from a checkpoint have no scan left to check)
            reads = [ln for ln in txt.splitlines() if ln.startswith("ReadSchema")]
            assert not any("event_type" in ln for ln in reads), (name, reads)


def test_size_check_measures_long_strings(spark):
    # ten rows, but 10 MB of text: the row count alone would pass a 5 MB budget
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1_000_000).alias("s"))
    assert not is_broadcastable(wide, max_bytes=5 * 1024 * 1024)
    assert is_broadcastable(wide, max_bytes=64 * 1024 * 1024)
    nested = spark.range(3).select(F.array(F.lit("abc"), F.lit("de")).alias("a"))
    assert is_broadcastable(nested, max_bytes=10_000)


def test_symbol_lookups_do_not_read_the_nation_side(spark):
    # companies left-joins nation only for exchange_id; a symbol -> id lookup
    # does not use it, and the key-distinct nation side lets the join go
    txt = plan_text(daily_bars(A.ticks(spark, SF01), A.companies(spark, SF01)))
    assert "nation.parquet" not in txt, txt
