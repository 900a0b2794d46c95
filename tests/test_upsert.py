"""BAR-2 / SNK-3: keyed upsert into a date-partitioned prices table."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from tests.conftest import SF001, plan_text
from tickwise.operators.bars import daily_bars
from tickwise.operators.checks import ConstraintViolation
from tickwise.schemas import PRICES_SCHEMA
from tickwise.sinks.prices import merge_bars, upsert_bars
from tickwise.sources import adapters as A
from tickwise.sources.tables import read_prices

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def _bars(spark, rows):
    return spark.createDataFrame(
        [(c, d, Decimal(o), Decimal(o), Decimal(o), Decimal(o), v) for c, d, o, v in rows],
        PRICES_SCHEMA)


def _table(spark, path):
    return sorted((r.company_id, r.date, r.close, r.volume) for r in read_prices(spark, path).collect())


def test_upsert_inserts_replaces_and_keeps(spark, scratch):
    path = os.path.join(scratch, "prices")
    upsert_bars(spark, _bars(spark, [(1, D1, "1", 10), (2, D1, "2", 20), (1, D2, "3", 30)]), path)
    upsert_bars(spark, _bars(spark, [(2, D1, "9", 90), (3, D3, "4", 40)]), path)
    assert _table(spark, path) == [
        (1, D1, Decimal("1.00"), 10), (1, D2, Decimal("3.00"), 30),
        (2, D1, Decimal("9.00"), 90), (3, D3, Decimal("4.00"), 40)]


def test_upsert_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "prices")
    bars = _bars(spark, [(1, D1, "1", 10), (2, D2, "2", 20)])
    upsert_bars(spark, bars, path)
    first = _table(spark, path)
    upsert_bars(spark, bars, path)
    assert _table(spark, path) == first


def test_untouched_dates_are_not_rewritten(spark, scratch):
    path = os.path.join(scratch, "prices")
    upsert_bars(spark, _bars(spark, [(1, D1, "1", 10), (1, D2, "2", 20)]), path)
    d1_dir = os.path.join(path, "date=2024-01-01")
    before = sorted(os.listdir(d1_dir))
    upsert_bars(spark, _bars(spark, [(1, D2, "5", 50)]), path)
    assert sorted(os.listdir(d1_dir)) == before


def test_merge_bars_dataframe(spark):
    old = _bars(spark, [(1, D1, "1", 10), (2, D1, "2", 20)])
    new = _bars(spark, [(2, D1, "7", 70)])
    got = sorted((r.company_id, r.volume) for r in merge_bars(old, new).collect())
    assert got == [(1, 10), (2, 70)]


def test_date_filter_prunes_partitions(spark, scratch):
    path = os.path.join(scratch, "prices")
    upsert_bars(spark, _bars(spark, [(1, D1, "1", 10), (1, D2, "2", 20)]), path)
    from pyspark.sql import functions as F
    df = read_prices(spark, path).filter(F.col("date") == F.lit("2024-01-02").cast("date"))
    txt = plan_text(df)
    assert "PartitionFilters: [isnotnull(date" in txt
    assert df.count() == 1


def test_merge_replaces_with_null_values_too(spark):
    # the conflict update sets all five values from the re-delivered row,
    # so a NULL there replaces a stored value
    old = _bars(spark, [(1, D1, "1", 10)])
    new = spark.createDataFrame([(1, D1, None, None, None, None, None)], PRICES_SCHEMA)
    (row,) = merge_bars(old, new).collect()
    assert (row.open, row.high, row.low, row.close, row.volume) == (None,) * 5


def test_merge_is_one_shuffle_on_the_key(spark):
    import re
    old = _bars(spark, [(1, D1, "1", 10)])
    new = _bars(spark, [(1, D1, "2", 20)])
    txt = plan_text(merge_bars(old, new))
    assert len(re.findall(r"\(\d+\) Exchange\b", txt)) == 1, txt
    assert "SortMergeJoin" not in txt and "SortAggregate" not in txt


def test_a_large_date_is_written_by_several_tasks(spark, scratch):
    path = os.path.join(scratch, "prices")
    wide = spark.range(20_000).selectExpr(
        "cast(id AS int) AS company_id", "DATE'2024-01-02' AS date", "cast(id % 977 AS decimal(10,2)) AS open",
        "cast(id % 883 AS decimal(10,2)) AS high", "cast(id % 787 AS decimal(10,2)) AS low",
        "cast(id % 677 AS decimal(10,2)) AS close", "id * 7919 % 1000003 AS volume")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        upsert_bars(spark, wide, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    (load,) = os.listdir(os.path.join(path, "date=2024-01-02"))
    files = [f for f in os.listdir(os.path.join(path, "date=2024-01-02", load)) if f.endswith(".parquet")]
    assert len(files) > 1 and read_prices(spark, path).count() == 20_000


def test_only_a_missing_path_counts_as_no_table(spark, scratch):
    path = os.path.join(scratch, "prices")
    os.makedirs(os.path.join(path, "date=2024-01-01"))
    with open(os.path.join(path, "date=2024-01-01", "part-0.parquet"), "w") as fh:
        fh.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        upsert_bars(spark, _bars(spark, [(1, D1, "1", 10)]), path)
    assert os.path.exists(os.path.join(path, "date=2024-01-01", "part-0.parquet"))


def test_upsert_refuses_bars_that_break_the_constraints(spark, scratch):
    path = os.path.join(scratch, "prices")
    comps = spark.createDataFrame([(1, "AAAA")], "id int, symbol string")
    twice = _bars(spark, [(1, D1, "1", 10), (1, D1, "2", 20)])
    for bars, kw in ((twice, {}), (twice, {"companies": comps}), (_bars(spark, [(9, D1, "1", 1)]), {"companies": comps})):
        with pytest.raises(ConstraintViolation):
            upsert_bars(spark, bars, path, **kw)
    assert not os.path.exists(path)


def test_first_load_takes_ticks_whose_numbers_do_not_follow_time(spark, tmp_path):
    import __spark_entry__ as entry
    for name in ("supplier", "nation", "region"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    events = spark.read.parquet(f"{SF001}/events.parquet")
    last = events.agg(F.max("event_id")).first()[0]
    backward = (F.lit(last) - F.col("event_id")).cast(events.schema["event_id"].dataType)
    events.withColumn("event_id", backward).write.parquet(f"{tmp_path}/events.parquet")
    first = F.col("date") < entry.RERUN_FROM
    got = entry.q_upsert_bars(spark, str(tmp_path)).filter(first).select("company_id", "date")
    want = daily_bars(A.ticks(spark, str(tmp_path)), A.companies(spark, str(tmp_path)), entry.EARLY_OPEN
                      ).filter(first).select("company_id", "date")
    assert want.count() > 0 and want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
