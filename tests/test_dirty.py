"""Ticks with bad times, missing numbers and values out of range."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF01
from tickwise.functions.display import change_class, money, percent, thousands
from tickwise.functions.time import parse_tick_ts
from tickwise.operators.bars import daily_bars
from tickwise.operators.checks import check_foreign_key, require_valid, validate_table, ConstraintViolation


@pytest.mark.parametrize("text, want", [
    ("2024-01-02 18:00:00", dt.datetime(2024, 1, 2, 18)), ("2024-1-2 8:0:5", dt.datetime(2024, 1, 2, 8, 0, 5)),
    ("24-01-02 18:00:00", None), ("20240-01-02 18:00:00", None), ("2024-02-30 18:00:00", None), ("", None),
    ("2024-01-02T18:00:00", None), ("2024-01-02", None), (None, None), ("2024-03-10 02:30:00", dt.datetime(2024, 3, 10, 2, 30))])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse(spark, text, want, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = spark.createDataFrame([(text,)], "t string").select(parse_tick_ts("t")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want


def test_all_reasons_occur_and_no_zone_changes_them(spark):
    def rows(session):
        return sorted(map(str, E.queries()["dirty_tick_rejects"](session, SF01).collect()))
    utc = rows(spark)
    reasons = {r["reject_reason"] for r in E.queries()["dirty_tick_rejects"](spark, SF01).collect()}
    assert reasons == {"no_symbol", "missing_timestamp", "bad_timestamp", "price_out_of_range",
                       "volume_out_of_range", "unknown_symbol"}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert rows(spark) == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_missing_numbers_have_their_own_display(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.0,), (-1.5,)], "x double")
    got = df.select(money("x"), percent("x"), thousands("x"), change_class("x")).collect()
    assert [tuple(r) for r in got] == [("-", "-", "-", "negative")] * 2 + [
        ("$0.00", "0.00%", "0", "positive"), ("$-1.50", "-1.50%", "-1.5", "negative")]


def test_a_symbol_listed_twice_does_not_double_bars(spark):
    from tests.fixtures import tick, ticks_df
    comps = spark.createDataFrame([(2, "AAAA"), (1, "AAAA")], "id int, symbol string")
    bars = daily_bars(ticks_df(spark, [tick("AAAA", "2024-01-02 18:00:00", 3.0, seq=1)]), comps).collect()
    assert [b.company_id for b in bars] == [1]


def test_checks_cannot_be_skipped(spark):
    df = spark.createDataFrame([(1, "AAAA", "n", 7, None, None, None, None)], "id int, symbol string, name string, "
                               "sector_id int, industry_id int, exchange_id int, country string, founded_year int")
    with pytest.raises(ValueError, match="sectors"):
        validate_table("companies", df)
    parents = {t: spark.createDataFrame([(1,)], "id int") for t in ("sectors", "industries", "exchanges")}
    with pytest.raises(ConstraintViolation, match="foreign_key:sector_id"):
        require_valid("companies", df, parents)
    good = df.withColumn("sector_id", F.lit(1))
    assert require_valid("companies", good, parents) is good


def test_violations_keep_the_column_order(spark):
    child = spark.createDataFrame([("x", 5)], "name string, ref int")
    bad = check_foreign_key(child, "ref", spark.createDataFrame([(1,)], "id int"), "id")
    assert bad.columns == ["name", "ref"] and bad.count() == 1
