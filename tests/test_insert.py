"""CHK-2/3 on load: new keys against stored keys, inserts with constraints, ranges of a JDBC read."""

from __future__ import annotations

import itertools
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text
from tickwise.operators import keycheck
from tickwise.operators.checks import ConstraintViolation
from tickwise.operators.keycheck import bits_of, key_filter, may_hold, stored_conflicts, word_of
from tickwise.schemas import SECTORS_SCHEMA
from tickwise.sinks.insert import insert_rows
from tickwise.sources.tables import quantile_bounds, range_predicates

KEYS = "a int, b string"


def conflicts(new, stored, keys=("a", "b")):
    return sorted(tuple(r) for r in stored_conflicts(new, stored, list(keys)).collect())


def test_conflicts_are_exact_whatever_the_filter_lets_through(spark):
    new = spark.range(0, 3000, 3).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b"))
    stored = spark.range(1000, 9000, 2).select(F.col("id").cast("int").alias("a"),
                                               F.when(F.col("id") % 5 > 0, "x").alias("b"))
    want = [(i, "x", 1, 1) for i in range(0, 3000, 3) if i >= 1000 and i % 2 == 0 and i % 5]
    assert conflicts(new, stored) == want
    few = keycheck.BITS_PER_KEY
    try:
        keycheck.BITS_PER_KEY = 1  # a crowded filter lets many through; the result is the same
        assert conflicts(new, stored) == want
    finally:
        keycheck.BITS_PER_KEY = few


def test_conflicts_nulls_repeats_empty_and_other_columns(spark):
    new = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (None, "y"), (3, "z")], KEYS)
    stored = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, None), (None, "y")], KEYS)
    clash = stored.withColumn("word", F.lit(7)).withColumn("n_new", F.lit("?")).withColumn("bits", F.lit(0))
    assert conflicts(new, clash) == [(1, "x", 2, 3)]
    assert conflicts(new.limit(0), stored) == []
    assert conflicts(new, stored.limit(0)) == []
    assert conflicts(new.filter("b IS NULL"), stored) == []


def test_keys_are_compared_in_the_stored_types(spark):
    new = spark.createDataFrame([(5, "2024-01-02")], "a long, b string")
    stored = spark.createDataFrame([(5, "2024-01-02")], KEYS).withColumn("b", F.col("b").cast("date"))
    assert [(r.a, r.n_stored) for r in stored_conflicts(new, stored, ["a", "b"]).collect()] == [(5, 1)]


def test_filter_holds_every_key_and_few_others(spark):
    new = spark.range(20_000).select(F.col("id").alias("k"))
    words = 20_000 * keycheck.BITS_PER_KEY // keycheck.WORD_BITS
    bloom = key_filter(new, ["k"], words)
    assert bloom.count() <= words
    assert may_hold(new, ["k"], bloom, words).count() == 20_000
    others = spark.range(1_000_000, 1_100_000).select(F.col("id").alias("k"))
    assert may_hold(others, ["k"], bloom, words).count() < 5_000
    one = new.select(word_of(["k"], words).alias("w"), bits_of(["k"]).alias("b")).first()
    assert 0 <= one.w < words and 1 <= bin(one.b & (2**64 - 1)).count("1") <= keycheck.KEY_BITS


def test_stored_side_is_not_shuffled_and_pruned(spark, scratch):
    path = os.path.join(scratch, "stored")
    spark.range(0, 100_000, 1, 8).select(F.col("id").alias("k")).write.parquet(path)
    new = spark.range(500, 900).select(F.col("id").alias("k"))
    plan = plan_text(stored_conflicts(new, spark.read.parquet(path), ["k"]), "simple")
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    # between the scan of the stored rows and their filter's join lies no exchange but the broadcast
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    semi = max(i for i, line in enumerate(lines[:scan]) if "LeftSemi" in line)
    assert not any("Exchange hashpartitioning" in line for line in lines[semi:scan])
    assert "GreaterThanOrEqual(k,500)" in plan and "LessThanOrEqual(k,899)" in plan


def test_filter_beyond_the_broadcast_bound_joins_the_keys(spark, monkeypatch):
    monkeypatch.setattr(keycheck.joins, "is_broadcastable", lambda df: False)
    new = spark.createDataFrame([(1, "x"), (4, "y")], KEYS)
    stored = spark.createDataFrame([(1, "x"), (2, "y")], KEYS)
    assert conflicts(new, stored) == [(1, "x", 1, 1)]


def test_insert_refuses_stored_keys_and_writes_all_or_nothing(spark, scratch):
    path = os.path.join(scratch, "sectors")

    def insert(*rows):
        return insert_rows(spark, "sectors", spark.createDataFrame(list(rows), SECTORS_SCHEMA), path)

    def stored():
        return sorted(tuple(r) for r in spark.read.parquet(path).collect())

    insert((1, "Tech"), (2, "Energy"))
    insert((3, "Health"))
    assert stored() == [(1, "Tech"), (2, "Energy"), (3, "Health")]
    for rows, key in ((((2, "Other"), (9, "New")), "id"), (((8, "Health"), (9, "New")), "name"),
                      (((9, "New"), (9, "Newer")), "primary_key")):
        with pytest.raises(ConstraintViolation, match=key):
            insert(*rows)
    assert stored() == [(1, "Tech"), (2, "Energy"), (3, "Health")]
    with pytest.raises(ConstraintViolation):  # a load that is run again
        insert((3, "Health"))


def test_jdbc_ranges_meet_every_row_once_and_are_even(spark):
    ids = spark.range(10_000).select((F.col("id") * F.col("id")).alias("id"))  # gaps that grow
    bounds = quantile_bounds(ids, "id", 8)
    assert bounds == sorted(set(bounds)) and len(bounds) == 7
    parts = range_predicates("id", bounds)
    con = duckdb.connect()
    con.execute("CREATE TABLE k AS SELECT range * range AS id FROM range(10000) UNION ALL SELECT NULL UNION ALL SELECT -5")
    counts = [con.execute(f"SELECT count(*) FROM k WHERE {p}").fetchone()[0] for p in parts]
    assert sum(counts) == 10_002 and max(counts) < 1.1 * 10_002 / 8
    for p, q in itertools.combinations(parts, 2):
        assert con.execute(f"SELECT count(*) FROM k WHERE ({p}) AND ({q})").fetchone()[0] == 0
    assert range_predicates("id", []) == ["1 = 1"]
    assert quantile_bounds(ids.limit(0), "id", 8) == [] and quantile_bounds(ids, "id", 1) == []
    same = quantile_bounds(spark.range(10).select(F.lit(3).alias("id")), "id", 4)
    assert range_predicates("id", same) == ["id < 3 OR id IS NULL", "id >= 3"]
