"""SRC-7: implicit ids 1..n in input order, computed distributed."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tickwise.schemas import EXCHANGES_SCHEMA, SECTORS_SCHEMA
from tickwise.sources.seed import assign_ids, load_seed, load_seed_file


def test_assign_ids_dense_and_ordered_over_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("v"))
    out = assign_ids(df, "k", num_partitions=5).orderBy("id").collect()
    assert [r.id for r in out] == list(range(1, 5001))
    ks = [r.k for r in out]
    assert ks == sorted(ks)


def test_load_seed_implicit_ids(spark):
    rows = [("Technology",), ("Healthcare",), ("Financials",)]
    got = load_seed(spark, rows, SECTORS_SCHEMA, implicit_id=True).orderBy("id").collect()
    assert [(r.id, r.name) for r in got] == [(1, "Technology"), (2, "Healthcare"), (3, "Financials")]
    assert load_seed(spark, rows, SECTORS_SCHEMA, implicit_id=True).schema == SECTORS_SCHEMA


def test_load_seed_file_with_order_column(spark, scratch):
    path = os.path.join(scratch, "exchanges.csv")
    with open(path, "w") as f:
        f.write("name,code,line\nBeta Exchange,BX,2\nAlpha Exchange,AX,1\nGamma,,3\n")
    got = load_seed_file(spark, path, EXCHANGES_SCHEMA, implicit_id=True, order_col="line")
    assert [(r.id, r.name, r.code) for r in got.orderBy("id").collect()] == [
        (1, "Alpha Exchange", "AX"), (2, "Beta Exchange", "BX"), (3, "Gamma", None)]
