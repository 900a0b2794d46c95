"""Ledger of consumed source ranges: a record is stored once, whichever query reads it (STR-3, SNK-2).

Under the store::

    ledger/batches/writer=W/batch_id=N/   ranges that one micro-batch stored; its presence commits the batch
    ledger/covered/version=V/             ranges of all batches up to a compaction, neighbours merged

A range is (source, partition, first, last) over consecutive offsets; ``source`` is the topic,
or the file of a text stream. A batch leaves out the records that ranges of other
batches cover, so a source that is read again from its start through a new checkpoint
adds only what the store lacks. A re-run batch ignores its own range and replaces
its own files. Ticks of a batch count only once its ledger folder is there, which is
written last: a batch that died half-way is neither read nor covered.

Two queries over one source must not run at the same time: each would miss
what the other has not committed yet.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.operators.joins import sized_broadcast
from tickwise.sinks.files import finished_versions, read_or_empty

RANGE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
COMMIT_SCHEMA = T.StructType([*RANGE_SCHEMA.fields, T.StructField("writer", T.StringType()),
                              T.StructField("batch_id", T.LongType())])
KEPT_VERSIONS = 2


def source_column(records: DataFrame) -> Column:
    """What names the source of a record: its ``source`` or topic, else one nameless source."""
    name = next((c for c in ("source", "topic") if c in records.columns), None)
    return F.col(name).cast("string") if name else F.lit("")


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Overlapping and neighbouring ranges of a partition as one; a single offset is a range too."""
    order = Window.partitionBy("source", "partition").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = ranges.select("source", "partition", "first", "last",
                           F.when(F.col("first") <= before + 1, 0).otherwise(1).alias("opens"))
    islands = marked.withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (islands.groupBy("source", "partition", "island")
            .agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island"))


def commits(spark: SparkSession, store: str) -> DataFrame:
    """Ranges of every committed batch; a batch without ticks has one row of nulls."""
    return read_or_empty(spark, os.path.join(store, "ledger", "batches"), COMMIT_SCHEMA)


def merged_cover(spark: SparkSession, store: str) -> DataFrame:
    root = os.path.join(store, "ledger", "covered")
    versions = finished_versions(spark, root)
    if not versions:
        return spark.createDataFrame([], RANGE_SCHEMA)
    return spark.read.schema(RANGE_SCHEMA).parquet(os.path.join(root, f"version={versions[-1]}"))


def covered(spark: SparkSession, store: str, writer: str = "", batch_id: int = -1) -> DataFrame:
    """Ranges that batches other than this one (of all batches, if none is named) have stored."""
    own = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
    others = commits(spark, store).filter(~own & F.col("first").isNotNull()).select(*RANGE_SCHEMA.names)
    return merged_cover(spark, store).unionByName(others)


def drop_covered(records: DataFrame, cover: DataFrame) -> DataFrame:
    """The records whose place no range covers (an equi-join on source and partition)."""
    c = sized_broadcast(cover.select(*[F.col(n).alias("covered_" + n) for n in RANGE_SCHEMA.names]))
    return records.join(c, (source_column(records) == F.col("covered_source"))
                        & (records["partition"] == F.col("covered_partition"))
                        & records["offset"].between(F.col("covered_first"), F.col("covered_last")), "left_anti")


def commit_batch(spark: SparkSession, store: str, writer: str, batch_id: int) -> None:
    """Enter what the landed files of a batch hold into the ledger; the batch counts from here on."""
    root = os.path.join(store, "landing")
    places = T.StructType([T.StructField("source", T.StringType()), T.StructField("partition", T.IntegerType()),
                           T.StructField("offset", T.LongType())])
    try:
        landed = (spark.read.schema(places).option("basePath", root)
                  .parquet(os.path.join(root, "trade_date=*", f"writer={writer}", f"batch_id={batch_id}")))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # a batch without ticks
            raise
        landed = spark.createDataFrame([], places)
    rows = merge_ranges(landed.filter("offset IS NOT NULL").select(
        F.coalesce("source", F.lit("")).alias("source"), "partition", F.col("offset").alias("first"),
        F.col("offset").alias("last")).distinct())
    mark = spark.createDataFrame([(None, None, None, None)], RANGE_SCHEMA)
    (rows.select(*RANGE_SCHEMA.names).unionByName(mark).coalesce(1).write.mode("overwrite")
        .parquet(os.path.join(store, "ledger", "batches", f"writer={writer}", f"batch_id={batch_id}")))


def merge_ledger(spark: SparkSession, store: str) -> None:
    """One version of all ranges so far, so that a batch reads few rows whatever the number of batches."""
    root = os.path.join(store, "ledger", "covered")
    versions = finished_versions(spark, root)
    every = merged_cover(spark, store).unionByName(
        commits(spark, store).filter("first IS NOT NULL").select(*RANGE_SCHEMA.names))
    merge_ranges(every).select(*RANGE_SCHEMA.names).write.mode("overwrite").parquet(
        os.path.join(root, f"version={versions[-1] + 1 if versions else 0}"))
