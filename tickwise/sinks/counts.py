"""AGG-7: counts of every ingested batch, kept with the store.

Under the store::

    counts/batches/writer=W/batch_id=N/   the counts of one batch
    counts/merged/version=V/              counts of all batches up to a clean-up

A batch that is run again replaces its own counts, so they survive the driver and
add up to the rows of the store: ``sum(ticks)`` is the number of stored ticks.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.sinks.files import finished_versions, read_or_empty, remove

COUNTS = ("envelopes", "malformed", "ticks")
COUNT_SCHEMA = T.StructType([*[T.StructField(c, T.LongType()) for c in COUNTS],
                             T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())])
KEPT_VERSIONS = 2


def batch_folder(store: str, writer: str, batch_id: int) -> str:
    return os.path.join(store, "counts", "batches", f"writer={writer}", f"batch_id={batch_id}")


def write_counts(spark: SparkSession, store: str, writer: str, batch_id: int, counts: dict) -> None:
    """Keep the counts of one batch; a sum over no envelopes is 0."""
    row = [counts.get(c) or 0 for c in COUNTS]
    (spark.createDataFrame([row], T.StructType(COUNT_SCHEMA.fields[:len(COUNTS)])).coalesce(1)
        .write.mode("overwrite").parquet(batch_folder(store, writer, batch_id)))


def read_counts(spark: SparkSession, store: str) -> DataFrame:
    """(writer, batch_id, envelopes, malformed, ticks) of every batch, the last run of each."""
    root = os.path.join(store, "counts", "merged")
    rows = read_or_empty(spark, os.path.join(store, "counts", "batches"), COUNT_SCHEMA).withColumn("own", F.lit(1))
    if versions := finished_versions(spark, root):
        merged = spark.read.schema(COUNT_SCHEMA).parquet(os.path.join(root, f"version={versions[-1]}"))
        rows = rows.unionByName(merged.withColumn("own", F.lit(0)))
    return rows.groupBy("writer", "batch_id").agg(*[F.max_by(c, "own").alias(c) for c in COUNTS])


def merge_counts(spark: SparkSession, store: str) -> None:
    """One table of all counts so far, so that reading does not follow the number of batches."""
    root = os.path.join(store, "counts", "merged")
    versions = finished_versions(spark, root)
    (read_counts(spark, store).select(*COUNT_SCHEMA.names).coalesce(1).write.mode("overwrite")
        .parquet(os.path.join(root, f"version={versions[-1] + 1 if versions else 0}")))
    for v in versions[:-KEPT_VERSIONS + 1]:
        remove(spark, os.path.join(root, f"version={v}"))
