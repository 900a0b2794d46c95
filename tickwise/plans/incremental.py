"""Bars from new batches only, and bars of symbols that are listed later (BAR-1, JOIN-5, JOIN-6, SRC-7).

The state of a (symbol, day) is what ``session_aggregates`` gives of its ticks so far:
extremes, greatest volume, and the values of the closing mark of highest ``seq``. Two
states merge into the state of both sets of ticks, in any order and however often, so a
run reads only batches that no run has folded; late and repeated ticks come out as
in a job over the whole history.

State is kept by symbol, listed or not, and is far smaller than the ticks. A
(symbol, day) that changes while its symbol is not listed waits in the backlog;
a run that finds the symbol among the companies makes its bars from the state,
without reading a tick of the past.

Layout under the state's path: the dated table of ``sinks.dated``, ``_folded`` (batches
and compaction runs that are in it) and ``_backlog/version=N``. A run that dies
is made good by the next: states are published before batches count as
folded, and prices before the backlog is written. One run of a state at a time.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.operators.bars import bars_of, session_aggregates
from tickwise.operators.joins import sized_broadcast
from tickwise.schemas import LANDING_SCHEMA, SEQ_TYPE
from tickwise.session import checkpoint_root
from tickwise.sinks.dated import publish_dates, read_dated, touched_rows
from tickwise.sinks.files import child_names, finished_versions, read_or_empty, remove
from tickwise.sinks.prices import upsert_bars
from tickwise.sinks.ticks import finished_runs, merged_batches, open_batches

STATE_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in ("open_raw", "close_raw", "high_raw", "low_raw")]
    + [T.StructField("volume", T.LongType()), T.StructField("mark_seq", SEQ_TYPE)])
STATE_KEY = ["symbol", "date"]
KEY_SCHEMA = T.StructType(STATE_SCHEMA.fields[:2])
FOLDED_SCHEMA = T.StructType([T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType()),
                              T.StructField("run", T.StringType())])
BATCH = ["writer", "batch_id"]


def merge_states(states: DataFrame) -> DataFrame:
    """One state per key of several; merging a state twice changes nothing."""
    return states.groupBy(*STATE_KEY).agg(
        F.max_by("open_raw", "mark_seq").alias("open_raw"), F.max_by("close_raw", "mark_seq").alias("close_raw"),
        F.max("high_raw").alias("high_raw"), F.min("low_raw").alias("low_raw"),
        F.max("volume").alias("volume"), F.max("mark_seq").alias("mark_seq"))


def unfolded(spark: SparkSession, ticks_path: str, state_path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the state lacks: landed batches, compaction runs to read, and runs whose batches it has."""
    folded = read_or_empty(spark, os.path.join(state_path, "_folded"), FOLDED_SCHEMA)
    batches = folded.filter("run IS NULL").select(*BATCH).distinct()
    landed = open_batches(spark, ticks_path).join(batches, BATCH, "left_anti").checkpoint()
    runs = (finished_runs(spark, ticks_path).select("run").distinct()
            .join(folded.filter("run IS NOT NULL").select("run").distinct(), "run", "left_anti"))
    # a run's list of batches may be removed already; then the run is read
    listed = (merged_batches(spark, ticks_path).join(batches.withColumn("known", F.lit(True)), BATCH, "left")
              .groupBy("run").agg(F.every(F.col("known").isNotNull()).alias("known")))
    runs = runs.join(listed, "run", "left").select("run", F.coalesce("known", F.lit(False)).alias("known")).checkpoint()
    return landed, runs.filter("NOT known").select("run"), runs.filter("known").select("run")


def fold_bars(spark: SparkSession, ticks_path: str, state_path: str) -> DataFrame | None:
    """Fold the batches that are new into the state; returns the (symbol, date) keys they touch, None if there are none."""
    checkpoint_root(spark)
    landed, to_read, known = unfolded(spark, ticks_path, state_path)
    nothing = landed.isEmpty() and to_read.isEmpty()
    changed = None
    if not nothing:
        landing = read_or_empty(spark, os.path.join(ticks_path, "landing"), LANDING_SCHEMA)
        compacted = read_or_empty(spark, os.path.join(ticks_path, "compacted"),
                                  T.StructType([*LANDING_SCHEMA.fields, T.StructField("run", T.StringType())]))
        # semi joins on partition columns: only folders of new batches and runs are read
        ticks = (landing.join(sized_broadcast(landed), BATCH, "left_semi")
                 .unionByName(compacted.join(sized_broadcast(to_read), "run", "left_semi").drop("run")))
        new = session_aggregates(ticks).select(*STATE_SCHEMA.names).checkpoint()
        changed = new.select(*STATE_KEY)
        old = touched_rows(spark, state_path, STATE_SCHEMA, new.select("date").distinct())
        merged = merge_states(new if old is None else old.unionByName(new)).checkpoint()
        publish_dates(spark, merged, state_path, STATE_SCHEMA)
    none = F.lit(None)
    marks = (landed.select(*BATCH, none.cast("string").alias("run"))
             .unionAll(to_read.unionAll(known).select(none.cast("string").alias("writer"),
                                                      none.cast("long").alias("batch_id"), "run")))
    if not nothing or not known.isEmpty():
        marks.coalesce(1).write.mode("append").parquet(os.path.join(state_path, "_folded"))
    return changed


def read_backlog(spark: SparkSession, state_path: str) -> DataFrame:
    """(symbol, date) of states whose symbol was not listed when they last changed."""
    root = os.path.join(state_path, "_backlog")
    versions = finished_versions(spark, root)
    if not versions:
        return spark.createDataFrame([], KEY_SCHEMA)
    return spark.read.schema(KEY_SCHEMA).parquet(os.path.join(root, f"version={versions[-1]}"))


def _write_backlog(spark: SparkSession, rows: DataFrame, state_path: str) -> None:
    root = os.path.join(state_path, "_backlog")
    versions = finished_versions(spark, root)
    number = max([int(n.split("=")[1]) for n in child_names(spark, root) if n.startswith("version=")], default=-1) + 1
    rows.write.mode("overwrite").parquet(os.path.join(root, f"version={number}"))
    for v in versions[:-1]:
        remove(spark, os.path.join(root, f"version={v}"))


def incremental_bars(spark: SparkSession, ticks_path: str, state_path: str, prices_path: str,
                     companies: DataFrame) -> bool:
    """Fold new batches, then upsert the bars that they change and those of newly listed symbols.

    Returns whether any bar was due. Keys that changed are put into the backlog before
    prices are written, listed or not, so a run that dies in between loses none.
    """
    changed = fold_bars(spark, ticks_path, state_path)
    waiting = read_backlog(spark, state_path)
    if changed is not None:
        waiting = waiting.unionByName(changed).distinct().checkpoint()
        _write_backlog(spark, waiting, state_path)
    symbols = sized_broadcast(companies.select("symbol").distinct())
    due = waiting.join(symbols, "symbol", "left_semi").checkpoint()
    if due.isEmpty():
        return False
    state = read_dated(spark, state_path, STATE_SCHEMA).join(sized_broadcast(due), STATE_KEY, "left_semi")
    upsert_bars(spark, bars_of(state, companies), prices_path, companies)
    _write_backlog(spark, waiting.join(symbols, "symbol", "left_anti").checkpoint(), state_path)
    return True
