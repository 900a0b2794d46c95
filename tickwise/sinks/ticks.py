"""SNK-2: idempotent append of micro-batches to the tick store, and its compaction.

Layout under the store::

    landing/trade_date=D/writer=W/batch_id=N/   one micro-batch of one query
    ledger/                                     what each batch holds (``sinks.ledger``)
    compacted/run=R/trade_date=D/               landed batches merged by run R
    merged/run=R/                               which batches run R has merged
    log/                                        finished runs
    counts/, quarantine/                        ``sinks.counts``, ``sinks.quarantine``

A batch is written with dynamic partition overwrite of its own folders. ``W`` is
the id that Spark keeps in the query's checkpoint, so a re-run batch replaces
exactly its own files. ``seq`` is the record's place in its source
(``functions.order``), hence the same for every reader of that record, and the
ledger keeps a record from being stored again through another checkpoint.

``compact_ticks`` merges landed batches into few files, clustered by symbol and time
within a date. Its data is invisible until its log row is written, and from then on the
merged landing folders are: readers take the runs in the log and the landed batches
that no run holds (``sources.tables.read_ticks``). A compaction that dies half-way
changes nothing. Landing folders of a run are removed by a later compaction,
``grace_seconds`` after it finished, so that readers of the old state can end.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.order import ORDER_COLUMNS, ingest_seq
from tickwise.functions.time import parse_tick_ts
from tickwise.schemas import LANDING_SCHEMA, MERGED_SCHEMA, PLACE_FIELDS, RUN_SCHEMA, TICK_FIELDS
from tickwise.sinks.counts import batch_folder, merge_counts
from tickwise.sinks.files import child_names, read_or_empty, remove
from tickwise.sinks.ledger import commit_batch, commits, merge_ledger, source_column

BATCH_KEY = ("trade_date", "writer", "batch_id")
GRACE_SECONDS = 3600


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns ``checkpoint`` (Spark writes it there first)."""
    line = spark.read.text(os.path.join(checkpoint, "metadata")).first()[0]
    return json.loads(line)["id"]


def with_ingest_columns(ticks: DataFrame, batch_id: int, writer: str) -> DataFrame:
    """Decoded ticks plus seq, ts, place, trade_date, writer and batch_id.

    ``seq`` is kept if there; else the envelope's timestamp, partition, offset
    and the tick's position in it must be there to build it from.
    """
    if "seq" in ticks.columns:
        seq = F.col("seq")
    else:
        names = ["envelope_timestamp", *ORDER_COLUMNS[1:], "pos"]
        missing = [c for c in names if c not in ticks.columns]
        if missing:
            raise ValueError(f"no ingest order without {', '.join(missing)}")
        seq = ingest_seq(*map(F.col, names))
    ts = parse_tick_ts("timestamp")
    place = {"source": source_column(ticks), **{c: F.col(c) for c in ORDER_COLUMNS[1:] if c in ticks.columns}}
    return ticks.select(*TICK_FIELDS, seq.alias("seq"), ts.alias("ts"),
                        *[place.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PLACE_FIELDS],
                        F.to_date(ts).alias("trade_date"), F.lit(writer).alias("writer"),
                        F.lit(batch_id).cast("long").alias("batch_id"))


def write_tick_batch(ticks: DataFrame, batch_id: int, ticks_path: str, writer: str) -> None:
    """Land a batch and enter it into the ledger, from when on it is read."""
    (with_ingest_columns(ticks, batch_id, writer)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*BATCH_KEY)
        .parquet(os.path.join(ticks_path, "landing")))
    commit_batch(ticks.sparkSession, ticks_path, writer, batch_id)


def read_batch(spark: SparkSession, ticks_path: str, writer: str, batch_id: int) -> DataFrame:
    """The landed ticks of one batch, from its own folders."""
    landing = read_or_empty(spark, os.path.join(ticks_path, "landing"), LANDING_SCHEMA)
    return landing.filter((F.col("writer") == writer) & (F.col("batch_id") == batch_id))


def finished_runs(spark: SparkSession, ticks_path: str) -> DataFrame:
    """(run, finished) of the compaction runs that count."""
    return read_or_empty(spark, os.path.join(ticks_path, "log"), RUN_SCHEMA)


def merged_batches(spark: SparkSession, ticks_path: str) -> DataFrame:
    """(writer, batch_id, run) of the batches that a finished run has merged and whose folders are still there."""
    merged = read_or_empty(spark, os.path.join(ticks_path, "merged"), MERGED_SCHEMA)
    return merged.join(finished_runs(spark, ticks_path).select("run"), "run", "left_semi")


def open_batches(spark: SparkSession, ticks_path: str) -> DataFrame:
    """(writer, batch_id) of the committed batches that no compaction run has merged."""
    key = list(BATCH_KEY[1:])
    return (commits(spark, ticks_path).select(*key).distinct()
            .join(merged_batches(spark, ticks_path).select(*key), key, "left_anti"))


def landed_batches(spark: SparkSession, ticks_path: str) -> DataFrame:
    """Landed ticks of the committed batches that no compaction run has merged."""
    landing = read_or_empty(spark, os.path.join(ticks_path, "landing"), LANDING_SCHEMA)
    return landing.join(open_batches(spark, ticks_path), list(BATCH_KEY[1:]), "left_semi")


def compact_ticks(spark: SparkSession, ticks_path: str, grace_seconds: int = GRACE_SECONDS) -> str | None:
    """Merge all landed batches into one run; returns its id, or None if there are none.

    The batches are listed first and only these are merged, so batches that land
    meanwhile stay landed. Run one compaction of a store at a time.
    """
    remove_merged(spark, ticks_path, grace_seconds)
    key = list(BATCH_KEY[1:])
    batches = open_batches(spark, ticks_path).checkpoint()
    if batches.isEmpty():
        return None
    run = uuid.uuid4().hex
    landing = read_or_empty(spark, os.path.join(ticks_path, "landing"), LANDING_SCHEMA)
    # a file holds a range of symbols, whose names its Bloom filter knows as well
    clustered = (landing.join(batches, key, "left_semi").repartitionByRange("trade_date", "symbol", "ts")
                 .sortWithinPartitions("trade_date", "symbol", "ts", "seq"))
    (clustered.write.partitionBy("trade_date").option("parquet.bloom.filter.enabled#symbol", "true")
        .option("parquet.bloom.filter.expected.ndv#symbol", "10000")
        .parquet(os.path.join(ticks_path, "compacted", f"run={run}")))
    batches.select(*key).coalesce(1).write.parquet(os.path.join(ticks_path, "merged", f"run={run}"))
    merge_ledger(spark, ticks_path)
    done = spark.range(1).select(F.lit(run).alias("run"), F.current_timestamp().alias("finished"))
    done.coalesce(1).write.mode("append").parquet(os.path.join(ticks_path, "log"))
    return run


def remove_merged(spark: SparkSession, ticks_path: str, grace_seconds: int = GRACE_SECONDS) -> None:
    """Remove the landing, ledger and count folders of batches that runs merged at least ``grace_seconds`` ago.

    The merged versions of ledger and counts hold them by then; a run's list of batches goes last.
    """
    old = (finished_runs(spark, ticks_path).filter(
        F.col("finished") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(grace_seconds))))
    merged = merged_batches(spark, ticks_path).join(old.select("run"), "run", "left_semi")
    gone = merged.collect()  # the batches of one compaction interval
    if not gone:
        return
    merge_counts(spark, ticks_path)
    landing = os.path.join(ticks_path, "landing")
    dates = [d for d in child_names(spark, landing) if d.startswith("trade_date=")]
    for r in gone:
        for d in dates:
            remove(spark, os.path.join(landing, d, f"writer={r['writer']}", f"batch_id={r['batch_id']}"))
        remove(spark, os.path.join(ticks_path, "ledger", "batches", f"writer={r['writer']}",
                                   f"batch_id={r['batch_id']}"))
        remove(spark, batch_folder(ticks_path, r["writer"], r["batch_id"]))
    for run in {r["run"] for r in gone}:
        remove(spark, os.path.join(ticks_path, "merged", f"run={run}"))
