"""JOB-2: envelope stream -> decoded ticks -> tick store (STR-1..3, SNK-2/5, FLT-7, AGG-7).

A checkpointed micro-batch query. A batch first leaves out the records that the
store's ledger covers, so each tick is stored once even if a source is read again
through a new checkpoint (``sinks.ledger``); the rest is decoded and written with an
idempotent overwrite of its own folders (``sinks.ticks``), so a restart on the
same checkpoint neither loses nor duplicates ticks, and several queries over
different sources can write to one store. A failing batch fails the query (the error
is not swallowed). With ``startingOffsets=earliest`` the source replays from the start
only on the first run; afterwards the checkpoint rules.

AGG-7: the counts of each batch (envelopes, malformed ones, ticks; all without
covered records) are taken during the write, logged, and kept with the store
(``sinks.counts``); ``metrics`` may name a list or bounded deque. Malformed envelopes
are put aside by their place (``sinks.quarantine``); only a batch that has some is
read again for it.
"""

from __future__ import annotations

import logging
from collections import deque

from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming import StreamingQuery

from tickwise.operators.decode import decode_envelopes
from tickwise.session import stream_checkpoint
from tickwise.sinks.counts import write_counts
from tickwise.sinks.latest import quoted, update_latest
from tickwise.sinks.ledger import covered, drop_covered
from tickwise.sinks.quarantine import quarantine_batch
from tickwise.sinks.ticks import read_batch, write_tick_batch, writer_id

log = logging.getLogger(__name__)

# Counts of so many recent batches are kept where the caller gives no container.
RECENT_BATCHES = 1000


def make_batch_writer(ticks_path: str, checkpoint: str, value_col: str = "value",
                      metrics: list | deque | None = None, latest_path: str | None = None):
    counted = deque(maxlen=RECENT_BATCHES) if metrics is None else metrics
    own: list[str] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # FLT-7: a batch without ticks (no records, only empty or malformed
        # envelopes) writes nothing -- the dynamic overwrite touches no
        # partition -- so no separate emptiness job (a second read of the
        # batch from the source) is run before the write.
        spark = batch.sparkSession
        if not own:
            own.append(writer_id(spark, checkpoint))
        obs = Observation(f"envelopes_{batch_id}")
        fresh = drop_covered(batch, covered(spark, ticks_path, own[0], batch_id))
        write_tick_batch(decode_envelopes(fresh, value_col, observation=obs), batch_id, ticks_path, own[0])
        if latest_path is not None:
            # from the batch's own files: the source is not read again
            update_latest(quoted(read_batch(spark, ticks_path, own[0], batch_id)), latest_path)
        counts = obs.get
        if counts["malformed"]:
            quarantine_batch(fresh, ticks_path, own[0], batch_id, value_col)
        write_counts(spark, ticks_path, own[0], batch_id, counts)
        counted.append({"batch_id": batch_id, **counts})
        log.info("batch %s: %s", batch_id, counts)
    return write_batch


def ingest_ticks(source: DataFrame, ticks_path: str, checkpoint: str | None = None,
                 query_name: str = "ingest_ticks", available_now: bool = False,
                 processing_time: str | None = None, value_col: str = "value",
                 metrics: list | deque | None = None, latest_path: str | None = None) -> StreamingQuery:
    """Start the ingestion query.

    ``source`` is a stream with a ``value`` column and the order columns
    (``sources.streams``). With ``latest_path`` the table of latest ticks that
    the publisher polls is kept up to date from the landed batches (one query per such
    table; ``streaming.latest.keep_latest`` does so from the source alone).
    """
    location = checkpoint or stream_checkpoint(source.sparkSession, query_name)
    writer = (source.writeStream
              .foreachBatch(make_batch_writer(ticks_path, location, value_col, metrics, latest_path))
              .outputMode("append")
              .option("checkpointLocation", location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
