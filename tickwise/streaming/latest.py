"""The live market as a stateful stream: one row of state per symbol (MKT-1, JOB-3).

Spark's state store keeps the newest tick of every symbol by ``seq``; in update
mode a micro-batch emits the symbols that it changed, and only these reach the
table that the publisher polls (``sinks.latest``). State lives with the checkpoint:
a restart on it goes on, and a new checkpoint starts with empty state, reads
the source again, and leaves the table alone until it has caught up, as the table
keeps the highest ``seq``. There is no watermark: state is bounded by the number of
symbols, and a symbol that ticks again after a year must still find its row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwise.functions.order import ORDER_COLUMNS, ingest_seq
from tickwise.functions.time import parse_tick_ts
from tickwise.operators.decode import decode_envelopes
from tickwise.session import stream_checkpoint
from tickwise.sinks.latest import newest_values, quoted, update_latest


def latest_by_symbol(source: DataFrame, value_col: str = "value") -> DataFrame:
    """The newest tick of every symbol of a stream (or table) of envelopes."""
    ticks = decode_envelopes(source, value_col)
    seq = ingest_seq(F.col("envelope_timestamp"), *map(F.col, ORDER_COLUMNS[1:]), F.col("pos"))
    ticks = ticks.withColumn("seq", seq).withColumn("ts", parse_tick_ts("timestamp"))
    return quoted(ticks).groupBy("symbol").agg(*newest_values())


def keep_latest(source: DataFrame, latest_path: str, checkpoint: str | None = None,
                query_name: str = "keep_latest", available_now: bool = False,
                processing_time: str | None = None, value_col: str = "value") -> StreamingQuery:
    """Start the query that keeps the table of latest ticks at ``latest_path``."""
    location = checkpoint or stream_checkpoint(source.sparkSession, query_name)

    def write(changed: DataFrame, _batch_id: int) -> None:
        update_latest(changed, latest_path)

    writer = (latest_by_symbol(source, value_col).writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
