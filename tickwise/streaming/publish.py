"""SRC-2 + JOB-3: clock-driven publishing of market snapshots as envelopes.

The rate source is the clock; on every micro-batch the current market state
(latest tick per symbol, stamped with the current UTC time) is encoded into one
envelope and written. The state comes from the table of latest ticks that
ingestion keeps (``sinks.latest``), so a poll reads one row per symbol whenever
that symbol last ticked. Each batch writes into its own ``batch_id=N`` folder
with overwrite, so a replayed batch does not duplicate envelopes. A poll is
computed once; empty ones are skipped (FLT-7).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwise.functions.time import utc_now_string
from tickwise.operators.encode import encode_snapshots
from tickwise.operators.joins import lookup
from tickwise.operators.snapshot import latest_ticks
from tickwise.session import checkpoint_root, stream_checkpoint
from tickwise.sinks.latest import read_latest
from tickwise.sources.streams import DEFAULT_CLOCK_ROWS_PER_SECOND, DEFAULT_TOPIC, clock_stream
from tickwise.schemas import TICK_FIELDS


def store_snapshot(ticks: DataFrame, companies: DataFrame) -> DataFrame:
    """Latest tick per listed symbol, re-stamped now (one poll of the market)."""
    latest = latest_ticks(ticks)
    named = lookup(latest, companies.select(F.col("id").cast("int").alias("id"), "symbol", "name"),
                   "symbol", "inner")
    return named.withColumn("timestamp", utc_now_string()).select(*TICK_FIELDS, "seq")


def latest_snapshot(spark: SparkSession, latest_path: str, companies: DataFrame) -> DataFrame:
    """One poll over the table of latest ticks."""
    return store_snapshot(read_latest(spark, latest_path), companies)


def kafka_sink(bootstrap_servers: str, topic: str = DEFAULT_TOPIC, **options: str
               ) -> Callable[[DataFrame, int], None]:
    """A sink for ``publish_on_clock`` that sends each envelope as one broker record without a key."""
    def send(envelopes: DataFrame, batch_id: int) -> None:
        (envelopes.select(F.col("value").cast("string").alias("value"))
            .write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("topic", topic)
            .options(**options)
            .save())
    return send


def publish_on_clock(spark: SparkSession, snapshot: Callable[[int], DataFrame], out_path: str,
                     rows_per_second: int = DEFAULT_CLOCK_ROWS_PER_SECOND,
                     checkpoint: str | None = None, query_name: str = "publish_snapshots",
                     max_bytes: int | None = None,
                     sink: Callable[[DataFrame, int], None] | None = None,
                     processing_time: str | None = None) -> StreamingQuery:
    """Start the publisher; ``snapshot(batch_id)`` returns the ticks of one poll.

    ``snapshot`` runs once per clock tick, so it should read a bounded table,
    e.g. ``lambda _: latest_snapshot(spark, latest_path, companies)``.

    ``sink(envelopes, batch_id)`` overrides the default text-folder writer, e.g.
    ``kafka_sink(servers)``. ``max_bytes``: see ``encode_snapshots``.
    """
    checkpoint_root(spark)

    def publish(_clock_rows: DataFrame, batch_id: int) -> None:
        ticks = snapshot(batch_id)
        if ticks is None:
            return
        env = encode_snapshots(ticks, max_bytes).select("value").checkpoint()
        if env.isEmpty():
            return
        if sink is not None:
            sink(env, batch_id)
        else:
            env.write.mode("overwrite").text(f"{out_path}/batch_id={batch_id}")

    location = checkpoint or stream_checkpoint(spark, query_name)
    writer = (clock_stream(spark, rows_per_second).writeStream
              .foreachBatch(publish)
              .option("checkpointLocation", location))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
