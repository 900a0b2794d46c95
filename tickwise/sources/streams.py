"""SRC-1 / SRC-2: stream sources.

Every ingest source yields ``value`` and the columns of its ingest order:
``timestamp``, ``partition`` and ``offset`` (see ``functions.order``).
``kafka_stream`` is the production source (needs the Kafka connector on the
classpath). ``text_envelope_stream`` (one envelope per line) stands in for it
in tests: its order is (file modification time, file, line number).
``clock_stream`` is the rate source used as a clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.order import PARTITION_LIMIT

# The reference's topic and clock rate.
DEFAULT_TOPIC = "stock-market-producer"
DEFAULT_CLOCK_ROWS_PER_SECOND = 5


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str = DEFAULT_TOPIC,
                 starting_offsets: str = "earliest", **options: str) -> DataFrame:
    """SRC-1: Kafka records (``key, value, topic, partition, offset, timestamp, ...``)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def text_envelope_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                         ) -> DataFrame:
    """Envelopes as text lines in files under ``path``.

    A file is read as one text, so that its lines can be numbered; the files
    of this stand-in are small. ``source`` is the file's path: the ledger tells files
    apart by it, while two files of one modification time may share ``seq`` numbers,
    as these hold a path as one of PARTITION_LIMIT numbers.
    """
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.load(path).select(
        "value", F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
        F.pmod(F.xxhash64("_metadata.file_path"), F.lit(PARTITION_LIMIT)).cast("int").alias("partition"))
    lines = files.select("source", "timestamp", "partition",
                         F.posexplode(F.split("value", "\n")).alias("offset", "value"))
    return lines.filter(F.length("value") > 0).select(
        "value", "source", "timestamp", "partition", F.col("offset").cast("long").alias("offset"))


def clock_stream(spark: SparkSession, rows_per_second: int = DEFAULT_CLOCK_ROWS_PER_SECOND
                 ) -> DataFrame:
    """SRC-2: the rate source; its rows are ignored, each micro-batch is a tick of the clock."""
    return spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
