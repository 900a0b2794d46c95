"""Malformed envelopes: kept by the place of their record, and ingested once repaired (PRJ-2, SNK-2).

Under the store::

    quarantine/writer=W/batch_id=N/   the envelopes of one batch that could not be decoded

An envelope whose value does not decode to an array of ticks is kept whole, with the
place and time of its record and what is wrong with it. A record is in quarantine
until ticks of its place are in the store's ledger. ``replay_quarantine`` takes
repaired values by place and lands their ticks as a batch of its own, with the ``seq``
that the record would have had; the ledger covers their places from then on, so a
second replay, or reading the source again, adds nothing.

Defined cases: a record without value is kept with a null value; of several
repairs of one record the greatest value counts; a repair that is malformed too or
holds no tick leaves its record in quarantine, and one of a record that is not
there is ignored.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.operators.decode import ENVELOPE_TYPE, decode_envelopes
from tickwise.sinks.counts import write_counts
from tickwise.sinks.files import read_or_empty
from tickwise.sinks.ledger import covered, drop_covered, source_column
from tickwise.sinks.ticks import write_tick_batch

PLACE = ("source", "partition", "offset")
QUARANTINE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.BinaryType()), T.StructField("reason", T.StringType())])


def fault(value: Column) -> Column:
    """What is wrong with an envelope; null if it decodes to an array of ticks."""
    text = value.cast("string")
    parsed = F.try_parse_json(text)
    return F.when(F.from_json(text, ENVELOPE_TYPE).isNull(), F.when(value.isNull(), "no value")
                  .when(parsed.isNull(), "not JSON")
                  .otherwise(F.concat(F.lit("no ticks: "), F.schema_of_variant(parsed))))


def quarantine_batch(records: DataFrame, store: str, writer: str, batch_id: int, value_col: str = "value") -> None:
    """Keep the malformed envelopes of one batch; a batch that is run again replaces its own."""
    value = F.col(value_col)
    rows = records.select(source_column(records).alias("source"), F.col("partition").cast("int"),
                          F.col("offset").cast("long"), F.col("timestamp").cast("timestamp"),
                          value.cast("binary").alias("value"), fault(value).alias("reason"))
    (rows.filter("reason IS NOT NULL").write.mode("overwrite")
        .parquet(os.path.join(store, "quarantine", f"writer={writer}", f"batch_id={batch_id}")))


def read_quarantine(spark: SparkSession, store: str) -> DataFrame:
    """The malformed envelopes no repair of which is stored yet, each record once."""
    kept = read_or_empty(spark, os.path.join(store, "quarantine"), QUARANTINE_SCHEMA)
    return drop_covered(kept.select(*QUARANTINE_SCHEMA.names).dropDuplicates(list(PLACE)), covered(spark, store))


def replay_quarantine(spark: SparkSession, store: str, repaired: DataFrame) -> int:
    """Land the ticks of ``repaired`` (source, partition, offset, value); returns how many there are.

    A replay that dies before its ledger entry has changed nothing. Do not run it
    at the same time as a query over the same source, or as another replay.
    """
    values = repaired.groupBy(*PLACE).agg(F.max(F.col("value").cast("string")).alias("value"))
    records = read_quarantine(spark, store).drop("value", "reason").join(values, list(PLACE))
    writer, obs = f"replay-{uuid.uuid4().hex}", Observation("replay")
    write_tick_batch(decode_envelopes(records, observation=obs), 0, store, writer)
    write_counts(spark, store, writer, 0, obs.get)
    return obs.get["ticks"] or 0
