"""JOB-1: snapshot envelopes -> typed ticks (PRJ-1..4).

An envelope is one record whose ``value`` is a JSON array of tick objects.
Decoding is ``cast(string)`` -> ``from_json(array<tick>)`` -> ``posexplode`` ->
flatten; everything stays inside whole-stage codegen. Malformed envelopes
(NULL parse) and empty arrays yield no rows, as in the reference; they are
counted through ``observe`` instead of disappearing without trace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.schemas import TICK_FIELDS, TICK_SCHEMA

ENVELOPE_TYPE = T.ArrayType(TICK_SCHEMA)


def parse_envelopes(envelopes: DataFrame, value_col: str = "value") -> DataFrame:
    """PRJ-1 + PRJ-2: bytes/string -> ``data array<tick>``.

    Other envelope columns are kept; those whose name collides with a tick
    field get an ``envelope_`` prefix.
    """
    keep = [F.col(c).alias("envelope_" + c if c in TICK_FIELDS or c in ("pos", "data") else c)
            for c in envelopes.columns if c != value_col]
    return envelopes.select(
        *keep, F.from_json(F.col(value_col).cast("string"), ENVELOPE_TYPE).alias("data"))


def decode_envelopes(envelopes: DataFrame, value_col: str = "value",
                     observation: Observation | None = None) -> DataFrame:
    """PRJ-1..4: one row per tick, envelope columns kept, ``pos`` = position in array."""
    parsed = parse_envelopes(envelopes, value_col)
    if observation is not None:
        parsed = parsed.observe(
            observation,
            F.count(F.lit(1)).alias("envelopes"),
            F.count(F.when(F.col("data").isNull(), 1)).alias("malformed"),
            F.sum(F.coalesce(F.size("data"), F.lit(0))).alias("ticks"))
    keep = [c for c in parsed.columns if c != "data"]
    exploded = parsed.select(*keep, F.posexplode("data").alias("pos", "stock"))
    return exploded.select(*keep, "pos", *[F.col("stock." + f).alias(f) for f in TICK_FIELDS])


def decode_ticks(envelopes: DataFrame, value_col: str = "value") -> DataFrame:
    """JOB-1: envelopes -> exactly the eight tick fields."""
    return decode_envelopes(envelopes, value_col).select(*TICK_FIELDS)
