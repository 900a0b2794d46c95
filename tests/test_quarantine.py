"""Malformed envelopes put aside, repaired and replayed; counts kept with the store."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tickwise.sinks.counts import COUNTS, read_counts, write_counts
from tickwise.sinks.quarantine import PLACE, fault, read_quarantine, replay_quarantine
from tickwise.sinks.ticks import compact_ticks
from tickwise.sources.streams import text_envelope_stream
from tickwise.sources.tables import read_ticks
from tickwise.streaming.ingest import ingest_ticks


def envelope(symbol, price):
    return json.dumps([{"symbol": symbol, "timestamp": "2024-01-02 18:00:00", "current_price": price,
                        "open": 1.0, "volume": 1.0}])


GOOD, TORN, NUMBER = envelope("AAAA", 1.0), envelope("BBBB", 2.0)[:-1], "17"


@pytest.fixture
def feed(spark, scratch):
    """A store that has read a file of one good, one torn and one wrong envelope."""
    src, store = os.path.join(scratch, "in"), os.path.join(scratch, "ticks")
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as fh:
        fh.write("\n".join([GOOD, TORN, "[]", NUMBER]) + "\n")

    def ingest(checkpoint):
        ingest_ticks(text_envelope_stream(spark, src), store, os.path.join(scratch, checkpoint),
                     available_now=True).awaitTermination(120)
    ingest("c1")
    return store, ingest


def in_quarantine(spark, store):
    return sorted((r.offset, bytes(r.value).decode(), r.reason) for r in read_quarantine(spark, store).collect())


def totals(spark, store):
    return tuple(read_counts(spark, store).agg(*[F.sum(c) for c in COUNTS]).first())


def repair(spark, store, offset, value):
    return read_quarantine(spark, store).filter(F.col("offset") == offset).select(
        *PLACE, F.lit(value).alias("value")).checkpoint()


@pytest.mark.parametrize("value, reason", [
    (None, "no value"), ("", "not JSON"), ("[{", "not JSON"), ("17", "no ticks: BIGINT"),
    ('"x"', "no ticks: STRING"), ("[]", None), (GOOD, None), ('{"symbol": "A"}', None)])
def test_what_is_wrong_with_an_envelope(spark, value, reason):
    df = spark.createDataFrame([(value,)], "value string")
    assert df.select(fault(F.col("value"))).first()[0] == reason


def test_malformed_envelopes_are_kept_by_place(spark, feed):
    store, ingest = feed
    want = [(1, TORN, "not JSON"), (3, NUMBER, "no ticks: BIGINT")]
    assert in_quarantine(spark, store) == want
    ingest("c2")  # the source again: each record stays once
    assert in_quarantine(spark, store) == want
    assert [r.symbol for r in read_ticks(spark, store).collect()] == ["AAAA"]


def test_a_repaired_envelope_is_ingested_once(spark, feed):
    store, ingest = feed
    fixed = repair(spark, store, 1, TORN + "]")
    assert replay_quarantine(spark, store, fixed.unionByName(fixed)) == 1
    assert replay_quarantine(spark, store, fixed) == 0
    ingest("c2")
    compact_ticks(spark, store)
    assert replay_quarantine(spark, store, fixed) == 0
    stored = {r.symbol: r.seq for r in read_ticks(spark, store).collect()}
    assert sorted(stored) == ["AAAA", "BBBB"] and read_ticks(spark, store).count() == 2
    assert stored["AAAA"] < stored["BBBB"]  # the order of the records, not of their arrival
    assert [r[0] for r in in_quarantine(spark, store)] == [3]


def test_a_repair_without_ticks_leaves_the_record(spark, feed):
    store, _ = feed
    for value in ("[", "[]", None):
        assert replay_quarantine(spark, store, repair(spark, store, 1, value)) == 0
    stranger = spark.createDataFrame([("elsewhere", 0, 7, GOOD)],
                                     "source string, partition int, offset long, value string")
    assert replay_quarantine(spark, store, stranger) == 0
    assert len(in_quarantine(spark, store)) == 2 and read_ticks(spark, store).count() == 1


def test_counts_outlive_the_driver_and_equal_the_store(spark, feed):
    store, ingest = feed
    assert totals(spark, store) == (4, 2, 1)
    replay_quarantine(spark, store, repair(spark, store, 1, TORN + "]"))
    ticks = read_ticks(spark, store).count()
    assert totals(spark, store)[2] == ticks == 2
    before = totals(spark, store)
    for _ in range(2):  # the second run removes what the first has merged
        compact_ticks(spark, store, grace_seconds=0)
    batches = os.path.join(store, "counts", "batches")
    assert not [b for w in os.listdir(batches) if "=" in w for b in os.listdir(os.path.join(batches, w))
                if b.startswith("batch_id=")]
    assert totals(spark, store) == before


def test_a_batch_run_again_replaces_its_counts(spark, scratch):
    for n in (5, 3):
        write_counts(spark, scratch, "w", 0, {"envelopes": n, "malformed": 0, "ticks": None})
    assert totals(spark, scratch) == (3, 0, 0)
    assert read_counts(spark, scratch + "/none").count() == 0
