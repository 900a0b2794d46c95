"""JOB-2 ingestion and the clock-driven publisher on Structured Streaming."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException

from tests.conftest import SF001
from tickwise.operators.bars import daily_bars
from tickwise.operators.decode import decode_envelopes, decode_ticks
from tickwise.operators.encode import encode_snapshots
from tickwise.schemas import LANDING_SCHEMA, TICK_FIELDS
from tickwise.sinks.latest import read_latest
from tickwise.sinks.ticks import compact_ticks, with_ingest_columns
from tickwise.sources import adapters as A
from tickwise.sources.streams import text_envelope_stream
from tickwise.sources.tables import read_ticks
from tickwise.streaming.ingest import ingest_ticks
from tickwise.streaming.publish import latest_snapshot, publish_on_clock, store_snapshot


def _write_envelopes(spark, folder, ticks, parts=3):
    env = encode_snapshots(ticks).select("value")
    env.repartition(parts).write.mode("overwrite").text(folder)


def test_ingest_matches_batch_decode_and_restart_adds_nothing(spark, scratch):
    src, store, ckpt = (os.path.join(scratch, x) for x in ("in", "ticks", "ckpt"))
    ticks = A.ticks(spark, SF001).select(*TICK_FIELDS, "seq")
    _write_envelopes(spark, src, ticks)
    metrics = []
    q = ingest_ticks(text_envelope_stream(spark, src, max_files_per_trigger=1), store, ckpt,
                     available_now=True, metrics=metrics)
    q.awaitTermination(120)
    stored = read_ticks(spark, store)
    assert stored.count() == ticks.count()
    expected = decode_ticks(spark.read.text(src))
    assert stored.select(*TICK_FIELDS).exceptAll(expected).count() == 0
    assert sum(m["ticks"] for m in metrics) == ticks.count()
    assert stored.select("seq").distinct().count() == ticks.count()
    assert stored.select("batch_id").distinct().count() >= 2
    # restart on the same checkpoint: nothing new to read, nothing duplicated
    q2 = ingest_ticks(text_envelope_stream(spark, src), store, ckpt, available_now=True)
    q2.awaitTermination(120)
    assert read_ticks(spark, store).count() == ticks.count()


def test_trade_date_partitions_prune(spark, scratch):
    src, store, ckpt = (os.path.join(scratch, x) for x in ("in", "ticks", "ckpt"))
    _write_envelopes(spark, src, A.ticks(spark, SF001).select(*TICK_FIELDS, "seq"), parts=1)
    ingest_ticks(text_envelope_stream(spark, src), store, ckpt, available_now=True).awaitTermination(120)
    from tests.conftest import plan_text
    df = read_ticks(spark, store, start_date="2024-01-20", end_date="2024-01-21")
    assert "PartitionFilters" in plan_text(df) and "trade_date" in plan_text(df)
    assert {r.trade_date.isoformat() for r in df.select("trade_date").distinct().collect()} <= {
        "2024-01-20", "2024-01-21"}


def test_failing_write_fails_the_query(spark, scratch):
    src, ckpt = os.path.join(scratch, "in"), os.path.join(scratch, "ckpt")
    _write_envelopes(spark, src, A.ticks(spark, SF001).select(*TICK_FIELDS, "seq"), parts=1)
    blocker = os.path.join(scratch, "not_a_dir")
    open(blocker, "w").write("x")
    q = ingest_ticks(text_envelope_stream(spark, src), os.path.join(blocker, "ticks"), ckpt,
                     available_now=True)
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(120)


def test_clock_publisher_writes_decodable_snapshots(spark, scratch):
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    ticks, comps = A.ticks(spark, SF001), A.companies(spark, SF001)
    q = publish_on_clock(spark, lambda _b: store_snapshot(ticks, comps), out, checkpoint=ckpt,
                         processing_time="1 second")
    def committed():
        # a batch interrupted by stop() has no _SUCCESS marker (it is replayed
        # and overwritten on restart), so only committed batches are read
        if not os.path.isdir(out):
            return []
        return sorted(d for d in os.listdir(out) if d.startswith("batch_id=")
                      and os.path.exists(os.path.join(out, d, "_SUCCESS")))

    deadline = time.time() + 60
    while time.time() < deadline and len(committed()) < 2:
        time.sleep(0.5)
    q.stop()
    batches = committed()
    assert len(batches) >= 2
    got = decode_ticks(spark.read.text(os.path.join(out, batches[0])))
    want = store_snapshot(ticks, comps)
    assert got.count() == want.count() > 0
    assert got.select("timestamp").distinct().count() == 1


def test_now_string_is_utc_in_any_session_zone(spark):
    import datetime as dt
    from tickwise.functions.time import utc_now_string
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        got = spark.range(1).select(utc_now_string().alias("now")).collect()[0].now
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((dt.datetime.strptime(got, "%Y-%m-%d %H:%M:%S") - now).total_seconds()) < 120


def test_batch_without_ticks_writes_nothing(spark, scratch):
    # FLT-7: empty arrays and malformed envelopes only -> no tick partition
    src, store, ckpt = (os.path.join(scratch, x) for x in ("in", "ticks", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "part-0.txt"), "w") as fh:
        fh.write("[]\nnot json\n[]\n")
    metrics = []
    ingest_ticks(text_envelope_stream(spark, src), store, ckpt, available_now=True,
                 metrics=metrics).awaitTermination(120)
    assert metrics and metrics[0]["envelopes"] == 3 and metrics[0]["ticks"] == 0
    assert metrics[0]["malformed"] == 1
    landing = os.path.join(store, "landing")
    assert not [d for d in (os.listdir(landing) if os.path.isdir(landing) else [])
                if d.startswith("trade_date=")]


def _ingest(spark, src, store, ckpt, **kw):
    ingest_ticks(text_envelope_stream(spark, src, **kw), store, ckpt, available_now=True).awaitTermination(120)


def _write_lines(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _envelope(*ticks):
    return json.dumps([{"symbol": s, "timestamp": t, "current_price": p, "open": 1.0, "volume": 1.0}
                       for s, t, p in ticks])


def test_two_queries_into_one_store_lose_nothing(spark, scratch):
    store = os.path.join(scratch, "ticks")
    for k in (1, 2):
        src = os.path.join(scratch, f"in{k}")
        _write_lines(f"{src}/a.txt", *[_envelope((f"Q{k}", "2024-01-02 18:00:00", float(i))) for i in range(4)])
        _ingest(spark, src, store, os.path.join(scratch, f"ckpt{k}"))
    stored = read_ticks(spark, store)
    assert stored.count() == 8 and stored.select("seq").distinct().count() == 8
    assert stored.select("writer").distinct().count() == 2


def test_later_tick_wins_across_checkpoints(spark, scratch):
    store = os.path.join(scratch, "ticks")
    comps = spark.createDataFrame([(1, "AAAA", "A")], "id int, symbol string, name string")
    for k, price in ((1, 3.0), (2, 7.0)):
        src = os.path.join(scratch, f"in{k}")
        _write_lines(f"{src}/a.txt", _envelope(("AAAA", "2024-01-02 18:00:00", price)))
        os.utime(f"{src}/a.txt", (1_700_000_000 + k, 1_700_000_000 + k))
        _ingest(spark, src, store, os.path.join(scratch, f"ckpt{k}"))
    (bar,) = daily_bars(read_ticks(spark, store), comps).collect()
    assert float(bar.close) == 7.0


def test_same_source_through_a_new_checkpoint_has_the_same_order_keys(spark, scratch):
    src, store = os.path.join(scratch, "in"), os.path.join(scratch, "ticks")
    for k in range(3):
        _write_lines(f"{src}/{k}.txt", _envelope(("AAAA", "2024-01-02 18:00:00", float(k)),
                                                 ("BBBB", "2024-01-02 18:00:00", float(k))))
    _ingest(spark, src, store, os.path.join(scratch, "c1"))
    once = sorted(r.seq for r in read_ticks(spark, store).collect())
    _ingest(spark, src, store, os.path.join(scratch, "c2"), max_files_per_trigger=1)
    assert len(set(once)) == 6 and sorted(r.seq for r in read_ticks(spark, store).collect()) == once
    # so does it after a compaction that has removed what it merged; what is new comes in
    assert compact_ticks(spark, store) and compact_ticks(spark, store, grace_seconds=0) is None
    _write_lines(f"{src}/9.txt", _envelope(("AAAA", "2024-01-02 18:00:00", 9.0)))
    _ingest(spark, src, store, os.path.join(scratch, "c3"))
    again = sorted(r.seq for r in read_ticks(spark, store).collect())
    assert len(again) == 7 and set(again) > set(once)


def test_batch_that_died_before_its_ledger_entry_is_not_read_and_not_covered(spark, scratch):
    import shutil
    src, store, ckpt = (os.path.join(scratch, x) for x in ("in", "ticks", "c1"))
    for k in range(3):
        _write_lines(f"{src}/{k}.txt", _envelope(("AAAA", "2024-01-02 18:00:00", float(k))))
    _ingest(spark, src, store, ckpt, max_files_per_trigger=1)
    (writer,) = {r.writer for r in read_ticks(spark, store).select("writer").distinct().collect()}
    shutil.rmtree(f"{store}/ledger/batches/writer={writer}/batch_id=1")
    assert read_ticks(spark, store).count() == 2
    _ingest(spark, src, store, os.path.join(scratch, "c2"))  # another checkpoint makes up for it
    assert sorted(r.current_price for r in read_ticks(spark, store).collect()) == [0.0, 1.0, 2.0]


def test_ranges_merge_and_gaps_stay_open(spark):
    from tickwise.sinks.ledger import drop_covered, merge_ranges
    rows = [("t", 0, 0, 4), ("t", 0, 3, 6), ("t", 0, 7, 9), ("t", 0, 11, 11), ("t", 1, 0, 0), ("u", 0, 5, 5), ("t", 0, 1, 2)]
    merged = merge_ranges(spark.createDataFrame(rows, "source string, partition int, first long, last long"))
    assert sorted(map(tuple, merged.select("source", "partition", "first", "last").collect())) == [
        ("t", 0, 0, 9), ("t", 0, 11, 11), ("t", 1, 0, 0), ("u", 0, 5, 5)]
    records = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in range(13)], "topic string, partition int, offset long")
    left = drop_covered(records, merged)
    assert sorted((r.partition, r.offset) for r in left.collect()) == [(0, 10), (0, 12)] + [(1, o) for o in range(1, 13)]


def _files_read(df):
    return len(df.select(F.input_file_name().alias("f")).distinct().filter("f <> ''").collect())


def test_compaction_shrinks_what_is_read(spark, scratch):
    src, store, ckpt = (os.path.join(scratch, x) for x in ("in", "ticks", "ckpt"))
    for k in range(6):
        _write_lines(f"{src}/{k}.txt", *[_envelope((f"S{s}", f"2024-01-0{1 + k % 2} 18:00:00", float(k))) for s in range(20)])
    _ingest(spark, src, store, ckpt, max_files_per_trigger=1)
    rows = sorted(map(str, read_ticks(spark, store).collect()))
    listed = lambda: sum(f.endswith(".parquet") and "ledger" not in d and "merged" not in d and "log" not in d
                         for d, _, fs in os.walk(store) for f in fs)
    landed = listed()
    compact_ticks(spark, store)
    compact_ticks(spark, store, grace_seconds=0)  # removes the landing folders
    assert listed() < landed and not os.listdir(f"{store}/merged") and sorted(map(str, read_ticks(spark, store).collect())) == rows
    # a date's files hold ranges of symbols in order
    for r in (spark.read.parquet(f"{store}/compacted").select(F.input_file_name().alias("f"), "symbol", "trade_date")
              .groupBy("trade_date", "f").agg(F.min("symbol").alias("a"), F.max("symbol").alias("b")).groupBy("trade_date")
              .agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")).collect()):
        assert all(x.b <= y.a for x, y in zip(r.spans, r.spans[1:]))


def _latest_prices(spark, latest):
    return {r.symbol: r.current_price for r in read_latest(spark, latest).collect()}


@pytest.mark.parametrize("stateful", [True, False])
def test_latest_table_survives_new_checkpoints(spark, scratch, stateful):
    from tickwise.streaming.latest import keep_latest
    src, latest = os.path.join(scratch, "in"), os.path.join(scratch, "latest")

    def run(n):
        ckpt = os.path.join(scratch, f"c{n}")
        stream = text_envelope_stream(spark, src, max_files_per_trigger=1)
        q = (keep_latest(stream, latest, ckpt, available_now=True) if stateful else
             ingest_ticks(stream, os.path.join(scratch, f"store{n}"), ckpt, available_now=True, latest_path=latest))
        q.awaitTermination(180)

    def write(k, *quotes):
        _write_lines(f"{src}/{k:02d}.txt", _envelope(*quotes))
        os.utime(f"{src}/{k:02d}.txt", (1_700_000_000 + k, 1_700_000_000 + k))

    for k in range(10):
        write(k, ("AAAA", "2024-01-02 09:00:00", float(k)), (f"Q{k}", "2024-01-02 09:00:00", 1.0))
    run(1)
    assert _latest_prices(spark, latest) == {"AAAA": 9.0, **{f"Q{k}": 1.0 for k in range(10)}}
    # a new checkpoint reads everything again: at no time does the table go back
    versions = set(os.listdir(latest))
    write(10, ("AAAA", "2024-01-02 09:00:01", 10.0))
    run(2)
    assert _latest_prices(spark, latest)["AAAA"] == 10.0 and len(_latest_prices(spark, latest)) == 11
    assert len(set(os.listdir(latest)) - versions) == 1  # only the new tick made a version
    write(11, ("AAAA", "2024-01-02 09:00:02", 11.0), (None, "2024-01-02 09:00:02", 1.0))
    run(2)  # the same checkpoint goes on
    assert _latest_prices(spark, latest)["AAAA"] == 11.0


def test_compaction_keeps_every_tick_once(spark, scratch):
    store, ckpt = os.path.join(scratch, "ticks"), os.path.join(scratch, "ckpt")
    src = os.path.join(scratch, "in")
    for k in range(4):
        _write_lines(f"{src}/{k}.txt", _envelope(("AAAA", f"2024-01-0{1 + k % 2} 18:00:00", float(k)),
                                                 ("BBBB", "never", float(k))))
    _ingest(spark, src, store, ckpt, max_files_per_trigger=1)
    rows = lambda: sorted(map(str, read_ticks(spark, store).collect()))
    before = rows()
    assert compact_ticks(spark, store) and rows() == before
    assert compact_ticks(spark, store) is None
    # more batches land after the run; an unlogged run stays invisible
    _write_lines(f"{src}/9.txt", _envelope(("AAAA", "2024-01-05 18:00:00", 9.0)))
    _ingest(spark, src, store, ckpt)
    assert len(rows()) == len(before) + 1
    (spark.read.schema(LANDING_SCHEMA).parquet(f"{store}/landing")
        .write.partitionBy("trade_date").parquet(f"{store}/compacted/run=half"))
    assert len(rows()) == len(before) + 1
    one_day = read_ticks(spark, store, "2024-01-02", "2024-01-02")
    assert one_day.count() == 2


def test_latest_table_follows_ingestion_and_keeps_quiet_symbols(spark, scratch):
    src, store, latest = (os.path.join(scratch, x) for x in ("in", "ticks", "latest"))
    _write_lines(f"{src}/0.txt", _envelope(("AAAA", "2024-01-02 09:00:00", 1.0), ("QUIET", "2023-05-01 09:00:00", 5.0)))
    os.utime(f"{src}/0.txt", (1_700_000_000, 1_700_000_000))
    _write_lines(f"{src}/1.txt", _envelope(("AAAA", "2024-01-02 09:00:01", 2.0)))
    os.utime(f"{src}/1.txt", (1_700_000_009, 1_700_000_009))
    assert read_latest(spark, latest).count() == 0
    ingest_ticks(text_envelope_stream(spark, src, max_files_per_trigger=1), store, os.path.join(scratch, "c"),
                 available_now=True, latest_path=latest).awaitTermination(120)
    got = {r.symbol: r.current_price for r in read_latest(spark, latest).collect()}
    assert got == {"AAAA": 2.0, "QUIET": 5.0}
    comps = spark.createDataFrame([(1, "AAAA", "A"), (2, "QUIET", "Q")], "id int, symbol string, name string")
    assert latest_snapshot(spark, latest, comps).count() == 2


def test_ingest_without_order_columns_is_an_error(spark):
    with pytest.raises(ValueError, match="ingest order"):
        with_ingest_columns(decode_envelopes(spark.createDataFrame([("[]",)], "value string")), 0, "w")


def test_one_poll_is_one_envelope_whatever_the_partitioning(spark):
    ticks = spark.range(300).select(
        F.lit(1.0).alias("current_price"), F.col("id").cast("int").alias("id"), F.lit("n").alias("name"),
        F.lit(1.0).alias("open"), F.lit(0.0).alias("percent_change"),
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"),
        F.lit("2024-01-02 18:00:00").alias("timestamp"), F.lit(1.0).alias("volume"), F.col("id").alias("seq"))
    assert encode_snapshots(ticks.repartition(4)).count() == 1
    split = {tuple(sorted(r[0] for r in encode_snapshots(ticks.repartition(n), max_bytes=8000)
                          .select("value").collect())) for n in (1, 4, 7)}
    assert len(split) == 1 and 1 < len(next(iter(split))) < 20
    assert decode_ticks(encode_snapshots(ticks, max_bytes=8000)).count() == 300


def test_kafka_source_and_sink_options(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    from pyspark.sql.streaming.readwriter import DataStreamReader
    from tickwise.sources.streams import kafka_stream
    from tickwise.streaming.publish import kafka_sink
    seen = {}
    monkeypatch.setattr(DataStreamReader, "option", lambda self, k, v: (seen.__setitem__(k, v), self)[1])
    monkeypatch.setattr(DataStreamReader, "load", lambda self: "stream")
    assert kafka_stream(spark, "b:9092", maxOffsetsPerTrigger="7") == "stream"
    assert seen == {"kafka.bootstrap.servers": "b:9092", "subscribe": "stock-market-producer",
                    "startingOffsets": "earliest", "maxOffsetsPerTrigger": "7"}
    sent = {}
    monkeypatch.setattr(DataFrameWriter, "format", lambda self, f: (sent.__setitem__("format", f), self)[1])
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: (sent.__setitem__(k, v), self)[1])
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: (sent.update(o), self)[1])
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: sent.__setitem__("saved", True))
    kafka_sink("b:9092", acks="all")(spark.createDataFrame([("[]",)], "value string"), 0)
    assert sent == {"format": "kafka", "kafka.bootstrap.servers": "b:9092", "topic": "stock-market-producer",
                    "acks": "all", "saved": True}


def test_an_hour_of_more_ticks_than_an_envelope_has_positions(spark, scratch):
    import __spark_entry__ as entry
    from tickwise.functions.order import POSITION_LIMIT
    n = POSITION_LIMIT + 5000
    for name in ("supplier", "nation", "region"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(f"{scratch}/{name}.parquet")
    events = spark.read.parquet(f"{SF001}/events.parquet")
    made = {"event_id": F.col("id"), "user_id": F.col("id") % 3, "value": F.lit(1.0), "props": F.lit('{"k": 1}'),
            "ts": F.lit("2024-01-02 10:30:00")}
    spark.range(n).select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema]
                          ).write.parquet(f"{scratch}/events.parquet")
    for query in (entry.q_ingested_ticks, entry.q_envelope_roundtrip):
        assert query(spark, scratch).groupBy("timestamp").count().collect() == [("2024-01-02 10:00:00", n)]
