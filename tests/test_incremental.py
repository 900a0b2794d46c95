"""Incremental bars, the backlog of unlisted symbols, and tables that switch as a whole."""

from __future__ import annotations

import datetime as dt
import os
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tickwise.operators.bars import daily_bars
from tickwise.plans import incremental
from tickwise.plans.incremental import fold_bars, incremental_bars, merge_states, read_backlog, unfolded
from tickwise.schemas import PRICES_SCHEMA, TICK_FIELDS
from tickwise.sinks import dated
from tickwise.sinks.prices import upsert_bars
from tickwise.sinks.ticks import compact_ticks, write_tick_batch
from tickwise.sources import adapters as A
from tickwise.sources.tables import read_prices, read_ticks

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def rows(df):
    return sorted(tuple(r) for r in df.select(*PRICES_SCHEMA.names).collect())


def full(spark, store, companies):
    bars = daily_bars(read_ticks(spark, store), companies)
    return rows(bars.select(*[F.col(f.name).cast(f.dataType) for f in PRICES_SCHEMA.fields]))


@pytest.fixture()
def paths(scratch):
    return [os.path.join(scratch, n) for n in ("ticks", "state", "prices")]


def land(spark, ticks, k, n, store, batch=None):
    part = ticks.filter(F.pmod(F.xxhash64("seq"), F.lit(n)) == k)
    write_tick_batch(part.select(*TICK_FIELDS, "seq"), k if batch is None else batch, store, "w")


def test_incremental_bars_equal_the_full_job_after_late_and_repeated_batches(spark, paths):
    store, state, prices = paths
    ticks, companies = A.ticks(spark, SF001), A.companies(spark, SF001)
    for k in (3, 0, 2, 1):  # batches hold ticks of all days in no order
        land(spark, ticks, k, 4, store)
        assert incremental_bars(spark, store, state, prices, companies)
        assert rows(read_prices(spark, prices)) == full(spark, store, companies)
        if k == 0:
            compact_ticks(spark, store)
            compact_ticks(spark, store, grace_seconds=0)
    assert len(full(spark, store, companies)) > 10
    assert fold_bars(spark, store, state) is None
    assert not incremental_bars(spark, store, state, prices, companies)
    # the same ticks once more, as another writer would land them
    write_tick_batch(ticks.select(*TICK_FIELDS, "seq"), 0, store, "again")
    incremental_bars(spark, store, state, prices, companies)
    assert rows(read_prices(spark, prices)) == full(spark, store, companies)


def test_a_run_reads_new_batches_only(spark, paths):
    store, state, prices = paths
    ticks, companies = A.ticks(spark, SF001), A.companies(spark, SF001)
    land(spark, ticks, 0, 2, store)
    incremental_bars(spark, store, state, prices, companies)
    compact_ticks(spark, store)  # only batches that are folded already
    landed, to_read, known = unfolded(spark, store, state)
    assert landed.isEmpty() and to_read.isEmpty() and known.count() == 1
    assert fold_bars(spark, store, state) is None
    land(spark, ticks, 1, 2, store)
    want = full(spark, store, companies)
    shutil.rmtree(f"{store}/compacted")  # what is folded is not opened again
    for d in os.listdir(f"{store}/landing"):
        if d.startswith("trade_date="):
            shutil.rmtree(f"{store}/landing/{d}/writer=w/batch_id=0", ignore_errors=True)
    incremental_bars(spark, store, state, prices, companies)
    assert rows(read_prices(spark, prices)) == want


def test_a_run_that_died_is_made_good(spark, paths, monkeypatch):
    store, state, prices = paths
    ticks, companies = A.ticks(spark, SF001), A.companies(spark, SF001)
    land(spark, ticks, 0, 2, store)
    incremental_bars(spark, store, state, prices, companies)
    land(spark, ticks, 1, 2, store)

    def dies(*_a, **_k):
        raise RuntimeError("lost")
    monkeypatch.setattr(incremental, "upsert_bars", dies)  # folded, but not in prices
    with pytest.raises(RuntimeError):
        incremental_bars(spark, store, state, prices, companies)
    monkeypatch.undo()
    assert rows(read_prices(spark, prices)) != full(spark, store, companies)
    assert incremental_bars(spark, store, state, prices, companies)
    assert rows(read_prices(spark, prices)) == full(spark, store, companies)
    shutil.rmtree(f"{state}/_folded")  # published, but not known as folded: folding again changes nothing
    incremental_bars(spark, store, state, prices, companies)
    assert rows(read_prices(spark, prices)) == full(spark, store, companies)


def test_a_symbol_listed_later_gets_its_old_bars(spark, paths):
    store, state, prices = paths
    ticks, companies = A.ticks(spark, SF001), A.companies(spark, SF001).cache()
    first = companies.filter("id % 2 = 0")
    land(spark, ticks, 0, 1, store)
    incremental_bars(spark, store, state, prices, first)
    assert rows(read_prices(spark, prices)) == full(spark, store, first)
    waiting = {(r.symbol, r.date) for r in read_backlog(spark, state).collect()}
    assert waiting
    shutil.rmtree(f"{store}/landing")  # no tick of the past is needed
    assert incremental_bars(spark, store, state, prices, companies)
    want = rows(daily_bars(ticks, companies).select(*[F.col(f.name).cast(f.dataType) for f in PRICES_SCHEMA.fields]))
    assert rows(read_prices(spark, prices)) == want
    listed = {r.symbol for r in companies.collect()}
    assert {(r.symbol, r.date) for r in read_backlog(spark, state).collect()} == {
        w for w in waiting if w[0] not in listed}


def test_states_merge_in_any_order(spark):
    made = [("A", D1, 1.0, 2.0, 9.0, 1.0, 5, Decimal(7)), ("A", D1, 3.0, 4.0, 8.0, 0.5, 6, Decimal(9)),
            ("A", D1, None, None, 20.0, 3.0, 1, None), ("B", D1, None, None, 1.0, 1.0, 1, None)]
    want = {("A", D1, 3.0, 4.0, 20.0, 0.5, 6, Decimal(9)), ("B", D1, None, None, 1.0, 1.0, 1, None)}
    for order in (made, made[::-1], made + made):
        df = spark.createDataFrame(order, incremental.STATE_SCHEMA)
        assert {tuple(r) for r in merge_states(df).select(*incremental.STATE_SCHEMA.names).collect()} == want


def bars(spark, *made):
    return spark.createDataFrame([(c, d, *[Decimal(p)] * 4, 1) for c, d, p in made], PRICES_SCHEMA)


def closes(spark, path):
    return sorted((r.company_id, r.date, int(r.close)) for r in read_prices(spark, path).collect())


def test_an_upsert_that_dies_before_its_switch_changes_nothing(spark, paths, monkeypatch):
    path = paths[2]
    real = dated._write_manifest

    def dies(rows, where, version):
        if version:
            raise RuntimeError("lost")
        real(rows, where, version)
    # the first load dies: there is an empty table, whatever files lie there
    monkeypatch.setattr(dated, "_write_manifest", dies)
    with pytest.raises(RuntimeError):
        upsert_bars(spark, bars(spark, (1, D1, 1)), path)
    assert os.path.isdir(f"{path}/date=2024-01-01") and closes(spark, path) == []
    monkeypatch.undo()
    upsert_bars(spark, bars(spark, (1, D1, 1), (1, D2, 1)), path)
    old = read_prices(spark, path)
    monkeypatch.setattr(dated, "_write_manifest", dies)
    with pytest.raises(RuntimeError):
        upsert_bars(spark, bars(spark, (1, D1, 5), (2, D2, 5)), path)
    monkeypatch.undo()
    # both dates have new files, and none of them counts
    assert {len(os.listdir(f"{path}/date={d}")) for d in (D1, D2)} == {3, 2}
    assert closes(spark, path) == [(1, D1, 1), (1, D2, 1)]
    upsert_bars(spark, bars(spark, (1, D1, 5), (2, D2, 5)), path)
    assert closes(spark, path) == [(1, D1, 5), (1, D2, 1), (2, D2, 5)]
    # who opened the old version still reads it
    assert sorted(int(r.close) for r in old.collect()) == [1, 1]


def test_a_half_written_manifest_does_not_count(spark, paths):
    path = paths[2]
    upsert_bars(spark, bars(spark, (1, D1, 1)), path)
    newest = max(os.listdir(f"{path}/_manifest"))
    shutil.copytree(f"{path}/_manifest/{newest}", f"{path}/_manifest/version=99")
    os.remove(f"{path}/_manifest/version=99/_SUCCESS")
    upsert_bars(spark, bars(spark, (2, D2, 2)), path)
    assert closes(spark, path) == [(1, D1, 1), (2, D2, 2)]


def test_superseded_loads_are_removed(spark, paths):
    path = paths[2]
    for k in range(1, dated.KEPT_VERSIONS + 5):
        upsert_bars(spark, bars(spark, (1, D1, k)), path)
    assert len(os.listdir(f"{path}/date={D1}")) == dated.KEPT_VERSIONS
    assert len([n for n in os.listdir(f"{path}/_manifest")]) == dated.KEPT_VERSIONS
    assert closes(spark, path) == [(1, D1, k)]


def test_a_plain_table_is_taken_over_whole(spark, paths):
    path = paths[2]
    bars(spark, (1, D1, 1), (1, D2, 2)).write.partitionBy("date").parquet(path)
    assert closes(spark, path) == [(1, D1, 1), (1, D2, 2)]
    upsert_bars(spark, bars(spark, (3, D2, 3)), path)
    assert closes(spark, path) == [(1, D1, 1), (1, D2, 2), (3, D2, 3)]
    upsert_bars(spark, bars(spark, (1, D1, 4)), path)
    assert closes(spark, path) == [(1, D1, 4), (1, D2, 2), (3, D2, 3)]


def test_a_missing_library_of_the_text_operators_leaves_the_market_queries():
    import subprocess
    import sys
    code = ("import sys; sys.modules['zstandard'] = None\n"
            "import __spark_entry__ as e\n"
            "print(len(e.queries()), any(k.startswith('op') for k in e.queries()), set(e.queries()) == set(e.oracle_sql()))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 32 and out[1:] == ["False", "True"]
