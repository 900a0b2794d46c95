"""The nightly chain over a real tick store: bars -> upsert into prices -> five CSVs."""

from __future__ import annotations

import csv
import glob
import os

from tests.conftest import SF001
from tickwise.operators import reports as R
from tickwise.operators.bars import daily_bars
from tickwise.plans.nightly import nightly
from tickwise.schemas import PRICES_SCHEMA, TICK_FIELDS
from tickwise.sinks.ticks import write_tick_batch
from tickwise.sources import adapters as A
from tickwise.sources.tables import read_prices, read_ticks

DAY = "2024-01-25"  # the busiest bar day at sf0.001
COLS = [f.name for f in PRICES_SCHEMA.fields]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_nightly_chain_over_a_tick_store(spark, scratch):
    store = os.path.join(scratch, "ticks")
    write_tick_batch(A.ticks(spark, SF001).select(*TICK_FIELDS, "seq"), 0, store, "w")
    companies = A.companies(spark, SF001)
    prices_path, out = os.path.join(scratch, "prices"), os.path.join(scratch, "reports")

    paths = nightly(spark, store, companies, A.sectors(spark, SF001), A.exchanges(spark, SF001),
                    prices_path, DAY, out)

    bars = daily_bars(read_ticks(spark, store), companies)
    want = _rows(bars.select(*[bars[f.name].cast(f.dataType).alias(f.name)
                               for f in PRICES_SCHEMA.fields]))
    assert _rows(read_prices(spark, prices_path)) == want and len(want) > 0

    (part,) = glob.glob(os.path.join(paths["top_volume_companies"], "part-*.csv"))
    with open(part) as fh:
        got_csv = [tuple(r.values()) for r in csv.DictReader(fh)]
    top = R.top_volume(read_prices(spark, prices_path), companies, DAY).collect()
    assert got_csv == [(r.name, r.symbol, str(r.volume)) for r in top] and len(top) > 0

    # an incremental re-run of the last dates changes nothing
    nightly(spark, store, companies, A.sectors(spark, SF001), A.exchanges(spark, SF001),
            prices_path, DAY, out, since=DAY)
    assert _rows(read_prices(spark, prices_path)) == want
