"""The events-based market model matches the figures of FIXTURES §3 at every scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tickwise.operators.ticks import unknown_symbols
from tickwise.sources import adapters as A

# sf folder -> (events, bars, days with bars, busiest day, bars on it)
EXPECTED = {
    "/root/testdata/sf0.001": (1_000, 31, 20, "2024-01-25", 3),
    "/root/testdata/sf0.01": (10_000, 275, 30, "2024-01-22", 16),
    "/root/testdata/sf0.1": (100_000, 2_664, 30, "2024-01-04", 111),
}


@pytest.mark.parametrize("sf", list(EXPECTED))
def test_bar_counts_match_the_fixture_table(spark, sf):
    events, bars, days, busiest, on_busiest = EXPECTED[sf]
    assert A.ticks(spark, sf).count() == events
    prices = A.prices(spark, sf)
    per_day = {r.date.isoformat(): r.n for r in
               prices.groupBy("date").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(per_day.values()) == bars and len(per_day) == days
    top = max(per_day.values())
    assert top == on_busiest and min(d for d, n in per_day.items() if n == top) == busiest


def test_unknown_symbol_share_at_sf001(spark):
    sf = "/root/testdata/sf0.01"
    assert unknown_symbols(A.ticks(spark, sf), A.companies(spark, sf)).count() == 3_303
