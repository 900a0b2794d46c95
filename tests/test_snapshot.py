"""MKT-1: latest tick per symbol with the market-table display columns."""

from __future__ import annotations

from tests.fixtures import companies_df, tick, ticks_df
from tickwise.operators.snapshot import last_updated, market_snapshot


def test_latest_tick_and_display(spark):
    rows = [
        tick("AAAA", "2024-01-01 10:00:00", 1.0, open_=1.0, volume=5.0, seq=1, pct=0.0),
        tick("AAAA", "2024-01-01 10:00:01", 1.005, open_=1.0, volume=1234567.5, seq=2, pct=0.5),
        tick("BBBB", "2024-01-01 10:00:00", 9.0, open_=10.0, volume=999.0, seq=3, pct=-10.0),
        tick("ZZZZ", "2024-01-01 10:00:00", 9.0, seq=4, pct=1.0),        # not listed
        tick(None, "2024-01-01 10:00:09", 9.0, seq=5, pct=1.0),
    ]
    snap = market_snapshot(ticks_df(spark, rows), companies_df(spark))
    got = {r.symbol: r for r in snap.collect()}
    assert set(got) == {"AAAA", "BBBB"}
    a = got["AAAA"]
    assert (a.name, a.price_display, a.open_display) == ("Alpha", "$1.01", "$1.00")
    assert (a.change_display, a.volume_display, a.change_class) == ("0.50%", "1,234,567.5", "positive")
    b = got["BBBB"]
    assert (b.change_display, b.change_class, b.volume_display) == ("-10.00%", "negative", "999")
    assert last_updated(snap).collect()[0].last_updated == "Last Updated: 2024-01-01 10:00:01 UTC"
