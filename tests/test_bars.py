"""BAR-1 semantics on hand-written ticks, plus a brute-force cross-check."""

from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tests.fixtures import companies_df, tick, ticks_df
from tickwise.operators.bars import daily_bars
from tickwise.operators.ticks import tick_rejects


def _bars(spark, rows):
    out = daily_bars(ticks_df(spark, rows), companies_df(spark)).collect()
    return {(r.company_id, r.date.isoformat()): r for r in out}


def test_closing_mark_required_and_session_bounds(spark):
    rows = [
        tick("AAAA", "2024-01-02 07:59:59", 1.0, seq=1),      # before session
        tick("AAAA", "2024-01-02 08:00:00", 5.0, seq=2),      # first second of session
        tick("AAAA", "2024-01-02 12:00:00", 7.5, seq=3),
        tick("AAAA", "2024-01-02 18:00:00", 6.0, seq=4),      # closing mark
        tick("AAAA", "2024-01-02 18:00:01", 99.0, seq=5),     # after close
        tick("BBBB", "2024-01-02 17:59:59", 3.0, seq=6),      # no closing mark -> no bar
    ]
    b = _bars(spark, rows)
    assert set(b) == {(1, "2024-01-02")}
    r = b[(1, "2024-01-02")]
    assert (r.high, r.low, r.close) == (Decimal("7.50"), Decimal("5.00"), Decimal("6.00"))
    assert r.open == Decimal("10.00")


def test_last_closing_tick_wins_and_open_from_that_tick(spark):
    rows = [
        tick("AAAA", "2024-01-03 18:00:00", 6.0, open_=5.0, seq=10),
        tick("AAAA", "2024-01-03 18:00:00", 6.5, open_=5.5, seq=30),   # highest seq
        tick("AAAA", "2024-01-03 18:00:00", 6.2, open_=5.2, seq=20),
    ]
    r = _bars(spark, rows)[(1, "2024-01-03")]
    assert (r.open, r.close) == (Decimal("5.50"), Decimal("6.50"))
    assert (r.high, r.low) == (Decimal("6.50"), Decimal("6.00"))


def test_volume_is_max_of_truncated_not_sum(spark):
    rows = [
        tick("AAAA", "2024-01-04 09:00:00", 1.0, volume=12345.99, seq=1),
        tick("AAAA", "2024-01-04 18:00:00", 1.0, volume=100.0, seq=2),
    ]
    assert _bars(spark, rows)[(1, "2024-01-04")].volume == 12345


def test_absent_numbers_default_to_zero(spark):
    rows = [
        tick("AAAA", "2024-01-05 09:00:00", None, volume=None, seq=1),
        tick("AAAA", "2024-01-05 18:00:00", 4.0, open_=None, volume=float("nan"), seq=2),
    ]
    r = _bars(spark, rows)[(1, "2024-01-05")]
    assert r.low == Decimal("0.00") and r.high == Decimal("4.00")
    assert r.open == Decimal("0.00") and r.volume == 0


def test_unpadded_timestamp_is_parsed(spark):
    rows = [tick("AAAA", "2024-1-6 8:0:0", 2.0, seq=1), tick("AAAA", "2024-01-06 18:00:00", 3.0, seq=2)]
    r = _bars(spark, rows)[(1, "2024-01-06")]
    assert r.low == Decimal("2.00")


def test_rejects_with_reasons(spark):
    rows = [
        tick(None, "2024-01-07 18:00:00", 1.0, seq=1),
        tick("AAAA", None, 1.0, seq=2),
        tick("AAAA", "", 1.0, seq=3),
        tick("AAAA", "not a time", 1.0, seq=4),
        tick("ZZZZ", "2024-01-07 18:00:00", 1.0, seq=5),
        tick("AAAA", "2024-01-07 18:00:00", 1.0, seq=6),
    ]
    rej = {int(r.seq): r.reject_reason
           for r in tick_rejects(ticks_df(spark, rows), companies_df(spark)).collect()}
    assert rej == {1: "no_symbol", 2: "missing_timestamp", 3: "missing_timestamp",
                   4: "bad_timestamp", 5: "unknown_symbol"}
    assert set(_bars(spark, rows)) == {(1, "2024-01-07")}


def test_price_rounding_half_up_to_numeric_10_2(spark):
    rows = [tick("AAAA", "2024-01-08 18:00:00", 12.345, open_=0.125, seq=1)]
    r = _bars(spark, rows)[(1, "2024-01-08")]
    assert r.close == Decimal("12.35") and r.open == Decimal("0.13")


# ------------------------------------------------------------- brute force

def _brute_force(rows, companies):
    """Row-at-a-time restatement of the bar rule (for small random inputs)."""
    ids = {c[1]: c[0] for c in companies}
    parsed = []
    for r in rows:
        price, _, _, open_, _, sym, ts, vol, seq = r
        if sym is None or not ts:
            continue
        t = dt.datetime.strptime(ts, "%Y-%m-%d %H:%M:%S")
        parsed.append((sym, t, 0.0 if open_ is None else open_,
                       0.0 if price is None else price, 0 if vol is None else vol, seq))
    out = {}
    for sym, t, open_, price, vol, seq in sorted(parsed, key=lambda x: x[5]):
        if sym not in ids or t.time() != dt.time(18, 0):
            continue
        d = t.date()
        lo, hi = dt.datetime.combine(d, dt.time(8)), dt.datetime.combine(d, dt.time(18))
        window = [p for p in parsed if p[0] == sym and lo <= p[1] <= hi]
        out[(ids[sym], d.isoformat())] = (
            open_, max(p[3] for p in window), min(p[3] for p in window), price,
            max(int(p[4]) for p in window))
    return out


def _d(x):
    return Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_matches_brute_force_on_random_ticks(spark):
    from tests.fixtures import COMPANIES
    rng = random.Random(7)
    syms = ["AAAA", "BBBB", "CCCC", "EEEE"]
    rows = []
    for seq in range(400):
        h = rng.choice([7, 8, 9, 12, 17, 18, 18, 18, 19])
        m, s = (0, 0) if rng.random() < 0.5 else (rng.randrange(60), rng.randrange(60))
        ts = f"2024-02-{rng.randint(1, 4):02d} {h:02d}:{m:02d}:{s:02d}"
        rows.append(tick(rng.choice(syms), ts, round(rng.uniform(1, 300), 2),
                         open_=round(rng.uniform(1, 300), 2),
                         volume=round(rng.uniform(0, 1e6), 2), seq=rng.randrange(10 ** 9)))
    got = {k: (v.open, v.high, v.low, v.close, v.volume) for k, v in _bars(spark, rows).items()}
    want = {k: (_d(o), _d(h), _d(lo), _d(c), v)
            for k, (o, h, lo, c, v) in _brute_force(rows, COMPANIES).items()}
    assert got == want
    assert len(want) > 5


def test_adapter_bars_do_not_depend_on_the_session_zone(spark):
    # event times are zone-less; a session zone with a half-hour offset must
    # not move the hour marks, the trade dates or the first-value order
    from tickwise.sources import adapters as A
    sf = "/root/testdata/sf0.001"

    def bars_now():
        t = A.ticks.__wrapped__(spark, sf)
        c = A.companies.__wrapped__(spark, sf)
        return sorted(tuple(r) for r in daily_bars(t, c).collect())

    want = bars_now()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        got = bars_now()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want and len(want) > 0


def test_hot_symbol_holding_a_third_of_all_ticks(spark):
    # one (symbol, day) group holds a third of the ticks, spread over all
    # input partitions; partial aggregation reduces it map-side and the
    # result must equal the row-at-a-time rule exactly
    from tests.fixtures import COMPANIES
    from tickwise.operators.snapshot import latest_ticks
    rng = random.Random(11)
    rows = []
    for seq in range(1500):
        hot = seq % 3 == 0
        sym = "AAAA" if hot else rng.choice(["BBBB", "CCCC"])
        day = 5 if hot else rng.randint(1, 6)
        h = rng.choice([8, 10, 12, 15, 18, 18])
        m, s = (0, 0) if h == 18 else (rng.randrange(60), rng.randrange(60))
        rows.append(tick(sym, f"2024-03-{day:02d} {h:02d}:{m:02d}:{s:02d}",
                         round(rng.uniform(1, 300), 2), open_=round(rng.uniform(1, 300), 2),
                         volume=round(rng.uniform(0, 1e6), 2), seq=rng.randrange(10 ** 12)))
    ticks = ticks_df(spark, rows).repartition(8)
    got = {(r.company_id, r.date.isoformat()): (r.open, r.high, r.low, r.close, r.volume)
           for r in daily_bars(ticks, companies_df(spark)).collect()}
    want = {k: (_d(o), _d(h), _d(lo), _d(c), v)
            for k, (o, h, lo, c, v) in _brute_force(rows, COMPANIES).items()}
    assert got == want and (1, "2024-03-05") in want
    # the latest tick of the hot symbol is the one with the highest seq
    last = max((r for r in rows if r[5] == "AAAA"), key=lambda r: r[8])
    (hot,) = latest_ticks(ticks).filter(F.col("symbol") == "AAAA").collect()
    assert (hot.current_price, hot.seq) == (last[0], last[8])
