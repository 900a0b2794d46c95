"""Tick timestamps: parse, format, and wall-clock times of a trading day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tick timestamp layout ("%Y-%m-%d %H:%M:%S", UTC). A year has
# four digits; the other parts may be unpadded, as strptime accepts them.
TICK_TS_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
TICK_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_tick_ts(c: Column | str) -> Column:
    """String -> timestamp_ntz; NULL for NULL, empty or malformed input.

    The text is cast straight to a zone-less timestamp, so the session zone
    (and its daylight-saving gaps) plays no part.
    """
    return F.when(_col(c).rlike(TICK_TS_PATTERN), _col(c).try_cast("timestamp_ntz"))


def format_tick_ts(c: Column | str) -> Column:
    return F.date_format(_col(c), TICK_TS_FORMAT)


def _hms(t: str) -> tuple[int, int, int]:
    parts = [int(p) for p in t.split(":")]
    while len(parts) < 3:
        parts.append(0)
    return parts[0], parts[1], parts[2]


def at_time(date: Column | str, hhmmss: str) -> Column:
    """timestamp_ntz of ``date`` at wall-clock ``hh:mm:ss``.

    ``date + interval`` alone would give a session-zoned timestamp, so the date is
    cast to timestamp_ntz first.
    """
    h, m, s = _hms(hhmmss)
    return _col(date).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(h), F.lit(m), F.lit(s))


def utc_now_string() -> Column:
    """Current UTC wall-clock time as a tick timestamp string, whatever the session zone."""
    local = F.current_timestamp().cast("timestamp_ntz")  # wall clock in the session zone
    return F.date_format(F.convert_timezone(None, F.lit("UTC"), local), TICK_TS_FORMAT)


_TS_SHIFT = 2 ** 61   # timestamps within +-73,000 years of 1970 in microseconds
_ID_SHIFT = 2 ** 63   # any bigint


def order_key(ts: Column | str, tiebreak: Column | str) -> Column:
    """Exact order of (ts, tiebreak) packed into one decimal(38,0).

    A single numeric key lets ``min_by`` / ``max_by`` run as a HashAggregate
    (a struct key would force a sort-based aggregate).
    """
    # microseconds since 1970-01-01 00:00:00 of the wall-clock time; on
    # timestamp_ntz this involves no time zone
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, _col(ts).cast("timestamp_ntz")).cast("decimal(38,0)")
    tb = _col(tiebreak).cast("decimal(38,0)")
    return ((micros + _dec(_TS_SHIFT)) * _dec(2 ** 64) + (tb + _dec(_ID_SHIFT))).cast("decimal(38,0)")


def _dec(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(38,0)")
