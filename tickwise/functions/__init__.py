"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from tickwise.functions.display import change_class, money, percent, thousands
from tickwise.functions.prices import (
    bar_pct_change, clean_number, exact_avg, tick_pct_change, to_price, truncate_volume,
    wide_sum,
)
from tickwise.functions.time import at_time, format_tick_ts, order_key, parse_tick_ts, utc_now_string

__all__ = [
    "at_time", "bar_pct_change", "change_class", "clean_number", "exact_avg", "format_tick_ts",
    "money", "order_key", "parse_tick_ts", "percent", "thousands", "tick_pct_change",
    "to_price", "truncate_volume", "utc_now_string", "wide_sum",
]
