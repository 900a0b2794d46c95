"""Price, volume and percent arithmetic with the reference's numeric rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickwise.schemas import PRICE_TYPE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_number(c: Column | str, default: float | int = 0.0) -> Column:
    """NaN -> NULL, then NULL (absent field) -> ``default``."""
    return F.coalesce(F.nanvl(_col(c), F.lit(None).cast("double")), F.lit(default))


def truncate_volume(c: Column | str) -> Column:
    """``int(volume)``: truncation toward zero; NULL when out of bigint range."""
    return _col(c).try_cast("bigint")


def to_price(c: Column | str) -> Column:
    """Store a price as NUMERIC(10,2) (HALF_UP); NULL when it does not fit."""
    return _col(c).try_cast(PRICE_TYPE)


def fits_price(c: Column | str) -> Column:
    """True when a price can be stored as NUMERIC(10,2)."""
    return to_price(c).isNotNull()


def fits_volume(c: Column | str) -> Column:
    """True when a truncated volume can be stored as bigint."""
    return truncate_volume(c).isNotNull()


def tick_pct_change(current: Column | str, open_: Column | str) -> Column:
    """Percent change of a tick against its open, on doubles, 2 decimals."""
    o = _col(open_)
    return F.round((_col(current) - o) / F.nullif(o, F.lit(0.0)) * F.lit(100.0), 2)


def bar_pct_change(close: Column | str, open_: Column | str) -> Column:
    """``ROUND(((close - open) / NULLIF(open, 0)) * 100, 2)`` on exact decimals."""
    o = _col(open_)
    pct = F.round((_col(close) - o) / F.nullif(o, F.lit(0).cast(PRICE_TYPE)) * F.lit(100), 2)
    return pct.cast("decimal(18,2)")


def exact_avg(c: Column | str, scale: int = 2) -> Column:
    """Exact decimal average rounded HALF_UP to ``scale`` (avg() would round twice)."""
    x = _col(c)
    return F.round(F.sum(x) / F.count(x), scale).cast(f"decimal(18,{scale})")


def wide_sum(c: Column | str) -> Column:
    """Sum of a bigint without overflow (the reference database widens to NUMERIC)."""
    return F.sum(_col(c).cast("decimal(38,0)")).cast("decimal(38,0)")
