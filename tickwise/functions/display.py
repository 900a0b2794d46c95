"""Display columns of the live market table.

A missing number (NULL or NaN) shows as ``MISSING`` and is not a gain.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The live market table's display formats and gain/loss classes.
MONEY_FORMAT = "$%.2f"
PERCENT_FORMAT = "%.2f%%"
VOLUME_FORMAT = "#,##0.###"
GAIN_CLASS = "positive"
LOSS_CLASS = "negative"
MISSING = "-"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """The number, NULL when it is NULL or NaN."""
    return F.nanvl(_col(c).cast("double"), F.lit(None).cast("double"))


def _shown(c: Column | str, text: Column) -> Column:
    return F.when(present(c).isNull(), F.lit(MISSING)).otherwise(text)


def money(c: Column | str) -> Column:
    """``$`` + two decimals."""
    return _shown(c, F.format_string(MONEY_FORMAT, _col(c)))


def percent(c: Column | str) -> Column:
    """Two decimals + ``%``."""
    return _shown(c, F.format_string(PERCENT_FORMAT, _col(c)))


def thousands(c: Column | str) -> Column:
    """Thousands separators, at most three decimals (locale-style number)."""
    return _shown(c, F.call_function("format_number", _col(c).cast("double"), F.lit(VOLUME_FORMAT)))


def change_class(pct: Column | str) -> Column:
    """``positive`` when the change is >= 0, else (missing included) ``negative``."""
    return F.when(present(pct) >= 0, F.lit(GAIN_CLASS)).otherwise(F.lit(LOSS_CLASS))
