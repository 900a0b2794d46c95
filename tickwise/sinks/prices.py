"""SNK-3 / BAR-2 / SNK-6: idempotent keyed upsert of daily bars into ``prices``.

``prices`` is a Parquet table partitioned by ``date``. An upsert touches only
the dates present in the new bars: existing rows of those dates whose key is
not re-delivered are kept, re-delivered keys are replaced. The merged rows are
first checkpointed to the shared checkpoint folder, so a lost executor recomputes
from the checkpoint.

An upsert becomes visible as a whole: the rows of its dates are written beside
the old ones, and one manifest switches all dates at once (``sinks.dated``). A job
that dies at any point before leaves the old table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators.checks import ConstraintViolation, check_primary_key, require_valid
from tickwise.schemas import BAR_KEY, BAR_VALUE_COLUMNS, PRICES_SCHEMA
from tickwise.session import checkpoint_root
from tickwise.sinks.dated import publish_dates, touched_rows


def merge_bars(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Keyed upsert as a DataFrame: for every (company_id, date) a re-delivered
    row replaces the stored one (all five values, NULLs included); stored rows
    whose key is not re-delivered are kept.

    One union and one aggregate on the key, keeping the values of the newer
    side: ``new`` is read once, there is a single shuffle, and since a key has
    at most two rows no key can be hot. ``new`` must be unique on the key
    (``daily_bars`` guarantees it), as the stored table is by its primary key.
    """
    cols = [f.name for f in PRICES_SCHEMA.fields]
    both = (existing.select(*cols, F.lit(0).alias("_newer"))
            .unionByName(new.select(*cols, F.lit(1).alias("_newer"))))
    merged = both.groupBy(*BAR_KEY).agg(
        *[F.max_by(c, "_newer").alias(c) for c in BAR_VALUE_COLUMNS])
    return merged.select(*cols)


def upsert_bars(spark: SparkSession, bars: DataFrame, prices_path: str,
                companies: DataFrame | None = None) -> DataFrame:
    """Write ``bars`` into the prices table at ``prices_path``; returns the merged rows.

    The bars must keep the table's primary key and, where ``companies`` is
    given, reference listed companies; else nothing is written.
    """
    checkpoint_root(spark)
    new = bars.select(*[F.col(f.name).cast(f.dataType) for f in PRICES_SCHEMA.fields])
    new = new.checkpoint(eager=True)  # computed once, reused for dates, keys and rows
    if companies is not None:
        require_valid("prices", new, {"companies": companies})
    elif not check_primary_key(new, list(BAR_KEY)).isEmpty():
        raise ConstraintViolation("prices: primary_key")
    existing = touched_rows(spark, prices_path, PRICES_SCHEMA, new.select("date").distinct())
    merged = new if existing is None else merge_bars(existing, new).checkpoint(eager=True)
    publish_dates(spark, merged, prices_path, PRICES_SCHEMA)
    return merged
