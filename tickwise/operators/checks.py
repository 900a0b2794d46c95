"""CHK-1..4: table constraints re-aimed as distributed checks returning violations.

The reference database enforces NOT NULL / UNIQUE / PRIMARY KEY / FOREIGN KEY
per inserted row. On Spark tables a check is one job over the whole table:
* NOT NULL: a filter;
* UNIQUE: ``groupBy(keys).count() > 1`` after dropping NULL keys (NULLs never
  conflict) -- a partial-able aggregate, so a hot key is pre-counted map-side;
* FOREIGN KEY: non-NULL references ``left_anti`` the distinct parent keys; the
  parent side is broadcast only when its size check passes, else a shuffle
  join where adaptive execution splits a skewed child key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators.joins import sized_broadcast
from tickwise.schemas import TABLES


def _seq(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def check_not_null(df: DataFrame, columns) -> DataFrame:
    """Rows where any of ``columns`` is NULL, with the offending column named."""
    cols = _seq(columns)
    which = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return df.filter(cond).withColumn("null_columns", which)


def check_unique(df: DataFrame, keys) -> DataFrame:
    """Key values occurring more than once (rows with a NULL key part ignored)."""
    ks = _seq(keys)
    notnull = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ks])
    return (df.filter(notnull).groupBy(*ks).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def check_primary_key(df: DataFrame, keys) -> DataFrame:
    """Primary-key violations: ``violation`` is ``null_key`` or ``duplicate``.

    One row per violating key value: NULL keys are counted per distinct key
    combination just like duplicates, so the output is keyed and bounded.
    """
    ks = _seq(keys)
    anynull = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in ks])
    counted = (df.groupBy(*ks).agg(F.count(F.lit(1)).alias("n_rows"))
                 .withColumn("violation",
                             F.when(anynull, F.lit("null_key"))
                              .when(F.col("n_rows") > 1, F.lit("duplicate"))))
    return counted.filter(F.col("violation").isNotNull())


def check_foreign_key(child: DataFrame, columns, parent: DataFrame, parent_columns) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row."""
    cs, ps = _seq(columns), _seq(parent_columns)
    notnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cs])
    # Anti-join semantics do not need distinct parent keys; skipping distinct
    # saves a shuffle of the parent table.
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(ps, cs)])
    return child.filter(notnull).join(sized_broadcast(keys), cs, "left_anti").select(*child.columns)


def validate_table(name: str, df: DataFrame, parents: dict[str, DataFrame] | None = None
                   ) -> dict[str, DataFrame]:
    """All declared constraints of table ``name`` -> violation DataFrames by check id.

    Every parent table that the foreign keys name must be passed: a check that
    cannot run is an error, not a pass.
    """
    spec = TABLES[name]
    missing = sorted({fk.parent for fk in spec.foreign_keys} - set(parents or {}))
    if missing:
        raise ValueError(f"{name}: no parent table given for {', '.join(missing)}")
    out: dict[str, DataFrame] = {}
    out["not_null"] = check_not_null(df, list(spec.not_null) + list(spec.primary_key))
    out["primary_key"] = check_primary_key(df, spec.primary_key)
    for u in spec.unique:
        out["unique:" + ",".join(u)] = check_unique(df, u)
    for fk in spec.foreign_keys:
        out["foreign_key:" + ",".join(fk.columns)] = check_foreign_key(
            df, fk.columns, parents[fk.parent], fk.parent_columns)
    return out


class ConstraintViolation(ValueError):
    """A load would break the constraints of its table."""


def require_valid(name: str, df: DataFrame, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """``df`` if it keeps every constraint of table ``name``; else an error that names those it breaks."""
    broken = [check for check, rows in validate_table(name, df, parents).items() if not rows.isEmpty()]
    if broken:
        raise ConstraintViolation(f"{name}: {', '.join(broken)}")
    return df
