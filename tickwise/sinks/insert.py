"""INSERT of rows into a relational table, with its constraints kept against stored rows.

The rows must keep every constraint of the table among themselves (``operators.
checks``), and no primary or unique key of theirs may be stored already
(``operators.keycheck``: the stored side is not shuffled). All rows are written
or none: Spark's commit moves the files of a finished job only, so a job that
dies before leaves the table as it was, and a repeated insert is refused.
Two inserts into one table must not run at the same time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators.checks import ConstraintViolation, require_valid
from tickwise.operators.keycheck import stored_conflicts
from tickwise.schemas import TABLES
from tickwise.session import checkpoint_root
from tickwise.sinks.files import read_or_empty


def insert_rows(spark: SparkSession, name: str, rows: DataFrame, path: str,
                parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Append ``rows`` to table ``name`` at ``path``; returns what was written.

    Raises ``ConstraintViolation`` and writes nothing if a constraint would break.
    """
    spec = TABLES[name]
    checkpoint_root(spark)
    new = rows.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema.fields]).checkpoint(eager=True)
    require_valid(name, new, parents)
    stored = read_or_empty(spark, path, spec.schema)
    broken = [",".join(keys) for keys in dict.fromkeys((spec.primary_key, *spec.unique))
              if not stored_conflicts(new, stored, keys).isEmpty()]
    if broken:
        raise ConstraintViolation(f"{name}: already stored: {'; '.join(broken)}")
    new.write.mode("append").parquet(path)
    return new
