"""SRC-7: seed loads of dimension rows with implicit ids.

The reference inserts sectors and exchanges without ids and lets a sequence
number them 1..n in input order. ``assign_ids`` does the same distributed:
range-partition on the input-order columns, number rows inside each partition
(``monotonically_increasing_id`` = partition index << 33 | row index), then add
the count of all earlier partitions. The per-partition counts table has one row
per partition, so it is the only thing broadcast. The numbered data is written
to the shared checkpoint folder first, so both passes see the same partitioning
even if an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.operators.checks import require_valid
from tickwise.schemas import TABLES
from tickwise.session import checkpoint_root

_ROW_BITS = 33


def assign_ids(df: DataFrame, order_by, id_col: str = "id", start: int = 1,
               num_partitions: int | None = None) -> DataFrame:
    """Dense ids ``start, start+1, ...`` following the order of ``order_by``."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    checkpoint_root(df.sparkSession)
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    numbered = (ranged.sortWithinPartitions(*cols)
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    part = F.shiftright(F.col("_mid"), _ROW_BITS)
    row = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = numbered.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = numbered.join(F.broadcast(offsets), part == F.col("_part"), "inner")
    return out.select((F.col("_off") + row + F.lit(start)).alias(id_col), *df.columns)


def load_seed(spark: SparkSession, rows: list[tuple], schema: T.StructType,
              implicit_id: bool = False, id_col: str = "id") -> DataFrame:
    """Rows given in input order; with ``implicit_id`` the ids are 1..n in that order."""
    if not implicit_id:
        return spark.createDataFrame(rows, schema)
    value_fields = [f for f in schema.fields if f.name != id_col]
    withpos = T.StructType([T.StructField("_pos", T.LongType(), False)] + value_fields)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], withpos)
    ided = assign_ids(df, "_pos", id_col=id_col).drop("_pos")
    return ided.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def load_seed_file(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                   implicit_id: bool = False, order_col: str | None = None,
                   id_col: str = "id") -> DataFrame:
    """Seed rows from a file; implicit ids follow ``order_col`` (an input-order column).

    ``operators.checks.require_valid`` on the result enforces the table's
    constraints, as ``load_reference_table`` does.
    """
    value_schema = T.StructType([f for f in schema.fields if not (implicit_id and f.name == id_col)])
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if implicit_id:
        if order_col is None:
            raise ValueError("implicit ids need an input-order column")
        read_schema = T.StructType(value_schema.fields + [T.StructField(order_col, T.LongType(), False)])
        df = reader.schema(read_schema).load(path)
        return assign_ids(df, order_col, id_col=id_col).drop(order_col).select(
            *[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return reader.schema(schema).load(path)


def load_reference_table(spark: SparkSession, name: str, path: str, parents: dict[str, DataFrame] | None = None,
                         **options) -> DataFrame:
    """Seed rows of table ``name`` from a file, with all constraints of the table enforced."""
    return require_valid(name, load_seed_file(spark, path, TABLES[name].schema, **options), parents)
