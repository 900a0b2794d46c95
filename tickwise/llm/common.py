"""Helpers shared by the operators of this subpackage.

Row keys. Operators that read their input more than once need a key that names
a row in every pass. ``with_row_key`` uses the given integer key when it is
unique and never null; otherwise it writes the rows once to the shared work
folder with a generated key, so repeated or null ids cost one extra write and
are otherwise handled alike.
"""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.session import checkpoint_root

INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written as a Parquet table in the shared work folder and reread."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def fresh_name(name: str, columns: Iterable[str]) -> str:
    """``name``, with underscores added until no column clashes with it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(df: DataFrame, key: str) -> tuple[DataFrame, str]:
    """``df`` with a bigint column that names each row; returns the column's name.

    One small job over the key column tells whether ``key`` is unique and
    never null. If it is not, the rows are written once with a generated key.
    """
    rid = fresh_name("row_key", df.columns)
    if isinstance(df.schema[key].dataType, INTEGER_TYPES):
        bad = (df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
               .filter("n > 1 OR k IS NULL").limit(1))
        if bad.isEmpty():
            return df.withColumn(rid, F.col(key).cast("long")), rid
    return written(df.withColumn(rid, F.monotonically_increasing_id()), "keyed"), rid


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The values of a string column as UTF-8 bytes, null as empty."""
    for v in pc.fill_null(column.cast(pa.binary()), b""):
        yield v.as_py()


def signed(value: int) -> int:
    """An unsigned 64-bit value as the signed integer Spark's bigint holds."""
    return value - (1 << 64) if value >= 1 << 63 else value


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces whose ``column`` holds about ``max_bytes`` (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def releasing(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]
              ) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` of an Arrow task, after which the worker gives back the memory that it left free.

    Workers go on to serve the tasks of later stages, and allocators keep what one
    task needed; without this a worker holds the most of all stages it has served.
    """

    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # the C library's, where it is glibc
            trim(0)

    return whole


def append_columns(df: DataFrame, source: str, fields: list[T.StructField], make,
                   keep_source: bool = False, max_bytes: int = 1 << 20) -> DataFrame:
    """Add columns computed from the string column ``source`` inside Arrow tasks.

    ``make()`` runs once per task and returns a function from a list of UTF-8
    values (null as empty) to a list of Arrow arrays, one for each of ``fields``.
    Rows pass in pieces of about ``max_bytes`` of text, so the memory of a task
    does not follow the batch size. ``source`` itself is dropped unless kept.
    """
    kept = [c for c in df.columns if c != source or keep_source]
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    names = kept + [f.name for f in fields]

    def run(batches):
        work = make()
        for batch in batches:
            for piece in slices(batch, source, max_bytes):
                new = work(list(utf8(piece.column(source))))
                yield pa.RecordBatch.from_arrays([piece.column(c) for c in kept] + new, names)

    return df.mapInArrow(releasing(run), schema)
