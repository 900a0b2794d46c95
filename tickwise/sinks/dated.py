"""Tables partitioned by ``date`` whose loads become visible as a whole (SNK-6).

Layout::

    date=D/load=L/             the rows of date D as load L wrote them
    _manifest/version=N/       which load of each date counts

A load writes all rows of the dates it touches into folders of its own and then one
manifest with a row per date; finishing that small job is the switch. Readers take the
newest finished manifest and open exactly the folders it names. A load that dies
earlier, even while its folders are moved into place, leaves files that no manifest
names. Folders that none of the ``KEPT_VERSIONS`` newest manifests names are
removed when a manifest falls out, so readers of an old version can end.

A table without a manifest (plain ``date=D`` folders) is read as it is, and taken over
whole by its next load. One load of a table at a time.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.operators.joins import sized_broadcast
from tickwise.sinks.files import exists, finished_versions, remove

MANIFEST_SCHEMA = T.StructType([T.StructField("date", T.DateType()), T.StructField("load", T.StringType())])
KEPT_VERSIONS = 4


def _root(path: str) -> str:
    return os.path.join(path, "_manifest")


def manifest(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(os.path.join(_root(path), f"version={version}"))


def _folder(path: str, row) -> str:
    return os.path.join(path, f"date={row['date'].isoformat()}", f"load={row['load']}")


def read_dated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table's newest version; None if there is no table."""
    versions = finished_versions(spark, _root(path))
    if versions:
        folders = [_folder(path, r) for r in manifest(spark, path, versions[-1]).collect()]  # one a date
        if not folders:
            return spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
        return spark.read.schema(stored).option("basePath", path).parquet(*folders).select(*schema.names)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # anything else must not pass for "no table yet"
            raise
        return None


def touched_rows(spark: SparkSession, path: str, schema: T.StructType, dates: DataFrame) -> DataFrame | None:
    """Stored rows of the dates that a load has to write: of ``dates``, or all of a table without manifest."""
    stored = read_dated(spark, path, schema)
    if stored is None or not finished_versions(spark, _root(path)):
        return stored
    # semi join on the partition column: only the touched dates are read
    return stored.join(sized_broadcast(dates), "date", "left_semi")


def publish_dates(spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType) -> None:
    """Replace every date of ``rows`` (all rows that these dates shall have) in one switch."""
    versions = finished_versions(spark, _root(path))
    number = versions[-1] if versions else -1
    if not versions and not exists(spark, _root(path)):
        # a first load that dies leaves an empty table, or the one without manifest
        if read_dated(spark, path, schema) is None:
            number = 0
            _write_manifest(spark.createDataFrame([], MANIFEST_SCHEMA), path, 0)
    load = uuid.uuid4().hex
    # a rebalance gathers a date's rows but splits a large date into several files
    (rows.select(*schema.names).withColumn("load", F.lit(load)).hint("rebalance", "date")
        .write.mode("append").partitionBy("date", "load").parquet(path))
    new = rows.select("date").distinct().withColumn("load", F.lit(load))
    if versions:
        old = manifest(spark, path, versions[-1])
        new = old.join(new.select("date"), "date", "left_anti").unionByName(new)
    _write_manifest(new, path, number + 1)
    _remove_old(spark, path)


def _write_manifest(rows: DataFrame, path: str, version: int) -> None:
    rows.coalesce(1).write.mode("overwrite").parquet(os.path.join(_root(path), f"version={version}"))


def _remove_old(spark: SparkSession, path: str) -> None:
    versions = finished_versions(spark, _root(path))
    kept = {tuple(r) for v in versions[-KEPT_VERSIONS:] for r in manifest(spark, path, v).collect()}
    for v in versions[:-KEPT_VERSIONS]:
        for r in manifest(spark, path, v).collect():
            if tuple(r) not in kept:
                remove(spark, _folder(path, r))
        remove(spark, os.path.join(_root(path), f"version={v}"))
