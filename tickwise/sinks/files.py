"""Folders of the tables that sinks keep: finished versions, missing tables, removal."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as the JVM's object."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly under ``path``; none if it does not exist."""
    fs, p = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def finished_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers N of the folders ``version=N`` whose job has finished, lowest first."""
    return sorted(int(n.split("=")[1]) for n in child_names(spark, path)
                  if n.startswith("version=") and exists(spark, f"{path}/{n}/_SUCCESS"))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``; empty if the path does not exist (and only then)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
