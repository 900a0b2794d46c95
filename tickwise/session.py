"""Session construction and the shared checkpoint folder.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a shared
filesystem path named by the cluster). Only a local master without that setting
(tests, the bench) gets a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC wall-clock semantics for tick
# timestamps, adaptive execution (runtime re-planning, partition coalescing and
# skew-join splitting), and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of materialized intermediate results (closing marks,
    # merged bars) are removed once their DataFrame is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # compiled whole-stage code is cached by generated source; a mix of
    # report, bar, check and snapshot queries has more distinct stages than
    # the default 100 entries, and each eviction means recompiling a stage
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def get_session(app_name: str = "tickwise", master: str | None = None,
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder and register it for ``Dataset.checkpoint``.

    Reads ``spark.checkpoint.dir``; sets a scratch folder only for a local master
    where it is unset. A cluster without the setting is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tickwise-ckpt-")
        _LOCAL_ROOTS[sc.applicationId] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


_LOCAL_ROOTS: dict[str, str] = {}


def stream_checkpoint(spark: SparkSession, query_name: str) -> str:
    """Checkpoint location of one streaming query, under the shared folder."""
    return os.path.join(checkpoint_root(spark), "streams", query_name)
