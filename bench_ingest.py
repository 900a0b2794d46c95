"""Streaming ingest throughput (JOB-2); prints ONE JSON line on stdout.

Env: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_FILES_PER_TRIGGER`` (default 4). All ticks of the tick view are encoded
into snapshot envelopes (SNK-1) and written as text files in a fresh scratch
folder; the checkpointed ingest query then decodes them and appends them to a
date-partitioned tick store with ``availableNow``. The time covers the whole
streaming query, start-up included.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    per_trigger = int(os.environ.get("BENCH_FILES_PER_TRIGGER", "4"))

    from tickwise.session import get_session
    run = tempfile.mkdtemp(prefix="bench-ingest-")
    spark = get_session("tickwise-bench-ingest", master=f"local[{cpus}]",
                        shuffle_partitions=cpus,
                        conf={"spark.checkpoint.dir": os.path.join(run, "checkpoints"),
                              "spark.driver.memory": "8g"})

    from tickwise.operators.encode import encode_snapshots
    from tickwise.schemas import TICK_FIELDS
    from tickwise.sources import adapters as A
    from tickwise.sources.streams import text_envelope_stream
    from tickwise.sources.tables import read_ticks
    from tickwise.streaming.ingest import ingest_ticks

    ticks = A.ticks(spark, sf_dir).select(*TICK_FIELDS, "seq")
    inbox = os.path.join(run, "in")
    encode_snapshots(ticks).select("value").repartition(4 * cpus).write.text(inbox)

    t0 = time.perf_counter()
    q = ingest_ticks(text_envelope_stream(spark, inbox, max_files_per_trigger=per_trigger),
                     os.path.join(run, "ticks"), os.path.join(run, "stream"), available_now=True)
    q.awaitTermination()
    seconds = time.perf_counter() - t0
    stored = read_ticks(spark, os.path.join(run, "ticks")).count()

    print(json.dumps({"metric": "ingest_ticks_per_second", "value": round(stored / seconds),
                      "unit": "ticks/s", "ticks": stored, "seconds": round(seconds, 3),
                      "files_per_trigger": per_trigger, "sf_dir": sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
