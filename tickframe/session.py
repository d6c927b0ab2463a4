"""Spark session helpers.

The library never creates sessions on its own; tests, the bench and the
driver hand one in.  ``build_session`` is the local/test convenience.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query here relies on: UTC for day arithmetic, AQE for
# runtime re-planning (coalescing small shuffles, splitting skewed joins).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of dereferenced intermediates are removed by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "tickframe", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(partitions or int(cpus))
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set (a path that all machines share); only a session
    in one JVM (``local`` masters) gets a fresh temporary folder when it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="tickframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
