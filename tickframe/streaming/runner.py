"""Drive a streaming job over files landed in time order and collect its output.

``stage_events`` lands the events once, in one folder per interval of event time (plus, optionally, an exact repeat of
one interval, rows older than the watermark, or a heartbeat after the end).  ``run`` moves one folder after the other into
the folder that ``readStream`` watches and starts the query again from its checkpoint with ``Trigger.AvailableNow``: an
interval is one micro-batch however many files it has, so results do not depend on file counts, cores or batch limits, and
every interval is a restart.  Micro-batches go through ``foreachBatch`` into a folder named by their epoch, which a
repeated epoch overwrites.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.sources.files import scratch
from tickframe.streaming.ops import EVENT_SCHEMA

MARKER_INSTANCE = -1


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in path, sorted; none if there is no such path."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def stage_events(events: DataFrame, n_batches: int = 4, repeat_batch: int | None = None,
                 late_rows: DataFrame | None = None, end_marker: bool = False) -> str:
    """Writes the events by interval of event time, in one pass; returns the folder of the interval folders."""
    path = scratch(events.sparkSession, "stream-src")
    bounds = F.broadcast(events.agg(F.min("ts").alias("_lo"), F.max("ts").alias("_hi")))  # one row
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    at = F.floor((micros("ts") - micros("_lo")) * n_batches / (micros("_hi") - micros("_lo") + 1)).cast("int")
    rows = events.join(bounds).withColumn("batch", F.coalesce(at, F.lit(0))).drop("_lo", "_hi")
    if repeat_batch is not None:
        rows = rows.withColumn("_n", F.explode(F.when(F.col("batch") == repeat_batch, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_n")
    if late_rows is not None:
        rows = rows.unionByName(late_rows.withColumn("batch", F.lit(n_batches)))
    if end_marker:
        rows = rows.unionByName(bounds.select(
            F.lit(-1).cast("bigint").alias("event_id"), (F.col("_hi") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz").alias("ts"),
            F.lit(MARKER_INSTANCE).cast("bigint").alias("user_id"), F.lit("heartbeat").alias("event_type"),
            F.lit(0.0).alias("value"), F.lit("{}").alias("props"), F.lit(n_batches + 1).alias("batch")))
    rows.withColumn("batch", F.format_string("%05d", "batch")).write.partitionBy("batch").parquet(path)
    return path


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def drive(spark: SparkSession, source: str, start) -> list:
    """start(folder) starts a query that watches folder; it is started once per interval folder of source, in order.
    Returns the progress records of all starts."""
    watched = scratch(spark, "stream-in")
    fs, to = _fs(spark, watched)
    fs.mkdirs(to)
    progress = []
    for name in folders(spark, source) or [None]:
        if name:
            fs.rename(_fs(spark, f"{source}/{name}")[1], _fs(spark, f"{watched}/{name.replace('=', '-')}")[1])
        query = start(watched)
        query.awaitTermination()
        progress += query.recentProgress
    return progress


def late_rows(progress: list) -> int:
    """Rows that a stateful operator turned away because they were older than the watermark."""
    return sum(o.numRowsDroppedByWatermark for p in progress for o in p.stateOperators)


def run(spark: SparkSession, source: str, build, mode: str = "complete", watermark: str | None = "10 minutes", timers: bool = True) -> DataFrame:
    """Run ``build(stream) -> stream`` to completion; returns the collected output as a batch frame.

    complete: the last micro-batch carries the whole result; append: the micro-batches together are the result
    (stateless or watermark-finalised rows).
    """
    from tickframe.streaming.ops import as_samples
    from tickframe.streaming.stateful import rocksdb
    out, ck = scratch(spark, "stream-out"), scratch(spark, "stream-ckpt")
    schema = None

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{epoch:09d}")

    def start(folder: str):
        nonlocal schema
        s = as_samples(read_stream(spark, folder))
        if watermark:
            s = s.withWatermark("ts", watermark)
        res = build(s)
        schema = res.schema
        return res.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", ck).trigger(availableNow=True).start()

    with rocksdb(spark) if timers else nullcontext():  # without timers the session's own state store does
        drive(spark, source, start)
    epochs = folders(spark, out)
    if not epochs:  # no micro-batch ran
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{out}/{e}" for e in (epochs[-1:] if mode == "complete" else epochs)])
