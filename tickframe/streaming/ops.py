"""ST-01 .. ST-16 as DataFrame functions that run unchanged on a batch or a streaming
``events`` frame (ts TIMESTAMP, event_type, user_id, value, props).

Events are re-aimed as metric samples: event_type -> metric name (fixed mapping
below), user_id -> instance, value -> sample value, props.k -> label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values ------------------------------------------------------------------------
# event type -> monitored metric
METRIC_OF_EVENT = {"view": "cpu_usage", "click": "memory_usage", "signup": "disk_usage",
                   "purchase": "db_connection_time", "error": "error_rate"}
# in-process monitor thresholds and severities
ALERT_THRESHOLDS = [("cpu_usage", 80.0, "warning", "High CPU usage"),
                    ("memory_usage", 85.0, "warning", "High memory usage"),
                    ("disk_usage", 90.0, "critical", "High disk usage"),
                    ("db_connection_time", 5.0, "warning", "Slow database connection"),
                    ("error_rate", 5.0, "warning", "High error rate")]
# latency histogram bucket edges (seconds); samples are value / 10 seconds
DURATION_BUCKETS = [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0]
# rule windows and limits
RATE_WINDOW, RATE_SLIDE, RATE_LIMIT = "5 minutes", "1 minute", 0.1
HIT_RATIO_FLOOR = 70.0
LATENCY_LIMIT = 2.0
SESSION_GAP = "10 minutes"
RESOURCE_LIMIT_PCT = 80.0
# -------------------------------------------------------------------------------------------

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def as_samples(events: DataFrame) -> DataFrame:
    """Event-time column as TIMESTAMP (watermarks reject TIMESTAMP_NTZ), metric name, label."""
    m = F.create_map(*[x for k, v in METRIC_OF_EVENT.items() for x in (F.lit(k), F.lit(v))])
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type",
                         m[F.col("event_type")].alias("metric"), F.col("user_id").alias("instance"), "value",
                         F.get_json_object("props", "$.k").cast("int").alias("label"))


def rate_windows(s: DataFrame, window=RATE_WINDOW, slide=RATE_SLIDE, limit=RATE_LIMIT) -> DataFrame:
    """Windows of ST-01 with their window column."""
    secs = 300.0
    g = s.groupBy(F.window("ts", window, slide).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return g.select("w", "event_type", F.col("n").cast("bigint").alias("n"), (F.col("n") / secs).alias("rate"), (F.col("n") / secs > limit).alias("alert"))


def rate_alerts(s: DataFrame, window=RATE_WINDOW, slide=RATE_SLIDE, limit=RATE_LIMIT) -> DataFrame:
    """ST-01: per-second rate over a sliding 5-minute window per series, flagged above the limit."""
    return rate_windows(s, window, slide, limit).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n", "rate", "alert")


def bucket_counts(s: DataFrame, keys, edges=DURATION_BUCKETS, scale: float = 10.0) -> DataFrame:
    """ST-12: cumulative fixed-bucket histogram counts (le edges) + total per key."""
    v = F.col("value") / scale
    aggs = [F.count_if(v <= e).cast("bigint").alias(f"le_{str(e).replace('.', '_')}") for e in edges]
    return s.groupBy(*keys).agg(*aggs, F.count("*").cast("bigint").alias("total"), F.sum(v).alias("sum"))


def histogram_quantile(counts: DataFrame, q: float = 0.95, edges=DURATION_BUCKETS) -> Column:
    """ST-02: Prometheus-style quantile from cumulative buckets: linear interpolation inside the
    bucket holding rank q * total; above the last finite edge the last edge is returned."""
    names = [f"le_{str(e).replace('.', '_')}" for e in edges]
    rank = F.lit(q) * F.col("total")
    expr = F.lit(edges[-1])
    # build from the last bucket backwards so the first matching bucket wins
    for i in range(len(edges) - 1, -1, -1):
        lo = 0.0 if i == 0 else edges[i - 1]
        prev = F.lit(0) if i == 0 else F.col(names[i - 1])
        cur = F.col(names[i])
        interp = F.lit(lo) + (edges[i] - lo) * (rank - prev) / (cur - prev)
        expr = F.when(cur >= rank, interp).otherwise(expr)
    return F.when(F.col("total") > 0, expr)


def p95_windows(s: DataFrame, window="5 minutes", slide="1 minute", q=0.95) -> DataFrame:
    """ST-02: windowed bucket counts then the interpolated quantile."""
    return latency_windows(s, window, slide, q).select(F.col("w.start").alias("window_start"), "event_type", "total", "p95_seconds")


def latency_windows(s: DataFrame, window="5 minutes", slide="1 minute", q=0.95, limit=LATENCY_LIMIT) -> DataFrame:
    """Windows of ST-02 with their window column, flagged above the limit."""
    c = bucket_counts(s, [F.window("ts", window, slide).alias("w"), "event_type"])
    c = c.select("w", "event_type", "total", histogram_quantile(c, q).alias("p95_seconds"))
    return c.withColumn("alert", F.col("p95_seconds") > limit)


def hit_ratio(s: DataFrame, window="10 minutes", floor=HIT_RATIO_FLOOR) -> DataFrame:
    """ST-03 / A-30: hits (view) and misses (click) per tumbling window, ratio in percent."""
    return hit_ratio_windows(s, window, floor).select(F.col("w.start").alias("window_start"), "hits", "misses", "hit_ratio", "alert")


def hit_ratio_windows(s: DataFrame, window="10 minutes", floor=HIT_RATIO_FLOOR) -> DataFrame:
    """Windows of ST-03 with their window column."""
    g = s.groupBy(F.window("ts", window).alias("w")).agg(
        F.count_if(F.col("event_type") == "view").cast("bigint").alias("hits"),
        F.count_if(F.col("event_type") == "click").cast("bigint").alias("misses"))
    ratio = F.try_divide(F.col("hits") * 100.0, F.col("hits") + F.col("misses"))
    return g.select("w", "hits", "misses", ratio.alias("hit_ratio"), (ratio < floor).alias("alert"))


def sessions(s: DataFrame, gap=SESSION_GAP) -> DataFrame:
    """ST-06: activity sessions per instance; a silence longer than the gap closes a session."""
    g = s.groupBy(F.session_window("ts", gap).alias("w"), "instance").agg(F.count("*").cast("bigint").alias("n"))
    return g.select("instance", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def threshold_alerts(s: DataFrame) -> DataFrame:
    """ST-07 / J-16: one row per sample above its metric's limit, with severity and message.

    The thresholds form a fixed five-row table joined by broadcast on the metric name
    (theta condition value > limit)."""
    spark = s.sparkSession
    th = spark.createDataFrame(ALERT_THRESHOLDS, "metric STRING, limit DOUBLE, severity STRING, title STRING")
    j = s.join(F.broadcast(th), "metric").filter(F.col("value") > F.col("limit"))
    # one decimal via DECIMAL rounding (formatting a double directly breaks ties engine-dependently)
    shown = F.round(F.col("value").cast("decimal(18,4)"), 1).cast("decimal(18,1)").cast("string")
    return j.select("event_id", "ts", "metric", "instance", "value", "limit", "severity",
                    F.concat(F.col("title"), F.lit(": "), shown).alias("message"))


def alert_flags(s: DataFrame) -> DataFrame:
    """The alerts among the samples, with value 1.  Other samples say nothing to the rule (a group ends by the clock), so they stay out of
    its state; only those without a time are kept, with value 0: by that the condition names ts, and Spark leaves a filter on the
    event time above the watermark.  One on the value alone would be pushed below it, and it would stand still while all is well."""
    th = s.sparkSession.createDataFrame([t[:2] for t in ALERT_THRESHOLDS], "metric STRING, limit DOUBLE")
    flags = s.join(F.broadcast(th), "metric", "left").select(F.coalesce("metric", F.lit("heartbeat")).alias("metric"), "ts", "event_id",
                                                           F.coalesce((F.col("value") > F.col("limit")).cast("double"), F.lit(0.0)).alias("value"))
    return flags.where((F.col("value") > 0) | F.col("ts").isNull())


def ohlc_bars(s: DataFrame, window="1 hour") -> DataFrame:
    """ST-10: tumbling-window bars per series: open / close by event time, high, low, count, total."""
    g = s.groupBy(F.window("ts", window).alias("w"), "event_type").agg(
        F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
        F.max_by("value", "ts").alias("close"), F.count("*").cast("bigint").alias("n"),
        F.sum(F.col("value").cast("decimal(38,6)")).cast("double").alias("total"))
    return g.select(F.col("w.start").alias("bucket"), F.col("event_type").alias("symbol"), "open", "high", "low",
                    "close", "n", "total")


def latest_per_key(s: DataFrame, keys) -> DataFrame:
    """ST-08: running last sample time and value per key (the freshness input)."""
    return s.groupBy(*keys).agg(F.max("ts").alias("last_ts"), F.max_by("value", "ts").alias("last_value"), F.count("*").cast("bigint").alias("n"))


def instance_average(s: DataFrame, window="5 minutes") -> DataFrame:
    """ST-14: windowed average per instance."""
    g = s.groupBy(F.window("ts", window).alias("w"), "instance").agg(F.avg("value").alias("avg_value"),
                                                                      F.count("*").cast("bigint").alias("n"))
    return g.select(F.col("w.start").alias("window_start"), "instance", "avg_value", "n")


def resource_share(s: DataFrame, window="1 hour", used="click", total="view", limit=RESOURCE_LIMIT_PCT) -> DataFrame:
    """ST-15: per window and instance, the last 'used' and last 'total' sample, used share in percent."""
    return share_windows(s, window, used, total, limit).select(F.col("w.start").alias("window_start"), "instance", "used", "capacity", "used_pct", "alert")


def share_windows(s: DataFrame, window="1 hour", used="click", total="view", limit=RESOURCE_LIMIT_PCT, keys=("instance",)) -> DataFrame:
    """Windows of ST-15 with their window column."""
    g = s.groupBy(F.window("ts", window).alias("w"), *keys).agg(
        F.max_by(F.when(F.col("event_type") == used, F.col("value")), F.when(F.col("event_type") == used, F.col("ts")))
        .alias("used"),
        F.max_by(F.when(F.col("event_type") == total, F.col("value")), F.when(F.col("event_type") == total, F.col("ts")))
        .alias("capacity"))
    pct = F.try_divide(F.col("used") * 100.0, F.col("capacity"))
    return g.select("w", *keys, "used", "capacity", pct.alias("used_pct"), (pct > limit).alias("alert"))

