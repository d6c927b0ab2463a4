"""Streaming queries ST-01 .. ST-16 (each runs a real stream over the events landed as
time-ordered files, Trigger.AvailableNow) and the batch monitoring rules F-23, F-26,
J-16, A-29, A-30, T-06, S-26."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import screen as SCR
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, oround, rounded
from tickframe.sources import files as FS
from tickframe.streaming import ops as O
from tickframe.streaming import runner as RUN
from tickframe.streaming import stateful as ST

# the oracles state the mapping, limits and edges themselves, so that a wrong constant in the code shows
MAP_SQL = """CASE event_type WHEN 'view' THEN 'cpu_usage' WHEN 'click' THEN 'memory_usage' WHEN 'signup' THEN 'disk_usage'
  WHEN 'purchase' THEN 'db_connection_time' WHEN 'error' THEN 'error_rate' END"""
EDGES = [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0]
SAMPLES = f"""s AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, event_type, {MAP_SQL} AS metric,
  user_id AS instance, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS label FROM events)"""
THRESH = """th(metric, lim, severity, title) AS (VALUES ('cpu_usage', 80.0, 'warning', 'High CPU usage'),
  ('memory_usage', 85.0, 'warning', 'High memory usage'), ('disk_usage', 90.0, 'critical', 'High disk usage'),
  ('db_connection_time', 5.0, 'warning', 'Slow database connection'), ('error_rate', 5.0, 'warning', 'High error rate'))"""


def _ntz(df, *cols):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns])


def _stream(spark, sf, build, mode="append", watermark="10 minutes", end_marker=True, timers=False, **stage):
    """Append mode: a heartbeat of an instance of its own, a day after the data, moves the watermark past the last window."""
    ev = Views(spark, sf).table("events")
    src = RUN.stage_events(ev, end_marker=end_marker and mode == "append", **stage)
    out = RUN.run(spark, src, build, mode, watermark, timers)
    for c, marker in (("instance", RUN.MARKER_INSTANCE), ("event_type", "heartbeat")):
        if c in out.columns:
            out = out.where(F.col(c) != marker)
    return out


def _floor(secs):
    return f"to_timestamp(FLOOR(epoch(ts) / {secs}) * {secs})::TIMESTAMP"


@query("st01_rate_alerts", oround(f"""
WITH {SAMPLES}, k AS (SELECT UNNEST(range(0, 5)) AS k),
w AS (SELECT {_floor(60)} - to_minutes(k.k) AS window_start, event_type FROM s, k)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, CAST(COUNT(*) AS BIGINT) AS n,
       COUNT(*) / 300.0 AS rate, COUNT(*) / 300.0 > 0.1 AS alert FROM w GROUP BY 1, 2, 3""", ["rate"], 9))
def st01(spark, sf):
    """ST-01: sliding 5-minute rate per series (1-minute slide), alert above 0.1/s."""
    out = _stream(spark, sf, O.rate_alerts)
    return rounded(_ntz(out, "window_start", "window_end"), 9)


def _p95_sql():
    cols = ", ".join(f"COUNT_IF(value / 10 <= {e}) AS c{i}" for i, e in enumerate(EDGES))
    e = EDGES
    expr = f"{e[-1]}"
    for i in range(len(e) - 1, -1, -1):
        lo = 0.0 if i == 0 else e[i - 1]
        prev = "0" if i == 0 else f"c{i - 1}"
        expr = (f"CASE WHEN c{i} >= 0.95 * total THEN {lo} + ({e[i]} - {lo}) * (0.95 * total - {prev}) / (c{i} - {prev}) "
                f"ELSE {expr} END")
    return f"""
WITH {SAMPLES}, k AS (SELECT UNNEST(range(0, 5)) AS k),
w AS (SELECT {_floor(60)} - to_minutes(k.k) AS window_start, event_type, value FROM s, k),
c AS (SELECT window_start, event_type, CAST(COUNT(*) AS BIGINT) AS total, {cols} FROM w GROUP BY 1, 2)
SELECT window_start, event_type, total, CASE WHEN total > 0 THEN {expr} END AS p95_seconds FROM c"""


@query("st02_p95_latency", oround(_p95_sql(), ["p95_seconds"], 9))
def st02(spark, sf):
    """ST-02: 95th percentile from fixed histogram buckets (linear interpolation in the bucket)."""
    out = _stream(spark, sf, O.p95_windows)
    return rounded(_ntz(out, "window_start"), 9)


@query("st03_cache_hit_ratio", oround(f"""
WITH {SAMPLES}
SELECT {_floor(600)} AS window_start, CAST(COUNT_IF(event_type = 'view') AS BIGINT) AS hits,
       CAST(COUNT_IF(event_type = 'click') AS BIGINT) AS misses,
       COUNT_IF(event_type = 'view') * 100.0 / NULLIF(COUNT_IF(event_type = 'view') + COUNT_IF(event_type = 'click'), 0) AS hit_ratio,
       COUNT_IF(event_type = 'view') * 100.0 / NULLIF(COUNT_IF(event_type = 'view') + COUNT_IF(event_type = 'click'), 0) < 70 AS alert
FROM s GROUP BY 1""", ["hit_ratio"], 9))
def st03(spark, sf):
    out = _stream(spark, sf, O.hit_ratio)
    return rounded(_ntz(out, "window_start"), 9)


@query("st04_instant_rate", oround(f"""
WITH {SAMPLES}, l AS (SELECT event_type, instance, ts, value, LAG(ts) OVER w AS pts, LAG(value) OVER w AS pv FROM s
  WINDOW w AS (PARTITION BY event_type, instance ORDER BY ts, event_id))
SELECT event_type, instance, ts, value, CASE WHEN pts IS NOT NULL AND epoch_us(ts) - epoch_us(pts) > 0 THEN
  (CASE WHEN value >= pv THEN value - pv ELSE value END) / ((epoch_us(ts) - epoch_us(pts)) / 1e6) END AS irate FROM l""", ["irate"], 9))
def st04(spark, sf):
    """ST-04: instant rate per series from the last two samples; a drop is a counter reset."""
    out = _stream(spark, sf, ST.irate, timers=True)
    return rounded(_ntz(out, "ts"), 9)


def _sustained_sql(limit, hold):
    return f"""
WITH {SAMPLES}, g AS (SELECT event_type, instance, ts, value, SUM(CASE WHEN value > {limit} THEN 0 ELSE 1 END) OVER
  (PARTITION BY event_type, instance ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM s),
r AS (SELECT *, MIN(ts) OVER (PARTITION BY event_type, instance, grp) AS first_ts FROM g WHERE value > {limit})
SELECT event_type, instance, ts, value, first_ts AS run_start FROM r WHERE (epoch_us(ts) - epoch_us(first_ts)) / 1e6 >= {hold}"""


# fixed rule parameters: error level above 100 held 10 minutes; connections above 20 held 2 minutes
@query("st05_sustained_condition", _sustained_sql(100.0, 600))
def st05(spark, sf):
    """ST-05: a condition that must hold continuously for a duration before the rule fires."""
    out = _stream(spark, sf, lambda s: ST.sustained(s, 100.0, 600), timers=True)
    return _ntz(out, "ts", "run_start")


@query("st16_level_above_limit", _sustained_sql(20.0, 120))
def st16(spark, sf):
    """ST-16: level above a limit (connections > 20) for 2 minutes."""
    out = _stream(spark, sf, lambda s: ST.sustained(s, 20.0, 120), timers=True)
    return _ntz(out, "ts", "run_start")


@query("st06_instance_sessions", f"""
WITH {SAMPLES}, l AS (SELECT instance, ts, LAG(ts) OVER (PARTITION BY instance ORDER BY ts) AS pts FROM s),
g AS (SELECT instance, ts, SUM(CASE WHEN pts IS NULL OR ts >= pts + INTERVAL 10 MINUTE THEN 1 ELSE 0 END)
  OVER (PARTITION BY instance ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM l)
SELECT instance, MIN(ts) AS session_start, MAX(ts) + INTERVAL 10 MINUTE AS session_end, CAST(COUNT(*) AS BIGINT) AS n
FROM g GROUP BY instance, sid""")
def st06(spark, sf):
    """ST-06: sessions per instance (gap 10 minutes); a gap is a silence of the instance."""
    return _ntz(_stream(spark, sf, O.sessions), "session_start", "session_end")


@query("st06_instance_silences", f"""
WITH {SAMPLES}, n AS (SELECT instance, ts, LEAD(ts) OVER (PARTITION BY instance ORDER BY ts) AS nts FROM s),
q AS (SELECT * FROM n WHERE nts IS NULL OR nts >= ts + INTERVAL 10 MINUTE)
SELECT instance, 'down' AS status, ts AS silent_since, ts + INTERVAL 10 MINUTE AS at FROM q
UNION ALL SELECT instance, 'up', ts, nts FROM q WHERE nts IS NOT NULL""")
def st06_silences(spark, sf):
    """ST-06: an instance without a sample for 10 minutes is down (a timer fires without input), its next sample ends the silence."""
    return _ntz(_stream(spark, sf, ST.silences, timers=True), "silent_since", "at")


def _firing_sql(windows, keys, hold, slide):
    """Runs of consecutive windows of the condition that lasted long enough; windows: keys, e (window end), alert."""
    return f"""
WITH {SAMPLES}, k AS (SELECT UNNEST(range(0, 5)) AS k), win AS ({windows}),
g AS (SELECT *, epoch_us(e) - ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY e) * {slide} * 1000000 AS run FROM win WHERE alert)
SELECT {keys}, MIN(e) AS pending_since, MIN(e) + to_seconds({hold}) AS firing_from, MAX(e) + to_seconds({slide}) AS resolved_at
FROM g GROUP BY {keys}, run HAVING epoch_us(MAX(e)) - epoch_us(MIN(e)) >= {hold} * 1000000"""


def _firing(spark, sf, windows, keys, hold, slide):
    """ST-05 behind a windowed aggregate of the same query: a rule fires once its condition has held, and until it no longer does.
    Both steps are stateful; the aggregate passes the watermark on."""
    out = _stream(spark, sf, lambda s: ST.firing(windows(s), keys, hold, slide), timers=True)
    # window ends reach the rule as their last microsecond
    return _ntz(out.select(*keys, *(F.timestamp_micros(F.unix_micros(c) + 1).alias(c) for c in ("pending_since", "firing_from", "resolved_at"))),
                "pending_since", "firing_from", "resolved_at")


# limits of the fixture's sparse events: two in five minutes; the reference's limits for latency, hit ratio and share
@query("st05_rate_firing", _firing_sql(f"""SELECT event_type, {_floor(60)} - to_minutes(k.k) + INTERVAL 5 MINUTE AS e, COUNT(*) / 300.0 > 0.005 AS alert
  FROM s, k GROUP BY 1, 2""", "event_type", 120, 60))
def st05_rate(spark, sf):
    """ST-05 on ST-01: a rate above the limit for 2 minutes."""
    return _firing(spark, sf, lambda s: O.rate_windows(s, limit=0.005), ["event_type"], 120, 60)


@query("st05_latency_firing", f"""
WITH lat AS ({_p95_sql()}), g AS (SELECT *, window_start + INTERVAL 5 MINUTE AS e FROM lat WHERE p95_seconds > 2),
r AS (SELECT *, epoch_us(e) - ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY e) * 60000000 AS run FROM g)
SELECT event_type, MIN(e) AS pending_since, MIN(e) + INTERVAL 5 MINUTE AS firing_from, MAX(e) + INTERVAL 1 MINUTE AS resolved_at
FROM r GROUP BY event_type, run HAVING MAX(e) - MIN(e) >= INTERVAL 5 MINUTE""")
def st05_latency(spark, sf):
    """ST-05 on ST-02: a 95th percentile above 2 seconds for 5 minutes."""
    return _firing(spark, sf, O.latency_windows, ["event_type"], 300, 60)


@query("st05_hit_ratio_firing", _firing_sql(f"""SELECT 'cache' AS series, {_floor(600)} + INTERVAL 10 MINUTE AS e,
  COUNT_IF(event_type = 'view') * 100.0 / NULLIF(COUNT_IF(event_type = 'view') + COUNT_IF(event_type = 'click'), 0) < 70 AS alert FROM s GROUP BY 1, 2""",
    "series", 600, 600))
def st05_hit_ratio(spark, sf):
    """ST-05 on ST-03: a hit ratio below 70 % for 10 minutes."""
    return _firing(spark, sf, lambda s: O.hit_ratio_windows(s).withColumn("series", F.lit("cache")), ["series"], 600, 600)


@query("st05_resource_firing", _firing_sql(f"""SELECT 'host' AS host, {_floor(3600)} + INTERVAL 1 HOUR AS e,
  ARG_MAX(value, ts) FILTER (WHERE event_type = 'click') * 100.0 / NULLIF(ARG_MAX(value, ts) FILTER (WHERE event_type = 'view'), 0) > 80 AS alert
  FROM s GROUP BY 1, 2""", "host", 300, 3600))
def st05_resource(spark, sf):
    """ST-05 on ST-15: a used share above 80 % for 5 minutes, of all instances together (single ones are too sparse to run on)."""
    return _firing(spark, sf, lambda s: O.share_windows(s.withColumn("host", F.lit("host")), keys=("host",)), ["host"], 300, 3600)


ALERTS_SQL = f"""
WITH {SAMPLES}, {THRESH}
SELECT event_id, s.ts, s.metric, instance, value, CAST(lim AS DOUBLE) AS "limit", severity,
  title || ': ' || CAST(CAST(ROUND(CAST(value AS DECIMAL(18, 4)), 1) AS DECIMAL(18, 1)) AS VARCHAR) AS message
FROM s JOIN th ON s.metric = th.metric WHERE value > lim"""


@query("st07_threshold_alerts", ALERTS_SQL)
def st07(spark, sf):
    """ST-07 / J-16: one alert row per sample above its metric's limit (stateless, append)."""
    out = _stream(spark, sf, O.threshold_alerts, watermark=None, end_marker=False)
    return _ntz(out, "ts")


@query("st08_freshness_status", oround(f"""
WITH {SAMPLES}, k AS (SELECT event_type, MAX(ts) AS last_ts, ARG_MAX(value, ts) AS v, CAST(COUNT(*) AS BIGINT) AS n FROM s GROUP BY 1),
a AS (SELECT MAX(last_ts) AS as_of, MAX(v) FILTER (WHERE event_type = 'purchase') / 10 AS db, MAX(v) FILTER (WHERE event_type = 'view') AS cpu,
      MAX(v) FILTER (WHERE event_type = 'click') AS mem FROM k),
h AS (SELECT *, (epoch_us(as_of) - epoch_us(last_ts)) / 3.6e9 AS hours_since FROM k, a)
SELECT event_type, last_ts, n, hours_since, db AS db_seconds, cpu, mem AS memory, CASE WHEN hours_since > 48 THEN 'stale_data' WHEN db > 5 THEN 'db_slow'
  WHEN cpu > 80 OR mem > 85 THEN 'resource_high' ELSE 'healthy' END AS status FROM h""", ["hours_since", "db_seconds"], 9))
def st08(spark, sf):
    """ST-08 + F-23: latest sample time per series, hours since it, and the pipeline's status from it and from the latest
    database seconds, CPU and memory samples of the same stream."""
    from pyspark.sql import Window
    k = _stream(spark, sf, lambda s: O.latest_per_key(s, ["event_type"]), mode="complete")
    every = Window.partitionBy()  # five rows, one per series
    last = lambda event: F.max(F.when(F.col("event_type") == event, F.col("last_value"))).over(every)
    k = k.withColumns({"as_of": F.max("last_ts").over(every), "db_seconds": last("purchase") / 10, "cpu": last("view"), "memory": last("click")})
    hrs = (F.unix_micros("as_of") - F.unix_micros("last_ts")) / 3.6e9
    st = SCR.pipeline_status(hrs, F.col("db_seconds"), F.col("cpu"), F.col("memory"))
    return rounded(_ntz(k.select("event_type", "last_ts", "n", hrs.alias("hours_since"), "db_seconds", "cpu", "memory", st.alias("status")), "last_ts"), 9)


@query("st09_streaming_upsert", f"""
WITH {SAMPLES} SELECT event_type, date_trunc('minute', ts) AS minute, ARG_MAX(value, ts) AS value, MAX(ts) AS ts
FROM s GROUP BY 1, 2""")
def st09(spark, sf):
    """ST-09: ticks upserted per (series, minute), newest event time wins; one landed batch is
    an exact repeat and is removed with dropDuplicatesWithinWatermark before the upsert."""
    ev = Views(spark, sf).table("events")
    src = RUN.stage_events(ev, repeat_batch=1)
    table, ck = FS.scratch(spark, "ticks"), FS.scratch(spark, "ticks-ckpt")

    def upsert_batch(batch, epoch):
        # an upsert leaves the same rows when an epoch is repeated; files of days without ticks in the batch stay
        FS.upsert_partitions(spark, table, batch, "day", ("event_type", "minute"))

    def start(folder):
        s = O.as_samples(RUN.read_stream(spark, folder)).withWatermark("ts", "10 minutes").dropDuplicatesWithinWatermark(["event_id"])
        s = s.select("event_type", F.date_trunc("minute", "ts").alias("minute"), "value", F.col("ts").alias("loaded_at"), F.to_date("ts").alias("day"))
        return s.writeStream.outputMode("append").foreachBatch(upsert_batch).option("checkpointLocation", ck).trigger(availableNow=True).start()

    RUN.drive(spark, src, start)
    return _ntz(spark.read.parquet(table).select("event_type", "minute", "value", F.col("loaded_at").alias("ts")), "minute", "ts")


@query("st10_hourly_bars", f"""
WITH {SAMPLES} SELECT date_trunc('hour', ts) AS bucket, event_type AS symbol, ARG_MIN(value, ts) AS open, MAX(value) AS high,
  MIN(value) AS low, ARG_MAX(value, ts) AS close, CAST(COUNT(*) AS BIGINT) AS n,
  CAST(SUM(CAST(value AS DECIMAL(38, 6))) AS DOUBLE) AS total FROM s GROUP BY 1, 2""")
def st10(spark, sf):
    """ST-10: hourly OHLC bars per series from the tick stream (tumbling window)."""
    return _ntz(_stream(spark, sf, O.ohlc_bars), "bucket")


@query("st10_late_rows", """
SELECT (SELECT COUNT(*) FROM events) AS kept, (SELECT COUNT(*) FROM events WHERE ts < (SELECT MIN(ts) FROM events) + INTERVAL 6 HOUR) AS dropped""")
def st10_late(spark, sf):
    """ST-10: the bars of a stream in which rows of its first six hours come again, under new ids, after its end: the bars hold
    every row but those, and the dropped rows are counted.  De-duplication turns them away one by one before the partial
    aggregate could merge them."""
    ev = Views(spark, sf).table("events")
    lo = ev.agg(F.min("ts").alias("lo"))  # one row
    late = ev.join(F.broadcast(lo)).where(F.col("ts") < F.col("lo") + F.expr("INTERVAL 6 HOURS")).drop("lo").withColumn("event_id", F.col("event_id") + 10**9)
    src, out, ck = RUN.stage_events(ev, late_rows=late, end_marker=True), FS.scratch(spark, "late-out"), FS.scratch(spark, "late-ckpt")

    def start(folder):
        s = O.as_samples(RUN.read_stream(spark, folder)).withWatermark("ts", "10 minutes").dropDuplicatesWithinWatermark(["event_id"])
        return O.ohlc_bars(s).writeStream.outputMode("append").foreachBatch(lambda b, epoch: b.write.mode("overwrite").parquet(f"{out}/{epoch:09d}")) \
            .option("checkpointLocation", ck).trigger(availableNow=True).start()
    dropped = RUN.late_rows(RUN.drive(spark, src, start))
    bars = spark.read.parquet(*[f"{out}/{e}" for e in RUN.folders(spark, out)])
    return bars.agg(F.sum("n").alias("kept"), F.lit(dropped).cast("bigint").alias("dropped"))


@query("st11_alert_notifications", f"""
WITH RECURSIVE {SAMPLES}, {THRESH},
a AS (SELECT s.metric, s.ts, LAG(s.ts) OVER (PARTITION BY s.metric ORDER BY s.ts) AS pts FROM s JOIN th ON s.metric = th.metric WHERE value > lim),
g AS (SELECT *, SUM(CASE WHEN pts IS NULL OR ts >= pts + INTERVAL 10 SECOND THEN 1 ELSE 0 END)
        OVER (PARTITION BY metric ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM a),
b AS (SELECT metric, k, MIN(ts) AS group_start, MAX(ts) + INTERVAL 10 SECOND AS sent_at, COUNT(*) AS alerts FROM g GROUP BY metric, k),
c AS (SELECT *, SUM(alerts) OVER (PARTITION BY metric ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM b),
sent AS (SELECT metric, k, group_start, sent_at, alerts, upto, alerts AS since FROM c WHERE k = 1
  UNION ALL SELECT metric, k, group_start, sent_at, alerts, upto, since FROM (
    SELECT c.metric, c.k, c.group_start, c.sent_at, c.alerts, c.upto, c.upto - sent.upto AS since, ROW_NUMBER() OVER (PARTITION BY c.metric ORDER BY c.k) AS n
    FROM sent JOIN c ON c.metric = sent.metric AND c.k > sent.k AND c.sent_at >= sent.sent_at + INTERVAL 1 HOUR) WHERE n = 1)
SELECT metric, group_start, sent_at, CAST(alerts AS BIGINT) AS alerts, CAST(since AS BIGINT) AS alerts_since_last FROM sent""")
def st11(spark, sf):
    """ST-11: alerts of a name less than 10 seconds apart are one group; a group is notified when it ends, at most once an hour per
    name, with the number of alerts since the last notification."""
    out = _stream(spark, sf, lambda s: ST.notifications(O.alert_flags(s)), timers=True)
    return _ntz(out, "group_start", "sent_at")


BUCKET_COLS = ", ".join(f"CAST(COUNT_IF(value / 10 <= {e}) AS BIGINT) AS le_{str(e).replace('.', '_')}"
                        for e in EDGES)


@query("st12_labelled_histograms", oround(f"""
WITH {SAMPLES} SELECT event_type, label, {BUCKET_COLS}, CAST(COUNT(*) AS BIGINT) AS total, SUM(value / 10) AS sum FROM s GROUP BY 1, 2""",
    ["sum"], 6))
def st12(spark, sf):
    """ST-12: counters and cumulative fixed-bucket histograms per series and label."""
    out = _stream(spark, sf, lambda s: O.bucket_counts(s, ["event_type", "label"]), mode="complete")
    return rounded(out, 6)


@query("st13_last_hour_view", f"""
WITH {SAMPLES} SELECT event_id, ts, metric, value FROM s WHERE ts >= (SELECT MAX(ts) FROM s) - INTERVAL 1 HOUR""")
def st13(spark, sf):
    """ST-13: samples of the last hour before the as-of time (the newest sample)."""
    ev = Views(spark, sf).table("events")
    as_of = ev.agg(F.max("ts")).first()[0]
    lo = F.lit(as_of).cast("timestamp") - F.expr("INTERVAL 1 HOUR")
    out = _stream(spark, sf, lambda s: s.filter(F.col("ts") >= lo).select("event_id", "ts", "metric", "value"),
                  watermark=None, end_marker=False)
    return _ntz(out, "ts")


@query("st14_instance_average", oround(f"""
WITH {SAMPLES} SELECT {_floor(300)} AS window_start, instance, AVG(value) AS avg_value, CAST(COUNT(*) AS BIGINT) AS n
FROM s GROUP BY 1, 2""", ["avg_value"], 9))
def st14(spark, sf):
    return rounded(_ntz(_stream(spark, sf, O.instance_average), "window_start"), 9)


@query("st15_resource_share", oround(f"""
WITH {SAMPLES}, g AS (SELECT {_floor(3600)} AS window_start, instance,
  ARG_MAX(value, ts) FILTER (WHERE event_type = 'click') AS used, ARG_MAX(value, ts) FILTER (WHERE event_type = 'view') AS capacity
  FROM s GROUP BY 1, 2)
SELECT window_start, instance, used, capacity, used * 100.0 / NULLIF(capacity, 0) AS used_pct,
       used * 100.0 / NULLIF(capacity, 0) > 80 AS alert FROM g""", ["used_pct"], 9))
def st15(spark, sf):
    """ST-15: share of a resource used against its capacity, per hour and instance."""
    return rounded(_ntz(_stream(spark, sf, O.resource_share), "window_start"), 9)


# ---- batch monitoring rules -----------------------------------------------------------------

@query("j16_threshold_join", ALERTS_SQL)
def j16(spark, sf):
    """J-16: batch twin of ST-07 -- samples joined with the threshold table on name and value > limit."""
    s = O.as_samples(Views(spark, sf).table("events"))
    return _ntz(O.threshold_alerts(s), "ts")


@query("f26_health_bands", f"""
WITH {SAMPLES}, l AS (SELECT instance, ARG_MAX(value, ts) FILTER (WHERE metric = 'cpu_usage') AS cpu,
  ARG_MAX(value, ts) FILTER (WHERE metric = 'memory_usage') AS memory,
  ARG_MAX(value, ts) FILTER (WHERE metric = 'db_connection_time') / 100 AS db_seconds FROM s GROUP BY 1)
SELECT instance, cpu, memory, db_seconds,
  CASE WHEN cpu >= 90 THEN 'critical' WHEN cpu >= 70 THEN 'warning' WHEN cpu IS NOT NULL THEN 'healthy' END AS cpu_band,
  CASE WHEN memory >= 90 THEN 'critical' WHEN memory >= 70 THEN 'warning' WHEN memory IS NOT NULL THEN 'healthy' END AS memory_band,
  CASE WHEN db_seconds >= 3 THEN 'critical' WHEN db_seconds >= 1 THEN 'warning' WHEN db_seconds IS NOT NULL THEN 'healthy' END AS db_band
FROM l""")
def f26(spark, sf):
    """F-26 + A-29: latest health values per instance (max_by on event time) and their bands."""
    s = O.as_samples(Views(spark, sf).table("events"))

    def last(metric):
        return F.max_by(F.when(F.col("metric") == metric, F.col("value")), F.when(F.col("metric") == metric, F.col("ts")))
    l = s.groupBy("instance").agg(last("cpu_usage").alias("cpu"), last("memory_usage").alias("memory"),
                                  (last("db_connection_time") / 100).alias("db_seconds"))
    return l.select("instance", "cpu", "memory", "db_seconds", SCR.health_band("cpu", "cpu").alias("cpu_band"),
                    SCR.health_band("memory", "memory").alias("memory_band"), SCR.health_band("db_seconds", "db").alias("db_band"))


@query("a29_system_snapshot", f"""
WITH {SAMPLES}, {THRESH}, a AS (SELECT s.metric, s.ts, value FROM s JOIN th ON s.metric = th.metric WHERE value > lim)
SELECT metric, MAX(ts) AS last_ts, ARG_MAX(value, ts) AS last_value, CAST(COUNT(*) AS BIGINT) AS alerts FROM a GROUP BY 1""")
def a29(spark, sf):
    """A-29: latest state per monitored metric as one record: newest alert value and time, alert count."""
    a = O.threshold_alerts(O.as_samples(Views(spark, sf).table("events")))
    snap = a.groupBy("metric").agg(F.max_by(F.struct("ts", "value"), "ts").alias("last"),
                                   F.count("*").cast("bigint").alias("alerts"))
    return _ntz(snap.select("metric", F.col("last.ts").alias("last_ts"), F.col("last.value").alias("last_value"), "alerts"),
                "last_ts")


@query("a30_cache_totals", f"""
WITH {SAMPLES}, h AS (SELECT date_trunc('hour', ts) AS hour, CAST(COUNT_IF(event_type = 'view') AS BIGINT) AS hits,
  CAST(COUNT_IF(event_type = 'click') AS BIGINT) AS misses FROM s GROUP BY 1)
SELECT hour, hits, misses, CAST(SUM(hits) OVER w AS BIGINT) AS total_hits, CAST(SUM(misses) OVER w AS BIGINT) AS total_misses
FROM h WINDOW w AS (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def a30(spark, sf):
    """A-30: hit and miss counts per hour and their running totals (differences added once,
    not cumulative totals re-added each cycle)."""
    from pyspark.sql import Window
    s = O.as_samples(Views(spark, sf).table("events"))
    h = s.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count_if(F.col("event_type") == "view").cast("bigint").alias("hits"),
        F.count_if(F.col("event_type") == "click").cast("bigint").alias("misses"))
    # one row per hour: the running window is over the hourly calendar
    w = Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    return _ntz(h.select("hour", "hits", "misses", F.sum("hits").over(w).cast("bigint").alias("total_hits"),
                         F.sum("misses").over(w).cast("bigint").alias("total_misses")), "hour")


@query("t06_recent_alerts", f"""
WITH {SAMPLES}, {THRESH}, a AS (SELECT event_id, s.ts, s.metric, value FROM s JOIN th ON s.metric = th.metric WHERE value > lim)
SELECT * FROM a WHERE ts >= (SELECT MAX(ts) FROM s) - INTERVAL 24 HOUR ORDER BY ts DESC, event_id LIMIT 100""")
def t06(spark, sf):
    """T-06: alerts of the last 24 hours before the as-of time, the 100 most recent (the limit is the feature)."""
    ev = Views(spark, sf).table("events")
    s = O.as_samples(ev)
    as_of = ev.agg(F.max("ts")).first()[0]
    a = O.threshold_alerts(s).filter(F.col("ts") >= F.lit(as_of).cast("timestamp") - F.expr("INTERVAL 24 HOURS"))
    return _ntz(a.orderBy(F.desc("ts"), "event_id").limit(100).select("event_id", "ts", "metric", "value"), "ts")


@query("s26_export_alerts_json", ALERTS_SQL)
def s26(spark, sf):
    """S-26: alert history exported as JSON records and read back."""
    a = _ntz(O.threshold_alerts(O.as_samples(Views(spark, sf).table("events"))), "ts")
    return FS.json_roundtrip(a, FS.scratch(spark, "alerts-export"))
