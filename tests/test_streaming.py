"""Stream = batch: each streaming rule run with Trigger.AvailableNow over time-ordered files
equals its batch twin; exact repeats are removed and rows older than the watermark dropped."""

import datetime as dt

from pyspark.sql import functions as F

from small import SF_SMALL
from tickframe.sources.tables import table
from tickframe.streaming import ops as O
from tickframe.streaming import runner as R
from tickframe.streaming import stateful as ST


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_hourly_bars_stream_equals_batch(spark):
    ev = table(spark, SF_SMALL, "events")
    src = R.stage_events(ev, n_batches=3)
    got = R.run(spark, src, O.ohlc_bars, "complete")  # append mode is held against SQL
    exp = O.ohlc_bars(O.as_samples(ev))
    assert _rows(got) == _rows(exp)


def test_threshold_alerts_stream_equals_batch(spark):
    ev = table(spark, SF_SMALL, "events")
    src = R.stage_events(ev, n_batches=3)
    got = R.run(spark, src, O.threshold_alerts, "append", watermark=None)
    assert _rows(got) == _rows(O.threshold_alerts(O.as_samples(ev)))


def test_late_rows_dropped_and_repeats_removed(spark):
    ev = table(spark, SF_SMALL, "events")
    lo = ev.agg(F.min("ts")).first()[0]
    late = ev.filter(F.col("ts") < F.lit(lo + dt.timedelta(hours=6))).withColumn("event_id", F.col("event_id") + 10**9)
    src = R.stage_events(ev, n_batches=3, repeat_batch=1, late_rows=late)

    def build(s):
        return (s.dropDuplicatesWithinWatermark(["event_id"])
                 .groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n")))

    got = R.run(spark, src, build, "update", watermark="10 minutes")
    # every event counted once: the repeated batch is deduplicated and the late batch dropped
    total = got.groupBy("w").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0]
    assert total == ev.count()


def _irates(spark, ev, **stage):
    out = R.run(spark, R.stage_events(ev, end_marker=True, **stage), ST.irate, "append")
    return _rows(out.where(F.col("instance") != R.MARKER_INSTANCE))


def test_state_does_not_depend_on_intervals_or_arrow_batches(spark):
    """A series' rows may come out of order, in many Arrow batches and in one interval or several: the same rows come out."""
    ev = table(spark, SF_SMALL, "events").where("event_id % 5 = 0").withColumn("user_id", F.lit(1).cast("bigint")).orderBy("value")
    want = _irates(spark, ev, n_batches=1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = _irates(spark, ev, n_batches=6)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want and len(got) == ev.count()


def _ruled(rule, samples, until=None):
    state, out = None, []
    for ts, v in samples:
        state, rows = rule.step(state, ts * ST.SECOND, v)
        out += rows
    return out + (rule.passed(state, until * ST.SECOND)[1] if until is not None else [])


def _seconds(rows):
    return [tuple(x // ST.SECOND if isinstance(x, int) and x >= ST.SECOND else x for x in r) for r in rows]


def test_rules_step_by_step():
    assert _seconds(_ruled(ST.InstantRate(), [(10, 5.0), (20, 9.0), (20, 1.0), (30, 0.5), (40, None), (50, 3.0)])) == \
        [(10, 5.0, None), (20, 9.0, 0.4), (20, 1.0, None), (30, 0.5, 0.05), (40, None, None), (50, 3.0, None)]
    assert _seconds(_ruled(ST.Held(1.0, 20), [(10, 2.0), (20, 2.0), (30, 2.0), (35, 2.0), (40, 1.0), (50, 2.0), (90, None), (95, 2.0)])) == \
        [(30, 2.0, 10), (35, 2.0, 10)]
    assert _seconds(_ruled(ST.Silence(60), [(10, 0.0), (69, 0.0), (129, 0.0)], 188)) == [("down", 69, 129), ("up", 69, 129)]
    assert _seconds(_ruled(ST.Silence(60), [(10, 0.0)], 70)) == [("down", 10, 70)] and _ruled(ST.Silence(60), [(10, 0.0)], 69) == []
    sent = _seconds(_ruled(ST.Notify(10, 100), [(1, 1.0), (5, 1.0), (14, 1.0), (15, 0.0), (30, 1.0), (60, 1.0), (125, 1.0)], 200))
    assert sent == [(1, 24, 3, 3), (125, 135, 1, 3)]
    firing = [(60, 1.0), (120, 1.0), (180, 1.0), (240, 0.0), (300, 1.0), (360, 1.0), (480, 1.0), (540, 1.0), (600, 1.0)]
    assert _seconds(_ruled(ST.Firing(120, 60), firing, 661)) == [(60, 180, 240), (480, 600, 660)]
    assert _seconds(_ruled(ST.Firing(120, 60), firing, 660)) == [(60, 180, 240)]


def test_provider_is_given_back(spark):
    before = spark.conf.get(ST.PROVIDER)
    with ST.rocksdb(spark):
        assert spark.conf.get(ST.PROVIDER) == ST.ROCKSDB
    assert spark.conf.get(ST.PROVIDER) == before


def test_many_small_files_lose_nothing(spark):
    ev = table(spark, SF_SMALL, "events").repartition(40)
    got = R.run(spark, R.stage_events(ev, n_batches=4, end_marker=True), O.sessions, "append", "10 minutes")
    assert got.where(F.col("instance") != R.MARKER_INSTANCE).agg(F.sum("n")).first()[0] == ev.count()


def test_state_partitions_follow_cores(spark, monkeypatch):
    """A task of a rule has its costs in every micro-batch; a session's many shuffle partitions must not multiply them."""
    ev = spark.range(50).select(F.col("id").alias("event_id"), F.timestamp_seconds(1_700_000_000 + 60 * F.col("id")).cast("timestamp_ntz").alias("ts"), (F.col("id") % 5).alias("user_id"),
                                F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    seen, drive, before = [], R.drive, spark.conf.get(ST.PARTITIONS)
    monkeypatch.setattr(R, "drive", lambda *a: seen.extend(drive(*a)))
    try:
        for session, most in ((24, max(8, spark.sparkContext.defaultParallelism)), (3, 3)):
            spark.conf.set(ST.PARTITIONS, session)
            out = R.run(spark, R.stage_events(ev, n_batches=1, end_marker=True), ST.silences, "append", "10 minutes")
            assert out.where((F.col("status") == "down") & (F.col("instance") != R.MARKER_INSTANCE)).count() > 0
            assert {o.numShufflePartitions for p in seen for o in p.stateOperators} == {most}
            assert spark.conf.get(ST.PARTITIONS) == str(session)
            seen.clear()
    finally:
        spark.conf.set(ST.PARTITIONS, before)


def test_samples_that_are_no_alerts_stay_out_of_the_state_but_move_the_watermark(spark):
    """The last alert's group ends while all is well, without a heartbeat: only samples that are no alerts move the watermark past it."""
    second = lambda at: F.timestamp_seconds(1_700_000_000 + at).cast("timestamp_ntz")
    ev = spark.range(200).select(F.col("id").alias("event_id"), second(F.when(F.col("id") < 3, F.col("id")).otherwise(30 * F.col("id"))).alias("ts"), F.lit(1).cast("bigint").alias("user_id"),
                                 F.lit("view").alias("event_type"), F.when(F.col("id") < 3, 90.0).otherwise(1.0).alias("value"), F.lit("{}").alias("props"))
    timeless = ev.where("event_id = 5").withColumns({"event_id": F.lit(1000).cast("bigint"), "ts": F.lit(None).cast("timestamp_ntz"), "value": F.lit(95.0)})
    flags = O.alert_flags(O.as_samples(ev.unionByName(timeless)))
    assert sorted(r.event_id for r in flags.collect()) == [0, 1, 2, 1000]
    got = R.run(spark, R.stage_events(ev, n_batches=2), lambda s: ST.notifications(O.alert_flags(s)), "append")
    assert [(r.metric, r.alerts, r.alerts_since_last, (r.sent_at - r.group_start).total_seconds()) for r in got.collect()] == [("cpu_usage", 3, 3, 12.0)]
