"""Rules with state per series (ST-04, ST-05 / ST-16, ST-06, ST-11) on ``transformWithState`` and event-time timers.

Series are dealt to buckets by a hash of their keys, and a bucket is the key of the state: a call of the state store costs far
more than a row, so calls are made per bucket and part of its rows, not per series and row.  Rows wait in map state, in parts
that are sorted by (ts, event_id), until the watermark has passed them; a timer then merges the parts, so a rule sees each
series in event-time order however its rows are spread over files, micro-batches and Arrow batches, and a task holds the parts
that overlap at one time, never a bucket's whole interval.  A rule may also name a deadline: a timer calls it when event time
gets there without input (silences, closed bursts, ended runs).  What a rule keeps of a series is a handful of scalars.

The rules themselves are plain classes over (state, time in microseconds, value), tested without a stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SECOND = 1_000_000  # microseconds
BUCKETS = 512  # of series: keys of the state
PART = 1024  # rows of a waiting part
RUN = 1 << 16  # rows that are sorted at a time, about
FRAME = 10_000  # rows of an output frame, about
NO_TIME, NO_ID = -(1 << 63), (1 << 63) - 1  # nulls: times first, ids last
SERIES = ("event_type", "instance")
PACKED = {"at": "BINARY", "id": "BINARY", "names": "STRING", "series": "BINARY", "value": "BINARY"}  # a part
_PARTS = pa.schema([("bucket", pa.int32()), *((c, pa.string() if kind == "STRING" else pa.binary()) for c, kind in PACKED.items())])
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITIONS = "spark.sql.shuffle.partitions"
LEAST_PARTITIONS = 8  # executors that have not registered yet do not count among the cores


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Timers and map state need the RocksDB provider; a query keeps the one that it was started with.

    It also keeps its number of state partitions.  A task of a rule costs about half a second in every micro-batch, rows or not
    (Python worker, state store, commit), and memory goes by buckets, so more partitions than cores only add such tasks."""
    cores = max(spark.sparkContext.defaultParallelism, LEAST_PARTITIONS)
    now = {PROVIDER: ROCKSDB, PARTITIONS: str(min(int(spark.conf.get(PARTITIONS)), cores))}
    before = {k: spark.conf.get(k, None) for k in now}
    for k, v in now.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Rule:
    """state: DDL of what is kept (or None); output: DDL of a row without the key.  Times are microseconds."""

    state: str
    output: str
    times: tuple[str, ...]  # output columns that are timestamps

    def step(self, state: tuple | None, ts: int, value: float | None) -> tuple[tuple | None, list[tuple]]:
        """The next sample of the series."""
        raise NotImplementedError

    def samples(self, state: dict[int, tuple | None], at: np.ndarray, series: np.ndarray, value: np.ndarray) -> list[tuple]:
        """The next samples of several series (by number; NaN for no value), in order; rows begin with the number of the series."""
        out = []
        for ts, k, v in zip(at.tolist(), series.tolist(), value.tolist()):
            state[k], new = self.step(state.get(k), ts, None if v != v else v)
            out += [(k, *r) for r in new]
        return out

    def passed(self, state: tuple | None, until: int) -> tuple[tuple | None, list[tuple]]:
        """Event time has come to ``until``; every earlier sample has been seen."""
        return state, []

    def deadline(self, state: tuple | None) -> int | None:
        """When ``passed`` has something to say if no sample comes."""
        return None


class InstantRate(Rule):
    """ST-04: rate from the last two samples; a drop is a counter reset, so the new value itself is the increase."""

    state, output, times = "ts BIGINT, value DOUBLE", "ts TIMESTAMP, value DOUBLE, irate DOUBLE", ("ts",)

    def step(self, state, ts, value):
        rate = None
        if state is not None and ts > state[0] and value is not None and state[1] is not None:
            rate = ((value - state[1]) if value >= state[1] else value) / ((ts - state[0]) / SECOND)
        return (ts, value), [(ts, value, rate)]


class Held(Rule):
    """ST-05 / ST-16: samples at which ``value > limit`` has held, sample after sample, for at least ``hold`` seconds."""

    state, output, times = "run_start BIGINT", "ts TIMESTAMP, value DOUBLE, run_start TIMESTAMP", ("ts", "run_start")

    def __init__(self, limit: float, hold: float):
        self.limit, self.hold = limit, int(hold * SECOND)

    def step(self, state, ts, value):
        if value is None or not value > self.limit:
            return None, []
        start = ts if state is None else state[0]
        return (start,), [(ts, value, start)] if ts - start >= self.hold else []


class Silence(Rule):
    """ST-06: a series without a sample for ``gap`` seconds is down from then on, and up again with its next sample."""

    state, output, times = "last BIGINT, down BOOLEAN", "status STRING, silent_since TIMESTAMP, at TIMESTAMP", ("silent_since", "at")

    def __init__(self, gap: float):
        self.gap = int(gap * SECOND)

    def step(self, state, ts, value):
        state, rows = self.passed(state, ts)
        return (ts, False), rows + ([("up", state[0], ts)] if state is not None and state[1] else [])

    def passed(self, state, until):
        if state is None or state[1] or until < state[0] + self.gap:
            return state, []
        return (state[0], True), [("down", state[0], state[0] + self.gap)]

    def deadline(self, state):
        return None if state is None or state[1] else state[0] + self.gap


class Notify(Rule):
    """ST-11: alerts of one name less than ``wait`` seconds apart are one group, which ends that long after its last alert; a
    group that ends is notified unless a notification went out less than ``repeat`` seconds before.  The next one counts what
    was kept back."""

    state = "first BIGINT, last BIGINT, n BIGINT, sent BIGINT, pending BIGINT"
    output, times = "group_start TIMESTAMP, sent_at TIMESTAMP, alerts BIGINT, alerts_since_last BIGINT", ("group_start", "sent_at")

    def __init__(self, wait: float, repeat: float):
        self.wait, self.repeat = int(wait * SECOND), int(repeat * SECOND)

    def step(self, state, ts, value):
        state, rows = self.passed(state, ts)
        if not value:  # a sample that is no alert
            return state, rows
        first, _, n, sent, pending = state or (None, None, 0, None, 0)
        return (ts if first is None else first, ts, n + 1, sent, pending), rows

    def passed(self, state, until):
        if state is None or state[0] is None or until < state[1] + self.wait:
            return state, []
        first, last, n, sent, pending = state
        end, pending = last + self.wait, pending + n
        if sent is not None and end - sent < self.repeat:
            return (None, None, 0, sent, pending), []
        return (None, None, 0, end, 0), [(first, end, n, pending)]

    def deadline(self, state):
        return None if state is None or state[0] is None else state[1] + self.wait


class Firing(Rule):
    """ST-05 behind a windowed aggregate: windows arrive by their end, value 1 where the condition is met.  Windows that
    follow each other by ``slide`` are one run; a run that lasted ``hold`` seconds is one row when it ends."""

    state, times = "first BIGINT, last BIGINT", ("pending_since", "firing_from", "resolved_at")
    output = "pending_since TIMESTAMP, firing_from TIMESTAMP, resolved_at TIMESTAMP"

    def __init__(self, hold: float, slide: float):
        self.hold, self.slide = int(hold * SECOND), int(slide * SECOND)

    def _closed(self, state):
        first, last = state
        return [(first, first + self.hold, last + self.slide)] if last - first >= self.hold else []

    def step(self, state, ts, value):
        met = value is not None and value > 0
        if state is not None and met and ts == state[1] + self.slide:
            return (state[0], ts), []
        return (ts, ts) if met else None, self._closed(state) if state is not None else []

    def samples(self, state, at, series, value):
        """As step by step, a run at a time: few series have very many windows each."""
        out, by = [], np.argsort(series, kind="stable")
        at, series, met = at[by], series[by], value[by] > 0
        borders = np.flatnonzero(series[1:] != series[:-1]) + 1
        for lo, hi in zip([0, *borders.tolist()], [*borders.tolist(), len(at)]):
            k = int(series[lo])
            t, m, before = at[lo:hi], met[lo:hi], state.get(k)
            if before is not None:  # the open run goes on from its last window
                t, m = np.append(before[1], t), np.append(True, m)
            follows = m[1:] & m[:-1] & (t[1:] == t[:-1] + self.slide)
            runs = list(zip(t[m & ~np.append(False, follows)].tolist(), t[m & ~np.append(follows, False)].tolist()))
            if before is not None:
                runs[0] = before[0], runs[0][1]
            state[k] = runs.pop() if m[-1] else None
            out += [(k, *row) for run in runs for row in self._closed(run)]
        return out

    def passed(self, state, until):
        if state is None or until <= state[1] + self.slide:  # a window that ends at ``until`` may still come
            return state, []
        return None, self._closed(state)

    def deadline(self, state):
        return None if state is None else state[1] + self.slide + 1


def _timer(micros: int) -> int:
    """The first millisecond after micros."""
    return micros // 1000 + 1


def _packed(at: np.ndarray, event: np.ndarray, series: np.ndarray, value: np.ndarray) -> tuple:
    """Rows as bytes (names of their series by lines, no value as NaN): the state store takes arrays element by element."""
    place, names = pd.factorize(series)
    return at.tobytes(), event.tobytes(), "\n".join(names), place.astype("int32").tobytes(), value.tobytes()


def _unpacked(at, event, names, place, value) -> tuple:
    at, event, place, value = (np.frombuffer(x, kind) for x, kind in ((at, "int64"), (event, "int64"), (place, "int32"), (value, "float64")))
    return at, event, np.array(names.split("\n"), object)[place], value


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, series, at, id, value) of a task by parts of buckets: the way to a rule costs the more the more rows there are."""
    for batch in batches:
        f = batch.to_pandas()
        rows = [(bucket, *_packed(*(g[c].to_numpy() for c in ("at", "id", "series", "value"))))
                for bucket, whole in f.groupby("bucket") for g in (whole[i:i + PART] for i in range(0, len(whole), PART))]
        yield pa.RecordBatch.from_pylist([dict(zip(("bucket", *PACKED), r)) for r in rows], _PARTS)


class InOrder(StatefulProcessor):
    """Runs a rule over the series of a bucket, each in event-time order."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self.columns = ["series", *(c.split()[0] for c in rule.output.split(", "))]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kept = ", ".join(f"_{name} ARRAY<{kind}>" for name, kind in (c.split() for c in self.rule.state.split(", ")))
        self.parts = handle.getValueState("parts", "part ARRAY<BIGINT>, lo ARRAY<BIGINT>, next BIGINT, timer BIGINT")
        self.waiting = handle.getMapState("waiting", "part BIGINT", ", ".join(f"{c} {kind}" for c, kind in PACKED.items()))
        self.kept = handle.getValueState("kept", f"series ARRAY<STRING>, {kept}")

    def handleInputRows(self, key, rows, timerValues):
        parts, after, timer = self._parts()
        held = []
        for f in rows:  # Arrow batches are short and each may reach over the whole interval: parts of several overlap less
            if "names" in f.columns:
                held += [_unpacked(*r) for r in f[list(PACKED)].itertuples(index=False, name=None)]
            else:
                held.append((f["at"], f["id"], f["series"], f["value"]))
            size = sum(len(x[0]) for x in held)
            if size >= RUN:
                after = self._wait(held, parts, after)
                held = []
        after = self._wait(held, parts, after)
        first = min(parts.values(), default=None)
        if timer is not None and (first is None or timer <= _timer(first)):
            self.parts.update((list(parts), list(parts.values()), after, timer))
        else:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self._save(parts, after, first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        border = timerValues.getCurrentWatermarkInMs() * 1000
        parts, after, _ = self._parts()
        names, out, rest = {}, [], []
        state = {names.setdefault(series, len(names)): s for series, s in self._kept().items()}
        for at, event, series, value in self._ordered(sorted((lo, part) for part, lo in parts.items() if lo < border), names):
            n = int(np.searchsorted(at, border))
            if n < len(at):
                rest.append((at[n:], event[n:], np.array(list(names), object)[series[n:]], value[n:]))
            if n:
                out += self.rule.samples(state, at[:n], series[:n], value[:n])
            if len(out) >= FRAME:
                yield from self._frames(out, names)
                out = []
        deadline = None
        for k, s in state.items():
            state[k], new = self.rule.passed(s, border)
            out += [(k, *r) for r in new]
            end = self.rule.deadline(state[k])
            deadline = end if deadline is None or end is not None and end < deadline else deadline
        yield from self._frames(out, names)
        state = {series: state[k] for series, k in names.items() if state.get(k) is not None}
        if state:
            self.kept.update((list(state), *map(list, zip(*state.values()))))
        else:
            self.kept.clear()
        parts = {part: lo for part, lo in parts.items() if lo >= border}
        after = self._wait(rest, parts, after)
        self._save(parts, after, min([*parts.values(), *([] if deadline is None else [deadline])], default=None))

    def _parts(self):
        """(lowest time of every waiting part by its number, the next number, the time of the bucket's timer)"""
        if not self.parts.exists():
            return {}, 0, None
        part, lo, after, timer = self.parts.get()
        return dict(zip(part, lo)), after, timer

    def _frames(self, out, names):
        """Frames of rows that begin with the number of their series."""
        names = list(names)
        for i in range(0, len(out), FRAME):
            yield pd.DataFrame([(names[k], *r) for k, *r in out[i:i + FRAME]], columns=self.columns)

    def _wait(self, held, parts, after):
        if not held:
            return after
        at, event, series, value = (np.concatenate([np.asarray(x[k], kind) for x in held]) for k, kind in enumerate(("int64", "int64", object, "float64")))
        rows = np.lexsort((event, at))
        for i in range(0, len(rows), PART):
            some = rows[i:i + PART]
            self.waiting.updateValue((after,), _packed(at[some], event[some], series[some], value[some]))
            parts[after] = int(at[some[0]])
            after += 1
        return after

    def _ordered(self, due, names):
        """Rows of the parts in order of (time, event, part, position), about RUN or twice the rows of the parts that overlap at a time,
        as arrays; a part is read, and leaves the state, when its first row is next.  names: the numbers of the series, which grow."""
        held, size, most = [], 0, RUN
        for lo, part in [*due, (None, None)]:
            if held and (part is None or size >= most):
                columns = [np.concatenate(x) for x in zip(*held)]
                by = np.lexsort((columns[4], columns[1], columns[0]))
                columns = [x[by] for x in columns]
                n = size if part is None else int(np.searchsorted(columns[0], lo))  # later parts have no earlier rows
                held, size = [tuple(x[n:] for x in columns)], size - n
                most = max(RUN, 2 * size)
                if n:
                    yield tuple(x[:n] for x in columns[:4])
            if part is not None:
                at, event, lines, place, value = self.waiting.getValue((part,))
                self.waiting.removeKey((part,))
                numbers = np.array([names.setdefault(x, len(names)) for x in lines.split("\n")], "int64")
                at, event, place, value = (np.frombuffer(x, kind) for x, kind in ((at, "int64"), (event, "int64"), (place, "int32"), (value, "float64")))
                held.append((at, event, numbers[place], value, np.full(len(at), part)))
                size += len(at)

    def _kept(self):
        if not self.kept.exists():
            return {}
        series, *columns = self.kept.get()
        return dict(zip(series, zip(*columns)))

    def _save(self, parts, after, first):
        """A bucket has one timer, for the first of its waiting rows and deadlines."""
        timer = None if first is None else _timer(first)
        if timer is not None:
            self.handle.registerTimer(timer)
        self.parts.update((list(parts), list(parts.values()), after, timer))

    def close(self) -> None:
        pass


def in_order(s: DataFrame, rule: Rule, keys, parts: bool = False) -> DataFrame:
    """rule over every series of s (ts with a watermark, event_id, value, keys): append mode, a row as soon as it is certain.

    parts: rows go to the rule by parts, not one by one.  Parts have no event time by which Spark could turn late rows away, so s must
    come from a step that has done so."""
    rows = s.select(F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket"), F.to_json(F.struct(*keys)).alias("series"), "ts",
                    F.coalesce(F.unix_micros("ts"), F.lit(NO_TIME)).alias("at"), F.coalesce("event_id", F.lit(NO_ID)).alias("id"), "value")
    schema = "series STRING, " + rule.output.replace("TIMESTAMP", "BIGINT")
    if parts:
        rows = rows.drop("ts").mapInArrow(_pack, ", ".join(f"{c} {kind}" for c, kind in ({"bucket": "INT"} | PACKED).items()))
    out = rows.groupBy("bucket").transformWithStateInPandas(InOrder(rule), schema, "append", "eventTime")
    kinds = ", ".join(f"{k} {s.schema[k].dataType.simpleString()}" for k in keys)
    time = lambda c: F.timestamp_micros(F.nullif(F.col(c), F.lit(NO_TIME)))
    values = [(time(c) if c in rule.times else F.col(c)).alias(c) for c in (x.split()[0] for x in rule.output.split(", "))]
    return out.withColumn("_k", F.from_json("series", kinds)).select(*(F.col("_k")[k].alias(k) for k in keys), *values)


def irate(s: DataFrame) -> DataFrame:
    return in_order(s, InstantRate(), SERIES)


def sustained(s: DataFrame, limit: float, hold_seconds: float) -> DataFrame:
    return in_order(s, Held(limit, hold_seconds), SERIES)


def silences(s: DataFrame, gap_seconds: float = 600.0) -> DataFrame:
    return in_order(s, Silence(gap_seconds), ("instance",))


def notifications(samples: DataFrame, wait_seconds: float = 10.0, repeat_seconds: float = 3600.0) -> DataFrame:
    """samples: metric, ts, event_id, value (1 for an alert, 0 for none, which need not be there)."""
    return in_order(samples, Notify(wait_seconds, repeat_seconds), ("metric",))


def firing(windows: DataFrame, keys, hold_seconds: float, slide_seconds: float) -> DataFrame:
    """ST-05 behind a windowed aggregate: windows has a window column ``w`` that still carries the watermark, keys, and alert."""
    ts = (F.window_time("w")).alias("ts")  # the window's end less a microsecond, with the watermark of the stream
    rows = windows.select(*keys, ts, F.lit(0).cast("bigint").alias("event_id"), F.coalesce(F.col("alert").cast("double"), F.lit(0.0)).alias("value"))
    return in_order(rows, Firing(hold_seconds, slide_seconds), keys, parts=True)  # the aggregate gives no window twice and none late
