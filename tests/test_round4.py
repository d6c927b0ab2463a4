"""Rules over buckets of series: order across parts, deadlines, calls of the state store."""

import json
import random

import numpy as np
import pandas as pd
import pyarrow as pa

from tickframe.streaming import stateful as ST


class _State:
    """Value or map state that counts its calls."""

    def __init__(self, calls):
        self.calls, self.rows = calls, {}

    def _count(self):
        self.calls.append(1)

    def exists(self):
        self._count()
        return None in self.rows

    def get(self):
        self._count()
        return self.rows.get(None)

    def update(self, value):
        self._count()
        self.rows[None] = value

    def clear(self):
        self._count()
        self.rows.clear()

    def getValue(self, key):
        self._count()
        return self.rows[key]

    def updateValue(self, key, value):
        self._count()
        self.rows[key] = value

    def removeKey(self, key):
        self._count()
        del self.rows[key]


class _Handle:
    def __init__(self):
        self.calls, self.timers = [], set()

    def getValueState(self, name, schema):
        return _State(self.calls)

    def getMapState(self, name, key, value):
        return _State(self.calls)

    def registerTimer(self, ms):
        self.calls.append(1)
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls.append(1)
        self.timers.remove(ms)


class _Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _drive(rule, intervals, frame_rows):
    """Rows (series, second, id, value) of each interval in frames of any order, then the timer at the interval's watermark second."""
    handle, out = _Handle(), []
    bucket = ST.InOrder(rule)
    bucket.init(handle)
    for rows, watermark in intervals:
        frames = [pd.DataFrame([(json.dumps(s), t * ST.SECOND, i, v) for s, t, i, v in rows[k:k + frame_rows]], columns=["series", "at", "id", "value"])
                  for k in range(0, len(rows), frame_rows)]
        assert not list(bucket.handleInputRows((0,), iter(frames), _Watermark(0)))
        assert len(handle.timers) <= 1
        for ms in [t for t in handle.timers if t <= watermark * 1000]:
            out += [r for f in bucket.handleExpiredTimer((0,), _Watermark(watermark * 1000), None) for r in f.itertuples(index=False, name=None)]
            handle.timers.remove(ms)
    return [(json.loads(s), *r) for s, *r in out], len(handle.calls), handle.timers


def _samples(n, series):
    r = random.Random(7)
    rows = [(r.randrange(series), t, i, float(r.randrange(100))) for i, t in enumerate(sorted(r.randrange(4000) for _ in range(n)))]
    return rows, [([*x], w) for x, w in ((rows[:n // 2], rows[n // 2][1] - 300), (rows[n // 2:], 3700), ([], 10_000))], r


def test_series_of_a_bucket_share_the_calls_of_the_state():
    """A waiting row or a series costs no call of its own, and the rows of each series come in order of time."""
    rows, intervals, r = _samples(3000, 700)
    for x, _ in intervals:
        r.shuffle(x)
    got, calls, timers = _drive(ST.InstantRate(), intervals, 500)
    want, last = [], {}
    for s, t, _, v in rows:
        rate = None
        if s in last and t > last[s][0]:
            rate = (v - last[s][1] if v >= last[s][1] else v) / (t - last[s][0])
        want.append((s, t * ST.SECOND, v, rate))
        last[s] = t, v
    plain = lambda x: sorted((s, t, v, -1.0 if q is None or q != q else q) for s, t, v, q in x)
    assert plain(got) == plain(want) and calls < 100 and not timers


def test_parts_of_many_rows_are_merged():
    """One series in more rows than a part holds, dealt to the frames at random."""
    rows = [(0, t, t, float(t)) for t in range(5 * ST.PART)]
    mixed = list(rows)
    random.Random(3).shuffle(mixed)
    got, _, _ = _drive(ST.InstantRate(), [(mixed, 3000), ([], 10_000)], 2 * ST.PART)
    assert [(s, t // ST.SECOND) for s, t, _, _ in got] == [(0, t) for t in range(5 * ST.PART)]
    assert [r for *_, r in got[1:]] == [1.0] * (5 * ST.PART - 1)


def test_deadlines_of_a_bucket_come_without_input():
    """The series whose deadline is first sets the timer; the others' deadlines follow."""
    rule = ST.Silence(60)
    got, _, timers = _drive(rule, [([("a", 10, 0, 0.0), ("b", 100, 1, 0.0)], 80), ([], 120), ([("a", 130, 2, 0.0)], 170), ([], 300)], 10)
    s = ST.SECOND
    assert sorted(got) == [("a", "down", 10 * s, 70 * s), ("a", "down", 130 * s, 190 * s), ("a", "up", 10 * s, 130 * s), ("b", "down", 100 * s, 160 * s)]
    assert not timers


def test_windows_of_a_series_are_taken_by_runs():
    """A series of very many windows: the rule goes by runs, not by windows, and says what it says step by step."""
    r = random.Random(11)
    rule, n = ST.Firing(120, 60), 20_000
    rows = [(s, 60 * t, 0, float(r.random() < 0.8)) for s in range(2) for t in range(n) if r.random() < 0.95]
    want = []
    for s in range(2):
        state = None
        for _, t, _, v in (x for x in rows if x[0] == s):
            state, new = rule.step(state, t * ST.SECOND, v)
            want += [(s, *x) for x in new]
        want += [(s, *x) for x in rule.passed(state, 10**18)[1]]
    mixed = list(rows)
    r.shuffle(mixed)
    half = [x for x in mixed if x[1] < 30 * n], [x for x in mixed if x[1] >= 30 * n]

    def one_by_one(*_):
        raise AssertionError("a window at a time")
    rule.step = one_by_one
    got, _, timers = _drive(rule, [(half[0], 20 * n), (half[1], 50 * n), ([], 70 * n)], 3000)
    assert sorted(got) == sorted(want) and len(want) > 1000 and not timers
    assert rule.samples({}, *(np.array(x, kind) for x, kind in (([60, 120], "int64"), ([0, 0], "int64"), ([float("nan"), 0.0], "float64")))) == []


def test_windows_go_to_the_rule_by_parts():
    """Rows of a task are packed by bucket; a rule says the same of parts as of rows."""
    rows, intervals, r = _samples(5000, 3)
    handle, out = _Handle(), []
    rule = ST.InOrder(ST.InstantRate())
    rule.init(handle)
    for some, watermark in intervals:
        r.shuffle(some)
        batch = pa.RecordBatch.from_pylist([{"bucket": 0, "series": json.dumps(s), "at": t * ST.SECOND, "id": i, "value": v} for s, t, i, v in some])
        parts = [x for b in ST._pack([batch] if some else []) for x in b.to_pylist()]
        assert len(parts) == -(-len(some) // ST.PART)
        list(rule.handleInputRows((0,), iter([pd.DataFrame(parts)] if parts else []), _Watermark(0)))
        for ms in [t for t in handle.timers if t <= watermark * 1000]:
            out += [x for f in rule.handleExpiredTimer((0,), _Watermark(watermark * 1000), None) for x in f.itertuples(index=False, name=None)]
            handle.timers.remove(ms)
    plain = lambda x: sorted((s, t, v, -1.0 if q is None or q != q else q) for s, t, v, q in x)
    assert plain((json.loads(s), *x) for s, *x in out) == plain(_drive(ST.InstantRate(), intervals, 500)[0]) and len(out) == 5000
