"""Rows that must not be lost, changed or folded wrongly."""

import datetime as dt

import pytest

from tickframe.functions.ema import with_ema
from tickframe.plans.common import rounded
from tickframe.sources import files as FS


def test_landing_keeps_lines_that_do_not_fit(spark, tmp_path):
    folder = tmp_path / "data_source=v" / "symbol=A"
    folder.mkdir(parents=True)
    (folder / "x.csv").write_text("date,open,high,low,close,adjusted_close,volume\n2024-01-01,1,2,0,1,1,5\nnonsense,1,2,0,1,1,x\n")
    landed = FS.read_landing_csv(spark, str(tmp_path))
    assert [r.volume for r in FS.landing_rows(landed).collect()] == [5]
    assert [r.line for r in FS.landing_rejects(landed).collect()] == ["nonsense,1,2,0,1,1,x"]


def test_json_keeps_microseconds(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 2, 3, 4, 123456),)], "ts timestamp_ntz")
    assert FS.json_roundtrip(df, str(tmp_path / "j")).collect() == df.collect()


def test_rounding_keeps_large_values(spark):
    got = [r.v for r in rounded(spark.createDataFrame([(1.5e35,), (0.1234567,), (None,)], "v double"), 6).collect()]
    assert got == [1.5e35, 0.123457, None]


def test_change_feed(spark):
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 4)], "id int, name string, n int")
    feed = spark.createDataFrame([(1, "update", "x", None, 1), (1, "update", None, 9, 2), (2, "delete", None, None, 1), (3, "delete", None, None, 1),
                                  (3, "insert", "new", None, 2), (7, "update", "no", 1, 1), (8, "insert", "i", 8, 1), (8, "update", "j", None, 2),
                                  (9, "insert", "k", 1, 1), (9, "delete", None, None, 2)], "id int, op string, name string, n int, sequence int")
    got = sorted(tuple(r) for r in FS.apply_changes(cur, feed).collect())
    assert got == [(1, "x", 9), (3, "new", None), (4, "d", 4), (8, "j", 8)]


def test_ema_of_minute_rows_is_finite(spark):
    rows = [("A", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), float(i % 17)) for i in range(4000)]
    df = with_ema(spark.createDataFrame(rows, "symbol string, date timestamp, close double"), "close", 9, "e")
    num = den = 0.0
    got = {r.date: r.e for r in df.collect()}
    for _, t, v in rows:
        num, den = v + 0.8 * num, 1 + 0.8 * den
        assert got[t] == pytest.approx(num / den, rel=1e-9)


def test_dbscan_follows_long_chains(spark):
    from tickframe.operators.cluster import dbscan
    pts = spark.createDataFrame([(f"p{i:04d}", [0.4 * i, 0.0]) for i in range(150)], "symbol string, x array<double>")
    got = dbscan(pts).groupBy("cluster").count().collect()
    assert [(r.cluster, r["count"]) for r in got] == [(0, 150)]


def test_risk_budget_is_met(spark):
    import numpy as np
    from tickframe.functions.solvers import risk_parity
    rng = np.random.default_rng(3)
    a = rng.normal(size=(6, 6))
    S, b = a @ a.T + np.eye(6), np.array([0.4, 0.2, 0.1, 0.1, 0.1, 0.1])
    w, ok = risk_parity(S, b)
    share = w * (S @ w) / (w @ S @ w)
    assert ok and np.allclose(share, b, atol=1e-8) and abs(w.sum() - 1) < 1e-12
