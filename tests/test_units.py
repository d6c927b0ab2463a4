"""Formula and invariant tests on hand-made frames (pandas / numpy as the second opinion)."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

D0 = dt.date(2024, 1, 1)


def series(spark, values, symbol="A", col="r", start=D0):
    rows = [(symbol, start + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"symbol STRING, date DATE, {col} DOUBLE")


def test_var_cvar_drawdown_hand_computed(spark):
    from tickframe.operators.risk import series_metrics
    r = [0.01, -0.02, 0.03, -0.01, 0.005]
    m = series_metrics(series(spark, r), ["symbol"], levels=(0.05,)).first()
    assert m["var_95"] == pytest.approx(np.percentile(r, 5))
    assert m["cvar_95"] == pytest.approx(np.mean([x for x in r if x <= np.percentile(r, 5)]))
    g = np.cumprod(1 + np.array(r))
    assert m["max_drawdown"] == pytest.approx(((g - np.maximum.accumulate(g)) / np.maximum.accumulate(g)).min())
    assert m["cvar_95"] <= m["var_95"] and m["max_drawdown"] <= 0


def test_constant_series_gives_null_ratios(spark):
    from tickframe.operators.risk import series_metrics
    m = series_metrics(series(spark, [0.01] * 6), ["symbol"], levels=(0.05,)).first()
    assert m["sharpe_ratio"] is None and m["volatility"] == pytest.approx(0.0)


def test_empty_and_single_row(spark):
    from tickframe.operators.risk import series_metrics
    assert series_metrics(series(spark, []), ["symbol"]).count() == 0
    one = series_metrics(series(spark, [0.02]), ["symbol"]).first()
    assert one["sharpe_ratio"] is None and one["var_95"] == pytest.approx(0.02)


def test_ema_matches_pandas_with_gaps(spark):
    from tickframe.functions.ema import with_ema
    rng = np.random.default_rng(3)
    x = list(np.cumsum(rng.normal(size=4000)) + 50)
    for i in (0, 7, 100, 3999):
        x[i] = None
    got = with_ema(series(spark, x, col="x"), "x", 9, "e").orderBy("date").toPandas()["e"].to_numpy()
    exp = pd.Series(x, dtype=float).ewm(span=9, adjust=True).mean().to_numpy()
    ok = ~np.isnan(exp)
    assert np.allclose(got[ok], exp[ok], rtol=1e-12)


def test_rsi_rising_falling(spark):
    from tickframe.operators.windows import with_rsi
    up = with_rsi(series(spark, list(range(1, 31)), col="close"), "close").orderBy("date").toPandas()["rsi"]
    down = with_rsi(series(spark, list(range(30, 0, -1)), col="close"), "close").orderBy("date").toPandas()["rsi"]
    assert up.iloc[:13].isna().all() and (up.iloc[13:] == 100).all()
    assert (down.iloc[13:] == 0).all()


def test_fill_and_interpolate(spark):
    from tickframe.operators.clean import fill
    df = series(spark, [None, 1.0, None, None, 4.0, None], col="v")
    ff = fill(df, ["v"], "forward_fill", zero_rest=False).orderBy("date").toPandas()["v"].tolist()
    it = fill(df, ["v"], "interpolate", zero_rest=False).orderBy("date").toPandas()["v"].tolist()
    assert ff[1:] == [1.0, 1.0, 1.0, 4.0, 4.0] and math.isnan(ff[0])
    assert it[1:] == [1.0, 2.0, 3.0, 4.0, 4.0] and math.isnan(it[0])


def test_weight_validation_rejects_bad_vectors(spark):
    from tickframe.operators.quality import weight_report
    df = spark.createDataFrame([("p1", ["A", "B"], [0.5, 0.4]), ("p2", ["A", "B", "C"], [0.5, 0.5, 0.1]),
                                ("p3", ["A", "B"], [0.5, 0.5])], "portfolio_name STRING, symbols ARRAY<STRING>, weights ARRAY<DOUBLE>")
    got = {r["portfolio_name"]: r["valid_service"] for r in weight_report(df).collect()}
    assert got == {"p1": False, "p2": False, "p3": True}


def test_cap_bucket_boundaries(spark):
    from tickframe.operators.screen import cap_category, cap_category_collector
    caps = [0.0, 3e8, 2e9, 1e10, 1e11, None]
    df = spark.createDataFrame([(c,) for c in caps], "market_cap DOUBLE")
    gen = [r[0] for r in df.select(cap_category("market_cap")).collect()]
    col = [r[0] for r in df.select(cap_category_collector("market_cap")).collect()]
    assert gen == ["Nano Cap ($10M+)", "Small Cap ($300M+)", "Mid Cap ($2B+)", "Large Cap ($10B+)", "Mega Cap ($100B+)",
                   "Nano Cap ($10M+)"]
    assert col == ["Unknown", "Small Cap", "Mid Cap", "Large Cap", "Large Cap", "Unknown"]


def test_upsert_keeps_newest_and_is_idempotent(spark):
    from tickframe.sources.files import upsert
    cur = spark.createDataFrame([("A", D0, 1.0, 1), ("A", D0 + dt.timedelta(1), 2.0, 1)],
                                "symbol STRING, date DATE, close DOUBLE, loaded_at INT")
    upd = spark.createDataFrame([("A", D0, 9.0, 2)], "symbol STRING, date DATE, close DOUBLE, loaded_at INT")
    once = upsert(cur, upd)
    twice = upsert(once, upd)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r["date"]: r["close"] for r in once.collect()} == {D0: 9.0, D0 + dt.timedelta(1): 2.0}


def test_gram_covariance_matches_pandas_pairwise(spark):
    from tickframe.operators.matrices import covariance
    rng = np.random.default_rng(5)
    wide = pd.DataFrame(rng.normal(size=(60, 7)), columns=list("ABCDEFG"))
    wide = wide.mask(rng.random(wide.shape) < 0.2)
    rows = [(s, D0 + dt.timedelta(days=int(i)), float(v)) for i, row in wide.iterrows() for s, v in row.items()
            if not np.isnan(v)]
    df = spark.createDataFrame(rows, "symbol STRING, date DATE, r DOUBLE")
    for tile in (256, 3):
        got = covariance(df, tile=tile).toPandas().set_index(["symbol_a", "symbol_b"])
        cov, cor = wide.cov(), wide.corr()
        for a in wide.columns:
            for b in wide.columns:
                assert got.loc[(a, b), "covariance"] == pytest.approx(cov.loc[a, b], rel=1e-9)
                assert got.loc[(a, b), "correlation"] == pytest.approx(cor.loc[a, b], rel=1e-9)


def test_linear_fits_match_numpy(spark):
    from tickframe.operators.models import fit, gram
    rng = np.random.default_rng(7)
    X = rng.normal(size=(200, 3))
    y = X @ np.array([0.5, -1.0, 2.0]) + 0.3 + rng.normal(scale=0.1, size=200)
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(target=y, symbol="S")
    df = spark.createDataFrame(pdf)
    for model in ("linear", "ridge"):
        c = fit(gram(df, ["a", "b", "c"], ["symbol"]), ["a", "b", "c"], ["symbol"], model).first()
        Xc, yc = X - X.mean(0), y - y.mean()
        w = np.linalg.solve(Xc.T @ Xc + (1.0 if model == "ridge" else 0.0) * np.eye(3), Xc.T @ yc)
        assert np.allclose(c["coef"], w, rtol=1e-9)
        assert c["intercept"] == pytest.approx(y.mean() - X.mean(0) @ w)


def test_solvers_invariants():
    from tickframe.functions.solvers import max_sharpe, min_variance, risk_parity
    rng = np.random.default_rng(0)
    A = rng.normal(size=(300, 6)) * 0.01 + 0.0005
    mu, S = A.mean(0), np.cov(A.T)
    w, ok = max_sharpe(S, mu, 0.0)
    R = rng.dirichlet(np.ones(6), 5000)
    best = ((R @ mu) / np.sqrt(np.einsum("ij,jk,ik->i", R, S, R))).max()
    assert ok and w.min() >= 0 and abs(w.sum() - 1) < 1e-12 and (mu @ w) / math.sqrt(w @ S @ w) >= best - 1e-12
    t = (mu.min() + mu.max()) / 2
    wt, okt = min_variance(S, mu, t)
    assert okt and abs(mu @ wt - t) < 1e-12 and wt.min() >= 0
    rp, okr = risk_parity(S)
    rc = rp * (S @ rp)
    assert okr and np.ptp(rc / rc.sum()) < 1e-8


def test_dbscan_two_tight_clusters_and_noise(spark):
    from pyspark.ml.functions import array_to_vector
    from tickframe.operators.cluster import dbscan
    pts = [("a", [0.0, 0.0]), ("b", [0.1, 0.0]), ("c", [0.0, 0.1]), ("d", [5.0, 5.0]), ("e", [5.1, 5.0]), ("f", [20.0, 0.0])]
    df = spark.createDataFrame(pts, "symbol STRING, x ARRAY<DOUBLE>").withColumn("features", array_to_vector("x"))
    got = {r["symbol"]: r["cluster"] for r in dbscan(df).collect()}
    assert got == {"a": 0, "b": 0, "c": 0, "d": 1, "e": 1, "f": -1}


def test_asof_join_takes_latest_earlier_value(spark):
    from tickframe.operators.joins import asof_join
    facts = spark.createDataFrame([("X", D0 + dt.timedelta(d)) for d in (0, 5, 40)], "symbol STRING, date DATE")
    macro = spark.createDataFrame([("GDP", D0 + dt.timedelta(1), 1.0), ("GDP", D0 + dt.timedelta(31), 2.0)],
                                  "series_id STRING, date DATE, value DOUBLE")
    got = {r["date"]: r["macro_gdp"] for r in asof_join(facts, macro).collect()}
    assert got == {D0: None, D0 + dt.timedelta(5): 1.0, D0 + dt.timedelta(40): 2.0}


def test_sparse_portfolio_returns_equal_dense_pandas(spark):
    """Two symbols on different calendars (one lists later): the sparse Spark portfolio
    series equals pandas pivot -> ffill -> bfill -> pct_change -> dropna -> weighted sum."""
    from tickframe.operators.portfolio import portfolio_analytics, portfolio_returns
    rng = np.random.default_rng(11)
    rows = []
    for sym, days in (("A", range(0, 60)), ("B", [d for d in range(10, 70) if d % 3])):
        px = 100.0
        for d in days:
            px *= 1 + rng.normal(0, 0.01)
            rows.append((sym, D0 + dt.timedelta(days=d), px))
    bars = spark.createDataFrame(rows, "symbol STRING, date DATE, close DOUBLE")
    hold = spark.createDataFrame([("P", 1, "A", 0.3), ("P", 2, "B", 0.7)],
                                 "portfolio_name STRING, pos INT, symbol STRING, weight DOUBLE")
    got = portfolio_returns(bars, hold).orderBy("date").toPandas().set_index("date")["r"]
    pdf = pd.DataFrame(rows, columns=["symbol", "date", "close"]).pivot(index="date", columns="symbol", values="close")
    rets = pdf.ffill().bfill().pct_change().dropna()
    exp = (rets * np.array([0.3, 0.7])).sum(axis=1)
    assert list(got.index) == list(exp.index)
    assert np.allclose(got.to_numpy(), exp.to_numpy(), rtol=1e-12, atol=1e-15)
    a = portfolio_analytics(bars, hold).first()
    assert a["total_return"] == pytest.approx((1 + exp).prod() - 1, rel=1e-12)
    assert a["var_95"] == pytest.approx(np.percentile(exp, 5), rel=1e-12)
    vols = rets.std() * np.sqrt(252)
    assert a["weighted_avg_volatility"] == pytest.approx(float((vols * np.array([0.3, 0.7])).sum()), rel=1e-9)
