"""Return-model queries M-01 .. M-14 (features, split and scaling have oracles; fitted
models are checked by invariants in tests)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.operators import models as MD
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, materialise, oround, rounded
from tickframe.plans.joins_q import ASOF_SQL, MCOLS
from tickframe.plans.views_sql import with_views
from tickframe.sources.files import scratch


def _w(n, off=0):
    return (f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1 + off} PRECEDING AND "
            f"{str(off) + ' PRECEDING' if off else 'CURRENT ROW'})")


def _mp(expr, col, n, off=0):
    return f"CASE WHEN COUNT({col}) OVER {_w(n, off)} = {n} THEN {expr} OVER {_w(n, off)} END"


FEAT = (["returns_lag_1", "returns_lag_5", "returns_lag_10", "returns_lag_20", "volatility_lag_5", "volatility_lag_10",
         "volatility_lag_20", "sma_5", "sma_20", "sma_50", "price_sma5_ratio", "price_sma20_ratio", "price_sma50_ratio",
         "volatility_5", "volatility_20", "rsi"] + sorted(MCOLS))

FEATURES_SQL = f"""
WITH r AS (SELECT symbol, date, close, close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS returns,
             close - LAG(close) OVER (PARTITION BY symbol ORDER BY date) AS delta FROM bars),
f AS (SELECT symbol, date, returns AS target,
  LAG(returns, 1) OVER (PARTITION BY symbol ORDER BY date) AS returns_lag_1,
  LAG(returns, 5) OVER (PARTITION BY symbol ORDER BY date) AS returns_lag_5,
  LAG(returns, 10) OVER (PARTITION BY symbol ORDER BY date) AS returns_lag_10,
  LAG(returns, 20) OVER (PARTITION BY symbol ORDER BY date) AS returns_lag_20,
  {_mp('STDDEV_SAMP(returns)', 'returns', 5, 1)} AS volatility_lag_5,
  {_mp('STDDEV_SAMP(returns)', 'returns', 10, 1)} AS volatility_lag_10,
  {_mp('STDDEV_SAMP(returns)', 'returns', 20, 1)} AS volatility_lag_20,
  {_mp('AVG(close)', 'close', 5)} AS sma_5, {_mp('AVG(close)', 'close', 20)} AS sma_20, {_mp('AVG(close)', 'close', 50)} AS sma_50,
  close / NULLIF({_mp('AVG(close)', 'close', 5)}, 0) AS price_sma5_ratio,
  close / NULLIF({_mp('AVG(close)', 'close', 20)}, 0) AS price_sma20_ratio,
  close / NULLIF({_mp('AVG(close)', 'close', 50)}, 0) AS price_sma50_ratio,
  {_mp('STDDEV_SAMP(returns)', 'returns', 5)} AS volatility_5, {_mp('STDDEV_SAMP(returns)', 'returns', 20)} AS volatility_20,
  CASE WHEN COUNT(*) OVER {_w(14)} = 14 THEN AVG(CASE WHEN delta > 0 THEN delta ELSE 0 END) OVER {_w(14)} END AS g,
  CASE WHEN COUNT(*) OVER {_w(14)} = 14 THEN AVG(CASE WHEN delta < 0 THEN -delta ELSE 0 END) OVER {_w(14)} END AS l
  FROM r),
m AS ({ASOF_SQL}),
x AS (SELECT f.*, CASE WHEN l > 0 THEN 100 - 100 / (1 + g / l) WHEN g > 0 THEN 100.0 END AS rsi,
             {', '.join('m.' + c for c in MCOLS)} FROM f JOIN m ON f.symbol = m.symbol AND f.date = m.date)
SELECT symbol, date, target, {', '.join(FEAT)} FROM x WHERE target IS NOT NULL AND {' AND '.join(c + ' IS NOT NULL' for c in FEAT)}"""


def _features(v):
    return MD.features(v.bars, v.macro)


@query("m01_feature_frame", oround(with_views(["bars", "macro"], FEATURES_SQL), ["target"] + FEAT, 6,
                                   {c: 4 for c in MCOLS}))
def m01(spark, sf):
    """M-01 + C-12: lag, volatility, moving-average, RSI and as-of macro features; complete rows only."""
    f, cols = _features(Views(spark, sf))
    assert cols == FEAT
    return rounded(f, 6, {c: 4 for c in MCOLS})


@query("m02_chronological_split", with_views(["bars", "macro"], f"""
WITH f AS ({FEATURES_SQL}),
n AS (SELECT symbol, date, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date) AS rn, COUNT(*) OVER (PARTITION BY symbol) AS n FROM f),
t AS (SELECT symbol, date, rn <= n - CEIL(n * 0.2) AS is_train FROM n)
SELECT symbol, date, is_train, CASE WHEN is_train THEN CAST(NTILE(5) OVER (PARTITION BY symbol, is_train ORDER BY date) - 1 AS INTEGER) END AS fold
FROM t"""))
def m02(spark, sf):
    """M-02: last ceil(20%) rows of each symbol are the test set; 5 contiguous folds over the rest."""
    f, _ = _features(Views(spark, sf))
    return MD.split(f).select("symbol", "date", "is_train", "fold")


SCALED = ["returns_lag_1", "volatility_5", "rsi"]


@query("m03_standard_scaling", oround(with_views(["bars", "macro"], f"""
WITH f AS ({FEATURES_SQL}),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date) AS rn, COUNT(*) OVER (PARTITION BY symbol) AS n FROM f),
t AS (SELECT *, rn <= n - CEIL(n * 0.2) AS is_train FROM n)
SELECT symbol, date, {', '.join(
    f"({c} - AVG(CASE WHEN is_train THEN {c} END) OVER (PARTITION BY symbol)) / COALESCE(NULLIF(STDDEV_POP(CASE WHEN is_train THEN {c} END) OVER (PARTITION BY symbol), 0), 1) AS {c}"
    for c in SCALED)} FROM t"""), SCALED, 6))
def m03(spark, sf):
    """M-03: features standardised with the training rows' mean and population std (per symbol)."""
    f, _ = _features(Views(spark, sf))
    s = MD.scale(MD.split(f), SCALED)
    return rounded(s.select("symbol", "date", *SCALED), 6)


def _prepared(spark, sf):
    f, cols = _features(Views(spark, sf))
    d = MD.scale(MD.split(f), cols)
    return d, cols


def _linear_report(spark, sf, model):
    d, cols = _prepared(spark, sf)
    train = d.filter("is_train")
    coefs = MD.fit(MD.gram(train, cols, ["symbol"]), cols, ["symbol"], model)
    test = MD.predict(d.filter(~F.col("is_train")), coefs.drop("model"), cols, "symbol")
    met = MD.regression_metrics(test, ["symbol"])
    cvc = MD.cv_fit(MD.gram(train, cols, ["symbol", "fold"]), cols, model)
    cvp = MD.predict(train, cvc.drop("model"), cols, ["symbol", "fold"])
    cvr = MD.regression_metrics(cvp, ["symbol", "fold"]).groupBy("symbol").agg(
        F.avg("r2").alias("cv_mean"), F.stddev_pop("r2").alias("cv_std"))
    return rounded(met.join(cvr, "symbol").withColumn("model", F.lit(model)), 9)


@query("m04_linear_regression")
def m04(spark, sf):
    """M-04 + M-10 + M-11: least squares per symbol; test MSE / MAE / R^2; 5-fold CV R^2."""
    return _linear_report(spark, sf, "linear")


@query("m05_ridge_regression")
def m05(spark, sf):
    return _linear_report(spark, sf, "ridge")


@query("m06_lasso_regression")
def m06(spark, sf):
    return _linear_report(spark, sf, "lasso")


@query("m07_elastic_net")
def m07(spark, sf):
    return _linear_report(spark, sf, "elastic")


@query("m07_optimality", with_views(["bars", "macro"], f"""
WITH f AS ({FEATURES_SQL}), n AS (SELECT symbol, COUNT(*) AS n FROM f GROUP BY 1)
SELECT symbol, m.model, TRUE AS optimal FROM n, (VALUES ('linear'), ('ridge'), ('lasso'), ('elastic')) m(model) WHERE n - CEIL(n * 0.2) > 0"""))
def m07_optimality(spark, sf):
    """M-04 .. M-07: every symbol's coefficients meet the conditions of the least loss on its training rows."""
    d, cols = _prepared(spark, sf)
    train = materialise(d.where("is_train"))
    sums = materialise(MD.gram(train, cols, ["symbol"]))
    out = [MD.optimality(train, MD.fit(sums, cols, ["symbol"], m), cols, m) for m in ("linear", "ridge", "lasso", "elastic")]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def _tree_frame(spark, sf):
    """Split features, written once: the fits and folds below read them many times."""
    f, cols = _features(Views(spark, sf))
    return materialise(MD.split(f)), cols


def _stored_forest(spark, sf):
    """The test rows, scored by a forest that was fitted, saved and read back."""
    d, cols = _tree_frame(spark, sf)
    path = MD.store_model(MD.tree_pipeline(cols, "rf").fit(d.where("is_train")), scratch(spark, "models"))
    return MD.score(d.where("NOT is_train"), path)


@query("m08_random_forest")
def m08(spark, sf):
    """M-08 + M-10 + M-11: pooled random forest (Spark ML), test metrics per symbol, R^2 over 5 folds of all symbols."""
    d, cols = _tree_frame(spark, sf)
    model, mean, std = MD.cross_validated(d.where("is_train"), MD.tree_pipeline(cols, "rf"))
    met = MD.regression_metrics(model.transform(d.where("NOT is_train")), ["symbol"])
    return rounded(met.select("*", F.lit(mean).alias("cv_mean"), F.lit(std).alias("cv_std"), F.lit("rf").alias("model")), 9)


@query("m09_gradient_boosting")
def m09(spark, sf):
    """M-09 + M-10: pooled gradient-boosted trees (Spark ML), test metrics per symbol; without folds: 600 rounds one after
    the other are mostly job overhead on small tables (``models.cross_validated`` takes this pipeline too)."""
    d, cols = _tree_frame(spark, sf)
    model = MD.tree_pipeline(cols, "gbt").fit(d.where("is_train"))
    return rounded(MD.regression_metrics(model.transform(d.where("NOT is_train")), ["symbol"]).withColumn("model", F.lit("gbt")), 9)


@query("m12_forest_importance")
def m12_forest(spark, sf):
    """M-12: every feature's importance in the pooled forest."""
    d, cols = _tree_frame(spark, sf)
    return rounded(MD.tree_importance(spark, MD.tree_pipeline(cols, "rf").fit(d.where("is_train")), cols, "rf"), 9)


@query("m13_forest_predictions")
def m13_forest(spark, sf):
    """M-13: predictions of the stored forest for the test rows."""
    return rounded(_stored_forest(spark, sf).select("symbol", "date", "target", "prediction"), 9)


@query("m14_forest_backtest")
def m14_forest(spark, sf):
    """M-14: long/short on the sign of the stored forest's prediction, 0.1% per unit of position change."""
    return rounded(MD.strategy_backtest(_stored_forest(spark, sf)), 9)


@query("m12_feature_importance")
def m12(spark, sf):
    """M-12 / T-04: the five largest |coefficients| of each symbol's ridge model."""
    d, cols = _prepared(spark, sf)
    coefs = MD.fit(MD.gram(d.filter("is_train"), cols, ["symbol"]), cols, ["symbol"], "ridge")
    imp = MD.importance(coefs, cols, ["symbol"])
    w = Window.partitionBy("symbol").orderBy(F.desc("importance"), "feature")
    return rounded(imp.withColumn("rank", F.row_number().over(w)).filter("rank <= 5"), 9)


@query("m13_predictions")
def m13(spark, sf):
    """M-13: stored scaler + linear model applied to the test rows."""
    d, cols = _prepared(spark, sf)
    coefs = MD.fit(MD.gram(d.filter("is_train"), cols, ["symbol"]), cols, ["symbol"], "linear")
    p = MD.predict(d.filter(~F.col("is_train")), coefs.drop("model"), cols, "symbol")
    return rounded(p.select("symbol", "date", "target", "prediction"), 9)


@query("m14_strategy_backtest")
def m14(spark, sf):
    """M-14: long/short on the sign of the linear model's prediction, 0.1% per unit of position change."""
    d, cols = _prepared(spark, sf)
    coefs = MD.fit(MD.gram(d.filter("is_train"), cols, ["symbol"]), cols, ["symbol"], "linear")
    p = MD.predict(d.filter(~F.col("is_train")), coefs.drop("model"), cols, "symbol")
    return rounded(MD.strategy_backtest(p), 9)
