"""M-01 .. M-14: return models.

Features and the chronological split are window expressions per symbol.  Linear
models are fitted per symbol from sufficient statistics -- n, sum x, sum y,
sum x x', sum x y -- summed by ``Summarizer`` (a partial aggregate whose size is
fixed by the number of features, not by the rows).  The k x k solves run per
group in ``applyInPandas``: closed form for least squares and ridge, coordinate
descent on the Gram matrix for lasso / elastic net (sklearn objectives).  The
statistics are additive, so 5-fold cross-validation fits fold models as
"total minus fold" without another pass over the rows.  Tree ensembles use
Spark ML on the pooled feature frame.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.functions.exprs import SQRT_YEAR, safe_div
from tickframe.operators import windows as W
from tickframe.operators.joins import asof_join
from tickframe.operators.returns import with_returns

# fixed values: model hyper-parameters of the reference
ALPHAS = {"ridge": 1.0, "lasso": 0.1, "elastic": 0.1}
L1_RATIO = 0.5
TRANSACTION_COST = 0.001


def features(bars: DataFrame, macro: DataFrame | None = None, lags=(1, 5, 10, 20)) -> tuple[DataFrame, list[str]]:
    """M-01: (symbol, date, target, features...) with lags, lagged volatility (Q-06: none for
    lag 1), SMA 5/20/50 and price ratios, volatility 5/20, RSI and as-of macro values;
    rows with any missing feature dropped (C-12 keeps the target aligned)."""
    d = with_returns(bars.select("symbol", "date", "close"), "close")
    d = W.with_lags(d, "returns", lags)
    d = W.with_sma(d, "close", (5, 20, 50))
    for n in (5, 20, 50):
        d = d.withColumn(f"price_sma{n}_ratio", safe_div("close", f"sma_{n}"))
    d = W.with_rolling_std(d, "returns", 5, "volatility_5")
    d = W.with_rolling_std(d, "returns", 20, "volatility_20")
    d = W.with_rsi(d, "close")
    cols = ([f"returns_lag_{k}" for k in lags] + [f"volatility_lag_{k}" for k in lags if k > 1] +
            ["sma_5", "sma_20", "sma_50", "price_sma5_ratio", "price_sma20_ratio", "price_sma50_ratio",
             "volatility_5", "volatility_20", "rsi"])
    if macro is not None:
        d = asof_join(d, macro)
        cols += sorted(c for c in d.columns if c.startswith("macro_"))
    d = d.select("symbol", "date", F.col("returns").alias("target"), *cols)
    return d.dropna(subset=cols + ["target"]), cols


def split(df: DataFrame, test_fraction: float = 0.2, key: str = "symbol") -> DataFrame:
    """M-02: chronological split per key, test = ceil(fraction * n) last rows; 5 contiguous
    cross-validation folds over the training rows (sizes as ``ntile``)."""
    w = Window.partitionBy(key).orderBy("date")
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    d = df.withColumn("_rn", F.row_number().over(w)).withColumn("_n", n)
    d = d.withColumn("is_train", F.col("_rn") <= F.col("_n") - F.ceil(F.col("_n") * test_fraction))
    ntr = F.col("_n") - F.ceil(F.col("_n") * test_fraction)
    # ntile(5) over the training rows: the first (n mod 5) folds hold one row more
    q, r = F.floor(ntr / 5), ntr % 5
    pos = F.col("_rn") - 1
    fold = F.when(pos < r * (q + 1), F.floor(pos / (q + 1))).otherwise(r + F.floor((pos - r * (q + 1)) / q))
    return d.withColumn("fold", F.when(F.col("is_train"), fold.cast("int"))).drop("_rn", "_n")


def scale(df: DataFrame, cols, key: str = "symbol") -> DataFrame:
    """M-03: standardise with the training rows' mean and population std per key (sklearn
    StandardScaler; a zero spread keeps scale 1)."""
    p = Window.partitionBy(key)
    out = df
    for c in cols:
        tr = F.when(F.col("is_train"), F.col(c))
        m, s = F.avg(tr).over(p), F.stddev_pop(tr).over(p)
        out = out.withColumn(c, (F.col(c) - m) / F.when(s > 0, s).otherwise(F.lit(1.0)))
    return out


def gram(df: DataFrame, cols, keys) -> DataFrame:
    """Sufficient statistics per group as one vector: [n, sum x (k), sum y, sum xx' (k*k), sum xy (k), sum yy]."""
    x = F.array(*[F.col(c) for c in cols])
    y = F.col("target")
    v = F.concat(F.array(F.lit(1.0)), x, F.array(y), F.flatten(F.transform(x, lambda a: F.transform(x, lambda b: a * b))),
                 F.transform(x, lambda a: a * y), F.array(y * y))
    return (df.select(*keys, array_to_vector(v).alias("_v")).groupBy(*keys)
              .agg(Summarizer.sum(F.col("_v")).alias("_s")).select(*keys, vector_to_array("_s").alias("stats")))


def _unpack(s: np.ndarray, k: int):
    n = s[0]
    sx = s[1:1 + k]
    sy = s[1 + k]
    sxx = s[2 + k:2 + k + k * k].reshape(k, k)
    sxy = s[2 + k + k * k:2 + 2 * k + k * k]
    return n, sx, sy, sxx, sxy


def solve_linear(n, sx, sy, sxx, sxy, model: str):
    """Coefficients and intercept from sums (centred normal equations)."""
    k = len(sx)
    mx, my = sx / n, sy / n
    C = sxx - n * np.outer(mx, mx)
    c = sxy - n * mx * my
    if model == "linear":
        w = np.linalg.lstsq(C, c, rcond=None)[0]
    elif model == "ridge":
        w = np.linalg.solve(C + ALPHAS["ridge"] * np.eye(k), c)
    else:
        a = ALPHAS[model]
        l1 = 1.0 if model == "lasso" else L1_RATIO
        w = np.zeros(k)
        for _ in range(10000):
            delta = 0.0
            for j in range(k):
                rho = c[j] - C[j] @ w + C[j, j] * w[j]
                new = np.sign(rho) * max(abs(rho) - n * a * l1, 0.0) / (C[j, j] + n * a * (1 - l1)) if C[j, j] > 0 else 0.0
                delta = max(delta, abs(new - w[j]))
                w[j] = new
            if delta < 1e-12:
                break
    return w, my - mx @ w


def fit(stats: DataFrame, cols, keys, model: str) -> DataFrame:
    """M-04 .. M-07: per-group coefficients from the summed statistics."""
    k = len(cols)
    names = list(keys)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for rec in pdf.itertuples(index=False):
            s = np.asarray(getattr(rec, "stats"), dtype=float)
            w, b = solve_linear(*_unpack(s, k), model)
            rows.append([getattr(rec, c) for c in names] + [model, w.tolist(), float(b)])
        return pd.DataFrame(rows, columns=names + ["model", "coef", "intercept"])

    schema = ", ".join(f"{c} {stats.schema[c].dataType.simpleString()}" for c in names) + \
        ", model STRING, coef ARRAY<DOUBLE>, intercept DOUBLE"
    return stats.groupBy(*keys).applyInPandas(fn, schema)


def optimality(train: DataFrame, coefs: DataFrame, cols, model: str, key: str = "symbol", tolerance: float = 1e-6) -> DataFrame:
    """(key, model, optimal): whether coefficients meet the conditions of the least loss, judged from the rows, not from the sums they
    were solved from.  Sweeps that ended before they converged show here as false.

    With the residuals e the sums x_j e must be zero (least squares), alpha w_j (ridge), or less the square penalty's share n alpha
    times the sign of w_j where w_j is not zero, and at most n alpha in size where it is (lasso, elastic net)."""
    d = predict(train, coefs.drop("model"), cols, key).withColumn("_e", F.col("target") - F.col("prediction"))
    z = F.arrays_zip(F.sequence(F.lit(0), F.lit(len(cols) - 1)).alias("j"), F.array(*[F.col(c) for c in cols]).alias("x"), F.col("coef").alias("w"))
    d = d.select(key, "target", "_e", F.explode(z).alias("z")).groupBy(key, "z.j").agg(
        F.sum(F.col("z.x") * F.col("_e")).alias("g"), F.first("z.w").alias("w"), F.count(F.lit(1)).alias("n"), F.sum("_e").alias("e"),
        F.sum(F.col("z.x") * F.col("z.x")).alias("xx"), F.sum(F.col("target") * F.col("target")).alias("yy"))
    slack = tolerance * F.sqrt(F.col("xx") * F.col("yy")) + 1e-12
    if model in ("linear", "ridge"):
        fits = F.abs(F.col("g") - (ALPHAS["ridge"] if model == "ridge" else 0.0) * F.col("w")) <= slack
    else:
        share = 1.0 if model == "lasso" else L1_RATIO
        bound = F.col("n") * (ALPHAS[model] * share)
        h = F.col("g") - F.col("n") * (ALPHAS[model] * (1 - share)) * F.col("w")
        fits = F.when(F.col("w") == 0, F.abs(h) <= bound + slack).otherwise(F.abs(h - bound * F.signum("w")) <= slack)
    level = F.abs(F.col("e")) <= tolerance * F.sqrt(F.col("n") * F.col("yy")) + 1e-12
    return d.groupBy(key).agg(F.bool_and(fits & level).alias("optimal")).select(key, F.lit(model).alias("model"), "optimal")


def cv_fit(fold_stats: DataFrame, cols, model: str, key: str = "symbol") -> DataFrame:
    """M-11: fold f's model is fitted on (all training statistics - fold f's statistics)."""
    k = len(cols)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack([np.asarray(s, float) for s in pdf["stats"]]), axis=0)
        out = []
        for f, s in zip(pdf["fold"], pdf["stats"]):
            w, b = solve_linear(*_unpack(total - np.asarray(s, float), k), model)
            out.append((pdf[key].iloc[0], int(f), model, w.tolist(), float(b)))
        return pd.DataFrame(out, columns=[key, "fold", "model", "coef", "intercept"])

    return fold_stats.groupBy(key).applyInPandas(
        fn, f"{key} STRING, fold INT, model STRING, coef ARRAY<DOUBLE>, intercept DOUBLE")


def predict(df: DataFrame, coefs: DataFrame, cols, on) -> DataFrame:
    """M-13: prediction = intercept + coef . x (array dot product, JVM-side)."""
    x = F.array(*[F.col(c) for c in cols])
    j = df.join(coefs, on)
    dot = F.aggregate(F.zip_with(x, F.col("coef"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return j.withColumn("prediction", F.col("intercept") + dot)


def regression_metrics(pred: DataFrame, keys) -> DataFrame:
    """M-10: MSE, MAE, R^2 = 1 - SSE / SST."""
    e = F.col("target") - F.col("prediction")
    g = pred.groupBy(*keys).agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                                F.sum(e * e).alias("_sse"), F.var_pop("target").alias("_vp"), F.count("*").alias("_n"))
    return g.select(*keys, "mse", "mae", (1 - safe_div(F.col("_sse"), F.col("_vp") * F.col("_n"))).alias("r2"))


def importance(coefs: DataFrame, cols, keys) -> DataFrame:
    """M-12: |coefficient| per feature, long form."""
    names = F.array(*[F.lit(c) for c in cols])
    z = coefs.select(*keys, "model", F.explode(F.arrays_zip(names.alias("feature"), F.col("coef").alias("c"))).alias("z"))
    return z.select(*keys, "model", "z.feature", F.abs("z.c").alias("importance"))


def strategy_backtest(pred: DataFrame, key: str = "symbol", cost: float = TRANSACTION_COST) -> DataFrame:
    """M-14: signal +1 / -1 by prediction > 0; cost |change| * 0.001 (first position free);
    total return, volatility, Sharpe, max drawdown of the strategy returns per key."""
    w = Window.partitionBy(key).orderBy("date")
    s = F.when(F.col("prediction") > 0, 1).otherwise(-1)
    d = pred.withColumn("signal", s)
    d = d.withColumn("change", F.coalesce(F.col("signal") - F.lag("signal").over(w), F.lit(0)))
    d = d.withColumn("strategy_return", F.col("signal") * F.col("target") - F.abs("change") * cost)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_g", F.product(1 + F.col("strategy_return")).over(run))
    d = d.withColumn("_dd", safe_div(F.col("_g") - F.max("_g").over(run), F.max("_g").over(run)))
    return d.groupBy(key).agg(
        (F.max_by("_g", "date") - 1).alias("total_return"),
        (F.stddev_samp("strategy_return") * SQRT_YEAR).alias("volatility"),
        (safe_div(F.avg("strategy_return"), F.stddev_samp("strategy_return")) * SQRT_YEAR).alias("sharpe_ratio"),
        F.min("_dd").alias("max_drawdown"))


def tree_pipeline(cols, kind: str = "rf", seed: int = 42, max_depth: int = 5, rounds: int = 100) -> Pipeline:
    """M-08 / M-09: pooled random forest (``rounds`` trees, all features per split, of depth ``max_depth``: at most 30 in Spark ML,
    where the reference lets trees grow without a limit) or gradient-boosted trees (``rounds`` rounds, depth 3, step 0.1) with
    Spark ML on unscaled features."""
    if kind == "rf":
        est = RandomForestRegressor(labelCol="target", numTrees=rounds, featureSubsetStrategy="all", maxDepth=max_depth, seed=seed)
    else:
        est = GBTRegressor(labelCol="target", maxIter=rounds, maxDepth=3, stepSize=0.1, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="features"), est])


def cross_validated(train: DataFrame, pipeline: Pipeline, folds: int = 5, threads: int = 5) -> tuple[PipelineModel, float, float]:
    """M-11 for any Spark ML pipeline: (model of all training rows, mean and population deviation of the folds' R^2).

    ``fold`` numbers the rows' folds 0 .. folds - 1 (``split``: contiguous ones per series).  The fits of the folds are
    independent jobs, ``threads`` at a time."""
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=[{}], numFolds=folds, foldCol="fold", parallelism=threads,
                        evaluator=RegressionEvaluator(labelCol="target", metricName="r2"))
    model = cv.fit(train)
    return model.bestModel, float(model.avgMetrics[0]), float(model.stdMetrics[0])


def store_model(model: PipelineModel, path: str) -> str:
    """M-13: the assembler and the fitted trees as one saved pipeline in a shared folder."""
    model.write().overwrite().save(path)
    return path


def score(df: DataFrame, path: str) -> DataFrame:
    """M-13: the rows with the ``prediction`` of a stored pipeline."""
    return PipelineModel.load(path).transform(df).drop("features")


def tree_importance(spark: SparkSession, model: PipelineModel, cols, kind: str) -> DataFrame:
    """M-12: (model, feature, importance) of a fitted tree pipeline, importances summing to one; one row per feature."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame([(kind, c, w) for c, w in zip(cols, weights, strict=True)], "model string, feature string, importance double")
