"""O-01 .. O-10: portfolio optimisation as grouped fan-out.

Spark computes each portfolio's sufficient statistics (mean vector, covariance rows --
A-13 / A-14); every (portfolio, method, target) problem is one ``applyInPandas`` group
holding only N x N covariance rows (N <= 50 by the portfolio rules), solved with the
numpy helpers.  The efficient frontier solves all target returns of a portfolio in that group, so its
matrix moves once.  The random-weight search
(O-09) stays entirely in the JVM: hash-seeded Dirichlet samples scored with array
higher-order functions, best sample by ``max_by``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions import solvers
from tickframe.functions.exprs import RISK_FREE, TRADING_DAYS

OUT_SCHEMA = ("group STRING, method STRING, target DOUBLE, symbol STRING, weight DOUBLE, expected_return DOUBLE, "
              "volatility DOUBLE, sharpe_ratio DOUBLE, converged BOOLEAN")


def _problem_rows(cov: DataFrame, mu: DataFrame, group: str) -> DataFrame:
    """One row per (group, a, b) with the covariance and a's mean return."""
    m = mu.select(F.col(group).alias("group"), F.col("symbol").alias("symbol_a"), "expected_return")
    c = cov.select(F.col(group).alias("group"), "symbol_a", "symbol_b", "covariance")
    return c.join(m, ["group", "symbol_a"])


def _solver(method: str, rf_daily: float, legacy_rf: bool):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        syms = sorted(pdf["symbol_a"].unique())
        S = (pdf.pivot_table(index="symbol_a", columns="symbol_b", values="covariance", aggfunc="first")
             .reindex(index=syms, columns=syms).to_numpy(dtype=float))
        mu = pdf.groupby("symbol_a")["expected_return"].first().reindex(syms).to_numpy(dtype=float)
        target = float(pdf["target"].iloc[0]) if "target" in pdf and pdf["target"].notna().any() else None
        rf = RISK_FREE if legacy_rf else rf_daily
        if method == "max_sharpe":
            w, ok = solvers.max_sharpe(S, mu, rf)
        elif method == "min_variance":
            w, ok = solvers.min_variance(S, mu, target)
        elif method == "risk_parity":
            share = pdf.groupby("symbol_a")["share"].first().reindex(syms).to_numpy(dtype=float) if "share" in pdf else None
            if share is not None and np.isfinite(share).all() and share.sum() > 0:
                w, ok = solvers.risk_parity(S, share / share.sum())
            else:
                w, ok = solvers.risk_parity(S)
        else:
            raise ValueError(method)
        ret = float(mu @ w)
        vol = float(np.sqrt(max(w @ S @ w, 0.0)))
        sr = (ret - rf) / vol if vol > 0 else 0.0
        return pd.DataFrame({"group": pdf["group"].iloc[0], "method": method, "target": target, "symbol": syms,
                             "weight": w, "expected_return": ret, "volatility": vol, "sharpe_ratio": sr,
                             "converged": ok})
    return fn


def optimise(cov: DataFrame, mu: DataFrame, group: str, method: str = "max_sharpe",
             rf: float = RISK_FREE / TRADING_DAYS, legacy_rf: bool = False, risk_shares: DataFrame | None = None) -> DataFrame:
    """O-01 (max_sharpe; Q-22 fixed: daily rf, ``legacy_rf`` compares with the annual rate as the
    reference does), O-02 (min_variance), O-05 (risk_parity); O-06 dispatches on ``method``."""
    rows = _problem_rows(cov, mu, group).withColumn("target", F.lit(None).cast("double"))
    if risk_shares is not None:  # (group, symbol, share): target risk contributions of O-05, equal ones where any is missing
        rows = rows.join(risk_shares.select(F.col(group).alias("group"), F.col("symbol").alias("symbol_a"), "share"), ["group", "symbol_a"], "left")
    out = rows.groupBy("group").applyInPandas(_solver(method, rf, legacy_rf), OUT_SCHEMA)
    return out.withColumnRenamed("group", group)


def optimality(weights: DataFrame, cov: DataFrame, mu: DataFrame, group: str, rf: float = RISK_FREE / TRADING_DAYS, tolerance: float = 1e-6) -> DataFrame:
    """(group, method, optimal): whether solved weights are long only, sum to one and meet their method's conditions, judged from
    the covariance rows with S w as one join and one sum.

    Least variance: (S w)_a is the variance where a is held and no less elsewhere.  Best Sharpe ratio: (S w)_a times the excess
    return is a's excess return times the variance where a is held and no less elsewhere; equal weights where no asset has an excess.
    Risk parity: equal contributions w_a (S w)_a."""
    w = weights.select(group, "method", "symbol", "weight")
    sw = (cov.join(w.withColumnRenamed("symbol", "symbol_b"), [group, "symbol_b"]).groupBy(group, "method", F.col("symbol_a").alias("symbol"))
          .agg(F.sum(F.col("covariance") * F.col("weight")).alias("sw")))
    d = w.join(sw, [group, "method", "symbol"]).join(mu.select(group, "symbol", (F.col("expected_return") - rf).alias("ex")), [group, "symbol"])
    p = Window.partitionBy(group, "method")
    d = d.select("*", F.sum(F.col("weight") * F.col("sw")).over(p).alias("var"), F.sum(F.col("weight") * F.col("ex")).over(p).alias("gain"),
                 F.max(F.abs("sw")).over(p).alias("top"), F.max("ex").over(p).alias("best"), F.max(F.abs("ex")).over(p).alias("most"),
                 F.count(F.lit(1)).over(p).alias("n"))

    def held(gap, slack):  # zero where the asset is held, not below zero elsewhere
        return F.when(F.col("weight") > 1e-9, F.abs(gap) <= slack).otherwise(gap >= -slack)
    fits = (F.when(F.col("method") == "min_variance", held(F.col("sw") - F.col("var"), tolerance * F.col("top")))
            .when((F.col("method") == "max_sharpe") & (F.col("best") <= 0), F.abs(F.col("weight") * F.col("n") - 1) <= tolerance)
            .when(F.col("method") == "max_sharpe", held(F.col("sw") * F.col("gain") - F.col("ex") * F.col("var"), tolerance * F.col("top") * F.col("most")))
            .when(F.col("method") == "risk_parity", F.abs(F.col("weight") * F.col("sw") * F.col("n") - F.col("var")) <= tolerance * F.col("var")))
    return d.groupBy(group, "method").agg((F.bool_and(fits & (F.col("weight") >= 0)) & (F.abs(F.sum("weight") - 1) <= tolerance)).alias("optimal"))


def frontier(cov: DataFrame, mu: DataFrame, group: str, points: int = 100) -> DataFrame:
    """O-03: minimum-variance portfolios at ``points`` target returns from min to max mean; a portfolio's matrix goes to
    its task once and all its targets are solved there."""
    solve = _solver("min_variance", 0.0, False)

    def all_targets(pdf):
        import pandas as pd
        lo, hi = float(pdf["expected_return"].min()), float(pdf["expected_return"].max())
        return pd.concat([solve(pdf.assign(target=lo + (hi - lo) * k / (points - 1))) for k in range(points)])

    out = _problem_rows(cov, mu, group).groupBy("group").applyInPandas(all_targets, OUT_SCHEMA)
    return out.withColumnRenamed("group", group)


def random_search(cov: DataFrame, mu: DataFrame, group: str, samples: int = 10000, seed: int = 42,
                  rf: float = RISK_FREE / TRADING_DAYS) -> DataFrame:
    """O-09: best of ``samples`` Dirichlet(1) portfolios by Sharpe ratio, all JVM-side.

    Uniforms come from xxhash64(group, sample, asset, seed), so the result repeats."""
    m = mu.groupBy(F.col(group).alias("g")).agg(F.array_sort(F.collect_list(F.struct("symbol", "expected_return")))
                                                .alias("mu"))
    c = cov.groupBy(F.col(group).alias("g")).agg(
        F.array_sort(F.collect_list(F.struct("symbol_a", "symbol_b", "covariance"))).alias("cov"))
    p = m.join(c, "g").select("g", F.col("mu.symbol").alias("syms"), F.col("mu.expected_return").alias("mu"),
                              F.col("cov.covariance").alias("S"), F.size("mu").alias("n"))
    s = p.select("*", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("sample"))
    u = F.expr(f"transform(sequence(0, n - 1), i -> -ln((CAST(xxhash64(g, sample, i, {seed}) & 9007199254740991 AS DOUBLE)"
               " + 0.5) / 9007199254740992.0))")
    s = s.withColumn("_e", u).withColumn("w", F.expr("transform(_e, x -> x / aggregate(_e, 0D, (a, y) -> a + y))"))
    s = s.withColumn("ret", F.expr("aggregate(zip_with(w, mu, (a, b) -> a * b), 0D, (x, y) -> x + y)"))
    s = s.withColumn("var", F.expr("aggregate(sequence(0, n * n - 1), 0D, (acc, k) -> acc + "
                                   "w[CAST(k DIV n AS INT)] * w[CAST(k % n AS INT)] * S[k])"))
    s = s.withColumn("sharpe", (F.col("ret") - rf) / F.sqrt("var"))
    best = s.groupBy("g", "syms").agg(F.max_by(F.struct("sample", "w", "ret", "var", "sharpe"), "sharpe").alias("b"))
    out = best.select(F.col("g").alias(group), F.col("b.sample").alias("sample"),
                      F.explode(F.arrays_zip(F.col("syms").alias("symbol"), F.col("b.w").alias("weight"))).alias("z"),
                      F.col("b.ret").alias("expected_return"), F.sqrt("b.var").alias("volatility"),
                      F.col("b.sharpe").alias("sharpe_ratio"))
    return out.select(group, "sample", "z.symbol", "z.weight", "expected_return", "volatility", "sharpe_ratio")


def strategy_weights(holdings: DataFrame, caps: DataFrame, group: str = "portfolio_name") -> DataFrame:
    """O-10 / A-27: equal weights and market-cap weights (0.1 for an unknown cap, then renormalised)."""
    p = Window.partitionBy(group)
    eq = holdings.select(group, "symbol", F.lit("equal").alias("strategy"), (1.0 / F.count("*").over(p)).alias("weight"))
    c = holdings.join(caps, "symbol", "left")
    capw = F.coalesce(F.col("market_cap") / F.sum("market_cap").over(p), F.lit(0.1))
    mc = c.select(group, "symbol", capw.alias("_w"))
    mc = mc.select(group, "symbol", F.lit("market_cap").alias("strategy"), (F.col("_w") / F.sum("_w").over(p)).alias("weight"))
    return eq.unionByName(mc)
