"""Covariance / correlation matrices and asset statistics: A-13..A-20, J-13, O-04.

Pairwise moments come from a block outer product instead of a self-join on date: symbols are numbered once, a row goes to
the pairs (I <= J) of its tile of symbols, and each (tile pair, block of dates) is a few matrix products in a task of bounded
size; blocks are summed per pair.  Values are taken from their symbol's mean first.  Pairwise-complete statistics match
pandas ``cov()`` / ``corr()``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.exprs import SQRT_YEAR, TRADING_DAYS, safe_div

G = "_grp"


def index_symbols(df: DataFrame, group: str, key: str = "symbol", value: str = "r") -> DataFrame:
    """(group, key, _mean, _i, _last): the symbol's mean value, its number 0 .. _last in key order inside its group (windows
    over a row per symbol)."""
    d = df.groupBy(group, key).agg(F.avg(value).alias("_mean"))
    return d.withColumn("_i", F.dense_rank().over(Window.partitionBy(group).orderBy(key)) - 1).withColumn(
        "_last", F.max("_i").over(Window.partitionBy(group)))


_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _block_moments(pdf):
    """Moments of all pairs between two tiles of symbols over one block of dates, as matrix products."""
    import numpy as np
    import pandas as pd

    first = pdf.iloc[0]
    day, days = pd.factorize(pdf["_date"])
    sides = []
    for t in (first["_p"], first["_q"]):
        mine = (pdf["_t"] == t).to_numpy()
        number, names = pd.factorize(pdf["_i"][mine], sort=True)
        x, has = np.zeros((len(days), len(names))), np.zeros((len(days), len(names)))
        x[day[mine], number] = pdf["_x"][mine]
        has[day[mine], number] = 1.0
        sides.append((np.asarray(names), x, has))
    (na, x, hx), (nb, y, hy) = sides
    out = {"a": np.repeat(na, len(nb)), "b": np.tile(nb, len(na))}
    for name, m in zip(_MOMENTS, (hx.T @ hy, x.T @ hy, hx.T @ y, (x * x).T @ hy, hx.T @ (y * y), x.T @ y)):
        out[name] = m.ravel()
    out = pd.DataFrame(out)
    out.insert(0, "_group", first["_group"])
    return out[out["n"] > 0]


def pair_moments(df: DataFrame, group: str | None = None, key: str = "symbol", date: str = "date",
                 value: str = "r", tile: int = 256, days: int = 4096) -> DataFrame:
    """Long (group, a, b, n, sx, sy, sxx, syy, sxy) over dates where both a and b are present; values are taken from
    their symbol's mean first, so that large levels lose no digits.

    A block outer product: symbols are numbered once, a row goes to the tile pairs (I <= J) of its tile, and each
    (tile pair, block of dates) is a few matrix products over at most 2 * tile symbols x days dates.
    """
    if group is None:
        df = df.withColumn(G, F.lit("all"))
        group = G
    df = df.filter(F.col(value).isNotNull())
    idx = index_symbols(df, group, key, value)
    rows = df.join(idx, [group, key]).select(
        F.col(group).cast("string").alias("_group"), F.col(date).alias("_date"), "_i", (F.col(value) - F.col("_mean")).alias("_x"),
        F.floor(F.col("_i") / tile).cast("int").alias("_t"), F.floor(F.col("_last") / tile).cast("int").alias("_tiles"),
        F.floor(F.datediff(F.col(date).cast("date"), F.lit("1970-01-01").cast("date")) / days).cast("int").alias("_days"))
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), "_tiles"))).withColumns({"_p": F.least("_t", "_o"), "_q": F.greatest("_t", "_o")})
    schema = "_group string, a bigint, b bigint, " + ", ".join(f"{m} double" for m in _MOMENTS)
    out = rows.select("_group", "_date", "_i", "_x", "_t", "_p", "_q", "_days").groupBy("_group", "_p", "_q", "_days") \
        .applyInPandas(_block_moments, schema).groupBy("_group", "a", "b").agg(*[F.sum(m).alias(m) for m in _MOMENTS])
    # pairs between two tiles come once; their mirror follows
    same = F.struct("a", "b", *_MOMENTS)
    swap = F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "n", F.col("sy").alias("sx"), F.col("sx").alias("sy"), F.col("syy").alias("sxx"),
                    F.col("sxx").alias("syy"), "sxy")
    one_tile = F.floor(F.col("a") / tile) == F.floor(F.col("b") / tile)
    out = out.select("_group", F.explode(F.when(one_tile, F.array(same)).otherwise(F.array(same, swap))).alias("e")).select("_group", "e.*")
    names = [idx.select(F.col(group).cast("string").alias("_group"), F.col(key).alias(f"symbol_{x}"), F.col("_i").cast("bigint").alias(x)) for x in "ab"]
    res = out.join(names[0], ["_group", "a"]).join(names[1], ["_group", "b"])
    cols = [F.col("_group").alias(group)] if group != G else []
    return res.select(*cols, "symbol_a", "symbol_b", F.col("n").cast("bigint").alias("n"), "sx", "sy", "sxx", "syy", "sxy")


def covariance_from_moments(m: DataFrame) -> DataFrame:
    n = F.col("n")
    cxy = F.col("sxy") - F.col("sx") * F.col("sy") / n
    cxx = F.col("sxx") - F.col("sx") * F.col("sx") / n
    cyy = F.col("syy") - F.col("sy") * F.col("sy") / n
    keep = [x for x in m.columns if x not in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    return m.select(*keep, "n", safe_div(cxy, n - 1).alias("covariance"),
                    F.when((cxx > 0) & (cyy > 0), cxy / F.sqrt(cxx * cyy)).alias("correlation"))


def covariance(returns: DataFrame, group: str | None = None, value: str = "r", tile: int = 256) -> DataFrame:
    """A-14 / A-16: long (group?, symbol_a, symbol_b, n, covariance, correlation)."""
    return covariance_from_moments(pair_moments(returns, group, value=value, tile=tile))


def shrink(cov: DataFrame, n_obs: DataFrame, group: str) -> DataFrame:
    """A-15 (Q-05 kept): (1 - l) S + l * avg_var * I with l = clamp((T - n - 2) / (T - 1), 0, 1).

    ``n_obs``: (group, T) number of observations behind each group's matrix.
    """
    diag = cov.filter(F.col("symbol_a") == F.col("symbol_b")).groupBy(group).agg(
        F.avg("covariance").alias("_avg_var"), F.count("*").alias("_n"))
    j = cov.join(diag, group).join(n_obs, group)
    lam = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("T") - F.col("_n") - 2) / (F.col("T") - 1)))
    target = F.when(F.col("symbol_a") == F.col("symbol_b"), F.col("_avg_var")).otherwise(F.lit(0.0))
    return j.select(group, "symbol_a", "symbol_b", lam.alias("shrinkage"),
                    ((1 - lam) * F.col("covariance") + lam * target).alias("covariance"))


def moments(returns: DataFrame, key: str = "symbol", value: str = "r") -> DataFrame:
    """A-17: mean, sample std, bias-corrected skew (G1) and excess kurtosis (G2), mean / std."""
    n = F.count(value)
    g1, g2 = F.skewness(value), F.kurtosis(value)
    m = returns.groupBy(key).agg(n.alias("_n"), F.avg(value).alias("mean_return"),
                                 F.stddev_samp(value).alias("volatility"), g1.alias("_g1"), g2.alias("_g2"))
    nn = F.col("_n").cast("double")
    skew = F.when(nn > 2, F.col("_g1") * F.sqrt(nn * (nn - 1)) / (nn - 2))
    kurt = F.when(nn > 3, (nn - 1) / ((nn - 2) * (nn - 3)) * ((nn + 1) * F.col("_g2") + 6))
    return m.select(key, "mean_return", "volatility", skew.alias("skewness"), kurt.alias("kurtosis"),
                    safe_div("mean_return", "volatility").alias("sharpe_like"))


def correlation_features(corr: DataFrame, threshold: float = 0.7) -> DataFrame:
    """A-18: per symbol, mean / max / min correlation with the others and how many exceed 0.7."""
    o = corr.filter(F.col("symbol_a") != F.col("symbol_b"))
    return o.groupBy(F.col("symbol_a").alias("symbol")).agg(
        F.avg("correlation").alias("avg_correlation"), F.max("correlation").alias("max_correlation"),
        F.min("correlation").alias("min_correlation"),
        F.count_if(F.col("correlation") > threshold).cast("bigint").alias("high_corr_count"))


def histogram(df: DataFrame, group: str, value: str = "r", bins: int = 50) -> DataFrame:
    """A-19 / A-20: equal-width bins between each group's min and max (max in the last bin),
    counts, and the fitted normal curve (expected count) at the bin centres."""
    w = Window.partitionBy(group)
    d = df.filter(F.col(value).isNotNull()).select(
        group, value, F.min(value).over(w).alias("_lo"), F.max(value).over(w).alias("_hi"),
        F.avg(value).over(w).alias("_mu"), F.stddev_samp(value).over(w).alias("_sd"), F.count(value).over(w).alias("_n"))
    b = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
                                                            * bins) + 1, F.lit(bins))).otherwise(F.lit(1))
    h = d.groupBy(group, b.cast("int").alias("bin"), "_lo", "_hi", "_mu", "_sd", "_n").agg(
        F.count("*").cast("bigint").alias("count"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    lo = F.col("_lo") + (F.col("bin") - 1) * width
    centre = lo + width / 2
    z = safe_div(centre - F.col("_mu"), F.col("_sd"))
    pdf = safe_div(F.exp(-0.5 * z * z), F.col("_sd") * math.sqrt(2 * math.pi))
    return h.select(group, "bin", lo.alias("bin_start"), (lo + width).alias("bin_end"), "count",
                    (F.col("_n") * width * pdf).alias("normal_expected"))


def expected_returns(returns: DataFrame, key: str = "symbol", value: str = "r", annualise: bool = False) -> DataFrame:
    """A-13: mean return per asset ('capm' and other methods fall back to the mean, as in the reference)."""
    m = F.avg(value) * (TRADING_DAYS if annualise else 1)
    return returns.groupBy(key).agg(m.alias("expected_return"))


def asset_points(returns: DataFrame, key: str = "symbol", value: str = "r") -> DataFrame:
    """O-08: annualised return and volatility per asset (the scatter behind the frontier)."""
    return returns.groupBy(key).agg((F.avg(value) * TRADING_DAYS).alias("annual_return"),
                                    (F.stddev_samp(value) * SQRT_YEAR).alias("annual_volatility"))


def implied_returns(returns: DataFrame, caps: DataFrame, group: str, delta: float = 3.0,
                    value: str = "r") -> DataFrame:
    """O-04 Black-Litterman prior (views are ignored, as in the reference):
    market weights w = cap / sum(cap) per group, implied return = delta * (S w)_a.

    (S w)_a = cov(r_a, p) with p the cap-weighted return, so the matrix is not
    needed: one join of each asset's returns with its group's weighted series.
    ``returns``: (group, symbol, date, r) on the dates the covariance uses;
    ``caps``: (group, symbol, market_cap).
    """
    w = caps.withColumn("market_weight", F.col("market_cap") / F.sum("market_cap").over(Window.partitionBy(group)))
    j = returns.join(w.select(group, "symbol", "market_weight"), [group, "symbol"])
    p = j.groupBy(group, "date").agg(F.sum(F.col("market_weight") * F.col(value)).alias("_p"))
    c = j.join(p, [group, "date"]).groupBy(group, "symbol", "market_weight").agg(
        F.covar_samp(value, "_p").alias("_cov"))
    return c.select(group, "symbol", "market_weight", (F.lit(delta) * F.col("_cov")).alias("implied_return"))
