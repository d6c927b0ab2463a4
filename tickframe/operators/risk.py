"""R-01 .. R-16: risk and performance metrics over long return series.

Input is long ``(key..., date, r)``; every metric is one ``groupBy(key).agg``
(partial aggregation) after at most one ordered window per key for the
drawdown path.  A key's series has one row per date, so window partitions
are bounded by the calendar length, not by data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.exprs import (RISK_FREE, SQRT_YEAR, TRADING_DAYS, c, guarded_pow,
                                       running, safe_div)


def with_drawdown(df: DataFrame, keys, r: str = "r", order: str = "date") -> DataFrame:
    """W-15: growth = prod(1+r), running max, drawdown = (growth - max) / max.

    The start value 1 is not part of the running max (reference behaviour).
    """
    w = running(keys, order)
    return (df.withColumn("growth", F.product(1 + c(r)).over(w))
              .withColumn("running_max", F.max("growth").over(w))
              .withColumn("drawdown", safe_div(F.col("growth") - F.col("running_max"),
                                               F.col("running_max"))))


def _vcol(level: float) -> str:
    return f"_var_{int(round(level * 10000))}"


def with_var(df: DataFrame, keys, r: str = "r", levels=(0.05,)) -> DataFrame:
    """Per-key exact percentile(r, level) attached to each row (whole-partition window)."""
    w = Window.partitionBy(*keys)
    for lv in levels:
        df = df.withColumn(_vcol(lv), F.percentile(c(r), lv).over(w))
    return df


def sharpe(r: str = "r", rf: float = RISK_FREE) -> F.Column:
    """R-01: mean(r - rf/252) / std(r) * sqrt(252)."""
    return safe_div(F.avg(c(r)) - rf / TRADING_DAYS, F.stddev_samp(c(r))) * SQRT_YEAR


def sortino(r: str = "r", rf: float = RISK_FREE, legacy: bool = False) -> F.Column:
    """R-02 (service form, Q-01): mean excess / downside std * sqrt(252), 0 when no downside spread.

    ``legacy`` reproduces the calculator form whose annualisation cancels
    and whose "no downside" result is +inf (returned as null, Q-07).
    """
    down = F.stddev_samp(F.when(c(r) < 0, c(r)))
    ex = F.avg(c(r)) - rf / TRADING_DAYS
    if legacy:
        return safe_div(ex, down * SQRT_YEAR) * SQRT_YEAR
    return F.when(down > 0, ex / down * SQRT_YEAR).otherwise(F.lit(0.0))


def total_return(r: str = "r") -> F.Column:
    return F.product(1 + c(r)) - 1


def annualized(total: F.Column, n: F.Column) -> F.Column:
    """(1 + total)^(252/n) - 1; null when 1 + total <= 0 (ln undefined)."""
    return guarded_pow(1 + total, safe_div(F.lit(float(TRADING_DAYS)), n)) - 1


def series_metrics(df: DataFrame, keys, r: str = "r", order: str = "date",
                   rf: float = RISK_FREE, levels=(0.05, 0.01)) -> DataFrame:
    """R-11 without benchmark: one row per key.

    sharpe, sortino (legacy calculator form), calmar, max_drawdown, volatility,
    annual_return, var_95/cvar_95, var_99/cvar_99.
    """
    keys = list(keys)
    d = with_var(with_drawdown(df.filter(c(r).isNotNull()), keys, r, order), keys, r, levels)
    aggs = [F.count(c(r)).cast("bigint").alias("n"),
            sharpe(r, rf).alias("sharpe_ratio"),
            sortino(r, rf, legacy=True).alias("sortino_ratio"),
            F.min("drawdown").alias("max_drawdown"),
            (F.stddev_samp(c(r)) * SQRT_YEAR).alias("volatility"),
            (F.avg(c(r)) * TRADING_DAYS).alias("annual_return")]
    for lv in levels:
        tag = int(round((1 - lv) * 100))
        aggs.append(F.first(_vcol(lv)).alias(f"var_{tag}"))
        aggs.append(F.avg(F.when(c(r) <= F.col(_vcol(lv)), c(r))).alias(f"cvar_{tag}"))
    out = d.groupBy(*keys).agg(*aggs)
    # R-03 Calmar = annual return / |max drawdown|; +inf sentinel becomes null (Q-07).
    return out.withColumn("calmar_ratio", safe_div(F.col("annual_return"), F.abs("max_drawdown")))


def benchmark_metrics(df: DataFrame, bench: DataFrame, keys, r: str = "r", bench_col: str = "r",
                      order: str = "date") -> DataFrame:
    """R-07..R-09 + excess: inner join on date with the benchmark (J-03).

    beta (Q-02 fixed: covar_samp / var_samp; 0 when the market does not move),
    tracking_error, information_ratio (0 without spread), excess_return,
    excess_volatility.  The benchmark has one row per date.
    """
    j = df.join(bench.select(order, F.col(bench_col).alias("_br")), order)
    j = j.filter(c(r).isNotNull() & F.col("_br").isNotNull())
    ex = c(r) - F.col("_br")
    te = F.stddev_samp(ex)
    return j.groupBy(*keys).agg(
        F.coalesce(safe_div(F.covar_samp(c(r), F.col("_br")), F.var_samp("_br")), F.lit(0.0)).alias("beta"),
        (te * SQRT_YEAR).alias("tracking_error"),
        F.when(te > 0, F.avg(ex) / te * SQRT_YEAR).otherwise(F.lit(0.0)).alias("information_ratio"),
        (F.avg(ex) * TRADING_DAYS).alias("excess_return"),
        (te * SQRT_YEAR).alias("excess_volatility"))
