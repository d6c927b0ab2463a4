"""W-*: ordered-window operators over long (key..., date, value) frames.

All operators of one family share ``Window.partitionBy(keys).orderBy(date)``
so Spark sorts each partition once.  Partitions hold one key's series,
bounded by its number of dates.  pandas' ``min_periods=window`` default is
reproduced with ``min_periods`` (value only when the frame is full).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.ema import block_rows, with_blocks, with_ema
from tickframe.functions.exprs import SQRT_YEAR, c, min_periods, rolling, safe_div, series_window


def with_sma(df, col="close", ns=(5, 20, 50), keys=("symbol",), order="date", prefix="sma"):
    """W-03: simple moving averages, null until the window is full."""
    for n in ns:
        w = rolling(keys, order, n)
        df = df.withColumn(f"{prefix}_{n}", min_periods(F.avg(c(col)).over(w), col, w, n))
    return df


def with_rolling_std(df, col, n, out, keys=("symbol",), order="date", scale=1.0, offset=0,
                     ddof=1):
    """Rolling std over ``n`` rows ending ``offset`` rows back (W-09, W-12, W-18, W-20)."""
    w = rolling(keys, order, n, offset)
    std = F.stddev_samp(c(col)) if ddof == 1 else F.stddev_pop(c(col))
    return df.withColumn(out, min_periods(std.over(w) * scale, col, w, n))


def with_macd(df, col="close", keys=("symbol",), order="date"):
    """W-04 / W-05: ema_12, ema_26, macd, macd_signal (EMA9 of macd), macd_histogram.

    The three EMAs share one block column (the smallest safe block), so their
    windows share one sort."""
    blk = min(block_rows(s) for s in (12, 26, 9))
    df = with_blocks(df, blk, "_ema_blk", keys, order)
    df = with_ema(df, col, 12, "ema_12", keys, order, blk, "_ema_blk")
    df = with_ema(df, col, 26, "ema_26", keys, order, blk, "_ema_blk")
    df = df.withColumn("macd", F.col("ema_12") - F.col("ema_26"))
    df = with_ema(df, "macd", 9, "macd_signal", keys, order, blk, "_ema_blk")
    return df.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).drop("_ema_blk", "_ema_blk_row")


def with_rsi(df, col="close", n=14, keys=("symbol",), order="date", out="rsi"):
    """W-06: RSI with simple rolling means of gains and losses.

    The first diff is null and counts as 0 (reference ``where``), so RSI starts
    at row n.  loss = 0 and gain > 0 gives 100; both 0 gives null (Q-08 kept).
    """
    w = series_window(keys, order)
    delta = c(col) - F.lag(c(col)).over(w)
    d = df.withColumn("_delta", delta)
    gain = F.when(F.col("_delta") > 0, F.col("_delta")).otherwise(F.lit(0.0))
    loss = F.when(F.col("_delta") < 0, -F.col("_delta")).otherwise(F.lit(0.0))
    rw = rolling(keys, order, n)
    full = F.count(F.lit(1)).over(rw) == n
    d = d.withColumn("_gain", F.when(full, F.avg(gain).over(rw))) \
         .withColumn("_loss", F.when(full, F.avg(loss).over(rw)))
    rsi = (F.when(F.col("_loss") > 0, 100 - 100 / (1 + F.col("_gain") / F.col("_loss")))
            .when(F.col("_gain") > 0, F.lit(100.0)))
    return d.withColumn(out, rsi).drop("_delta", "_gain", "_loss")


def with_bollinger(df, col="close", n=20, k=2.0, keys=("symbol",), order="date"):
    """W-07: middle = SMA20, upper/lower = middle +- 2 sample std, width."""
    w = rolling(keys, order, n)
    mid = min_periods(F.avg(c(col)).over(w), col, w, n)
    sd = min_periods(F.stddev_samp(c(col)).over(w), col, w, n)
    return (df.withColumn("bb_middle", mid).withColumn("_bbsd", sd)
              .withColumn("bb_upper", F.col("bb_middle") + F.col("_bbsd") * k)
              .withColumn("bb_lower", F.col("bb_middle") - F.col("_bbsd") * k)
              .withColumn("bb_width", F.col("bb_upper") - F.col("bb_lower")).drop("_bbsd"))


def with_volume_sma(df, col="volume", n=20, keys=("symbol",), order="date"):
    """W-08: volume SMA20 and volume / SMA ratio."""
    w = rolling(keys, order, n)
    df = df.withColumn("volume_sma", min_periods(F.avg(c(col)).over(w), col, w, n))
    return df.withColumn("volume_ratio", safe_div(c(col), "volume_sma"))


def with_volatility(df, col="returns", n=30, keys=("symbol",), order="date"):
    """W-09: rolling std * sqrt(252); 'volatility_garch' is the same un-annualised (no GARCH fit)."""
    df = with_rolling_std(df, col, n, "volatility", keys, order, scale=SQRT_YEAR)
    return with_rolling_std(df, col, n, "volatility_garch", keys, order)


def technical_indicators(bars: DataFrame, keys=("symbol",), order="date") -> DataFrame:
    """S-23 / W-03..W-09: the full indicator row per (symbol, date).  The rolling windows share the sort
    by date; the moving averages by blocks come last, on one sort by block and date."""
    from tickframe.operators.returns import with_returns
    d = with_returns(bars.select(*keys, order, "close", "volume"), "close", keys, order)
    d = with_sma(d, "close", (20, 50), keys, order)
    d = with_rsi(d, "close", 14, keys, order)
    d = with_bollinger(d, "close", 20, 2.0, keys, order)
    d = with_volume_sma(d, "volume", 20, keys, order)
    d = with_volatility(d, "returns", 30, keys, order)
    return with_macd(d, "close", keys, order)


def rolling_portfolio_metrics(pr: DataFrame, keys=("portfolio_name",), col="r", n=30,
                              order="date") -> DataFrame:
    """W-10 / W-13 / W-14: rolling Sharpe (rf 0, ddof 1), rolling vol, rolling VaR 5% / 1%;
    rows where any is null are dropped (W-14)."""
    w = rolling(keys, order, n)
    full = F.count(c(col)).over(w) == n
    mean, sd = F.avg(c(col)).over(w), F.stddev_samp(c(col)).over(w)
    d = pr.select(*keys, order, F.when(full, safe_div(mean, sd) * SQRT_YEAR).alias("rolling_sharpe"),
                  F.when(full, sd * SQRT_YEAR).alias("rolling_volatility"),
                  F.when(full, F.percentile(c(col), 0.05).over(w)).alias("rolling_var_95"),
                  F.when(full, F.percentile(c(col), 0.01).over(w)).alias("rolling_var_99"))
    return d.dropna(subset=["rolling_sharpe", "rolling_volatility", "rolling_var_95", "rolling_var_99"])


def prior_window_metrics(pr: DataFrame, keys=("portfolio_name",), col="r", n=30,
                         order="date") -> DataFrame:
    """W-11 / W-12: the n rows *before* the current one, population std;
    Sharpe only where std > 0 (rows with std = 0 are dropped from the Sharpe chart)."""
    w = rolling(keys, order, n, offset=1)
    full = F.count(c(col)).over(w) == n
    sd = F.stddev_pop(c(col)).over(w)
    d = pr.select(*keys, order, F.when(full, F.avg(c(col)).over(w)).alias("_m"),
                  F.when(full, sd).alias("_sd"))
    d = d.filter(F.col("_sd").isNotNull())
    return d.select(*keys, order, F.when(F.col("_sd") > 0, F.col("_m") / F.col("_sd") * SQRT_YEAR)
                    .alias("prior_sharpe"), (F.col("_sd") * SQRT_YEAR).alias("prior_volatility"))


def with_lags(df, col="returns", lags=(1, 5, 10, 20), keys=("symbol",), order="date"):
    """W-17 lag features and W-18 lagged rolling vol (std over k rows, shifted 1).

    Q-06 fixed: k = 1 would be the std of one value (always null) and make a
    later ``dropna`` remove every row, so no vol column is made for k = 1.
    """
    w = series_window(keys, order)
    for k in lags:
        df = df.withColumn(f"returns_lag_{k}", F.lag(c(col), k).over(w))
        if k > 1:
            df = with_rolling_std(df, col, k, f"volatility_lag_{k}", keys, order, offset=1)
    return df


def with_growth(df, col="r", keys=("portfolio_name",), order="date"):
    """W-15 / W-16: growth = prod(1+r), cumulative return, drawdown, cumulative sum."""
    from tickframe.operators.risk import with_drawdown
    d = with_drawdown(df, list(keys), col, order)
    w = series_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return (d.withColumn("cumulative_return", F.col("growth") - 1)
             .withColumn("cumulative_sum", F.sum(c(col)).over(w)))


def vol_profile(df, col="returns", keys=("symbol",), order="date") -> DataFrame:
    """W-21: per key, mean over time of rolling std 5/20/60 and std of the rolling-20 std."""
    for n in (5, 20, 60):
        df = with_rolling_std(df, col, n, f"_v{n}", keys, order)
    return df.groupBy(*keys).agg(F.avg("_v5").alias("volatility_5d"), F.avg("_v20").alias("volatility_20d"),
                                 F.avg("_v60").alias("volatility_60d"),
                                 F.stddev_samp("_v20").alias("volatility_of_volatility"))


def with_position_change(df, signal="signal", keys=("symbol",), order="date", out="position_change"):
    """W-22: change of position vs the previous row; 0 on the first row."""
    w = series_window(keys, order)
    return df.withColumn(out, F.coalesce(c(signal) - F.lag(c(signal)).over(w), F.lit(0)))


def range_return(df, col="close", keys=("symbol",), order="date", start=None, end=None):
    """W-23: last / first value - 1 over a date range (max_by / min_by, partial aggregates)."""
    if start is not None:
        df = df.filter(F.col(order) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(order) <= F.lit(end).cast("date"))
    return df.groupBy(*keys).agg(
        F.min(order).alias("first_date"), F.max(order).alias("last_date"),
        F.min_by(c(col), order).alias("first_close"), F.max_by(c(col), order).alias("last_close"),
    ).withColumn("range_return", safe_div("last_close", "first_close") - 1)
