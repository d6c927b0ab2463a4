"""Portfolio operators: weights (J-04, F-24), daily portfolio returns and the
flagship analytics (R-13..R-17), backtest (R-18), comparison (R-19).

Sparse formulation of the reference's pivot → ffill → bfill → pct_change:
after forward and backward filling, a symbol's return on a calendar date
where it has no bar is exactly 0, and on a date where it has a bar it is
its own close over its own previous bar (its first bar gives 0).  So the
portfolio return is a plain ``groupBy(portfolio, date).sum(w * r)`` over
the bars that exist -- the date x symbol panel is never densified.  The
DuckDB oracle keeps the literal densified version, so each checks the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.exprs import (RISK_FREE, SQRT_YEAR, TRADING_DAYS, c, safe_div)
from tickframe.operators.returns import with_returns
from tickframe.operators.risk import annualized, with_drawdown

PKEY = "portfolio_name"


def in_range(df: DataFrame, start=None, end=None, date: str = "date") -> DataFrame:
    if start is not None:
        df = df.filter(F.col(date) >= F.to_date(F.lit(start)))
    if end is not None:
        df = df.filter(F.col(date) <= F.to_date(F.lit(end)))
    return df


def normalised_weights(holdings: DataFrame, available_symbols: DataFrame) -> DataFrame:
    """J-04: weights of symbols that have data, renormalised to 1; equal weights if they sum to 0.

    ``holdings``: (portfolio_name, symbol, weight); result adds ``w``.
    """
    avail = holdings.join(available_symbols, "symbol", "left_semi")
    p = Window.partitionBy(PKEY)
    tot = F.sum(F.coalesce("weight", F.lit(0.0))).over(p)
    return avail.withColumn(
        "w", F.when(tot > 0, F.coalesce("weight", F.lit(0.0)) / tot)
              .otherwise(1.0 / F.count(F.lit(1)).over(p)))


def held_returns(bars: DataFrame, holdings: DataFrame, start=None, end=None,
                 price: str = "close") -> DataFrame:
    """(portfolio_name, symbol, date, r, weight, w) for every existing bar of a held symbol.

    Returns are computed once per symbol (before fanning out to the portfolios
    that hold it).  ``w`` is the weight renormalised over the symbols that have
    data in range (J-04), on the holdings (a few rows per portfolio) before they meet the bars.
    """
    h = holdings.select(PKEY, "symbol", "weight")
    px = in_range(bars.select("symbol", "date", price), start, end).join(
        h.select("symbol").distinct(), "symbol", "left_semi")
    px = with_returns(px, price, out="r", ffill=False)
    return px.join(normalised_weights(h, px.select("symbol").distinct()), "symbol")


def portfolio_returns(bars: DataFrame, holdings: DataFrame, start=None, end=None,
                      price: str = "close", held: DataFrame | None = None) -> DataFrame:
    """(portfolio_name, date, r): weighted return on the union calendar, first date dropped."""
    h = held if held is not None else held_returns(bars, holdings, start, end, price)
    daily = h.groupBy(PKEY, "date").agg(F.sum(F.col("w") * F.coalesce("r", F.lit(0.0))).alias("r"))
    first = F.min("date").over(Window.partitionBy(PKEY))
    return daily.withColumn("_first", first).filter(F.col("date") > F.col("_first")).drop("_first")


def portfolio_analytics(bars: DataFrame, holdings: DataFrame, start=None, end=None,
                        rf: float = RISK_FREE, price: str = "close") -> DataFrame:
    """R-17: every portfolio's risk, performance, drawdown and volatility block in one job.

    Columns: portfolio_name, n_symbols, n_days, total_return, annualized_return,
    sharpe_ratio, sortino_ratio (service form, Q-01), var_95, cvar_95,
    max_drawdown, avg_drawdown, drawdown_frequency, portfolio_volatility,
    weighted_avg_volatility, diversification_ratio.
    """
    h = held_returns(bars, holdings, start, end, price)
    pr = portfolio_returns(bars, holdings, held=h)
    d = with_drawdown(pr, [PKEY], "r")
    d = d.withColumn("_var", F.percentile("r", 0.05).over(Window.partitionBy(PKEY)))
    ex_mean = F.avg("r") - rf / TRADING_DAYS
    std = F.stddev_samp("r")
    down = F.stddev_samp(F.when(F.col("r") < 0, F.col("r")))
    m = d.groupBy(PKEY).agg(
        F.count("r").cast("bigint").alias("n_days"),
        (F.product(1 + F.col("r")) - 1).alias("total_return"),
        safe_div(ex_mean, std).alias("_sr"),
        F.when(down > 0, ex_mean / down * SQRT_YEAR).otherwise(F.lit(0.0)).alias("sortino_ratio"),
        F.first("_var").alias("var_95"),
        F.avg(F.when(F.col("r") <= F.col("_var"), F.col("r"))).alias("cvar_95"),
        F.min("drawdown").alias("max_drawdown"),
        F.avg(F.when(F.col("drawdown") < 0, F.col("drawdown"))).alias("avg_drawdown"),
        (F.count_if(F.col("drawdown") < 0) / F.count("r")).alias("drawdown_frequency"),
        (std * SQRT_YEAR).alias("portfolio_volatility"))
    # Per-asset volatility over the portfolio calendar: zero returns on dates without a
    # bar contribute nothing to the sums, so sums over existing bars + the calendar
    # length give the dense sample std exactly.
    n = m.select(PKEY, "n_days")
    asset = (h.groupBy(PKEY, "symbol", "w")
             .agg(F.sum(F.coalesce("r", F.lit(0.0))).alias("s1"),
                  F.sum(F.coalesce(F.col("r") * F.col("r"), F.lit(0.0))).alias("s2"))
             .join(n, PKEY)
             .withColumn("vol", F.sqrt(F.greatest(F.lit(0.0), safe_div(
                 F.col("s2") - F.col("s1") * F.col("s1") / F.col("n_days"), F.col("n_days") - 1)))
                 * SQRT_YEAR))
    wav = asset.groupBy(PKEY).agg(F.count("symbol").cast("bigint").alias("n_symbols"),
                                  F.sum(F.col("w") * F.col("vol")).alias("weighted_avg_volatility"))
    out = m.join(wav, PKEY)
    return out.select(
        PKEY, "n_symbols", "n_days", "total_return",
        annualized(F.col("total_return"), F.col("n_days")).alias("annualized_return"),
        (F.col("_sr") * SQRT_YEAR).alias("sharpe_ratio"), "sortino_ratio", "var_95", "cvar_95",
        "max_drawdown", "avg_drawdown", "drawdown_frequency", "portfolio_volatility",
        "weighted_avg_volatility",
        F.when(F.col("portfolio_volatility") > 0,
               F.col("weighted_avg_volatility") / F.col("portfolio_volatility"))
         .otherwise(F.lit(1.0)).alias("diversification_ratio"))


# first day of the holding period that a date falls in
REBALANCE = {"daily": lambda d: F.col(d), "weekly": lambda d: F.trunc(d, "week"), "monthly": lambda d: F.trunc(d, "month"),
             "quarterly": lambda d: F.trunc(d, "quarter"), "yearly": lambda d: F.trunc(d, "year"), "never": lambda d: F.lit("1900-01-01").cast("date")}


def value_path(bars: DataFrame, holdings: DataFrame, start=None, end=None, initial: float = 10000.0, price: str = "close",
               rebalance: str = "daily") -> DataFrame:
    """R-18: (portfolio_name, date, value) on every portfolio's union calendar, the first date at the initial value.

    At the start of a period (``rebalance``: daily, weekly, monthly, quarterly, yearly, never) the value is dealt by the stored
    weights, not renormalised; inside it holdings drift with their prices:
    V_t = V_0 (1 + sum_s w_s (G_s(t) - 1)), G_s the growth of symbol s since the period began.  Sparse: G_s moves only on days with a
    bar, so a day's level is a running sum of w_s dG_s over the bars that exist, and the value carried into a period is the product
    of the growths of the periods before it."""
    h = held_returns(bars, holdings, start, end, price).withColumn("_p", REBALANCE[rebalance]("date"))
    own = Window.partitionBy(PKEY, "symbol", "_p").orderBy("date")
    grown = F.product(1 + F.coalesce("r", F.lit(0.0))).over(own.rowsBetween(Window.unboundedPreceding, 0))
    moved = h.withColumn("_g", grown).withColumn("_dg", F.col("_g") - F.lag("_g", 1, 1.0).over(own))
    daily = moved.groupBy(PKEY, "_p", "date").agg(F.sum(F.col("weight") * F.col("_dg")).alias("_d"))
    level = 1 + F.sum("_d").over(Window.partitionBy(PKEY, "_p").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    daily = daily.withColumn("_level", level)
    # one row per portfolio and period
    ends = daily.groupBy(PKEY, "_p").agg(F.max_by("_level", "date").alias("_growth"))
    before = F.product("_growth").over(Window.partitionBy(PKEY).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(PKEY, "_p", (initial * F.coalesce(before, F.lit(1.0))).alias("_start"))
    return daily.join(ends, [PKEY, "_p"]).select(PKEY, "date", (F.col("_start") * F.col("_level")).alias("value"))


def backtest(bars: DataFrame, holdings: DataFrame, start=None, end=None, initial: float = 10000.0,
             price: str = "close", rebalance: str = "daily") -> DataFrame:
    """R-18 summary of ``value_path`` (Q-04: the reference ignores its rebalance argument and always deals daily).

    Weights are the stored ones, not renormalised (reference), matched to symbols
    by key rather than by position (Q-03 fixed).  Summary per portfolio:
    total_return_pct, annualized_return_pct (exponent 252 / number of calendar
    dates including the first), max_value / min_value (the initial value is part
    of the path), final_value.
    """
    path = value_path(bars, holdings, start, end, initial, price, rebalance)
    s = path.groupBy(PKEY).agg(F.count(F.lit(1)).alias("n_dates"), F.max_by("value", "date").alias("fv"), F.max("value").alias("mx"), F.min("value").alias("mn"))
    tr = F.col("fv") / initial - 1
    return s.select(PKEY, (tr * 100).alias("total_return_pct"),
                    ((F.when(1 + tr > 0, F.pow(1 + tr, TRADING_DAYS / F.col("n_dates"))) - 1) * 100)
                    .alias("annualized_return_pct"), F.col("mx").alias("max_value"), F.col("mn").alias("min_value"), F.col("fv").alias("final_value"))


def risk_attribution(bars: DataFrame, holdings: DataFrame, start=None, end=None,
                     price: str = "close") -> DataFrame:
    """R-12: sigma_p = sqrt(w' S w), marginal = (S w) / sigma_p, contribution = w * marginal,
    percent = contribution / sigma_p * 100.

    (S w)_a = sum_b cov(a, b) w_b = cov(r_a, p) with p the portfolio return, so the
    N x N covariance is never formed: one join of each asset's returns with its
    portfolio's series.  Sparse sums again: dates where the asset has no bar add 0.
    """
    h = held_returns(bars, holdings, start, end, price)
    pr = portfolio_returns(bars, holdings, held=h)
    ps = pr.groupBy(PKEY).agg(F.count("r").alias("n"), F.sum("r").alias("sp"),
                              F.stddev_samp("r").alias("sigma_p"))
    # the first calendar date only holds zero asset returns, so dropping it changes nothing
    cross = (h.join(pr.withColumnRenamed("r", "p"), [PKEY, "date"], "left")
             .groupBy(PKEY, "symbol", "w")
             .agg(F.sum(F.coalesce("r", F.lit(0.0))).alias("sa"),
                  F.sum(F.coalesce(F.col("r") * F.col("p"), F.lit(0.0))).alias("sap")))
    j = cross.join(ps, PKEY)
    cov_ap = (F.col("sap") - F.col("sa") * F.col("sp") / F.col("n")) / (F.col("n") - 1)
    marginal = safe_div(cov_ap, F.col("sigma_p"))
    return j.select(PKEY, "symbol", F.col("w").alias("weight"), "sigma_p",
                    marginal.alias("marginal_risk_contribution"),
                    (F.col("w") * marginal).alias("risk_contribution"),
                    (safe_div(F.col("w") * marginal, F.col("sigma_p")) * 100).alias("risk_contribution_pct"))


def _complete_date_returns(bars: DataFrame, groups: DataFrame | None, price: str, start=None, end=None):
    """Per (group, symbol, date) returns on dates where every symbol of the group has one.

    ``groups``: (portfolio_name, symbol) symbol lists; None = one group of all symbols
    named 'main_portfolio'.  Symbols without any data are left out of the group, as the
    reference skips them.  Completeness is a count per (group, date) compared with the
    group size -- no n-way join.
    """
    px = in_range(bars.select("symbol", "date", price), start, end)
    d = with_returns(px, price, out="r", ffill=False).filter(F.col("r").isNotNull())
    if groups is None:
        groups = px.select(F.lit("main_portfolio").alias(PKEY), "symbol").distinct()
    g = groups.select(PKEY, "symbol").join(px.select("symbol").distinct(), "symbol", "left_semi")
    size = g.groupBy(PKEY).agg(F.count("symbol").alias("n"))
    d = d.join(g, "symbol")
    per = d.groupBy(PKEY, "date").agg(F.count("r").alias("k"))
    full = per.join(size, PKEY).filter(F.col("k") == F.col("n")).select(PKEY, "date", "n")
    return d.join(full, [PKEY, "date"])


def equal_weight_returns(bars: DataFrame, groups: DataFrame | None = None, price: str = "close",
                         start=None, end=None) -> DataFrame:
    """R-21 / J-02 / A-11: (portfolio_name, date, r) = mean return over the group's symbols
    on dates where every one of them has a return."""
    d = _complete_date_returns(bars, groups, price, start, end)
    return d.groupBy(PKEY, "date").agg(F.avg("r").alias("r"))


def equal_weight_panel(bars: DataFrame, groups: DataFrame | None = None, price: str = "close",
                       total_value: float = 100000.0) -> DataFrame:
    """R-22: (portfolio_name, date, symbol, weight 1/n, returns, value total/n) on complete dates."""
    d = _complete_date_returns(bars, groups, price)
    return d.select(PKEY, "date", "symbol", (1.0 / F.col("n")).alias("weight"), F.col("r").alias("returns"),
                    (total_value / F.col("n")).alias("value"))
