"""Risk and performance queries R-01 .. R-24 (besides the R-17 / R-18 flagship)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.functions.exprs import SQRT_YEAR, safe_div
from tickframe.operators import portfolio as P
from tickframe.operators import risk as R
from tickframe.operators import screen as S
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, oround, rounded
from tickframe.plans.oracle_blocks import DENSE_PORTFOLIO
from tickframe.plans.portfolio_q import R17_SQL
from tickframe.plans.views_sql import with_views

PR = "WITH " + DENSE_PORTFOLIO


def _metrics_sql(src="pr", k="portfolio_name"):
    return f"""
sv AS (SELECT {k}, QUANTILE_CONT(r, 0.05) AS v95, QUANTILE_CONT(r, 0.01) AS v99 FROM {src} GROUP BY {k}),
sd AS (SELECT {k}, date, r, PRODUCT(1 + r) OVER (PARTITION BY {k} ORDER BY date
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM {src}),
sdd AS (SELECT *, (g - MAX(g) OVER w) / NULLIF(MAX(g) OVER w, 0) AS dd FROM sd
        WINDOW w AS (PARTITION BY {k} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
met AS (SELECT sdd.{k}, COUNT(r) AS n,
    (AVG(r) - 0.02 / 252) / NULLIF(STDDEV_SAMP(r), 0) * SQRT(252) AS sharpe_ratio,
    (AVG(r) - 0.02 / 252) / NULLIF(STDDEV_SAMP(CASE WHEN r < 0 THEN r END) * SQRT(252), 0) * SQRT(252) AS sortino_ratio,
    MIN(dd) AS max_drawdown, STDDEV_SAMP(r) * SQRT(252) AS volatility, AVG(r) * 252 AS annual_return,
    ANY_VALUE(v95) AS var_95, AVG(CASE WHEN r <= v95 THEN r END) AS cvar_95,
    ANY_VALUE(v99) AS var_99, AVG(CASE WHEN r <= v99 THEN r END) AS cvar_99,
    AVG(r) * 252 / NULLIF(ABS(MIN(dd)), 0) AS calmar_ratio
  FROM sdd JOIN sv ON sdd.{k} = sv.{k} GROUP BY sdd.{k})"""


def _bench_sql(src="pr", k="portfolio_name"):
    return f"""
bj AS (SELECT s.{k}, s.r, b.r AS br FROM {src} s JOIN benchmark_returns b ON s.date = b.date
       WHERE s.r IS NOT NULL AND b.r IS NOT NULL),
bm AS (SELECT {k}, COALESCE(COVAR_SAMP(r, br) / NULLIF(VAR_SAMP(br), 0), 0) AS beta,
    STDDEV_SAMP(r - br) * SQRT(252) AS tracking_error,
    CASE WHEN STDDEV_SAMP(r - br) > 0 THEN AVG(r - br) / STDDEV_SAMP(r - br) * SQRT(252) ELSE 0 END AS information_ratio,
    AVG(r - br) * 252 AS excess_return, STDDEV_SAMP(r - br) * SQRT(252) AS excess_volatility
  FROM bj GROUP BY {k})"""


MET_COLS = ["sharpe_ratio", "sortino_ratio", "max_drawdown", "volatility", "annual_return", "var_95",
            "cvar_95", "var_99", "cvar_99", "calmar_ratio"]
BM_COLS = ["beta", "tracking_error", "information_ratio", "excess_return", "excess_volatility"]


def _pr(v):
    return P.portfolio_returns(v.bars, v.holdings)


def _single(key, cols, oracle_cols=None, bench=False):
    """Register a query returning a subset of the calculator metrics per portfolio."""
    ocols = oracle_cols or cols
    if bench:
        sql = with_views(["bars", "holdings", "benchmark_returns"], PR + "," + _bench_sql() +
                         f"\nSELECT portfolio_name, {', '.join(ocols)} FROM bm")
    else:
        sql = with_views(["bars", "holdings"], PR + "," + _metrics_sql() +
                         f"\nSELECT portfolio_name, {', '.join(ocols)} FROM met")

    @query(key, oround(sql, cols))
    def fn(spark, sf):
        v = Views(spark, sf)
        if bench:
            m = R.benchmark_metrics(_pr(v), v.benchmark, ["portfolio_name"])
        else:
            m = R.series_metrics(_pr(v), ["portfolio_name"])
        return rounded(m.select("portfolio_name", *cols))
    return fn


_single("r01_sharpe", ["sharpe_ratio"])
_single("r02_sortino", ["sortino_ratio"])
_single("r03_calmar", ["calmar_ratio"])
_single("r04_max_drawdown", ["max_drawdown"])
_single("r05_value_at_risk", ["var_95", "var_99"])
_single("r06_conditional_var", ["cvar_95", "cvar_99"])
_single("r07_beta", ["beta"], bench=True)
_single("r08_tracking_error", ["tracking_error"], bench=True)
_single("r09_information_ratio", ["information_ratio"], bench=True)


@query("r10_rolling_volatility", oround(with_views(["bars", "holdings"], PR + """
SELECT portfolio_name, date, CASE WHEN COUNT(r) OVER w = 30 THEN STDDEV_SAMP(r) OVER w * SQRT(252) END AS volatility
FROM pr WINDOW w AS (PARTITION BY portfolio_name ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""),
    ["volatility"]))
def r10(spark, sf):
    from tickframe.operators.windows import with_rolling_std
    d = with_rolling_std(_pr(Views(spark, sf)), "r", 30, "volatility", ["portfolio_name"], scale=SQRT_YEAR)
    return rounded(d.select("portfolio_name", "date", "volatility"))


@query("r11_risk_metrics", oround(with_views(["bars", "holdings", "benchmark_returns"],
    PR + "," + _metrics_sql() + "," + _bench_sql() + f"""
SELECT met.portfolio_name, met.n, {', '.join(MET_COLS)}, {', '.join(BM_COLS)}
FROM met LEFT JOIN bm ON met.portfolio_name = bm.portfolio_name"""), MET_COLS + BM_COLS))
def r11(spark, sf):
    v = Views(spark, sf)
    pr = _pr(v)
    m = R.series_metrics(pr, ["portfolio_name"])
    b = R.benchmark_metrics(pr, v.benchmark, ["portfolio_name"])
    return rounded(m.join(b, "portfolio_name", "left").select("portfolio_name", "n", *MET_COLS, *BM_COLS))


RA_COLS = ["weight", "sigma_p", "marginal_risk_contribution", "risk_contribution", "risk_contribution_pct"]


@query("r12_risk_attribution", oround(with_views(["bars", "holdings"], PR + """,
c AS (SELECT a.portfolio_name, a.symbol, ANY_VALUE(a.w) AS weight, COVAR_SAMP(a.r, p.r) AS cov_ap
      FROM rets a JOIN pr p ON a.portfolio_name = p.portfolio_name AND a.date = p.date
      WHERE a.r IS NOT NULL GROUP BY 1, 2),
s AS (SELECT portfolio_name, STDDEV_SAMP(r) AS sigma_p FROM pr GROUP BY 1)
SELECT c.portfolio_name, symbol, weight, sigma_p, cov_ap / NULLIF(sigma_p, 0) AS marginal_risk_contribution,
       weight * cov_ap / NULLIF(sigma_p, 0) AS risk_contribution,
       weight * cov_ap / NULLIF(sigma_p, 0) / NULLIF(sigma_p, 0) * 100 AS risk_contribution_pct
FROM c JOIN s ON c.portfolio_name = s.portfolio_name"""), RA_COLS))
def r12(spark, sf):
    v = Views(spark, sf)
    return rounded(P.risk_attribution(v.bars, v.holdings))


def _r17(v):
    return P.portfolio_analytics(v.bars, v.holdings)


def _subset(key, cols, extra_sql_cols=None):
    @query(key, oround(f"SELECT portfolio_name, {', '.join(cols)} FROM ({R17_SQL}) x", cols))
    def fn(spark, sf):
        return rounded(_r17(Views(spark, sf)).select("portfolio_name", *cols))
    return fn


_subset("r14_performance_block", ["total_return", "annualized_return", "sharpe_ratio", "sortino_ratio"])
_subset("r15_drawdown_block", ["max_drawdown", "avg_drawdown", "drawdown_frequency"])
_subset("r16_volatility_block", ["portfolio_volatility", "weighted_avg_volatility", "diversification_ratio"])
_subset("r24_risk_summary", ["sharpe_ratio", "portfolio_volatility", "var_95", "max_drawdown"])


R13_COLS = ["var_95", "cvar_95", "beta", "max_drawdown"]


@query("r13_service_risk_block", oround(with_views(["bars", "holdings", "benchmark_returns"], PR + "," + _bench_sql() + f""",
r17 AS ({R17_SQL})
SELECT r17.portfolio_name, var_95, cvar_95, bm.beta, max_drawdown FROM r17 LEFT JOIN bm
ON r17.portfolio_name = bm.portfolio_name"""), R13_COLS))
def r13(spark, sf):
    """Q-19 fixed: beta from the benchmark (R-07) instead of the constant 1.0."""
    v = Views(spark, sf)
    b = R.benchmark_metrics(_pr(v), v.benchmark, ["portfolio_name"]).select("portfolio_name", "beta")
    return rounded(_r17(v).join(b, "portfolio_name", "left").select("portfolio_name", *R13_COLS))


@query("r19_compare_portfolios", oround(f"""
WITH a AS ({R17_SQL})
SELECT MAX(annualized_return) AS best_return, ARG_MAX(portfolio_name, annualized_return) AS best_return_portfolio,
       MAX(sharpe_ratio) AS best_sharpe, ARG_MAX(portfolio_name, sharpe_ratio) AS best_sharpe_portfolio,
       MIN(portfolio_volatility) AS lowest_volatility,
       ARG_MIN(portfolio_name, portfolio_volatility) AS lowest_volatility_portfolio,
       MAX(max_drawdown) AS lowest_drawdown, ARG_MAX(portfolio_name, max_drawdown) AS lowest_drawdown_portfolio,
       CAST(COUNT(*) AS BIGINT) AS n_portfolios FROM a""",
    ["best_return", "best_sharpe", "lowest_volatility", "lowest_drawdown"]))
def r19(spark, sf):
    a = _r17(Views(spark, sf))
    return rounded(a.agg(
        F.max("annualized_return").alias("best_return"),
        F.max_by("portfolio_name", "annualized_return").alias("best_return_portfolio"),
        F.max("sharpe_ratio").alias("best_sharpe"),
        F.max_by("portfolio_name", "sharpe_ratio").alias("best_sharpe_portfolio"),
        F.min("portfolio_volatility").alias("lowest_volatility"),
        F.min_by("portfolio_name", "portfolio_volatility").alias("lowest_volatility_portfolio"),
        F.max("max_drawdown").alias("lowest_drawdown"),
        F.max_by("portfolio_name", "max_drawdown").alias("lowest_drawdown_portfolio"),
        F.count("*").cast("bigint").alias("n_portfolios")))


@query("r19_rank_portfolios", oround(f"""
WITH a AS ({R17_SQL})
SELECT portfolio_name, sharpe_ratio,
       CAST(RANK() OVER (ORDER BY sharpe_ratio DESC NULLS LAST) AS BIGINT) AS sharpe_rank,
       CAST(RANK() OVER (ORDER BY portfolio_volatility ASC NULLS LAST) AS BIGINT) AS volatility_rank FROM a""",
    ["sharpe_ratio"]))
def r19_rank(spark, sf):
    a = rounded(_r17(Views(spark, sf)))
    # one row per portfolio: the ranking windows run over #portfolios rows
    return a.select("portfolio_name", "sharpe_ratio",
                    F.rank().over(Window.orderBy(F.desc_nulls_last("sharpe_ratio"))).cast("bigint").alias("sharpe_rank"),
                    F.rank().over(Window.orderBy(F.asc_nulls_last("portfolio_volatility"))).cast("bigint")
                    .alias("volatility_rank"))


R20_COLS = ["total_return", "annualized_return", "volatility", "sharpe_ratio", "max_drawdown", "beta", "alpha"]


@query("r20_performance_statistics", oround(with_views(["bars", "holdings", "benchmark_returns"], PR + "," + _bench_sql() + f""",
r17 AS ({R17_SQL})
SELECT r17.portfolio_name, total_return, annualized_return, portfolio_volatility AS volatility, sharpe_ratio,
       max_drawdown, bm.beta, total_return - (0.05 + bm.beta * (0.10 - 0.05)) AS alpha
FROM r17 LEFT JOIN bm ON r17.portfolio_name = bm.portfolio_name"""), R20_COLS))
def r20(spark, sf):
    """alpha = total return - (rf + beta * (market - rf)) with rf 5%, market 10% (reference constants);
    Q-20 fixed: volatility is the portfolio volatility."""
    v = Views(spark, sf)
    b = R.benchmark_metrics(_pr(v), v.benchmark, ["portfolio_name"]).select("portfolio_name", "beta")
    a = _r17(v).join(b, "portfolio_name", "left")
    return rounded(a.select("portfolio_name", "total_return", "annualized_return",
                            F.col("portfolio_volatility").alias("volatility"), "sharpe_ratio", "max_drawdown",
                            "beta", (F.col("total_return") - (0.05 + F.col("beta") * (0.10 - 0.05))).alias("alpha")))


EW_SQL = """
WITH r AS (SELECT symbol, date, close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS r FROM bars),
g AS (SELECT DISTINCT h.portfolio_name, h.symbol FROM holdings h WHERE h.symbol IN (SELECT symbol FROM bars)),
n AS (SELECT portfolio_name, COUNT(*) AS n FROM g GROUP BY 1),
gr AS (SELECT g.portfolio_name, r.symbol, r.date, r.r FROM r JOIN g ON r.symbol = g.symbol WHERE r.r IS NOT NULL),
full_dates AS (SELECT gr.portfolio_name, date, ANY_VALUE(n.n) AS n FROM gr JOIN n ON gr.portfolio_name = n.portfolio_name
               GROUP BY 1, 2 HAVING COUNT(*) = ANY_VALUE(n.n)),
ew AS (SELECT gr.portfolio_name, gr.date, AVG(r) AS r FROM gr JOIN full_dates f
       ON gr.portfolio_name = f.portfolio_name AND gr.date = f.date GROUP BY 1, 2)"""


@query("r21_equal_weight_risk", oround(with_views(["bars", "holdings"], EW_SQL + "," + _metrics_sql("ew") +
                                            f"\nSELECT portfolio_name, n, {', '.join(MET_COLS)} FROM met"), MET_COLS))
def r21(spark, sf):
    """Equal-weight risk row per symbol list; each portfolio's holdings is one list."""
    v = Views(spark, sf)
    ew = P.equal_weight_returns(v.bars, v.holdings)
    return rounded(R.series_metrics(ew, ["portfolio_name"]).select("portfolio_name", "n", *MET_COLS))


@query("r22_panel_expansion", oround(with_views(["bars", "holdings"], EW_SQL + """
SELECT gr.portfolio_name, gr.date, gr.symbol, 1.0 / f.n AS weight, gr.r AS returns, 100000.0 / f.n AS value
FROM gr JOIN full_dates f ON gr.portfolio_name = f.portfolio_name AND gr.date = f.date"""),
    ["weight", "returns", "value"]))
def r22(spark, sf):
    v = Views(spark, sf)
    return rounded(P.equal_weight_panel(v.bars, v.holdings))


@query("r23_portfolio_list", oround(with_views(["bars", "holdings"], f"""
WITH a AS ({R17_SQL}),
h AS (SELECT portfolio_name, STRING_AGG(printf('%s (%.1f%%)', symbol, weight * 100), ', ' ORDER BY pos) AS assets
      FROM holdings GROUP BY portfolio_name)
SELECT a.portfolio_name, total_return, COALESCE(printf('%.1f%%', total_return * 100), 'N/A') AS return_label,
       CASE WHEN sharpe_ratio >= 2 THEN 'excellent' WHEN sharpe_ratio >= 1 THEN 'good'
            WHEN sharpe_ratio >= 0.5 THEN 'average' WHEN sharpe_ratio >= 0 THEN 'poor' ELSE 'negative' END AS sharpe_band,
       h.assets FROM a JOIN h ON a.portfolio_name = h.portfolio_name"""), ["total_return"]))
def r23(spark, sf):
    """R-23: portfolio list with total return, its label (F-27), Sharpe band (F-12) and
    the asset label (F-18) built from the ordered holdings arrays."""
    v = Views(spark, sf)
    a = rounded(_r17(v))
    h = (v.holdings.groupBy("portfolio_name")
         .agg(F.array_sort(F.collect_list(F.struct("pos", "symbol", "weight"))).alias("hs"))
         .select("portfolio_name", S.asset_label(F.col("hs.symbol"), F.col("hs.weight")).alias("assets")))
    return a.join(h, "portfolio_name").select(
        "portfolio_name", "total_return", S.return_label("total_return").alias("return_label"),
        S.sharpe_band("sharpe_ratio").alias("sharpe_band"), "assets")
