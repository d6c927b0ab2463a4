"""Portfolio queries: R-17 flagship analytics, R-18 backtest, R-19 comparison, W-15 series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import portfolio as P
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, oround, rounded
from tickframe.plans.oracle_blocks import DENSE_PORTFOLIO
from tickframe.plans.views_sql import with_views

R17_COLS = ["total_return", "annualized_return", "sharpe_ratio", "sortino_ratio", "var_95",
            "cvar_95", "max_drawdown", "avg_drawdown", "drawdown_frequency",
            "portfolio_volatility", "weighted_avg_volatility", "diversification_ratio"]

R17_SQL = oround(with_views(["bars", "holdings"], "WITH " + DENSE_PORTFOLIO + """,
vr AS (SELECT portfolio_name, QUANTILE_CONT(r, 0.05) AS v FROM pr GROUP BY 1),
m AS (
  SELECT d.portfolio_name, COUNT(*) AS n_days, PRODUCT(1 + r) - 1 AS total_return,
         (AVG(r) - 0.02 / 252) / NULLIF(STDDEV_SAMP(r), 0) * SQRT(252) AS sharpe_ratio,
         CASE WHEN STDDEV_SAMP(CASE WHEN r < 0 THEN r END) > 0
              THEN (AVG(r) - 0.02 / 252) / STDDEV_SAMP(CASE WHEN r < 0 THEN r END) * SQRT(252)
              ELSE 0 END AS sortino_ratio,
         ANY_VALUE(v.v) AS var_95, AVG(CASE WHEN r <= v.v THEN r END) AS cvar_95,
         MIN(dd) AS max_drawdown, AVG(CASE WHEN dd < 0 THEN dd END) AS avg_drawdown,
         SUM(CASE WHEN dd < 0 THEN 1 ELSE 0 END) / COUNT(*) AS drawdown_frequency,
         STDDEV_SAMP(r) * SQRT(252) AS portfolio_volatility
  FROM dd d JOIN vr v ON d.portfolio_name = v.portfolio_name GROUP BY 1),
av AS (
  SELECT portfolio_name, COUNT(*) AS n_symbols, SUM(w * vol) AS weighted_avg_volatility
  FROM (SELECT portfolio_name, symbol, ANY_VALUE(w) AS w, STDDEV_SAMP(r) * SQRT(252) AS vol
        FROM rets WHERE r IS NOT NULL GROUP BY 1, 2) a GROUP BY 1)
SELECT m.portfolio_name, av.n_symbols, m.n_days, total_return,
       CASE WHEN 1 + total_return > 0 THEN POWER(1 + total_return, 252.0 / n_days) - 1 END AS annualized_return,
       sharpe_ratio, sortino_ratio, var_95, cvar_95, max_drawdown, avg_drawdown, drawdown_frequency,
       portfolio_volatility, weighted_avg_volatility,
       CASE WHEN portfolio_volatility > 0 THEN weighted_avg_volatility / portfolio_volatility ELSE 1 END
         AS diversification_ratio
FROM m JOIN av ON m.portfolio_name = av.portfolio_name"""), R17_COLS)


@query("r17_portfolio_analytics", R17_SQL)
def r17_portfolio_analytics(spark, sf_dir):
    v = Views(spark, sf_dir)
    return rounded(P.portfolio_analytics(v.bars, v.holdings))


R18_COLS = ["total_return_pct", "annualized_return_pct", "max_value", "min_value", "final_value"]
R18_SQL = oround(with_views(["bars", "holdings"], "WITH " + DENSE_PORTFOLIO + """,
praw AS (SELECT portfolio_name, date, SUM(weight * r) AS r FROM rets WHERE r IS NOT NULL GROUP BY 1, 2),
path AS (SELECT portfolio_name, date, 10000 * PRODUCT(1 + r) OVER (PARTITION BY portfolio_name ORDER BY date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM praw),
s AS (SELECT portfolio_name, ARG_MAX(value, date) AS fv, MAX(value) AS mx, MIN(value) AS mn FROM path GROUP BY 1),
nd AS (SELECT portfolio_name, COUNT(*) AS n_dates FROM cal GROUP BY 1)
SELECT nd.portfolio_name, (COALESCE(fv, 10000) / 10000 - 1) * 100 AS total_return_pct,
       (POWER(COALESCE(fv, 10000) / 10000, 252.0 / n_dates) - 1) * 100 AS annualized_return_pct,
       GREATEST(COALESCE(mx, 10000), 10000) AS max_value, LEAST(COALESCE(mn, 10000), 10000) AS min_value,
       COALESCE(fv, 10000) AS final_value
FROM nd LEFT JOIN s ON nd.portfolio_name = s.portfolio_name"""), R18_COLS)


@query("r18_backtest", R18_SQL)
def r18_backtest(spark, sf_dir):
    v = Views(spark, sf_dir)
    return rounded(P.backtest(v.bars, v.holdings))


def _path_sql(period: str) -> str:
    """Dense: every holding's growth since its period began, dealt by stored weights, periods chained."""
    return with_views(["bars", "holdings"], "WITH " + DENSE_PORTFOLIO + f""",
gr AS (SELECT portfolio_name, symbol, date, weight, {period} AS p, PRODUCT(1 + COALESCE(r, 0)) OVER (PARTITION BY portfolio_name, symbol, {period}
         ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM rets),
lv AS (SELECT portfolio_name, p, date, 1 + SUM(weight * (g - 1)) AS level FROM gr GROUP BY 1, 2, 3),
en AS (SELECT portfolio_name, p, ARG_MAX(level, date) AS growth FROM lv GROUP BY 1, 2),
st AS (SELECT portfolio_name, p, 10000 * COALESCE(PRODUCT(growth) OVER (PARTITION BY portfolio_name ORDER BY p
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS v0 FROM en)
SELECT lv.portfolio_name, lv.date, v0 * level AS value FROM lv JOIN st ON lv.portfolio_name = st.portfolio_name AND lv.p = st.p""")


def _register_path(name: str, rebalance: str, period: str):
    @query(name, oround(_path_sql(period), ["value"]))
    def path(spark, sf_dir):
        v = Views(spark, sf_dir)
        return rounded(P.value_path(v.bars, v.holdings, rebalance=rebalance))
    path.__doc__ = f"R-18: value path, weights restored {rebalance}."


_register_path("r18_value_path_daily", "daily", "date")
_register_path("r18_value_path_monthly", "monthly", "DATE_TRUNC('month', date)")
_register_path("r18_value_path_buy_and_hold", "never", "0")


@query("r18_backtest_by_rebalance", oround(" UNION ALL ".join(f"""
SELECT '{name}' AS rebalance, portfolio_name, (ARG_MAX(value, date) / 10000 - 1) * 100 AS total_return_pct,
  (POWER(ARG_MAX(value, date) / 10000, 252.0 / COUNT(*)) - 1) * 100 AS annualized_return_pct, MAX(value) AS max_value, MIN(value) AS min_value,
  ARG_MAX(value, date) AS final_value FROM ({_path_sql(period)}) GROUP BY portfolio_name"""
    for name, period in (("daily", "date"), ("monthly", "DATE_TRUNC('month', date)"), ("quarterly", "DATE_TRUNC('quarter', date)"), ("never", "0"))), R18_COLS))
def r18_by_rebalance(spark, sf_dir):
    """R-18: the backtest's summary for each way to rebalance."""
    v = Views(spark, sf_dir)
    runs = [P.backtest(v.bars, v.holdings, rebalance=k).select(F.lit(k).alias("rebalance"), "*") for k in ("daily", "monthly", "quarterly", "never")]
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return rounded(out)
