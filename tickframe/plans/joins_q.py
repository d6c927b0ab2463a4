"""Join queries J-01 .. J-17."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import joins as J
from tickframe.operators import portfolio as P
from tickframe.operators import quality as Q
from tickframe.operators.returns import with_returns
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, oround, rounded
from tickframe.plans.oracle_blocks import DENSE_PORTFOLIO
from tickframe.plans.portfolio_q import R17_SQL
from tickframe.plans.views_sql import with_views

# fixed values: the region names of the macro series (fixture vocabulary)
SERIES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
MCOLS = ["macro_" + s.lower().replace(" ", "_") for s in SERIES]


@query("j01_union_calendar_fill", with_views(["bars", "holdings"], "WITH " + DENSE_PORTFOLIO + """
SELECT portfolio_name, symbol, date, fp AS price FROM filled"""))
def j01(spark, sf):
    v = Views(spark, sf)
    return J.union_calendar_panel(v.bars, v.holdings)


@query("j02_complete_dates", with_views(["bars", "holdings"], """
WITH r AS (SELECT symbol, date, close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS r FROM bars),
g AS (SELECT DISTINCT portfolio_name, symbol FROM holdings),
n AS (SELECT portfolio_name, COUNT(*) AS n FROM g GROUP BY 1)
SELECT g.portfolio_name, r.date FROM r JOIN g ON r.symbol = g.symbol WHERE r.r IS NOT NULL
GROUP BY 1, 2 HAVING COUNT(*) = (SELECT n FROM n WHERE n.portfolio_name = g.portfolio_name)"""))
def j02(spark, sf):
    v = Views(spark, sf)
    r = with_returns(v.bars.select("symbol", "date", "close"), "close", out="r", ffill=False)
    return J.complete_dates(r, v.holdings)


@query("j03_benchmark_alignment", oround(with_views(["bars", "holdings", "benchmark_returns"], "WITH " + DENSE_PORTFOLIO + """
SELECT p.portfolio_name, p.date, p.r, b.r AS benchmark_r FROM pr p JOIN benchmark_returns b ON p.date = b.date"""),
    ["r", "benchmark_r"]))
def j03(spark, sf):
    v = Views(spark, sf)
    pr = P.portfolio_returns(v.bars, v.holdings)
    return rounded(pr.join(v.benchmark.withColumnRenamed("r", "benchmark_r"), "date"))


@query("j04_weight_lookup", oround(with_views(["bars", "holdings"], "WITH " + DENSE_PORTFOLIO + """
SELECT portfolio_name, symbol, w FROM wts"""), ["w"]))
def j04(spark, sf):
    """J-04: weights looked up by symbol (left join, default 0), renormalised over symbols with data."""
    v = Views(spark, sf)
    return rounded(P.normalised_weights(v.holdings, v.bars.select("symbol").distinct())
                   .select("portfolio_name", "symbol", "w"))


RECENT = "(SELECT MAX(date) - INTERVAL 30 DAY FROM bars)"


@query("j05_missing_recent_data", with_views(["bars", "holdings"], f"""
SELECT DISTINCT portfolio_name, symbol FROM (SELECT portfolio_name, symbol FROM holdings
  UNION ALL SELECT portfolio_name, 'NOT LISTED' FROM holdings) h WHERE NOT EXISTS
 (SELECT 1 FROM bars b WHERE b.symbol = h.symbol AND b.date > {RECENT})"""))
def j05(spark, sf):
    """J-05: held symbols with no bar in the 30 days before the data's last date (anti join); each portfolio also holds
    a symbol that is not listed, so that there is one to find."""
    v = Views(spark, sf)
    recent = J.last_days(v.bars, 30)
    held = v.holdings.select("portfolio_name", "symbol")
    held = held.unionByName(held.select("portfolio_name", F.lit("NOT LISTED").alias("symbol")))
    return held.join(recent, "symbol", "left_anti").distinct()


@query("j06_partial_portfolios", with_views(["bars", "holdings"], f"""
WITH rb AS (SELECT DISTINCT symbol FROM bars WHERE date > {RECENT}),
a AS (SELECT portfolio_name, CAST(COUNT(DISTINCT symbol) AS BIGINT) AS n_requested,
             CAST(COUNT(DISTINCT CASE WHEN symbol IN (SELECT symbol FROM rb) THEN symbol END) AS BIGINT) AS n_available
      FROM holdings GROUP BY 1)
SELECT portfolio_name, n_requested, n_available,
       CASE WHEN n_available < n_requested THEN portfolio_name || ' (Partial)' ELSE portfolio_name END AS label FROM a"""))
def j06(spark, sf):
    """J-06: semi join against the last 30 days of prices; '(Partial)' when some symbols lack data."""
    v = Views(spark, sf)
    recent = J.last_days(v.bars, 30)
    return J.flag_partial(v.holdings, recent)


ASOF_SQL = "SELECT b.symbol, b.date, b.close, " + ", ".join(
    f"a{i}.value AS {c}" for i, c in enumerate(MCOLS)) + " FROM bars b " + " ".join(
    f"ASOF LEFT JOIN (SELECT date, value FROM macro WHERE series_id = '{s}') a{i} ON b.date >= a{i}.date"
    for i, s in enumerate(SERIES))


@query("j07_macro_asof", with_views(["bars", "macro"], ASOF_SQL))
def j07(spark, sf):
    v = Views(spark, sf)
    return J.asof_join(v.bars.select("symbol", "date", "close"), v.macro)


@query("j07_macro_left_equi", oround(with_views(["bars", "macro"], "SELECT b.symbol, b.date, b.close, " + ", ".join(
    f"a{i}.value AS {c}" for i, c in enumerate(MCOLS)) + " FROM bars b " + " ".join(
    f"LEFT JOIN (SELECT date, value FROM macro WHERE series_id = '{s}') a{i} ON b.date = a{i}.date"
    for i, s in enumerate(SERIES))), []))
def j07e(spark, sf):
    v = Views(spark, sf)
    return J.equi_join_series(v.bars.select("symbol", "date", "close"), v.macro)


RISK_ROWS_SQL = "WITH " + DENSE_PORTFOLIO + """,
rr AS (SELECT portfolio_name, date,
        CASE WHEN COUNT(r) OVER w = 30 THEN AVG(r) OVER w / NULLIF(STDDEV_SAMP(r) OVER w, 0) * SQRT(252) END AS sharpe_ratio,
        CASE WHEN COUNT(r) OVER w = 30 THEN STDDEV_SAMP(r) OVER w * SQRT(252) END AS volatility,
        CASE WHEN COUNT(r) OVER w = 30 THEN QUANTILE_CONT(r, 0.05) OVER w END AS var_95
       FROM pr WINDOW w AS (PARTITION BY portfolio_name ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
risk AS (SELECT * FROM rr WHERE sharpe_ratio IS NOT NULL AND volatility IS NOT NULL AND var_95 IS NOT NULL)"""


def risk_rows(v):
    """Daily rolling risk rows per portfolio (the risk_metrics table shape)."""
    from tickframe.operators.windows import rolling_portfolio_metrics
    m = rolling_portfolio_metrics(P.portfolio_returns(v.bars, v.holdings))
    return m.select("portfolio_name", "date", F.col("rolling_sharpe").alias("sharpe_ratio"),
                    F.col("rolling_volatility").alias("volatility"), F.col("rolling_var_95").alias("var_95"))


@query("t03_latest_risk_row", oround(with_views(["bars", "holdings"], RISK_ROWS_SQL + """
SELECT portfolio_name, ARG_MAX(date, date) AS date, ARG_MAX(sharpe_ratio, date) AS sharpe_ratio,
       ARG_MAX(volatility, date) AS volatility, ARG_MAX(var_95, date) AS var_95 FROM risk GROUP BY 1"""),
    ["sharpe_ratio", "volatility", "var_95"]))
def t03(spark, sf):
    """T-03: latest risk row per portfolio via max_by(struct, date) -- a partial aggregate."""
    r = risk_rows(Views(spark, sf))
    last = r.groupBy("portfolio_name").agg(F.max_by(F.struct("date", "sharpe_ratio", "volatility", "var_95"), "date")
                                           .alias("l"))
    return rounded(last.select("portfolio_name", "l.*"))


@query("t05_last_risk_rows", oround(with_views(["bars", "holdings"], RISK_ROWS_SQL + """
SELECT * FROM risk ORDER BY date DESC, portfolio_name LIMIT 5"""), ["sharpe_ratio", "volatility", "var_95"]))
def t05(spark, sf):
    """T-05: the five most recent risk rows (the limit is the feature)."""
    r = risk_rows(Views(spark, sf))
    return rounded(r.orderBy(F.desc("date"), "portfolio_name").limit(5))


A10_COLS = ["mean_return", "mean_symbol_total_return", "std_return", "latest_sharpe", "latest_volatility"]


@query("a10_portfolio_summary", oround(with_views(["bars", "holdings"], RISK_ROWS_SQL + """,
hp AS (SELECT h.portfolio_name, b.symbol, b.date,
              b.close / NULLIF(LAG(b.close) OVER (PARTITION BY h.portfolio_name, b.symbol ORDER BY b.date), 0) - 1 AS r
       FROM bars b JOIN holdings h ON b.symbol = h.symbol),
s AS (SELECT portfolio_name, CAST(COUNT(DISTINCT symbol) AS BIGINT) AS n_symbols, MIN(date) AS start_date,
             MAX(date) AS end_date, CAST(COUNT(*) AS BIGINT) AS n_records, AVG(r) AS mean_return,
             STDDEV_SAMP(r) AS std_return, LIST(DISTINCT symbol ORDER BY symbol) AS symbols FROM hp GROUP BY 1),
t AS (SELECT portfolio_name, AVG(tot) AS mean_symbol_total_return
      FROM (SELECT portfolio_name, symbol, SUM(r) AS tot FROM hp GROUP BY 1, 2) x GROUP BY 1),
l AS (SELECT portfolio_name, ARG_MAX(sharpe_ratio, date) AS latest_sharpe, ARG_MAX(volatility, date) AS latest_volatility
      FROM risk GROUP BY 1)
SELECT s.*, t.mean_symbol_total_return, l.latest_sharpe, l.latest_volatility FROM s JOIN t USING (portfolio_name)
LEFT JOIN l USING (portfolio_name)"""), A10_COLS))
def a10(spark, sf):
    """A-10 + J-08: portfolio panel summary with the latest risk row left-joined."""
    v = Views(spark, sf)
    hp = with_returns(v.bars.select("symbol", "date", "close").join(v.holdings.select("portfolio_name", "symbol"),
                                                                   "symbol"),
                      "close", keys=("portfolio_name", "symbol"), out="r", ffill=False)
    s = hp.groupBy("portfolio_name").agg(
        F.countDistinct("symbol").cast("bigint").alias("n_symbols"), F.min("date").alias("start_date"),
        F.max("date").alias("end_date"), F.count("*").cast("bigint").alias("n_records"),
        F.avg("r").alias("mean_return"), F.stddev_samp("r").alias("std_return"),
        F.array_sort(F.collect_set("symbol")).alias("symbols"))
    t = (hp.groupBy("portfolio_name", "symbol").agg(F.sum("r").alias("tot"))
         .groupBy("portfolio_name").agg(F.avg("tot").alias("mean_symbol_total_return")))
    l = (risk_rows(v).groupBy("portfolio_name")
         .agg(F.max_by("sharpe_ratio", "date").alias("latest_sharpe"),
              F.max_by("volatility", "date").alias("latest_volatility")))
    return rounded(s.join(t, "portfolio_name").join(l, "portfolio_name", "left"))


@query("j09_new_portfolio_names", with_views([], """
WITH cand AS (SELECT DISTINCT o_orderpriority AS portfolio_name FROM orders
              UNION SELECT DISTINCT c_mktsegment FROM customer),
existing AS (SELECT DISTINCT c.c_mktsegment AS portfolio_name FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT portfolio_name FROM cand WHERE portfolio_name NOT IN (SELECT portfolio_name FROM existing)"""))
def j09(spark, sf):
    """J-09: candidate portfolios (order priorities and segments) whose name is not stored yet."""
    v = Views(spark, sf)
    cand = (v.table("orders").select(F.col("o_orderpriority").alias("portfolio_name"))
            .union(v.table("customer").select(F.col("c_mktsegment").alias("portfolio_name"))).distinct())
    existing = v.holdings.select("portfolio_name")
    return cand.join(existing, "portfolio_name", "left_anti")


# fixed value: the selected portfolio names (market segments of the fixture)
SELECTED = ["BUILDING", "MACHINERY"]


@query("j15_selected_portfolios", oround(f"SELECT * FROM ({R17_SQL}) x WHERE portfolio_name IN ('BUILDING', 'MACHINERY')",
                                        ["total_return", "annualized_return", "sharpe_ratio", "sortino_ratio", "var_95",
                                         "cvar_95", "max_drawdown", "avg_drawdown", "drawdown_frequency",
                                         "portfolio_volatility", "weighted_avg_volatility", "diversification_ratio"]))
def j15(spark, sf):
    """J-15: restrict to a list of portfolio names (isin, pushed below the analytics)."""
    v = Views(spark, sf)
    h = v.holdings.filter(F.col("portfolio_name").isin(SELECTED))
    return rounded(P.portfolio_analytics(v.bars, h))


@query("j17_portfolios_with_analytics", oround(with_views(["holdings"], f"""
WITH a AS ({R17_SQL}), p AS (SELECT portfolio_name, LIST(symbol ORDER BY pos) AS symbols FROM holdings GROUP BY 1)
SELECT p.portfolio_name, p.symbols, a.total_return, a.sharpe_ratio FROM p JOIN a ON p.portfolio_name = a.portfolio_name"""),
    ["total_return", "sharpe_ratio"]))
def j17(spark, sf):
    """J-17: stored portfolios joined one-to-one with their analytics."""
    v = Views(spark, sf)
    p = Q.portfolio_arrays(v.holdings).select("portfolio_name", "symbols")
    a = P.portfolio_analytics(v.bars, v.holdings).select("portfolio_name", "total_return", "sharpe_ratio")
    return rounded(p.join(a, "portfolio_name"))
