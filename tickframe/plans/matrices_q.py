"""Matrix and asset-statistics queries: A-13..A-20, J-13, O-04, O-08."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import joins as J
from tickframe.operators import matrices as M
from tickframe.operators import portfolio as P
from tickframe.operators.returns import with_returns
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, oround, rounded
from tickframe.plans.views_sql import with_views

RET = "WITH r AS (SELECT symbol, date, close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS r FROM bars)"
COMPLETE = RET + """,
g AS (SELECT DISTINCT portfolio_name, symbol FROM holdings),
gn AS (SELECT portfolio_name, COUNT(*) AS n FROM g GROUP BY 1),
gr AS (SELECT g.portfolio_name, r.symbol, r.date, r.r FROM r JOIN g ON r.symbol = g.symbol WHERE r.r IS NOT NULL),
cd AS (SELECT gr.portfolio_name, gr.date FROM gr JOIN gn ON gr.portfolio_name = gn.portfolio_name
       GROUP BY 1, 2 HAVING COUNT(*) = ANY_VALUE(gn.n)),
pr AS (SELECT gr.* FROM gr JOIN cd ON gr.portfolio_name = cd.portfolio_name AND gr.date = cd.date)"""
PAIR_SQL = """SELECT a.portfolio_name, a.symbol AS symbol_a, b.symbol AS symbol_b, CAST(COUNT(*) AS BIGINT) AS n,
  COVAR_SAMP(a.r, b.r) AS covariance,
  CASE WHEN VAR_POP(a.r) > 0 AND VAR_POP(b.r) > 0 THEN CORR(a.r, b.r) END AS correlation
FROM pr a JOIN pr b ON a.portfolio_name = b.portfolio_name AND a.date = b.date GROUP BY 1, 2, 3"""
SPEC = {"covariance": 12, "correlation": 9}


def _returns(v):
    return with_returns(v.bars.select("symbol", "date", "close"), "close", out="r", ffill=False)


def _complete(v):
    """(portfolio_name, symbol, date, r) on dates where every held symbol has a return (J-02)."""
    r = _returns(v).filter(F.col("r").isNotNull())
    g = v.holdings.select("portfolio_name", "symbol").distinct()
    gr = r.join(g, "symbol")
    cd = J.complete_dates(r, g)
    return gr.join(cd, ["portfolio_name", "date"])


@query("a13_expected_returns", oround(with_views(["bars"], RET + """
SELECT symbol, AVG(r) AS expected_return FROM r GROUP BY 1"""), ["expected_return"], 12))
def a13(spark, sf):
    return rounded(M.expected_returns(_returns(Views(spark, sf))), 12)


@query("a14_covariance_matrix", oround(with_views(["bars", "holdings"], COMPLETE + "\n" + PAIR_SQL),
                                       ["covariance", "correlation"], 6, SPEC))
def a14(spark, sf):
    """A-14: sample covariance of each portfolio's holdings over its complete dates."""
    return rounded(M.covariance(_complete(Views(spark, sf)), "portfolio_name"), 6, SPEC)


@query("a15_shrinkage_covariance", oround(with_views(["bars", "holdings"], COMPLETE + """,
c AS (""" + PAIR_SQL + """),
d AS (SELECT portfolio_name, AVG(covariance) AS avg_var, COUNT(*) AS k FROM c WHERE symbol_a = symbol_b GROUP BY 1),
t AS (SELECT portfolio_name, COUNT(*) AS T FROM cd GROUP BY 1)
SELECT c.portfolio_name, symbol_a, symbol_b, LEAST(1, GREATEST(0, (T - k - 2) / (T - 1))) AS shrinkage,
  (1 - LEAST(1, GREATEST(0, (T - k - 2) / (T - 1)))) * covariance
   + LEAST(1, GREATEST(0, (T - k - 2) / (T - 1))) * CASE WHEN symbol_a = symbol_b THEN avg_var ELSE 0 END AS covariance
FROM c JOIN d ON c.portfolio_name = d.portfolio_name JOIN t ON c.portfolio_name = t.portfolio_name"""),
    ["shrinkage", "covariance"], 9, {"covariance": 12}))
def a15(spark, sf):
    v = Views(spark, sf)
    rc = _complete(v)
    cov = M.covariance(rc, "portfolio_name")
    n_obs = rc.groupBy("portfolio_name").agg(F.countDistinct("date").cast("double").alias("T"))
    return rounded(M.shrink(cov, n_obs, "portfolio_name"), 9, {"covariance": 12})


UNIV = RET + """,
pr AS (SELECT 'all' AS portfolio_name, symbol, date, r FROM r WHERE r IS NOT NULL)"""


@query("a16_correlation_matrix", oround(with_views(["bars"], UNIV + "\n" + PAIR_SQL.replace(
    "SELECT a.portfolio_name, ", "SELECT ").replace("GROUP BY 1, 2, 3", "GROUP BY 1, 2")),
    ["covariance", "correlation"], 6, SPEC))
def a16(spark, sf):
    """A-16: pairwise-complete correlation (and covariance) of every symbol's returns."""
    return rounded(M.covariance(_returns(Views(spark, sf))), 6, SPEC)


@query("j13_covariance_of_holdings", oround(with_views(["bars", "holdings"], UNIV + """,
c AS (""" + PAIR_SQL.replace("SELECT a.portfolio_name, ", "SELECT ").replace("GROUP BY 1, 2, 3", "GROUP BY 1, 2") + """)
SELECT ha.portfolio_name, c.symbol_a, c.symbol_b, c.covariance FROM c
JOIN holdings ha ON c.symbol_a = ha.symbol JOIN holdings hb ON c.symbol_b = hb.symbol AND ha.portfolio_name = hb.portfolio_name"""),
    ["covariance"], 12))
def j13(spark, sf):
    """J-13: the universe covariance restricted to each portfolio's assets on both axes."""
    v = Views(spark, sf)
    cov = M.covariance(_returns(v))
    h = v.holdings.select("portfolio_name", "symbol")
    out = (cov.join(h.withColumnRenamed("symbol", "symbol_a"), "symbol_a")
           .join(h.withColumnRenamed("symbol", "symbol_b"), ["portfolio_name", "symbol_b"]))
    return rounded(out.select("portfolio_name", "symbol_a", "symbol_b", "covariance"), 12)


@query("a17_asset_moments", oround(with_views(["bars"], RET + """
SELECT symbol, AVG(r) AS mean_return, STDDEV_SAMP(r) AS volatility, SKEWNESS(r) AS skewness, KURTOSIS(r) AS kurtosis,
       AVG(r) / NULLIF(STDDEV_SAMP(r), 0) AS sharpe_like FROM r GROUP BY 1"""),
    ["mean_return", "volatility", "skewness", "kurtosis", "sharpe_like"], 9))
def a17(spark, sf):
    return rounded(M.moments(_returns(Views(spark, sf))), 9)


@query("a18_correlation_features", oround(with_views(["bars"], UNIV + """,
c AS (""" + PAIR_SQL.replace("SELECT a.portfolio_name, ", "SELECT ").replace("GROUP BY 1, 2, 3", "GROUP BY 1, 2") + """)
SELECT symbol_a AS symbol, AVG(correlation) AS avg_correlation, MAX(correlation) AS max_correlation,
       MIN(correlation) AS min_correlation, CAST(COUNT_IF(correlation > 0.7) AS BIGINT) AS high_corr_count
FROM c WHERE symbol_a <> symbol_b GROUP BY 1"""), ["avg_correlation", "max_correlation", "min_correlation"], 9))
def a18(spark, sf):
    return rounded(M.correlation_features(M.covariance(_returns(Views(spark, sf)))), 9)


@query("a19_return_histogram", oround(with_views(["bars", "holdings"], "WITH " + __import__(
    "tickframe.plans.oracle_blocks", fromlist=["DENSE_PORTFOLIO"]).DENSE_PORTFOLIO + """,
s AS (SELECT portfolio_name, r, MIN(r) OVER w AS lo, MAX(r) OVER w AS hi, AVG(r) OVER w AS mu,
             STDDEV_SAMP(r) OVER w AS sd, COUNT(r) OVER w AS n FROM pr WINDOW w AS (PARTITION BY portfolio_name)),
b AS (SELECT portfolio_name, CAST(CASE WHEN hi > lo THEN LEAST(FLOOR((r - lo) / (hi - lo) * 50) + 1, 50) ELSE 1 END AS INTEGER) AS bin,
             lo, hi, mu, sd, n FROM s),
h AS (SELECT portfolio_name, bin, lo, hi, mu, sd, n, CAST(COUNT(*) AS BIGINT) AS count FROM b GROUP BY ALL)
SELECT portfolio_name, bin, lo + (bin - 1) * ((hi - lo) / 50) AS bin_start, lo + (bin - 1) * ((hi - lo) / 50) + (hi - lo) / 50 AS bin_end,
  count, n * ((hi - lo) / 50) * EXP(-0.5 * POWER(((lo + (bin - 1) * ((hi - lo) / 50) + ((hi - lo) / 50) / 2) - mu) / sd, 2))
    / (sd * SQRT(2 * PI())) AS normal_expected FROM h"""), ["bin_start", "bin_end", "normal_expected"], 9))
def a19(spark, sf):
    """A-19 / A-20: 50-bin histogram of daily portfolio returns with the fitted normal curve."""
    v = Views(spark, sf)
    return rounded(M.histogram(P.portfolio_returns(v.bars, v.holdings), "portfolio_name"), 9)


@query("o04_black_litterman_prior", oround(with_views(["bars", "holdings", "stock_info"], COMPLETE + """,
caps AS (SELECT h.portfolio_name, h.symbol, SUM(s.market_cap) AS cap FROM holdings h JOIN stock_info s ON s.industry = h.symbol GROUP BY 1, 2),
w AS (SELECT portfolio_name, symbol, cap / SUM(cap) OVER (PARTITION BY portfolio_name) AS market_weight FROM caps),
p AS (SELECT pr.portfolio_name, pr.date, SUM(w.market_weight * pr.r) AS p FROM pr JOIN w ON pr.portfolio_name = w.portfolio_name AND pr.symbol = w.symbol GROUP BY 1, 2)
SELECT pr.portfolio_name, pr.symbol, ANY_VALUE(w.market_weight) AS market_weight, 3.0 * COVAR_SAMP(pr.r, p.p) AS implied_return
FROM pr JOIN w ON pr.portfolio_name = w.portfolio_name AND pr.symbol = w.symbol
JOIN p ON pr.portfolio_name = p.portfolio_name AND pr.date = p.date GROUP BY 1, 2"""),
    ["market_weight", "implied_return"], 12))
def o04(spark, sf):
    """O-04: market weights from summed fundamentals' caps per symbol; implied returns delta * S w."""
    v = Views(spark, sf)
    caps = (v.holdings.select("portfolio_name", "symbol")
            .join(v.stock_info.groupBy(F.col("industry").alias("symbol")).agg(F.sum("market_cap").alias("market_cap")), "symbol"))
    return rounded(M.implied_returns(_complete(v), caps, "portfolio_name"), 12)


@query("o08_asset_points", oround(with_views(["bars"], RET + """
SELECT symbol, AVG(r) * 252 AS annual_return, STDDEV_SAMP(r) * SQRT(252) AS annual_volatility FROM r GROUP BY 1"""),
    ["annual_return", "annual_volatility"], 9))
def o08(spark, sf):
    return rounded(M.asset_points(_returns(Views(spark, sf))), 9)
