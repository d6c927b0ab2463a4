"""Optimisation queries O-01, O-02, O-03, O-05, O-06, O-07, O-09, O-10 (solver outputs are
checked by invariants in tests; O-10's equal / market-cap weights have an oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import matrices as M
from tickframe.operators import optimize as O
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, materialise, oround, rounded
from tickframe.plans.matrices_q import _complete
from tickframe.plans.views_sql import with_views
from tickframe.sources import files as FS

G = "portfolio_name"


def _inputs(v):
    rc = _complete(v)
    return M.covariance(rc, G), M.expected_returns(rc, ["portfolio_name", "symbol"])


@query("o01_max_sharpe")
def o01(spark, sf):
    """O-01: long-only maximum-Sharpe weights per portfolio (daily rf, Q-22 fixed)."""
    cov, mu = _inputs(Views(spark, sf))
    return rounded(O.optimise(cov, mu, G, "max_sharpe"), 9)


@query("o02_min_variance")
def o02(spark, sf):
    """O-02: long-only minimum-variance weights per portfolio."""
    cov, mu = _inputs(Views(spark, sf))
    return rounded(O.optimise(cov, mu, G, "min_variance"), 9)


@query("o06_optimality", with_views(["holdings"], """
SELECT p.portfolio_name, m.method, TRUE AS optimal FROM (SELECT DISTINCT portfolio_name FROM holdings) p,
  (VALUES ('max_sharpe'), ('min_variance'), ('risk_parity')) m(method)"""))
def o06_optimality(spark, sf):
    """O-01, O-02, O-05: every portfolio's solved weights meet the conditions of their method."""
    cov, mu = (materialise(d) for d in _inputs(Views(spark, sf)))
    solved = [O.optimise(cov, mu, G, m) for m in ("max_sharpe", "min_variance", "risk_parity")]
    return O.optimality(materialise(solved[0].unionByName(solved[1]).unionByName(solved[2])), cov, mu, G)


@query("o03_efficient_frontier")
def o03(spark, sf):
    """O-03: 100 minimum-variance portfolios between the lowest and highest mean return."""
    cov, mu = _inputs(Views(spark, sf))
    return rounded(O.frontier(cov, mu, G, 100), 9)


@query("o05_risk_parity")
def o05(spark, sf):
    """O-05: equal risk contributions per portfolio."""
    cov, mu = _inputs(Views(spark, sf))
    return rounded(O.optimise(cov, mu, G, "risk_parity"), 9)


@query("o05_risk_budget")
def o05b(spark, sf):
    """O-05 with target risk shares: contributions in proportion to the holdings' weights."""
    v = Views(spark, sf)
    cov, mu = _inputs(v)
    return rounded(O.optimise(cov, mu, G, "risk_parity", risk_shares=v.holdings.select(G, "symbol", F.col("weight").alias("share"))), 9)


@query("o06_optimise_dispatch")
def o06(spark, sf):
    """O-06: every method's result summary {return, volatility, Sharpe} per portfolio."""
    cov, mu = _inputs(Views(spark, sf))
    res = None
    for m in ("max_sharpe", "min_variance", "risk_parity"):
        r = O.optimise(cov, mu, G, m).groupBy(G, "method").agg(
            F.first("expected_return").alias("expected_return"), F.first("volatility").alias("volatility"),
            F.first("sharpe_ratio").alias("sharpe_ratio"), F.bool_and("converged").alias("converged"))
        res = r if res is None else res.unionByName(r)
    return rounded(res, 9)


@query("o07_persist_optimal_weights")
def o07(spark, sf):
    """O-07: prices -> returns -> complete dates -> max-Sharpe weights, persisted with
    value = weight * 100000 and read back (Q-24 fixed: the method stays in the name)."""
    v = Views(spark, sf)
    cov, mu = _inputs(v)
    as_of = v.bars.agg(F.max("date").alias("date"))  # one row
    w = O.optimise(cov, mu, G, "max_sharpe").join(F.broadcast(as_of)).select(
        F.concat(F.col(G), F.lit(" / "), F.col("method")).alias(G), "date", "symbol", "weight",
        (F.col("weight") * 100000).alias("value"), "converged")
    path = FS.write_table(w, FS.scratch(spark, "optimised_weights"))
    return rounded(spark.read.parquet(path), 6)


@query("o09_random_weight_search")
def o09(spark, sf):
    """O-09: best of 10,000 Dirichlet portfolios by Sharpe ratio (JVM-side sampling)."""
    cov, mu = _inputs(Views(spark, sf))
    return rounded(O.random_search(cov, mu, G, 10000), 9)


O10_SQL = with_views(["holdings", "stock_info"], """
WITH caps AS (SELECT industry AS symbol, SUM(market_cap) AS market_cap FROM stock_info GROUP BY 1),
c AS (SELECT h.portfolio_name, h.symbol, COALESCE(c.market_cap / SUM(c.market_cap) OVER (PARTITION BY h.portfolio_name), 0.1) AS w
      FROM holdings h LEFT JOIN caps c ON h.symbol = c.symbol)
SELECT portfolio_name, symbol, 'equal' AS strategy, 1.0 / COUNT(*) OVER (PARTITION BY portfolio_name) AS weight FROM holdings
UNION ALL SELECT portfolio_name, symbol, 'market_cap', w / SUM(w) OVER (PARTITION BY portfolio_name) FROM c""")


@query("o10_strategy_weights", oround(O10_SQL, ["weight"], 9))
def o10(spark, sf):
    """O-10: equal and market-cap strategy weights (risk parity is O-05)."""
    v = Views(spark, sf)
    caps = v.stock_info.groupBy(F.col("industry").alias("symbol")).agg(F.sum("market_cap").alias("market_cap"))
    return rounded(O.strategy_weights(v.holdings.select(G, "symbol"), caps), 9)
