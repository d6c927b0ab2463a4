"""Reusable DuckDB CTE fragments for the oracle side (literal reference semantics)."""

# Dense panel per portfolio: union calendar x available symbols, ffill then bfill,
# pct_change, weights renormalised over available symbols (equal if they sum to 0).
DENSE_PORTFOLIO = """
px AS (SELECT h.portfolio_name, b.symbol, b.date, b.close, h.weight
       FROM bars b JOIN holdings h ON b.symbol = h.symbol),
avail AS (SELECT DISTINCT portfolio_name, symbol, weight FROM px),
wts AS (SELECT portfolio_name, symbol, weight,
               CASE WHEN SUM(weight) OVER (PARTITION BY portfolio_name) > 0
                    THEN weight / SUM(weight) OVER (PARTITION BY portfolio_name)
                    ELSE 1.0 / COUNT(*) OVER (PARTITION BY portfolio_name) END AS w
        FROM avail),
cal AS (SELECT DISTINCT portfolio_name, date FROM px),
grid AS (SELECT c.portfolio_name, w.symbol, c.date, w.w, w.weight
         FROM cal c JOIN wts w ON c.portfolio_name = w.portfolio_name),
filled AS (
  SELECT g.portfolio_name, g.symbol, g.date, g.w, g.weight,
         COALESCE(LAST_VALUE(p.close IGNORE NULLS) OVER (PARTITION BY g.portfolio_name, g.symbol ORDER BY g.date
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  FIRST_VALUE(p.close IGNORE NULLS) OVER (PARTITION BY g.portfolio_name, g.symbol ORDER BY g.date
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS fp
  FROM grid g LEFT JOIN px p
    ON p.portfolio_name = g.portfolio_name AND p.symbol = g.symbol AND p.date = g.date),
rets AS (SELECT portfolio_name, symbol, date, w, weight,
                fp / NULLIF(LAG(fp) OVER (PARTITION BY portfolio_name, symbol ORDER BY date), 0) - 1 AS r
         FROM filled),
pr AS (SELECT portfolio_name, date, SUM(w * r) AS r FROM rets WHERE r IS NOT NULL GROUP BY 1, 2),
ddg AS (SELECT portfolio_name, date, r,
               PRODUCT(1 + r) OVER (PARTITION BY portfolio_name ORDER BY date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM pr),
ddm AS (SELECT *, MAX(g) OVER (PARTITION BY portfolio_name ORDER BY date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gm FROM ddg),
dd AS (SELECT portfolio_name, date, r, g, (g - gm) / NULLIF(gm, 0) AS dd FROM ddm)
"""
