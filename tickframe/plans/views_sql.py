"""DuckDB text of the derived views, used to build oracle SQL.

The oracle must be independent of the Spark code: it keeps the literal
row_number / window formulations while the Spark side uses partial
aggregates.  ``with_views`` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

VIEW_SQL = {
    "bars": """
SELECT symbol, date,
       MAX(CASE WHEN rf = 1 THEN px END) AS open, MAX(px) AS high, MIN(px) AS low,
       MAX(CASE WHEN rl = 1 THEN px END) AS close,
       MAX(CASE WHEN rl = 1 THEN px END) AS adjusted_close,
       CAST(SUM(qty) AS BIGINT) AS volume, 'fixture' AS data_source
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, date ORDER BY ok, ln, px) AS rf,
            ROW_NUMBER() OVER (PARTITION BY symbol, date ORDER BY ok DESC, ln DESC, px DESC) AS rl
  FROM (SELECT p.p_brand AS symbol, CAST(l.l_shipdate AS DATE) AS date,
               p.p_retailprice * (1 - l.l_discount) AS px, l.l_quantity AS qty,
               l.l_orderkey AS ok, l.l_linenumber AS ln
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) t) r
GROUP BY symbol, date""",
    "holdings": """
SELECT portfolio_name, CAST(rn AS INT) AS pos, symbol, v / SUM(v) OVER (PARTITION BY portfolio_name) AS weight
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY portfolio_name ORDER BY v DESC, symbol) AS rn
      FROM (SELECT c.c_mktsegment AS portfolio_name, p.p_brand AS symbol, CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(38, 6))) AS DOUBLE) AS v
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                 JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
            GROUP BY c.c_mktsegment, p.p_brand) s) k
WHERE rn <= 5""",
    "stock_info": """
SELECT CAST(p.p_partkey AS VARCHAR) AS symbol, p.p_name AS name, p.p_type AS sector, p.p_brand AS industry,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(38, 6))) AS DOUBLE) * p.p_size * p.p_size * 30 AS market_cap,
       p.p_retailprice AS current_price, CAST(SUM(l.l_quantity) AS BIGINT) AS volume,
       CASE WHEN p.p_size % 7 = 0 THEN NULL ELSE CAST(5 + p.p_size * 0.8 AS DOUBLE) END AS pe_ratio,
       CASE WHEN p.p_partkey % 11 = 0 THEN NULL ELSE CAST(0.5 + (p.p_partkey % 40) * 0.1 AS DOUBLE) END AS peg_ratio,
       CAST(SUM(CAST(l.l_tax AS DECIMAL(38, 6))) AS DOUBLE) / COUNT(*) AS dividend_yield,
       CAST(SUM(CAST(l.l_discount AS DECIMAL(38, 6))) AS DOUBLE) / COUNT(*) * 20 AS beta,
       CAST((p.p_partkey % 30) * 0.1 AS DOUBLE) AS debt_to_equity,
       CAST(((p.p_partkey % 70) - 20) * 0.01 AS DOUBLE) AS return_on_equity,
       CAST(((p.p_size % 50) - 10) * 0.01 AS DOUBLE) AS profit_margins
FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name, p.p_type, p.p_brand, p.p_size, p.p_retailprice""",
    "macro": """
SELECT r.r_name AS series_id, CAST(DATE_TRUNC('month', o.o_orderdate) AS DATE) AS date,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(38, 6))) AS DOUBLE) / COUNT(*) AS value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
     JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2""",
    "benchmark_returns": """
SELECT date, level / LAG(level) OVER (ORDER BY date) - 1 AS r
FROM (SELECT date, AVG(close) AS level FROM bars GROUP BY date) a""",
    "metric_bars": """
SELECT event_type AS symbol, DATE_TRUNC('hour', ts) AS bucket, COUNT(*) AS n, MIN(value) AS low,
       MAX(value) AS high, CAST(SUM(CAST(value AS DECIMAL(38, 6))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""",
}

DEPENDS = {"benchmark_returns": ["bars"]}


def with_views(views, body: str) -> str:
    """Prefix ``body`` with CTEs for ``views`` (dependencies first)."""
    order: list[str] = []

    def add(v):
        for d in DEPENDS.get(v, []):
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    if not order:
        return body
    prefix = "WITH " + ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in order)
    b = body.lstrip()
    if b[:4].upper() == "WITH":
        return prefix + ",\n" + b[4:]
    return prefix + "\n" + b
