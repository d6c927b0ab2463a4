"""Scan, coverage, set-operation and data-quality queries:
S-01..S-07, A-01..A-04, A-21, A-22, A-24..A-28, T-01, U-01..U-07."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import portfolio as P
from tickframe.operators import quality as Q
from tickframe.operators import scans as SC
from tickframe.operators import screen as S
from tickframe.operators import windows as W
from tickframe.operators.joins import last_days
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, oround, rounded
from tickframe.plans.views_sql import with_views
from tickframe.sources.tables import BASE_TABLES

BAR_COLS = "symbol, date, open, high, low, close, adjusted_close, volume, data_source"


@query("s01_scan_prices", with_views(["bars"], f"SELECT {BAR_COLS} FROM bars ORDER BY date, symbol"))
def s01(spark, sf):
    return SC.scan_prices(Views(spark, sf).bars)


# fixed value: the symbol scanned by the single-symbol query
ONE_SYMBOL = "Brand#13"


@query("s02_scan_symbol_sql", with_views(["bars"], f"""
SELECT symbol, date, open, high, low, close, adjusted_close, volume FROM bars WHERE symbol = '{ONE_SYMBOL}'"""))
def s02(spark, sf):
    return SC.scan_symbol_sql(spark, Views(spark, sf).bars, ONE_SYMBOL)


@query("s03_user_sql", oround(with_views(["bars"], """
SELECT symbol, CAST(COUNT(*) AS BIGINT) AS n, MAX(high) AS max_high, MIN(low) AS min_low FROM bars
WHERE date >= DATE '1995-01-01' GROUP BY symbol"""), []))
def s03(spark, sf):
    q = ("SELECT symbol, CAST(COUNT(*) AS BIGINT) AS n, MAX(high) AS max_high, MIN(low) AS min_low "
         "FROM {bars} WHERE date >= CAST(:start AS DATE) GROUP BY symbol")
    return SC.run_sql(spark, q, {"start": "1995-01-01"}, bars=Views(spark, sf).bars)


@query("s04_scan_held_symbols", with_views(["bars", "holdings"], f"""
SELECT {BAR_COLS} FROM bars WHERE symbol IN (SELECT symbol FROM holdings)"""))
def s04(spark, sf):
    v = Views(spark, sf)
    return SC.scan_prices(v.bars, v.holdings, order=False)


@query("s05_scan_portfolio_panel", oround(with_views(["bars", "holdings"], """
SELECT h.portfolio_name, b.date, b.symbol, h.weight,
       b.close / NULLIF(LAG(b.close) OVER (PARTITION BY h.portfolio_name, b.symbol ORDER BY b.date), 0) - 1 AS returns,
       100000 * h.weight AS value
FROM bars b JOIN holdings h ON b.symbol = h.symbol"""), ["weight", "returns", "value"]))
def s05(spark, sf):
    """S-05: the portfolio panel (portfolio_name, date, symbol, weight, returns, value) for all portfolios."""
    v = Views(spark, sf)
    from tickframe.operators.returns import with_returns
    j = v.bars.select("symbol", "date", "close").join(v.holdings.select("portfolio_name", "symbol", "weight"), "symbol")
    j = with_returns(j, "close", keys=("portfolio_name", "symbol"), ffill=False)
    return rounded(j.select("portfolio_name", "date", "symbol", "weight", "returns",
                            (F.lit(100000.0) * F.col("weight")).alias("value")))


@query("s06_scan_indicators", oround(with_views(["bars"], """
WITH s AS (SELECT symbol, date, CASE WHEN COUNT(close) OVER w = 20 THEN AVG(close) OVER w END AS sma_20
           FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT * FROM s WHERE date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'"""), ["sma_20"]))
def s06(spark, sf):
    """S-06: stored indicators scanned by date range (range filter applied after the window)."""
    b = Views(spark, sf).bars.select("symbol", "date", "close")
    d = W.with_sma(b, "close", (20,)).drop("close")
    return rounded(d.filter(F.col("date").between(F.lit("1994-01-01").cast("date"), F.lit("1996-12-31").cast("date"))))


@query("s07_fundamentals_by_cap", oround(with_views(["stock_info"], """
SELECT symbol, name, sector, industry, market_cap FROM stock_info ORDER BY market_cap DESC NULLS FIRST"""),
    ["market_cap"], 2))
def s07(spark, sf):
    si = Views(spark, sf).stock_info
    return rounded(si.select("symbol", "name", "sector", "industry", "market_cap")
                   .orderBy(F.desc_nulls_first("market_cap")), 2)


@query("a01_distinct_symbols", with_views(["bars"], "SELECT DISTINCT symbol FROM bars ORDER BY symbol"))
def a01(spark, sf):
    return Views(spark, sf).bars.select("symbol").distinct().orderBy("symbol")


@query("a01_distinct_portfolios", with_views(["holdings"], "SELECT DISTINCT portfolio_name FROM holdings"))
def a01p(spark, sf):
    return Views(spark, sf).holdings.select("portfolio_name").distinct().orderBy("portfolio_name")


@query("a02_symbol_coverage", with_views(["bars"], """
SELECT symbol, CAST(COUNT(*) AS BIGINT) AS records, MIN(date) AS start_date, MAX(date) AS end_date FROM bars GROUP BY 1"""))
def a02(spark, sf):
    return Q.coverage(Views(spark, sf).bars)


@query("a03_symbol_coverage_avg_close", oround(with_views(["bars"], """
SELECT symbol, CAST(COUNT(*) AS BIGINT) AS records, MIN(date) AS start_date, MAX(date) AS end_date,
       SUM(close) / COUNT(close) AS avg_close FROM bars GROUP BY 1"""), ["avg_close"], 6))
def a03(spark, sf):
    return rounded(Q.coverage(Views(spark, sf).bars, avg_col="close"), 6)


@query("a04_portfolio_coverage", with_views(["bars", "holdings"], """
SELECT h.portfolio_name, CAST(COUNT(*) AS BIGINT) AS records, MIN(b.date) AS start_date, MAX(b.date) AS end_date
FROM bars b JOIN holdings h ON b.symbol = h.symbol GROUP BY 1"""))
def a04(spark, sf):
    v = Views(spark, sf)
    return Q.coverage(v.bars.join(v.holdings, "symbol"), keys=("portfolio_name",))


@query("a21_row_counts", with_views(["bars", "holdings", "stock_info", "macro"], " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {t}"
    for t in list(BASE_TABLES) + ["bars", "holdings", "stock_info", "macro"])))
def a21(spark, sf):
    """A-21: row count per table; each count is its own partial aggregate, unioned."""
    v = Views(spark, sf)
    frames = {t: v.table(t) for t in BASE_TABLES}
    frames.update(bars=v.bars, holdings=v.holdings, stock_info=v.stock_info, macro=v.macro)
    out = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


@query("a22_freshness", oround(with_views(["bars", "macro"], """
WITH m AS (SELECT 'bars' AS table_name, CAST(MAX(date) AS TIMESTAMP) AS last_ts FROM bars
           UNION ALL SELECT 'macro', CAST(MAX(date) AS TIMESTAMP) FROM macro
           UNION ALL SELECT 'events', MAX(ts) FROM events),
a AS (SELECT MAX(last_ts) AS as_of FROM m)
SELECT table_name, last_ts, DATE_DIFF('second', last_ts, as_of) / 3600.0 AS hours_since,
  CASE WHEN DATE_DIFF('second', last_ts, as_of) / 3600.0 > 48 THEN 'stale'
       WHEN DATE_DIFF('second', last_ts, as_of) / 3600.0 > 24 THEN 'warning' ELSE 'fresh' END AS status FROM m, a"""),
    ["hours_since"]))
def a22(spark, sf):
    """A-22: hours since each table's newest row, against an as-of time (the newest row over
    all tables, so results repeat); 24 h warn, 48 h stale."""
    v = Views(spark, sf)
    m = (v.bars.agg(F.max("date").cast("timestamp_ntz").alias("last_ts")).select(F.lit("bars").alias("table_name"), "last_ts")
         .unionByName(v.macro.agg(F.max("date").cast("timestamp_ntz").alias("last_ts")).select(F.lit("macro").alias("table_name"), "last_ts"))
         .unionByName(v.table("events").agg(F.max("ts").alias("last_ts")).select(F.lit("events").alias("table_name"), "last_ts")))
    from pyspark.sql import Window
    # three rows: the global max is a window over the union of per-table maxima
    d = m.withColumn("as_of", F.max("last_ts").over(Window.partitionBy()))
    h = (F.unix_timestamp(F.col("as_of").cast("timestamp")) - F.unix_timestamp(F.col("last_ts").cast("timestamp"))) / 3600.0
    return rounded(d.select("table_name", "last_ts", h.alias("hours_since"),
                            F.when(h > 48, "stale").when(h > 24, "warning").otherwise("fresh").alias("status")))


@query("a24_symbols_across_portfolios", with_views(["holdings"], "SELECT DISTINCT symbol FROM holdings"))
def a24(spark, sf):
    from tickframe.operators.quality import portfolio_arrays
    arr = portfolio_arrays(Views(spark, sf).holdings)
    return arr.select(F.explode("symbols").alias("symbol")).distinct()


@query("a25_performance_summary", oround(with_views(["bars"], """
WITH t AS (SELECT symbol, ARG_MAX(close, date) / NULLIF(ARG_MIN(close, date), 0) - 1 AS ret FROM bars GROUP BY 1),
r AS (SELECT symbol, date, close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS r FROM bars),
v AS (SELECT symbol, STDDEV_SAMP(r) * SQRT(252) AS vol, AVG(r) / NULLIF(STDDEV_SAMP(r), 0) * SQRT(252) AS sharpe
      FROM r GROUP BY 1)
SELECT ARG_MAX(t.symbol, ret) AS best_performer, MAX(ret) AS best_return, ARG_MIN(t.symbol, ret) AS worst_performer,
       MIN(ret) AS worst_return, ARG_MAX(t.symbol, sharpe) AS best_sharpe_symbol, ARG_MIN(t.symbol, vol) AS lowest_vol_symbol,
       AVG(ret) AS mean_return, CAST(COUNT(ret) AS BIGINT) AS n_available FROM t JOIN v ON t.symbol = v.symbol"""),
    ["best_return", "worst_return", "mean_return"]))
def a25(spark, sf):
    """A-25: best / worst performer, best Sharpe, lowest volatility, mean, availability."""
    from tickframe.functions.exprs import SQRT_YEAR, safe_div
    from tickframe.operators.returns import with_returns
    b = Views(spark, sf).bars
    t = W.range_return(b).select("symbol", F.col("range_return").alias("ret"))
    r = with_returns(b.select("symbol", "date", "close"), "close", out="r", ffill=False)
    v = r.groupBy("symbol").agg((F.stddev_samp("r") * SQRT_YEAR).alias("vol"),
                                (safe_div(F.avg("r"), F.stddev_samp("r")) * SQRT_YEAR).alias("sharpe"))
    j = t.join(v, "symbol")
    return rounded(j.agg(F.max_by("symbol", "ret").alias("best_performer"), F.max("ret").alias("best_return"),
                         F.min_by("symbol", "ret").alias("worst_performer"), F.min("ret").alias("worst_return"),
                         F.max_by("symbol", "sharpe").alias("best_sharpe_symbol"),
                         F.min_by("symbol", "vol").alias("lowest_vol_symbol"), F.avg("ret").alias("mean_return"),
                         F.count("ret").cast("bigint").alias("n_available")))


@query("a26_duplicate_keys", with_views([], """
SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1"""))
def a26(spark, sf):
    """A-26: keys a UNIQUE constraint would reject (lineitem's (orderkey, linenumber) repeats)."""
    return Q.duplicate_keys(Views(spark, sf).table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("a26_duplicate_bar_keys", with_views(["bars"], """
SELECT symbol, date, CAST(COUNT(*) AS BIGINT) AS n FROM (SELECT symbol, date FROM bars
  UNION ALL SELECT symbol, date FROM bars WHERE date > (SELECT MAX(date) - INTERVAL 30 DAY FROM bars)) b GROUP BY 1, 2 HAVING COUNT(*) > 1"""))
def a26b(spark, sf):
    """A-26 on bars of which the last 30 days were delivered twice."""
    b = Views(spark, sf).bars.select("symbol", "date")
    return Q.duplicate_keys(b.unionByName(last_days(b, 30)), ["symbol", "date"])


@query("a27_market_cap_weights", oround(with_views(["stock_info"], """
SELECT symbol, sector, COALESCE(market_cap / NULLIF(SUM(market_cap) OVER (PARTITION BY sector), 0), 0.1) AS cap_weight
FROM stock_info"""), ["cap_weight"], 12))
def a27(spark, sf):
    """A-27: market-cap weight within the sector; 0.1 where the cap is unknown (reference default)."""
    from tickframe.functions.exprs import safe_div
    si = Views(spark, sf).stock_info
    # a sector may hold a third of all parts: summed map-side, then joined
    total = si.groupBy("sector").agg(F.sum(F.col("market_cap").cast("decimal(38,6)")).cast("double").alias("total"))
    w = safe_div(F.col("market_cap"), F.col("total"), 0.1)
    return rounded(si.join(total, "sector", "left").select("symbol", "sector", w.alias("cap_weight")), 12)


@query("a28_symbol_availability", with_views(["bars"], """
WITH req AS (SELECT DISTINCT p_brand AS symbol FROM part UNION SELECT DISTINCT industry FROM stock_info),
have AS (SELECT DISTINCT symbol FROM bars WHERE date > (SELECT MAX(date) - INTERVAL 30 DAY FROM bars))
SELECT r.symbol, h.symbol IS NOT NULL AS has_data FROM req r LEFT JOIN have h ON r.symbol = h.symbol""".replace(
    "FROM stock_info", "FROM (SELECT p_brand AS industry FROM part) si")))
def a28(spark, sf):
    """A-28: per requested symbol, whether prices exist in the last 30 days of data."""
    v = Views(spark, sf)
    req = v.table("part").select(F.col("p_brand").alias("symbol")).distinct()
    recent = last_days(v.bars, 30)
    return Q.availability(req, recent)


@query("t01_latest_rows", with_views(["bars"], f"SELECT {BAR_COLS} FROM bars ORDER BY date DESC, symbol LIMIT 100"))
def t01(spark, sf):
    """T-01: latest 100 rows (the limit is the feature)."""
    return SC.latest_rows(Views(spark, sf).bars, 100)


@query("u02_distinct_symbol_union", with_views(["holdings", "stock_info"], """
SELECT symbol FROM holdings UNION SELECT industry FROM stock_info"""))
def u02(spark, sf):
    v = Views(spark, sf)
    return v.holdings.select("symbol").union(v.stock_info.select(F.col("industry").alias("symbol"))).distinct()


@query("u03_symbols_not_held", with_views(["holdings", "stock_info"], """
SELECT industry AS symbol FROM stock_info EXCEPT ALL SELECT symbol FROM holdings"""))
def u03(spark, sf):
    """U-03: multiset difference (exceptAll)."""
    v = Views(spark, sf)
    return v.stock_info.select(F.col("industry").alias("symbol")).exceptAll(v.holdings.select("symbol"))


@query("u04_calendar_intersection", with_views(["bars", "macro"], """
SELECT date FROM bars INTERSECT SELECT date FROM macro"""))
def u04(spark, sf):
    v = Views(spark, sf)
    return v.bars.select("date").intersect(v.macro.select("date"))


@query("u05_missing_ranges", with_views(["bars", "holdings"], """
WITH ext AS (SELECT MIN(date) AS s, MAX(date) AS e FROM bars),
req AS (SELECT DISTINCT h.symbol, ext.s AS start, ext.e AS "end" FROM holdings h, ext),
st AS (SELECT symbol, MIN(date) AS first, MAX(date) AS last FROM bars GROUP BY 1),
r AS (SELECT req.*, first, last FROM req LEFT JOIN st ON req.symbol = st.symbol)
SELECT symbol, start AS gap_start, "end" AS gap_end, 'no_data' AS kind FROM r WHERE first IS NULL
UNION ALL SELECT symbol, start, CAST(first - INTERVAL 1 DAY AS DATE), 'before' FROM r WHERE start < first
UNION ALL SELECT symbol, CAST(last + INTERVAL 1 DAY AS DATE), "end", 'after' FROM r WHERE "end" > last"""))
def u05(spark, sf):
    """U-05: for each held symbol requested over the data's whole range, the missing part
    before its first and after its last stored date."""
    v = Views(spark, sf)
    ext = v.bars.agg(F.min("date").alias("start"), F.max("date").alias("end")).first()
    req = v.holdings.select("symbol").distinct().select(
        "symbol", F.lit(ext["start"]).alias("start"), F.lit(ext["end"]).alias("end"))
    return Q.missing_ranges(v.bars, req)


@query("u05_interior_gaps", with_views(["bars"], """
WITH n AS (SELECT symbol, date, LEAD(date) OVER (PARTITION BY symbol ORDER BY date) AS nxt FROM bars)
SELECT symbol, CAST(date + INTERVAL 1 DAY AS DATE) AS gap_start, CAST(nxt - INTERVAL 1 DAY AS DATE) AS gap_end,
       CAST(DATE_DIFF('day', date, nxt) - 1 AS BIGINT) AS missing_days FROM n WHERE DATE_DIFF('day', date, nxt) > 1"""))
def u05g(spark, sf):
    return Q.interior_gaps(Views(spark, sf).bars)


# fixed values: source ranks (first source with data wins)
SOURCE_RANKS = {"yahoo_finance": 0, "alpha_vantage": 1}


@query("u06_source_precedence", with_views(["bars"], """
WITH a AS (SELECT symbol, date, close, 'yahoo_finance' AS data_source FROM bars WHERE DAYOFMONTH(date) % 3 <> 0),
b AS (SELECT symbol, date, high AS close, 'alpha_vantage' AS data_source FROM bars WHERE DAYOFMONTH(date) % 2 = 0),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT symbol, date, ARG_MIN(close, CASE data_source WHEN 'yahoo_finance' THEN 0 ELSE 1 END) AS close,
       ARG_MIN(data_source, CASE data_source WHEN 'yahoo_finance' THEN 0 ELSE 1 END) AS data_source FROM u GROUP BY 1, 2"""))
def u06(spark, sf):
    """U-06 + U-01: two sources unioned by name; per (symbol, date) the first-ranked source wins.

    The second source is derived from the same bars (its close is the day's high) and each
    source covers a different subset of days, so both precedence and fallback occur.
    """
    b = Views(spark, sf).bars
    a = b.filter(F.dayofmonth("date") % 3 != 0).select("symbol", "date", "close",
                                                       F.lit("yahoo_finance").alias("data_source"))
    v2 = b.filter(F.dayofmonth("date") % 2 == 0).select("symbol", "date", F.col("high").alias("close"),
                                                        F.lit("alpha_vantage").alias("data_source"))
    return Q.source_precedence(a.unionByName(v2), SOURCE_RANKS)


@query("u07_recent_data", with_views(["bars"], """
SELECT symbol, MAX(date) AS last_date, MAX(date) >= (SELECT MAX(date) FROM bars) - INTERVAL 7 DAY AS has_recent
FROM bars GROUP BY 1"""))
def u07(spark, sf):
    """U-07: any row in the last 7 days before the as-of date (the data's last date)."""
    b = Views(spark, sf).bars
    last = b.agg(F.max("date")).first()[0]
    return Q.recent_data(b, F.lit(last))
