"""Screener and display-rule queries: F-01 .. F-27, A-05 .. A-09, A-23, T-02, T-08."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions.exprs import safe_div
from tickframe.operators import portfolio as P
from tickframe.operators import screen as S
from tickframe.operators.returns import with_returns
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, oround, rounded
from tickframe.plans.portfolio_q import R17_SQL, R18_SQL
from tickframe.plans.views_sql import with_views

CAP_SQL = """CASE WHEN market_cap >= 100000000000 THEN 'Mega Cap ($100B+)' WHEN market_cap >= 10000000000 THEN 'Large Cap ($10B+)'
 WHEN market_cap >= 2000000000 THEN 'Mid Cap ($2B+)' WHEN market_cap >= 300000000 THEN 'Small Cap ($300M+)'
 WHEN market_cap >= 50000000 THEN 'Micro Cap ($50M+)' ELSE 'Nano Cap ($10M+)' END"""
SI = f"si AS (SELECT *, {CAP_SQL} AS market_cap_category FROM stock_info)"
OUT = ["symbol", "name", "sector", "industry", "market_cap", "market_cap_category", "current_price",
       "pe_ratio", "peg_ratio", "dividend_yield", "beta"]
OUT_SQL = ", ".join(OUT)
FLOATS = ["market_cap", "dividend_yield", "beta"]
SPECIAL = {"market_cap": 2}


def _si(v):
    return S.with_cap_category(v.stock_info)


def _where(filters):
    """Oracle text of a filter dict (same FILTER_SPEC as the Spark predicate)."""
    parts = []
    for k, val in filters.items():
        col, op = S.FILTER_SPEC[k]
        if op == "in":
            parts.append(f"{col} IN ({', '.join(repr(x) for x in val)})")
        else:
            parts.append(f"{col} {op} {val!r}")
    return " AND ".join(parts) or "TRUE"


def _screen_query(key, filters, order=True):
    sql = with_views(["stock_info"], f"WITH {SI} SELECT {OUT_SQL} FROM si WHERE {_where(filters)}")

    @query(key, oround(sql, FLOATS, 9, SPECIAL))
    def fn(spark, sf):
        return rounded(S.screen(_si(Views(spark, sf)), filters, order).select(*OUT), 9, SPECIAL)
    return fn


# fixed preset parameters (F-03); sector names follow the fixture's vocabulary
PRESETS = {
    "f03_preset_large_cap": {"market_cap_categories": ["Large Cap ($10B+)"]},
    "f03_preset_sector": {"sectors": ["STANDARD"]},
    "f03_preset_high_yield": {"dividend_yield_min": 0.03},
    "f03_preset_value": {"pe_ratio_max": 15},
    "f03_preset_growth": {"peg_ratio_max": 1.5},
    "f03_preset_combined": {"market_cap_categories": ["Large Cap ($10B+)", "Mid Cap ($2B+)"],
                            "sectors": ["STANDARD", "PROMO"], "pe_ratio_max": 25, "dividend_yield_min": 0.01},
}
for _k, _f in PRESETS.items():
    _screen_query(_k, _f)

ALL_FILTERS = {"market_cap_categories": ["Large Cap ($10B+)", "Mid Cap ($2B+)", "Small Cap ($300M+)"],
               "sectors": ["MEDIUM", "STANDARD", "LARGE", "PROMO"], "pe_ratio_min": 6, "pe_ratio_max": 40,
               "peg_ratio_min": 0.6, "peg_ratio_max": 4.0, "dividend_yield_min": 0.035, "dividend_yield_max": 0.05,
               "price_min": 950.0, "price_max": 2000.0, "volume_min": 100, "beta_min": 0.8, "beta_max": 1.2,
               "debt_to_equity_max": 2.5, "return_on_equity_min": -0.1, "profit_margin_min": -0.05}
_screen_query("f01_screen", ALL_FILTERS, order=True)
_screen_query("f02_frame_filter", {k: v for k, v in ALL_FILTERS.items() if k != "sectors"}, order=False)


@query("f04_percent_inputs", oround(with_views(["stock_info"], f"""
WITH {SI} SELECT {OUT_SQL} FROM si WHERE dividend_yield >= 4.0 / 100 AND return_on_equity >= 10.0 / 100"""),
    FLOATS, 9, SPECIAL))
def f04(spark, sf):
    """F-04: percent inputs (4 %, 10 %) become fractions before screening."""
    filt = {"dividend_yield_min": 4.0 / 100, "return_on_equity_min": 10.0 / 100}
    return rounded(S.screen(_si(Views(spark, sf)), filt).select(*OUT), 9, SPECIAL)


@query("f05_cap_category_rules", with_views(["stock_info"], f"""
SELECT 'generator' AS rule, {CAP_SQL} AS category, CAST(COUNT(*) AS BIGINT) AS count FROM stock_info GROUP BY 2
UNION ALL
SELECT 'collector', CASE WHEN market_cap IS NULL OR market_cap <= 0 THEN 'Unknown'
  WHEN market_cap >= 10000000000 THEN 'Large Cap' WHEN market_cap >= 2000000000 AND market_cap <= 10000000000 THEN 'Mid Cap'
  WHEN market_cap >= 300000000 AND market_cap <= 2000000000 THEN 'Small Cap'
  WHEN market_cap >= 0 AND market_cap <= 300000000 THEN 'Micro Cap' ELSE 'Unknown' END, CAST(COUNT(*) AS BIGINT)
FROM stock_info GROUP BY 2"""))
def f05(spark, sf):
    """F-05 (collector rule, Q-11 kept) and F-06 (generator rule) side by side."""
    si = Views(spark, sf).stock_info
    g = si.groupBy(F.lit("generator").alias("rule"), S.cap_category("market_cap").alias("category")).agg(
        F.count("*").cast("bigint").alias("count"))
    c = si.groupBy(F.lit("collector").alias("rule"), S.cap_category_collector("market_cap").alias("category")).agg(
        F.count("*").cast("bigint").alias("count"))
    return g.unionByName(c)


@query("f07_symbol_validation", with_views([], """
WITH w AS (SELECT DISTINCT UNNEST(STRING_SPLIT(p_name, ' ')) AS raw FROM part)
SELECT raw, UPPER(TRIM(raw)) AS symbol, REGEXP_MATCHES(UPPER(TRIM(raw)), '^\\p{L}{1,10}$') AS valid FROM w"""))
def f07(spark, sf):
    """F-07: normalise (strip, upper) and validate (alphabetic, 1..10 chars) candidate symbols;
    candidates are the words of every part name."""
    from tickframe.operators.quality import validate_symbols
    w = Views(spark, sf).table("part").select(F.explode(F.split("p_name", " ")).alias("raw")).distinct()
    return validate_symbols(w, "raw")


@query("f09_weight_validation", oround(with_views(["holdings"], """
SELECT portfolio_name, CAST(COUNT(symbol) AS BIGINT) AS n_symbols, CAST(COUNT(weight) AS BIGINT) AS n_weights,
       SUM(weight) AS weight_sum, COUNT(symbol) = COUNT(weight) AND ABS(SUM(weight) - 1) <= 0.01 AS valid_service,
       COUNT(symbol) = COUNT(weight) AND ABS(SUM(weight) - 1) < 0.01 AS valid_dashboard
FROM holdings GROUP BY portfolio_name"""), ["weight_sum"]))
def f09(spark, sf):
    from tickframe.operators.quality import portfolio_arrays, weight_report
    return rounded(weight_report(portfolio_arrays(Views(spark, sf).holdings)))


@query("f10_bounds_report", oround(with_views(["bars", "holdings"], f"""
WITH b AS (SELECT portfolio_name, final_value FROM ({R18_SQL}) z),
h AS (SELECT portfolio_name, CAST(COUNT(*) AS BIGINT) AS n_symbols, MIN(weight) AS min_weight, MAX(weight) AS max_weight
      FROM holdings GROUP BY 1)
SELECT h.portfolio_name, n_symbols, min_weight, max_weight, b.final_value AS value,
       n_symbols BETWEEN 1 AND 50 AS symbols_ok, min_weight >= 0.01 AND max_weight <= 1 AS weights_ok,
       b.final_value BETWEEN 1000 AND 10000000 AS value_ok
FROM h JOIN b ON h.portfolio_name = b.portfolio_name"""), ["min_weight", "max_weight", "value"]))
def f10(spark, sf):
    """F-10: symbols 1..50, weights 0.01..1, value 1,000..10,000,000 (value = backtest final value)."""
    from tickframe.operators.quality import bounds_report
    v = Views(spark, sf)
    val = P.backtest(v.bars, v.holdings).select("portfolio_name", F.col("final_value").alias("value"))
    return rounded(bounds_report(v.holdings, val))


@query("f11_weight_status", oround(with_views(["holdings"], """
SELECT portfolio_name, SUM(weight) * 100 AS total_pct,
  CASE WHEN ABS(SUM(weight) * 100 - 100) < 1e-9 THEN printf('Total Weight: %.1f%% \u2713 Perfect!', SUM(weight) * 100)
       WHEN SUM(weight) * 100 > 100 THEN printf('Total Weight: %.1f%% \u26a0\ufe0f Exceeds 100%%', SUM(weight) * 100)
       WHEN SUM(weight) * 100 > 0 THEN printf('Total Weight: %.1f%% (Need %.1f%% more)', SUM(weight) * 100, 100 - SUM(weight) * 100)
       ELSE printf('Total Weight: %.1f%%', 0.0) END AS status FROM holdings GROUP BY 1"""), ["total_pct"]))
def f11(spark, sf):
    h = Views(spark, sf).holdings.groupBy("portfolio_name").agg((F.sum("weight") * 100).alias("total_pct"))
    return rounded(h.withColumn("status", S.weight_status("total_pct")))


@query("f12_sharpe_band", oround(f"""
SELECT portfolio_name, sharpe_ratio, CASE WHEN sharpe_ratio >= 2 THEN 'excellent' WHEN sharpe_ratio >= 1 THEN 'good'
  WHEN sharpe_ratio >= 0.5 THEN 'average' WHEN sharpe_ratio >= 0 THEN 'poor' ELSE 'negative' END AS band,
  COALESCE(printf('%.1f%%', total_return * 100), 'N/A') AS return_label FROM ({R17_SQL}) x""", ["sharpe_ratio"]))
def f12(spark, sf):
    """F-12 Sharpe band and F-27 return label over the flagship analytics."""
    v = Views(spark, sf)
    a = rounded(P.portfolio_analytics(v.bars, v.holdings))
    return a.select("portfolio_name", "sharpe_ratio", S.sharpe_band("sharpe_ratio").alias("band"),
                    S.return_label("total_return").alias("return_label"))


@query("f13_display_projection", oround(with_views(["stock_info"], f"""
WITH {SI} SELECT symbol, name, current_price, market_cap / 1e9 AS market_cap_bn, pe_ratio,
  dividend_yield * 100 AS dividend_yield_pct FROM si"""), ["current_price", "market_cap_bn", "pe_ratio", "dividend_yield_pct"], 2))
def f13(spark, sf):
    """F-13: display projection rounded to 2 decimals (tie-consistent decimal rounding)."""
    si = _si(Views(spark, sf))
    return rounded(si.select("symbol", "name", "current_price", (F.col("market_cap") / 1e9).alias("market_cap_bn"),
                             "pe_ratio", (F.col("dividend_yield") * 100).alias("dividend_yield_pct")), 2)


@query("f19_dollar_allocation", with_views(["holdings"], """
SELECT portfolio_name, symbol, CAST(TRUNC(100000 * COALESCE(weight, 1.0 / COUNT(*) OVER (PARTITION BY portfolio_name)))
       AS BIGINT) AS dollars FROM holdings"""))
def f19(spark, sf):
    """F-19: int(total * w) dollars per holding; equal split when a weight is missing."""
    from pyspark.sql import Window
    h = Views(spark, sf).holdings
    w = F.coalesce("weight", 1.0 / F.count(F.lit(1)).over(Window.partitionBy("portfolio_name")))
    return h.select("portfolio_name", "symbol", (F.lit(100000.0) * w).cast("bigint").alias("dollars"))


@query("f20_safe_divide", oround(with_views(["stock_info"], """
SELECT symbol, COALESCE(market_cap / NULLIF(CAST(volume AS DOUBLE), 0), 0) AS cap_per_share_traded FROM stock_info"""),
    ["cap_per_share_traded"], 4))
def f20(spark, sf):
    si = Views(spark, sf).stock_info
    return rounded(si.select("symbol", safe_div("market_cap", F.col("volume").cast("double"), 0.0)
                             .alias("cap_per_share_traded")), 4)


@query("f21_day_change", oround(with_views(["bars"], """
SELECT symbol, date, close - LAG(close) OVER w AS change, (close - LAG(close) OVER w) / NULLIF(LAG(close) OVER w, 0) * 100
       AS change_pct FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)"""), ["change", "change_pct"]))
def f21(spark, sf):
    from tickframe.functions.exprs import series_window
    b = Views(spark, sf).bars
    prev = F.lag("close").over(series_window())
    return rounded(b.select("symbol", "date", (F.col("close") - prev).alias("change"),
                            (safe_div(F.col("close") - prev, prev) * 100).alias("change_pct")))


@query("f22_clip_returns", oround(with_views(["bars"], """
SELECT symbol, date, GREATEST(LEAST(close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1, 0.05), -0.05)
  AS clipped_return FROM bars"""), ["clipped_return"]))
def f22(spark, sf):
    d = with_returns(Views(spark, sf).bars.select("symbol", "date", "close"), "close")
    return rounded(d.select("symbol", "date", F.greatest(F.least("returns", F.lit(0.05)), F.lit(-0.05))
                            .alias("clipped_return")))


@query("f24_portfolio_input_cleaning", oround(with_views(["holdings"], """
WITH i AS (SELECT portfolio_name, symbol, weight * 100 AS pct FROM holdings
           WHERE symbol IS NOT NULL AND weight IS NOT NULL AND weight > 0),
f AS (SELECT portfolio_name, symbol, pct / 100 AS w FROM i)
SELECT portfolio_name, symbol, CASE WHEN SUM(w) OVER p > 0 THEN w / SUM(w) OVER p ELSE 1.0 / COUNT(*) OVER p END AS weight
FROM f WINDOW p AS (PARTITION BY portfolio_name)"""), ["weight"]))
def f24(spark, sf):
    """F-24: drop pairs without symbol / weight or weight <= 0, percent -> fraction, renormalise."""
    from tickframe.operators.quality import clean_portfolio_input
    h = Views(spark, sf).holdings.select("portfolio_name", "symbol", (F.col("weight") * 100).alias("pct"))
    return rounded(clean_portfolio_input(h))


@query("f25_holdings_summary", oround(with_views(["holdings"], """
SELECT portfolio_name, symbol, weight, CAST(COUNT(*) OVER (PARTITION BY portfolio_name) AS BIGINT) AS n_stocks,
       SUM(weight) OVER (PARTITION BY portfolio_name) AS total_weight FROM holdings"""), ["weight", "total_weight"]))
def f25(spark, sf):
    from pyspark.sql import Window
    h = Views(spark, sf).holdings
    p = Window.partitionBy("portfolio_name")
    return rounded(h.select("portfolio_name", "symbol", "weight", F.count("*").over(p).cast("bigint").alias("n_stocks"),
                            F.sum("weight").over(p).alias("total_weight")))


@query("a05_screener_summary", oround(with_views(["stock_info"], """
SELECT CAST(COUNT(*) AS BIGINT) AS total_stocks, CAST(COUNT(DISTINCT sector) AS BIGINT) AS total_sectors,
  CAST(COUNT(DISTINCT industry) AS BIGINT) AS total_industries, AVG(pe_ratio) AS avg_pe_ratio,
  AVG(dividend_yield) AS avg_dividend_yield, AVG(beta) AS avg_beta, AVG(current_price) AS avg_price,
  SUM(market_cap) AS total_market_cap FROM stock_info"""),
    ["avg_pe_ratio", "avg_dividend_yield", "avg_beta", "avg_price", "total_market_cap"], 9, {"total_market_cap": 0}))
def a05(spark, sf):
    s = S.summary(Views(spark, sf).stock_info).drop("approx_industries")
    return rounded(s, 9, {"total_market_cap": 0})


@query("a06_frame_summary", oround(with_views(["stock_info"], """
SELECT CAST(COUNT(*) AS BIGINT) AS total_stocks, MIN(current_price) AS price_min, MAX(current_price) AS price_max,
       AVG(current_price) AS price_avg, COALESCE(AVG(pe_ratio), 0) AS avg_pe_ratio FROM stock_info"""),
    ["price_min", "price_max", "price_avg", "avg_pe_ratio"], 9))
def a06(spark, sf):
    si = Views(spark, sf).stock_info
    return rounded(si.agg(F.count("*").cast("bigint").alias("total_stocks"), F.min("current_price").alias("price_min"),
                          F.max("current_price").alias("price_max"), F.avg("current_price").alias("price_avg"),
                          F.coalesce(F.avg("pe_ratio"), F.lit(0.0)).alias("avg_pe_ratio")), 9)


for _col in ("market_cap_category", "sector", "industry"):
    def _mk(col):
        @query(f"a07_distribution_{col}", with_views(["stock_info"], f"""
WITH {SI} SELECT {col}, CAST(COUNT(*) AS BIGINT) AS count FROM si GROUP BY {col}"""))
        def fn(spark, sf):
            return S.distribution(_si(Views(spark, sf)), col)
    _mk(_col)


@query("a07_rollup_sector_industry", with_views(["stock_info"], """
SELECT sector, industry, CAST(COUNT(*) AS BIGINT) AS count FROM stock_info GROUP BY ROLLUP (sector, industry)"""))
def a07r(spark, sf):
    si = Views(spark, sf).stock_info
    return si.rollup("sector", "industry").agg(F.count("*").cast("bigint").alias("count"))


@query("a08_filter_options", oround(with_views(["stock_info"], f"""
WITH {SI}, l AS (SELECT LIST(DISTINCT market_cap_category ORDER BY market_cap_category) AS market_cap_categories,
                        LIST(DISTINCT sector ORDER BY sector) AS sectors, LIST(DISTINCT industry ORDER BY industry) AS industries FROM si),
r AS (SELECT MIN(pe_ratio) AS pe_min, MAX(pe_ratio) AS pe_max, MIN(peg_ratio) AS peg_min, MAX(peg_ratio) AS peg_max,
             MIN(dividend_yield) AS div_min, MAX(dividend_yield) AS div_max, MIN(current_price) AS price_min,
             MAX(current_price) AS price_max, MIN(beta) AS beta_min, MAX(beta) AS beta_max FROM si
      WHERE pe_ratio IS NOT NULL AND peg_ratio IS NOT NULL AND dividend_yield IS NOT NULL AND current_price IS NOT NULL
        AND beta IS NOT NULL)
SELECT * FROM l, r"""), ["div_min", "div_max", "beta_min", "beta_max"], 9))
def a08(spark, sf):
    return rounded(S.filter_options(_si(Views(spark, sf))), 9)


@query("a09_frame_filter_options", oround(with_views(["stock_info"], """
SELECT COALESCE(MIN(pe_ratio), 0) AS pe_min, COALESCE(MAX(pe_ratio), 100) AS pe_max, COALESCE(MIN(peg_ratio), 0) AS peg_min,
  COALESCE(MAX(peg_ratio), 5) AS peg_max, COALESCE(MIN(dividend_yield), 0) AS div_min, COALESCE(MAX(dividend_yield), 0.1) AS div_max,
  COALESCE(MIN(current_price), 0) AS price_min, COALESCE(MAX(current_price), 1000) AS price_max,
  COALESCE(MIN(beta), 0) AS beta_min, COALESCE(MAX(beta), 3) AS beta_max FROM stock_info"""),
    ["pe_min", "pe_max", "peg_min", "peg_max", "div_min", "div_max", "price_min", "price_max", "beta_min", "beta_max"], 9))
def a09(spark, sf):
    return rounded(S.frame_filter_options(Views(spark, sf).stock_info), 9)


@query("a23_filtered_averages", oround(with_views(["stock_info"], f"""
WITH {SI} SELECT CAST(COUNT(*) AS BIGINT) AS result_count, AVG(pe_ratio) AS avg_pe_ratio,
  AVG(dividend_yield) AS avg_dividend_yield, AVG(market_cap) AS avg_market_cap FROM si
  WHERE {_where(PRESETS['f03_preset_combined'])}"""), ["avg_pe_ratio", "avg_dividend_yield", "avg_market_cap"], 9,
    {"avg_market_cap": 2}))
def a23(spark, sf):
    s = S.screen(_si(Views(spark, sf)), PRESETS["f03_preset_combined"], order=False)
    return rounded(s.agg(F.count("*").cast("bigint").alias("result_count"), F.avg("pe_ratio").alias("avg_pe_ratio"),
                         F.avg("dividend_yield").alias("avg_dividend_yield"), F.avg("market_cap").alias("avg_market_cap")),
                   9, {"avg_market_cap": 2})


@query("t02_top_by_metric", oround(with_views(["stock_info"], f"""
WITH {SI} SELECT symbol, name, market_cap, sector, industry, market_cap_category, current_price FROM si
WHERE market_cap IS NOT NULL ORDER BY market_cap DESC, symbol LIMIT 10"""), ["market_cap"], 6, SPECIAL))
def t02(spark, sf):
    """T-02: top 10 by a caller-chosen metric (here market cap); the limit is the feature."""
    return rounded(S.top_n(_si(Views(spark, sf)), "market_cap", 10), 6, SPECIAL)


@query("t08_top_per_sector", oround(with_views(["stock_info"], """
SELECT * FROM (SELECT symbol, sector, dividend_yield,
  CAST(ROW_NUMBER() OVER (PARTITION BY sector ORDER BY dividend_yield DESC, symbol) AS BIGINT) AS rank
  FROM stock_info WHERE dividend_yield IS NOT NULL) t WHERE rank <= 3"""), ["dividend_yield"], 9))
def t08(spark, sf):
    d = S.top_per_group(Views(spark, sf).stock_info, "sector", "dividend_yield", 3)
    return rounded(d.select("symbol", "sector", "dividend_yield", "rank"), 9)
