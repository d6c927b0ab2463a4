"""Cleaning and reshaping queries C-01 .. C-12."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import clean as C
from tickframe.operators import windows as W
from tickframe.operators.returns import with_returns
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, oround, rounded
from tickframe.plans.views_sql import with_views

RET = "close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1"

# daily grid of every symbol over the global [min, max] date range, left joined to bars
GRID = """
ext AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM bars),
syms AS (SELECT DISTINCT symbol FROM bars),
grid AS (SELECT s.symbol, CAST(g.d AS DATE) AS date
         FROM syms s, ext, LATERAL (SELECT UNNEST(generate_series(ext.lo, ext.hi, INTERVAL 1 DAY)) AS d) g),
panel AS (SELECT g.symbol, g.date, b.close, b.volume FROM grid g LEFT JOIN bars b
          ON g.symbol = b.symbol AND g.date = b.date)"""


def _panel(v):
    return C.align(v.bars, ["close", "volume"], "D")


@query("c08_reindex_daily", with_views(["bars"], "WITH " + GRID + " SELECT * FROM panel"))
def c08(spark, sf):
    return _panel(Views(spark, sf))


@query("c02_forward_fill", with_views(["bars"], "WITH " + GRID + """
SELECT symbol, date,
  COALESCE(LAST_VALUE(close IGNORE NULLS) OVER w, 0) AS close,
  COALESCE(LAST_VALUE(volume IGNORE NULLS) OVER w, 0) AS volume
FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def c02(spark, sf):
    return C.fill(_panel(Views(spark, sf)), ["close", "volume"], "forward_fill")


@query("c02_backward_fill", with_views(["bars"], "WITH " + GRID + """
SELECT symbol, date,
  COALESCE(FIRST_VALUE(close IGNORE NULLS) OVER w, 0) AS close,
  COALESCE(FIRST_VALUE(volume IGNORE NULLS) OVER w, 0) AS volume
FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""))
def c02b(spark, sf):
    return C.fill(_panel(Views(spark, sf)), ["close", "volume"], "backward_fill")


@query("c03_interpolate", oround(with_views(["bars"], "WITH " + GRID + """,
p AS (SELECT symbol, date, close, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date) AS pos FROM panel),
q AS (SELECT *,
  LAST_VALUE(close IGNORE NULLS) OVER wb AS pv, LAST_VALUE(CASE WHEN close IS NOT NULL THEN pos END IGNORE NULLS) OVER wb AS pp,
  FIRST_VALUE(close IGNORE NULLS) OVER wa AS nv, FIRST_VALUE(CASE WHEN close IS NOT NULL THEN pos END IGNORE NULLS) OVER wa AS np
  FROM p WINDOW wb AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                wa AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT symbol, date, COALESCE(CASE WHEN close IS NOT NULL THEN close WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
       ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END, 0) AS close FROM q"""), ["close"]))
def c03(spark, sf):
    d = _panel(Views(spark, sf)).select("symbol", "date", "close")
    return rounded(C.fill(d, ["close"], "interpolate"))


@query("c04_drop_missing", with_views(["bars"], "WITH " + GRID + """
SELECT * FROM panel WHERE close IS NOT NULL AND volume IS NOT NULL"""))
def c04(spark, sf):
    return C.fill(_panel(Views(spark, sf)), ["close", "volume"], "drop")


@query("c01_null_fractions", oround(with_views(["bars"], f"""
WITH r AS (SELECT symbol, date, close, {RET} AS returns FROM bars),
s AS (SELECT *, CASE WHEN COUNT(close) OVER w20 = 20 THEN AVG(close) OVER w20 END AS sma_20,
             CASE WHEN COUNT(close) OVER w50 = 50 THEN AVG(close) OVER w50 END AS sma_50 FROM r
      WINDOW w20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
             w50 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)),
f AS (SELECT 'symbol' AS "column", AVG(CASE WHEN symbol IS NULL THEN 1.0 ELSE 0.0 END) AS null_fraction FROM s
      UNION ALL SELECT 'date', AVG(CASE WHEN date IS NULL THEN 1.0 ELSE 0.0 END) FROM s
      UNION ALL SELECT 'close', AVG(CASE WHEN close IS NULL THEN 1.0 ELSE 0.0 END) FROM s
      UNION ALL SELECT 'returns', AVG(CASE WHEN returns IS NULL THEN 1.0 ELSE 0.0 END) FROM s
      UNION ALL SELECT 'sma_20', AVG(CASE WHEN sma_20 IS NULL THEN 1.0 ELSE 0.0 END) FROM s
      UNION ALL SELECT 'sma_50', AVG(CASE WHEN sma_50 IS NULL THEN 1.0 ELSE 0.0 END) FROM s)
SELECT "column", null_fraction, null_fraction > 0.1 AS dropped FROM f"""), ["null_fraction"], 9))
def c01(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close"), "close")
    d = W.with_sma(d, "close", (20, 50))
    return rounded(C.null_fractions(d).withColumn("dropped", F.col("null_fraction") > 0.1), 9)


@query("c01_columns_kept", with_views(["stock_info"], """
SELECT symbol, market_cap, current_price, volume, peg_ratio, dividend_yield, beta, debt_to_equity, return_on_equity, profit_margins FROM stock_info"""))
def c01_kept(spark, sf):
    """C-01: the frame without the columns of which more than a tenth is missing (a seventh of the P/E ratios is)."""
    return C.drop_sparse_columns(Views(spark, sf).stock_info.drop("name", "sector", "industry"))


def _iqr_sql(src, col):
    return f"""SELECT s.* FROM {src} s JOIN (SELECT symbol, QUANTILE_CONT({col}, 0.25) AS q1,
      QUANTILE_CONT({col}, 0.75) AS q3 FROM {src} GROUP BY symbol) q ON s.symbol = q.symbol
      WHERE NOT COALESCE({col} < q1 - 1.5 * (q3 - q1) OR {col} > q3 + 1.5 * (q3 - q1), FALSE)"""


@query("c05_outliers_iqr", oround(with_views(["bars"], f"""
WITH r AS (SELECT symbol, date, volume, {RET} AS returns FROM bars),
a AS ({_iqr_sql('r', 'returns')}), b AS ({_iqr_sql('a', 'volume')})
SELECT symbol, date, returns, volume FROM b"""), ["returns"]))
def c05(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close", "volume"), "close")
    d = C.remove_outliers(d.select("symbol", "date", "returns", "volume"), ["returns", "volume"], "iqr", 1.5)
    return rounded(d)


@query("c06_outliers_zscore", oround(with_views(["bars"], f"""
WITH r AS (SELECT symbol, date, {RET} AS returns FROM bars),
z AS (SELECT *, AVG(returns) OVER (PARTITION BY symbol) AS m, STDDEV_SAMP(returns) OVER (PARTITION BY symbol) AS s FROM r)
SELECT symbol, date, returns FROM z WHERE NOT COALESCE(ABS((returns - m) / NULLIF(s, 0)) > 1.5, FALSE)"""),
    ["returns"]))
def c06(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close"), "close").select("symbol", "date", "returns")
    return rounded(C.remove_outliers(d, ["returns"], "zscore", 1.5))


@query("c09_standardize", oround(with_views(["bars"], f"""
WITH r AS (SELECT symbol, date, {RET} AS x FROM bars),
m AS (SELECT *, MEDIAN(x) OVER (PARTITION BY symbol) AS med FROM r),
a AS (SELECT *, MEDIAN(ABS(x - med)) OVER (PARTITION BY symbol) AS mad FROM m)
SELECT symbol, date,
  (x - AVG(x) OVER (PARTITION BY symbol)) / NULLIF(STDDEV_SAMP(x) OVER (PARTITION BY symbol), 0) AS z_score,
  (x - MIN(x) OVER (PARTITION BY symbol)) / NULLIF(MAX(x) OVER (PARTITION BY symbol) - MIN(x) OVER (PARTITION BY symbol), 0) AS min_max,
  (x - med) / NULLIF(mad, 0) AS robust FROM a"""), ["z_score", "min_max", "robust"]))
def c09(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close"), "close")
    d = d.select("symbol", "date", *[F.col("returns").alias(n) for n in ("z_score", "min_max", "robust")])
    d = C.standardize(d, ["z_score"], "zscore")
    d = C.standardize(d, ["min_max"], "minmax")
    return rounded(C.standardize(d, ["robust"], "robust"))


def _resample_sql(freq_expr, cal_sql):
    return f"""
WITH b AS (SELECT symbol, date, close, volume, {freq_expr} AS bucket FROM bars),
res AS (SELECT symbol, bucket, ARG_MAX(close, date) FILTER (WHERE close IS NOT NULL) AS close,
               ARG_MAX(volume, date) FILTER (WHERE volume IS NOT NULL) AS volume FROM b GROUP BY 1, 2),
ext AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM bars),
cal AS ({cal_sql}),
syms AS (SELECT DISTINCT symbol FROM bars)
SELECT s.symbol, c.d AS date, res.close, res.volume FROM syms s CROSS JOIN cal c
LEFT JOIN res ON res.symbol = s.symbol AND res.bucket = c.d"""


MONTH_CAL = """SELECT d FROM (SELECT CAST(LAST_DAY(UNNEST(generate_series(DATE_TRUNC('month', lo), DATE_TRUNC('month', hi),
  INTERVAL 1 MONTH))) AS DATE) AS d, lo, hi FROM ext) t WHERE d >= lo AND d <= hi"""
WEEK_CAL = """SELECT d FROM (SELECT CAST(UNNEST(generate_series(lo + CAST((7 - ISODOW(lo)) % 7 AS INTEGER),
  hi, INTERVAL 7 DAY)) AS DATE) AS d, hi FROM ext) t WHERE d <= hi"""


@query("c07_resample_monthly", with_views(["bars"], _resample_sql("LAST_DAY(date)", MONTH_CAL)))
def c07m(spark, sf):
    return C.align(Views(spark, sf).bars, ["close", "volume"], "M")


@query("c07_resample_weekly", with_views(["bars"], _resample_sql(
    "CAST(date + CAST((7 - ISODOW(date)) % 7 AS INTEGER) AS DATE)", WEEK_CAL)))
def c07w(spark, sf):
    return C.align(Views(spark, sf).bars, ["close", "volume"], "W")


# fixed values: the symbols of the fixture, so that the wide schema does not depend on a scan
WIDE_SYMBOLS = [f"Brand#{k}" for k in range(1, 26)]


@query("c10_pivot_wide", with_views(["bars"], "SELECT date, " + ", ".join(
    f"MAX(close) FILTER (WHERE symbol = '{s}') AS \"{s}\"" for s in WIDE_SYMBOLS) + " FROM bars GROUP BY date"))
def c10(spark, sf):
    b = Views(spark, sf).bars
    return b.groupBy("date").pivot("symbol", WIDE_SYMBOLS).agg(F.first("close"))


@query("c10_unpivot_long", with_views(["bars"], "SELECT date, symbol, close FROM bars"))
def c10u(spark, sf):
    b = Views(spark, sf).bars
    wide = b.groupBy("date").pivot("symbol", WIDE_SYMBOLS).agg(F.first("close"))
    cols = [x for x in wide.columns if x != "date"]
    return wide.unpivot(["date"], cols, "symbol", "close").filter(F.col("close").isNotNull())


@query("c11_median_fill", with_views(["stock_info"], """
SELECT symbol, COALESCE(pe_ratio, (SELECT MEDIAN(pe_ratio) FROM stock_info)) AS pe_ratio,
       COALESCE(peg_ratio, (SELECT MEDIAN(peg_ratio) FROM stock_info)) AS peg_ratio FROM stock_info"""))
def c11(spark, sf):
    si = Views(spark, sf).stock_info.select("symbol", "pe_ratio", "peg_ratio")
    return C.median_fill(si, ["pe_ratio", "peg_ratio"])


@query("c12_target_alignment", oround(with_views(["bars"], f"""
WITH r AS (SELECT symbol, date, {RET} AS returns FROM bars),
f AS (SELECT symbol, date, returns AS target,
        LAG(returns, 1) OVER (PARTITION BY symbol ORDER BY date) AS returns_lag_1,
        LAG(returns, 5) OVER (PARTITION BY symbol ORDER BY date) AS returns_lag_5 FROM r)
SELECT * FROM f WHERE returns_lag_1 IS NOT NULL AND returns_lag_5 IS NOT NULL"""),
    ["target", "returns_lag_1", "returns_lag_5"]))
def c12(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close"), "close")
    d = W.with_lags(d, "returns", (1, 5))
    d = d.select("symbol", "date", F.col("returns").alias("target"), "returns_lag_1", "returns_lag_5")
    return rounded(d.dropna(subset=["returns_lag_1", "returns_lag_5"]))
