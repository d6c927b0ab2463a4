"""Window-function queries W-01 .. W-25 and the indicator table S-23."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions.ema import with_emas
from tickframe.operators import portfolio as P
from tickframe.operators import windows as W
from tickframe.operators.returns import with_returns
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, oround, rounded
from tickframe.plans.oracle_blocks import DENSE_PORTFOLIO
from tickframe.plans.views_sql import with_views

RET = "close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1"


def _w(n, off=0):
    return f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1 + off} PRECEDING AND {off or 'CURRENT'} {'PRECEDING' if off else 'ROW'})"


def _minp(expr, col, n, off=0):
    return f"CASE WHEN COUNT({col}) OVER {_w(n, off)} = {n} THEN {expr} OVER {_w(n, off)} END"


# EMA oracle: unblocked closed form sum(x b^-i) / sum(b^-i) (fine for the fixture lengths).
def _ema_sql(x, span, src, keycols="symbol, date"):
    b = 1.0 - 2.0 / (span + 1.0)
    return (f"SELECT {keycols}, SUM({x} * POWER({b!r}, -t)) OVER (PARTITION BY symbol ORDER BY date "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / SUM(POWER({b!r}, -t)) OVER "
            f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM {src}")


@query("w01_simple_returns", oround(with_views(["bars"], f"SELECT symbol, date, {RET} AS returns FROM bars"),
                                   ["returns"]))
def w01(spark, sf):
    v = Views(spark, sf)
    return rounded(with_returns(v.bars, "close").select("symbol", "date", "returns"))


@query("w02_log_returns", oround(with_views(["bars"], f"""
SELECT symbol, date, CASE WHEN q > 0 THEN LN(q) END AS log_returns
FROM (SELECT symbol, date, close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY date), 0) AS q FROM bars) t"""),
    ["log_returns"]))
def w02(spark, sf):
    v = Views(spark, sf)
    return rounded(with_returns(v.bars, "close", kind="log", out="log_returns")
                   .select("symbol", "date", "log_returns"))


@query("w03_sma", oround(with_views(["bars"], f"""
SELECT symbol, date, {_minp('AVG(close)', 'close', 5)} AS sma_5, {_minp('AVG(close)', 'close', 20)} AS sma_20,
       {_minp('AVG(close)', 'close', 50)} AS sma_50 FROM bars"""), ["sma_5", "sma_20", "sma_50"]))
def w03(spark, sf):
    v = Views(spark, sf)
    return rounded(W.with_sma(v.bars.select("symbol", "date", "close"), "close", (5, 20, 50)).drop("close"))


EMA_SQL = with_views(["bars"], f"""
WITH t AS (SELECT symbol, date, close, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date) - 1 AS t FROM bars),
e12 AS ({_ema_sql('close', 12, 't')}), e26 AS ({_ema_sql('close', 26, 't')}),
m AS (SELECT t.symbol, t.date, t.t, e12.v AS ema_12, e26.v AS ema_26, e12.v - e26.v AS macd
      FROM t JOIN e12 ON t.symbol = e12.symbol AND t.date = e12.date
             JOIN e26 ON t.symbol = e26.symbol AND t.date = e26.date),
s AS ({_ema_sql('macd', 9, 'm')})
SELECT m.symbol, m.date, ema_12, ema_26, macd, s.v AS macd_signal, macd - s.v AS macd_histogram
FROM m JOIN s ON m.symbol = s.symbol AND m.date = s.date""")


@query("w04_ema", oround(f"SELECT symbol, date, ema_12, ema_26 FROM ({EMA_SQL}) x", ["ema_12", "ema_26"]))
def w04(spark, sf):
    v = Views(spark, sf)
    d = v.bars.select("symbol", "date", "close")
    return rounded(with_emas(d, "close", (12, 26)).drop("close"))


MACD_COLS = ["macd", "macd_signal", "macd_histogram"]


@query("w05_macd", oround(f"SELECT symbol, date, macd, macd_signal, macd_histogram FROM ({EMA_SQL}) x", MACD_COLS))
def w05(spark, sf):
    v = Views(spark, sf)
    return rounded(W.with_macd(v.bars.select("symbol", "date", "close"))
                   .select("symbol", "date", *MACD_COLS))


RSI_SQL = f"""
WITH d AS (SELECT symbol, date, close - LAG(close) OVER (PARTITION BY symbol ORDER BY date) AS delta FROM bars),
g AS (SELECT symbol, date,
        CASE WHEN COUNT(*) OVER {_w(14)} = 14 THEN AVG(CASE WHEN delta > 0 THEN delta ELSE 0 END) OVER {_w(14)} END AS gain,
        CASE WHEN COUNT(*) OVER {_w(14)} = 14 THEN AVG(CASE WHEN delta < 0 THEN -delta ELSE 0 END) OVER {_w(14)} END AS loss
      FROM d)
SELECT symbol, date, CASE WHEN loss > 0 THEN 100 - 100 / (1 + gain / loss) WHEN gain > 0 THEN 100.0 END AS rsi FROM g"""


@query("w06_rsi", oround(with_views(["bars"], RSI_SQL), ["rsi"]))
def w06(spark, sf):
    v = Views(spark, sf)
    return rounded(W.with_rsi(v.bars.select("symbol", "date", "close")).drop("close"))


BB_COLS = ["bb_middle", "bb_upper", "bb_lower", "bb_width"]
BB_SQL = f"""
WITH b AS (SELECT symbol, date, {_minp('AVG(close)', 'close', 20)} AS bb_middle,
                  {_minp('STDDEV_SAMP(close)', 'close', 20)} AS sd FROM bars)
SELECT symbol, date, bb_middle, bb_middle + sd * 2 AS bb_upper, bb_middle - sd * 2 AS bb_lower,
       (bb_middle + sd * 2) - (bb_middle - sd * 2) AS bb_width FROM b"""


@query("w07_bollinger", oround(with_views(["bars"], BB_SQL), BB_COLS))
def w07(spark, sf):
    v = Views(spark, sf)
    return rounded(W.with_bollinger(v.bars.select("symbol", "date", "close")).drop("close"))


@query("w08_volume_sma", oround(with_views(["bars"], f"""
WITH v AS (SELECT symbol, date, volume, {_minp('AVG(volume)', 'volume', 20)} AS volume_sma FROM bars)
SELECT symbol, date, volume_sma, volume / NULLIF(volume_sma, 0) AS volume_ratio FROM v"""),
    ["volume_sma", "volume_ratio"]))
def w08(spark, sf):
    v = Views(spark, sf)
    return rounded(W.with_volume_sma(v.bars.select("symbol", "date", "volume")).drop("volume"))


VOL_SQL = f"""
WITH r AS (SELECT symbol, date, {RET} AS returns FROM bars)
SELECT symbol, date, {_minp('STDDEV_SAMP(returns)', 'returns', 30)} * SQRT(252) AS volatility,
       {_minp('STDDEV_SAMP(returns)', 'returns', 30)} AS volatility_garch FROM r"""


@query("w09_rolling_volatility", oround(with_views(["bars"], VOL_SQL), ["volatility", "volatility_garch"]))
def w09(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close"), "close")
    return rounded(W.with_volatility(d).select("symbol", "date", "volatility", "volatility_garch"))


IND_COLS = ["returns", "sma_20", "sma_50", "ema_12", "ema_26", "macd", "macd_signal", "macd_histogram",
            "rsi", "bb_middle", "bb_upper", "bb_lower", "bb_width", "volume_sma", "volume_ratio",
            "volatility", "volatility_garch"]


@query("s23_indicator_table", oround(with_views(["bars"], f"""
WITH e AS ({EMA_SQL}), r AS ({RSI_SQL}), bb AS ({BB_SQL}), vo AS ({VOL_SQL}),
base AS (SELECT symbol, date, close, volume, {RET} AS returns,
                {_minp('AVG(close)', 'close', 20)} AS sma_20, {_minp('AVG(close)', 'close', 50)} AS sma_50,
                {_minp('AVG(volume)', 'volume', 20)} AS volume_sma FROM bars)
SELECT base.symbol, base.date, close, volume, returns, sma_20, sma_50, ema_12, ema_26, macd, macd_signal,
       macd_histogram, rsi, bb_middle, bb_upper, bb_lower, bb_width, volume_sma,
       volume / NULLIF(volume_sma, 0) AS volume_ratio, volatility, volatility_garch
FROM base JOIN e USING (symbol, date) JOIN r USING (symbol, date) JOIN bb USING (symbol, date)
     JOIN vo USING (symbol, date)"""), ["close"] + IND_COLS))
def s23(spark, sf):
    v = Views(spark, sf)
    return rounded(W.technical_indicators(v.bars))


PR_SQL = "WITH " + DENSE_PORTFOLIO


def _pw(n, off=0):
    return (f"(PARTITION BY portfolio_name ORDER BY date ROWS BETWEEN {n - 1 + off} PRECEDING AND "
            f"{str(off) + ' PRECEDING' if off else 'CURRENT ROW'})")


@query("w10_rolling_portfolio_metrics", oround(with_views(["bars", "holdings"], PR_SQL + f""",
x AS (SELECT portfolio_name, date,
        CASE WHEN COUNT(r) OVER {_pw(30)} = 30 THEN AVG(r) OVER {_pw(30)} / NULLIF(STDDEV_SAMP(r) OVER {_pw(30)}, 0) * SQRT(252) END AS rolling_sharpe,
        CASE WHEN COUNT(r) OVER {_pw(30)} = 30 THEN STDDEV_SAMP(r) OVER {_pw(30)} * SQRT(252) END AS rolling_volatility,
        CASE WHEN COUNT(r) OVER {_pw(30)} = 30 THEN QUANTILE_CONT(r, 0.05) OVER {_pw(30)} END AS rolling_var_95,
        CASE WHEN COUNT(r) OVER {_pw(30)} = 30 THEN QUANTILE_CONT(r, 0.01) OVER {_pw(30)} END AS rolling_var_99
      FROM pr)
SELECT * FROM x WHERE rolling_sharpe IS NOT NULL AND rolling_volatility IS NOT NULL
  AND rolling_var_95 IS NOT NULL AND rolling_var_99 IS NOT NULL"""),
    ["rolling_sharpe", "rolling_volatility", "rolling_var_95", "rolling_var_99"]))
def w10(spark, sf):
    v = Views(spark, sf)
    return rounded(W.rolling_portfolio_metrics(P.portfolio_returns(v.bars, v.holdings)))


@query("w11_prior_window_metrics", oround(with_views(["bars", "holdings"], PR_SQL + f""",
x AS (SELECT portfolio_name, date,
        CASE WHEN COUNT(r) OVER {_pw(30, 1)} = 30 THEN AVG(r) OVER {_pw(30, 1)} END AS m,
        CASE WHEN COUNT(r) OVER {_pw(30, 1)} = 30 THEN STDDEV_POP(r) OVER {_pw(30, 1)} END AS sd FROM pr)
SELECT portfolio_name, date, CASE WHEN sd > 0 THEN m / sd * SQRT(252) END AS prior_sharpe,
       sd * SQRT(252) AS prior_volatility FROM x WHERE sd IS NOT NULL"""), ["prior_sharpe", "prior_volatility"]))
def w11(spark, sf):
    v = Views(spark, sf)
    return rounded(W.prior_window_metrics(P.portfolio_returns(v.bars, v.holdings)))


@query("w15_growth_drawdown", oround(with_views(["bars", "holdings"], PR_SQL + """
SELECT portfolio_name, date, g AS growth, g - 1 AS cumulative_return, dd AS drawdown,
       SUM(r) OVER (PARTITION BY portfolio_name ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS cumulative_sum FROM dd"""), ["growth", "cumulative_return", "drawdown", "cumulative_sum"]))
def w15(spark, sf):
    v = Views(spark, sf)
    d = W.with_growth(P.portfolio_returns(v.bars, v.holdings))
    return rounded(d.select("portfolio_name", "date", "growth", "cumulative_return", "drawdown",
                            "cumulative_sum"))


@query("w16_cumulative_returns", oround(with_views(["bars"], f"""
WITH r AS (SELECT symbol, date, {RET} AS returns FROM bars)
SELECT symbol, date, SUM(returns) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING
       AND CURRENT ROW) AS cumulative_sum FROM r"""), ["cumulative_sum"]))
def w16(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close"), "close")
    w = F.sum("returns").over(__import__("tickframe.functions.exprs", fromlist=["running"]).running())
    return rounded(d.select("symbol", "date", w.alias("cumulative_sum")))


LAG_COLS = ["returns_lag_1", "returns_lag_5", "volatility_lag_5", "returns_lag_10", "volatility_lag_10",
            "returns_lag_20", "volatility_lag_20"]


@query("w17_lag_features", oround(with_views(["bars"], f"""
WITH r AS (SELECT symbol, date, {RET} AS returns FROM bars)
SELECT symbol, date,
  LAG(returns, 1) OVER (PARTITION BY symbol ORDER BY date) AS returns_lag_1,
  LAG(returns, 5) OVER (PARTITION BY symbol ORDER BY date) AS returns_lag_5,
  {_minp('STDDEV_SAMP(returns)', 'returns', 5, 1)} AS volatility_lag_5,
  LAG(returns, 10) OVER (PARTITION BY symbol ORDER BY date) AS returns_lag_10,
  {_minp('STDDEV_SAMP(returns)', 'returns', 10, 1)} AS volatility_lag_10,
  LAG(returns, 20) OVER (PARTITION BY symbol ORDER BY date) AS returns_lag_20,
  {_minp('STDDEV_SAMP(returns)', 'returns', 20, 1)} AS volatility_lag_20 FROM r"""), LAG_COLS))
def w17(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close"), "close")
    return rounded(W.with_lags(d).select("symbol", "date", *LAG_COLS))


RATIO_SQL = f"""
WITH s AS (SELECT symbol, date, close, {_minp('AVG(close)', 'close', 5)} AS sma_5,
                  {_minp('AVG(close)', 'close', 20)} AS sma_20, {_minp('AVG(close)', 'close', 50)} AS sma_50 FROM bars)
SELECT symbol, date, close / NULLIF(sma_5, 0) AS price_sma5_ratio, close / NULLIF(sma_20, 0) AS price_sma20_ratio,
       close / NULLIF(sma_50, 0) AS price_sma50_ratio FROM s"""
RATIO_COLS = ["price_sma5_ratio", "price_sma20_ratio", "price_sma50_ratio"]


def _ratios(v):
    d = W.with_sma(v.bars.select("symbol", "date", "close"), "close", (5, 20, 50))
    from tickframe.functions.exprs import safe_div
    return d.select("symbol", "date", *[safe_div("close", f"sma_{n}").alias(f"price_sma{n}_ratio")
                                        for n in (5, 20, 50)])


@query("w19_price_sma_ratio", oround(with_views(["bars"], RATIO_SQL), RATIO_COLS))
def w19(spark, sf):
    return rounded(_ratios(Views(spark, sf)))


@query("w19_last_ratio_snapshot", oround(with_views(["bars"], f"""
SELECT symbol, ARG_MAX(price_sma20_ratio, date) AS last_price_sma20_ratio,
       ARG_MAX(price_sma50_ratio, date) AS last_price_sma50_ratio FROM ({RATIO_SQL}) x GROUP BY symbol"""),
    ["last_price_sma20_ratio", "last_price_sma50_ratio"]))
def w19_last(spark, sf):
    d = _ratios(Views(spark, sf))
    return rounded(d.groupBy("symbol").agg(F.max_by("price_sma20_ratio", "date").alias("last_price_sma20_ratio"),
                                           F.max_by("price_sma50_ratio", "date").alias("last_price_sma50_ratio")))


@query("w20_unannualised_volatility", oround(with_views(["bars"], f"""
WITH r AS (SELECT symbol, date, {RET} AS returns FROM bars)
SELECT symbol, date, {_minp('STDDEV_SAMP(returns)', 'returns', 5)} AS volatility_5,
       {_minp('STDDEV_SAMP(returns)', 'returns', 20)} AS volatility_20 FROM r"""), ["volatility_5", "volatility_20"]))
def w20(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close"), "close")
    d = W.with_rolling_std(d, "returns", 5, "volatility_5")
    return rounded(W.with_rolling_std(d, "returns", 20, "volatility_20").select(
        "symbol", "date", "volatility_5", "volatility_20"))


VP_COLS = ["volatility_5d", "volatility_20d", "volatility_60d", "volatility_of_volatility"]


@query("w21_volatility_profile", oround(with_views(["bars"], f"""
WITH r AS (SELECT symbol, date, {RET} AS returns FROM bars),
v AS (SELECT symbol, {_minp('STDDEV_SAMP(returns)', 'returns', 5)} AS v5, {_minp('STDDEV_SAMP(returns)', 'returns', 20)} AS v20,
             {_minp('STDDEV_SAMP(returns)', 'returns', 60)} AS v60 FROM r)
SELECT symbol, AVG(v5) AS volatility_5d, AVG(v20) AS volatility_20d, AVG(v60) AS volatility_60d,
       STDDEV_SAMP(v20) AS volatility_of_volatility FROM v GROUP BY symbol"""), VP_COLS))
def w21(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close"), "close")
    return rounded(W.vol_profile(d))


@query("w22_position_change", with_views(["bars"], f"""
WITH r AS (SELECT symbol, date, {RET} AS returns FROM bars),
s AS (SELECT symbol, date, CASE WHEN returns > 0 THEN 1 ELSE -1 END AS signal FROM r)
SELECT symbol, date, signal, COALESCE(signal - LAG(signal) OVER (PARTITION BY symbol ORDER BY date), 0)
       AS position_change FROM s"""))
def w22(spark, sf):
    v = Views(spark, sf)
    d = with_returns(v.bars.select("symbol", "date", "close"), "close")
    d = d.withColumn("signal", F.when(F.col("returns") > 0, 1).otherwise(-1))
    return W.with_position_change(d).select("symbol", "date", "signal", "position_change")


@query("w23_range_return", oround(with_views(["bars"], """
SELECT symbol, MIN(date) AS first_date, MAX(date) AS last_date, ARG_MIN(close, date) AS first_close,
       ARG_MAX(close, date) AS last_close, ARG_MAX(close, date) / NULLIF(ARG_MIN(close, date), 0) - 1 AS range_return
FROM bars GROUP BY symbol"""), ["first_close", "last_close", "range_return"]))
def w23(spark, sf):
    v = Views(spark, sf)
    return rounded(W.range_return(v.bars))


@query("w25_rank_by_return", oround(with_views(["bars"], """
WITH t AS (SELECT symbol, ARG_MAX(close, date) / NULLIF(ARG_MIN(close, date), 0) - 1 AS range_return
           FROM bars GROUP BY symbol)
SELECT symbol, range_return, CAST(ROW_NUMBER() OVER (ORDER BY range_return DESC NULLS LAST, symbol) AS BIGINT) AS rank
FROM t"""), ["range_return"]))
def w25(spark, sf):
    v = Views(spark, sf)
    t = W.range_return(v.bars).select("symbol", "range_return")
    # one row per symbol: the ranking window runs over #symbols rows
    from pyspark.sql import Window
    w = Window.orderBy(F.desc_nulls_last("range_return"), "symbol")
    return rounded(t.withColumn("rank", F.row_number().over(w).cast("bigint")))


# fixed values: dashboard period presets (days back from the data's last date, sampling)
PERIOD_PRESETS = [("1M", 30, "D"), ("3M", 90, "W"), ("6M", 180, "W"), ("1Y", 365, "W"), ("2Y", 730, "M"),
                  ("ALL", None, "M")]


def _preset_sql():
    parts = []
    for name, days, freq in PERIOD_PRESETS:
        start = "(SELECT MIN(date) FROM bars)" if days is None else f"(SELECT MAX(date) - INTERVAL {days} DAY FROM bars)"
        bucket = {"D": "date", "W": "CAST(date + CAST((7 - ISODOW(date)) % 7 AS INTEGER) AS DATE)",
                  "M": "LAST_DAY(date)"}[freq]
        parts.append(f"SELECT '{name}' AS preset, symbol, CAST({bucket} AS DATE) AS period_end, date, close FROM bars "
                     f"WHERE date >= {start}")
    return " UNION ALL ".join(parts)


def _presets(b):
    """A row per preset (preset, start_date, end_date, frequency) from the one-row date range of b."""
    ext = b.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("preset"), F.lit(d).cast("int").alias("days"), F.lit(fq).alias("frequency")) for n, d, fq in PERIOD_PRESETS]))
    p = ext.select("lo", "hi", rows.alias("p")).select("lo", "hi", "p.*")
    return p.select("preset", F.coalesce(F.date_sub("hi", F.col("days")), "lo").alias("start_date"), F.col("hi").alias("end_date"), "frequency")


@query("f17_period_presets", with_views(["bars"], "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS preset, CAST({'(SELECT MIN(date) FROM bars)' if d is None else f'(SELECT MAX(date) - INTERVAL {d} DAY FROM bars)'} AS DATE)"
    f" AS start_date, (SELECT MAX(date) FROM bars) AS end_date, '{fq}' AS frequency" for n, d, fq in PERIOD_PRESETS) + ") p"))
def f17(spark, sf):
    """F-17: period presets resolved against the data's last date (not the wall clock)."""
    b = Views(spark, sf).bars
    return _presets(b).select("preset", "start_date", "end_date", "frequency")


@query("w24_period_returns", oround(with_views(["bars"], f"""
WITH p AS ({_preset_sql()}),
l AS (SELECT preset, symbol, period_end, ARG_MAX(close, date) AS close FROM p GROUP BY 1, 2, 3)
SELECT preset, symbol, period_end, close / NULLIF(LAG(close) OVER (PARTITION BY preset, symbol ORDER BY period_end), 0) - 1
       AS period_return FROM l"""), ["period_return"]))
def w24(spark, sf):
    """W-24: for each preset, the last close of every sampling period and its return
    (C-07 resampling + W-01 on real data instead of the reference's random series)."""
    from tickframe.operators.clean import period_end
    b = Views(spark, sf).bars.select("symbol", "date", "close")
    # one pass: every bar meets the six presets and stays with those that it falls in
    j = b.join(F.broadcast(_presets(b)), F.col("date") >= F.col("start_date"))
    end = F.when(F.col("frequency") == "D", period_end("date", "D")).when(F.col("frequency") == "W", period_end("date", "W")).otherwise(period_end("date", "M"))
    out = j.groupBy("preset", "symbol", end.alias("period_end")).agg(F.max_by("close", "date").alias("close"))
    r = with_returns(out, "close", keys=("preset", "symbol"), order="period_end", out="period_return", ffill=False)
    return rounded(r.select("preset", "symbol", "period_end", "period_return"))


@query("a11_cross_sectional_mean", oround(with_views(["bars"], """
WITH r AS (SELECT symbol, date, close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS r FROM bars)
SELECT date, AVG(r) AS mean_return, CAST(COUNT(r) AS BIGINT) AS n_symbols FROM r WHERE r IS NOT NULL GROUP BY 1"""),
    ["mean_return"], 9))
def a11(spark, sf):
    """A-11: equal-weight cross-sectional return per date over the symbols trading that day."""
    d = with_returns(Views(spark, sf).bars.select("symbol", "date", "close"), "close", out="r", ffill=False)
    return rounded(d.filter(F.col("r").isNotNull()).groupBy("date").agg(
        F.avg("r").alias("mean_return"), F.count("r").cast("bigint").alias("n_symbols")), 9)


@query("a12_total_portfolio_value", oround(with_views(["bars", "holdings"], "WITH " + __import__(
    "tickframe.plans.oracle_blocks", fromlist=["DENSE_PORTFOLIO"]).DENSE_PORTFOLIO + """
,
hv AS (SELECT portfolio_name, date, 10000 * w * fp / FIRST_VALUE(fp) OVER (PARTITION BY portfolio_name, symbol ORDER BY date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM filled)
SELECT portfolio_name, date, SUM(v) AS total_value FROM hv GROUP BY 1, 2"""), ["total_value"], 6))
def a12(spark, sf):
    """A-12: buy-and-hold value of each portfolio per date: the holdings' values (initial
    10,000 split by normalised weight, grown with the filled price) summed per date."""
    from pyspark.sql import Window
    from tickframe.operators import joins as J
    from tickframe.operators import portfolio as P
    v = Views(spark, sf)
    panel = J.union_calendar_panel(v.bars, v.holdings)
    w = P.normalised_weights(v.holdings, v.bars.select("symbol").distinct()).select("portfolio_name", "symbol", "w")
    first = F.first("price").over(Window.partitionBy("portfolio_name", "symbol").orderBy("date"))
    d = panel.join(w, ["portfolio_name", "symbol"]).withColumn("value", 10000 * F.col("w") * F.col("price") / first)
    return rounded(d.groupBy("portfolio_name", "date").agg(F.sum("value").alias("total_value")))
