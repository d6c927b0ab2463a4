"""Queries on whole vendor documents: S-09 (eight fields), S-11 (rejects beside parsed rows), S-16, S-17 (44 fields).

The documents are made from the tables in the vendor's layouts, with missing, null and unreadable values among them; the oracle
states what must come out of them with its own constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.plans.catalog import query
from tickframe.plans.common import Views, materialise, oround, rounded
from tickframe.plans.views_sql import with_views
from tickframe.sources import vendor as V

ACTIONS_SQL = """
SELECT symbol, date, open, high, low, close, CAST(volume AS DOUBLE) AS volume,
       CASE WHEN date = MAX(date) OVER (PARTITION BY symbol, DATE_TRUNC('quarter', date)) THEN close * 0.01 ELSE 0.0 END AS dividend,
       CASE WHEN date = MAX(date) OVER (PARTITION BY symbol, YEAR(date)) AND YEAR(date) % 3 = 0 THEN 2.0 ELSE 1.0 END AS split FROM bars"""


def _actions(bars: DataFrame) -> DataFrame:
    """Bars with a dividend on a symbol's last day of a quarter and a split on its last day of every third year."""
    quarter = F.max("date").over(Window.partitionBy("symbol", F.date_trunc("quarter", "date")))
    year = F.max("date").over(Window.partitionBy("symbol", F.year("date")))
    return bars.select("symbol", "date", "open", "high", "low", "close", F.col("volume").cast("double").alias("volume"),
                       F.when(F.col("date") == quarter, F.col("close") * 0.01).otherwise(0.0).alias("dividend"),
                       F.when((F.col("date") == year) & (F.year("date") % 3 == 0), 2.0).otherwise(1.0).alias("split"))


def _month_documents(rows: DataFrame) -> DataFrame:
    """A daily document per symbol and month; the dividend of every 13th is text, the volume of every 20th is missing."""
    value = {"adjusted_close": F.col("close"), "dividend_amount": F.when(F.dayofmonth("date") == 13, "n/a").otherwise(F.col("dividend").cast("string")),
             "split_coefficient": F.col("split"), "volume": F.when(F.dayofmonth("date") != 20, F.col("volume"))}
    entry = F.struct(*[value.get(c, F.col(c) if c in rows.columns else None).cast("string").alias(n) for n, c in V.ADJUSTED_FIELDS])
    per = rows.groupBy("symbol", F.date_trunc("month", "date").alias("_m")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd"), entry))).alias("_ts"), F.count(F.lit(1)).alias("n"))
    return per.select("symbol", "n", F.to_json(F.struct(F.col("_ts").alias(V.VENDOR_SERIES_KEY))).alias("payload"))


@query("s09_parse_adjusted_bars", with_views(["bars"], f"""
WITH a AS ({ACTIONS_SQL})
SELECT symbol, date, open, high, low, close, close AS adjusted_close, CASE WHEN DAY(date) <> 20 THEN volume END AS volume,
       CASE WHEN DAY(date) <> 13 THEN dividend END AS dividend_amount, CAST(split AS DOUBLE) AS split_coefficient, 'alpha_vantage' AS data_source FROM a"""))
def s09_adjusted(spark, sf):
    """S-09: the adjusted daily payload with all its eight fields; unreadable and missing numbers are null."""
    return V.adjusted_bars(_month_documents(_actions(Views(spark, sf).bars)))


@query("s11_parsed_and_rejected", with_views(["bars"], """
WITH b AS (SELECT *, COUNT(*) OVER (PARTITION BY symbol, DATE_TRUNC('month', date)) AS n FROM bars),
m AS (SELECT symbol, DATE_TRUNC('month', date) AS m, COUNT(*) AS n FROM bars GROUP BY 1, 2)
SELECT 'row' AS kind, symbol, date, close, NULL AS reason FROM b WHERE n > 4
UNION ALL SELECT 'reject', symbol, NULL, NULL, CASE n WHEN 1 THEN 'empty answer' WHEN 2 THEN 'not a JSON object'
  WHEN 3 THEN 'Invalid API call' ELSE 'API call frequency exceeded' END FROM m WHERE n <= 4"""))
def s11_parsed(spark, sf):
    """S-11: the documents of thin months are empty, cut short, an error or a limit note; these become rejects with their reason, and
    the good ones are parsed on to rows."""
    docs = _month_documents(_actions(Views(spark, sf).bars))
    note = lambda key, text: F.to_json(F.struct(F.lit(text).alias(key)))
    docs = docs.withColumn("payload", F.when(F.col("n") == 1, F.lit(None)).when(F.col("n") == 2, F.substring("payload", 1, 30))
                           .when(F.col("n") == 3, note("Error Message", "Invalid API call"))
                           .when(F.col("n") == 4, note("Note", "API call frequency exceeded")).otherwise(F.col("payload")))
    rows = V.adjusted_bars(docs).select(F.lit("row").alias("kind"), "symbol", "date", "close", F.lit(None).cast("string").alias("reason"))
    return rows.unionByName(V.rejected(docs).select(F.lit("reject").alias("kind"), "symbol", F.lit(None).cast("date").alias("date"),
                                                    F.lit(None).cast("double").alias("close"), "reason"))


@query("s16_dividends_splits", with_views(["bars"], f"""
WITH a AS ({ACTIONS_SQL})
SELECT symbol, date, 'dividend' AS action, dividend AS value FROM a WHERE dividend > 0
UNION ALL SELECT symbol, date, 'split', CAST(split AS DOUBLE) FROM a WHERE split <> 1"""))
def s16_actions(spark, sf):
    """S-16: dividend and split series, a document per symbol and year, as dated rows."""
    a = _actions(Views(spark, sf).bars)

    def series(cond, col):  # collect_list leaves out the null entries
        return F.map_from_entries(F.collect_list(F.when(cond, F.struct(F.date_format("date", "yyyy-MM-dd"), F.col(col)))))
    per = a.groupBy("symbol", F.year("date").alias("_y")).agg(
        series(F.col("dividend") > 0, "dividend").alias("dividends"), series(F.col("split") != 1, "split").alias("splits"))
    return V.corporate_actions(per.select("symbol", F.to_json(F.struct("dividends", "splits")).alias("payload")))


@query("s16_company_overview", oround(with_views(["stock_info"], """
SELECT symbol, name, sector, NULLIF(industry, 'Brand#11') AS industry, market_cap, pe_ratio, peg_ratio, dividend_yield,
       CASE WHEN CAST(symbol AS BIGINT) % 5 <> 0 THEN beta END AS beta FROM stock_info"""), ["market_cap", "pe_ratio", "peg_ratio", "dividend_yield", "beta"], 4))
def s16_overview(spark, sf):
    """S-16: overview documents, all values text, missing ones as the vendor writes them, as typed rows."""
    si = Views(spark, sf).stock_info
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("None")) for _, c, _ in V.OVERVIEW_FIELDS}
    text["beta"] = F.when(F.col("symbol").cast("bigint") % 5 == 0, "-").otherwise(text["beta"])
    text["industry"] = F.when(F.col("industry") == "Brand#11", "").otherwise(text["industry"])
    return rounded(V.company_overview(si.select("symbol", F.to_json(F.struct(*[text[c].alias(n) for n, c, _ in V.OVERVIEW_FIELDS])).alias("payload"))), 4)


@query("s16_earnings", oround("""
WITH o AS (SELECT n.n_name AS symbol, CAST(o.o_orderdate AS DATE) AS d, CAST(o.o_totalprice AS DECIMAL(38, 6)) AS p
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
q AS (SELECT symbol, 'quarterly' AS period, CAST(DATE_TRUNC('quarter', d) AS DATE) AS fiscal_date, CAST(SUM(p) AS DOUBLE) / COUNT(*) AS e, CAST(MIN(p) AS DOUBLE) AS m
      FROM o GROUP BY 1, 3 UNION ALL
      SELECT symbol, 'annual', CAST(DATE_TRUNC('year', d) AS DATE), CAST(SUM(p) AS DOUBLE) / COUNT(*), CAST(MIN(p) AS DOUBLE) FROM o GROUP BY 1, 3)
SELECT symbol, period, fiscal_date, e AS reported_eps, CASE WHEN period = 'quarterly' THEN m END AS estimated_eps,
       CASE WHEN period = 'quarterly' THEN e - m END AS surprise FROM q""", ["reported_eps", "estimated_eps", "surprise"], 4))
def s16_earnings(spark, sf):
    """S-16: earnings documents per company and year with an annual and a quarterly array; annual records carry no estimate."""
    v = Views(spark, sf)
    o = (v.table("orders").select("o_custkey", F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").cast("decimal(38,6)").alias("p"))
         .join(v.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
         .join(v.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("symbol")), "c_nationkey"))

    def records(unit, full):
        g = o.groupBy("symbol", F.to_date(F.date_trunc(unit, "d")).alias("f")).agg(
            (F.sum("p").cast("double") / F.count(F.lit(1))).alias("e"), F.min("p").cast("double").alias("m"))
        return g.select("symbol", F.year("f").alias("y"), F.lit(full).alias("full"), F.struct(
            F.date_format("f", "yyyy-MM-dd").alias("fiscalDateEnding"), F.col("e").cast("string").alias("reportedEPS"),
            F.when(F.lit(full), F.col("m").cast("string")).otherwise("None").alias("estimatedEPS"),
            F.when(F.lit(full), (F.col("e") - F.col("m")).cast("string")).alias("surprise")).alias("r"))
    docs = records("quarter", True).unionByName(records("year", False)).groupBy("symbol", "y").agg(F.to_json(F.struct(
        F.collect_list(F.when(~F.col("full"), F.col("r"))).alias("annualEarnings"),
        F.collect_list(F.when(F.col("full"), F.col("r"))).alias("quarterlyEarnings"))).alias("payload"))
    return rounded(V.earnings(docs), 4)


# what the made-up vendor reports beside the columns of stock_info, as SQL that both engines read; k is the number of the part
_REPORTED = {
    "previousClose": "current_price * 0.99", "regularMarketChange": "current_price * 0.01", "regularMarketChangePercent": "CASE WHEN k % 2 = 0 THEN 1.0101 END",
    "averageVolume": "volume + k", "forwardPE": "pe_ratio * 0.9", "priceToBook": "CASE WHEN k % 3 = 0 THEN 1.5 END", "priceToSalesTrailing12Months": "beta + 1",
    "dividendRate": "current_price * 0.02", "revenueGrowth": "CASE WHEN k % 4 <> 0 THEN return_on_equity END", "earningsGrowth": "profit_margins * 0.5",
    "fiftyTwoWeekHigh": "current_price * 1.25", "fiftyTwoWeekLow": "current_price * 0.75", "enterpriseValue": "market_cap * 1.125",
    "sharesOutstanding": "volume * 1000", "floatShares": "volume * 900", "shortRatio": "beta * 0.25", "shortPercentOfFloat": "CASE WHEN k % 6 = 0 THEN 0.125 END",
    "institutionOwnership": "0.5", "insiderOwnership": "CASE WHEN k % 2 = 1 THEN 0.25 END", "recommendationMean": "peg_ratio", "targetMeanPrice": "current_price * 1.5",
    "fullTimeEmployees": "CASE WHEN k % 5 <> 0 THEN volume * 3 END", "founded": "CASE WHEN k % 7 = 0 THEN 1900 + k % 100 END"}


LARGE = {"market_cap": 0, "enterprise_value": 0}  # digits that a double of this size holds


@query("s17_fundamentals", oround(with_views(["stock_info"], f"""
WITH u AS (SELECT CAST(l_partkey AS VARCHAR) AS symbol, MAX(CAST(l_shipdate AS DATE)) AS seen FROM lineitem GROUP BY 1),
s AS (SELECT i.*, u.seen, CAST(i.symbol AS BIGINT) AS k FROM stock_info i JOIN u ON i.symbol = u.symbol),
r AS (SELECT *, {', '.join(f'{e} AS "{n}"' for n, e in _REPORTED.items())} FROM s)
SELECT symbol, CASE WHEN k % 10 = 0 THEN '' ELSE name END AS name, sector, industry, market_cap,
  CASE WHEN market_cap IS NULL OR market_cap <= 0 THEN 'Unknown' WHEN market_cap >= 10000000000 THEN 'Large Cap'
       WHEN market_cap >= 2000000000 THEN 'Mid Cap' WHEN market_cap >= 300000000 THEN 'Small Cap' ELSE 'Micro Cap' END AS market_cap_category,
  CASE k % 3 WHEN 2 THEN 0 ELSE current_price END AS current_price, "previousClose" AS previous_close, "regularMarketChange" AS day_change,
  COALESCE("regularMarketChangePercent", 0) AS day_change_percent, volume, CAST("averageVolume" AS BIGINT) AS avg_volume, COALESCE(pe_ratio, 0) AS pe_ratio,
  COALESCE("forwardPE", 0) AS forward_pe, COALESCE(peg_ratio, 0) AS peg_ratio, COALESCE("priceToBook", 0) AS price_to_book,
  "priceToSalesTrailing12Months" AS price_to_sales, dividend_yield, "dividendRate" AS dividend_rate, beta, debt_to_equity, return_on_equity, profit_margins,
  COALESCE("revenueGrowth", 0) AS revenue_growth, "earningsGrowth" AS earnings_growth, "fiftyTwoWeekHigh" AS "52_week_high", "fiftyTwoWeekLow" AS "52_week_low",
  "enterpriseValue" AS enterprise_value, CAST("sharesOutstanding" AS BIGINT) AS shares_outstanding, CAST("floatShares" AS BIGINT) AS float_shares,
  "shortRatio" AS short_ratio, COALESCE("shortPercentOfFloat", 0) AS short_percent, 0.5 AS institutional_ownership, COALESCE("insiderOwnership", 0) AS insider_ownership,
  COALESCE("recommendationMean", 0) AS analyst_recommendation, "targetMeanPrice" AS target_price, CASE WHEN k % 4 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
  '' AS exchange, 'x' || (k % 9) AS country, '' AS website, '' AS business_summary, CAST(COALESCE("fullTimeEmployees", 0) AS BIGINT) AS employees,
  CAST(COALESCE("founded", 0) AS BIGINT) AS founded_year, STRFTIME(seen, '%Y-%m-%dT%H:%M:%S') AS last_updated FROM r"""),
    ["market_cap", "current_price", "previous_close", "day_change", "day_change_percent", "pe_ratio", "forward_pe", "peg_ratio", "price_to_book", "price_to_sales",
     "dividend_yield", "dividend_rate", "beta", "debt_to_equity", "return_on_equity", "profit_margins", "revenue_growth", "earnings_growth", '"52_week_high"',
     '"52_week_low"', "enterprise_value", "short_ratio", "short_percent", "institutional_ownership", "insider_ownership", "analyst_recommendation", "target_price"], 3, LARGE))
def s17_fundamentals(spark, sf):
    """S-17: all 44 fields from company documents with missing, null and unreadable values; the collection time is the last day the
    tables know of a part."""
    v = Views(spark, sf)
    at = v.table("lineitem").groupBy(F.col("l_partkey").cast("string").alias("symbol")).agg(F.max(F.to_date("l_shipdate")).cast("timestamp").alias("at"))
    s = v.stock_info.join(at, "symbol").withColumn("k", F.col("symbol").cast("bigint"))
    third = F.col("k") % 3
    known = {"longName": F.when(F.col("k") % 10 != 0, F.col("name")), "sector": F.col("sector"), "industry": F.col("industry"), "marketCap": F.col("market_cap"),
             "currentPrice": F.when(third == 0, F.col("current_price").cast("string")).when(third == 2, "soon"),
             "regularMarketPrice": F.when(third == 1, F.col("current_price")), "volume": F.col("volume"), "trailingPE": F.col("pe_ratio"),
             "pegRatio": F.col("peg_ratio"), "dividendYield": F.col("dividend_yield"), "beta": F.col("beta"), "debtToEquity": F.col("debt_to_equity"),
             "returnOnEquity": F.col("return_on_equity"), "profitMargins": F.col("profit_margins"),
             "currency": F.when(F.col("k") % 4 == 0, "EUR"), "country": F.concat(F.lit("x"), F.col("k") % 9)}
    fields = {**known, **{n: F.expr(e) for n, e in _REPORTED.items()}}
    docs = s.select("symbol", "at", F.to_json(F.struct(*[e.alias(n) for n, e in fields.items()])).alias("payload"))
    return rounded(V.fundamentals(materialise(docs), F.col("at")), 3, LARGE)  # the documents land before they are read
