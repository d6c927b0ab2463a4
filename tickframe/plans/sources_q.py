"""Source / sink queries S-08 .. S-29: every write lands under the shared scratch root
and is read back, so the check covers the round trip."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.operators import portfolio as P
from tickframe.operators import quality as Q
from tickframe.operators import screen as S
from tickframe.operators import windows as W
from tickframe.plans.catalog import query
from tickframe.plans.common import Views, oround, rounded
from tickframe.plans.portfolio_q import R17_SQL, R18_SQL
from tickframe.plans.views_sql import with_views
from tickframe.sources import files as FS

BARS8 = "symbol, date, open, high, low, close, adjusted_close, volume"


@query("s08_csv_landing_roundtrip", with_views(["bars"], f"SELECT {BARS8}, data_source FROM bars"))
def s08(spark, sf):
    v = Views(spark, sf)
    path = FS.write_landing_csv(v.bars, FS.scratch(spark, "landing"))
    back = FS.landing_rows(FS.read_landing_csv(spark, path))
    return back.select(*BARS8.split(", "), "data_source")


@query("s08_landing_stream", with_views(["bars"], f"""
SELECT 'row' AS kind, CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(DISTINCT symbol || date::VARCHAR) AS BIGINT) AS n_distinct, CAST(SUM(volume) AS BIGINT) AS total FROM bars
UNION ALL SELECT 'reject', COUNT(DISTINCT symbol), COUNT(DISTINCT symbol), NULL FROM bars"""))
def s08_stream(spark, sf):
    """S-08: files land in two parts, with one unreadable line for every symbol, and the stream is started anew after each part and
    once more without new files: every line is read once, rejects are kept."""
    b = Views(spark, sf).bars
    landing, table, rejects, progress = (FS.scratch(spark, k) for k in ("landing", "landed", "landed-rejects", "landed-progress"))
    early = F.col("date") < F.lit("1995-01-01").cast("date")
    bad = b.select("symbol", "data_source").distinct().select("symbol", F.lit("no date").alias("date"), *(F.lit("x").alias(c) for c in BARS8.split(", ")[2:]), "data_source")
    for part in (b.where(early), b.where(~early), bad):
        part.write.mode("append").partitionBy("data_source", "symbol").option("header", True).csv(landing)
        FS.stream_landing_csv(spark, landing, table, rejects, progress)
    FS.stream_landing_csv(spark, landing, table, rejects, progress)
    rows, lines = spark.read.parquet(table), spark.read.parquet(rejects)
    read = rows.agg(F.lit("row").alias("kind"), F.count(F.lit(1)).alias("n"), F.countDistinct("symbol", "date").alias("n_distinct"), F.sum("volume").alias("total"))
    return read.unionByName(lines.agg(F.lit("reject").alias("kind"), F.count(F.lit(1)).alias("n"), F.countDistinct("source_file").alias("n_distinct"),
                                      F.lit(None).cast("bigint").alias("total")))


@query("s09_parse_vendor_bars", with_views(["bars"], """
SELECT symbol, date, open, high, low, close, volume, 'alpha_vantage' AS data_source FROM bars"""))
def s09(spark, sf):
    """S-09: vendor daily-bar documents (one per symbol-month, derived from the bars) parsed back."""
    return FS.parse_daily_bars(FS.vendor_payloads(Views(spark, sf).bars))


@query("s10_parse_indicator_json", oround(with_views(["bars"], """
SELECT symbol, date, 'SMA' AS indicator, value FROM (
  SELECT symbol, date, CASE WHEN COUNT(close) OVER w = 20 THEN AVG(close) OVER w END AS value FROM bars
  WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) x WHERE value IS NOT NULL"""),
    ["value"]))
def s10(spark, sf):
    ind = W.with_sma(Views(spark, sf).bars.select("symbol", "date", "close"), "close", (20,))
    return rounded(FS.parse_indicator(FS.indicator_payloads(ind, "SMA", "sma_20")))


ERR_SQL = """
WITH m AS (SELECT symbol, DATE_TRUNC('month', date) AS m, COUNT(*) AS n FROM bars GROUP BY 1, 2)
SELECT CASE WHEN n < 3 THEN 'rejected' ELSE 'accepted' END AS status, CAST(COUNT(*) AS BIGINT) AS documents FROM m GROUP BY 1"""


@query("s11_vendor_error_split", with_views(["bars"], ERR_SQL))
def s11(spark, sf):
    """S-11: documents of thin months are replaced by the vendor's rate-limit note; the split
    separates good documents from rejected ones."""
    b = Views(spark, sf).bars
    per = b.groupBy("symbol", F.date_trunc("month", "date").alias("_m")).agg(F.count("*").alias("n"))
    pay = per.select("symbol", F.when(F.col("n") < 3, F.to_json(F.struct(F.lit("API call frequency exceeded")
                                                                      .alias("Note"))))
                     .otherwise(F.to_json(F.struct(F.col("n").alias("bars")))).alias("payload"))
    good, bad = FS.split_errors(pay)
    return (good.select(F.lit("accepted").alias("status")).unionByName(bad.select(F.lit("rejected").alias("status")))
            .groupBy("status").agg(F.count("*").cast("bigint").alias("documents")))


@query("s12_normalise_vendor_bars", with_views(["bars"], """
SELECT symbol, date, open, high, low, close, CASE WHEN DAYOFMONTH(date) % 10 = 0 THEN 0 ELSE volume END AS volume,
       'alpha_vantage' AS data_source FROM bars"""))
def s12(spark, sf):
    """S-12: vendor rows with a missing volume get 0; unparseable numbers become null."""
    b = Views(spark, sf).bars.withColumn("volume", F.when(F.dayofmonth("date") % 10 == 0, F.lit(None))
                                         .otherwise(F.col("volume")))
    return FS.parse_daily_bars(FS.vendor_payloads(b))


@query("s13_lineage_columns", with_views(["bars"], """
SELECT symbol, data_source, CAST(COUNT(*) AS BIGINT) AS rows, TRUE AS has_file_lineage,
       TIMESTAMP '2024-01-31 00:00:00' AS collected_at FROM bars GROUP BY 1, 2"""))
def s13(spark, sf):
    """S-13: symbol / source from the landing layout, file name per row, collection time as a parameter.

    Partition folder names are escaped twice in the file URI (path escaping, then URI
    encoding), hence the double decode."""
    path = FS.write_landing_csv(Views(spark, sf).bars, FS.scratch(spark, "landing"))
    back = FS.landing_rows(FS.read_landing_csv(spark, path))
    return back.groupBy("symbol", "data_source").agg(
        F.count("*").cast("bigint").alias("rows"),
        F.bool_and(F.url_decode(F.url_decode("source_file")).contains(F.concat(F.lit("symbol="), F.col("symbol"))))
        .alias("has_file_lineage")
    ).withColumn("collected_at", F.lit("2024-01-31 00:00:00").cast("timestamp"))


@query("s14_macro_normalise", with_views(["macro"], """
SELECT series_id, date, value FROM macro WHERE date >= DATE '1995-01-01'"""))
def s14(spark, sf):
    """S-14: per-series wide frame (as a vendor returns it) back to (series_id, date, value), range-filtered."""
    wide = Views(spark, sf).macro.groupBy("date").pivot("series_id").agg(F.first("value"))
    return FS.normalise_series(wide, start="1995-01-01")


@query("s15_dataset_collapse", with_views(["bars"], """
WITH l AS (UNPIVOT (SELECT symbol, date, open, high, low, close FROM bars) ON open, high, low, close INTO NAME field VALUE value)
SELECT symbol, field, LAST_DAY(date) AS period, ARG_MAX(value, date) AS value FROM l GROUP BY 1, 2, 3"""))
def s15(spark, sf):
    """S-15: multi-column dataset to long (unpivot), collapsed to monthly (last value per period)."""
    from tickframe.operators.clean import period_end
    b = Views(spark, sf).bars.select("symbol", "date", "open", "high", "low", "close")
    long = b.unpivot(["symbol", "date"], ["open", "high", "low", "close"], "field", "value")
    return long.groupBy("symbol", "field", period_end("date", "M").alias("period")).agg(
        F.max_by("value", "date").alias("value"))


INFO_SQL = """
SELECT industry AS symbol, industry AS name, ANY_VALUE(sector) AS sector, industry, SUM(market_cap) AS market_cap,
  CASE WHEN CAST(SUBSTR(industry, 7) AS INT) % 3 = 0 THEN MAX(current_price) ELSE MIN(current_price) END AS current_price
FROM stock_info GROUP BY industry"""


def _info_docs(v):
    si = v.stock_info
    per = si.groupBy("industry").agg(F.min("sector").alias("sector"), F.sum("market_cap").alias("marketCap"),
                                     F.max("current_price").alias("mx"), F.min("current_price").alias("mn"))
    # every third brand only reports regularMarketPrice (the fallback path)
    third = F.substring("industry", 7, 10).cast("int") % 3 == 0
    doc = F.to_json(F.struct(F.col("industry").alias("symbol"), F.col("industry").alias("longName"), "sector",
                             "industry", "marketCap",
                             F.when(~third, F.col("mn")).alias("currentPrice"),
                             F.when(third, F.col("mx")).alias("regularMarketPrice")))
    return per.select(doc.alias("payload"))


@query("s17_company_info", oround(with_views(["stock_info"], """
SELECT industry AS symbol, industry AS name, MIN(sector) AS sector, industry, SUM(market_cap) AS market_cap,
  CASE WHEN CAST(SUBSTR(industry, 7) AS INT) % 3 = 0 THEN MAX(current_price) ELSE MIN(current_price) END AS current_price,
  CAST(NULL AS DOUBLE) AS pe_ratio, CAST(NULL AS DOUBLE) AS peg_ratio, 0.0 AS dividend_yield, 1.0 AS beta,
  CAST(0 AS BIGINT) AS volume FROM stock_info GROUP BY industry"""), ["market_cap"], 2))
def s17(spark, sf):
    """S-16 / S-17: fundamentals rows from nested vendor documents with price fallback
    (currentPrice, then regularMarketPrice, then 0) and typed defaults."""
    return rounded(FS.company_info(_info_docs(Views(spark, sf))), 2)


@query("s16_earnings_explode", oround(with_views([], """
SELECT n.n_name AS symbol, CAST(DATE_TRUNC('quarter', o.o_orderdate) AS DATE) AS quarter, SUM(o.o_totalprice) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2"""),
    ["revenue"], 2))
def s16(spark, sf):
    """S-16: an earnings document per company with an array of quarterly records, exploded.

    The documents are built per (nation, year) so no array grows with the whole history."""
    v = Views(spark, sf)
    o = v.table("orders").select("o_custkey", "o_orderdate", "o_totalprice")
    j = o.join(v.table("customer").select("c_custkey", "c_nationkey"), o.o_custkey == F.col("c_custkey")).join(
        v.table("nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    q = j.groupBy("n_name", F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("quarter")).agg(
        F.sum("o_totalprice").alias("revenue"))
    docs = q.groupBy("n_name", F.year("quarter").alias("y")).agg(
        F.to_json(F.struct(F.col("n_name").alias("symbol"), F.collect_list(F.struct(
            F.date_format("quarter", "yyyy-MM-dd").alias("fiscalDateEnding"), F.col("revenue").alias("totalRevenue")))
            .alias("quarterlyEarnings"))).alias("payload"))
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("quarterlyEarnings", T.ArrayType(
        T.StructType([T.StructField("fiscalDateEnding", T.StringType()), T.StructField("totalRevenue", T.DoubleType())])))])
    p = docs.select(F.from_json("payload", schema).alias("d"))
    e = p.select("d.symbol", F.explode("d.quarterlyEarnings").alias("q"))
    return rounded(e.select("symbol", F.to_date("q.fiscalDateEnding").alias("quarter"),
                            F.col("q.totalRevenue").alias("revenue")), 2)


@query("s18_append_price_batches", with_views(["bars"], f"""
SELECT {BARS8}, data_source FROM bars WHERE DAYOFMONTH(date) <= 15
UNION ALL SELECT symbol, date, open, high, low, close, NULL, volume, 'second_vendor' FROM bars WHERE DAYOFMONTH(date) > 15"""))
def s18(spark, sf):
    """S-18 + F-14 + F-16: two batches -- one with vendor capitalised names, one without
    adjusted_close -- renamed, unioned by name, projected on the canonical schema, appended."""
    b = Views(spark, sf).bars
    a = b.filter(F.dayofmonth("date") <= 15).withColumnsRenamed(
        {"open": "Open", "high": "High", "low": "Low", "close": "Close", "volume": "Volume"})
    a = a.withColumnsRenamed({"Open": "open", "High": "high", "Low": "low", "Close": "close", "Volume": "volume"})
    c = b.filter(F.dayofmonth("date") > 15).drop("adjusted_close").withColumn("data_source", F.lit("second_vendor"))
    batch = FS.append_batch([a, c], FS.BAR_SCHEMA)
    path = FS.scratch(spark, "stock_prices")
    FS.write_table(batch.filter(F.col("data_source") == "fixture"), path, "append")
    FS.write_table(batch.filter(F.col("data_source") != "fixture"), path, "append")
    return spark.read.parquet(path)


@query("s19_append_macro", with_views(["macro"], """
SELECT series_id, CAST(COUNT(*) AS BIGINT) AS n, MIN(date) AS first_date, MAX(date) AS last_date FROM macro GROUP BY 1"""))
def s19(spark, sf):
    """S-19: macro rows appended in two batches (by year parity) and verified per series."""
    m = Views(spark, sf).macro
    path = FS.scratch(spark, "economic_indicators")
    FS.write_table(m.filter(F.year("date") % 2 == 0), path, "append")
    FS.write_table(m.filter(F.year("date") % 2 == 1), path, "append")
    return Q.coverage(spark.read.parquet(path), keys=("series_id",)).withColumnRenamed("records", "n") \
        .withColumnRenamed("start_date", "first_date").withColumnRenamed("end_date", "last_date")


@query("s20_append_portfolio_rows", oround(with_views(["bars", "holdings"], """
SELECT h.portfolio_name, b.date, b.symbol, h.weight, 100000 * h.weight AS value FROM bars b JOIN holdings h ON b.symbol = h.symbol"""),
    ["weight", "value"]))
def s20(spark, sf):
    """S-20: portfolio panel rows appended per portfolio (one append per batch of portfolios)."""
    v = Views(spark, sf)
    panel = v.bars.select("symbol", "date").join(v.holdings.select("portfolio_name", "symbol", "weight"), "symbol") \
        .select("portfolio_name", "date", "symbol", "weight", (F.lit(100000.0) * F.col("weight")).alias("value"))
    path = FS.scratch(spark, "portfolio_data")
    FS.write_table(panel.filter(F.col("portfolio_name") < "H"), path, "append", ["portfolio_name"])
    FS.write_table(panel.filter(F.col("portfolio_name") >= "H"), path, "append", ["portfolio_name"])
    return rounded(spark.read.parquet(path).select("portfolio_name", "date", "symbol", "weight", "value"))


UPS_SQL = """
SELECT symbol, date, CASE WHEN DAYOFMONTH(date) = 15 THEN close * 1.01 ELSE close END AS close,
  CASE WHEN DAYOFMONTH(date) = 15 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS loaded_at
FROM bars"""


@query("s21_upsert_prices", oround(with_views(["bars"], UPS_SQL), ["close"]))
def s21(spark, sf):
    """S-21: corrected bars (a later load) overwrite the stored ones on (symbol, date); applying
    the same update twice changes nothing."""
    b = Views(spark, sf).bars.select("symbol", "date", "close")
    cur = b.withColumn("loaded_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    upd = (b.filter(F.dayofmonth("date") == 15).withColumn("close", F.col("close") * 1.01)
           .withColumn("loaded_at", F.lit("2024-01-02 00:00:00").cast("timestamp")))
    once = FS.upsert(cur, upd)
    twice = FS.upsert(once, upd)
    return rounded(twice)


@query("s21_upsert_partitions", with_views(["bars"], """
SELECT CAST(YEAR(date) * 100 + MONTH(date) AS INTEGER) AS month, YEAR(date) * 100 + MONTH(date) IN (199503, 199611) AS rewritten,
  CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(*) FILTER (DAYOFMONTH(date) = 15 AND YEAR(date) * 100 + MONTH(date) IN (199503, 199611)) AS BIGINT) AS corrected
FROM bars GROUP BY 1, 2"""))
def s21_partitions(spark, sf):
    """S-21 on a stored table, partitioned by month: corrections of two months rewrite the files of those two, and applying them
    twice changes nothing more."""
    b = Views(spark, sf).bars.select("symbol", "date", "close", F.lit("2024-01-01").cast("timestamp").alias("loaded_at"),
                                     (F.year("date") * 100 + F.month("date")).alias("month"))
    path = FS.scratch(spark, "monthly_prices")
    FS.upsert_partitions(spark, path, b, "month")
    files = lambda: spark.read.parquet(path).select("month", F.input_file_name().alias("file")).distinct()
    before = files().checkpoint()
    fixed = b.where((F.dayofmonth("date") == 15) & F.col("month").isin(199503, 199611)) \
        .withColumns({"close": F.col("close") * 1.01, "loaded_at": F.lit("2024-01-02").cast("timestamp")})
    FS.upsert_partitions(spark, path, fixed, "month")
    FS.upsert_partitions(spark, path, fixed, "month")
    same = before.join(files(), ["month", "file"]).select("month").distinct().withColumn("_same", F.lit(True))
    rows = spark.read.parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("loaded_at") > F.lit("2024-01-01")).alias("corrected"))
    return rows.join(same, "month", "left").select("month", F.col("_same").isNull().alias("rewritten"), "n", "corrected")


@query("s22_replace_table", oround(with_views(["stock_info"], "SELECT symbol, market_cap FROM stock_info"), ["market_cap"], 2))
def s22(spark, sf):
    """S-22: overwrite replaces the whole table (the second write wins)."""
    si = Views(spark, sf).stock_info.select("symbol", "market_cap")
    path = FS.scratch(spark, "stock_info")
    FS.write_table(si.limit(0), path, "overwrite")
    FS.write_table(si, path, "overwrite")
    return rounded(spark.read.parquet(path), 2)


@query("s23_store_indicators", oround(with_views(["bars"], """
SELECT symbol, date, CASE WHEN COUNT(close) OVER w = 20 THEN AVG(close) OVER w END AS sma_20 FROM bars
WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""), ["sma_20"]))
def s23store(spark, sf):
    """S-23: the indicator subset written partitioned by symbol and read back."""
    ind = W.with_sma(Views(spark, sf).bars.select("symbol", "date", "close"), "close", (20,)).drop("close")
    path = FS.write_table(ind, FS.scratch(spark, "technical_indicators"), "overwrite", ["symbol"])
    return rounded(spark.read.parquet(path).select("symbol", "date", "sma_20"))


@query("s24_filter_history", with_views(["stock_info"], """
WITH si AS (SELECT * FROM stock_info)
SELECT * FROM (
 SELECT 'high_yield' AS filter_name, CAST(COUNT(*) AS BIGINT) AS result_count, TIMESTAMP '2024-01-03 00:00:00' AS created_at
 FROM si WHERE dividend_yield >= 0.03
 UNION ALL SELECT 'value', COUNT(*), TIMESTAMP '2024-01-02 00:00:00' FROM si WHERE pe_ratio <= 15
 UNION ALL SELECT 'growth', COUNT(*), TIMESTAMP '2024-01-01 00:00:00' FROM si WHERE peg_ratio <= 1.5) x
ORDER BY created_at DESC LIMIT 2"""))
def s24(spark, sf):
    """S-24 / T-07: each screen run is logged (criteria as JSON, result count) and the most
    recent entries are read back (the limit is the feature)."""
    si = Views(spark, sf).stock_info
    runs = [("growth", {"peg_ratio_max": 1.5}, "2024-01-01 00:00:00"),
            ("value", {"pe_ratio_max": 15}, "2024-01-02 00:00:00"),
            ("high_yield", {"dividend_yield_min": 0.03}, "2024-01-03 00:00:00")]
    path = FS.scratch(spark, "stock_filter_history")
    for name, crit, at in runs:
        cnt = S.screen(si, crit, order=False).agg(F.count("*").alias("result_count"))
        FS.history_entries(name, crit, cnt, at).write.mode("append").json(path)
    schema = "filter_name STRING, filter_criteria STRING, result_count BIGINT, created_at TIMESTAMP"
    h = spark.read.schema(schema).json(path)
    return h.orderBy(F.desc("created_at")).limit(2).select("filter_name", "result_count", "created_at")


@query("s25_json_records_roundtrip", oround(with_views(["stock_info"], """
SELECT symbol, name, sector, market_cap, pe_ratio FROM stock_info WHERE dividend_yield >= 0.03"""), ["market_cap"], 2))
def s25(spark, sf):
    """S-25: a screen result written as JSON records and read back with the same schema."""
    si = Views(spark, sf).stock_info
    res = S.screen(si, {"dividend_yield_min": 0.03}, order=False).select("symbol", "name", "sector", "market_cap", "pe_ratio")
    return rounded(FS.json_roundtrip(res, FS.scratch(spark, "records")), 2)


@query("s27_portfolio_json_arrays", oround(with_views(["holdings"], """
SELECT DENSE_RANK() OVER (ORDER BY portfolio_name) AS id, portfolio_name AS name, 'Custom' AS strategy, pos, symbol, weight
FROM holdings"""), ["weight"], 12))
def s27(spark, sf):
    """S-27: portfolios stored with JSON-text symbol / weight arrays, parsed and exploded by position."""
    from pyspark.sql import Window
    arr = Q.portfolio_arrays(Views(spark, sf).holdings)
    # one row per portfolio: ids are assigned over #portfolios rows
    rows = arr.select(F.dense_rank().over(Window.orderBy("portfolio_name")).cast("bigint").alias("id"),
                      F.col("portfolio_name").alias("name"), F.to_json("symbols").alias("symbols"),
                      F.to_json("weights").alias("weights"), F.lit("Custom").alias("strategy"))
    out = FS.portfolio_rows(rows)
    return rounded(out.select("id", "name", "strategy", F.col("pos").cast("int").alias("pos"), "symbol", "weight"), 12)


@query("s28_portfolio_change_feed", with_views(["holdings"], """
WITH cur AS (SELECT DISTINCT portfolio_name AS name, 'Custom' AS strategy FROM holdings),
pri AS (SELECT DISTINCT o_orderpriority AS name FROM orders)
SELECT name, CASE WHEN name = 'BUILDING' THEN 'Min Variance' WHEN name = 'FURNITURE' THEN 'Restored' ELSE strategy END AS strategy
FROM cur WHERE name <> 'MACHINERY' UNION ALL SELECT name, 'Risk Parity' FROM pri"""))
def s28(spark, sf):
    """S-28 / J-09 / J-12: a change feed applied by key in order -- inserts (new order-priority portfolios), two updates
    of one key, a delete, a delete followed by an insert, and changes of unknown keys, which do nothing."""
    v = Views(spark, sf)
    cur = v.holdings.select(F.col("portfolio_name").alias("name")).distinct().withColumn("strategy", F.lit("Custom"))
    new = (v.table("orders").select(F.col("o_orderpriority").alias("name")).distinct()
           .join(cur, "name", "left_anti").select("name", F.lit("insert").alias("op"), F.lit("Risk Parity").alias("strategy")))
    steps = [("BUILDING", "update", "Equal Weight", 1), ("BUILDING", "update", "Min Variance", 2), ("BUILDING", "update", None, 3),
             ("MACHINERY", "delete", None, 1), ("FURNITURE", "delete", None, 1), ("FURNITURE", "insert", "Restored", 2),
             ("NO SUCH", "update", "x", 1), ("NO SUCH EITHER", "delete", None, 1)]
    feed = spark.createDataFrame(steps, "name string, op string, strategy string, sequence int")
    return FS.apply_changes(cur, new.withColumn("sequence", F.lit(0)).unionByName(feed), key="name")


@query("s28_validated_writes", with_views(["holdings"], """
WITH p AS (SELECT portfolio_name AS name, list(symbol ORDER BY pos) AS s, list(weight ORDER BY pos) AS w FROM holdings GROUP BY 1),
v AS (SELECT * FROM (VALUES ('ok'), ('short'), ('sum'), ('bounds'), ('unreadable'), ('null'), ('no name'), ('empty')) t(fault)),
r AS (SELECT CASE WHEN fault = 'no name' THEN ' ' ELSE name END AS name, fault, CASE fault WHEN 'empty' THEN [] ELSE s END AS s,
        CASE fault WHEN 'short' THEN w[:-2] WHEN 'sum' THEN [x * 1.5 FOR x IN w] WHEN 'bounds' THEN [1.2, -0.2] || [0.0 FOR x IN w[3:]]
          WHEN 'unreadable' THEN NULL WHEN 'null' THEN [NULL] || w[2:] WHEN 'empty' THEN [] ELSE w END AS w FROM p, v)
SELECT name, fault, array_to_string(list_filter([CASE WHEN trim(name) = '' THEN 'no_name' END, CASE WHEN w IS NULL THEN 'weights_unreadable' END,
  CASE WHEN len(s) <> len(w) THEN 'length_mismatch' END, CASE WHEN w IS NOT NULL AND len(s) NOT BETWEEN 1 AND 50 THEN 'symbol_count' END,
  CASE WHEN list_count(w) < len(w) THEN 'null_entry' END,
  CASE WHEN len(s) = len(w) AND list_count(w) = len(w) AND abs(coalesce(list_sum(w), 0) - 1) > 0.01 THEN 'weights_sum' END,
  CASE WHEN len(s) = len(w) AND list_count(w) = len(w) AND len(list_filter(w, lambda x: x < 0.01 OR x > 1)) > 0 THEN 'weight_bounds' END],
  lambda x: x IS NOT NULL), ',') AS reasons FROM r"""))
def s28_validated(spark, sf):
    """S-28 with F-09 and F-10: portfolio writes, good ones and ones with every kind of fault, split by the constraints; the accepted
    rows and the rejects are written as tables and read back."""
    from tickframe.operators import quality as Q
    p = Q.portfolio_arrays(Views(spark, sf).holdings).select(F.col("portfolio_name").alias("name"), "symbols", "weights")
    faults = spark.createDataFrame([(f,) for f in ("ok", "short", "sum", "bounds", "unreadable", "null", "no name", "empty")], "fault string")
    p = p.join(F.broadcast(faults))  # a fixed list of eight
    w, fault, none = F.col("weights"), F.col("fault"), F.array().cast("array<double>")
    broken = (F.when(fault == "short", F.slice(w, F.lit(1), F.size(w) - 1)).when(fault == "sum", F.transform(w, lambda x: x * 1.5))
              .when(fault == "bounds", F.concat(F.array(F.lit(1.2), F.lit(-0.2)), F.transform(F.slice(w, F.lit(3), F.size(w)), lambda x: F.lit(0.0))))
              .when(fault == "null", F.concat(F.array(F.lit(None).cast("double")), F.slice(w, F.lit(2), F.size(w)))).when(fault == "empty", none).otherwise(w))
    rows = p.select(F.when(fault == "no name", F.lit(" ")).otherwise(F.col("name")).alias("name"), "fault",
                    F.when(fault == "empty", F.lit("[]")).otherwise(F.to_json("symbols")).alias("symbols"),
                    F.when(fault == "unreadable", F.lit("no weights")).otherwise(F.to_json(broken, {"ignoreNullFields": "false"})).alias("weights"))
    good, rejects = FS.validated_portfolios(rows)
    a, b = FS.write_table(good, FS.scratch(spark, "portfolios")), FS.write_table(rejects, FS.scratch(spark, "portfolio_rejects"))
    return spark.read.parquet(a).select("name", "fault", F.lit("").alias("reasons")).unionByName(
        spark.read.parquet(b).select("name", "fault", F.array_join("reasons", ",").alias("reasons")))


@query("s27_run_keys", with_views(["holdings"], """
SELECT portfolio_name, 'portfolio_analytics:' || md5('1992-01-01|1998-12-31|' || string_agg(symbol || '=' || printf('%.6f', weight), ',' ORDER BY symbol))
         AS run_key,
       replace(lower(portfolio_name), ' ', '_') AS strategy_key,
       array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN string_split(replace(replace(lower(portfolio_name), ' ', '_'), '_', ' '), ' ')], ' ') AS strategy_label
FROM holdings GROUP BY portfolio_name"""))
def s27k(spark, sf):
    """Run key: MD5 over the date range and the sorted (symbol, weight) pairs; strategy names as keys (lower case,
    underscores) and back as labels (title case)."""
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("symbol", "weight"))),
                        lambda p: F.concat(p["symbol"], F.lit("="), F.format_string("%.6f", p["weight"])))
    per = Views(spark, sf).holdings.groupBy("portfolio_name").agg(F.concat_ws(",", pairs).alias("pairs"))
    key = F.replace(F.lower("portfolio_name"), F.lit(" "), F.lit("_"))
    return per.select("portfolio_name", F.concat(F.lit("portfolio_analytics:"), F.md5(F.concat(F.lit("1992-01-01|1998-12-31|"), "pairs"))).alias("run_key"),
                      key.alias("strategy_key"), F.initcap(F.replace(key, F.lit("_"), F.lit(" "))).alias("strategy_label"))


@query("s29_result_tables", oround(with_views(["bars", "holdings"], f"""
WITH a AS ({R17_SQL}),
b AS ({R18_SQL})
SELECT a.portfolio_name, a.total_return, a.sharpe_ratio, a.max_drawdown, b.final_value
FROM a JOIN b ON a.portfolio_name = b.portfolio_name"""), ["total_return", "sharpe_ratio", "max_drawdown", "final_value"]))
def s29(spark, sf):
    """S-29: the analytics and backtest result tables written and read back joined on the portfolio."""
    v = Views(spark, sf)
    pa = FS.write_table(P.portfolio_analytics(v.bars, v.holdings), FS.scratch(spark, "portfolio_analytics"))
    pb = FS.write_table(P.backtest(v.bars, v.holdings), FS.scratch(spark, "portfolio_backtests"))
    a = spark.read.parquet(pa).select("portfolio_name", "total_return", "sharpe_ratio", "max_drawdown")
    b = spark.read.parquet(pb).select("portfolio_name", "final_value")
    return rounded(a.join(b, "portfolio_name"))
