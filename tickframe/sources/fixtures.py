"""Derived views that give the driver's TPC-H-ish tables the shapes this engine works on.

bars              (symbol, date, open, high, low, close, adjusted_close, volume, data_source)
holdings          (portfolio_name, pos, symbol, weight)
stock_info        fundamentals, one row per symbol
macro             (series_id, date, value) monthly series
benchmark_returns (date, r) market index returns
metric_bars       hourly OHLC-style buckets of the events stream

All are plain aggregations with partial (map-side) combine, so a hot key
(one brand or one day holding a third of all lines) is pre-aggregated per
task before the shuffle; open/close use ``min_by``/``max_by`` over a total
order instead of a row_number window so no single (symbol, day) group is
ever materialised in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.sources.tables import table


def _exact_sum(col: str):
    """Sum as an exact decimal of six digits after the point, returned as double: the same value whatever
    order the partial sums arrive in (a float sum's last bits depend on shuffle order)."""
    return F.sum(F.col(col).cast("decimal(38,6)")).cast("double")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_quantity", "l_shipdate")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    t = li.join(pa, li.l_partkey == pa.p_partkey).select(
        F.col("p_brand").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        (F.col("p_retailprice") * (1 - F.col("l_discount"))).alias("px"),
        F.col("l_quantity").alias("qty"),
        F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"))
    # (orderkey, linenumber) repeats in the fixtures, so the price completes the order.
    order = F.struct("ok", "ln", "px")
    return (t.groupBy("symbol", "date")
            .agg(F.min_by("px", order).alias("open"), F.max("px").alias("high"),
                 F.min("px").alias("low"), F.max_by("px", order).alias("close"),
                 F.sum("qty").cast("bigint").alias("volume"))
            .select("symbol", "date", "open", "high", "low", "close",
                    F.col("close").alias("adjusted_close"), "volume",
                    F.lit("fixture").alias("data_source")))


def holdings(spark: SparkSession, sf_dir: str, top_n: int = 5) -> DataFrame:
    """Five portfolios (market segments) of their five largest brands, value weighted."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    s = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, o.o_custkey == c.c_custkey)
         .join(pa, li.l_partkey == pa.p_partkey)
         .groupBy(F.col("c_mktsegment").alias("portfolio_name"), F.col("p_brand").alias("symbol"))
         .agg(_exact_sum("l_extendedprice").alias("v")))
    # One row per (segment, brand) here: the window holds #brands rows per segment.
    w = Window.partitionBy("portfolio_name").orderBy(F.desc("v"), "symbol")
    k = s.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= top_n)
    return k.select("portfolio_name", F.col("rn").cast("int").alias("pos"), "symbol",
                    (F.col("v") / F.sum("v").over(Window.partitionBy("portfolio_name"))).alias("weight"))


def stock_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    pa = table(spark, sf_dir, "part")
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount")
    agg = li.groupBy("l_partkey").agg(
        _exact_sum("l_extendedprice").alias("ext"), F.sum("l_quantity").alias("qty"),
        _exact_sum("l_tax").alias("tax"), _exact_sum("l_discount").alias("disc"), F.count("*").alias("n"))
    # Pre-aggregating lineitem by part before the join keeps the join input at #parts rows.
    j = pa.join(agg, pa.p_partkey == agg.l_partkey)
    key = F.col("p_partkey")
    size = F.col("p_size")
    return j.select(
        key.cast("string").alias("symbol"), F.col("p_name").alias("name"),
        F.col("p_type").alias("sector"), F.col("p_brand").alias("industry"),
        (F.col("ext") * size * size * 30).alias("market_cap"),
        F.col("p_retailprice").alias("current_price"), F.col("qty").cast("bigint").alias("volume"),
        # decimal literals, as in the fixture definition (0.1 is DECIMAL, then cast)
        F.expr("CASE WHEN p_size % 7 = 0 THEN NULL ELSE CAST(5 + p_size * 0.8 AS DOUBLE) END").alias("pe_ratio"),
        F.expr("CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(0.5 + (p_partkey % 40) * 0.1 AS DOUBLE) END")
         .alias("peg_ratio"),
        (F.col("tax") / F.col("n")).alias("dividend_yield"),
        (F.col("disc") / F.col("n") * 20).alias("beta"),
        F.expr("CAST((p_partkey % 30) * 0.1 AS DOUBLE)").alias("debt_to_equity"),
        F.expr("CAST(((p_partkey % 70) - 20) * 0.01 AS DOUBLE)").alias("return_on_equity"),
        F.expr("CAST(((p_size % 50) - 10) * 0.01 AS DOUBLE)").alias("profit_margins"))


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey))
    return (j.groupBy(F.col("r_name").alias("series_id"),
                      F.to_date(F.date_trunc("month", "o_orderdate")).alias("date"))
            # exact decimal sum of cent amounts, then one division: identical doubles everywhere
            .agg((_exact_sum("o_totalprice") / F.count("*")).alias("value")))


def benchmark_returns(spark: SparkSession, sf_dir: str, bars_df: DataFrame | None = None) -> DataFrame:
    """Equal-weight market level per day and its daily return.

    The level series has one row per calendar day, so the un-partitioned
    ordered window runs over #days rows (bounded by the time span, not by
    data volume); everything before it is a partial aggregate.
    """
    b = bars_df if bars_df is not None else bars(spark, sf_dir)
    a = b.groupBy("date").agg(F.avg("close").alias("level"))
    w = Window.orderBy("date")
    return a.select("date", (F.col("level") / F.lag("level").over(w) - 1).alias("r"))


def metric_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("bucket"))
            .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"),
                 _exact_sum("value").alias("total")))
