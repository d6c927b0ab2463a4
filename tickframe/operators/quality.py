"""Data-quality and validation operators: F-07..F-10, F-24, A-02..A-04, A-26, A-28, U-05..U-07.

Every report is a DataFrame of violations / statistics built with aggregates
and joins on keys; nothing is looped over on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.exprs import c

# fixed values: symbol rule (alphabetic, 1..10 characters) and portfolio bounds
SYMBOL_PATTERN = r"^\p{L}{1,10}$"
MIN_SYMBOLS, MAX_SYMBOLS = 1, 50
MIN_WEIGHT, MAX_WEIGHT = 0.01, 1.0
MIN_VALUE, MAX_VALUE = 1_000, 10_000_000
WEIGHT_TOLERANCE = 0.01


def validate_symbols(df: DataFrame, col: str = "raw") -> DataFrame:
    """F-07: normalised = upper(trim(raw)); valid when alphabetic with 1..10 characters."""
    norm = F.upper(F.trim(c(col)))
    return df.select(c(col).alias("raw"), norm.alias("symbol"), norm.rlike(SYMBOL_PATTERN).alias("valid"))


def portfolio_arrays(holdings: DataFrame) -> DataFrame:
    """S-27 shape: one row per portfolio with parallel symbol / weight arrays in position order."""
    s = F.array_sort(F.collect_list(F.struct("pos", "symbol", "weight")))
    return (holdings.groupBy("portfolio_name").agg(s.alias("_h"))
            .select("portfolio_name", F.col("_h.symbol").alias("symbols"), F.col("_h.weight").alias("weights")))


def weight_report(arrays: DataFrame) -> DataFrame:
    """F-09: equal lengths and |sum - 1| <= 0.01 (service) / < 0.01 (dashboard)."""
    total = F.aggregate("weights", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    n_w = F.size(F.filter("weights", lambda x: x.isNotNull()))
    same = F.size("symbols") == n_w
    return arrays.select("portfolio_name", F.size("symbols").cast("bigint").alias("n_symbols"),
                         n_w.cast("bigint").alias("n_weights"), total.alias("weight_sum"),
                         (same & (F.abs(total - 1) <= WEIGHT_TOLERANCE)).alias("valid_service"),
                         (same & (F.abs(total - 1) < WEIGHT_TOLERANCE)).alias("valid_dashboard"))


def bounds_report(holdings: DataFrame, values: DataFrame) -> DataFrame:
    """F-10: symbol count, weight range and portfolio value bounds per portfolio."""
    h = holdings.groupBy("portfolio_name").agg(F.count("*").cast("bigint").alias("n_symbols"),
                                               F.min("weight").alias("min_weight"), F.max("weight").alias("max_weight"))
    j = h.join(values, "portfolio_name")
    return j.select("portfolio_name", "n_symbols", "min_weight", "max_weight", "value",
                    F.col("n_symbols").between(MIN_SYMBOLS, MAX_SYMBOLS).alias("symbols_ok"),
                    ((F.col("min_weight") >= MIN_WEIGHT) & (F.col("max_weight") <= MAX_WEIGHT)).alias("weights_ok"),
                    F.col("value").between(MIN_VALUE, MAX_VALUE).alias("value_ok"))


def clean_portfolio_input(df: DataFrame, key: str = "portfolio_name") -> DataFrame:
    """F-24: drop pairs with null symbol / weight or weight <= 0, percent -> fraction,
    renormalise to 1; equal weights when the total is 0."""
    d = df.filter(F.col("symbol").isNotNull() & F.col("pct").isNotNull() & (F.col("pct") > 0))
    d = d.withColumn("w", F.col("pct") / 100)
    p = Window.partitionBy(key)
    tot = F.sum("w").over(p)
    return d.select(key, "symbol", F.when(tot > 0, F.col("w") / tot)
                    .otherwise(1.0 / F.count(F.lit(1)).over(p)).alias("weight"))


def coverage(df: DataFrame, keys=("symbol",), date: str = "date", avg_col: str | None = None) -> DataFrame:
    """A-02 / A-03 / A-04: rows, first and last date (and an average) per key."""
    aggs = [F.count("*").cast("bigint").alias("records"), F.min(date).alias("start_date"), F.max(date).alias("end_date")]
    if avg_col:
        aggs.append((F.sum(avg_col) / F.count(avg_col)).alias(f"avg_{avg_col}"))
    return df.groupBy(*keys).agg(*aggs)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """A-26: keys that occur more than once (what a UNIQUE constraint would reject)."""
    return (df.groupBy(*keys).agg(F.count("*").cast("bigint").alias("n"))
              .filter(F.col("n") > 1))


def availability(requested: DataFrame, prices: DataFrame, key: str = "symbol") -> DataFrame:
    """A-28 / J-05 / J-06: requested symbols flagged by whether any price row exists."""
    have = prices.select(key).distinct().withColumn("has_data", F.lit(True))
    return (requested.select(key).distinct().join(have, key, "left")
            .select(key, F.coalesce("has_data", F.lit(False)).alias("has_data")))


def missing_ranges(prices: DataFrame, requests: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    """U-05: per requested (symbol, start, end), the gap before the first and after the last
    stored date, as rows (symbol, gap_start, gap_end, kind)."""
    ext = prices.groupBy(key).agg(F.min(date).alias("first"), F.max(date).alias("last"))
    r = requests.join(ext, key, "left")
    gaps = F.array(
        F.when(F.col("first").isNull(), F.struct(F.col("start").alias("gap_start"), F.col("end").alias("gap_end"),
                                                 F.lit("no_data").alias("kind"))),
        F.when(F.col("start") < F.col("first"), F.struct(F.col("start").alias("gap_start"),
                                                        F.date_sub("first", 1).alias("gap_end"), F.lit("before").alias("kind"))),
        F.when(F.col("end") > F.col("last"), F.struct(F.date_add("last", 1).alias("gap_start"),
                                                     F.col("end").alias("gap_end"), F.lit("after").alias("kind"))))
    return r.select(key, F.inline(F.filter(gaps, lambda g: g.isNotNull())))


def interior_gaps(prices: DataFrame, key: str = "symbol", date: str = "date", min_missing: int = 1) -> DataFrame:
    """U-05 extension: runs of missing calendar days inside each series (gaps-and-islands
    on the next stored date, one ordered window per key)."""
    w = Window.partitionBy(key).orderBy(date)
    d = prices.select(key, date).withColumn("_next", F.lead(date).over(w))
    d = d.filter(F.datediff("_next", date) - 1 >= min_missing)
    return d.select(key, F.date_add(date, 1).alias("gap_start"), F.date_sub("_next", 1).alias("gap_end"),
                    (F.datediff("_next", date) - 1).cast("bigint").alias("missing_days"))


def recent_data(prices: DataFrame, as_of, days: int = 7, key: str = "symbol", date: str = "date") -> DataFrame:
    """U-07: per symbol, whether any row lies in the last ``days`` days before ``as_of``."""
    return prices.groupBy(key).agg(F.max(date).alias("last_date")).select(
        key, "last_date", (F.col("last_date") >= F.date_sub(c(as_of), days)).alias("has_recent"))


def source_precedence(df: DataFrame, ranks: dict, keys=("symbol", "date"), source: str = "data_source") -> DataFrame:
    """U-06: for each key keep the row of the best-ranked source (first source with data wins).

    ``ranks`` is a small fixed dict source -> rank, inlined as a map literal.
    """
    m = F.create_map(*[x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))])
    r = F.coalesce(m[F.col(source)], F.lit(len(ranks)))
    best = F.min_by(F.struct(*[F.col(x) for x in df.columns]), F.struct(r, F.col(source)))
    return df.groupBy(*keys).agg(best.alias("_row")).select("_row.*")
