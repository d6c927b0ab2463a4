"""Screener and display rules: F-*, A-05..A-09, T-02, T-08.

A screen is one conjunction of Column predicates, so Catalyst pushes every
comparison into the parquet scan; nulls fail comparisons (as in SQL).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.exprs import c

# ---- fixed values (must equal the reference's rules) -------------------------
# Collector rule (F-05): ordered, inclusive on both ends, first match wins.
COLLECTOR_CAP_RANGES = [
    ("Large Cap", 10_000_000_000, float("inf")),
    ("Mid Cap", 2_000_000_000, 10_000_000_000),
    ("Small Cap", 300_000_000, 2_000_000_000),
    ("Micro Cap", 0, 300_000_000),
    ("Mega Cap ($100B+)", 100_000_000_000, float("inf")),
    ("Large Cap ($10B+)", 10_000_000_000, float("inf")),
    ("Mid Cap ($2B+)", 2_000_000_000, float("inf")),
    ("Small Cap ($300M+)", 300_000_000, float("inf")),
    ("Micro Cap ($50M+)", 50_000_000, float("inf")),
    ("Nano Cap ($10M+)", 10_000_000, float("inf")),
]
# Generator rule (F-06): descending lower-inclusive thresholds, last label otherwise.
GENERATOR_CAP_THRESHOLDS = [
    ("Mega Cap ($100B+)", 100_000_000_000),
    ("Large Cap ($10B+)", 10_000_000_000),
    ("Mid Cap ($2B+)", 2_000_000_000),
    ("Small Cap ($300M+)", 300_000_000),
    ("Micro Cap ($50M+)", 50_000_000),
]
GENERATOR_CAP_DEFAULT = "Nano Cap ($10M+)"
# Sharpe colour bands (F-12): >= 2, >= 1, >= 0.5, >= 0, below 0.
SHARPE_BANDS = [(2.0, "excellent"), (1.0, "good"), (0.5, "average"), (0.0, "poor")]
SHARPE_BAND_DEFAULT = "negative"
# Health banding (F-26): cpu / memory percent warn 70, critical 90; db seconds 1 / 3.
HEALTH_LIMITS = {"cpu": (70.0, 90.0), "memory": (70.0, 90.0), "db": (1.0, 3.0)}
# Pipeline status (F-23): stale after 48 h, slow db above 5 s, cpu > 90 or memory > 95.
STALE_HOURS, SLOW_DB_SECONDS, CPU_LIMIT, MEMORY_LIMIT = 48.0, 5.0, 90.0, 95.0
# -----------------------------------------------------------------------------

# filter key -> (column, operator)
FILTER_SPEC = {
    "market_cap_categories": ("market_cap_category", "in"),
    "sectors": ("sector", "in"),
    "industries": ("industry", "in"),
    "pe_ratio_min": ("pe_ratio", ">="), "pe_ratio_max": ("pe_ratio", "<="),
    "peg_ratio_min": ("peg_ratio", ">="), "peg_ratio_max": ("peg_ratio", "<="),
    "dividend_yield_min": ("dividend_yield", ">="), "dividend_yield_max": ("dividend_yield", "<="),
    "price_min": ("current_price", ">="), "price_max": ("current_price", "<="),
    "volume_min": ("volume", ">="),
    "beta_min": ("beta", ">="), "beta_max": ("beta", "<="),
    "debt_to_equity_max": ("debt_to_equity", "<="),
    "return_on_equity_min": ("return_on_equity", ">="),
    "profit_margin_min": ("profit_margins", ">="),
}


def cap_category_collector(cap) -> Column:
    """F-05 (Q-11 kept): only the first four labels are reachable."""
    x = c(cap)
    e = None
    for label, lo, hi in COLLECTOR_CAP_RANGES:
        cond = (x >= lo) if hi == float("inf") else ((x >= lo) & (x <= hi))
        e = F.when(cond, label) if e is None else e.when(cond, label)
    return F.when(x.isNull() | (x <= 0), "Unknown").otherwise(e.otherwise("Unknown"))


def cap_category(cap) -> Column:
    """F-06: the generator's descending thresholds (null falls through to the last label)."""
    x = c(cap)
    e = None
    for label, lo in GENERATOR_CAP_THRESHOLDS:
        e = F.when(x >= lo, label) if e is None else e.when(x >= lo, label)
    return e.otherwise(GENERATOR_CAP_DEFAULT)


def with_cap_category(df: DataFrame, rule: str = "generator") -> DataFrame:
    f = cap_category if rule == "generator" else cap_category_collector
    return df.withColumn("market_cap_category", f("market_cap"))


def predicate(filters: dict) -> Column:
    """F-01 / F-02: AND of every given criterion; unknown keys are rejected."""
    preds = []
    for key, val in filters.items():
        if val is None or (isinstance(val, (list, tuple)) and not val):
            continue
        if key not in FILTER_SPEC:
            raise ValueError(f"unknown filter {key}")
        col, op = FILTER_SPEC[key]
        if op == "in":
            preds.append(F.col(col).isin(list(val)))
        elif op == ">=":
            preds.append(F.col(col) >= val)
        else:
            preds.append(F.col(col) <= val)
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def screen(df: DataFrame, filters: dict, order: bool = True) -> DataFrame:
    """F-01 (ordered by market cap, PostgreSQL DESC puts nulls first) / F-02 (order=False)."""
    out = df.filter(predicate(filters))
    return out.orderBy(F.desc_nulls_first("market_cap")) if order else out


def summary(df: DataFrame) -> DataFrame:
    """A-05: count, distinct sectors / industries, averages, total cap (one partial aggregate)."""
    return df.agg(F.count("*").cast("bigint").alias("total_stocks"),
                  F.countDistinct("sector").cast("bigint").alias("total_sectors"),
                  F.countDistinct("industry").cast("bigint").alias("total_industries"),
                  F.avg("pe_ratio").alias("avg_pe_ratio"), F.avg("dividend_yield").alias("avg_dividend_yield"),
                  F.avg("beta").alias("avg_beta"), F.avg("current_price").alias("avg_price"),
                  F.sum("market_cap").alias("total_market_cap"),
                  F.approx_count_distinct("industry").cast("bigint").alias("approx_industries"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """A-07: value counts, most frequent first (ties by value for a stable order)."""
    return (df.groupBy(col).agg(F.count("*").cast("bigint").alias("count"))
              .orderBy(F.desc("count"), F.asc_nulls_first(col)))


RANGE_COLS = [("pe_ratio", "pe"), ("peg_ratio", "peg"), ("dividend_yield", "div"),
              ("current_price", "price"), ("beta", "beta")]


def filter_options(df: DataFrame) -> DataFrame:
    """A-08: sorted distinct lists + min/max over rows where all five metrics are present,
    in one aggregate (conditional min/max instead of a second pass).

    Q-13 fixed: the price maximum is the maximum (the reference returns the minimum).
    """
    full = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x, _ in RANGE_COLS])
    lists = [F.array_sort(F.collect_set(x)).alias(n) for x, n in
             (("market_cap_category", "market_cap_categories"), ("sector", "sectors"), ("industry", "industries"))]
    ranges = [f for x, n in RANGE_COLS for f in (F.min(F.when(full, F.col(x))).alias(f"{n}_min"),
                                                  F.max(F.when(full, F.col(x))).alias(f"{n}_max"))]
    return df.agg(*lists, *ranges)


def frame_filter_options(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """A-09: each metric's min / max over its own non-null rows, default when all null."""
    defaults = defaults or {"pe": (0, 100), "peg": (0, 5), "div": (0, 0.1), "price": (0, 1000), "beta": (0, 3)}
    return df.agg(*[f for x, n in RANGE_COLS for f in (
        F.coalesce(F.min(x), F.lit(float(defaults[n][0]))).alias(f"{n}_min"),
        F.coalesce(F.max(x), F.lit(float(defaults[n][1]))).alias(f"{n}_max"))])


def top_n(df: DataFrame, metric: str, n: int = 10, cols=None) -> DataFrame:
    """T-02: top n by a caller-chosen metric, nulls removed (TakeOrderedAndProject).

    The metric name is checked against the schema instead of pasted into SQL.
    """
    if metric not in df.columns:
        raise ValueError(f"unknown metric {metric}")
    cols = cols or ["symbol", "name", metric, "sector", "industry", "market_cap_category", "current_price"]
    return (df.filter(F.col(metric).isNotNull()).orderBy(F.desc(metric), "symbol").limit(n)
              .select(*[x for x in cols if x in df.columns]))


def top_per_group(df: DataFrame, group: str, metric: str, n: int = 3) -> DataFrame:
    """T-08: top n per group by metric (row_number over the group, ties by symbol)."""
    w = Window.partitionBy(group).orderBy(F.desc(metric), "symbol")
    return (df.filter(F.col(metric).isNotNull()).withColumn("rank", F.row_number().over(w))
              .filter(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("bigint")))


def sharpe_band(s) -> Column:
    """F-12."""
    x = c(s)
    e = None
    for lo, label in SHARPE_BANDS:
        e = F.when(x >= lo, label) if e is None else e.when(x >= lo, label)
    return e.otherwise(SHARPE_BAND_DEFAULT)


def return_label(r) -> Column:
    """F-27: 0.1234 -> '12.3%', null -> 'N/A'."""
    return F.coalesce(F.format_string("%.1f%%", c(r) * 100), F.lit("N/A"))


def asset_label(symbols, weights, decimals: int = 1) -> Column:
    """F-18: 'SYM (12.5%), SYM2 (40.0%)' from parallel arrays."""
    fmt = f"%s (%.{decimals}f%%)"
    z = F.arrays_zip(c(symbols).alias("s"), c(weights).alias("w"))
    return F.array_join(F.transform(z, lambda e: F.format_string(fmt, e["s"], e["w"] * 100)), ", ")


def weight_status(total_pct) -> Column:
    """F-11: weight-sum status text."""
    t = c(total_pct)
    # fixed values: the status texts
    return (F.when(F.abs(t - 100) < 1e-9, F.format_string("Total Weight: %.1f%% \u2713 Perfect!", t))
             .when(t > 100, F.format_string("Total Weight: %.1f%% \u26a0\ufe0f Exceeds 100%%", t))
             .when(t > 0, F.format_string("Total Weight: %.1f%% (Need %.1f%% more)", t, 100 - t))
             .otherwise(F.format_string("Total Weight: %.1f%%", F.coalesce(t, F.lit(0.0)))))


def health_band(value, kind: str) -> Column:
    """F-26: traffic light for cpu / memory percent or database seconds."""
    warn, crit = HEALTH_LIMITS[kind]
    x = c(value)
    return F.when(x >= crit, "critical").when(x >= warn, "warning").when(x.isNotNull(), "healthy")


def pipeline_status(hours_since, db_seconds, cpu, memory) -> Column:
    """F-23: stale_data / db_slow / resource_high / healthy, first match wins."""
    return (F.when(c(hours_since) > STALE_HOURS, "stale_data")
             .when(c(db_seconds) > SLOW_DB_SECONDS, "db_slow")
             .when((c(cpu) > CPU_LIMIT) | (c(memory) > MEMORY_LIMIT), "resource_high")
             .otherwise("healthy"))
