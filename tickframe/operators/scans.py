"""S-01 .. S-07: scans with optional symbol lists and date ranges.

Filters are plain Column predicates on the scan, so Catalyst pushes them into
the parquet reader (PushedFilters) and prunes columns (ReadSchema).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_prices(bars: DataFrame, symbols=None, start=None, end=None, order: bool = True) -> DataFrame:
    """S-01 / S-04: price panel, optional symbol list (list or a one-column DataFrame,
    joined as a semi join) and inclusive date range, ordered by date, symbol."""
    df = bars
    if isinstance(symbols, DataFrame):
        df = df.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    elif symbols:
        df = df.filter(F.col("symbol").isin(list(symbols)))
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    return df.orderBy("date", "symbol") if order else df


def scan_symbol_sql(spark: SparkSession, bars: DataFrame, symbol: str, start=None, end=None) -> DataFrame:
    """S-02: one symbol via parameterised SQL (named parameters, never string pasting)."""
    q = ("SELECT symbol, date, open, high, low, close, adjusted_close, volume FROM {bars} "
         "WHERE symbol = :symbol AND (:start IS NULL OR date >= CAST(:start AS DATE)) "
         "AND (:end IS NULL OR date <= CAST(:end AS DATE)) ORDER BY date")
    return spark.sql(q, args={"symbol": symbol, "start": start, "end": end}, bars=bars)


def run_sql(spark: SparkSession, query: str, params: dict | None = None, **frames) -> DataFrame:
    """S-03: user SQL with named parameters over DataFrames passed as ``{name}`` placeholders."""
    return spark.sql(query, args=params or {}, **frames)


def latest_rows(df: DataFrame, n: int = 100, symbol: str | None = None, date: str = "date",
                tiebreak=("symbol",)) -> DataFrame:
    """T-01: the latest n rows (optionally of one symbol), ties broken by key."""
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    return df.orderBy(F.desc(date), *tiebreak).limit(n)
