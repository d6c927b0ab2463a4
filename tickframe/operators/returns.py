"""W-01 / W-02: simple and log returns over each symbol's own ordered series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.exprs import c, safe_div, series_window


def with_returns(df: DataFrame, price: str = "close", keys=("symbol",), order: str = "date",
                 kind: str = "simple", out: str = "returns", ffill: bool = True) -> DataFrame:
    """Append ``out`` = p / p[-1] - 1 (simple) or ln(p / p[-1]) (log).

    The pinned pandas pads nulls before ``pct_change``, so with ``ffill`` the
    previous *non-null* price is used.  First row of each series is null;
    a zero previous price gives null instead of inf.
    """
    w = series_window(keys, order)
    if ffill:
        prev = F.last(c(price), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        cur = F.coalesce(c(price), prev)
    else:
        prev = F.lag(c(price)).over(w)
        cur = c(price)
    ratio = safe_div(cur, prev)
    val = ratio - 1 if kind == "simple" else F.when(ratio > 0, F.ln(ratio))
    return df.withColumn(out, val)
