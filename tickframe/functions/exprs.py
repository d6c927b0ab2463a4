"""Small reusable Column expressions.

Spark 4 runs with ANSI mode on: division by zero and overflow raise, so
every ratio goes through ``try_divide`` and every log/power is guarded.
NaN never appears: missing is null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Fixed values shared with the reference's formulas.
TRADING_DAYS = 252          # periods per year
RISK_FREE = 0.02            # annual risk-free rate
SQRT_YEAR = math.sqrt(TRADING_DAYS)


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(n, d, default=None) -> Column:
    """n / d, null (or ``default``) when d is 0 or null."""
    q = F.try_divide(c(n), c(d))
    return q if default is None else F.coalesce(q, F.lit(default))


def r6(x, digits: int = 6) -> Column:
    return F.round(c(x), digits)


def series_window(keys=("symbol",), order: str = "date") -> Window:
    return Window.partitionBy(*keys).orderBy(order)


def rolling(keys=("symbol",), order: str = "date", n: int = 20, offset: int = 0) -> Window:
    """Trailing frame of ``n`` rows ending ``offset`` rows before the current one."""
    return series_window(keys, order).rowsBetween(-(n - 1) - offset, -offset)


def running(keys=("symbol",), order: str = "date") -> Window:
    return series_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def min_periods(expr: Column, col, window: Window, n: int) -> Column:
    """pandas' default ``min_periods=window``: value only when the frame holds n non-nulls."""
    return F.when(F.count(c(col)).over(window) == n, expr)


def guarded_ln(x) -> Column:
    return F.when(c(x) > 0, F.ln(c(x)))


def guarded_pow(base, exp) -> Column:
    return F.when(c(base) > 0, F.pow(c(base), c(exp)))
