"""J-*: joins the reference did by index alignment or dict lookup, as key joins.

As-of join (J-07): the latest macro value at or before each date is resolved
on the calendar of distinct dates (one row per day, bounded by the time span),
then attached to the fact rows with a plain equi-join on date -- so the fact
table is never sorted globally and never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PKEY = "portfolio_name"


def last_days(df: DataFrame, days: int, date: str = "date") -> DataFrame:
    """Rows of the last ``days`` days of df, counted back from its newest date (a one-row aggregate joined back)."""
    last = df.agg(F.max(date).alias("_last"))
    return df.join(F.broadcast(last)).filter(F.col(date) > F.date_sub("_last", days)).drop("_last")


def asof_join(facts: DataFrame, series: DataFrame, key: str = "series_id", date: str = "date",
              value: str = "value", prefix: str = "macro_") -> DataFrame:
    """Attach, for every series, the latest value with series.date <= facts.date.

    Series names become columns ``prefix + lower(name)`` (spaces -> '_'); the
    set of series is small (macro indicators) and read once for the pivot.
    """
    cal = facts.select(date).distinct().withColumn("_is_fact", F.lit(True))
    wide = series.groupBy(date).pivot(key).agg(F.first(value))
    names = [x for x in wide.columns if x != date]
    u = cal.join(wide, date, "full_outer")
    w = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = u.select(date, "_is_fact", *[F.last(F.col(f"`{n}`"), True).over(w).alias(
        prefix + n.lower().replace(" ", "_")) for n in names])
    filled = filled.filter(F.col("_is_fact")).drop("_is_fact")
    return facts.join(filled, date, "left")


def equi_join_series(facts: DataFrame, series: DataFrame, key: str = "series_id", date: str = "date",
                     value: str = "value", prefix: str = "macro_") -> DataFrame:
    """J-07 parity form: left join on the exact date (values only where dates coincide)."""
    wide = series.groupBy(date).pivot(key).agg(F.first(value))
    names = [x for x in wide.columns if x != date]
    wide = wide.select(date, *[F.col(f"`{n}`").alias(prefix + n.lower().replace(" ", "_")) for n in names])
    return facts.join(wide, date, "left")


def union_calendar_panel(bars: DataFrame, holdings: DataFrame, price: str = "close", bfill: bool = True) -> DataFrame:
    """J-01: per portfolio, the union of its symbols' dates x its symbols, prices forward-
    then backward-filled (Q-23 kept by default; ``bfill=False`` leaves pre-listing gaps null).

    Dense by definition: rows = calendar dates x held symbols of each portfolio.
    """
    px = bars.select("symbol", "date", price).join(holdings.select(PKEY, "symbol"), "symbol")
    avail = px.select(PKEY, "symbol").distinct()
    cal = px.select(PKEY, "date").distinct()
    grid = cal.join(avail, PKEY)
    g = grid.join(px, [PKEY, "symbol", "date"], "left")
    w = Window.partitionBy(PKEY, "symbol").orderBy("date")
    f = F.last(price, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    if bfill:
        f = F.coalesce(f, F.first(price, True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    return g.select(PKEY, "symbol", "date", f.alias("price"))


def complete_dates(returns: DataFrame, groups: DataFrame, key: str = PKEY, col: str = "r") -> DataFrame:
    """J-02 / U-04: (group, date) where every symbol of the group has a non-null value.

    A count per (group, date) compared with the group size: no n-way join.
    """
    g = groups.select(key, "symbol").distinct()
    size = g.groupBy(key).agg(F.count("symbol").alias("_n"))
    per = (returns.filter(F.col(col).isNotNull()).join(g, "symbol")
           .groupBy(key, "date").agg(F.count(col).alias("_k")))
    return per.join(size, key).filter(F.col("_k") == F.col("_n")).select(key, "date")


def flag_partial(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """J-06: portfolios whose symbols lack data get ' (Partial)' appended to the label."""
    have = holdings.join(prices.select("symbol").distinct(), "symbol", "left_semi")
    n_all = holdings.groupBy(PKEY).agg(F.countDistinct("symbol").alias("n_requested"))
    n_have = have.groupBy(PKEY).agg(F.countDistinct("symbol").alias("n_available"))
    j = n_all.join(n_have, PKEY, "left").fillna(0, subset=["n_available"])
    return j.select(PKEY, F.col("n_requested").cast("bigint"), F.col("n_available").cast("bigint"),
                    F.when(F.col("n_available") < F.col("n_requested"), F.concat(F.col(PKEY), F.lit(" (Partial)")))
                    .otherwise(F.col(PKEY)).alias("label"))
