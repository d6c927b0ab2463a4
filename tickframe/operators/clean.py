"""C-*: missing values, outliers, standardisation, resampling and calendars.

Fills run over each key's ordered series (``Window.partitionBy(keys)``);
statistics are per key (bounded by the series length) or, for global
scalars, a one-row partial aggregate whose few numbers are read back and
inlined as literals (no cross join, nothing large through the driver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tickframe.functions.exprs import c, safe_div, series_window


def null_fractions(df: DataFrame, cols=None) -> DataFrame:
    """C-01 report: (column, null_fraction) for every column, one aggregate pass."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.avg(F.col(x).isNull().cast("double")).alias(x) for x in cols])
    return row.unpivot([], cols, "column", "null_fraction")


def drop_sparse_columns(df: DataFrame, threshold: float = 0.1, protect=()) -> DataFrame:
    """C-01: drop columns whose null fraction is strictly above ``threshold``.

    Q-09 fixed: the fraction is over the whole table, never per symbol, so every
    symbol keeps the same schema.  Reads back one row of fractions.
    """
    fr = {r["column"]: r["null_fraction"] for r in null_fractions(df).collect()}
    keep = [x for x in df.columns if x in protect or (fr.get(x) or 0.0) <= threshold]
    return df.select(*keep)


def numeric_cols(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def fill(df: DataFrame, cols, method: str = "forward_fill", keys=("symbol",), order: str = "date",
         zero_rest: bool = True) -> DataFrame:
    """C-02 / C-03 / C-04 over each key's series.

    forward_fill, backward_fill, interpolate (linear by position; leading nulls
    stay, trailing nulls take the last value), drop (rows with any null).
    Unknown methods forward-fill, as the reference does.  ``zero_rest`` then
    fills remaining numeric nulls with 0 (reference final step).
    """
    w = series_window(keys, order)
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    if method == "drop":
        out = df.dropna(subset=list(cols))
    elif method == "backward_fill":
        out = df.select(*[F.first(F.col(x), True).over(after).alias(x) if x in cols else F.col(x)
                          for x in df.columns])
    elif method == "interpolate":
        d = df.withColumn("_pos", F.row_number().over(w))
        sel = []
        for x in df.columns:
            if x not in cols:
                sel.append(F.col(x))
                continue
            pv = F.last(F.col(x), True).over(before)
            pp = F.last(F.when(F.col(x).isNotNull(), F.col("_pos")), True).over(before)
            nv = F.first(F.col(x), True).over(after)
            np_ = F.first(F.when(F.col(x).isNotNull(), F.col("_pos")), True).over(after)
            val = (F.when(F.col(x).isNotNull(), F.col(x)).when(pv.isNull(), F.lit(None))
                   .when(nv.isNull(), pv)
                   .otherwise(pv + (nv - pv) * (F.col("_pos") - pp) / (np_ - pp)))
            sel.append(val.alias(x))
        out = d.select(*sel)
    else:
        out = df.select(*[F.last(F.col(x), True).over(before).alias(x) if x in cols else F.col(x)
                          for x in df.columns])
    if zero_rest:
        out = out.fillna(0, subset=[x for x in numeric_cols(out) if x in cols])
    return out


def remove_outliers(df: DataFrame, cols, method: str = "iqr", threshold: float = 1.5,
                    keys=("symbol",)) -> DataFrame:
    """C-05 / C-06: drop rows outside IQR fences or beyond |z| > threshold, per key.

    Sequential over columns: column k's bounds use the rows that survived k-1.
    Rows with a null value are kept (a null comparison is not an outlier).
    """
    p = Window.partitionBy(*keys)
    for x in cols:
        v = F.col(x)
        if method == "iqr":
            q = F.percentile(v, F.array(F.lit(0.25), F.lit(0.75))).over(p)
            d = df.withColumn("_q", q)
            iqr = F.col("_q")[1] - F.col("_q")[0]
            out = (v < F.col("_q")[0] - threshold * iqr) | (v > F.col("_q")[1] + threshold * iqr)
        elif method == "zscore":
            d = df.withColumn("_m", F.avg(v).over(p)).withColumn("_s", F.stddev_samp(v).over(p))
            out = F.abs(safe_div(v - F.col("_m"), F.col("_s"))) > threshold
        else:
            continue
        df = d.filter(~F.coalesce(out, F.lit(False))).drop("_q", "_m", "_s")
    return df


def standardize(df: DataFrame, cols, method: str = "zscore", keys=("symbol",)) -> DataFrame:
    """C-09: zscore (sample std), minmax, robust ((x - median) / MAD), per key.

    Q-10 fixed: the median and MAD skip nulls.  Zero spread gives null.
    """
    p = Window.partitionBy(*keys)
    for x in cols:
        v = F.col(x)
        if method == "zscore":
            e = safe_div(v - F.avg(v).over(p), F.stddev_samp(v).over(p))
        elif method == "minmax":
            e = safe_div(v - F.min(v).over(p), F.max(v).over(p) - F.min(v).over(p))
        elif method == "robust":
            df = df.withColumn("_med", F.median(v).over(p))
            df = df.withColumn("_mad", F.median(F.abs(v - F.col("_med"))).over(p))
            e = safe_div(v - F.col("_med"), F.col("_mad"))
        else:
            continue
        df = df.withColumn(x, e).drop("_med", "_mad")
    return df


def period_end(date_col, freq: str):
    """Bucket label: D = the day, W = the Sunday ending the week, M / Q / Y = period end."""
    d = c(date_col).cast("date")
    if freq == "D":
        return d
    if freq == "W":
        return F.date_add(d, (8 - F.dayofweek(d)) % 7)
    if freq == "M":
        return F.last_day(d)
    if freq == "Q":
        return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    if freq in ("Y", "A"):
        return F.make_date(F.year(d), F.lit(12), F.lit(31))
    raise ValueError(f"unknown frequency {freq}")


def _calendar(lo, hi, freq: str):
    """Array of period-end labels inside [lo, hi] (pandas ``date_range(lo, hi, freq)``)."""
    if freq == "D":
        return F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))
    if freq == "W":
        first = F.date_add(lo, (8 - F.dayofweek(lo)) % 7)
        return F.filter(F.sequence(first, F.greatest(first, hi), F.expr("INTERVAL 7 DAYS")), lambda d: d <= hi)
    step, unit = {"M": (1, "month"), "Q": (3, "quarter"), "Y": (12, "year"), "A": (12, "year")}[freq]
    starts = F.sequence(F.trunc(lo, unit), F.trunc(hi, unit), F.expr(f"INTERVAL {step} MONTHS"))
    ends = F.transform(starts, lambda s: F.last_day(F.add_months(s, step - 1)))
    return F.filter(ends, lambda e: (e >= lo) & (e <= hi))


def align(df: DataFrame, cols, freq: str = "D", keys=("symbol",), date: str = "date") -> DataFrame:
    """C-07 + C-08: resample each key to ``freq`` (last non-null value per column per
    bucket), then reindex every key onto the common calendar of period ends between
    the global min and max date.  Gaps stay null; a trailing partial period whose
    end lies after the max date is not on the calendar (pandas behaviour).
    """
    keys = list(keys)
    b = df.withColumn("_bucket", period_end(date, freq))
    res = b.groupBy(*keys, "_bucket").agg(
        *[F.max_by(F.col(x), F.when(F.col(x).isNotNull(), F.col(date))).alias(x) for x in cols])
    # per-key extent, then the global extent by a window over #keys rows (no cross join)
    ext = df.groupBy(*keys).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    g = Window.partitionBy()
    ext = ext.select(*keys, F.min("_lo").over(g).cast("date").alias("_glo"),
                     F.max("_hi").over(g).cast("date").alias("_ghi"))
    grid = ext.select(*keys, F.explode(_calendar(F.col("_glo"), F.col("_ghi"), freq)).alias(date))
    return grid.join(res.withColumnRenamed("_bucket", date), keys + [date], "left")


def medians(df: DataFrame, cols, parts: int = 256) -> DataFrame:
    """(name, median) of each column's non-null values, exact, without one task that holds them all.

    Equal values are counted first, approximate quantiles (``parts`` a column) only deal the values into parts; the parts that
    hold the middle ranks are found from the counts, and only their values are put in order.  A column without values has no row."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(x).alias("name"), F.col(x).cast("double").alias("v")) for x in cols])).alias("_x"))
    long = long.select("_x.name", "_x.v").where("v IS NOT NULL")
    cuts = long.groupBy("name").agg(F.percentile_approx("v", [i / parts for i in range(1, parts)], 100 * parts).alias("cuts"))
    counted = long.groupBy("name", "v").agg(F.count(F.lit(1)).alias("n"))
    dealt = counted.join(F.broadcast(cuts), "name").select("name", "v", "n", F.size(F.filter("cuts", lambda s: s < F.col("v"))).alias("part"))
    name = Window.partitionBy("name")
    size = dealt.groupBy("name", "part").agg(F.sum("n").alias("m")).select(
        "name", "part", "m", (F.sum("m").over(name.orderBy("part")) - F.col("m")).alias("before"), F.sum("m").over(name).alias("total"))
    low, high = F.expr("(total - 1) div 2"), F.expr("total div 2")
    middle = size.where((F.col("before") <= high) & (F.col("before") + F.col("m") > low)).drop("m")
    ranked = dealt.join(F.broadcast(middle), ["name", "part"]).withColumn(
        "end", F.col("before") + F.sum("n").over(Window.partitionBy("name", "part").orderBy("v")))

    def at(rank):
        return F.min(F.when((F.col("end") - F.col("n") <= rank) & (rank < F.col("end")), F.col("v")))
    return ranked.groupBy("name").agg(((at(low) + at(high)) / 2).alias("median"))


def median_fill(df: DataFrame, cols) -> DataFrame:
    """C-11: nulls become the column's median over all rows; a column of nulls only stays as it is.  The medians reach the rows as a
    scalar subquery: no join, no job of its own, nothing through the driver program."""
    known = medians(df, cols).agg(F.map_from_entries(F.collect_list(F.struct("name", "median")))).scalar()
    return df.select(*[F.coalesce(F.col(x).cast("double"), known[x]).alias(x) if x in cols else F.col(x) for x in df.columns])
