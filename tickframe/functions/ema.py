"""Exponentially weighted mean (pandas ``ewm(span, adjust=True)``) as native window expressions.

EMA_t = N_t / D_t with N_t = sum_{i<=t, x_i not null} b^(t-i) x_i, D_t = same with x = 1,
b = 1 - 2/(span+1).  A single closed form b^t * sum x_i b^-i overflows after a few
thousand rows, so the series is cut into blocks of K rows short enough that b^-j
(j = row index inside the block) stays below e^300:

* inside a block: running sum of x_j * b^-j over (key, block) ordered by date;
* across blocks: a block is the affine map N -> E + b^K N.  Composed over J blocks the factor
  is b^(J K); from b^(J K) < e^-1454 on, the smallest double over the largest, the older blocks add
  exactly 0 in double precision.  So a row folds the last J = ceil(1454 / (K ln(1/b))) maps and no
  more: J does not grow with the series (5 blocks of full size), nor does the list on a row.

The block windows are ordered by the block number, a prefix of the order by block and date, so
all EMAs of a frame that share their blocks share one sort.  No join, no Python.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ln(largest double / smallest positive double), rounded up: a smaller factor times any sum is 0
VANISHES = 1455.0


def block_rows(span: float) -> int:
    b = 1.0 - 2.0 / (span + 1.0)
    return max(1, int(300.0 / math.log(1.0 / b)))


def lookback_blocks(span: float, rows: int) -> int:
    """Earlier blocks of ``rows`` rows whose sums can still change a double."""
    b = 1.0 - 2.0 / (span + 1.0)
    return max(1, math.ceil(VANISHES / (rows * math.log(1.0 / b))))


def with_blocks(df: DataFrame, rows: int, blk: str, keys=("symbol",), order: str = "date") -> DataFrame:
    """Append ``blk`` (number of the block of ``rows`` rows) and ``<blk>_row`` (row inside it)."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    return (df.withColumn(f"{blk}_row", at).withColumn(blk, F.floor(F.col(f"{blk}_row") / rows))
              .withColumn(f"{blk}_row", F.col(f"{blk}_row") % rows))


def with_ema(df: DataFrame, col: str, span: float, out: str, keys=("symbol",),
             order: str = "date", block: int | None = None, blk_col: str | None = None) -> DataFrame:
    """Append ``out`` = EMA(span) of ``col``.

    Several EMAs of one frame can share the columns of ``with_blocks(df, block, blk_col)`` (with a
    ``block`` no larger than any of their ``block_rows``): their windows then share one sort.
    A row whose last 745 / ln(1/b) values are all null has no EMA.
    """
    keys = list(keys)
    b = 1.0 - 2.0 / (span + 1.0)
    k = block or block_rows(span)
    s_n, s_d, blocks = (f"_{out}_{n}" for n in ("sn", "sd", "blocks"))
    blk = blk_col or f"_{out}_blk"
    d = df if blk_col is not None else with_blocks(df, k, blk, keys, order)
    x, j = F.col(col), F.col(f"{blk}_row")
    present = x.isNotNull()
    run = Window.partitionBy(*keys, blk).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inv = F.pow(F.lit(b), -j)
    d = (d.withColumn(s_n, F.sum(F.when(present, x * inv).otherwise(F.lit(0.0))).over(run))
          .withColumn(s_d, F.sum(F.when(present, inv).otherwise(F.lit(0.0))).over(run)))
    # earlier blocks are full: their last row holds E = b^(K-1) * S; the frame moves once per block
    bj = F.pow(F.lit(b), j)
    summary = F.when(j == k - 1, F.struct((bj * F.col(s_n)).alias("n"), (bj * F.col(s_d)).alias("d")))
    earlier = Window.partitionBy(*keys).orderBy(blk).rangeBetween(-lookback_blocks(span, k), -1)
    d = d.withColumn(blocks, F.collect_list(summary).over(earlier))
    bk = F.lit(b ** k)
    carry = F.aggregate(
        F.col(blocks), F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("d")),
        lambda acc, e: F.struct((e["n"] + bk * acc["n"]).alias("n"), (e["d"] + bk * acc["d"]).alias("d")))
    bj1 = F.pow(F.lit(b), j + 1)
    num = bj * F.col(s_n) + bj1 * carry["n"]
    den = bj * F.col(s_d) + bj1 * carry["d"]
    d = d.withColumn(out, F.when(den > 0, num / den)).drop(s_n, s_d, blocks)
    return d if blk_col is not None else d.drop(blk, f"{blk}_row")


def with_emas(df: DataFrame, col: str, spans, keys=("symbol",), order: str = "date", prefix: str = "ema") -> DataFrame:
    """Append ``<prefix>_<span>`` for every span, all on one sort."""
    rows = min(block_rows(s) for s in spans)
    d = with_blocks(df, rows, "_ema_blk", keys, order)
    for s in spans:
        d = with_ema(d, col, s, f"{prefix}_{s}", keys, order, rows, "_ema_blk")
    return d.drop("_ema_blk", "_ema_blk_row")
