"""Helpers shared by the plan modules: cached-free view loaders and rounding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tickframe.session import checkpoint_dir
from tickframe.sources import fixtures


GUARD = 3  # extra decimals of the intermediate DECIMAL


def round_col(col, digits: int):
    """Round a double to ``digits`` decimals through DECIMAL(38, digits + 3).

    Rounding a double directly is engine-dependent on exact ties (Spark rounds the
    shortest decimal form, DuckDB the binary value: 0.145 -> 0.15 vs 0.14).  The
    intermediate decimal with three guard digits makes both engines agree.
    """
    d = F.col(col).cast("double").try_cast(f"decimal(38,{digits + GUARD})")
    return F.coalesce(F.round(d, digits).cast("double"), F.col(col).cast("double"))  # too large for the decimal: as it is


def rounded(df: DataFrame, digits: int = 6, special: dict | None = None) -> DataFrame:
    """Round every floating column (same rounding is applied in the oracle SQL)."""
    special = special or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(round_col(f.name, special.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def oround(sql: str, cols, digits: int = 6, special: dict | None = None) -> str:
    """Wrap oracle SQL so the listed double columns are rounded like ``rounded``."""
    special = special or {}
    if not cols:
        return sql
    rep = ", ".join(
        f"CAST(ROUND(TRY_CAST(CAST({c} AS DOUBLE) AS DECIMAL(38, {special.get(c, digits) + GUARD})), "
        f"{special.get(c, digits)}) AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"


def materialise(df: DataFrame) -> DataFrame:
    """Write a reused intermediate once as a parquet table in the shared checkpoint folder
    and read it back (lineage cut, one job -- an eager RDD checkpoint would compute it twice).

    Used for derived views that one query consumes in several branches: without it
    every branch would rescan and re-aggregate the fact table.  The folder comes from
    ``spark.checkpoint.dir`` (a temporary one only when unset, as in local tests); a
    lost executor only costs re-reading the written files.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/views/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


class Views:
    """Per-call access to the derived views of one sf directory.

    Each view is one DataFrame object per call, so branches of a query that use it see
    the identical subtree and Spark reuses its shuffle output (ReuseExchange).  With
    ``materialise_views`` (session conf ``tickframe.materialise.views=true``) the reused
    views are instead written once to the shared checkpoint folder -- the better choice
    when a view is consumed under different projections or the source scan is huge.
    """

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir
        self._bars = None
        self._holdings = None
        self._mat = (spark.conf.get("tickframe.materialise.views", "false") or "false").lower() == "true"

    def _keep(self, df: DataFrame) -> DataFrame:
        return materialise(df) if self._mat else df

    @property
    def bars(self) -> DataFrame:
        if self._bars is None:
            self._bars = self._keep(fixtures.bars(self.spark, self.sf_dir))
        return self._bars

    @property
    def holdings(self) -> DataFrame:
        # always materialised: a handful of rows whose lineage is a four-way join over the
        # fact tables, consumed under different projections (no exchange reuse possible)
        if self._holdings is None:
            self._holdings = materialise(fixtures.holdings(self.spark, self.sf_dir))
        return self._holdings

    @property
    def stock_info(self) -> DataFrame:
        return fixtures.stock_info(self.spark, self.sf_dir)

    @property
    def macro(self) -> DataFrame:
        return fixtures.macro(self.spark, self.sf_dir)

    @property
    def benchmark(self) -> DataFrame:
        return fixtures.benchmark_returns(self.spark, self.sf_dir, self.bars)

    @property
    def metric_bars(self) -> DataFrame:
        return fixtures.metric_bars(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        from tickframe.sources.tables import table
        return table(self.spark, self.sf_dir, name)
