"""Base table access: one parquet file/folder per table under an sf directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan; Catalyst prunes columns and pushes filters into the reader.  The number of splits is the session's
    business (spark.sql.files.maxPartitionBytes and minPartitionNum)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
