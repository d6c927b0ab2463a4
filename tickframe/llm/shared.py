"""Tables between steps, and joins whose small side is broadcast only after its size was checked."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.session import checkpoint_dir

MAX_BROADCAST_BYTES = 96 << 20


def stored(df: DataFrame) -> DataFrame:
    """df written as compressed Parquet into the session's shared folder and read back: a lineage cut that survives
    lost executors and takes less disk than a checkpoint."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bounded(df: DataFrame, row_bytes: int = 48, values: str | None = None, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """df (materialised already) marked for broadcast if its rows, and 8 bytes for every element of the array column
    ``values``, come to at most limit; else df itself, for a shuffled join."""
    size = df.agg((F.count(F.lit(1)) * row_bytes + (F.coalesce(F.sum(F.size(values)), F.lit(0)) * 8 if values else F.lit(0))).alias("b")).first().b
    return F.broadcast(df) if size <= limit else df


def merged(starts, ends) -> list[list[int]]:
    """Sorted, disjoint, non-touching intervals that cover the same places."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out
