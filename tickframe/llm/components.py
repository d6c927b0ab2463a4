"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a partial-aggregated minimum per node and an equi-join, so a node with very many links is neither
gathered nor held in one task.  The link table shrinks to stars that point to the smallest id of each component;
each round is checkpointed into the session's shared checkpoint folder.  A round never has more links than the one before,
so the first one's number tells how many tasks read them: many shuffle partitions with few links each cost more than the links.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.session import checkpoint_dir

TASK_LINKS = 100_000


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in the columns a and b of links (longs), component being the least id reachable.

    Null ends and self-links are ignored; repeated and reversed links count once; no links give no rows.
    """
    spark = links.sparkSession
    checkpoint_dir(spark)
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    n = edges.count()
    tasks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(n / TASK_LINKS))
    edges, before = edges.coalesce(tasks), None
    while n:
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        low = _least(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = _least(large)
        # the least neighbour's own row links u itself
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")) \
            .distinct().checkpoint().coalesce(tasks)
        state = tuple(small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        edges = small
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
