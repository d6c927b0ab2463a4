"""Embedding near-duplicates by an epsilon grid order join.

Cosine >= t between unit vectors means a Euclidean distance of at most eps = sqrt(2 - 2 t).  Vectors are projected on
LEADING principal directions (fitted on a bounded sample of PCA_SAMPLE vectors; they steer the pruning only, never the
result), sorted by grid cells of side eps on those, and cut into blocks of consecutive vectors of BLOCK_BYTES.  Pairs of blocks
meet only if their bounding boxes lie within eps; a task joins two blocks by halving the longer interval again and
again, leaving out halves that are provably too far apart, and compares what is left in double precision.

Tasks return, for a pair of blocks, the number of links of each vector and a spanning forest of the links, never the
links themselves.  Equal vectors of a label are one vector with a weight.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, rows without a label and
rows without an id link with nothing; vectors of different lengths do not link; repeated rows are vectors of their
own; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.components import components
from tickframe.session import checkpoint_dir

THRESHOLD = 0.98
LEADING, BLOCK_BYTES, LEAF, PCA_SAMPLE = 6, 2 << 20, 64, 20_000
LEAST_BLOCK = 256
_SLACK = 1e-9


def _directions(vectors: list) -> dict[int, np.ndarray]:
    """Leading principal directions (columns) by vector length."""
    out = {}
    by_len: dict[int, list] = {}
    for v in vectors:
        by_len.setdefault(len(v), []).append(v)
    for d, vs in by_len.items():
        x = np.array(vs, np.float64)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        _, axes = np.linalg.eigh(np.cov(x, rowvar=False).reshape(d, d) if len(vs) > 1 else np.eye(d))
        out[d] = axes[:, ::-1][:, :LEADING]
    return out


def _unit(column: pa.Array, d: int) -> np.ndarray:
    x = np.asarray(column.flatten(), np.float64).reshape(-1, d)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _project(axes_shared, eps: float):
    def task(batches):
        axes = axes_shared.value
        for b in batches:
            for d in sorted(set(b.column("d").to_pylist())):
                part = b.filter(pa.compute.equal(b.column("d"), d))
                at = _unit(part.column("vec"), d) @ axes.get(d, np.eye(d)[:, :LEADING])
                cells = np.floor(at / eps).astype(np.int32)
                cols = {c: part.column(c) for c in part.schema.names}
                cols["at"] = pa.array(list(at), pa.list_(pa.float64()))
                cols["cells"] = pa.array(list(cells), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(cols)
    return task


def _cut(batches):
    """Rows in grid order -> blocks of at most BLOCK_BYTES (or LEAST_BLOCK rows) of one label and length."""
    held, key, most = [], None, 0

    def block():
        at = np.array([r["at"] for r in held])
        return {"label": [key[0]], "d": [key[1]], "block": [held[0]["rep"]], "lo": [at.min(axis=0).tolist()], "hi": [at.max(axis=0).tolist()],
                "ids": [np.array([r["rep"] for r in held], np.int64).tobytes()], "weights": [np.array([r["copies"] for r in held], np.int64).tobytes()],
                "ats": [at.tobytes()], "vecs": [np.array([r["vec"] for r in held], np.float64).tobytes()]}
    for b in batches:
        for r in b.to_pylist():
            if held and (len(held) >= most or key != (r["label"], r["d"])):
                yield pa.RecordBatch.from_pydict(block(), schema=_BLOCKS)
                held.clear()
            key, most = (r["label"], r["d"]), max(LEAST_BLOCK, BLOCK_BYTES // (8 * r["d"]))
            held.append(r)
    if held:
        yield pa.RecordBatch.from_pydict(block(), schema=_BLOCKS)


_BLOCKS = pa.schema([("label", pa.string()), ("d", pa.int32()), ("block", pa.int64()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())),
                     ("ids", pa.binary()), ("weights", pa.binary()), ("ats", pa.binary()), ("vecs", pa.binary())])
_BLOCKS_DDL = "label string, d int, block bigint, lo array<double>, hi array<double>, ids binary, weights binary, ats binary, vecs binary"


def _gap2(a: np.ndarray, b: np.ndarray) -> float:
    gap = np.maximum(0.0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
    return float(gap @ gap)


def _linked(ua, pa_, ub, pb, threshold: float, reach: float, same: bool):
    """Index pairs of vectors with a cosine of at least threshold, by recursive halving of the two intervals."""
    stack = [(0, len(ua), 0, len(ub))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        if same and b1 <= a0 or _gap2(pa_[a0:a1], pb[b0:b1]) > reach:
            continue
        if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
            i, j = np.nonzero(ua[a0:a1] @ ub[b0:b1].T >= threshold)
            i, j = i + a0, j + b0
            if same:
                i, j = i[i < j], j[i < j]
            if i.size:
                yield i, j
        elif a1 - a0 >= b1 - b0:
            m = (a0 + a1) // 2
            stack += [(a0, m, b0, b1), (m, a1, b0, b1)]
        else:
            m = (b0 + b1) // 2
            stack += [(a0, a1, b0, m), (a0, a1, m, b1)]


def _join_blocks(threshold: float, reach: float):
    def task(batches):
        for batch in batches:
            for r in batch.to_pylist():
                d, same = r["d"], r["block"] == r["block2"]
                side = []
                for s in ("", "2"):
                    v = np.frombuffer(r["vecs" + s]).reshape(-1, d)
                    side += [np.frombuffer(r["ids" + s], np.int64), np.frombuffer(r["weights" + s], np.int64),
                             v / np.sqrt((v * v).sum(axis=1, keepdims=True)), np.frombuffer(r["ats" + s]).reshape(len(v), -1)]
                ids_a, w_a, u_a, p_a, ids_b, w_b, u_b, p_b = side
                n_a, root = len(ids_a), list(range(len(ids_a) + (0 if same else len(ids_b))))
                links, tree, shift = np.zeros(len(root), np.int64), [], 0 if same else n_a

                def find(x):
                    while root[x] != x:
                        root[x] = root[root[x]]
                        x = root[x]
                    return x
                for i, j in _linked(u_a, p_a, u_b, p_b, threshold, reach, same):
                    np.add.at(links, i, w_b[j])
                    np.add.at(links, j + shift, w_a[i])
                    for x, y in zip(i.tolist(), (j + shift).tolist()):
                        x, y = find(x), find(y)
                        if x != y:
                            root[y] = x
                            tree.append((x, y))
                ids = ids_a if same else np.concatenate([ids_a, ids_b])
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(np.concatenate([ids[hit], ids[[x for x, _ in tree]].astype(np.int64)]), pa.int64()),
                    "b": pa.array([None] * hit.size + ids[[y for _, y in tree]].tolist(), pa.int64()),
                    "n": pa.array(links[hit].tolist() + [None] * len(tree), pa.int64())})
    return task


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of vectors: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    checkpoint_dir(spark)
    eps = math.sqrt(2 - 2 * threshold) + _SLACK
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).alias("vec"))
    good = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("vec") > 0) \
        & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    good = F.coalesce(good, F.lit(False))
    reps = rows.where(good).groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")) \
        .withColumn("d", F.size("vec")).checkpoint()
    sample = [r.vec for r in reps.orderBy(F.xxhash64("rep")).limit(PCA_SAMPLE).select("vec").collect()]
    axes = spark.sparkContext.broadcast(_directions(sample))
    placed = reps.mapInArrow(_project(axes, eps), reps_schema(reps) + ", at array<double>, cells array<int>")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["label", "d", "cells", "rep"]
    blocks = placed.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("label", "d", "rep", "copies", "at", "vec") \
        .mapInArrow(_cut, _BLOCKS_DDL).checkpoint()
    cell = lambda c: F.floor(F.col(c)[0] / F.lit(eps)).cast("int")
    meta = blocks.select("label", "d", "block", "lo", "hi")
    left = meta.withColumn("c", F.explode(F.sequence(cell("lo") - 1, cell("hi") + 1)))
    right = meta.select("label", "d", F.col("block").alias("block2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2")) \
        .withColumn("c", F.explode(F.sequence(cell("lo2"), cell("hi2"))))
    gap = F.aggregate(F.zip_with(F.zip_with("lo", "hi2", lambda x, y: x - y), F.zip_with("lo2", "hi", lambda x, y: x - y),
                                 lambda x, y: F.pow(F.greatest(x, y, F.lit(0.0)), 2)), F.lit(0.0), lambda s, x: s + x)
    pairs = left.join(right, ["label", "d", "c"]).where((F.col("block") <= F.col("block2")) & (gap <= eps * eps + _SLACK)) \
        .select("block", "block2").distinct()
    sides = [blocks.select(*(F.col(c).alias(c + s) for c in ("block", "ids", "weights", "ats", "vecs"))) for s in ("", "2")]
    found = pairs.join(sides[0].join(blocks.select("block", "d"), "block"), "block").join(sides[1], "block2").repartition(n, "block", "block2") \
        .mapInArrow(_join_blocks(threshold, eps * eps + _SLACK), "a bigint, b bigint, n bigint").checkpoint()
    links = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"))
    comps = components(found.where("b IS NOT NULL").select("a", "b"))
    per_rep = reps.select("label", "vec", "rep", "copies").join(links, F.col("rep") == links["a"], "left").join(comps, F.col("rep") == comps["id"], "left") \
        .select("label", "vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = rows.where(good).join(per_rep, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def reps_schema(reps: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in reps.schema)
