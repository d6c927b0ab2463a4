"""Approximate nearest neighbours by largest inner product: multi-index hashing over learned rotated binary codes.

Vectors get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, so that the order by inner product with a query
is the order by angle.  Codes of BITS bits are signs after centring, projection on LEADING principal directions and
several learned rotations (iterative quantisation from different starts), all fitted on at most SAMPLE vectors.  A code is split into
substrings of 8 or 16 bits.  Two codes within a Hamming radius R agree in at least one of m substrings up to R // m bits
(pigeonhole), so the buckets of all substring values that close to the query's hold every code within R.

Every different vector is indexed once, with the least ``k + 1`` ids that have it (its other copies can't be among k
results).  Blocks of BLOCK_ROWS vectors carry codes and floats; a task takes a block of the index and a block of queries (the
stated query set against all rows, in blocks), builds the substring tables, probes them, keeps codes within R, takes inner
products of those in double precision and returns each query's best k + 1 of the block.  Best of blocks are cut per query.

R is calibrated: CALIBRATION queries are compared with all rows exactly, R is the distance within which KEPT of their true
neighbours lie.  Queries that find fewer than k rows probe again with a wider radius, at last with all bits, so a query has k
results whenever there are k candidates.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without an id, take no
part; a query and a candidate need equal lengths; a row is no candidate of queries of its own id; equal rows count
once; several vectors of one queried id are queries of their own under that id.  Ties go to the smaller id.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.shared import stored
from tickframe.session import checkpoint_dir

K, EVERY = 20, 20
BITS, LEADING, SAMPLE, ROUNDS = 256, 64, 20_000, 15
CALIBRATION, KEPT = 64, 0.97
BLOCK_ROWS, QUERY_ROWS = 65_536, 4_096
_ROWS = "vec_id bigint, d int, key binary, norm double, vec array<double>"


def _packed(batches):
    """Usable vectors in double precision, with a digest that stands for the vector and its norm."""
    for b in batches:
        out = []
        for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if i is None or not v or None in v:
                continue
            x = np.array(v, np.float64) + 0.0  # one zero
            if np.isfinite(x).all() and x.any():
                out.append((i, len(x), hashlib.blake2b(x.tobytes(), digest_size=16).digest(), math.sqrt(x @ x), x))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.list_(pa.float64())))],
                                             names=["vec_id", "d", "key", "norm", "vec"])


class Coder:
    """Learned codes for vectors of one length; ``most`` is the largest norm."""

    def __init__(self, sample: np.ndarray, d: int, most: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.most = most
        x = self.lifted(sample, True)
        self.mean = x.mean(axis=0) if len(x) else np.zeros(d + 1)
        _, axes = np.linalg.eigh(np.cov(x, rowvar=False) if len(x) > 1 else np.eye(d + 1))
        self.axes = axes[:, ::-1][:, :min(LEADING, d + 1)]
        at, self.turns = (x - self.mean) @ self.axes, []
        for _ in range(-(-BITS // self.axes.shape[1])):
            turn, _ = np.linalg.qr(rng.normal(size=(self.axes.shape[1],) * 2))
            for _ in range(ROUNDS if len(x) > 1 else 0):  # signs, then the rotation that fits them best
                u, _, v = np.linalg.svd(np.where(at @ turn >= 0, 1.0, -1.0).T @ at)
                turn = (u @ v).T
            self.turns.append(turn)
        self.projection = self.axes @ np.concatenate(self.turns, axis=1)[:, :BITS]

    def lifted(self, x: np.ndarray, candidate: bool) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.most ** 2 - (x * x).sum(axis=1))) if candidate else np.zeros(len(x))
        return np.concatenate([x, rest[:, None]], axis=1) / (self.most if candidate else np.sqrt((x * x).sum(axis=1, keepdims=True)))

    def codes(self, x: np.ndarray, candidate: bool) -> np.ndarray:
        """(rows, BITS / 8) bytes."""
        return np.packbits((self.lifted(x, candidate) - self.mean) @ self.projection >= 0, axis=1)


def hamming(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes.view(np.uint64) ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)


class SubstringIndex:
    """Tables of one block of codes: for every substring the rows in order of its value, and where each value's rows begin."""

    def __init__(self, codes: np.ndarray, width: int):
        self.codes, self.width = codes, width
        self.parts = np.ascontiguousarray((codes if width == 8 else codes.view(np.uint16)).T)
        self.order = [np.argsort(p, kind="stable") for p in self.parts]
        values = np.arange((1 << width) + 1)
        self.starts = [np.searchsorted(p[o], values) for p, o in zip(self.parts, self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes are within radius of code: all of them, by probing every substring's near buckets."""
        m = len(self.parts)
        near = masks(self.width, radius // m)
        found = np.zeros(len(self.codes), bool)
        for s, value in enumerate((code if self.width == 8 else code.view(np.uint16)).tolist()):
            buckets = near ^ value
            lo, hi = self.starts[s][buckets], self.starts[s][buckets + 1]
            full = np.flatnonzero(hi > lo)
            if (hi - lo).sum() * 4 < len(found):
                for a, b in zip(lo[full].tolist(), hi[full].tolist()):
                    found[self.order[s][a:b]] = True
            else:  # many rows: test every row's bucket instead of listing the buckets' rows
                hit = np.zeros(1 << self.width, bool)
                hit[buckets] = True
                found |= hit[self.parts[s]]
            if found.all():
                break
        rows = np.flatnonzero(found)
        return rows[hamming(self.codes[rows], code) <= radius]


_masks: dict[tuple[int, int], np.ndarray] = {}


def masks(width: int, radius: int) -> np.ndarray:
    """All values of width bits with at most radius ones."""
    if (width, radius) not in _masks:
        values = np.arange(1 << width)
        _masks[width, radius] = values[np.bitwise_count(values) <= radius]
    return _masks[width, radius]


def substring_width(radius: int) -> int:
    """16 bits while few of the 65,536 values are near, else 8."""
    return 16 if radius // (BITS // 16) <= 2 else 8


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, d)


def _best(scores: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller least id."""
    if scores.size > k:
        cut = np.partition(scores, -k)[-k]
        keep = np.flatnonzero(scores >= cut)
    else:
        keep = np.arange(scores.size)
    return keep[np.lexsort((least[keep], -scores[keep]))][:k]


_BLOCKS = "d int, block bigint, n int, keys binary, ids binary, firsts binary, codes binary, vecs binary"
_BLOCKS_ARROW = pa.schema([("d", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary()),
                           ("firsts", pa.binary()), ("codes", pa.binary()), ("vecs", pa.binary())])


def _blocks(coders, most: int, candidate: bool):
    """Rows (sorted by d in a task) -> blocks of at most ``most`` vectors of one length, coded."""
    def task(batches):
        from pyspark import TaskContext
        held, at, made = [], None, 0

        def block():
            nonlocal made
            vecs = np.array([r[3] for r in held])
            ids = [i for r in held for i in r[2]]
            codes = coders.value[at].codes(vecs, candidate)
            made += 1
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(
                (at, (TaskContext.get().partitionId() << 32) + made, len(held), b"".join(r[1] for r in held), np.array(ids, np.int64).tobytes(),
                 np.cumsum([0] + [len(r[2]) for r in held]).tobytes(), codes.tobytes(), vecs.tobytes()), _BLOCKS_ARROW)], schema=_BLOCKS_ARROW)
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("d", "key", "ids", "vec"))):
                if held and (len(held) >= most or r[0] != at):
                    yield block()
                    held.clear()
                at = r[0]
                held.append(r)
        if held:
            yield block()
    return task


class _Block:
    def __init__(self, r: dict, side: str = ""):
        self.d, self.n = r["d"], r["n" + side]
        self.keys = [r["keys" + side][16 * i:16 * i + 16] for i in range(self.n)]
        self.ids, self.firsts = np.frombuffer(r["ids" + side], np.int64), np.frombuffer(r["firsts" + side], np.int64)
        self.least = self.ids[self.firsts[:-1]]
        self.codes = np.frombuffer(r["codes" + side], np.uint8).reshape(self.n, BITS // 8)
        self.vecs = np.frombuffer(r["vecs" + side], np.float64).reshape(self.n, self.d)


_FOUND = "key binary, vec_id bigint, score double"
_FOUND_ARROW = pa.schema([("key", pa.binary()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(radius: int, k: int):
    """Rows (index block, query block) -> every query's best k + 1 rows of the block within the radius."""
    def task(batches):
        for batch in batches:
            for r in batch.to_pylist():
                block, asked = _Block(r), _Block(r, "2")
                index = SubstringIndex(block.codes, substring_width(radius))
                keys, ids, scores = [], [], []
                for q in range(asked.n):
                    rows = index.within(asked.codes[q], radius)
                    score = (block.vecs[rows] * asked.vecs[q]).sum(axis=1)
                    best = _best(score, block.least[rows], k + 1)
                    for p, s in zip(rows[best].tolist(), score[best].tolist()):
                        mine = block.ids[block.firsts[p]:block.firsts[p + 1]].tolist()
                        keys += [asked.keys[q]] * len(mine)
                        ids += mine
                        scores += [s] * len(mine)
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], schema=_FOUND_ARROW)
    return task


def _true_neighbours(queries, k: int):
    """Exact best k of each block for a few broadcast queries, with their Hamming distances; none below a query's bound."""
    def task(batches):
        for batch in batches:
            for r in batch.to_pylist():
                block, out = _Block(r), []
                for n, (d, key, vec, code, bound) in enumerate(queries.value):
                    if d != block.d:
                        continue
                    score = (block.vecs * vec).sum(axis=1)
                    if key in block.keys:
                        score[block.keys.index(key)] = -np.inf
                    best = _best(score, block.least, k)
                    best = best[np.isfinite(score[best]) & (score[best] >= bound)]
                    out += zip([n] * best.size, score[best].tolist(), hamming(block.codes[best], code).tolist())
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.float64(), pa.int32()))], names=["q", "score", "distance"])
    return task


def _sample(rows: DataFrame) -> dict[int, tuple[list, np.ndarray]]:
    """(keys, vectors) by length, of at most SAMPLE vectors of all."""
    found: dict[int, list] = {}
    for r in rows.select("d", "key", "vec").orderBy(F.xxhash64("key")).limit(SAMPLE).collect():
        found.setdefault(r.d, []).append((bytes(r.key), r.vec))
    return {d: ([k for k, _ in x], np.array([v for _, v in x], np.float64)) for d, x in found.items()}


def _coders(rows: DataFrame, sample: dict) -> dict[int, Coder]:
    """A coder for every vector length that occurs."""
    norms = {r.d: r.m for r in rows.groupBy("d").agg(F.max("norm").alias("m")).collect()}  # a row per length
    return {d: Coder(sample[d][1] if d in sample else np.zeros((0, d)), d, m) for d, m in norms.items()}


def _calibrated(index: DataFrame, queries: DataFrame, coders, sample: dict, k: int) -> int:
    """The Hamming radius within which KEPT of the true neighbours of CALIBRATION queries lie.

    The k-th best of the sample bounds a query's k-th best of all rows from below, so few rows leave the tasks."""
    spark = index.sparkSession
    asked = []
    for r in queries.select("d", "key", "vec").orderBy(F.xxhash64("key")).limit(CALIBRATION).collect():
        vec, (keys, known) = np.array(r.vec), sample.get(r.d, ([], np.zeros((0, r.d))))
        score = np.sort([s for s, key in zip((known * vec).sum(axis=1).tolist(), keys) if key != bytes(r.key)])
        asked.append((r.d, bytes(r.key), vec, coders.value[r.d].codes(vec[None, :], False)[0], score[-k] if score.size >= k else -np.inf))
    best = index.mapInArrow(_true_neighbours(spark.sparkContext.broadcast(asked), k), "q int, score double, distance int")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "distance"))
    found = sorted(r.distance for r in best.withColumn("p", place).where(F.col("p") <= k).select("distance").collect())  # CALIBRATION * k rows
    return found[min(len(found) - 1, math.ceil(KEPT * len(found)))] if found else BITS


def nearest(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose id is divisible by every."""
    spark = vectors.sparkSession
    checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vec")).mapInArrow(_packed, _ROWS).distinct())
    place = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    reps = stored(rows.withColumn("p", place).where(F.col("p") <= k + 1).groupBy("key")
                  .agg(F.first("d").alias("d"), F.first("vec").alias("vec"), F.max("norm").alias("norm"), F.array_sort(F.collect_list("vec_id")).alias("ids")))
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "key")
    queries = stored(reps.join(asked.select("key").distinct(), "key", "left_semi"))
    sample = _sample(reps)
    coders = spark.sparkContext.broadcast(_coders(reps, sample))  # a projection per vector length
    index = stored(reps.repartition(n, "key").sortWithinPartitions("d").mapInArrow(_blocks(coders, BLOCK_ROWS, True), _BLOCKS))
    radius, best, open_ = _calibrated(index, queries, coders, sample, k), None, queries
    sizes = reps.groupBy("d").agg(F.sum(F.size("ids")).alias("rows"))
    while True:
        found = stored(_round(index, open_, coders, radius, k, n))
        counts = found.groupBy("key").agg(F.count(F.lit(1)).alias("got"))
        short = open_.join(counts, "key", "left").join(F.broadcast(sizes), "d") \
            .where(F.coalesce("got", F.lit(0)) < F.least(F.col("rows"), F.lit(k + 1))).select("key") if radius < BITS else None
        more = stored(short) if short is not None else None
        last = more is None or more.isEmpty()
        done = found if last else found.join(more, "key", "left_anti")
        best = done if best is None else best.unionByName(done)
        if last:
            break
        open_, radius = stored(open_.join(more, "key", "left_semi")), min(BITS, max(radius + 1, (radius + BITS + 1) // 2))
    lists = best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("found"))
    own = asked.join(lists, "key").select(F.col("vec_id").alias("query_id"), F.slice(F.filter("found", lambda x: x.vec_id != F.col("vec_id")), 1, k).alias("found"))
    return own.select("query_id", F.posexplode("found").alias("at", "x")) \
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))


def _round(index: DataFrame, queries: DataFrame, coders, radius: int, k: int, n: int) -> DataFrame:
    """Best k + 1 rows within the radius of every query, over all blocks."""
    asked = stored(queries.repartition(max(1, n // 4), "key").sortWithinPartitions("d").mapInArrow(_blocks(coders, QUERY_ROWS, False), _BLOCKS))
    sides = asked.select("d", *(F.col(c).alias(c + "2") for c in ("block", "n", "keys", "ids", "firsts", "codes", "vecs")))
    pairs = index.select("d", "block").join(sides.select("d", "block2"), "d")  # (index block, query block), ids only
    met = pairs.join(index.drop("d"), "block").join(sides.drop("d"), "block2").repartition(n, "block", "block2")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    return met.mapInArrow(_search(radius, k), _FOUND).withColumn("p", place).where(F.col("p") <= k + 1).drop("p")
