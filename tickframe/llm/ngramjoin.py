"""N-gram Jaccard join by vertical partitioning.

Documents are sets of word shingles.  All shingles have one global order: first by the exact number of shingles in their
hash bucket over all documents (2**LOAD_BITS buckets, so what is broadcast has a fixed size), then by hash; shingles of
common lines and passages thereby come last.  The order is cut into FRAGMENTS intervals of equal mass.  For a candidate
pair each fragment counts its own part of the overlap, and the parts are summed per pair.

Candidates share a shingle of their prefixes (sets that share none of the first n - ceil(0.75 n) + 1 shingles can't
reach 0.75).  Not all documents of a shingle are paired.  First every document meets the one that it shares most prefix
shingles with among the least ones of its shingles, and verified links form components.  Only documents of different
components that still share a prefix shingle, and enough of them, are compared afterwards.  Shingles that are still open
between more than HOT documents, of which one component holds at least a DENSE-th, tell of large groups of near copies:
their documents are dealt to blocks by their commonest such shingle; tasks compare two blocks that share such a
shingle, in matrix products, and return a spanning forest of the links.  Copies of a set are one document from the start.
A shingle whose bucket is far above the mean is split over several groups (``salt``), whose least documents meet again.

Defined results: null, empty or blank texts have no shingles and link with nothing; fewer words than the shingle
length make one shingle of all words; a null doc_id gets a null component and links with nothing; repeated rows are
copies and each get a row (one doc_id with several different texts is outside the contract); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm import blocks as B
from tickframe.llm.components import components
from tickframe.llm.shared import stored
from tickframe.session import checkpoint_dir

SHINGLE, NUMERATOR, DENOMINATOR = 5, 75, 100
LOAD_BITS, FRAGMENTS, SPLIT, HOT, DENSE = 18, 8, 10_000, 32, 8
BLOCK_ROWS, BLOCK_BYTES = 512, 4 << 20
TEXT_BYTES = 1 << 17  # of a block of texts: a worker holds some 200 times that while it hashes
CHUNK = 1 << 14
MAX_BROADCAST_IDS = 2_000_000


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of every row, sorted by row and hash, and the first of each row."""
    starts, ends, firsts = B.slices(B.SPACE_SPLIT[data], offsets)
    words = B.slice_hash(B.prefix_sums(B.value_table(lower=lower)[data]), starts, ends) if starts.size else np.zeros(0, np.uint64)
    counts = np.diff(firsts)
    sums = B.prefix_sums(words)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(n.size), n)
    lo = firsts[row] + (np.arange(row.size) - np.repeat(np.cumsum(n) - n, n))
    h = B.slice_hash(sums, lo, np.minimum(lo + size, firsts[row + 1])) if row.size else np.zeros(0, np.uint64)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(row.size, bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    row, h = row[new], h[new]
    return row, h, np.searchsorted(row, np.arange(n.size + 1))


def signatures(h: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """One 64-bit value per set, the same for equal sets (0 for empty ones)."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(B.mix(h), dtype=np.uint64)])
    n = np.diff(firsts).astype(np.uint64)
    return np.where(n > 0, B.mix(sums[firsts[1:]] - sums[firsts[:-1]] + n), np.uint64(0)).view(np.int64)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - LOAD_BITS)).astype(np.int64)


_SETS = "doc_id bigint, n bigint, sig bigint, chunk int, loads binary"


def _survey(batches):
    """A row per document (size and signature of its set) and this task's bucket loads in chunks."""
    loads = np.zeros(1 << LOAD_BITS, np.int64)
    for rows, data, offsets in B.blocks(batches, "text", TEXT_BYTES):
        _, h, firsts = shingles(data, offsets)
        np.add.at(loads, _bucket(h), 1)
        k = rows.num_rows
        yield pa.RecordBatch.from_pydict({"doc_id": rows.column("doc_id"), "n": pa.array(np.diff(firsts), pa.int64()),
                                          "sig": pa.array(signatures(h, firsts), pa.int64()), "chunk": pa.nulls(k, pa.int32()), "loads": pa.nulls(k, pa.binary())})
    parts = loads.reshape(-1, CHUNK).astype(np.int32)
    used = [i for i in range(len(parts)) if parts[i].any()]
    yield pa.RecordBatch.from_pydict({"doc_id": pa.nulls(len(used), pa.int64()), "n": pa.nulls(len(used), pa.int64()), "sig": pa.nulls(len(used), pa.int64()),
                                      "chunk": pa.array(used, pa.int32()), "loads": pa.array([parts[i].tobytes() for i in used], pa.binary())})


def _sum_loads(batches):
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for chunk, raw in zip(b.column("chunk").to_pylist(), b.column("loads").to_pylist()):
            total[chunk] = total.get(chunk, 0) + np.frombuffer(raw, np.int32).astype(np.int64)
    if total:
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(total), pa.int32()), "loads": pa.array([x.tobytes() for x in total.values()], pa.binary())})


def global_order(loads: np.ndarray) -> dict[str, np.ndarray]:
    """The global order as plain arrays: loads by bucket, the cuts between fragments, and how often a hot bucket's shingles are split."""
    used = np.sort(loads[loads > 0])
    mass = np.cumsum(used)
    cuts = used[np.searchsorted(mass, mass[-1] * np.arange(1, FRAGMENTS) / FRAGMENTS)] if used.size else np.zeros(FRAGMENTS - 1, np.int64)
    mean = used.mean() if used.size else 0
    return {"loads": loads, "cuts": cuts, "salts": (1 + np.maximum(0, loads - 2 * mean) // SPLIT).astype(np.int64)}


def _equal_overlap(n):
    """Least overlap of a set of n shingles with one that is no smaller."""
    both = NUMERATOR + DENOMINATOR
    return (2 * NUMERATOR * n + both - 1) // both


def _prefixes(order_shared):
    def task(batches):
        order, seen = order_shared.value, set()
        for _, data, offsets in B.blocks(batches, "text", TEXT_BYTES):
            row, h, firsts = shingles(data, offsets)
            sig, n = signatures(h, firsts), np.diff(firsts)
            rank = np.lexsort((h, order["loads"][_bucket(h)], row))
            row, h = row[rank], h[rank]
            at = np.arange(row.size) - firsts[row]
            length = n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1
            fresh = np.zeros(n.size, bool)
            for k, s in enumerate(sig.tolist()):  # copies in this task once
                if s not in seen:
                    seen.add(s)
                    fresh[k] = True
            keep = (at < length[row]) & fresh[row]
            short = (at < (n - _equal_overlap(n) + 1)[row])[keep]
            row, h = row[keep], h[keep]
            salts, s = order["salts"][_bucket(h)], sig[row]
            yield pa.RecordBatch.from_pydict({
                "token": pa.array(h.view(np.int64), pa.int64()), "sig": pa.array(s, pa.int64()),
                "salt": pa.array(np.where(salts > 1, s % salts, 0).astype(np.int16), pa.int16()), "split": pa.array(salts > 1, pa.bool_()), "short": pa.array(short, pa.bool_())})
    return task


def _sets(batches):
    """The sorted shingles of each document."""
    for rows, data, offsets in B.blocks(batches, "text", TEXT_BYTES):
        _, h, firsts = shingles(data, offsets)
        yield pa.RecordBatch.from_pydict({"rep": rows.column("doc_id"), "set": pa.array([h[a:b].tobytes() for a, b in zip(firsts, firsts[1:])], pa.binary())})


def _dicts(batch: pa.RecordBatch):
    """The rows of a batch, a few at a time: sets and blocks are long."""
    for i in range(0, batch.num_rows, 8):
        yield from batch.slice(i, 8).to_pylist()


_BLOCK = "block bigint, reps array<bigint>, comps array<bigint>, sizes array<int>, words binary, places binary"


def _cut(batches):
    """Sorted documents -> blocks: the block's shingles once, and their places for each document."""
    def block(rows):
        sets = [np.frombuffer(r["set"], np.uint64) for r in rows]
        words, places = np.unique(np.concatenate(sets), return_inverse=True)
        return pa.RecordBatch.from_pydict({
            "block": pa.array([rows[0]["rep"]], pa.int64()), "reps": pa.array([[r["rep"] for r in rows]], pa.list_(pa.int64())),
            "comps": pa.array([[r["comp"] for r in rows]], pa.list_(pa.int64())), "sizes": pa.array([[len(x) for x in sets]], pa.list_(pa.int32())),
            "words": pa.array([words.tobytes()], pa.binary()), "places": pa.array([places.astype(np.uint32).tobytes()], pa.binary())})
    held, size, key = [], 0, None
    for b in batches:
        for r in _dicts(b):
            if held and (key != (r["main"], r["part"]) or size + len(r["set"]) > BLOCK_BYTES):
                yield block(held)
                held, size = [], 0
            key = (r["main"], r["part"])
            held.append(r)
            size += len(r["set"])
    if held:
        yield block(held)


def _common(one, two) -> np.ndarray:
    """Sizes of the intersections of every set of one block with every set of another, in chunks of their common shingles."""
    (words1, places1, sizes1), (words2, places2, sizes2) = one, two
    both, at1, at2 = np.intersect1d(words1, words2, assume_unique=True, return_indices=True)
    out = np.zeros((sizes1.size, sizes2.size), np.float32)
    cells = []
    for words, places, sizes, at in ((words1, places1, sizes1, at1), (words2, places2, sizes2, at2)):
        column = np.full(words.size, -1, np.int64)
        column[at] = np.arange(both.size)
        column, row = column[places], np.repeat(np.arange(sizes.size), sizes)
        keep = column >= 0
        order = np.argsort(column[keep], kind="stable")
        cells.append((row[keep][order], column[keep][order], sizes.size))
    for lo in range(0, both.size, 4096):
        part = []
        for row, column, n in cells:
            a, b = np.searchsorted(column, (lo, lo + 4096))
            m = np.zeros((n, min(4096, both.size - lo)), np.float32)
            m[row[a:b], column[a:b] - lo] = 1
            part.append(m)
        out += part[0] @ part[1].T
    return out


def _compare(batches):
    """Links between documents of different components in a pair of blocks, as a spanning forest."""
    for batch in batches:
        for r in _dicts(batch):
            side = [(np.frombuffer(r["words" + s], np.uint64), np.frombuffer(r["places" + s], np.uint32), np.array(r["sizes" + s], np.int64)) for s in ("", "2")]
            (_, _, n1), (_, _, n2) = side
            common = _common(*side).astype(np.int64)
            comp1, comp2 = np.array(r["comps"], np.int64), np.array(r["comps2"], np.int64)
            linked = (DENOMINATOR * common >= NUMERATOR * (n1[:, None] + n2[None, :] - common)) & (comp1[:, None] != comp2[None, :])
            root: dict[int, int] = {}

            def find(x):
                while (y := root.get(x, x)) != x:
                    x = y
                return x
            out = []
            for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
                a, b = find(r["comps"][i]), find(r["comps2"][j])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((r["reps"][i], r["reps2"][j]))
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _block_links(docs: DataFrame, dense: DataFrame) -> DataFrame:
    """Links (a, b) between documents of different components that share a shingle of dense (token, rep, n, comp, k)."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = dense.groupBy("rep", "comp").agg(F.max_by("token", F.struct("k", "token")).alias("main"))
    # documents of one commonest shingle are dealt to blocks of about BLOCK_ROWS, however many partitions there are
    many = place.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).alias("parts"))
    place = place.join(many, "main").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts"))).drop("parts").checkpoint()
    sets = _chosen(docs, place.select(F.col("rep").alias("doc_id"))).mapInArrow(_sets, "rep bigint, set binary").dropDuplicates(["rep"]).join(place, "rep")
    blocks = sets.repartition(n, "main", "part").sortWithinPartitions("main", "part", "rep").select("main", "part", "rep", "comp", "set").mapInArrow(_cut, _BLOCK).checkpoint()
    where = blocks.select("block", F.explode("reps").alias("rep"))
    # a pair of blocks is of interest if the two share a shingle, and not all their documents are of one component
    shared = dense.join(where, "rep").groupBy("token", "block").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    other = shared.select("token", *(F.col(c).alias(c + "2") for c in ("block", "lo", "hi")))
    pairs = shared.join(other, "token").where((F.col("block") <= F.col("block2")) & (F.least("lo", "lo2") < F.greatest("hi", "hi2"))).select("block", "block2").distinct()
    right = blocks.select(*(F.col(c).alias(c + "2") for c in blocks.columns))
    return pairs.join(blocks, "block").join(right, "block2").repartition(n, "block", "block2").mapInArrow(_compare, "a bigint, b bigint")


def _chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs of the given ids (doc_id); beyond MAX_BROADCAST_IDS of them the join shuffles."""
    return docs.join(F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids, "doc_id", "left_semi")


def _segments(order_shared):
    """The shingles of each document, cut at the borders of the fragments."""
    def task(batches):
        order = order_shared.value
        for rows, data, offsets in B.blocks(batches, "text", TEXT_BYTES):
            row, h, firsts = shingles(data, offsets)
            frag = np.searchsorted(order["cuts"], order["loads"][_bucket(h)], "left")
            by = np.lexsort((frag, row))
            row, h, frag = row[by], h[by], frag[by]
            heads = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (frag[1:] != frag[:-1])])) if row.size else np.zeros(0, np.int64)
            ids = np.array(rows.column("doc_id").to_pylist(), np.int64)
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(ids[row[heads]], pa.int64()), "frag": pa.array(frag[heads], pa.int32()),
                "part": pa.ListArray.from_arrays(pa.array(np.append(heads, row.size), pa.int32()), pa.array(h.view(np.int64), pa.int64()))})
    return task


def _overlaps(docs: DataFrame, pairs: DataFrame, order) -> DataFrame:
    """pairs (a, b, na, nb) that reach the threshold, by the sum of the fragments' partial overlaps."""
    pairs = pairs.checkpoint()
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    parts = _chosen(docs, ids).mapInArrow(_segments(order), "id bigint, frag int, part array<bigint>") \
        .groupBy("id", "frag").agg(F.first("part").alias("part"))  # a repeated row repeats its parts
    split = pairs.withColumn("frag", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))))
    left = parts.select(F.col("id").alias("a"), "frag", F.col("part").alias("part_a"))
    right = parts.select(F.col("id").alias("b"), "frag", F.col("part").alias("part_b"))
    both = split.join(left, ["a", "frag"]).join(right, ["b", "frag"]) \
        .groupBy("a", "b", "na", "nb").agg(F.sum(F.size(F.array_intersect("part_a", "part_b"))).alias("common"))
    return both.where(DENOMINATOR * F.col("common") >= NUMERATOR * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _may_reach(c, na, nb):
    """Whether c shingles common to the smaller set's short prefix and the larger set's prefix leave the threshold possible:
    behind the prefix that ends first no more than the rest of that set can be common."""
    small, large, both = F.least(na, nb), F.greatest(na, nb), NUMERATOR + DENOMINATOR
    rest_small = F.floor((2 * NUMERATOR * small + both - 1) / F.lit(both)) - 1
    rest_large = F.floor((NUMERATOR * large + DENOMINATOR - 1) / F.lit(DENOMINATOR)) - 1
    return (DENOMINATOR * small >= NUMERATOR * large) & (both * (c + F.greatest(rest_small, rest_large)) >= NUMERATOR * (na + nb))


def _open(members: DataFrame) -> DataFrame:
    """(token, big, most, k) of the shingles whose k documents are of several components, big being the largest, with most
    of them."""
    return members.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("token") \
        .agg(F.max_by("comp", F.struct("n", "comp")).alias("big"), F.max("n").alias("most"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("k")).where("parts > 1").drop("parts")


def _cross(members: DataFrame) -> DataFrame:
    """A row (a, b, na, nb) for every shingle that two documents of different components share; a < b.

    The shingle must lie in the short prefix of the smaller one: a set and one that is no smaller overlap in 2t / (1 + t) of the
    smaller at least, so they share one of its first n - ceil(2t n / (1 + t)) + 1.  Only that side's rows are joined, so documents
    that have nothing but a common line in common, which comes late in their order, do not meet at all."""
    members = members.join(_open(members).select("token", "big"), "token")
    side = lambda s: [F.col(c).alias(c + s) for c in ("rep", "n", "comp", "short")]
    few = members.where("comp <> big").select("token", *side("1"))
    rest = members.select("token", (F.col("comp") == F.col("big")).alias("main"), *side("2"))
    fit = (F.col("comp1") != F.col("comp2")) & (F.col("main") | (F.col("rep1") < F.col("rep2"))) \
        & (DENOMINATOR * F.least("n1", "n2") >= NUMERATOR * F.greatest("n1", "n2"))
    pairs = few.where("short1").join(rest, "token").where(fit & (F.col("n1") <= F.col("n2"))) \
        .unionByName(few.join(rest.where("short2"), "token").where(fit & (F.col("n2") < F.col("n1"))))
    swap = F.col("rep1") > F.col("rep2")
    return pairs.select(F.least("rep1", "rep2").alias("a"), F.greatest("rep1", "rep2").alias("b"),
                        F.when(swap, F.col("n2")).otherwise(F.col("n1")).alias("na"), F.when(swap, F.col("n1")).otherwise(F.col("n2")).alias("nb"))


def link_components(docs: DataFrame) -> DataFrame:
    """A row per row of docs (doc_id, text): doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    survey = docs.mapInArrow(_survey, _SETS).checkpoint()
    sets = survey.where("chunk IS NULL").select("doc_id", "n", "sig")
    loads = np.zeros(1 << LOAD_BITS, np.int64)
    for r in survey.where("chunk IS NOT NULL").select("chunk", "loads").repartition("chunk").mapInArrow(_sum_loads, "chunk int, loads binary").collect():
        loads[r.chunk * CHUNK:(r.chunk + 1) * CHUNK] = np.frombuffer(r.loads, np.int64)  # 2**LOAD_BITS numbers in all
    order = spark.sparkContext.broadcast(global_order(loads))
    nodes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("sig", "n").agg(F.min("doc_id").alias("rep")).checkpoint()
    named = docs.where("doc_id IS NOT NULL")
    # prefix shingles of more than one set; pivot: the least set of the shingle, or of its salted group
    group = Window.partitionBy("token", "salt")
    shared = named.mapInArrow(_prefixes(order), "token bigint, sig bigint, salt smallint, split boolean, short boolean") \
        .withColumns({"pivot": F.min("sig").over(group), "top": F.max("sig").over(group)}) \
        .where("split OR pivot <> top").select("token", "sig", "pivot", "split", "short").distinct().transform(stored)
    met = shared.where("sig <> pivot").groupBy("sig", "pivot").agg(F.count(F.lit(1)).alias("c"))
    tops = shared.where("split").groupBy("token").agg(F.min("pivot").alias("top"))
    again = shared.where("split").select("token", "pivot").distinct().join(tops, "token").where("pivot <> top") \
        .groupBy(F.col("pivot").alias("sig"), F.col("top").alias("pivot")).agg(F.count(F.lit(1)).alias("c"))
    x, y = (nodes.select(F.col("sig").alias(s), F.col("rep").alias(r), F.col("n").alias(n)) for s, r, n in (("sig", "a", "na"), ("pivot", "b", "nb")))
    sizes = DENOMINATOR * F.least("na", "nb") >= NUMERATOR * F.greatest("na", "nb")
    # worth a look in the first round; what is left out here comes back in the second
    first = met.unionByName(again).join(x, "sig").join(y, "pivot").where(sizes & (F.col("c") * 16 >= F.col("na"))) \
        .groupBy("a", "na").agg(F.max_by(F.struct("b", "nb"), F.struct("c", "b")).alias("best")).select("a", "na", "best.*")
    links = _overlaps(named, first, order).checkpoint()
    # second round: sets of different components that share a prefix shingle
    near = components(links)
    at = nodes.join(near, F.col("rep") == F.col("id"), "left").select("sig", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    members = shared.select("token", "sig", "short").distinct().join(at, "sig").select("token", "rep", "n", "comp", "short")
    # a dense shingle is one of a large group of near copies: documents meet the others of it in blocks; pairs that share no
    # dense shingle have all that they share below
    dense = (F.col("k") > HOT) & (F.col("most") * DENSE >= F.col("k"))
    members = members.join(_open(members).select("token", "k", dense.alias("dense")), "token").transform(stored)
    second = _cross(members.where("NOT dense")).groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("c")) \
        .where(_may_reach(F.col("c"), F.col("na"), F.col("nb"))).select("a", "b", "na", "nb")
    links = links.unionByName(_block_links(named, members.where("dense")))
    links = links.unionByName(_overlaps(named, second, order)).checkpoint()
    final = nodes.join(components(links), F.col("rep") == F.col("id"), "left").select("sig", F.coalesce("component", "rep").alias("component_id"))
    some = F.coalesce((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.lit(False))
    linked = sets.where(some).join(final, "sig").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(sets.where(~some).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
