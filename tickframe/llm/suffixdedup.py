"""Suffix-array deduplication: removes bytes covered by a LENGTH-byte string that starts at another place too.

Induced sorting from sampled suffixes, spread over Spark.  Sampled suffixes start at the least hash of GRAM-byte strings in
every window, so two equal LENGTH-byte strings hold a sampled suffix at the same offset, and it starts with the same
GRAM bytes.  The pieces, in order:

1. Copies of a whole text are one text from the start.
2. Suffix tuples (gram, document, position, context hash) are shuffled; grams that occur once can't repeat.
3. Of every gram with different contexts, each different context (REACH bytes on either side) goes once to the shard of
   the gram, where Spark's spilling sort is the disk-backed queue that hands the suffixes over in suffix order; a
   gram in more than SPLIT contexts is dealt to two shards per half of the offsets (see ``_halves``).
4. The task walks the order, takes the common-prefix value of each neighbour pair, and induces the order of the suffixes
   that start 1, 2, ... REACH bytes earlier from the order before, by the byte in front; the common-prefix values are carried
   along.  A suffix with a neighbour of LENGTH common bytes repeats.  Suffixes that share no bytes in front drop out.

Defined results: null is the empty text; texts under LENGTH bytes keep everything; copies of a text of at least LENGTH
bytes lose everything, as do repeated rows; null ids get rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm import blocks as B
from tickframe.llm.shared import bounded, merged, stored
from tickframe.session import checkpoint_dir

LENGTH, GRAM = 400, 200
REACH = LENGTH - GRAM
SPLIT = 100_000
BATCH = 20_000


def _samples(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions of the sampled suffixes: in every LENGTH-byte string of a text the gram of least hash, the first of equals."""
    n = data.size
    if n < LENGTH:
        return np.zeros(0, np.int64)
    at = np.arange(n - GRAM + 1)
    h = B.slice_hash(B.prefix_sums(B.value_table(11)[data]), at, at + GRAM)
    return B.sampled(h, REACH + 1, np.arange(n) + LENGTH <= np.repeat(offsets[1:], np.diff(offsets)))


def _tuples(batches):
    """Suffix tuples: both halves of the gram's hash, id, position, bytes before and behind in reach, hash of the context."""
    for rows, data, offsets in B.blocks(batches, "text"):
        at = _samples(data, offsets)
        if not at.size:
            continue
        row = np.searchsorted(offsets, at, "right") - 1
        before = np.minimum(at - offsets[row], REACH)
        behind = np.minimum(offsets[row + 1] - at - GRAM, REACH)
        one, two = (B.prefix_sums(B.value_table(s)[data]) for s in (11, 12))
        ids = np.array(rows.column("id").to_pylist(), np.int64)
        context = B.mix(B.slice_hash(two, at - before, at + GRAM + behind) + before.astype(np.uint64))
        yield pa.RecordBatch.from_pydict({
            "k1": pa.array(B.slice_hash(one, at, at + GRAM).view(np.int64)), "k2": pa.array(B.slice_hash(two, at, at + GRAM).view(np.int64)),
            "id": pa.array(ids[row]), "at": pa.array(at - offsets[row]), "before": pa.array(before.astype(np.int16)),
            "behind": pa.array(behind.astype(np.int16)), "context": pa.array(context.view(np.int64))})


_TUPLES = "k1 bigint, k2 bigint, id bigint, at bigint, before smallint, behind smallint, context bigint"


def _contexts(batches):
    """The bytes around chosen suffixes: front is reversed, so that its first byte stands next to the gram."""
    for batch in batches:
        data, offsets = B.text_bytes(batch.column("text"))
        raw, out = data.tobytes(), {k: [] for k in ("k1", "k2", "context", "front", "back")}
        size = 0
        for lo, hi, picks in zip(offsets.tolist(), offsets[1:].tolist(), batch.column("picks").to_pylist()):
            for p in picks:
                a = lo + p["at"]
                out["front"].append(raw[max(lo, a - REACH):a][::-1])
                out["back"].append(raw[a + GRAM:min(hi, a + LENGTH)])
                for k in ("k1", "k2", "context"):
                    out[k].append(p[k])
                size += LENGTH
                if size >= 4 << 20:
                    yield _context_batch(out)
                    out, size = {k: [] for k in out}, 0
        if size:
            yield _context_batch(out)


def _context_batch(out):
    kinds = {"front": pa.binary(), "back": pa.binary()}
    return pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})


def _fixed(column: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in column], np.int64)
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in column), np.uint8).reshape(-1, width), size


def induce(group: np.ndarray, front: list[bytes], back: list[bytes], width: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) offset before the gram at which a suffix of LENGTH repeats in its group; greatest -1: none.

    Rows come sorted by group and back.  prefix[i] is the number of bytes behind the gram that rows i-1 and i have in
    common.  At offset o two suffixes repeat if they share o bytes in front and width - o behind: neighbours in the
    induced order share their front bytes, and share the bytes behind if no smaller prefix value lies between them.
    """
    n = len(group)
    least, greatest = np.full(n, width + 1), np.full(n, -1)
    (f, f_size), (b, b_size) = _fixed(front, width), _fixed(back, width)
    prefix = np.zeros(n, np.int64)
    if n > 1:
        differ = b[1:] != b[:-1]
        prefix[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        prefix[1:] = np.minimum(prefix[1:], np.minimum(b_size[1:], b_size[:-1]))
        prefix[1:][group[1:] != group[:-1]] = -1
    prefix[:1] = -1
    order, classes = np.arange(n), group.astype(np.int64)  # classes: rows that share group and front bytes, ascending in order
    for offset in range(width + 1):
        if offset:
            live = f_size[order] >= offset
            order, classes = order[live], classes[live]
            key = classes * 256 + f[order, offset - 1]
            by = np.argsort(key, kind="stable")
            order, key = order[by], key[by]
            new = np.concatenate([[True], key[1:] != key[:-1]]) if key.size else np.zeros(0, bool)
            classes = np.cumsum(new)
            alone = new & np.append(new[1:], True)
            order, classes = order[~alone], classes[~alone]
        if order.size < 2:
            break
        run = np.cumsum(prefix < width - offset)  # rows of one run share width - offset bytes behind
        same = (classes[1:] == classes[:-1]) & (run[order[1:]] == run[order[:-1]])
        if offset == width:  # nothing behind is needed, only the group, which the classes hold
            same = classes[1:] == classes[:-1]
        enough = b_size[order] >= width - offset
        same &= enough[1:] & enough[:-1]
        hit = order[np.append(same, False) | np.concatenate([[False], same])]
        least[hit] = np.minimum(least[hit], offset)
        greatest[hit] = np.maximum(greatest[hit], offset)
    return least, greatest


def _shard(batches):
    """Sorted contexts of a shard -> offsets at which they repeat, for runs of whole groups of about BATCH rows."""
    held = {k: [] for k in ("k1", "k2", "part", "context", "front", "back")}

    def flush(upto: int):
        cols = {k: v[:upto] for k, v in held.items()}
        for k in held:
            held[k] = held[k][upto:]
        keys = np.array([cols["k1"], cols["k2"], cols["part"]])
        group = np.cumsum(np.concatenate([[False], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
        least, greatest = induce(group, cols["front"], cols["back"])
        hit = np.flatnonzero(greatest >= 0)
        return pa.RecordBatch.from_pydict({k: pa.array([cols[k][i] for i in hit], pa.int64()) for k in ("k1", "k2", "context")}
                                          | {"least": pa.array(least[hit], pa.int64()), "greatest": pa.array(greatest[hit], pa.int64())})
    for b in batches:
        for k in held:
            held[k] += b.column(k).to_pylist()
        while len(held["k1"]) >= BATCH:
            k1, k2, part = held["k1"], held["k2"], held["part"]
            cut = len(k1) - 1
            while cut and (k1[cut], k2[cut], part[cut]) == (k1[cut - 1], k2[cut - 1], part[cut - 1]):
                cut -= 1
            if not cut:
                break  # one group alone so far
            yield flush(cut)
    if held["k1"]:
        yield flush(len(held["k1"]))


def _halves(contexts: DataFrame, hot: DataFrame) -> DataFrame:
    """Contexts of a hot gram twice: a repeat at an offset of at least half of REACH shares that many bytes in front, one at a smaller
    offset that many behind, so each half is dealt out by a hash of those bytes; part 0: not hot."""
    half = REACH // 2
    both = contexts.join(hot, ["k1", "k2"], "left")
    side = lambda c, seed: F.xxhash64(F.lit(seed), F.substring(c, 1, half)).bitwiseOR(F.lit(1))
    parts = F.when(F.col("hot"), F.array(side("front", 1), side("back", 2))).otherwise(F.array(F.lit(0).cast("long")))
    return both.withColumn("part", F.explode(parts)).drop("hot")


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For docs (id, text): spans (id, starts, ends) to remove, and the ids whose whole text goes (at least LENGTH bytes, with a copy)."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    long = docs.where(F.octet_length("text") >= LENGTH)
    texts = long.select("id", F.sha2("text", 256).alias("digest"))
    copies = texts.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    whole = texts.join(copies, "digest").select("id", (F.col("id") != F.col("first")).alias("other")).distinct().checkpoint()
    others = bounded(whole.where("other").select("id").checkpoint())
    unique = long.join(others, "id", "left_anti")
    tuples = unique.mapInArrow(_tuples, _TUPLES)
    again = tuples.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k1", "k2")
    tuples = stored(tuples.join(again, ["k1", "k2"], "left_semi"))
    kinds = tuples.groupBy("k1", "k2", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "at")).alias("one")).transform(stored)
    several = kinds.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    hot = several.where(F.col("kinds") > SPLIT).select("k1", "k2", F.lit(True).alias("hot"))
    picks = kinds.join(several.select("k1", "k2"), ["k1", "k2"], "left_semi").groupBy(F.col("one.id").alias("id")) \
        .agg(F.collect_list(F.struct("k1", "k2", "context", F.col("one.at").alias("at"))).alias("picks"))
    picked = unique.join(picks, "id")
    contexts = picked.select("text", "picks").mapInArrow(_contexts, "k1 bigint, k2 bigint, context bigint, front binary, back binary")
    sharded = _halves(contexts, hot)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    offsets = sharded.repartition(n, "k1", "k2", "part").sortWithinPartitions("k1", "k2", "part", "back") \
        .mapInArrow(_shard, "k1 bigint, k2 bigint, context bigint, least bigint, greatest bigint") \
        .groupBy("k1", "k2", "context").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    same = kinds.where("n > 1").select("k1", "k2", "context", F.lit(True).alias("same"))
    found = offsets.join(same, ["k1", "k2", "context"], "full")
    hits = tuples.join(found, ["k1", "k2", "context"])
    least = F.when(F.col("same"), F.greatest(F.lit(0), REACH - F.col("behind"))).otherwise(F.col("least"))
    greatest = F.when(F.col("same"), F.col("before")).otherwise(F.col("greatest"))
    spans = hits.select("id", (F.col("at") - greatest).cast("long").alias("start"), (F.col("at") - least + LENGTH).cast("long").alias("end")) \
        .groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    return spans, whole.select("id").distinct()


def _cut(keep_text: bool):
    def task(batches):
        for b in batches:
            names, out = [n for n in b.schema.names if n not in ("text", "starts", "ends", "whole")], []
            data, offsets = B.text_bytes(b.column("text"))
            raw = data.tobytes()
            for lo, hi, s, e, whole in zip(offsets.tolist(), offsets[1:].tolist(), b.column("starts").to_pylist(), b.column("ends").to_pylist(),
                                           b.column("whole").to_pylist()):
                spans = [[0, hi - lo]] if whole else merged(s, e) if s else []
                kept, at = [], lo
                for x, y in spans:
                    kept.append(raw[at:lo + x])
                    at = lo + y
                kept = b"".join(kept) + raw[at:hi]
                out.append((hi - lo, hi - lo - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            cols = {n: b.column(n) for n in names}
            for i, (n, t) in enumerate((("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()))):
                cols[n] = pa.array([x[i] for x in out], t)
            if keep_text:
                cols["text"] = pa.array([x[4].decode("utf-8", "ignore") for x in out], pa.string())
            yield pa.RecordBatch.from_pydict(cols)
    return task


def deduplicate(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """A row per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, with keep_text the text left
    (cut characters dropped)."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("no id"), "text")))
    spans, whole = repeats(docs.select("id", "text"))
    marks = spans.join(whole.withColumn("whole", F.lit(True)), "id", "full")
    rows = docs.join(marks, "id", "left").select("doc_id", "text", "starts", "ends", "whole")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", text string" if keep_text else "")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(_cut(keep_text), schema)
