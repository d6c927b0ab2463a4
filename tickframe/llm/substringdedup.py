"""Substring deduplication: removes words inside a WINDOW-word sequence that starts in a document of smaller id too.

Suffix automata of reference shards, documents streamed past them for matching statistics.  The references are the
documents themselves and have no size bound, so the automata are not broadcast: sampled word grams (the least hash of GRAM words in
every window) deal both the references and the documents that may match them to the same shard.  Equal windows hold the same gram at
the same place, so a shard sees all partners.

1. Copies of a whole text are removed at once, but for that of the least id.
2. Grams that occur in one document alone can't match; the others' places are kept.
3. Equal contexts of a gram (REACH words on either side) match from their second document on, without further work.
4. Every other context goes once, under its least id, to the shard of its gram.  There the contexts stream by in order of
   id: each gets its matching statistics from the automaton of the smaller documents' contexts and is then added to it.
   A gram in more than SPLIT contexts is dealt by whole windows instead (``_deal``), so that no shard grows with the corpus.

Defined results: null is the empty text; fewer than WINDOW words keep everything; rows without an id count as larger
than all ids (which lie below NULL_IDS) and none smaller than another; rows of the same id are not smaller than one another; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm import blocks as B
from tickframe.llm.automaton import SuffixAutomaton
from tickframe.llm.shared import bounded, merged, stored
from tickframe.session import checkpoint_dir

WINDOW, GRAM = 13, 5
REACH = WINDOW - GRAM
SPLIT = 20_000
NO_ID = (1 << 63) - 1
NULL_IDS = NO_ID - (1 << 61)  # ids of documents lie below; rows without one get keys above, and all rank as this value


def _words(data: np.ndarray, offsets: np.ndarray):
    return B.slices(B.SPACE_SPLIT[data], offsets)


def _tuples(batches):
    """Places of sampled grams: gram hash, id, word number, words in reach before and behind, hash of the context."""
    for rows, data, offsets in B.blocks(batches, "text"):
        starts, ends, firsts = _words(data, offsets)
        if starts.size < WINDOW:
            continue
        sums = B.prefix_sums(B.slice_hash(B.prefix_sums(B.value_table(21)[data]), starts, ends))
        at = np.arange(starts.size - GRAM + 1)
        row = np.searchsorted(firsts, np.arange(starts.size), "right") - 1
        last = firsts[row + 1]
        valid = np.arange(starts.size) + WINDOW <= last
        h = B.slice_hash(sums, at, at + GRAM)
        at = B.sampled(h, REACH + 1, valid)
        if not at.size:
            continue
        before, behind = np.minimum(at - firsts[row[at]], REACH), np.minimum(last[at] - at - GRAM, REACH)
        context = B.mix(B.slice_hash(sums, at - before, at + GRAM + behind) + before.astype(np.uint64))
        ids = np.array(rows.column("id").to_pylist(), np.int64)
        yield pa.RecordBatch.from_pydict({
            "gram": pa.array(h[at].view(np.int64)), "context": pa.array(context.view(np.int64)), "id": pa.array(ids[row[at]]),
            "at": pa.array((at - firsts[row[at]]).astype(np.int32)), "before": pa.array(before.astype(np.int16)), "behind": pa.array(behind.astype(np.int16))})


_TUPLES = "gram bigint, context bigint, id bigint, at int, before smallint, behind smallint"


def _contexts(batches):
    """The words around chosen grams, one blank between them."""
    for rows, data, offsets in B.blocks(batches, "text"):
        starts, ends, firsts = _words(data, offsets)
        raw, out, starts, ends = data.tobytes(), {k: [] for k in ("gram", "context", "id", "before", "words")}, starts.tolist(), ends.tolist()
        for k, (who, picks) in enumerate(zip(rows.column("id").to_pylist(), rows.column("picks").to_pylist())):
            lo, hi = int(firsts[k]), int(firsts[k + 1])
            for p in picks:
                a = max(lo, lo + p["at"] - REACH)
                out["words"].append(b" ".join([raw[starts[i]:ends[i]] for i in range(a, min(hi, lo + p["at"] + GRAM + REACH))]))
                out["before"].append(lo + p["at"] - a)
                out["gram"].append(p["gram"])
                out["context"].append(p["context"])
                out["id"].append(who)
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "words" else pa.int64()) for k, v in out.items()})


_CONTEXTS = "gram bigint, context bigint, id bigint, before bigint, words binary"


def _deal(batches):
    """Contexts with their shard key; those of hot grams once per window, keyed by the window's hash."""
    for b in batches:
        out = {k: [] for k in ("gram", "part", "context", "id", "before", "words")}
        for r in b.to_pylist():
            words, before = r["words"].split(b" "), r["before"]
            pieces = [(0, r["words"], before)]
            if r["hot"]:
                pieces = []
                for a in range(len(words) - WINDOW + 1):
                    text = b" ".join(words[a:a + WINDOW])
                    pieces.append((int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True) | 1, text, before - a))
            for part, text, front in pieces:
                for k, v in (("gram", r["gram"]), ("part", part), ("context", r["context"]), ("id", r["id"]), ("before", front), ("words", text)):
                    out[k].append(v)
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "words" else pa.int64()) for k, v in out.items()})


def _shard(batches):
    """Contexts sorted by shard key and id -> least and greatest number of words before the gram at which a window of a smaller
    document starts."""
    key = who = automaton = None
    waiting: list = []
    for b in batches:
        out = {k: [] for k in ("gram", "context", "least", "greatest")}
        for gram, part, context, i, before, text in zip(*(b.column(c).to_pylist() for c in ("gram", "part", "context", "id", "before", "words"))):
            i = min(i, NULL_IDS)  # rows without an id are not smaller than each other
            if key != (gram, part):
                key, who, automaton, waiting = (gram, part), i, SuffixAutomaton(), []
            elif who != i:  # the contexts of smaller ids are references now
                for w in waiting:
                    automaton.add(w)
                who, waiting = i, []
            words = text.split(b" ")
            found = [before - (at - WINDOW) for at, (_, size) in enumerate(automaton.statistics(words), 1) if size >= WINDOW]
            if found:
                for k, v in (("gram", gram), ("context", context), ("least", min(found)), ("greatest", max(found))):
                    out[k].append(v)
            waiting.append(words)
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For docs (id, text): word spans (id, starts, ends) to remove, and the ids of which the whole text has a copy of smaller id."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    place = F.least("id", F.lit(NULL_IDS))  # in the order of ids
    texts = docs.where(F.octet_length("text") >= 2 * WINDOW - 1).select("id", place.alias("place"), F.sha2("text", 256).alias("digest"))
    firsts = texts.groupBy("digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    whole = texts.join(firsts, "digest").where("place <> first").select("id").distinct().checkpoint()
    unique = docs.join(bounded(whole), "id", "left_anti")
    tuples = unique.mapInArrow(_tuples, _TUPLES)
    again = tuples.groupBy("gram").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("gram")
    tuples = stored(tuples.join(again, "gram", "left_semi"))
    kinds = tuples.groupBy("gram", "context").agg(F.min(F.struct("id", "at")).alias("one")).transform(stored)
    several = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    picks = kinds.join(several, "gram").groupBy(F.col("one.id").alias("id")) \
        .agg(F.collect_list(F.struct("gram", "context", F.col("one.at").alias("at"))).alias("picks"))
    contexts = unique.join(picks, "id").select("id", "text", "picks").mapInArrow(_contexts, _CONTEXTS)
    hot = several.where(F.col("kinds") > SPLIT).select("gram", F.lit(True).alias("hot"))
    dealt = contexts.join(hot, "gram", "left").mapInArrow(_deal, "gram bigint, part bigint, context bigint, id bigint, before bigint, words binary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = dealt.repartition(n, "gram", "part").sortWithinPartitions("gram", "part", "id") \
        .mapInArrow(_shard, "gram bigint, context bigint, least bigint, greatest bigint") \
        .groupBy("gram", "context").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    first = kinds.select("gram", "context", F.least("one.id", F.lit(NULL_IDS)).alias("first")).join(found, ["gram", "context"], "left")
    hits = tuples.join(first, ["gram", "context"]).withColumn("later", place > F.col("first"))
    least = F.when(F.col("later"), F.greatest(F.lit(0), REACH - F.col("behind"))).otherwise(F.col("least"))
    greatest = F.when(F.col("later"), F.col("before")).otherwise(F.col("greatest"))
    spans = hits.where("later OR least IS NOT NULL").select("id", (F.col("at") - greatest).cast("long").alias("start"), (F.col("at") - least + WINDOW).cast("long").alias("end")) \
        .groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    return spans, whole


def _cut(keep_text: bool):
    def task(batches):
        for rows, data, offsets in B.blocks(batches, "text"):
            starts, ends, firsts = _words(data, offsets)
            raw, starts, ends, out = data.tobytes(), starts.tolist(), ends.tolist(), []
            for k, (s, e, whole) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("starts", "ends", "whole")))):
                lo, hi = int(firsts[k]), int(firsts[k + 1])
                spans = ([[0, hi - lo]] if hi - lo >= WINDOW else []) if whole else merged(s, e) if s else []
                words, at = [], lo
                for x, y in spans + [[hi - lo, hi - lo]]:
                    words += [raw[starts[i]:ends[i]] for i in range(at, lo + x)]
                    at = lo + y
                kept = b" ".join(words)
                out.append((hi - lo, sum(y - x for x, y in spans), hashlib.sha256(kept).hexdigest(), kept))
            cols = {"doc_id": rows.column("doc_id")}
            for i, (n, t) in enumerate((("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()))):
                cols[n] = pa.array([x[i] for x in out], t)
            if keep_text:
                cols["text"] = pa.array([x[3].decode() for x in out], pa.string())
            yield pa.RecordBatch.from_pydict(cols)
    return task


def deduplicate(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """A row per row of docs (doc_id, text): doc_id, n_words, n_removed, kept_sha256, with keep_text the words left as text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID) - F.pmod(F.xxhash64("text"), F.lit(1 << 61))))
    spans, whole = repeats(docs.select("id", "text"))
    marks = spans.join(whole.withColumn("whole", F.lit(True)), "id", "full")
    rows = docs.join(marks, "id", "left").select("doc_id", "text", "starts", "ends", "whole")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", text string" if keep_text else "")
    return rows.mapInArrow(_cut(keep_text), schema)
