"""Filter interaction audit: what each of five text filters removes, alone and behind every order of the others.

Incremental retraction streaming.  All files of the table are read as available-now micro-batches.  Filters A to D are
functions of a row's text; E (an exact copy of a text with a smaller id) depends on rows that may come later, so it
is kept as keyed state: per text digest the least id so far and what rows of that id were counted as.  When a smaller id
arrives, the rows counted without E are retracted from the counters of their part and counted again with E.

Per micro-batch: masks in native expressions (the text goes no further), labels joined by id, then each task combines its
rows: of a digest only the rows of the task's least id go to the state, all others are copies already and leave as plain
counts.  So a text that a third of all rows share sends one row per task to the state, which holds a least id and a count per
part for it.  A state key stands for about DIGESTS digests (their number of keys grows with the table's rows), since a key costs
some milliseconds a micro-batch whatever it holds.  Every micro-batch writes its summed changes (part, mask, labels: a few
rows) under its own epoch, which a repeated epoch overwrites; the counters are the sum of all changes.  The state store is
the session's (set RocksDB there for states beyond the executors' memory) and commits below the checkpoint folder.

From the counters (32 masks per part) every number of every order follows: filters before a step are a mask of bits.

Defined results: null text is the empty text and counts as identical to it; null part is the empty string; rows without an id
are in all counts but never copies and make none; rows of one id and text are one document repeated, none a copy of the other;
of repeated label rows of an id, a 1 wins; labels of no document count nowhere.  An empty table has no parts, hence no rows.
Only the named columns of the inputs are read, so further columns may have any names.
"""

from __future__ import annotations

import itertools
import json
import random
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tickframe.llm.shared import stored
from tickframe.session import checkpoint_dir

FILTERS = "ABCDE"
COPY = 16  # bit of filter E
MICRO_BATCHES, DIGESTS = 4, 256
_HELD = 100_000
_WORD_GAP = r"[\x20\x09-\x0D]+"


def text_mask(text: Column) -> Column:
    """Bits 1, 2, 4, 8 for failing A (under 100 words), B (distinct words under 80 %), C (capitals over 10 %), D (a sign)."""
    words = F.array_remove(F.split(text, _WORD_GAP), "")
    n, distinct, chars = F.size(words), F.size(F.array_distinct(words)), F.length(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    bit = lambda failed, b: F.when(failed, F.lit(b)).otherwise(F.lit(0))
    return bit(n < 100, 1) + bit(100 * distinct < 80 * n, 2) + bit(100 * capitals > 10 * chars, 4) + bit(text.rlike("[#$%&*|]"), 8)


def marks(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    """doc_id, part, digest, mask (A to D), good, toxic of every row; labels has a row per doc_id at most."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), body.alias("_text")) \
        .select("doc_id", "part", F.sha2("_text", 256).alias("digest"), text_mask(F.col("_text")).alias("mask"))
    return rows.join(labels, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def label_flags(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias("good" if c == "quality" else c)
    return labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(flag("quality"), flag("toxic"))


_COMBINED = "key bigint, digest string, doc_id bigint, part string, mask int, good int, toxic int, n bigint"
_COMBINED_ARROW = pa.schema([("key", pa.int64()), ("digest", pa.string()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("good", pa.int32()),
                             ("toxic", pa.int32()), ("n", pa.int64())])


def _combine(keys: int):
    """Rows of a task -> per digest the rows of its least id, by part; all other rows as counts that need no state."""
    def task(batches):
        least: dict[str, list] = {}
        counts: dict[tuple, int] = {}

        def count(part, mask, good, toxic, n=1):
            key = (part, mask, good, toxic)
            counts[key] = counts.get(key, 0) + n

        def emit():
            rows = [(int(digest[:15], 16) % keys, digest, i, part, mask, good, toxic, n)
                    for digest, (i, mask, good, toxic, parts) in least.items() for part, n in parts.items()]
            # counts have a negative key of their own: they pass the stateful step without a state, spread over its tasks
            rows += [(-1 - random.getrandbits(40), None, None, *key, n) for key, n in counts.items()]
            least.clear()
            counts.clear()
            for lo in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[lo:lo + 10_000]), _COMBINED_ARROW)], schema=_COMBINED_ARROW)
        for b in batches:
            for i, part, digest, mask, good, toxic in zip(*(b.column(c).to_pylist() for c in ("doc_id", "part", "digest", "mask", "good", "toxic"))):
                held = least.get(digest)
                if i is None:
                    count(part, mask, good, toxic)
                elif held is None:
                    least[digest] = [i, mask, good, toxic, {part: 1}]
                elif i == held[0]:
                    held[4][part] = held[4].get(part, 0) + 1
                elif i > held[0]:
                    count(part, mask | COPY, good, toxic)
                else:
                    for p, n in held[4].items():
                        count(p, mask | COPY, held[2], held[3], n)
                    least[digest] = [i, mask, good, toxic, {part: 1}]
            if len(least) >= _HELD:
                yield from emit()
        yield from emit()
    return task


_CHANGES = "part string, mask int, good int, toxic int, n bigint"
_STATE = "texts string"


def arrived(texts: dict, digest: str, i: int, part: str, mask: int, good: int, toxic: int, n: int):
    """Changes of the counters as n rows of one id and digest arrive; texts has each digest's least id and what it was counted as."""
    held = texts.get(digest)
    if held is not None and i > held[0]:
        yield part, mask | COPY, good, toxic, n
        return
    if held is not None and i < held[0]:
        for p, m in held[4].items():  # retract, count again as copies
            yield p, held[1], held[2], held[3], -m
            yield p, held[1] | COPY, held[2], held[3], m
        held = None
    if held is None:
        held = texts[digest] = [i, mask, good, toxic, {}]
    held[4][part] = held[4].get(part, 0) + n
    yield part, mask, good, toxic, n


def _update(key, frames, state):
    """Changes of the counters, summed, when rows of the digests of one key arrive."""
    import pandas as pd

    if key[0] < 0:
        for f in frames:
            yield f[["part", "mask", "good", "toxic", "n"]]
        return
    texts, out = json.loads(state.get[0]) if state.exists else {}, {}
    for f in frames:
        f["doc_id"] = f["doc_id"].astype("int64")
        for row in zip(*(f[c].tolist() for c in ("digest", "doc_id", "part", "mask", "good", "toxic", "n"))):
            for *cell, n in arrived(texts, *row):
                out[tuple(cell)] = out.get(tuple(cell), 0) + n
    state.update((json.dumps(texts, separators=(",", ":")),))
    yield pd.DataFrame([(*cell, n) for cell, n in out.items() if n or not cell[1] & COPY], columns=["part", "mask", "good", "toxic", "n"])


def counters(spark: SparkSession, path: str, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
             micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """(part, mask, good, toxic, n): how many rows of the Parquet table at path fail exactly the filters of mask."""
    table, path = spark.read.parquet(path), path.rstrip("/")
    per_batch = max(1, -(-len(table.inputFiles()) // micro_batches))
    folder = f"{checkpoint_dir(spark).rstrip('/')}/filter-audit-{uuid.uuid4().hex}"
    known = stored(label_flags(labels))
    files = f"{path[:-1]}[{path[-1]}]"  # as a pattern, so that a table of one file is streamed like a folder
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", per_batch).parquet(files)
    changes = marks(stream, known, doc_id, text, part).select("doc_id", "part", "digest", "mask", "good", "toxic") \
        .mapInArrow(_combine(max(1, -(-table.count() // DIGESTS))), _COMBINED).groupBy("key").applyInPandasWithState(_update, _CHANGES, _STATE, "append", GroupStateTimeout.NoTimeout)

    def land(batch: DataFrame, epoch: int) -> None:
        batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{folder}/changes/epoch={epoch}")
    query = changes.writeStream.foreachBatch(land).outputMode("append").option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.lastProgress is None:  # no file, so no micro-batch and no folder of changes
        return spark.createDataFrame([], _CHANGES)
    return spark.read.schema(_CHANGES).parquet(f"{folder}/changes").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, bits of the filters before it, its bit) for every permutation and step."""
    bits = {f: 1 << k for k, f in enumerate(filters)}
    return [("".join(p), k + 1, sum(bits[f] for f in p[:k]), bits[p[k]]) for p in itertools.permutations(filters) for k in range(len(p))]


def interactions(counts: DataFrame) -> DataFrame:
    """A row per part, order and step from the counters; 600 rows per part whatever the size of the table."""
    spark = counts.sparkSession
    only = {"n": F.lit(True), "good": F.col("good") == 1, "toxic": F.col("toxic") == 1}
    cells = [F.sum(F.when((F.col("mask") == m) & only[v], F.col("n")).otherwise(0)).alias(f"{v}_{m}") for v in only for m in range(2 * COPY)]
    wide = counts.groupBy("part").agg(*cells)
    table = wide.select("part", *(F.array(*(f"{v}_{m}" for m in range(2 * COPY))).alias(v) for v in only))
    steps = spark.createDataFrame([(k, *o) for k, o in enumerate(orders())], "k int, filter_order string, step int, before int, bit int")
    rows = table.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(len(orders()) - 1)))).join(F.broadcast(steps), "k")  # 600 fixed rows

    def total(values: str, chosen) -> Column:
        return F.aggregate(F.transform(values, lambda x, m: F.when(chosen(m), x).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x)
    fails = lambda m: m.bitwiseAND(F.col("bit")) != 0
    passed = lambda m: m.bitwiseAND(F.col("before")) == 0
    here = lambda m: fails(m) & passed(m)
    share = F.aggregate(F.transform("n", lambda x, m: F.when(fails(m), (x * 120 / F.bit_count(m)).cast("long")).otherwise(F.lit(0).cast("long"))),
                        F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select("part", "filter_order", "step", total("n", lambda m: passed(m) & ~fails(m)).alias("kept"), total("n", here).alias("removed"),
                       total("n", lambda m: fails(m) & ~passed(m)).alias("redundant"), total("n", lambda m: m == F.col("bit")).alias("unique_fails"),
                       total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"), share.alias("shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
          micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A set of failed filters is removed by one of them in every order, by each in an equal share of the 120: shapley is the sum of
    120 / (filters failed) over the rows that fail the step's filter."""
    return interactions(counters(spark, path, labels, doc_id, text, part, micro_batches))
