"""Target-distribution importance resampling over hashed word n-grams.

Words: A-Z lower-cased, then runs of digits, letters a-z and non-ASCII characters.  Features are all runs of one and of
two consecutive words (joined by one blank), repeats counted; a feature's bucket is the CRC-32 of its bytes modulo ``buckets``.
A task numbers the distinct words of a block of texts, takes the distinct features as numbers and pairs of numbers, and
computes their CRCs in length buckets: features of one length form a two-dimensional uint8 array, one row per feature, and all
CRCs of the array are updated together, column by column; the results are scattered back to the places of the features.
A length that fewer than FEW features share has no matrix worth the steps (one word of a megabyte would take a million): those
features take zlib's CRC, the same number.

1. Bucket counts of the corpus and of the target: per task at most ``buckets`` rows, then a partial-aggregated sum.
2. Gains of the buckets on the driver (``buckets`` numbers), the corpus streamed past them again for the weights; scores and
   lengths are written as a narrow table.
3. The draw: rows of enough words are dealt by range of (score descending, id), sorted and checkpointed; a row's rank is
   its place in its partition plus the sizes of the partitions before it, so no task sees more than its own range.

Defined results: null and empty texts have no words, no features and weight 0; they still have a score.  Rows without an id
count in the corpus and get features and a weight, but no score and no rank, and not in N.  Repeated ids are rows of their
own: same h, one rank each, ties in any order.  An empty corpus gives no rows; an empty target has T = t = 0.  Only the columns
of the result are returned, whatever columns the inputs have.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm import blocks as B
from tickframe.llm.shared import stored

BUCKETS, LEAST_WORDS, SHARE, SEED = 10_000, 20, 25, 7
_POLYNOMIAL = 0xEDB88320  # fixed value: the reflected CRC-32 polynomial
_MATRIX_BYTES, _BLOCK_BYTES = 1 << 20, 4 << 20
FEW = 8


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(_POLYNOMIAL), t >> 1).astype(np.uint32)
    return t


_TABLE = _byte_table()


def crc_matrix(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a uint8 matrix, all rows advanced together by one column at a time."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.asfortranarray(matrix).T:
        crc = _TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def crc_of_slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, starts2: np.ndarray | None = None, lengths2: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of slices of data, or of pairs of slices joined by a blank, in length-bucketed matrices."""
    total = lengths if lengths2 is None else lengths + 1 + lengths2
    out = np.empty(starts.size, np.uint32)
    order = np.argsort(total, kind="stable")
    sizes, firsts = np.unique(total[order], return_index=True)
    for size, lo, hi in zip(sizes.tolist(), firsts.tolist(), [*firsts[1:].tolist(), order.size]):
        if hi - lo < FEW:
            for k in order[lo:hi].tolist():
                crc = zlib.crc32(data[starts[k]:starts[k] + lengths[k]])
                out[k] = crc if lengths2 is None else zlib.crc32(data[starts2[k]:starts2[k] + lengths2[k]], zlib.crc32(b" ", crc))
            continue
        step = max(1, _MATRIX_BYTES // max(size, 1))
        for a in range(lo, hi, step):
            rows = order[a:min(hi, a + step)]
            place = np.arange(size)[None, :]
            if lengths2 is None:
                matrix = data[starts[rows][:, None] + place]
            else:
                cut = lengths[rows][:, None]
                at = np.where(place < cut, starts[rows][:, None] + place, starts2[rows][:, None] + place - cut - 1)
                at[np.arange(rows.size), lengths[rows]] = 0
                matrix = data[at]
                matrix[np.arange(rows.size), lengths[rows]] = 0x20
            out[rows] = crc_matrix(matrix)
    return out


def _numbered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word, place of the first word with each number): equal bytes, equal number.

    Words of one length are compared as whole rows of a matrix, so numbers never rest on a hash."""
    number, firsts, known = np.empty(starts.size, np.int64), [], 0
    order = np.argsort(lengths, kind="stable")
    sizes, begins = np.unique(lengths[order], return_index=True)
    for size, lo, hi in zip(sizes.tolist(), begins.tolist(), [*begins[1:].tolist(), order.size]):
        rows = order[lo:hi]
        wide = -(-size // 8) * 8
        matrix = np.zeros((rows.size, wide), np.uint8)
        step = max(1, _MATRIX_BYTES // size)
        for a in range(0, rows.size, step):
            matrix[a:a + step, :size] = data[starts[rows[a:a + step]][:, None] + np.arange(size)[None, :]]
        keys = matrix.view(np.uint64).ravel() if wide == 8 else matrix.view(np.dtype((np.void, wide))).ravel()
        _, first, back = np.unique(keys, return_index=True, return_inverse=True)
        number[rows] = back.ravel() + known
        firsts.append(rows[first])
        known += first.size
    return number, np.concatenate(firsts) if firsts else np.zeros(0, np.int64)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Features:
    """Distinct features of one block of texts, with their buckets, and every occurrence as a number of one of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, buckets: int):
        low = _LOWER[data]
        starts, ends, self.firsts = B.slices(B.ALNUM_SPLIT[low], offsets)  # after lower-casing
        lengths = ends - starts
        number, place = _numbered(low, starts, lengths)
        follows = np.ones(number.size, bool)  # a word before it in the same text
        heads = self.firsts[:-1]
        follows[heads[heads < number.size]] = False
        self.second = np.flatnonzero(follows)
        pairs, self.pair = np.unique(number[self.second - 1] * max(place.size, 1) + number[self.second], return_inverse=True)
        left, right = place[pairs // max(place.size, 1)], place[pairs % max(place.size, 1)]
        self.word = number
        self.word_bucket = (crc_of_slices(low, starts[place], lengths[place]) % np.uint32(buckets)).astype(np.int64)
        self.pair_bucket = (crc_of_slices(low, starts[left], lengths[left], starts[right], lengths[right]) % np.uint32(buckets)).astype(np.int64)

    def counts(self, buckets: int) -> np.ndarray:
        out = np.bincount(self.word_bucket, np.bincount(self.word, minlength=self.word_bucket.size), buckets)
        return (out + np.bincount(self.pair_bucket, np.bincount(self.pair, minlength=self.pair_bucket.size), buckets)).astype(np.int64)

    def sums(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, features, summed gains) of each text."""
        words = np.diff(self.firsts)
        run = np.zeros(self.word.size + 1, np.int64)
        both = gains[self.word_bucket][self.word] if self.word.size else np.zeros(0, np.int64)
        both[self.second] += gains[self.pair_bucket][self.pair] if self.second.size else np.zeros(0, np.int64)
        np.cumsum(both, out=run[1:])
        return words, np.maximum(2 * words - 1, 0), run[self.firsts[1:]] - run[self.firsts[:-1]]


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) for every bucket that occurs in the texts: all features of all rows."""
    def task(batches):
        total = np.zeros(buckets, np.int64)
        for _, data, offsets in B.blocks(batches, "text", _BLOCK_BYTES):
            total += Features(data, offsets, buckets).counts(buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(hit, pa.int64()), "n": pa.array(total[hit], pa.int64())})
    return texts.select(F.col(text).alias("text")).mapInArrow(task, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.float64)
    for r in counts.collect():  # a row per bucket
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket."""
    m = source.size
    return np.floor(1000.0 * np.log((target + 1.0) * (source.sum() + m) / ((source + 1.0) * (target.sum() + m)))).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight of every row: weight is the floored mean of the gains of its features."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def task(batches):
        for rows, data, offsets in B.blocks(batches, "text", _BLOCK_BYTES):
            found = Features(data, offsets, shared.value.size)
            words, n, total = found.sums(shared.value)
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(x, pa.int64()) for x in (words, n, np.floor_divide(total, np.maximum(n, 1))))],
                                             names=["doc_id", "n_words", "n_features", "weight"])
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(task, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))), h the first 8 hex digits of sha256(seed:doc_id); null without an id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, score: str = "score", tie: str = "doc_id") -> DataFrame:
    """rows with rank 1, 2, 3 ... by score (highest first) and tie (least first), without a task that sees them all.

    Equal rows are told apart by a column _row that the caller provides, so that a range border can fall between them."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(score).desc(), F.col(tie), F.col("_row")]
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint()
    placed = placed.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    before, offsets = 0, []
    for r in sorted(placed.groupBy("_part").count().collect()):  # a row per partition
        offsets.append((r[0], before))
        before += r[1]
    if not offsets:
        return placed.withColumn("rank", F.lit(None).cast("long")).drop("_part", "_place")
    starts = rows.sparkSession.createDataFrame(offsets, "_part int, _before bigint")
    return placed.join(F.broadcast(starts), "_part").withColumn("rank", F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS,
             least_words: int = LEAST_WORDS, share: int = SHARE, seed: int = SEED) -> DataFrame:
    """A row per row of docs: doc_id, n_features, weight, score, rank (null if not drawn).

    Of the N rows with an id and at least least_words words, floor(share N / 100) are drawn by Gumbel top-k."""
    gain = gains(_dense(bucket_counts(docs, text, buckets), buckets), _dense(bucket_counts(target, target_text, buckets), buckets))
    scored = stored(weighted(docs, gain, doc_id, text).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
                    .withColumn("_row", F.monotonically_increasing_id()))
    can = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    inside = scored.where(can)
    drawn = share * inside.count() // 100
    first = ranked(inside).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return first.unionByName(scored.where(~can).withColumn("rank", F.lit(None).cast("long"))).select("doc_id", "n_features", "weight", "score", "rank")
