"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fit: tasks count hashed n-grams (1 to 3 code points, letters lower-cased, other characters as blanks) per language
over every training text, Spark sums the counts, and the log-probability matrix (languages x BUCKETS) is broadcast;
its size is bounded by BUCKETS and MAX_LANGUAGES.  Predict: each block of texts is scored by gathering matrix rows.

Defined results: ``und`` with score 0 where the text is null, empty or has no letter; likewise every text when
nothing could be learned; equally likely languages resolve to the first by name; rows without a language are not
learned from; repeated rows each count and each get a result; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm import blocks as B
from tickframe.llm import codepoints as C

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 1000
UNKNOWN = "und"


def ngrams(data: np.ndarray, offsets: np.ndarray, classes: C.Classes):
    """Per order: (buckets, first n-gram of each row and one past the last); n-grams do not cross rows.
    Then whether each row has a letter."""
    at, cps = C.decode(data)
    rows = np.searchsorted(at, offsets)
    letter = classes.kinds(cps) == C.LETTER
    x = classes.folded(cps)
    seen = np.concatenate([[0], np.cumsum(letter)])
    out, h = [], np.zeros(x.size, np.uint32)
    for n in ORDERS:
        h = (h[:x.size - n + 1] * np.uint32(0x01000193)) ^ (x[n - 1:] * np.uint32(0x9E3779B1)) if x.size >= n else h[:0]
        bucket = ((h * np.uint32(0x85EBCA6B) + np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) >> np.uint32(17)).astype(np.int64)
        ends = np.maximum(rows[1:] - (n - 1), rows[:-1])
        out.append((bucket, rows[:-1], ends))
    return out, (seen[rows[1:]] - seen[rows[:-1]]) > 0


def _count_task(text: str, lang: str):
    def task(batches):
        classes, totals, texts = C.Classes(), {}, {}
        for rows, data, offsets in B.blocks(batches, text):
            grams, _ = ngrams(data, offsets, classes)
            langs = rows.column(rows.schema.get_field_index(lang)).to_pylist()
            for k, name in enumerate(langs):
                counts = totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                texts[name] = texts.get(name, 0) + 1
                row = np.concatenate([bucket[a[k]:b[k]] for bucket, a, b in grams])
                if row.size < BUCKETS // 8:
                    np.add.at(counts, row, 1)
                else:
                    counts += np.bincount(row, minlength=BUCKETS)
        for name, counts in totals.items():
            used = np.flatnonzero(counts)
            # bucket -1 carries the number of texts
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * (used.size + 1), pa.string()), "bucket": pa.array(np.append(used, -1), pa.int64()),
                "n": pa.array(np.append(counts[used], texts[name]), pa.int64())})
    return task


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, log-probabilities by language and bucket) from all rows with a language."""
    counted = train.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang")) \
        .mapInArrow(_count_task("text", "lang"), "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counted.toPandas()
    langs = sorted(got["lang"].unique())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"{len(langs)} languages; the broadcast matrix holds {MAX_LANGUAGES}")
    number = {x: i for i, x in enumerate(langs)}
    row = got["lang"].map(number).to_numpy(np.int64) if langs else np.zeros(0, np.int64)
    bucket, n = got["bucket"].to_numpy(np.int64), got["n"].to_numpy(np.float64)
    counts, texts = np.full((len(langs), BUCKETS), 0.5), np.zeros(len(langs))
    grams = bucket >= 0
    counts[row[grams], bucket[grams]] += n[grams]
    texts[row[~grams]] = n[~grams]
    return langs, np.log(texts / max(texts.sum(), 1)), np.log(counts / counts.sum(axis=1, keepdims=True))


def _score_task(model, text: str):
    def task(batches):
        langs, prior, logp = model.value
        classes = C.Classes()
        for rows, data, offsets in B.blocks(batches, text):
            grams, letters = ngrams(data, offsets, classes)
            total = np.repeat(prior[:, None], rows.num_rows, axis=1)
            for bucket, a, b in grams:
                for k in range(len(langs)):
                    sums = np.concatenate([[0.0], np.cumsum(logp[k][bucket])])
                    total[k] += sums[b] - sums[a]
            if langs:
                best = total.argmax(axis=0)
                score = 1.0 / np.exp(total - total.max(axis=0)).sum(axis=0)
            known = letters & bool(langs)
            name = [langs[best[i]] if known[i] else UNKNOWN for i in range(rows.num_rows)]
            cols = {c: rows.column(c) for c in rows.schema.names if c != text}
            cols["lang_pred"] = pa.array(name, pa.string())
            cols["score"] = pa.array(np.where(known, score, 0.0) if langs else np.zeros(rows.num_rows), pa.float64())
            yield pa.RecordBatch.from_pydict(cols)
    return task


def predict(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """docs without the text, plus lang_pred and score (the posterior of the predicted language)."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in (text, "lang_pred", "score")]
    docs = docs.drop("lang_pred", "score")
    return docs.mapInArrow(_score_task(docs.sparkSession.sparkContext.broadcast(model), text),
                           ", ".join([*kept, "lang_pred string", "score double"]))
