"""Toxicity: bags of subwords, embedded, averaged and fed to a linear softmax; embeddings and weights are trained jointly.

Training cuts a text into windows of WINDOW words, scoring into windows of SCORE_WINDOW, so a few toxic words weigh the
same in a short and in a very long text.  A word is a run of letters, digits and the SIGNS that stand before one of them, with at
least one letter.  A window's features are its words and their character 3- to 5-grams (word edges marked), hashed to BUCKETS rows of
the embedding; misspellings share most of their n-grams with the words that were seen.  A document's score comes
from its most toxic window.  The softmax is linear in the averaged embeddings, so for scoring every bucket reduces to
one number (embedding times weight difference) and whole texts are scored by one gather and one mean per window.

Fit: on a bounded sample of labelled documents, MAX_POSITIVE and MAX_NEGATIVE documents by least hash of doc_id, of those
that have a text with a letter; of a text over MAX_TRAIN_BYTES, pieces from hash-chosen places all over it.  A toxic document tells only that some window is toxic: the first rounds count all its
windows as toxic, later ones those that the model finds toxic, or its most toxic one.

Defined results: null or empty texts and texts without a letter get the score of the prior window (no features);
with no labelled documents, or of one class only, every score is that class's share (0.0 without any labels);
repeated labels of a document count as toxic if one of them does; null labels are ignored; repeated documents get a
row each; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm import blocks as B
from tickframe.llm import codepoints as C

BITS, DIM, WINDOW, SCORE_WINDOW = 17, 8, 24, 1
BUCKETS = 1 << BITS
_CHUNK = 1 << 11
SCORE_BYTES = 1 << 17  # of text that a task holds features of at once, about 250 bytes of arrays for each; a longer text is on its own
SIGNS = "@$!*#+|'"
ORDERS = (3, 4, 5)
MAX_POSITIVE, MAX_NEGATIVE, MAX_TRAIN_BYTES, PIECES = 1000, 1200, 32_768, 8
ROUNDS, MIN_STEPS, BATCH, RATE = 4, 300, 512, 0.05


def _in_words(classes: C.Classes, cps: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Lower-case letters, digits and signs of words, blanks for all else."""
    x, number = classes.folded(cps), classes.kinds(cps) == C.NUMBER
    letter = x != 0x20
    if not cps.size:
        return x
    ahead = np.append((letter | number)[1:], False)
    ahead[rows[1:][rows[1:] > 0] - 1] = False
    sign = np.isin(cps, np.array([ord(c) for c in SIGNS], cps.dtype))
    for _ in range(2):  # a sign before a sign, as in a$$le
        ahead |= np.append((sign & ahead)[1:], False) & sign
        ahead[rows[1:][rows[1:] > 0] - 1] = False
    inside = letter | number | (sign & ahead)
    starts, ends, _ = B.slices(inside, rows)
    sums = np.concatenate([[0], np.cumsum(letter)])
    some = np.zeros(cps.size + 1, np.int64)
    good = sums[ends] > sums[starts]
    np.add.at(some, starts[good], 1)
    np.add.at(some, ends[good], -1)
    return np.where(np.cumsum(some[:-1]) > 0, np.where(letter, x, cps), 0x20).astype(x.dtype)


def subwords(data: np.ndarray, offsets: np.ndarray, classes: C.Classes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature buckets, window of each feature, first window of each row and one past the last); windows in row order."""
    at, cps = C.decode(data)
    rows = np.searchsorted(at, offsets)
    x = _in_words(classes, cps, rows)
    letter = x != 0x20
    starts, ends, firsts = B.slices(letter, rows)
    n_windows = -(-np.diff(firsts) // window)
    window_firsts = np.concatenate([[0], np.cumsum(n_windows)])
    row_of = np.repeat(np.arange(rows.size - 1), np.diff(firsts))
    window_of_word = window_firsts[row_of] + (np.arange(starts.size) - firsts[row_of]) // window
    values = B.mix(x.astype(np.uint64) + np.uint64(0x51ED270B))
    whole = B.slice_hash(B.prefix_sums(values), starts, ends)
    out, of = [(whole >> np.uint64(64 - BITS)).astype(np.int64)], [window_of_word]
    # n-grams of each word with one edge mark before and after: lay the words out with single marks between them
    size = ends - starts
    places = np.cumsum(size + 1) - size  # first letter of each word in the layout; a mark stands before and after it
    laid = np.full(int(size.sum() + size.size + 1), 0x20, np.uint32)
    inside = np.repeat(places - starts, size) + np.flatnonzero(letter) if size.size else np.zeros(0, np.int64)
    laid[inside] = x[letter]
    word = np.zeros(laid.size, np.int64)
    word[1:][laid[:-1] == 0x20] = 1
    word = np.cumsum(word) - 1
    marks = np.concatenate([[0], np.cumsum(laid == 0x20)])
    h = laid * np.uint32(0x9E3779B1)
    for n in range(2, ORDERS[-1] + 1):
        h = ((h[:-1] * np.uint32(0x01000193)) ^ (laid[n - 1:] * np.uint32(0x9E3779B1))) if laid.size >= n else h[:0]
        if n in ORDERS and h.size:
            i = np.flatnonzero(marks[n - 1:-1][:h.size] - marks[1:h.size + 1] == 0)  # no mark but at the ends
            i = i[i + n <= laid.size]
            out.append(((h[i] * np.uint32(0x85EBCA6B) + np.uint32(n)) >> np.uint32(32 - BITS)).astype(np.int64))
            of.append(window_of_word[np.minimum(np.where(laid[i] == 0x20, word[np.minimum(i + 1, laid.size - 1)], word[i]), starts.size - 1)])
    return np.concatenate(out), np.concatenate(of), window_firsts


def _bags(texts: list[str], window: int):
    """Features sorted by window, their window starts, and the document of each window.  Features are written to their final
    place as they come, so the bounded sample is held once."""
    data = [np.frombuffer(t.encode("utf-8", "replace"), np.uint8) for t in texts]
    # a word, and per character and edge mark at most one n-gram of each length; memory is taken as it is written
    features, n = np.empty(sum(5 * d.size + 16 for d in data), np.int32), 0
    classes, sizes, docs = C.Classes(), [], []
    for k, d in enumerate(data):
        f, w, firsts = subwords(d, np.array([0, d.size]), classes, window)
        features[n:n + f.size] = f[np.argsort(w, kind="stable")]
        n += f.size
        sizes.append(np.bincount(w, minlength=int(firsts[-1])))
        docs.append(np.full(int(firsts[-1]), k))
    return features[:n], np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64), np.concatenate(docs)


def _take(features, starts, chosen):
    """Features of the chosen windows and the position in chosen that each belongs to."""
    n = starts[chosen + 1] - starts[chosen]
    owner = np.repeat(np.arange(chosen.size), n)
    shift = np.repeat(starts[chosen] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    return features[shift + np.arange(int(n.sum()))], owner, n


def train(texts: list[str], labels: np.ndarray, seed: int = 0) -> dict:
    """Joint training in numpy: {"weight": a number per bucket, "bias"}; the score is the logistic of the window's mean plus bias."""
    labels = np.asarray(labels, np.int64)
    if not len(texts) or labels.min() == labels.max():
        share = float(labels[0]) if len(texts) else 0.0
        return {"weight": np.zeros(BUCKETS), "bias": 60.0 if share else -60.0, "constant": share}
    rng = np.random.default_rng(seed)
    features, starts, doc = _bags(texts, WINDOW)
    y_doc = labels[doc].astype(float)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float64)
    out = rng.normal(0, 0.5, (DIM, 2))
    bias, g2_emb, g2_out = np.zeros(2), np.zeros(BUCKETS), 1e-6
    target = y_doc.copy()
    per_round = max(1, -(-int((np.diff(starts) > 0).sum()) // BATCH))
    for step in range(max(ROUNDS, -(-MIN_STEPS // per_round))):  # small samples go round more often
        use = np.flatnonzero((target == y_doc) & (np.diff(starts) > 0))
        weight = np.where(target[use] > 0, 0.5 / max(1, (target[use] > 0).sum()), 0.5 / max(1, (target[use] == 0).sum())) * use.size
        order = rng.permutation(use.size)
        for lo in range(0, order.size, BATCH):
            pick = order[lo:lo + BATCH]
            f, owner, n = _take(features, starts, use[pick])
            first = np.concatenate([[0], np.cumsum(n)[:-1]])
            mean = np.add.reduceat(emb[f], first, axis=0) / n[:, None]
            z = mean @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            d = p.copy()
            d[np.arange(pick.size), target[use[pick]].astype(int)] -= 1.0
            d *= weight[pick][:, None] / pick.size
            d_mean = d @ out.T / n[:, None]
            d_out, d_bias = mean.T @ d, d.sum(axis=0)
            used, where = np.unique(f, return_inverse=True)
            grad = np.stack([np.bincount(where, weights=d_mean[owner, k], minlength=used.size) for k in range(DIM)], axis=1)
            g2_emb[used] += (grad ** 2).sum(axis=1)
            emb[used] -= RATE * grad / (np.sqrt(g2_emb[used])[:, None] + 1e-8)
            g2_out += float((d_out ** 2).sum() + (d_bias ** 2).sum())
            out -= RATE * 4 * d_out / np.sqrt(g2_out)
            bias -= RATE * 4 * d_bias / np.sqrt(g2_out)
        per_bucket = emb @ (out[:, 1] - out[:, 0])
        z = _means(per_bucket, features, starts) + (bias[1] - bias[0])
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, doc, z)
        if step >= 2:
            target = np.where((y_doc > 0) & (z < np.minimum(0.0, best[doc])), 0.5, y_doc)  # 0.5: not used this round
    del features, starts, doc, emb, g2_emb
    best = np.full(len(texts), -np.inf)
    for k, text in enumerate(texts):  # one text's features at a time
        features, starts, doc = _bags([text], SCORE_WINDOW)
        if doc.size:
            best[k] = _means(per_bucket, features, starts).max()
    seen = np.isfinite(best)
    cut = _threshold(best[seen], labels[seen])
    return {"weight": per_bucket, "bias": -cut, "constant": None}


def _means(per_bucket, features, starts):
    """Mean of every window, in chunks of windows."""
    out = np.zeros(starts.size - 1)
    for lo in range(0, out.size, _CHUNK):  # a chunk's features take 16 bytes each while it is summed
        part = starts[lo:lo + _CHUNK + 1]
        sums = np.concatenate([[0.0], np.cumsum(per_bucket[features[part[0]:part[-1]]])])
        out[lo:lo + part.size - 1] = (sums[part[1:] - part[0]] - sums[part[:-1] - part[0]]) / np.maximum(np.diff(part), 1)
    return out


def _threshold(score: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the fewest errors, each class weighing the same; the middle of the gap where it lies."""
    order = np.argsort(score, kind="stable")
    s, y = score[order], labels[order]
    pos, neg = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    wrong = np.concatenate([[0], np.cumsum((y == 1) / pos)]) + np.concatenate([np.cumsum(((y == 0) / neg)[::-1])[::-1], [0]])
    k = int(np.argmin(wrong))
    return float(s[0] - 1 if k == 0 else s[-1] + 1 if k == s.size else (s[k - 1] + s[k]) / 2)


def _pieces(text: str) -> Column:
    """The text, or, of one longer than MAX_TRAIN_BYTES, PIECES pieces of about that size together, one at a hash-chosen place of each PIECES-th of it."""
    t, n = F.col(text), F.length(text)
    each = F.floor(F.lit(MAX_TRAIN_BYTES // PIECES) * n / F.octet_length(text)).cast("int")
    part = F.floor(n / PIECES).cast("int")
    at = lambda k: (k * part + F.pmod(F.xxhash64("doc_id", k), part - each + 1)).cast("int")
    piece = lambda k: F.regexp_replace(F.substr(t, at(k) + 1, each), r"^\S{1,40}\s|\s\S{1,40}$", " ")
    return F.when(F.octet_length(text) <= MAX_TRAIN_BYTES, t).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), piece), " "))


def sample(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The bounded training sample (doc_id, text, toxic) of docs (doc_id, text) and labels (doc_id, toxic); only labels of documents with letters count."""
    docs = docs.where(F.col("doc_id").isNotNull() & F.col(text).rlike(r"\p{L}"))
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    one = one.join(docs.select("doc_id"), "doc_id", "left_semi")
    picks = [one.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE))]
    chosen = F.broadcast(picks[0].unionByName(picks[1]))  # at most MAX_POSITIVE + MAX_NEGATIVE rows
    return docs.join(chosen, "doc_id").select("doc_id", _pieces(text).alias("text"), "toxic") \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def _train_task(batches):
    """All of the bounded sample in one task -> one row, the model."""
    rows = sorted((r["doc_id"], r["text"], r["toxic"]) for b in batches for r in b.to_pylist())
    model = train([t for _, t, _ in rows], np.array([y for *_, y in rows], np.int64))
    yield pa.RecordBatch.from_pydict({"weight": pa.array([model["weight"].astype(np.float64).tobytes()], pa.binary()),
                                      "bias": pa.array([model["bias"]], pa.float64()), "constant": pa.array([model["constant"]], pa.float64())})


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> dict:
    """The model trained on the sample; a task trains it, the driver gets BUCKETS numbers."""
    got = sample(docs, labels, text).select("doc_id", "text", "toxic").coalesce(1).mapInArrow(_train_task, "weight binary, bias double, constant double").collect()
    if not got:
        return train([], np.zeros(0, np.int64))
    return {"weight": np.frombuffer(got[0].weight), "bias": got[0].bias, "constant": got[0].constant}


def _score_task(model, text: str, keep_text: bool):
    def task(batches):
        m, classes = model.value, C.Classes()
        for rows, data, offsets in B.blocks(batches, text, SCORE_BYTES):
            f, w, firsts = subwords(data, offsets, classes, SCORE_WINDOW)
            total, count = np.bincount(w, weights=m["weight"][f], minlength=int(firsts[-1])), np.bincount(w, minlength=int(firsts[-1]))
            z = total / np.maximum(count, 1) + m["bias"]
            some = np.diff(firsts) > 0
            best = np.full(rows.num_rows, m["bias"])
            if some.any():
                best[some] = np.maximum.reduceat(z, firsts[:-1][some])
            score = np.full(rows.num_rows, m["constant"]) if m["constant"] is not None else 1 / (1 + np.exp(-np.clip(best * 2, -60, 60)))
            cols = {c: rows.column(c) for c in rows.schema.names if keep_text or c != text}
            cols |= {"score": pa.array(score.astype(float), pa.float64()), "predicted": pa.array((score >= 0.5).astype(np.int32), pa.int32())}
            yield pa.RecordBatch.from_pydict(cols)
    return task


def score(docs: DataFrame, model: dict, text: str = "text", keep_text: bool = False) -> DataFrame:
    """docs without the text (unless keep_text), plus score and predicted."""
    docs = docs.drop("score", "predicted")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if keep_text or f.name != text]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    return docs.mapInArrow(_score_task(shared, text, keep_text), ", ".join([*kept, "score double", "predicted int"]))
