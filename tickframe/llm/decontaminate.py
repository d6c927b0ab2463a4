"""Benchmark decontamination: a generalised suffix automaton of the normalised test items, streamed over documents.

Words: A-Z lower-cased, then runs of digits, letters a-z and non-ASCII characters.  A window is ``window``
consecutive item words; an item of fewer (but some) words is one window.  The automaton is built from items of at
most ``block_bytes`` of text; a larger benchmark is cut by item into blocks and the documents stream past one block
after the other, so what is broadcast stays bounded.

Defined results: null or empty text has no words and no hits; items without words are never found; a null item_id
is named ``null``; repeated items count once by item_id; repeated documents each get their own row; an empty
benchmark hits nothing.  Other columns of documents pass through untouched under their own names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm import blocks as B
from tickframe.llm.automaton import SuffixAutomaton

WINDOW = 10
BLOCK_BYTES = 4 << 20
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def item_words(text: str) -> list[bytes]:
    return [w.encode() for w in _WORDS.findall(text.translate(_LOWER))]


class _Index:
    """Automaton of one block of items, with sorted hashes of its words and word pairs for the vectorised pre-scan."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        seqs = [(name, item_words(text)) for name, text in items]
        seqs = [(name, s) for name, s in seqs if s]
        table = B.value_table(lower=True)
        self.words = sorted({w for _, s in seqs for w in s})
        number = {w: i for i, w in enumerate(self.words)}
        self.lengths = sorted({min(len(s), window) for _, s in seqs})
        data = np.frombuffer(b"".join(self.words), np.uint8)
        ends = np.cumsum([len(w) for w in self.words]).astype(np.int64) if self.words else np.zeros(0, np.int64)
        h = B.slice_hash(B.prefix_sums(table[data]), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends) if self.words else np.zeros(0, np.uint64)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        ids = [(name, [number[w] for w in s]) for name, s in seqs]
        self.pairs = np.unique(np.array([a * len(self.words) + b for _, s in ids for a, b in zip(s, s[1:])], np.int64))
        self.sam = SuffixAutomaton()
        for _, s in ids:
            self.sam.add(s)
        for name, s in ids:
            self.sam.tag(s, min(len(s), window), name)

    def number(self, h: np.ndarray) -> np.ndarray:
        """Word numbers by hash, -1 for words of no item."""
        if not self.hashes.size:
            return np.full(h.size, -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), self.hashes.size - 1)
        return np.where(self.hashes[at] == h, self.order[at], -1)

    def runs(self, ids: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int]]:
        """Word ranges, inside one row each, whose words and neighbouring pairs all occur in items."""
        if not self.lengths or not ids.size:
            return []
        inside = ids >= 0
        joined = np.zeros(ids.size, bool)  # this word continues the word before it
        both = np.flatnonzero(inside[1:] & inside[:-1]) + 1
        if self.pairs.size and both.size:
            key = ids[both - 1] * len(self.words) + ids[both]
            at = np.minimum(np.searchsorted(self.pairs, key), self.pairs.size - 1)
            joined[both] = self.pairs[at] == key
        heads = firsts[:-1]
        joined[heads[heads < ids.size]] = False
        start = np.flatnonzero(inside & ~joined)
        if not start.size:
            return []
        stop = np.flatnonzero(inside & ~np.append(joined[1:], False)) + 1
        long = stop - start >= self.lengths[0]
        return list(zip(start[long].tolist(), stop[long].tolist()))


def _stream(index: _Index):
    lengths, sam = index.lengths, index.sam

    def hits(words: list[int]):
        """(first, last + 1, item names) of every window found in a run of words."""
        for at, (state, size) in enumerate(sam.statistics(words), 1):
            for m in lengths:
                if size < m:
                    break
                if names := sam.tags.get((sam.shorten(state, m), m)):
                    yield at - m, at, names
    return hits


def _scan(items_broadcast, window: int, names: list[str]):
    """mapInArrow task: adds to _spans ([first, end) word pairs, flat) and _items of each row."""
    def task(batches):
        index = _Index(items_broadcast.value, window)
        table, hits = B.value_table(lower=True), _stream(index)
        for rows, data, offsets in B.blocks(batches, "_text"):
            starts, ends, firsts = B.slices(B.ALNUM_SPLIT[data], offsets)
            ids = index.number(B.slice_hash(B.prefix_sums(table[data]), starts, ends)) if starts.size else np.zeros(0, np.int64)
            spans, items = ([x or [] for x in rows.column(c).to_pylist()] for c in ("_spans", "_items"))
            for lo, hi in index.runs(ids, firsts):
                words = [int(x) for x in ids[lo:hi]]
                for k in range(lo, hi):  # by the bytes, not by the hash alone
                    if data[starts[k]:ends[k]].tobytes().translate(_BYTES_LOWER) != index.words[words[k - lo]]:
                        words[k - lo] = -1
                row = int(np.searchsorted(firsts, lo, "right")) - 1
                base = lo - int(firsts[row])
                for a, b, found in hits(words):
                    if spans[row] and spans[row][-2] <= a + base <= spans[row][-1]:
                        spans[row][-1] = max(spans[row][-1], b + base)
                    else:
                        spans[row] += [a + base, b + base]
                    items[row] = list(set(items[row]) | found)
            cols = {n: rows.column(n) for n in rows.schema.names}
            cols["_spans"] = pa.array(spans, pa.list_(pa.int64()))
            cols["_items"] = pa.array(items, pa.list_(pa.string()))
            cols["_n_words"] = pa.array(np.diff(firsts), pa.int64())
            if "_n_hit" in names:
                out = [_finish(s, rows_text, f) for s, rows_text, f in zip(
                    spans, _row_cuts(data, offsets, starts, ends, firsts), np.diff(firsts))]
                cols["_clean"] = pa.array([x[0] for x in out], pa.string())
                cols["_n_hit"] = pa.array([x[1] for x in out], pa.int64())
            yield pa.RecordBatch.from_pydict({n: cols[n] for n in names})
    return task


_BYTES_LOWER = bytes(range(256)).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


def _row_cuts(data, offsets, starts, ends, firsts):
    for k in range(len(offsets) - 1):
        yield data[offsets[k]:offsets[k + 1]], starts[firsts[k]:firsts[k + 1]] - offsets[k], ends[firsts[k]:firsts[k + 1]] - offsets[k]


def _finish(spans, cut, n_words):
    """(text without the hit words, number of hit words); spans are merged first, blocks may overlap."""
    if not spans:
        return None, 0  # the text stays as it is
    text, starts, ends = cut
    pairs, merged = sorted(zip(spans[::2], spans[1::2])), []
    for a, b in pairs:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    keep, at = [], 0
    for a, b in merged:
        keep.append(text[at:starts[a]].tobytes())
        at = int(ends[b - 1])
    keep.append(text[at:].tobytes())
    return b"".join(keep).decode(), sum(b - a for a, b in merged)


def scan(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep_text: bool = True) -> DataFrame:
    """_row (the other columns of docs as a struct), _n_words, _n_hit, _items (names of the items found), and with keep_text
    _text and _clean (the text without hit words; null: unchanged)."""
    spark = docs.sparkSession
    items = bench.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("name"),
                         F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-2 * total // block_bytes))  # twice the mean leaves room for uneven blocks
    key = F.pmod(F.xxhash64("name", "text"), F.lit(n_blocks))
    out = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("_row"), F.col(text).alias("_text"),
                      F.lit(None).cast("array<bigint>").alias("_spans"), F.lit(None).cast("array<string>").alias("_items"))
    row = out.schema["_row"].dataType.simpleString()
    for k in range(n_blocks):
        block = [tuple(r) for r in items.where(key == k).distinct().collect()]  # about block_bytes at most
        last = k == n_blocks - 1
        kinds = {"_row": row, "_items": "array<string>"}
        if not last:
            kinds |= {"_text": "string", "_spans": "array<bigint>"}
        else:
            kinds |= {"_n_words": "bigint", "_n_hit": "bigint"} | ({"_text": "string", "_clean": "string"} if keep_text else {})
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(block), window, list(kinds)), ", ".join(f"{k} {v}" for k, v in kinds.items()))
    return out


def digest(name: Column) -> Column:
    return F.sha2(F.concat_ws(",", F.sort_array(name)), 256)


def report(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """The digest of op4: one row per document."""
    got = scan(docs.select("doc_id", "text"), bench, keep_text=False, **options)
    return got.select("_row.doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
                      F.size("_items").cast("long").alias("n_items"), digest(F.col("_items")).alias("items_sha256"),
                      (F.col("_n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, bench: DataFrame, max_coverage: float = 0.5, **options) -> DataFrame:
    """Documents without the spans found in items; a document of which more than max_coverage is hit goes."""
    got = scan(docs, bench, **options).where(F.col("_n_hit") <= F.lit(max_coverage) * F.greatest(F.col("_n_words"), F.lit(1)))
    name = options.get("text", "text")
    text = F.when(F.col("_n_hit") > 0, F.col("_clean")).otherwise(F.col("_text"))
    return got.select(*(text.alias(name) if c == name else F.col(f"_row.`{c}`") for c in docs.columns))
