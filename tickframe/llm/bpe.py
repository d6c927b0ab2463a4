"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Pre-tokens are located in numpy.  Every byte gets the class of its code point; a code point's transition function
either keeps the automaton's state or resets it, and such functions compose associatively, so the state before each
position is a scan (the previous class with resets at text starts).  Boundaries follow from the state before and the
class at each position; the few contractions look two bytes ahead.  Slices feed a bounded cache of merged pairs.

Defined results: null is the empty text with no tokens; every row gets a result, repeated rows each their own;
other columns pass through.  ``ends`` (the byte offset after each token) makes decoding of any token range possible.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickframe.llm import blocks as B
from tickframe.llm import codepoints as C

CACHE_ENTRIES = 300_000
CACHE_BYTES = 64  # longer slices are merged each time
_ONE, _TWO = np.zeros(256, bool), {ord("r"): ord("e"), ord("v"): ord("e"), ord("l"): ord("l")}
_ONE[[ord(c) for c in "stmd"]] = True


def boundaries(data: np.ndarray, offsets: np.ndarray, classes: C.Classes) -> np.ndarray:
    """First bytes of the pre-tokens of every row, in order."""
    n = data.size
    if not n:
        return np.zeros(0, np.int64)
    text_start = np.zeros(n + 3, bool)
    text_start[offsets] = True
    at, cps = C.decode(data)
    kind = np.empty(n, np.uint8)
    lead = np.zeros(n, bool)
    lead[at] = True
    kinds = classes.kinds(cps)
    kind[:] = kinds[np.cumsum(lead) - 1] if at.size != n else kinds
    before = np.empty(n, np.uint8)  # the scanned state
    before[0], before[1:] = C.START, kind[:-1]
    before[text_start[:n]] = C.START
    blank = np.empty(n, bool)  # the byte before is a blank of the same text
    blank[0], blank[1:] = False, data[:-1] == 0x20
    blank &= before == C.SPACE
    first = lead & (kind != before) & ~blank
    after_space = np.flatnonzero(lead & (kind != C.SPACE) & (before == C.SPACE))
    if after_space.size:  # the last space of a run stands apart or goes with what follows
        p = after_space - 1
        for _ in range(3):
            p = np.where(lead[p], p, p - 1)
        first[p] = True
    quote = np.flatnonzero((data == 0x27) & (before != C.OTHER) & ~blank)
    if quote.size:
        pad = np.concatenate([data, np.zeros(2, np.uint8)])
        a, b = pad[quote + 1], pad[quote + 2]
        inside = ~text_start[quote + 1]
        size = np.where(_ONE[a] & inside, 1, 0)
        for x, y in _TWO.items():
            size[(a == x) & (b == y) & inside & ~text_start[quote + 2]] = 2
        quote, size = quote[size > 0], size[size > 0]
        first[quote + 1] = False
        nxt = quote + 1 + size
        first[nxt[nxt < n]] = True
    return np.flatnonzero(first)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec(dict):
    """Ids of slices (a bounded cache), and bytes of ids."""

    def __init__(self, path: str):
        super().__init__()
        self.ranks = read_ranks(path)
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.name_of = {i: str(i) for i in self.bytes_of}
        self.classes = C.Classes()

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        rank = self.ranks.get(piece)
        ids = (rank,) if rank is not None else self._merge(piece) if len(piece) <= CACHE_BYTES else self._merge_long(piece)
        if len(piece) <= CACHE_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids

    def _merge(self, piece: bytes) -> tuple[int, ...]:
        rank, far = self.ranks.get, 1 << 60
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [rank(a + b, far) for a, b in zip(parts, parts[1:])]
        while pairs and (low := min(pairs)) < far:
            i = pairs.index(low)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], far)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], far)
        return tuple(self.ranks[p] for p in parts)

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Same merges by a heap over a linked list, for slices of any length."""
        n, rank = len(piece), self.ranks.get
        end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or end[j] != stop or not alive[i]:
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                prev[stop] = i
                if (r := rank(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := rank(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return tuple(out)

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Yields the list of ids of each row."""
        raw, first = data.tobytes(), boundaries(data, offsets, self.classes)
        cut = first.tolist()
        parts = [self[raw[a:b]] for a, b in zip(cut, cut[1:] + [len(raw)])]
        rows = np.searchsorted(first, offsets).tolist()
        for lo, hi in zip(rows, rows[1:]):
            yield list(chain.from_iterable(parts[lo:hi]))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _with(rows: pa.RecordBatch, drop: tuple[str, ...], **columns) -> pa.RecordBatch:
    cols = {n: rows.column(n) for n in rows.schema.names if n not in drop}
    return pa.RecordBatch.from_pydict(cols | columns)


def _schema(docs: DataFrame, drop: tuple[str, ...], extra: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in drop] + [extra])


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """docs plus token_ids, token_ends (byte offset after each token), n_tokens and whether the ids decode to the text's bytes."""
    new = ("token_ids", "token_ends", "n_tokens", "round_trip")

    def task(batches):
        codec = Codec(vocabulary)
        for rows, data, offsets in B.blocks(batches, text):
            ids, raw = list(codec.encode(data, offsets)), data.tobytes()
            same = [codec.decode(x) == raw[a:b] for x, a, b in zip(ids, offsets.tolist(), offsets[1:].tolist())]
            ends = [np.cumsum([len(codec.bytes_of[i]) for i in x], dtype=np.int64).tolist() for x in ids]
            yield _with(rows, new, token_ids=pa.array(ids, pa.list_(pa.int32())), token_ends=pa.array(ends, pa.list_(pa.int64())),
                        n_tokens=pa.array([len(x) for x in ids], pa.int64()), round_trip=pa.array(same, pa.bool_()))
    return docs.mapInArrow(task, _schema(docs, new, "token_ids array<int>, token_ends array<bigint>, n_tokens bigint, round_trip boolean"))


def decode(docs: DataFrame, vocabulary: str, ids: str = "token_ids") -> DataFrame:
    """docs plus decoded (binary), the bytes of the ids; null ids give no bytes."""
    def task(batches):
        codec = Codec(vocabulary)
        for b in batches:
            out = [codec.decode(x or ()) for x in b.column(b.schema.get_field_index(ids)).to_pylist()]
            yield _with(b, ("decoded",), decoded=pa.array(out, pa.binary()))
    return docs.mapInArrow(task, _schema(docs, ("decoded",), "decoded binary"))


def round_trip(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """docs without the text, plus n_tokens, ids_sha256 and decoded_sha256 of encoding and then decoding it."""
    def task(batches):
        codec = Codec(vocabulary)
        for rows, data, offsets in B.blocks(batches, text):
            n, a, b = [], [], []
            for ids in codec.encode(data, offsets):
                n.append(len(ids))
                a.append(hashlib.sha256(",".join(map(codec.name_of.__getitem__, ids)).encode()).hexdigest())
                b.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield _with(rows, (text,), n_tokens=pa.array(n, pa.int64()), ids_sha256=pa.array(a, pa.string()),
                        decoded_sha256=pa.array(b, pa.string()))
    return docs.mapInArrow(task, _schema(docs, (text,), "n_tokens bigint, ids_sha256 string, decoded_sha256 string"))
