"""Plain re-computations of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re

SF_SMALL = "/root/testdata/sf0.001"


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def repeats_of_bytes(rows, length=400):
    """op1 by counting every string."""
    places: dict[bytes, int] = {}
    texts = [(t or "").encode() for _, t in rows]
    for b in texts:
        for i in range(len(b) - length + 1):
            places[b[i:i + length]] = places.get(b[i:i + length], 0) + 1
    out = []
    for (d, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if places[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out, key=str)


def repeats_of_words(rows, window=13):
    """op8: windows that start in a document of smaller id."""
    big = 1 << 62
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first: dict[tuple, int] = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            first[g] = min(first.get(g, big + 1), big if d is None else d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (big if d is None else d):
                gone[i:i + window] = [True] * window
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return sorted(out, key=str)


def jaccard_components(rows, k=5):
    """op7 by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    comp = [d for d, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                common = len(sets[i] & sets[j])
                if common and None not in (comp[i], comp[j]) and 100 * common >= 75 * len(sets[i] | sets[j]) and comp[j] > comp[i]:
                    comp[j], changed = comp[i], True
    return sorted(((d, len(s), c) for (d, _), s, c in zip(rows, sets, comp)), key=str)


def benchmark_hits(rows, items, window=10):
    """op4 by comparing all windows."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    grams: dict[tuple, set] = {}
    for name, t in items:
        w = split(t)
        m = min(len(w), window)
        for i in range(len(w) - m + 1 if m else 0):
            grams.setdefault(tuple(w[i:i + m]), set()).add("null" if name is None else str(name))
    out = []
    for d, t in rows:
        w, found = split(t), set()
        hit = [False] * len(w)
        for g, names in grams.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i:i + len(g)]) == g:
                    hit[i:i + len(g)] = [True] * len(g)
                    found |= names
        out.append((d, len(w), sum(hit), len(found), sha(",".join(sorted(found)).encode()), any(hit)))
    return sorted(out, key=str)
