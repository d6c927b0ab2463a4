"""Vectorised views of text columns: Arrow buffers as numpy bytes, word slices, hashes of slices.

The helpers run inside ``mapInArrow`` tasks.  A block is a run of whole rows whose UTF-8 bytes come to about
``max_bytes``; one longer text is a block of its own, so memory follows the block, not the Arrow batch.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
# Slices are hashed by polynomials modulo the prime 2**31 - 1, for two bases at once (62 bits).  Modulo a power of two there
# are short words (Thue-Morse) that collide for every base; modulo a prime two words of n places collide for n bases at most.
_PRIME = np.uint64((1 << 31) - 1)
_BASES = (0x3C6EF372, 0x5BE0CD19)
LEAST_POWERS = (1 << 17) + 1  # tables of powers grow with the blocks that they are asked for
_powers: list[dict] = [{"n": 0, "p": None, "q": None} for _ in _BASES]


def _folded(x: np.ndarray) -> np.ndarray:
    """A smaller number of the same remainder: below 2**33 for any x, below 2**32 for products of two remainders."""
    return (x & _PRIME) + (x >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, without a division."""
    x = _folded(_folded(x))
    return np.minimum(x, x - _PRIME)  # what is below the prime wraps round to a large number


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string column; null counts as the empty text."""
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Gives back what earlier tasks of this Python worker left: functions sent by value (with their tables) go in cycles, Arrow and
    the C library keep freed pages; workers of an executor outlive stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def blocks(batches, column: str, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, data, offsets) for runs of rows of about max_bytes of text."""
    release()
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
            hi = min(n, max(hi, lo + 1))
            yield batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            lo = hi
    release()  # idle workers keep no batches


def slices(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross rows: (starts, ends, first run of each row and one past the last)."""
    n = mask.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(offsets.size, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, mask[:-1]
    before[edge[:n]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, mask[1:]
    after[edge[1:]] = False
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _power_run(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo the prime, by doubling."""
    out = np.ones(1, np.uint64)
    while out.size < n:
        out = np.concatenate([out, _reduced(out * np.uint64(pow(base, out.size, int(_PRIME))))])
    return out[:n]


def _power_tables(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    table = _powers[k]
    if table["n"] < n:
        m = max(n, min(2 * table["n"], BLOCK_BYTES + 1), LEAST_POWERS)
        table |= {"p": _power_run(_BASES[k], m), "q": _power_run(pow(_BASES[k], -1, int(_PRIME)), m), "n": m}
    return table["p"][:n], table["q"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixing of 64-bit values (the splitmix finaliser), in place on a copy."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def value_table(seed: int = 1, lower: bool = False) -> np.ndarray:
    """One 64-bit value per byte; with ``lower`` A-Z share the values of a-z."""
    t = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed)) | np.uint64(1)
    if lower:
        t[65:91] = t[97:123]
    return t


def prefix_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial prefix sums of the low and the high half of the values: the hash of any slice is a difference (see slice_hash)."""
    out = []
    for k, part in enumerate((values & _PRIME, (values >> np.uint64(32)) & _PRIME)):
        p, _ = _power_tables(k, values.size + 1)
        sums = np.zeros(values.size + 1, np.uint64)
        np.cumsum(_folded(part * p[:values.size]), out=sums[1:])  # below 2**32 times the values, so exact up to 2**31 of them
        out.append(sums)
    return out[0], out[1]


def slice_hash(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hashes of slices (62 bits of information); equal slices have equal hashes wherever they start."""
    one, two = (_reduced(_folded(s[ends] - s[starts]) * _power_tables(k, s.size)[1][starts]) for k, s in enumerate(sums))
    return mix((one | two << np.uint64(32)) + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values (block-wise running minima, two passes for any w)."""
    n = h.size
    if n < w:
        return h[:0]
    m = -(-n // w) * w
    pad = np.full(m, np.iinfo(h.dtype).max, h.dtype)
    pad[:n] = h
    grid = pad.reshape(-1, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - w + 1], left[w - 1:n])


_PLACE = np.uint64((1 << 24) - 1)
_PIECE = 1 << 23


def sampled(h: np.ndarray, w: int, valid: np.ndarray) -> np.ndarray:
    """Places of the least of every w consecutive values (the first of equals) whose window's first place is valid."""
    found = []
    for lo in range(0, h.size, _PIECE):  # the place within a piece fits the low bits
        part = h[lo:lo + _PIECE + w - 1]
        least = sliding_min((part & ~_PLACE) | np.arange(part.size, dtype=np.uint64), w)
        found.append((least[valid[lo:lo + least.size]] & _PLACE).astype(np.int64) + lo)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


# Word characters.  The ASCII white space of the contracts, and the bytes of words of letters and digits.
SPACE_SPLIT = np.ones(256, bool)
SPACE_SPLIT[[0x20, *range(0x09, 0x0E)]] = False
ALNUM_SPLIT = np.ones(256, bool)
ALNUM_SPLIT[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False  # after lower-casing A-Z
