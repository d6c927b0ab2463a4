"""Code points of UTF-8 byte arrays and their classes, without per-character Python."""

from __future__ import annotations

import unicodedata

import numpy as np

OTHER, LETTER, NUMBER, SPACE, START = 0, 1, 2, 3, 4
# The code points of the Unicode property White_Space.
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006,
               0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Ranges of letters and of numbers that Unicode 16.0 added; unicodedata may be of an earlier version.
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
               (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
               (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
               (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
               (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


def decode(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the first bytes, code points)."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[at]
    cp = first.astype(np.uint32)
    wide = np.flatnonzero(first >= 0xC0)
    if wide.size:
        pad = np.concatenate([data, np.zeros(3, np.uint8)])
        p, b = at[wide], first[wide].astype(np.uint32)
        c1, c2, c3 = ((pad[p + k] & 0x3F).astype(np.uint32) for k in (1, 2, 3))
        cp[wide] = np.where(b < 0xE0, (b & 0x1F) << 6 | c1,
                            np.where(b < 0xF0, (b & 0x0F) << 12 | c1 << 6 | c2, (b & 0x07) << 18 | c1 << 12 | c2 << 6 | c3))
    return at, np.minimum(cp, 0x10FFFF)


class Classes:
    """Class and lower-case form of code points, looked up once for each code point that occurs."""

    def __init__(self):
        self.kind = np.full(0x110000, 255, np.uint8)
        self.fold = np.zeros(0x110000, np.uint32)  # lower-case letter, or a blank for what is no letter
        for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
            for a, b in ranges:
                self.kind[a:b + 1] = kind
                self.fold[a:b + 1] = np.arange(a, b + 1) if kind == LETTER else 0x20

    def _learn(self, cps: np.ndarray) -> None:
        if (self.kind[cps] != 255).all():
            return
        for c in np.unique(cps[self.kind[cps] == 255]).tolist():
            major = unicodedata.category(chr(c))[0]
            self.kind[c] = SPACE if c in WHITE_SPACE else {"L": LETTER, "N": NUMBER}.get(major, OTHER)
            low = chr(c).lower()
            self.fold[c] = (ord(low) if len(low) == 1 else c) if major == "L" else 0x20

    def kinds(self, cps: np.ndarray) -> np.ndarray:
        self._learn(cps)
        return self.kind[cps]

    def folded(self, cps: np.ndarray) -> np.ndarray:
        self._learn(cps)
        return self.fold[cps]
