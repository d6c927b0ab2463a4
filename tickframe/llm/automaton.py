"""Generalised suffix automaton over sequences of hashable symbols."""

from __future__ import annotations


class SuffixAutomaton:
    """One automaton of several sequences.  ``add`` restarts at the root, so no match runs across two sequences.

    ``tag(seq, length, value)`` notes a value at the state of every window of that length; ``tags`` maps
    (state, length) to the noted values.
    """

    __slots__ = ("next", "link", "len", "tags")

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len = [-1], [0]
        self.tags: dict[tuple[int, int], set] = {}

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, p: int, q: int, symbol) -> int:
        """The state of p's string plus symbol, cut out of q where q also stands for longer strings."""
        if self.len[p] + 1 == self.len[q]:
            return q
        clone = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def add(self, seq) -> None:
        last = 0
        nxt, link = self.next, self.link
        for symbol in seq:
            q = nxt[last].get(symbol)
            if q is not None:
                last = self._split(last, q, symbol)
                continue
            cur, p = self._state(self.len[last] + 1, {}, 0), last
            while p >= 0 and symbol not in nxt[p]:
                nxt[p][symbol] = cur
                p = link[p]
            if p >= 0:
                link[cur] = self._split(p, nxt[p][symbol], symbol)
            last = cur

    def statistics(self, seq):
        """Yields (state, length of the longest match that ends here) for every symbol."""
        nxt, link, length = self.next, self.link, self.len
        state = size = 0
        for symbol in seq:
            edge = nxt[state].get(symbol)
            while edge is None and state:
                state = link[state]
                size = length[state]
                edge = nxt[state].get(symbol)
            if edge is None:
                state = size = 0
            else:
                state, size = edge, size + 1
            yield state, size

    def shorten(self, state: int, length: int) -> int:
        """The state of the last ``length`` symbols of a match that ends in state."""
        while self.len[self.link[state]] >= length:
            state = self.link[state]
        return state

    def tag(self, seq, length: int, value) -> None:
        for state, size in self.statistics(seq):
            if size >= length:
                self.tags.setdefault((self.shorten(state, length), length), set()).add(value)
