"""Suffix arrays of many short texts at once, in numpy."""

from __future__ import annotations

import numpy as np

STEP = 8  # symbols that the first sort looks at


class Suffixes:
    """All suffixes of some texts, each text ending in a symbol of its own.

    Larsson-Sadakane refinement: suffixes sorted by h symbols are sorted by 2 h by the rank of what
    follows, and only groups that are not yet single are touched again. ``lcp[i]`` is the common prefix
    of the i-th and the one before it: by Kasai's inequality it falls by at most one from a suffix to
    the next, and exactly by one unless the symbols before differ, so only those are compared.
    """

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)[:-1]]).astype(np.int64) if texts else np.empty(0, np.int64)
        body = b"\xff".join(texts) + b"\xff" if texts else b""
        self.size = len(body)
        symbols = np.frombuffer(body, np.uint8)
        self.ends = np.zeros(self.size, bool)
        self.ends[self.starts + self.lengths] = True
        self._first(symbols)
        self._refine()
        self.order = self.sa
        self._prefixes(symbols)

    def _first(self, symbols: np.ndarray) -> None:
        """Sort by 8 symbols. A text's end within them makes a suffix unlike all others."""
        n = self.size
        padded = np.concatenate([symbols, np.zeros(STEP, np.uint8)]).astype(np.uint64)
        ended = np.zeros(n, bool)
        key = np.zeros(n, np.uint64)
        open_ends = np.concatenate([self.ends, np.zeros(STEP, bool)])
        for j in range(STEP):
            key = (key << np.uint64(8)) | np.where(ended, np.uint64(0), padded[j : j + n])
            ended |= open_ends[j : j + n]
        self.sa = np.argsort(key, kind="stable")
        key = key[self.sa]
        new = np.ones(n, bool)
        new[1:] = (key[1:] != key[:-1]) | ended[self.sa[1:]] | ended[self.sa[:-1]]
        self._rank(np.arange(n), new)

    def _rank(self, places: np.ndarray, new: np.ndarray) -> None:
        """Number the suffixes at sorted places by the place of their group's head."""
        if not hasattr(self, "rank"):
            self.rank = np.empty(self.size, np.int64)
        head = np.maximum.accumulate(np.where(new, places, 0))
        self.rank[self.sa[places]] = head
        single = new & np.concatenate([new[1:], [True]])
        self.open = places[~single]

    def _refine(self) -> None:
        self.first_rank = self.rank.copy()
        h = STEP
        while len(self.open):
            suffix = self.sa[self.open]
            key = self.rank[suffix] * (self.size + 1) + self.rank[suffix + h]  # within its text, as it isn't single
            order = np.argsort(key, kind="stable")
            key = key[order]
            self.sa[self.open] = suffix[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            self._rank(self.open, new)
            h *= 2

    def _prefixes(self, symbols: np.ndarray) -> None:
        n = self.size
        before = np.full(n, -1, np.int64)
        before[self.sa[1:]] = self.sa[:-1]
        place = np.arange(n)
        ahead = np.maximum(before, 1) - 1
        falls = np.zeros(n, bool)
        falls[1:] = (before[1:] > 0) & (symbols[:-1] == symbols[ahead[1:]]) & ~self.ends[:-1]
        own = np.flatnonzero(~falls)
        own = own[before[own] >= 0]
        common = np.zeros(n, np.int64)
        active, other = own, before[own]
        length = np.zeros(len(own), np.int64)
        live = np.arange(len(own))
        while len(live):  # eight symbols at a time; ranks are equal only if all eight are, and no text ends
            same = self.first_rank[active[live] + length[live]] == self.first_rank[other[live] + length[live]]
            live = live[same]
            length[live] += STEP
        live = np.arange(len(own))
        for _ in range(STEP - 1):
            a, b = active[live] + length[live], other[live] + length[live]
            same = (symbols[a] == symbols[b]) & ~self.ends[a] & ~self.ends[b]
            live = live[same]
            length[live] += 1
        common[own] = length
        last = np.maximum.accumulate(np.where(falls, 0, place))
        common = np.where(falls, common[last] - (place - last), common)
        self.lcp = common[self.sa]
        if n:
            self.lcp[0] = 0
