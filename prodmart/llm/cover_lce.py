"""Longest common extensions of positions in a word sequence, by a difference cover.

A difference cover D of the numbers below V has, for every i and j, a shift d < V with i + d and j + d both in D modulo V.
Only suffixes that start in D modulo V, a fifth of all, are sorted. To extend i and j, at most d words are compared one by
one; from the synchronised positions on, the answer is a range minimum over the common prefixes of neighbours in
that order, from a sparse table.

The order is refined: suffixes are sorted by their first two words, and only those still tied by the next two; once V words
are equal, by the place of the suffix V, 2V, 4V... words further on, which starts in D as well. Whatever
separates two neighbours gives the length of their common prefix, so no words are compared twice. Everything is exact and takes
memory in proportion to the words times the logarithm of the sampled ones.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

V = 31
_FAR = np.iinfo(np.int32).max


@lru_cache(maxsize=4)
def difference_cover(v: int) -> tuple[int, ...]:
    """The first of the smallest covers of 0..v - 1 that hold 0 and 1."""
    size = 2
    while True:
        for rest in combinations(range(2, v), size - 2):
            cover = (0, 1, *rest)
            if len({(a - b) % v for a in cover for b in cover}) == v:
                return cover
        size += 1


@lru_cache(maxsize=4)
def shifts(v: int) -> np.ndarray:
    """Table of the least d that brings both i and j, taken modulo v, into the cover."""
    inside = np.zeros(v, bool)
    inside[list(difference_cover(v))] = True
    i, j, d = np.ogrid[:v, :v, :v]
    return np.argmax(inside[(i + d) % v] & inside[(j + d) % v], axis=2).astype(np.int64)


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Row k holds the minima of 2**k neighbours."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        last, half = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(last[:-half], last[half:]))
    return table


def range_min(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minima over low..high, both included."""
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), table[0].dtype)
    for k in np.unique(level):
        at = np.flatnonzero(level == k)
        row = table[k]
        out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k)) + 1])
    return out


class CoverLce:
    """Extensions over `words`, an array of positive word numbers below 2**32."""

    def __init__(self, words: np.ndarray, v: int = V):
        self.n, self.v = len(words), v
        # Behind the end stand zeros, which no word equals: two suffixes differ at the end of the shorter one at the latest.
        self.words = np.zeros(self.n + 2 * v + 2, np.uint64)
        self.words[: self.n] = words
        self.rank: np.ndarray | None = None
        self.table: list[np.ndarray] = []

    def _sort(self) -> None:
        """Places of the sampled suffixes, and common prefixes of neighbours; made when first needed."""
        cover = np.array(difference_cover(self.v))
        sampled = (np.arange(0, self.n, self.v)[:, None] + cover).ravel()
        sampled = sampled[sampled < self.n]
        m = len(sampled)
        rank = np.full(self.n + 1, -1, np.int64)  # of a position: where its group of ties begins; behind the end: first
        rank[sampled] = 0
        common = np.full(m, _FAR, np.int32)  # of the places p - 1 and p, once they are told apart
        order = sampled
        slots = np.arange(m)  # places still tied

        def split(key: np.ndarray, lcp) -> None:  # noqa: ANN001
            """Sort the tied suffixes by `key`; `lcp` gives the common prefix of neighbours told apart."""
            nonlocal slots
            group = rank[order[slots]]
            by = np.lexsort((key, group))
            order[slots] = order[slots][by]
            key, group = key[by], group[by]
            new = np.ones(len(slots), bool)
            new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
            apart = np.flatnonzero(new[1:] & (group[1:] == group[:-1])) + 1
            common[slots[apart]] = lcp(order[slots[apart - 1]], order[slots[apart]])
            rank[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
            tied = ~new
            tied[:-1] |= ~new[1:]
            slots = slots[tied]

        for done in range(0, self.v, 2):
            if not len(slots):
                break
            at = order[slots] + done
            pair = (self.words[at] << np.uint64(32)) | self.words[at + 1]
            split(pair, lambda a, b, done=done: done + (self.words[a + done] == self.words[b + done]))
        step = self.v
        while len(slots):
            table = sparse_table(common)

            def further(a: np.ndarray, b: np.ndarray, step: int = step, table: list = table) -> np.ndarray:
                x, y = rank_before[a + step], rank_before[b + step]
                low, high = np.minimum(x, y), np.maximum(x, y)
                rest = np.zeros(len(a), np.int64)  # one that ends there has nothing more in common
                inside = low >= 0
                rest[inside] = range_min(table, low[inside] + 1, high[inside])
                return step + rest

            rank_before = rank.copy()
            split(rank[order[slots] + step], further)
            step *= 2
        self.rank, self.table = rank, sparse_table(common)

    def extend(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many words from i and from j on are equal, at most `limit`; i < j, and j + limit is at most n."""
        found = limit.astype(np.int64)
        shift = np.minimum(shifts(self.v)[i % self.v, j % self.v], found)
        alive = np.arange(len(i))
        for k in range(self.v):
            alive = alive[shift[alive] > k]
            if not len(alive):
                break
            differ = self.words[i[alive] + k] != self.words[j[alive] + k]
            found[alive[differ]] = k
            shift[alive[differ]] = -1
            alive = alive[~differ]
        far = np.flatnonzero((shift >= 0) & (shift < found))
        if len(far):
            if self.rank is None:
                self._sort()
            x, y = self.rank[i[far] + shift[far]], self.rank[j[far] + shift[far]]
            more = range_min(self.table, np.minimum(x, y) + 1, np.maximum(x, y))
            found[far] = np.minimum(found[far], shift[far] + more)
        return found
