"""Vectorised scanning of UTF-8 text columns inside Arrow batches.

Texts are read as one byte array per batch with row offsets and handled in blocks of whole rows, so the
temporary arrays stay small whatever the batch holds. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    where = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, where


@dataclass
class Block:
    """Some whole rows: `data` is their bytes, row i is data[at[i]:at[i + 1]]; `first` is the batch row of row 0."""

    data: np.ndarray
    at: np.ndarray
    first: int

    @property
    def rows(self) -> int:
        return len(self.at) - 1

    def sums(self, mask: np.ndarray) -> np.ndarray:
        """Per row, how many bytes of the mask are set."""
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[self.at[1:]] - total[self.at[:-1]]

    def spans(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of the mask that do not cross rows: starts, ends, and per row the index of its first run."""
        if not len(mask):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(len(self.at), np.int64)
        begin, end = mask.copy(), mask.copy()
        begin[1:] &= ~mask[:-1]
        end[:-1] &= ~mask[1:]
        inner = self.at[(self.at > 0) & (self.at < len(mask))]
        begin[inner] = mask[inner]
        end[inner - 1] = mask[inner - 1]
        starts = np.flatnonzero(begin)
        return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, self.at)

    def pieces(self, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What stands between separator bytes, empty pieces too; every row has at least one.

        Returns starts, ends, and per row the index of its first piece.
        """
        cuts = np.flatnonzero(separator)
        starts = np.concatenate([self.at[:-1], cuts + 1])
        row = np.concatenate([np.arange(self.rows), np.searchsorted(self.at, cuts, "right") - 1])
        order = np.lexsort((starts, row))
        starts, row = starts[order], row[order]
        first = np.searchsorted(row, np.arange(self.rows + 1))
        ends = np.empty(len(starts), np.int64)
        ends[:-1] = starts[1:] - 1
        ends[first[1:] - 1] = self.at[1:]
        return starts, ends, first


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows of a column in order, about `limit` bytes at a time; a longer row is a block of its own."""
    data, at = text_bytes(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1))
        yield Block(data[at[i] : at[j]], at[i : j + 1] - at[i], i)
        i = j


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        made = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            np.multiply.accumulate(table, out=table)
            made.append(table)
        _powers = made[0], made[1]
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hasher(data: np.ndarray) -> Callable[..., np.ndarray]:
    """A function (starts, ends, seed) -> 64-bit hashes; equal spans get equal values wherever they stand."""
    power, inverse = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=prefix[1:])

    def of(starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        length = (ends - starts).astype(np.uint64) + np.uint64(seed << 40)
        return mix((prefix[ends] - prefix[starts]) * inverse[starts] + length)

    return of


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hasher(data)(starts, ends)


def grams(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive word hashes that lie in one row: (index of their first word, hash)."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n - k + 1, np.uint64)
    factor = 1
    for j in range(k):
        total += words[j : n - k + 1 + j] * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
    inside = np.ones(n - k + 1, bool)
    for j in range(1, k):  # a window that starts up to k - 1 words before a row's first word crosses rows
        edge = first[1:-1] - j
        inside[edge[(edge >= 0) & (edge <= n - k)]] = False
    at = np.flatnonzero(inside)
    return at, mix(total[at])


def byte_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return table


# Letters, digits and everything beyond ASCII; A-Z lower-cased.
WORD = byte_table(bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
# Everything but ASCII white space.
SOLID = ~byte_table(b" \t\n\v\f\r")
NEWLINE = byte_table(b"\n")


def heads(data: np.ndarray) -> np.ndarray:
    """Mask of the bytes that begin a code point."""
    return (data & 0xC0) != 0x80


def words_of(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words: hashes, starts, ends, and per row the index of its first word."""
    starts, ends, first = block.spans(WORD[block.data])
    return hashes(LOWER[block.data], starts, ends), starts, ends, first
