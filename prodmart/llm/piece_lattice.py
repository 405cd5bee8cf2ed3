"""Segmentation lattices of many texts at once, over the pieces of a SentencePiece vocabulary.

A text is cut into chunks (a run of spaces with what follows it, or one character that no piece has); pieces
never cross chunks, so a text's lattice is its chunks' lattices in a row, and equal chunks share one. Nodes are byte
positions; edges are pieces, and for characters that are no piece themselves their single bytes.

A piece of rank r has weight 1 / (r + 1), a byte the weight of the last rank divided by e^2. Conditional
probabilities of the edges follow from the backward sums, so a walk that draws edges by them is an exact sample.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from .textscan import Block, span_hasher
from .tokenizers import pieces

SPACE = 0x20
SHORT = 64
SCALE = 4.0


@dataclass(frozen=True)
class Vocabulary:
    """Double-array trie of the pieces' bytes, with "▁" as a space: child = base[state] + byte, if check[child] is state."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray  # id of the piece that ends in a state, or -1
    score: np.ndarray  # log weight by id
    weight: np.ndarray  # exp(score + SCALE * size) by id
    size: np.ndarray  # bytes of each piece
    byte_id: np.ndarray  # id of each byte's own piece
    surface: tuple[bytes, ...]
    lonely: np.ndarray  # bytes below 128 that no piece has


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    names = pieces(model)
    byte_id = np.full(256, -1)
    surface: list[bytes] = []
    for i, name in enumerate(names):
        if len(name) == 6 and name.startswith("<0x"):
            byte_id[int(name[3:5], 16)] = i
            surface.append(bytes([int(name[3:5], 16)]))
        else:
            surface.append(b"" if name in ("<unk>", "<s>", "</s>") else name.replace("▁", " ").encode())
    if (byte_id < 0).any():
        raise ValueError("the vocabulary has no piece for every byte")
    first = int(byte_id.max()) + 1
    score = np.full(len(names), -np.log(len(names) - first + 1) - 2.0)
    score[first:] = -np.log(np.arange(len(names) - first) + 1.0)
    usable = {s: i for i, s in enumerate(surface) if i >= first and s}
    base, check, piece = _trie(usable)
    used = np.zeros(256, bool)
    used[np.frombuffer(b"".join(usable), np.uint8)] = True
    size = np.array([len(x) for x in surface])
    weight = np.exp(score + SCALE * size)
    return Vocabulary(base, check, piece, score, weight, size, byte_id, tuple(surface), ~used & (np.arange(256) < 128))


def _trie(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    children: list[dict[int, int]] = [{}]
    ends = {}
    for word, i in words.items():
        at = 0
        for c in word:
            if c not in children[at]:
                children[at][c] = len(children)
                children.append({})
            at = children[at][c]
        ends[at] = i
    size = 2 * len(children) + 1024
    base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken = bytearray(size)
    slot = {0: 0}
    taken[0] = 1
    check[0] = -2
    free, queue = 1, [0]
    for node in queue:
        kids = sorted(children[node].items())
        if not kids:
            continue
        low, b = kids[0][0], 0
        at = free
        while True:
            at = taken.index(0, at)
            b = at - low
            if b > 0 and not any(taken[b + c] for c, _ in kids):
                break
            at += 1
        base[slot[node]] = b
        for c, kid in kids:
            taken[b + c] = 1
            check[b + c] = slot[node]
            slot[kid] = b + c
            if kid in ends:
                piece[b + c] = ends[kid]
            queue.append(kid)
        free = taken.index(0, free)
    return base, check, piece


@dataclass
class Lattices:
    """The lattices of a block. A text is tokens[t] for t in first[row] .. first[row + 1]; a token is a distinct chunk, whose
    first node is start[chunk]. Node i has the edges offset[i] .. offset[i + 1], each with a piece id, the node it
    leads to (-1: the chunk ends), the node it is from (origin), its log probability, and the sum of probabilities up
    to it in its node (2 for the last)."""

    token: np.ndarray
    first: np.ndarray
    start: np.ndarray
    offset: np.ndarray
    ids: np.ndarray
    to: np.ndarray
    log_p: np.ndarray
    upto: np.ndarray
    origin: np.ndarray


def lattices(block: Block, words: Vocabulary) -> Lattices:
    # a space goes before every text that is not empty
    filled = np.flatnonzero(np.diff(block.at) > 0)
    data = np.insert(block.data, block.at[filled], SPACE) if len(filled) else np.zeros(0, np.uint8)
    added = np.zeros(block.rows + 1, np.int64)
    added[filled + 1] = 1
    at = block.at + np.cumsum(added)

    space, lonely = data == SPACE, words.lonely[data]
    begins = lonely.copy()
    begins[1:] |= (space[1:] & ~space[:-1]) | lonely[:-1]
    begins[at[:-1][filled]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data))
    first = np.searchsorted(starts, at)
    _, sample, token = np.unique(span_hasher(data)(starts, ends), return_index=True, return_inverse=True)

    # the distinct chunks' bytes, one after the other
    size = ends[sample] - starts[sample]
    start = np.concatenate([[0], np.cumsum(size)])
    n = int(start[-1])
    position = np.arange(n)
    chunk_end = np.repeat(start[1:], size)
    text = data[position + np.repeat(starts[sample] - start[:-1], size)]

    # pieces from every code point on, a byte further each round
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    degree = np.zeros(n, np.int64)
    head = (text & 0xC0) != 0x80
    width = np.where(text < 0x80, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
    whole = np.zeros(n, bool)  # the code point is a piece
    live = np.flatnonzero(head)
    state, length = np.zeros(len(live), np.int32), 0
    while len(live):
        child = words.base[state] + text[live + length]
        length += 1
        go = words.check[child] == state
        live, state = live[go], child[go]
        ids = words.piece[state]
        hit = ids >= 0
        where = live[hit]
        found.append((where, where + length, ids[hit], degree[where]))
        degree[where] += 1
        whole[where[width[where] == length]] = True
        more = live + length < chunk_end[live]
        live, state = live[more], state[more]
    # a code point that is no piece is spelled in bytes
    lead = np.maximum.accumulate(np.where(head, position, 0))
    spelled = np.flatnonzero(~whole[lead])
    found.append((spelled, spelled + 1, words.byte_id[text[spelled]], degree[spelled]))
    degree[spelled] += 1

    offset = np.concatenate([[0], np.cumsum(degree)])
    ids, to = np.empty(offset[-1], np.int32), np.empty(offset[-1], np.int64)
    for where, target, piece, rank in found:
        slot = offset[where] + rank
        ids[slot], to[slot] = piece, np.where(target == chunk_end[where], -1, target)

    # Backward sums, nodes with equally many bytes to the end of their chunk together. They are kept as exp(sum + SCALE *
    # bytes), which neither overflows nor vanishes in chunks of up to SHORT bytes; longer ones are done in logarithms.
    left = chunk_end - position
    longest = int(left.max()) if n else 0
    order = np.argsort(left.astype(np.int16) if longest < 1 << 15 else left, kind="stable")
    origin = np.repeat(position, degree)
    score = words.score[ids]
    weight = words.weight[ids]
    total = np.ones(n + 1)  # total[-1]: the end of a chunk
    beta = np.zeros(n + 1)
    short = np.repeat(size <= SHORT, size)
    order = order[degree[order] > 0]
    for plain in (True, False):
        # the nodes in this order, their edges side by side
        nodes = order[short[order] == plain]
        bounds = np.searchsorted(left[nodes], np.arange(1, longest + 2))
        begin = np.concatenate([[0], np.cumsum(degree[nodes])])
        edge = np.arange(begin[-1]) + np.repeat(offset[nodes] - begin[:-1], degree[nodes])
        value, target, known = (weight if plain else score)[edge], to[edge], total if plain else beta
        for r in np.flatnonzero(np.diff(bounds)):
            a, b = bounds[r], bounds[r + 1]
            here = slice(begin[a], begin[b])
            at_node = begin[a:b] - begin[a]
            if plain:
                known[nodes[a:b]] = np.add.reduceat(value[here] * known[target[here]], at_node)
            else:
                known[nodes[a:b]] = np.logaddexp.reduceat(value[here] + known[target[here]], at_node)
    p = weight * total[to] / total[origin]
    wide = np.flatnonzero(~short[origin])
    p[wide] = np.exp(score[wide] + beta[to[wide]] - beta[origin[wide]])
    upto = p.copy()  # summed node by node, so that it does not depend on what else the block holds
    many = np.flatnonzero(degree > 1)
    e, rest = offset[many], degree[many]
    while len(e):
        e, rest = e + 1, rest - 1
        upto[e] += upto[e - 1]
        e, rest = e[rest > 1], rest[rest > 1]
    upto[offset[1:][degree > 0] - 1] = 2.0
    log_p = np.log(p)
    log_p[wide] = score[wide] + beta[to[wide]] - beta[origin[wide]]
    return Lattices(token, first, start[:-1], offset, ids, to, log_p, upto, origin)
