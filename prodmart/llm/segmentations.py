"""SentencePiece encoding with several segmentations of each text, and decoding.

The k segmentations are a sample without replacement, drawn by perturbed A* search over the lattice (Gumbel top-k):
the root's key is a Gumbel variable; the best child of a node inherits its key, and its siblings get Gumbel keys
truncated at it, located at the log probability of their subtree. Taking the open subtree with the greatest key
again and again emits distinct segmentations in the order of their keys. With the (k + 1)-th key as the
threshold, a segmentation of log probability l has the inclusion probability 1 - exp(-exp(l - threshold)), which is
returned as its logarithm.

All random numbers are hashes of the row's key, so a row gives the same segmentations wherever it is computed; its scores
agree up to the last bits. A subtree
whose log probability is 45 below that of its path's root wins with a chance of about e^-40, less than that of
a collision of the hashes; such siblings are not drawn.

Defined results: a null or empty text has one segmentation, the empty one; a text with fewer than k segmentations
gives all of them, with inclusion probability 1; every other text is read whole, and decoding any segmentation gives it
back byte for byte; rows with equal keys and texts get equal samples; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .frames import Inner, add_columns, map_batches
from .piece_lattice import Lattices, Vocabulary, lattices, vocabulary
from .textscan import Block, blocks, mix
from .tokenizers import TOKENIZERS, file_bytes

MODEL = "piece_bpe_32k.model"
BLOCK = 1 << 18
DEPTH = 45.0
SAMPLE = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("log_prob", T.DoubleType()),
    T.StructField("key", T.DoubleType()), T.StructField("log_inclusion", T.DoubleType()),
])
SAMPLES = T.StructField("samples", T.ArrayType(SAMPLE))


def uniform(seed: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on the seed and the number alone."""
    bits = mix(seed + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def gumbel(seed: np.ndarray, number: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(uniform(seed, number)))


@dataclass
class Path:
    """A segmentation of each of some rows: edges in order, and per row the index of its first edge. `fresh` is where in
    the row the edges begin that no earlier path has; `base` is the log probability before them."""

    rows: np.ndarray
    edge: np.ndarray
    at: np.ndarray
    fresh: np.ndarray
    base: np.ndarray
    key: np.ndarray


def walk(lat: Lattices, token: np.ndarray, seed: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Draw a segmentation of each token: (edges in token order, number of edges per token).

    Each token has a random sequence of its own, begun by its seed and number; all tokens advance together.
    """
    live, node = np.arange(len(token)), lat.start[token]
    count = np.zeros(len(token), np.int64)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    state = mix(seed + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    while len(live):
        edge = lat.offset[node]
        u = (state >> np.uint64(11)).astype(np.float64) * 2.0**-53
        # the last edge of a node has the sum 2, so the search ends there
        open_ = np.flatnonzero(u > lat.upto[edge])
        while len(open_):
            e = edge[open_] + 1
            edge[open_] = e
            open_ = open_[u[open_] > lat.upto[e]]
        steps.append((live, edge))
        node = lat.to[edge]
        on = np.flatnonzero(node >= 0)
        count[live] += 1
        live, node, state = live[on], node[on], state[on] * np.uint64(6364136223846793005) + np.uint64(1442695040888963407)
    begin = np.cumsum(count) - count
    out = np.empty(int(count.sum()), np.int64)
    for s, (who, edge) in enumerate(steps):
        out[begin[who] + s] = edge
    return out, count


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each, one after the other."""
    total = int(counts.sum())
    begin = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(begin - starts, counts)


def sums_before(values: np.ndarray, size: np.ndarray, narrow: int = 512) -> np.ndarray:
    """Sum of the values before each value within its row; the same for a row whatever stands beside it."""
    out = np.empty(len(values))
    begin = np.cumsum(size) - size
    rows = np.flatnonzero((size > 0) & (size <= narrow))
    if len(rows):
        at = ragged(begin[rows], size[rows])
        row = np.repeat(np.arange(len(rows)), size[rows])
        square = np.zeros((len(rows), int(size[rows].max()) + 1))
        square[row, at - begin[rows][row] + 1] = values[at]
        out[at] = np.cumsum(square, axis=1)[row, at - begin[rows][row]]
    for r in np.flatnonzero(size > narrow):
        part = values[begin[r] : begin[r] + size[r]]
        out[begin[r] : begin[r] + size[r]] = np.concatenate([[0.0], np.cumsum(part)[:-1]])
    return out


class Search:
    """The A* search of all rows of a block at once."""

    def __init__(self, block: Block, seed: np.ndarray, words: Vocabulary, k: int):
        self.lat, self.k, self.seed, self.rows = lattices(block, words), k, seed, block.rows
        self.open: list[list[tuple[float, int, int, int, float]]] = [[] for _ in range(block.rows)]
        self.paths: list[Path] = []
        self.place: list[dict[int, int]] = []  # row -> its place in the path

    def tokens(self, rows: np.ndarray, begin: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Draw the tokens of rows from the begin-th on: (edges, number of edges per row)."""
        counts = self.lat.first[rows + 1] - self.lat.first[rows] - begin
        which = ragged(self.lat.first[rows] + begin, counts)
        seed = np.repeat(mix(self.seed[rows] + np.uint64(number + 1)), counts)
        edges, steps = walk(self.lat, self.lat.token[which], seed, which - np.repeat(self.lat.first[rows], counts))
        total = np.concatenate([[0], np.cumsum(steps)])
        bound = np.concatenate([[0], np.cumsum(counts)])
        return edges, total[bound[1:]] - total[bound[:-1]]

    def add(self, path: Path) -> None:
        """Put the siblings along the fresh part of a path into the rows' queues."""
        lat, number = self.lat, len(self.paths)
        self.paths.append(path)
        self.place.append({int(r): i for i, r in enumerate(path.rows)})
        n, left = len(path.rows), np.diff(path.at) - path.fresh
        size, start = np.minimum(left, 128), path.at[:-1] + path.fresh
        going = np.arange(n)
        while True:  # as far as the subtrees are not hopeless, mostly some dozen edges
            drop = np.concatenate([[0.0], np.cumsum(lat.log_p[path.edge[ragged(start[going], size[going])]])])
            end = np.cumsum(size[going])
            going = going[(drop[end] - drop[end - size[going]] >= -DEPTH) & (size[going] < left[going])]
            if not len(going):
                break
            size[going] = np.minimum(left[going], 4 * size[going])
        row, slot = np.repeat(np.arange(n), size), ragged(start, size)
        prefix = sums_before(lat.log_p[path.edge[slot]], size)
        wanted = np.flatnonzero(prefix >= -DEPTH)
        slot, row, prefix = slot[wanted], row[wanted], prefix[wanted] + path.base[row[wanted]]
        node = lat.origin[path.edge[slot]]
        degree = lat.offset[node + 1] - lat.offset[node]
        edge = ragged(lat.offset[node], degree)
        which = np.repeat(np.arange(len(slot)), degree)
        other = edge != path.edge[slot[which]]
        edge, which = edge[other], which[other]
        if not len(edge):
            return
        who, here = row[which], slot[which] - path.at[row[which]]
        # one random number per sibling of the path: its step and its edge's place in the node
        draw = here.astype(np.uint64) * np.uint64(64) + (edge - lat.offset[node[which]]).astype(np.uint64)
        seed = mix(self.seed[path.rows[who]] + np.uint64(1000 + number))
        mass = prefix[which] + lat.log_p[edge]
        value = mass + gumbel(seed, draw)
        begin = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        group, rest, best = np.cumsum(np.append(False, who[1:] != who[:-1])), value.copy(), []
        for _ in range(self.k):  # more of one path are never taken, but for the threshold
            top = np.flatnonzero((rest == np.maximum.reduceat(rest, begin)[group]) & (rest > -np.inf))
            best.append(top)
            rest[top] = -np.inf
        best = np.concatenate(best)
        key = -np.logaddexp(-path.key[who[best]], -value[best])  # truncated at the path's own key
        found = path.rows[who[best]], key, here[best], edge[best], mass[best]
        for r, x, step, e, m in zip(*(f.tolist() for f in found)):
            heapq.heappush(self.open[r], (-x, number, step, e, m))

    def branch(self, taken: list[tuple[int, float, int, int, int, float]]) -> Path:
        """New paths: each leaves an old path of its row at a step by another edge and goes on at random."""
        lat, number = self.lat, len(self.paths)
        rows = np.array([r for r, *_ in taken])
        # the rest of the token that the new edge is in
        edge, steps = np.array([t[4] for t in taken]), np.array([t[3] for t in taken])
        chunks, live, draw = [[e] for e in edge.tolist()], np.flatnonzero(lat.to[edge] >= 0), 0
        while len(live):
            node = lat.to[edge[live]]
            u = uniform(self.seed[rows[live]] ^ np.uint64(number + 7), draw + (steps[live] << 10))
            e = lat.offset[node]
            open_ = np.flatnonzero(u > lat.upto[e])
            while len(open_):
                e[open_] += 1
                open_ = open_[u[open_] > lat.upto[e[open_]]]
            for i, x in zip(live.tolist(), e.tolist()):
                chunks[i].append(x)
            edge[live] = e
            live, draw = live[lat.to[e] >= 0], draw + 1
        kept: list[np.ndarray] = []
        begin = np.empty(len(taken), np.int64)
        for i, (r, _, old, step, _, _) in enumerate(taken):
            path = self.paths[old]
            start = int(path.at[self.place[old][r]])
            # the token that the step is in: as many tokens as edges before it that end a chunk
            before = path.edge[start : start + step]
            begin[i] = int((lat.to[before] < 0).sum()) + 1
            kept.append(np.concatenate([before, np.array(chunks[i])]))
        later, counts = self.tokens(rows, begin, number)
        bound = np.concatenate([[0], np.cumsum(counts)])
        parts = [x for i in range(len(taken)) for x in (kept[i], later[bound[i] : bound[i + 1]])]
        size = np.array([len(kept[i]) for i in range(len(taken))]) + counts
        return Path(
            rows, np.concatenate(parts), np.concatenate([[0], np.cumsum(size)]), np.array([t[3] + 1 for t in taken]),
            np.array([t[5] for t in taken]), np.array([t[1] for t in taken]),
        )

    def run(self) -> np.ndarray:
        """Draw up to k paths of every row; returns the (k + 1)-th key of each, -inf where there is none."""
        rows = np.arange(self.rows)
        edges, counts = self.tokens(rows, np.zeros(self.rows, np.int64), 0)
        root = gumbel(mix(self.seed + np.uint64(77)), np.zeros(self.rows))
        self.add(Path(rows, edges, np.concatenate([[0], np.cumsum(counts)]), np.zeros(self.rows, np.int64), np.zeros(self.rows), root))
        for _ in range(1, self.k):
            taken = [(r, -q[0][0], *q[0][1:]) for r, q in enumerate(self.open) if q]
            for r, *_ in taken:
                heapq.heappop(self.open[r])
            if not taken:
                break
            self.add(self.branch(taken))
        return np.array([-q[0][0] if q else -np.inf for q in self.open])


def segment_block(block: Block, seed: np.ndarray, words: Vocabulary, k: int) -> pa.Array:
    """The samples of each row, as an Arrow array of the type SAMPLES."""
    search = Search(block, seed, words, k)
    threshold = search.run()
    lat = search.lat
    rows = np.concatenate([p.rows for p in search.paths])
    order = np.lexsort((np.repeat(np.arange(len(search.paths)), [len(p.rows) for p in search.paths]), rows))
    log_prob, key, size = [], [], []
    for p in search.paths:
        sums = np.add.reduceat(np.append(lat.log_p[p.edge], 0.0), p.at[:-1])
        log_prob.append(np.where(np.diff(p.at) > 0, sums, 0.0))
        key.append(p.key)
        size.append(np.diff(p.at))
    log_prob, key, size = (np.concatenate(x)[order] for x in (log_prob, key, size))
    begin = np.concatenate([p.at[:-1] + b for p, b in zip(search.paths, np.cumsum([0] + [len(p.edge) for p in search.paths]))])
    ids = lat.ids[np.concatenate([p.edge for p in search.paths])][ragged(begin[order], size)]
    x = log_prob - threshold[rows[order]]
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        inclusion = np.where(np.isposinf(x), 0.0, np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.minimum(x, 700))))))
    struct = pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(ids)),
            pa.array(log_prob), pa.array(key), pa.array(inclusion),
        ],
        ["ids", "log_prob", "key", "log_inclusion"],
    )
    bound = np.searchsorted(rows[order], np.arange(block.rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bound), struct)


def sample_segmentations(
    docs: DataFrame, k: int = 3, row_key: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS
) -> DataFrame:
    """The input's columns with `samples`: up to k distinct segmentations (ids, log_prob, key, log_inclusion), greatest key
    first. A result column replaces an input column of its name."""
    inner, rows = _sampled(docs, k, row_key, text, tokenizers, None)
    return inner.with_results(rows, ["samples"])


def segmentations_only(
    docs: DataFrame, keep: list[str], k: int = 3, row_key: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS
) -> DataFrame:
    """As `sample_segmentations` with only some input columns, so that texts are not carried along."""
    inner, rows = _sampled(docs, k, row_key, text, tokenizers, keep)
    return rows.select(*(F.col(inner[c]).alias(c) for c in keep), "samples")


def _sampled(docs: DataFrame, k: int, row_key: str, text: str, tokenizers: str, keep: list[str] | None) -> tuple[Inner, DataFrame]:
    inner = Inner(docs)
    model = docs.sparkSession.sparkContext.broadcast(file_bytes(f"{tokenizers}/{MODEL}"))
    rows = inner.df.withColumns({"_text": inner.text(text), "_seed": F.xxhash64(F.col(inner[row_key]).cast("string"))})
    kept = inner.kept if keep is None else [inner[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model.value)
        for batch in batches:
            seeds = batch.column("_seed").to_numpy().view(np.uint64)
            for block in blocks(batch.column("_text"), BLOCK):
                made = segment_block(block, seeds[block.first : block.first + block.rows], words, k)
                part = batch.slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), made], [*kept, "samples"])

    rows = rows.select(*kept, "_text", "_seed")
    return inner, map_batches(rows, run, T.StructType([*rows.select(*kept).schema.fields, SAMPLES]))


def decode(ids: list[int] | np.ndarray, words: Vocabulary) -> str:
    """The text of a segmentation."""
    return b"".join(words.surface[i] for i in ids)[1:].decode() if len(ids) else ""


def decode_column(df: DataFrame, ids: str, out: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    """Add the decoded text of a column of piece ids; null for null."""
    model = df.sparkSession.sparkContext.broadcast(file_bytes(f"{tokenizers}/{MODEL}"))

    def step(column: pa.Array) -> list[pa.Array]:
        words = vocabulary(model.value)
        return [pa.array([decode(x.as_py(), words) if x.is_valid else None for x in column], pa.string())]

    return add_columns(df, ids, [T.StructField(out, T.StringType())], step)
