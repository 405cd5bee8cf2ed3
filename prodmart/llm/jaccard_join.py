"""Near duplicates: Jaccard self-join over word shingles with Bayesian candidate pruning.

Texts with the same words are one copy class and are compared once. Classes get MinHash values of their
shingles of five words; classes that agree in all values of some band are candidates. The MinHash
values of a candidate pair are compared a few at a time: with m agreements of n, the posterior of the
similarity under a uniform prior is Beta(m + 1, n - m + 1), and the pair is dropped as soon as P(similarity >=
threshold) falls below the tolerance. Pairs that stay are verified exactly on their shingle sets.

Large groups are never gathered: a group is cut into blocks by the hash of its members, every pair of
blocks is compared in a task of its own, and tasks return one row per member (its number of links and a
spanning star), never the pairs. The cost of counting all links of a group of different texts still
grows with the pairs in it; copies cost nothing, as they share a class.

Defined results: a text without words has no shingles, so it is alone and has no link; a text of fewer than five words
is one shingle; a null id takes part like any other, and ids of classes ignore it; an id may
stand with several texts, as classes are told apart by `class_hash` and not by their ids; repeated rows are
copies of each other; a result column replaces an input column of its name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .components import components
from .frames import Inner, map_batches, written
from .textscan import Block, blocks, grams, mix, powers, words_of

SIGNED = T.StructType([
    T.StructField("node", T.BinaryType()), T.StructField("sign", T.BinaryType()),
])
BANDED = T.StructType([
    T.StructField("node", T.BinaryType()), T.StructField("key", T.LongType()), T.StructField("band", T.IntegerType()),
])


@dataclass(frozen=True)
class Join:
    """bands * rows MinHash values. A pair at the threshold shares no band with probability (1 - 0.8^5)^40 = 1e-7.

    tolerance: posterior probability below which a pair is dropped; step: values compared at a time; block: members
    of a group that one task compares with each other.
    """

    threshold: float = 0.8
    shingle: int = 5
    bands: int = 40
    rows: int = 5
    tolerance: float = 1e-9
    step: int = 25
    block: int = 256

    @property
    def values(self) -> int:
        return self.bands * self.rows


def tail(threshold: float, m: int, n: int) -> float:
    """P(s >= threshold) for s ~ Beta(m + 1, n - m + 1), as a binomial sum."""
    return sum(math.comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(m + 1))


@cache
def least_matches(join: Join) -> dict[int, int]:
    """After n values, the fewest agreements with which a pair stays."""
    return {
        n: next(m for m in range(n + 1) if tail(join.threshold, m, n) >= join.tolerance)
        for n in [*range(join.step, join.values, join.step), join.values]
    }


@cache
def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[n:] >> np.uint64(32)).astype(np.uint32)


def shingles_of(block: Block, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes row after row, the index of each row's first, and word hashes with each row's first."""
    words, _, _, first = words_of(block)
    at, value = grams(words, first, size)
    count = np.diff(first)
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        low, _ = sequence_hash(words, first)
        value = np.concatenate([value, mix(low[few])])
        at = np.concatenate([at, first[few]])
        order = np.argsort(at, kind="stable")
        at, value = at[order], value[order]
    return value, np.searchsorted(at, first), words, first


def sequence_hash(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's whole word sequence."""
    power, inverse = powers(len(words) + 1)
    made = []
    for x in (words, mix(words ^ np.uint64(0xA5A5A5A5A5A5A5A5))):
        total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(x * power[: len(words)], out=total[1:])
        made.append(mix((total[first[1:]] - total[first[:-1]]) * inverse[first[:-1]] + np.diff(first).astype(np.uint64)))
    return made[0], made[1]


def sign_block(block: Block, join: Join) -> tuple[list[bytes | None], list[bytes | None]]:
    """Per row: the id of its word sequence and its MinHash values, 16 bits each; None for rows without words."""
    value, at, words, first = shingles_of(block, join.shingle)
    a, b = sequence_hash(words, first)
    raw = np.stack([a, b], axis=1).astype(">u8").tobytes()
    some = np.flatnonzero(np.diff(at) > 0)
    node: list[bytes | None] = [None] * block.rows
    sign: list[bytes | None] = [None] * block.rows
    if len(some):
        x = (value >> np.uint64(32)).astype(np.uint32)
        starts, buffer = at[some], np.empty(len(x), np.uint32)
        minima = np.empty((len(some), join.values), np.uint32)
        for j, (times, flip) in enumerate(zip(*_multipliers(join.values))):
            np.multiply(x, times, out=buffer)
            np.bitwise_xor(buffer, flip, out=buffer)
            minima[:, j] = np.minimum.reduceat(buffer, starts)
        # the low half of the smallest value is as good as random; the high half is near 0
        short = (minima & np.uint32(0xFFFF)).astype(np.uint16)
        for i, r in enumerate(some):
            node[r], sign[r] = raw[16 * r : 16 * r + 16], short[i].tobytes()
    return node, sign


def sign(docs: DataFrame, text: str, join: Join) -> DataFrame:
    """Add `node` and `sign`; the text is dropped."""
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, signs = [], []
            for block in blocks(batch.column(batch.schema.names.index(text))):
                a, b = sign_block(block, join)
                node += a
                signs += b
            made = [pa.array(node, pa.binary()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, *made], [*kept, "node", "sign"])

    return map_batches(docs, run, T.StructType([*docs.select(*kept).schema.fields, *SIGNED.fields]))


def bands(classes: DataFrame, join: Join) -> DataFrame:
    """One row per class and band: the key that equal bands share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = _matrix(batch.column(1), join).reshape(batch.num_rows, join.bands, join.rows).astype(np.uint64)
            for band in range(join.bands):
                key = np.full(batch.num_rows, band + 1, np.uint64)
                for j in range(join.rows):
                    key = mix(key * np.uint64(0x100000001B3) + signs[:, band, j])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(key.view(np.int64)), pa.array(np.full(batch.num_rows, band, np.int32))],
                    ["node", "key", "band"],
                )

    return map_batches(classes.select("node", "sign"), run, BANDED)


def _matrix(signs: pa.Array, join: Join) -> np.ndarray:
    return np.frombuffer(b"".join(signs.to_pylist()), np.uint16).reshape(len(signs), join.values)


def staying(signs: np.ndarray, i: np.ndarray, j: np.ndarray, join: Join) -> np.ndarray:
    """Which pairs the Bayesian test keeps: after every step those too unlikely to reach the threshold go."""
    alive, agree, done = np.arange(len(i)), np.zeros(len(i), np.int64), 0
    for n, least in least_matches(join).items():
        agree = agree + (signs[i[alive], done:n] == signs[j[alive], done:n]).sum(axis=1)
        stay = agree >= least
        alive, agree, done = alive[stay], agree[stay], n
    return alive


def first_band(signs: np.ndarray, i: np.ndarray, j: np.ndarray, join: Join) -> np.ndarray:
    """The first band in which pairs agree; -1 for none."""
    same = (signs[i] == signs[j]).reshape(len(i), join.bands, join.rows).all(axis=2)
    return np.where(same.any(axis=1), same.argmax(axis=1), -1)


class Sets:
    """Disjoint sets of row numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def blocked(members: DataFrame, key: list[str], size: str, block: int) -> DataFrame:
    """Deal the members of each key to tasks that compare one block with another (`lo` <= `hi`).

    A key of up to `block` members is one task's. A larger one has size / block blocks by the hash of the member,
    and each member goes to every pair of blocks that has its own.
    """
    n = F.ceil(F.col(size) / block)
    parted = members.withColumn("_n", n).withColumn("part", F.pmod(F.xxhash64("node"), F.col("_n")))
    dealt = parted.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    dealt = dealt.withColumns({"lo": F.least("part", "_other"), "hi": F.greatest("part", "_other")}).drop("_n", "_other", size)
    order = [*key, "lo", "hi"]
    return dealt.repartition(*order).sortWithinPartitions(*order, "node")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that hold whole runs of equal keys, with the number of the run of each row."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        edge = np.zeros(batch.num_rows, bool)
        for name in keys:
            column = batch.column(name)
            edge[1:] |= np.asarray(pc.not_equal(column[1:], column[:-1]).fill_null(True))
        cuts = np.flatnonzero(edge)
        same = bool(held) and all(held[-1].column(k)[-1] == batch.column(k)[0] for k in keys)
        if held and not same:
            yield _numbered(held, keys)
            held = []
        if len(cuts):
            held.append(batch.slice(0, cuts[-1]))
            yield _numbered(held, keys)
            held = [batch.slice(cuts[-1])]
        else:
            held.append(batch)
    if held:
        yield _numbered(held, keys)


def _numbered(held: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.RecordBatch, np.ndarray]:
    batch = pa.concat_batches(held) if len(held) > 1 else held[0]
    edge = np.zeros(batch.num_rows, bool)
    for name in keys:
        column = batch.column(name)
        edge[1:] |= np.asarray(pc.not_equal(column[1:], column[:-1]).fill_null(True))
    return batch, np.cumsum(edge)


def pairs(run: np.ndarray, part: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a run that its two blocks have to compare, a diagonal at a time."""
    for d in range(1, int(np.bincount(run).max()) if len(run) else 0):
        i = np.flatnonzero(run[d:] == run[:-d])
        if not len(i):
            return
        j = i + d
        keep = (lo[i] == hi[i]) | (part[i] != part[j])
        if keep.any():
            yield i[keep], j[keep]


def candidate_edges(members: DataFrame, join: Join) -> DataFrame:
    """Spanning stars (a, b) of the pairs that share a band and pass the Bayesian test."""
    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, number in runs(batches, ["key", "lo", "hi"]):
            signs, node = _matrix(batch.column("sign"), join), batch.column("node").to_pylist()
            band = batch.column("band").to_numpy()
            sets = Sets(batch.num_rows)
            for i, j in pairs(number, *(batch.column(c).to_numpy() for c in ("part", "lo", "hi"))):
                stay = staying(signs, i, j, join)
                i, j = i[stay], j[stay]
                once = first_band(signs, i, j, join) == band[i]  # other bands need not link the pair again
                for a, b in zip(i[once].tolist(), j[once].tolist()):
                    sets.join(a, b)
            linked = [(i, sets.root(i)) for i in range(batch.num_rows) if sets.up[i] != i]
            if linked:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node[i] for i, _ in linked], pa.binary()), pa.array([node[r] for _, r in linked], pa.binary())],
                    ["a", "b"],
                )

    dealt = blocked(members, ["key"], "n", join.block)
    return map_batches(dealt.select("key", "lo", "hi", "part", "band", "node", "sign"), run, schema)


def with_shingles(rows: DataFrame, join: Join) -> DataFrame:
    """Replace `_text` by `shingles`, the sorted distinct hashes, 8 bytes each."""
    kept = [c for c in rows.columns if c != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for block in blocks(batch.column("_text")):
                value, at, _, _ = shingles_of(block, join.shingle)
                made += [np.unique(value[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(made, pa.binary())], [*kept, "shingles"])

    return map_batches(rows, run, T.StructType([*rows.select(*kept).schema.fields, T.StructField("shingles", T.BinaryType())]))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    same = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return same / (len(a) + len(b) - same)


def verified(members: DataFrame, join: Join) -> DataFrame:
    """Per member of a group and pair of blocks: its exact number of links there, and the root of a spanning star."""
    schema = T.StructType([
        T.StructField("node", T.BinaryType()), T.StructField("links", T.LongType()), T.StructField("root", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, number in runs(batches, ["group", "lo", "hi"]):
            signs, node = _matrix(batch.column("sign"), join), batch.column("node").to_pylist()
            sets, links = Sets(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            shingles = batch.column("shingles")
            size = pc.binary_length(shingles).to_numpy() // 8
            values = [np.frombuffer(x.as_buffer(), np.uint64) for x in shingles]
            for i, j in pairs(number, *(batch.column(c).to_numpy() for c in ("part", "lo", "hi"))):
                near = np.minimum(size[i], size[j]) >= join.threshold * np.maximum(size[i], size[j]) - 1e-9
                i, j = i[near], j[near]
                stay = staying(signs, i, j, join)
                i, j = i[stay], j[stay]
                for a, b in zip(i.tolist(), j.tolist()):
                    if jaccard(values[a], values[b]) >= join.threshold - 1e-12:
                        links[[a, b]] += 1
                        sets.join(a, b)
            has = np.flatnonzero(links)
            if len(has):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node[i] for i in has], pa.binary()), pa.array(links[has]),
                        pa.array([node[sets.root(i)] for i in has], pa.binary()),
                    ],
                    ["node", "links", "root"],
                )

    dealt = blocked(members, ["group"], "n", join.block)
    return map_batches(dealt.select("group", "lo", "hi", "part", "node", "sign", "shingles"), run, schema)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", join: Join | None = None) -> DataFrame:
    """One row per input row: `doc_id`, `class_id` (least id of its class: all rows that links and copies connect),
    `class_hash` (the class itself, as ids may be null or repeat: the least hash of its word sequences, null for a text
    without words), `copy_id` (least id of the rows with the same words), `n_copies`, `n_links` (other word sequences
    whose similarity reaches the threshold, counted once each), `row_hash` of the text and `alone` (without words)."""
    join = join or Join()
    inner = Inner(docs)
    rows = inner.df.select(F.col(inner[doc_id]).alias("id"), inner.text(text).alias("_text"))
    rows = rows.withColumn("hash", F.xxhash64("_text"))
    signed = written(sign(rows, "_text", join), "signed")
    classes = written(
        signed.filter("node is not null").groupBy("node").agg(
            F.first("sign").alias("sign"), F.min("id").alias("copy_id"), F.count("*").alias("n_copies"),
            F.min(F.struct("hash", "id")).alias("pick"),
        ),
        "classes",
    )

    keyed = bands(classes, join)
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = keyed.join(shared, "key").join(classes.select("node", "sign"), "node")
    groups = components(candidate_edges(members, join), F.col("a"), F.col("b")).withColumnRenamed("root", "group")
    groups = written(groups, "groups")
    sizes = groups.groupBy("group").agg(F.count("*").alias("n"))

    picked = groups.join(sizes, "group").join(classes.select("node", "sign", "pick.*"), "node")
    texts = rows.withColumnsRenamed({"id": "_id", "hash": "_hash"})
    picked = picked.join(texts, (F.col("hash") == F.col("_hash")) & F.col("id").eqNullSafe(F.col("_id")))
    picked = with_shingles(picked.select("node", "group", "n", "sign", "_text"), join).dropDuplicates(["node"])
    links = written(verified(picked, join), "links")
    counted = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    roots = components(links, F.col("node"), F.col("root"))

    nodes = classes.select("node", "copy_id", "n_copies").join(counted, "node", "left").join(roots, "node", "left")
    nodes = written(nodes.withColumn("root", F.coalesce("root", "node")), "nodes")
    heads = nodes.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    nodes = nodes.join(heads, "root").select("node", "root", "class_id", "copy_id", "n_copies", "n_links")
    alone = F.col("node").isNull()
    return signed.select("id", "hash", "node").join(nodes, "node", "left").select(
        F.col("id").alias(doc_id),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("root").alias("class_hash"),
        F.col("hash").alias("row_hash"),
        alone.alias("alone"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", join: Join | None = None) -> DataFrame:
    """One document of each class, the one with the least id (null last), with the input's columns.

    Documents without words are classes of their own, so all of them stay.
    """
    inner = Inner(docs)
    found = near_duplicates(docs, doc_id, text, join)
    chosen = (
        found.filter("not alone").groupBy("class_hash")
        .agg(F.min(F.struct(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("id"), "row_hash")).alias("pick"))
        .select("pick.id", "pick.row_hash", F.lit(False).alias("alone"))
    )
    lone = found.filter("alone").select(F.col(doc_id).alias("id"), "row_hash", F.lit(True).alias("alone")).distinct()
    chosen = written(chosen.union(lone), "chosen")
    rows = inner.df.withColumn("_hash", F.xxhash64(inner.text(text)))
    same = (F.col("_hash") == F.col("row_hash")) & F.col(inner[doc_id]).eqNullSafe(F.col("id"))
    kept = rows.join(chosen, same)
    once = kept.filter("not alone").dropDuplicates(["id", "_hash"])
    return inner.outer(once.select(*inner.kept).union(kept.filter("alone").select(*inner.kept)))
