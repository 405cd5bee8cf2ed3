"""Benchmark decontamination by winnowing.

Words of `documents` and `benchmark` texts are hashed, k consecutive words make a gram, and of every `w`
consecutive grams the one with the smallest hash is kept (the rightmost of equals). Two texts that share
k + w - 1 words share one of those grams, so joining the kept grams finds every sufficiently long shared
span. Hits are then extended word by word to the whole shared span, by comparing the words themselves.

A window is `window` consecutive words of an item, and k + w - 1 equals it; an item of fewer words, but not
none, is one window, and for each such length m every gram of m words is kept (k = m, w = 1).

Defined results: null and empty texts have no words and no hits; rows that repeat give a row each; item ids
that repeat count once; a null item id counts with the id's text "null"; an empty benchmark leaves every
document clean; a result column replaces an input column of its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .frames import Inner, map_batches, written
from .textscan import blocks, grams, words_of

WINDOW = 10
GRAM = 5
# Fixed value: a word.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_PATTERN = re.compile(WORDS)
LOWER_AZ = {c: c + 32 for c in range(0x41, 0x5B)}

RESULTS = [
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("spans", T.ArrayType(
        T.StructType([T.StructField("item", T.StringType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    )),
]


def words(text: str | None) -> list[str]:
    return WORD_PATTERN.findall((text or "").translate(LOWER_AZ))


def winnow(at: np.ndarray, value: np.ndarray, row: np.ndarray, w: int) -> np.ndarray:
    """Indices of the grams that are smallest in some window of w consecutive grams of their row, the rightmost of equals.

    A row with fewer than w grams has no full window, so none of its grams is of use.
    """
    n = len(value)
    if w == 1 or n < w:
        return np.arange(n if w == 1 else 0)
    best = np.arange(n - w + 1)  # running minimum with its index
    low = value[: n - w + 1].copy()
    for j in range(1, w):
        other = value[j : n - w + 1 + j]
        take = other <= low
        low[take] = other[take]
        best[take] = np.flatnonzero(take) + j
    return np.unique(best[row[: n - w + 1] == row[w - 1 :]])


def _prints(texts: pa.Array, ids: pa.Array, lengths: tuple[int, ...], window: int, k: int) -> Iterator[pa.RecordBatch]:
    """Kept grams of a batch: (row id, length of the grams, hash, position of the gram's first word)."""
    for block in blocks(texts):
        hashed, _, _, first = words_of(block)
        for m in (0, *lengths):  # 0: winnowed grams, which hold for windows of full length
            at, value = grams(hashed, first, m or k)
            row = np.searchsorted(first, at, "right") - 1
            kept = winnow(at, value, row, 1 if m else window - k + 1)
            where = row[kept]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(where + block.first)), pa.array(np.full(len(kept), m, np.int32)),
                    pa.array(value[kept].view(np.int64)), pa.array((at[kept] - first[where]).astype(np.int32)),
                ],
                ["_row", "m", "gram", "pos"],
            )


def fingerprints(rows: DataFrame, lengths: tuple[int, ...], window: int, k: int) -> DataFrame:
    """Kept grams of `rows` (_row, _text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _prints(batch.column(1), batch.column(0), lengths, window, k)

    return map_batches(rows.select("_row", "_text"), run, T.StructType([
        T.StructField("_row", T.LongType()), T.StructField("m", T.IntegerType()),
        T.StructField("gram", T.LongType()), T.StructField("pos", T.IntegerType()),
    ]))


def extend(doc: list[str], item: list[str], hits: list[tuple[int, int]], window: int) -> list[tuple[int, int]]:
    """Word spans of `doc` that windows of `item` cover. hits: positions of equal grams in doc and item."""
    least = min(window, len(item))
    done: dict[int, int] = {}  # diagonal -> end of the last span on it
    spans = []
    for p, q in sorted(hits):
        if p < done.get(p - q, 0):
            continue
        a, b = p, q
        while a and b and doc[a - 1] == item[b - 1]:
            a, b = a - 1, b - 1
        end, other = p, q
        while end < len(doc) and other < len(item) and doc[end] == item[other]:
            end, other = end + 1, other + 1
        done[p - q] = max(end, p + 1)
        if end - a >= least:
            spans.append((a, end))
    return spans


def contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, k: int = GRAM,
) -> DataFrame:
    """The documents with `n_words`, `n_hit` (words inside any occurrence of a benchmark window) and `spans`
    (item id as text, first word, word after the last; one per item and shared span).

    Only grams, positions and the words of matched items are shuffled besides the texts, which travel at most
    once, when the matched documents are too many to broadcast. Spark picks the joins by measured size and
    splits heavy keys, such as a passage that a third of the documents hold. Items with the same words
    are matched once.
    """
    inner, rows = _rows(docs, text)
    items, lengths = _items(benchmark, item_id, item_text, window)
    marks = fingerprints(items.select(F.col("item").alias("_row"), F.col("words").alias("_text")), lengths, window, k)
    marks = marks.select("m", "gram", F.col("_row").alias("item"), F.col("pos").alias("item_pos"))
    found = fingerprints(rows, lengths, window, k).join(marks, ["m", "gram"])
    matched = (
        found.groupBy("_row", "item").agg(F.collect_set(F.struct("pos", "item_pos")).alias("hits"))
        .join(items.select("item", "words", "ids"), "item")
        .groupBy("_row").agg(F.collect_list(F.struct("words", "ids", "hits")).alias("_matches"))
    )
    matched = written(matched, "matches")
    joined = rows.join(matched, "_row", "left")
    checked = map_batches(joined, _checker(joined.columns, window), T.StructType([*rows.schema.fields, *RESULTS]))
    return inner.with_results(checked, [f.name for f in RESULTS])


def _rows(docs: DataFrame, text: str) -> tuple[Inner, DataFrame]:
    inner = Inner(docs)
    # Rows with the same text share their matches. Equal hashes of different texts do no harm, as
    # every match is checked against the text.
    return inner, inner.df.withColumn("_text", inner.text(text)).withColumn("_row", F.xxhash64("_text"))


def _items(benchmark: DataFrame, item_id: str, item_text: str, window: int) -> tuple[DataFrame, tuple[int, ...]]:
    """Distinct word sequences with their item ids, and the lengths below a full window that occur."""
    lower = F.translate(F.col(item_text).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    listed = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"),
        F.array_join(F.regexp_extract_all(lower, F.lit(WORDS), F.lit(0)), " ").alias("words"),
    )
    kept = listed.filter(F.length("words") > 0).groupBy("words").agg(F.collect_set("id").alias("ids"))
    items = written(kept.withColumn("item", F.xxhash64("words")).withColumn("n", F.size(F.split("words", " "))), "items")
    short = items.filter(F.col("n") < window).select("n").distinct().collect()  # fewer than `window` numbers
    return items, tuple(sorted(r.n for r in short))


def _checker(columns: list[str], window: int):  # noqa: ANN202
    kept = [c for c in columns if c != "_matches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(columns.index("_text"))
            matches = batch.column(columns.index("_matches"))
            n_words = [np.diff(words_of(b)[3]) for b in blocks(texts)]
            n_hit = np.zeros(batch.num_rows, np.int64)
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(np.asarray(matches.is_valid())):
                doc = words(texts[i].as_py())
                inside = np.zeros(len(doc) + 1, np.int64)
                for match in matches[i].as_py():
                    hits = [(h["pos"], h["item_pos"]) for h in match["hits"]]
                    for begin, end in extend(doc, match["words"].split(" "), hits, window):
                        inside[begin] += 1
                        inside[end] -= 1
                        spans[i] += [{"item": x, "begin": begin, "end": end} for x in match["ids"]]
                n_hit[i] = int((np.cumsum(inside[:-1]) > 0).sum())
            made = [
                pa.array(np.concatenate(n_words) if n_words else np.zeros(0, np.int64), pa.int64()), pa.array(n_hit),
                pa.array(spans, pa.list_(pa.struct([("item", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))),
            ]
            keep = [batch.column(columns.index(c)) for c in kept]
            order = [c for c in kept if c != "_row"]
            yield pa.RecordBatch.from_arrays([*keep, *made], [*kept, *(f.name for f in RESULTS)]).select(
                [*order, "_row", *(f.name for f in RESULTS)]
            )

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no benchmark window, with the input's columns."""
    inner = Inner(docs)
    checked = contaminated(inner.df.withColumn("_body", inner.text(text)), benchmark, "_body")
    return inner.outer(checked.filter(F.col("n_hit") == 0))
