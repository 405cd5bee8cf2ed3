"""Runs of words that repeat with a period, and texts with the repeats taken out.

A run is a stretch of words with smallest period q (words q apart are identical) that is at least `min_words` and
`min_periods` * q long and that no neighbouring word extends. Enumeration goes over a harmonic grid: for each q the
places 0, q, 2q, ... of a text. A run of three periods holds at least two neighbouring places of its grid, so
extending each place against the next finds it; over all q that are n * (1 + 1/2 + 1/3 + ...) pairs, most of which differ
in their first word. Extensions come from a difference cover (`cover_lce`); the beginning of a run is found by bisection
with the same forward extensions, as words before the first grid place agree up to it or not at all. A stretch found
for several q counts with the least.

Texts are handled in blocks of about `BLOCK_WORDS` words, a longer text alone, and grid pairs in slices, so memory
follows the longest text of a batch. Words are compared by numbers given in their block, so nothing is left to hashing.

Defined results: words are what stands between ASCII white space; a null or empty text has no runs and becomes empty;
repeated rows are handled each on its own; an empty table gives an empty result; a result column replaces an
input column of its name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .cover_lce import CoverLce
from .frames import Inner, add_columns

BLOCK_WORDS = 1 << 16
PAIRS = 1 << 20

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(RUN, False)),
    T.StructField("collapsed", T.StringType()),
]


@dataclass(frozen=True)
class RunRules:
    min_words: int = 24
    min_periods: int = 3

    def __post_init__(self) -> None:
        if self.min_periods < 3:
            raise ValueError("the grid finds runs of three periods or more")


@dataclass
class Runs:
    """Runs of one block by text, start and period; starts count from the text's first word."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _slices(counts: np.ndarray, limit: int) -> Iterator[slice]:
    """Consecutive slices whose counts sum to about `limit`; one larger count is a slice of its own."""
    upto = np.cumsum(counts)
    at = 0
    while at < len(counts):
        base = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, base + limit, "right")))
        yield slice(at, end)
        at = end


def _numbered(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts 2, 3: owners 0 0 1 1 1 and numbers 0 1 0 1 2."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def find_runs(words: np.ndarray, at: np.ndarray, rules: RunRules | None = None) -> Runs:
    """Runs of all texts of a block: `words` are numbers from 1, text i is words[at[i]:at[i + 1]]."""
    rules = rules or RunRules()
    lce = CoverLce(words)
    sizes = np.diff(at)
    periods = np.where(sizes >= rules.min_words, sizes // rules.min_periods, 0)
    text, period = _numbered(periods)
    period = period + 1
    # Enough words must agree from a run's first grid place on, which lies less than a period behind its start.
    need = np.maximum(rules.min_words - 2 * period, (rules.min_periods - 2) * period) + 1
    places = np.maximum((sizes[text] - period - need) // period + 1, 0)
    found = [np.zeros((0, 4), np.int64)]
    for part in _slices(places, PAIRS):
        owner, place = _numbered(places[part])
        t, q, least = text[part][owner], period[part][owner], need[part][owner]
        found.append(_runs_on_grid(lce, words, at, t, q, at[t] + place * q, least, rules))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)  # by text, start, length, period: the first of a stretch has its smallest period
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return Runs(rows[:, 0], rows[:, 1] - at[rows[:, 0]], rows[:, 2], rows[:, 3])


def _runs_on_grid(
    lce: CoverLce, words: np.ndarray, at: np.ndarray, text: np.ndarray, period: np.ndarray, place: np.ndarray,
    need: np.ndarray, rules: RunRules,
) -> np.ndarray:
    """(text, start, length, period) of the runs whose first grid place is among the given ones; starts are block places."""

    def keep(mask: np.ndarray) -> None:
        nonlocal text, period, place, need
        text, period, place, need = text[mask], period[mask], place[mask], need[mask]

    keep(words[place] == words[place + period])
    for k in (1, 2, 3):  # cheap looks before any extension; `need` is at least 9 words
        keep(words[place + k] == words[place + k + period])
    reach = lce.extend(place, place + period, at[text + 1] - place - period)
    long = reach >= need
    reach = reach[long]
    keep(long)
    # not the first place of its run when the place before agrees with this one for a whole period
    before = place - period
    inner = np.flatnonzero(before >= at[text])
    first = np.ones(len(place), bool)
    first[inner] = lce.extend(before[inner], place[inner], period[inner]) < period[inner]
    reach = reach[first]
    keep(first)
    low, high = np.maximum(place - period + 1, at[text]), place.copy()  # the start lies in low..high
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        middle = (low[open_] + high[open_]) // 2
        ahead = place[open_] - middle
        joined = lce.extend(middle, middle + period[open_], ahead) >= ahead
        high[open_[joined]] = middle[joined]
        low[open_[~joined]] = middle[~joined] + 1
    length = place + period + reach - low
    enough = length >= np.maximum(rules.min_words, rules.min_periods * period)
    return np.stack([text, low, length, period], axis=1)[enough]


def _blocks(texts: pa.Array) -> Iterator[tuple[list[list[bytes]], np.ndarray, np.ndarray]]:
    """Some texts at a time: their words, the words' numbers in the block from 1, and where each text begins."""
    split: list[list[bytes]] = []
    numbers: dict[bytes, int] = defaultdict(count(1).__next__)
    coded: list[np.ndarray] = []
    total = 0
    for value in texts:
        words = value.as_buffer().to_pybytes().split() if value.is_valid else []
        split.append(words)
        coded.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        total += len(words)
        if total >= BLOCK_WORDS:
            yield _block(split, coded)
            split, numbers, coded, total = [], defaultdict(count(1).__next__), [], 0
    if split:
        yield _block(split, coded)


def _block(split: list[list[bytes]], coded: list[np.ndarray]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    at = np.zeros(len(split) + 1, np.int64)
    np.cumsum([len(words) for words in split], out=at[1:])
    return split, np.concatenate(coded), at


def _collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words that no run holds behind its first period, joined by one space."""
    if len(start):
        step = np.zeros(len(words) + 1, np.int64)
        np.add.at(step, start + period, 1)
        np.add.at(step, start + length, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)]
    return b" ".join(words)


def run_columns(texts: pa.Array, rules: RunRules) -> list[pa.Array]:
    """`n_words`, `runs` and `collapsed` of an Arrow column of texts."""
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    n_words, counts, found, collapsed = [], [], [], []
    for split, words, at in _blocks(texts):
        runs = find_runs(words, at, rules)
        bounds = np.searchsorted(runs.text, np.arange(len(split) + 1))
        for i, own in enumerate(split):
            part = slice(bounds[i], bounds[i + 1])
            collapsed.append(_collapsed(own, runs.start[part], runs.length[part], runs.period[part]).decode())
        n_words.append(np.diff(at))
        counts.append(np.diff(bounds))
        found.append(runs)

    def joined(parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    values = pa.StructArray.from_arrays(
        [pa.array(joined([getattr(r, name) for r in found])) for name in RUN.names], RUN.names
    )
    offsets = np.zeros(len(texts) + 1, np.int32)
    np.cumsum(joined(counts), out=offsets[1:])
    return [pa.array(joined(n_words)), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(collapsed, pa.string())]


def periodic_runs(docs: DataFrame, text: str = "text", rules: RunRules | None = None) -> DataFrame:
    """The input with `n_words`, `runs` (by start, then period) and `collapsed`, the text without repeats in runs.

    Every text is handled where it is read: nothing is shuffled.
    """
    rules = rules or RunRules()
    inner = Inner(docs)
    texts = inner.df.withColumn("_text", inner.text(text))
    found = add_columns(texts, "_text", FIELDS, lambda column: run_columns(column, rules))
    return inner.with_results(found.drop("_text"), [f.name for f in FIELDS])


def collapse_runs(docs: DataFrame, text: str = "text", rules: RunRules | None = None) -> DataFrame:
    """The input with its text replaced by the collapsed one where the text has runs, unchanged elsewhere."""
    rules = rules or RunRules()
    inner = Inner(docs)
    texts = inner.df.withColumn("_text", inner.text(text))
    found = add_columns(texts, "_text", FIELDS, lambda column: run_columns(column, rules))
    changed = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("_text"))
    return inner.outer(found.withColumn(inner[text], changed))
