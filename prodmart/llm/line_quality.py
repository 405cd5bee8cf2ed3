"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's potentials come from features of the line itself and of the lines
before and after it; transitions couple neighbouring labels. The document score is the length-weighted mean
of the lines' forward-backward marginals of "good", passed through a fitted increasing curve so that it reads
as a probability.

The field is fitted from document labels alone: the lines of a good document are good; in a bad document the
junk lines are found by expectation maximisation, starting from "all bad".

Defined results: a null or empty text is one empty line; an empty label table gives a field that knows
nothing and scores 0.5; rows repeat as they come; a result column replaces an input column of its name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .frames import Inner, add_columns
from .textscan import NEWLINE, SOLID, Block, blocks, byte_table, heads, mix, span_hasher

UPPER = byte_table(bytes(range(0x41, 0x5B)))
LETTER = byte_table(bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
DIGIT = byte_table(b"0123456789")
STOP = byte_table(b".!?")
SIGN = byte_table(b"#*$%&|<>{}[]=+_~^@\\/")
PIPE = byte_table(b"|")
BANG = byte_table(b"!")

# Upper bounds of the steps each line measure is cut into.
STEPS = {
    "words": [0, 1, 2, 4, 8, 16, 32, 64],
    "word_length": [2, 3, 4, 5, 6, 8, 12],
    "upper": [0.01, 0.03, 0.06, 0.12, 0.3, 0.6],
    "letters": [0.3, 0.6, 0.75, 0.85, 0.95],
    "digits": [0.0, 0.02, 0.1, 0.3],
    "stops": [0.0, 0.01, 0.02, 0.04, 0.08],
    "signs": [0.0, 0.01, 0.03, 0.08, 0.15, 0.3],
    "pipes": [0.0, 0.02, 0.05],
    "bangs": [0.0, 0.02, 0.05],
    "repeats": [0.0, 0.5, 1.5, 4.5],
    "echoes": [0.0, 0.02, 0.1, 0.3, 0.6],
}
WIDTH = sum(len(s) + 1 for s in STEPS.values()) + 2  # and first line, last line
RESULTS = [
    T.StructField("quality", T.DoubleType()), T.StructField("good_share", T.DoubleType()),
    T.StructField("n_lines", T.LongType()), T.StructField("n_bad_lines", T.LongType()),
]


@dataclass(frozen=True)
class LineField:
    """own, before, after: weight of each feature of the line and its neighbours for "good" over "bad";
    move[a, b]: weight of label b after label a (0 bad, 1 good); curve: slope and offset on the share's logit."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    move: np.ndarray
    curve: tuple[float, float]


@dataclass(frozen=True)
class Fit:
    """sample: about how many labelled documents are used."""

    sample: int = 4000
    rounds: int = 3
    steps: int = 50
    rate: float = 0.1
    shrink: float = 1e-3
    shrink_moves: float = 3e-2


@dataclass
class Lines:
    """Lines of some documents in order. active[i]: indices of the features that line i has."""

    active: np.ndarray
    weight: np.ndarray
    first: np.ndarray


def lines_of(block: Block) -> Lines:
    data = block.data
    starts, ends, first = block.pieces(NEWLINE[data])
    row = np.repeat(np.arange(block.rows), np.diff(first))

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[ends] - total[starts]

    solid = SOLID[data]
    hash_of = span_hasher(data)
    word_at, word_end, _ = block.spans(solid)
    line = np.searchsorted(starts, word_at, "right") - 1
    word = hash_of(word_at, word_end)
    words = np.bincount(line, minlength=len(starts))
    echoes = np.bincount(line[1:][(word[1:] == word[:-1]) & (line[1:] == line[:-1])], minlength=len(starts))
    head = heads(data)
    points = count(head & solid)
    letters = count(LETTER[data] & head)
    whole = np.maximum(points, 1)
    _, inverse, counts = np.unique(
        mix(hash_of(starts, ends) + mix(row.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True
    )
    measures = {
        "words": words, "word_length": points / np.maximum(words, 1), "upper": count(UPPER[data]) / np.maximum(letters, 1),
        "letters": letters / whole, "digits": count(DIGIT[data]) / whole, "stops": count(STOP[data]) / whole,
        "signs": count(SIGN[data]) / whole, "pipes": count(PIPE[data]) / whole, "bangs": count(BANG[data]) / whole,
        "repeats": np.where(points > 0, counts[inverse] - 1.0, 0.0), "echoes": echoes / np.maximum(words, 1),
    }
    active = np.empty((len(starts), len(STEPS) + 2), np.int32)
    offset = 0
    for i, (name, steps) in enumerate(STEPS.items()):
        active[:, i] = offset + np.searchsorted(steps, measures[name])
        offset += len(steps) + 1
    # the last two features hold only for a document's first and last line; elsewhere they point to a weight of 0
    active[:, -2:] = WIDTH
    active[first[:-1], -2] = offset
    active[first[1:] - 1, -1] = offset + 1
    return Lines(active, points + 1.0, first)


def emission(lines: Lines, own: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Score of "good" over "bad" per line."""
    pad = [np.append(w, 0.0)[lines.active].sum(axis=1) for w in (own, before, after)]
    score = pad[0]
    n = len(score)
    later = np.ones(n, bool)
    later[lines.first[:-1]] = False
    score[later] += pad[1][np.flatnonzero(later) - 1]
    sooner = np.ones(n, bool)
    sooner[lines.first[1:] - 1] = False
    score[sooner] += pad[2][np.flatnonzero(sooner) + 1]
    return score


def marginals(score: np.ndarray, move: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) per line, and the expected number of each label pair; all documents advance in step."""
    n, size = len(score), np.diff(first)
    unary = np.stack([np.zeros(n), score], axis=1)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    longest = np.argsort(-size, kind="stable")
    size, start = size[longest], first[:-1][longest]
    forward[start] = unary[start]
    lasts = start + size - 1
    for t in range(1, int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -t, "left"))  # documents with more than t lines
        at = start[:live] + t
        step = forward[at - 1][:, :, None] + move
        forward[at] = np.logaddexp(step[:, 0], step[:, 1]) + unary[at]
        forward[at] -= forward[at].max(axis=1, keepdims=True)
        at = lasts[:live] - t
        step = (backward[at + 1] + unary[at + 1])[:, None, :] + move
        backward[at] = np.logaddexp(step[:, :, 0], step[:, :, 1])
        backward[at] -= backward[at].max(axis=1, keepdims=True)
    both = forward + backward
    good = np.exp(-np.logaddexp(0.0, both[:, 0] - both[:, 1]))
    inner = np.ones(n, bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    pair = forward[at - 1][:, :, None] + move + (unary[at] + backward[at])[:, None, :]
    pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
    return good, (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def shares(lines: Lines, good: np.ndarray) -> np.ndarray:
    """Per document, the length-weighted mean of P(good)."""
    return np.add.reduceat(good * lines.weight, lines.first[:-1]) / np.add.reduceat(lines.weight, lines.first[:-1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_lines(samples: list[tuple[str, int]], fit: Fit | None = None) -> LineField:
    """Fit from (text, label) pairs, label 1 for good documents. Without both labels: the field that knows nothing."""
    fit = fit or Fit()
    zero = np.zeros(WIDTH)
    label = np.array([y for _, y in samples], float)
    if not len(label) or label.min() == label.max():
        return LineField(zero, zero, zero, np.zeros((2, 2)), (1.0, 0.0))
    parts = [lines_of(b) for b in blocks(pa.array([t for t, _ in samples], pa.string()))]
    starts = np.cumsum([0] + [len(p.weight) for p in parts])
    lines = Lines(
        np.concatenate([p.active for p in parts]), np.concatenate([p.weight for p in parts]),
        np.append(np.concatenate([p.first[:-1] + s for p, s in zip(parts, starts)]), starts[-1]),
    )
    n = len(lines.weight)
    size = np.diff(lines.first)
    of_doc = np.repeat(label, size)
    inner = np.ones(n, bool)
    inner[lines.first[:-1]] = False
    later = np.flatnonzero(inner)
    width = lines.active.shape[1]

    def gather(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.bincount(lines.active[rows].ravel(), np.repeat(x, width), minlength=WIDTH + 1)[:WIDTH]

    target = of_doc.copy()  # what each line is taken for
    w = np.zeros(3 * WIDTH + 4)
    shrink = np.append(np.full(3 * WIDTH, fit.shrink), np.full(4, fit.shrink_moves))
    # both labels weigh the same, so that the share of bad documents in the sample does not matter
    balance = np.where(of_doc > 0, 0.5 / max(of_doc.sum(), 1), 0.5 / max((1 - of_doc).sum(), 1)) * n
    for number in range(fit.rounds):
        moment, second = np.zeros_like(w), np.zeros_like(w)
        pairs = np.zeros((2, 2))
        a, b = target[later - 1], target[later]
        scale = balance[later]
        for i, x in enumerate((1 - a, a)):
            for j, y in enumerate((1 - b, b)):
                pairs[i, j] = (x * y * scale).sum()
        for step in range(1, fit.steps + 1):
            own, before, after, move = w[:WIDTH], w[WIDTH : 2 * WIDTH], w[2 * WIDTH : 3 * WIDTH], w[3 * WIDTH :].reshape(2, 2)
            good, expected = marginals(emission(lines, own, before, after), move, lines.first)
            miss = (target - good) * balance
            grad = np.concatenate([
                gather(miss, np.arange(n)), gather(miss[later], later - 1), gather(miss[later - 1], later),
                (pairs - expected * pairs.sum() / max(expected.sum(), 1e-9)).ravel(),
            ]) / n - shrink * w
            moment = 0.9 * moment + 0.1 * grad
            second = 0.99 * second + 0.01 * grad * grad
            w = w + fit.rate * (moment / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        field = LineField(w[:WIDTH], w[WIDTH : 2 * WIDTH], w[2 * WIDTH : 3 * WIDTH], w[3 * WIDTH :].reshape(2, 2), (1.0, 0.0))
        good, _ = marginals(emission(lines, field.own, field.before, field.after), field.move, lines.first)
        # the most suspicious line of a bad document stays bad
        worst = np.repeat(np.minimum.reduceat(good, lines.first[:-1]), size)
        target = np.where(of_doc > 0, 1.0, np.where(good <= worst, 0.0, good))

    x = _logit(shares(lines, good))
    slope, offset = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic curve through the labels
        p = np.exp(-np.logaddexp(0.0, -(slope * x + offset)))
        weight = p * (1 - p) + 1e-6
        g = np.array([((label - p) * x).sum(), (label - p).sum()]) - 1e-3 * np.array([slope - 1, offset])
        h = np.array([[(weight * x * x).sum(), (weight * x).sum()], [(weight * x).sum(), weight.sum()]]) + 1e-3 * np.eye(2)
        change = np.clip(np.linalg.solve(h, g), -2, 2)
        slope, offset = slope + change[0], offset + change[1]
    return LineField(field.own, field.before, field.after, field.move, (float(max(slope, 1e-3)), float(offset)))


def score_block(block: Block, field: LineField) -> list[np.ndarray]:
    """Per row: score, length-weighted share of good, lines, lines more likely bad."""
    lines = lines_of(block)
    good, _ = marginals(emission(lines, field.own, field.before, field.after), field.move, lines.first)
    share = shares(lines, good)
    slope, offset = field.curve
    score = np.exp(-np.logaddexp(0.0, -(slope * _logit(share) + offset)))
    return [score, share, np.diff(lines.first), np.add.reduceat((good < 0.5).astype(np.int64), lines.first[:-1])]


def score_quality(docs: DataFrame, field: LineField, text: str = "text") -> DataFrame:
    """The input with `quality` (0 to 1), `good_share`, `n_lines` and `n_bad_lines`; whole texts are read."""
    inner = Inner(docs)
    kinds = [np.float64, np.float64, np.int64, np.int64]

    def step(texts: pa.Array) -> list[pa.Array]:
        parts = [score_block(b, field) for b in blocks(texts)]
        return [
            pa.array(np.concatenate([p[i] for p in parts]).astype(kind) if parts else np.zeros(0, kind))
            for i, kind in enumerate(kinds)
        ]

    scored = add_columns(inner.df.withColumn("_text", inner.text(text)), "_text", RESULTS, step)
    return inner.with_results(scored.drop("_text"), [f.name for f in RESULTS])


def line_labels(text: str | None, field: LineField) -> list[tuple[str, float]]:
    """Each line of one text with its marginal probability of being good."""
    block = next(blocks(pa.array([text or ""], pa.string())))
    lines = lines_of(block)
    good, _ = marginals(emission(lines, field.own, field.before, field.after), field.move, lines.first)
    return list(zip((text or "").split("\n"), good.tolist()))
