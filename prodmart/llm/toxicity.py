"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has the probability sigmoid(bias + sum of its feature weights),
and the document is toxic unless every sentence is clean: p = 1 - prod(1 - p_s) (noisy-or). Features are the
lower-cased words and the first 4, 5 and 6 bytes of longer words, so inflected forms share weight. Only document
labels are needed to fit the weights; the fitted sentence probabilities locate what offends.

Defined results: a null or empty text has no sentence and scores the least a document can, 0; an empty
label table gives a model that scores every sentence alike; rows repeat as they come; a result column
replaces an input column of its name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .frames import Inner, add_columns
from .textscan import LOWER, WORD, Block, blocks, byte_table, heads, mix, span_hasher

STOPS = byte_table(b".!?\n")
PREFIXES = (4, 5, 6)
SPAN = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
RESULTS = [
    T.StructField("toxicity", T.DoubleType()), T.StructField("n_sentences", T.LongType()), T.StructField("offending", T.ArrayType(SPAN)),
]


@dataclass(frozen=True)
class ToxicityModel:
    """Feature hashes in ascending order with their weights; at most `max_features` of them."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


@dataclass(frozen=True)
class Fit:
    """sample: about how many labelled documents are used; max_features bounds the model that is sent to the tasks.

    screen: the least log-likelihood ratio (G) by which a feature's share of toxic documents exceeds that of all. At a
    share of 13 % that takes 4 purely toxic documents, at 50 % it takes 12, and at 1 % one document never does.
    """

    sample: int = 4000
    min_docs: int = 4
    screen: float = 16.0
    max_features: int = 20000
    steps: int = 300
    rate: float = 0.15
    shrink: float = 3e-5


def sentences_of(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sentences with at least one word: starts, ends, row; and for each feature its hash and its sentence."""
    word_at, word_end, _ = block.spans(WORD[block.data])
    starts, ends, _ = block.pieces(STOPS[block.data])
    none = np.zeros(0, np.int64)
    if not len(word_at):
        return none, none, none, none.astype(np.uint64), none
    of = np.searchsorted(starts, word_at, "right") - 1
    fresh = np.append(True, of[1:] != of[:-1])
    sentence = np.cumsum(fresh) - 1
    used = of[fresh]
    row = np.searchsorted(block.at, word_at[fresh], "right") - 1
    hash_of = span_hasher(LOWER[block.data])
    features, where = [hash_of(word_at, word_end)], [sentence]
    for size in PREFIXES:
        longer = np.flatnonzero(word_end - word_at > size)
        features.append(hash_of(word_at[longer], word_at[longer] + size, seed=size))
        where.append(sentence[longer])
    return starts[used], ends[used], row, np.concatenate(features), np.concatenate(where)


def look_up(known: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which features are known (ascending), and where."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    maybe = np.zeros(1 << 16, bool)  # the top bits rule out most features before the search
    maybe[(known >> np.uint64(48)).astype(np.int64)] = True
    likely = np.flatnonzero(maybe[(features >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(known, features[likely]), len(known) - 1)
    hit = known[at] == features[likely]
    return likely[hit], at[hit]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -z))


def _log_clean(z: np.ndarray) -> np.ndarray:
    """log(1 - sigmoid(z))"""
    return -np.logaddexp(0.0, z)


def excess(toxic: np.ndarray, n: np.ndarray, share: float) -> np.ndarray:
    """Log-likelihood ratio (G) of `toxic` of `n` documents against the share of all; negative where there are fewer."""
    clean = n - toxic  # a count of 0 adds nothing
    g = 2 * (toxic * np.log(np.maximum(toxic, 1) / (n * share)) + clean * np.log(np.maximum(clean, 1) / (n * (1 - share))))
    return np.where(toxic > n * share, g, -g)


def fit_toxicity(samples: list[tuple[str, int]], fit: Fit | None = None) -> ToxicityModel:
    """Fit from (text, label) pairs: gradient ascent on the noisy-or likelihood of the document labels.

    Features in fewer than `min_docs` documents, and those that pass no screen, are left out; the pull `shrink`
    moves weights towards 0. Without both labels every sentence gets the same probability.
    """
    fit = fit or Fit()
    label = np.array([y for _, y in samples], float)
    if not len(label) or label.min() == label.max():
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 0.0 if len(label) and label[0] else -20.0)
    texts = pa.array([t for t, _ in samples], pa.string())

    seen, doc_seen = [], []  # each feature once a document
    for block in blocks(texts):
        _, _, row, features, of = sentences_of(block)
        found, at = np.unique(mix(features) ^ row[of].astype(np.uint64), return_index=True)
        seen.append(features[at])
        doc_seen.append(row[of[at]] + block.first)
    vocabulary, feature = np.unique(np.concatenate(seen), return_inverse=True)
    n_docs = np.bincount(feature, minlength=len(vocabulary))
    share = label.mean()
    toxic = np.bincount(feature, label[np.concatenate(doc_seen)], minlength=len(vocabulary))
    ratio = excess(toxic, n_docs, share)
    fits = np.flatnonzero((n_docs >= fit.min_docs) & (ratio >= fit.screen))
    chosen = vocabulary[np.sort(fits[np.argsort(-ratio[fits], kind="stable")[: fit.max_features]])]
    del seen, doc_seen, vocabulary, feature

    cell_sentence, cell, doc_of, n_sent = [], [], [], 0
    for block in blocks(texts):
        _, _, row, features, of = sentences_of(block)
        hit, at = look_up(chosen, features)
        cell_sentence.append(of[hit] + n_sent)
        cell.append(at)
        doc_of.append(row + block.first)
        n_sent += len(row)
    cell_sentence, cell, doc_of = (np.concatenate(x) for x in (cell_sentence, cell, doc_of))

    weights, bias = np.zeros(len(chosen)), -4.0 - np.log(max(n_sent, 1) / len(label))
    moment, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, fit.steps + 1):
        z = bias + np.bincount(cell_sentence, weights[cell], minlength=n_sent)
        clean = np.bincount(doc_of, _log_clean(z), minlength=len(label))  # log P(document is clean)
        p = np.clip(-np.expm1(clean), 1e-9, 1.0)
        pull = (label[doc_of] * np.exp(clean[doc_of]) / p[doc_of] - (1 - label[doc_of])) * sigmoid(z)
        grad = np.append(np.bincount(cell, pull[cell_sentence], minlength=len(chosen)), pull.sum()) / len(label)
        grad[:-1] -= fit.shrink * weights
        moment = 0.9 * moment + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        move = fit.rate * (moment / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights + move[:-1], bias + move[-1]
    return ToxicityModel(chosen, weights, float(bias))


def score_block(block: Block, model: ToxicityModel, limit: float) -> tuple[np.ndarray, np.ndarray, list]:
    """Per row: score, number of sentences, offending sentences as code point spans with their scores."""
    starts, ends, row, features, of = sentences_of(block)
    z = np.full(len(starts), model.bias)
    hit, at = look_up(model.features, features)
    z += np.bincount(of[hit], model.weights[at], minlength=len(starts))
    score = -np.expm1(np.bincount(row, _log_clean(z), minlength=block.rows))
    p = sigmoid(z)
    spans: list = [[] for _ in range(block.rows)]
    bad = np.flatnonzero(p >= limit)
    if len(bad):
        point = np.zeros(len(block.data) + 1, np.int64)
        np.cumsum(heads(block.data), out=point[1:])
        for s in bad:
            base = point[block.at[row[s]]]
            spans[row[s]].append({"begin": int(point[starts[s]] - base), "end": int(point[ends[s]] - base), "score": float(p[s])})
    return score, np.bincount(row, minlength=block.rows), spans


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", sentence_limit: float = 0.5) -> DataFrame:
    """The input with `toxicity` (0 to 1), `n_sentences` and `offending` (begin, end, score of each sentence at or
    over `sentence_limit`; code points, the whole text is read)."""
    inner = Inner(docs)

    def step(texts: pa.Array) -> list[pa.Array]:
        parts = [score_block(b, model, sentence_limit) for b in blocks(texts)]
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return [
            pa.array(np.concatenate([p[0] for p in parts]) if parts else np.zeros(0)),
            pa.array(np.concatenate([p[1] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)),
            pa.array([s for p in parts for s in p[2]], span),
        ]

    scored = add_columns(inner.df.withColumn("_text", inner.text(text)), "_text", RESULTS, step)
    return inner.with_results(scored.drop("_text"), [f.name for f in RESULTS])


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents that score below the limit, with the input's columns."""
    inner = Inner(docs)
    scored = score_toxicity(inner.df.withColumn("_text", inner.text(text)), model, "_text")
    return inner.outer(scored.filter(F.col("toxicity") < limit))
