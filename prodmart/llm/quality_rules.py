"""Quality rules with host verdicts.

Every text is measured; rules fail on the measures; each host's failure rates are shrunk towards the corpus
by an empirical beta prior, and a host whose shrunken rate of any rule is over `host_limit` is rejected with
all its documents.

Defined results: a null text has no words, so it fails the base rule; a null host is a host of its own;
repeated rows count once each; an empty table gives an empty result; a result column replaces an input
column of its name. Lines and windows are compared by 64-bit hashes within a text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .frames import Inner, add_columns, written
from .textscan import NEWLINE, SOLID, Block, blocks, byte_table, grams, hashes, heads, mix

WINDOW = 5
SYMBOLS = byte_table(b"#*$%&|<>")
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
FIELDS = [T.StructField(name, T.LongType()) for name in MEASURES]


@dataclass(frozen=True)
class Rules:
    """Percentages are of words, of word characters or of lines with a word."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbol_percent: int = 25
    max_dup_line_percent: int = 30
    host_limit: float = 0.5

    def failures(self) -> dict[str, Column]:
        def over(part: str, limit: int, whole: str) -> Column:
            return 100 * F.col(part) > limit * F.col(whole)

        return {
            "few_words": F.col("n_words") < self.min_words,
            "repeats": over("n_repeat_words", self.max_repeat_percent, "n_words"),
            "symbols": over("n_symbols", self.max_symbol_percent, "word_chars"),
            "dup_lines": over("n_dup_lines", self.max_dup_line_percent, "n_lines"),
        }


def _repeated_per_row(rows: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Per row, how many keys equal an earlier key of the row."""
    _, index = np.unique(mix(keys + mix(rows.astype(np.uint64) + np.uint64(1))), return_index=True)
    return np.bincount(rows, minlength=n) - np.bincount(rows[index], minlength=n)


def measure_block(block: Block) -> list[np.ndarray]:
    data, n = block.data, block.rows
    solid = SOLID[data]
    starts, ends, first = block.spans(solid)
    n_words = np.diff(first)

    line_at, line_end, _ = block.pieces(NEWLINE[data])
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(solid, out=filled[1:])
    with_word = filled[line_end] > filled[line_at]
    line_at, line_end = line_at[with_word], line_end[with_word]
    line_row = np.searchsorted(block.at, line_at, "right") - 1
    n_lines = np.bincount(line_row, minlength=n)
    n_dup = _repeated_per_row(line_row, hashes(data, line_at, line_end), n)

    words = hashes(data, starts, ends)
    at, windows = grams(words, first, WINDOW)
    row = np.searchsorted(first, at, "right") - 1
    _, inverse, counts = np.unique(
        mix(windows + mix(row.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True
    )
    again = at[counts[inverse] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    inside = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.cumsum(cover[:-1]) > 0, out=inside[1:])
    n_repeat = inside[first[1:]] - inside[first[:-1]]
    return [n_words, block.sums(solid & heads(data)), block.sums(SYMBOLS[data]), n_lines, n_dup, n_repeat]


def measure(texts: pa.Array) -> list[pa.Array]:
    parts = [measure_block(b) for b in blocks(texts)]
    return [
        pa.array(np.concatenate([p[i] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64))
        for i in range(len(MEASURES))
    ]


def measured(docs: DataFrame, text: str, host: str, rules: Rules) -> tuple[Inner, DataFrame]:
    """Measures and `base_failed` beside the input's columns."""
    inner = Inner(docs)
    texts = inner.df.withColumns({"_text": inner.text(text), "_host": F.coalesce(inner.text(host), F.lit("\0"))})
    fails = rules.failures()
    return inner, add_columns(texts, "_text", FIELDS, measure).drop("_text").withColumn(
        "base_failed", fails["few_words"] | fails["repeats"]
    )


def host_rates(rows: DataFrame, rules: Rules) -> DataFrame:
    """Per host: documents, failures of each rule, rates shrunk by the prior, and `host_rejected`.

    The prior of a rule is Beta(m * k, (1 - m) * k): m is the rule's rate over all documents, and k follows from
    how much the hosts' rates vary beyond chance (method of moments, weighted by documents).
    """
    fails = rules.failures()
    hosts = written(
        rows.groupBy("_host").agg(
            F.count("*").alias("n_docs"), *(F.sum(c.cast("long")).alias(f"n_{name}") for name, c in fails.items())
        ),
        "hosts",
    )
    n = F.col("n_docs")
    sums = hosts.agg(
        F.count("*").alias("hosts"), F.sum(n).alias("docs"),
        *(F.sum(f"n_{name}").alias(f"f_{name}") for name in fails),
        *(F.sum(F.col(f"n_{name}") * F.col(f"n_{name}") / n).alias(f"s_{name}") for name in fails),
    ).first()
    shrunk = {}
    for name in fails:
        mean, strength = prior(sums["hosts"], sums["docs"], sums[f"f_{name}"], sums[f"s_{name}"])
        shrunk[f"rate_{name}"] = (F.col(f"n_{name}") + F.lit(mean * strength)) / (n + F.lit(strength))
    rejected = F.greatest(*(F.col(c) for c in shrunk)) > rules.host_limit
    return hosts.withColumns(shrunk).withColumn("host_rejected", rejected)


def prior(hosts: int, docs: int | None, failed: int | None, squares: float | None) -> tuple[float, float]:
    """(mean, strength) of the beta prior; squares: sum over hosts of failures squared over documents."""
    if not docs:
        return 0.0, 1.0
    mean = failed / docs
    chance = mean * (1 - mean)
    between = max((squares / docs - mean * mean) - chance * hosts / docs, 0.0)
    return mean, min(max(chance / between - 1, 1.0), 1e6) if between > 0 else 1e6


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", rules: Rules | None = None) -> DataFrame:
    """The input with its measures, `base_failed`, `host_rejected` and `kept`.

    Texts are measured once for the host counts and once for the result, so no text is shuffled or stored; the
    hosts come back by a join whose small side Spark broadcasts when its size allows and whose heavy hosts
    it splits otherwise.
    """
    rules = rules or Rules()
    inner, rows = measured(docs, text, host, rules)
    return inner.with_results(_verdicts(rows, rows, rules), [*MEASURES, "base_failed", "host_rejected", "kept"])


def _verdicts(rows: DataFrame, counted: DataFrame, rules: Rules) -> DataFrame:
    hosts = host_rates(counted, rules).select("_host", "host_rejected")
    return rows.join(hosts, "_host", "left").withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def quality_measures(docs: DataFrame, keep: list[str], text: str = "text", host: str = "source",
                     rules: Rules | None = None) -> DataFrame:
    """As `quality_rules`, with only the named input columns; texts are measured once and the numbers stored."""
    rules = rules or Rules()
    inner, rows = measured(docs, text, host, rules)
    stored = written(rows.select(*(inner[c] for c in keep), "_host", *MEASURES, "base_failed"), "measures")
    found = _verdicts(stored, stored, rules)
    results = [*MEASURES, "base_failed", "host_rejected", "kept"]
    return found.select(*(F.col(inner[c]).alias(c) for c in keep), *results)


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", rules: Rules | None = None) -> DataFrame:
    """The documents the rules keep, with the input's columns."""
    rules = rules or Rules()
    inner, rows = measured(docs, text, host, rules)
    return inner.outer(_verdicts(rows, rows, rules).filter("kept"))
