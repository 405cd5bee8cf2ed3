"""Keyed append: the first row of a key wins, stored rows are never touched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schema import MAX_LENGTH

MAX_KEYS = 10_000


def first_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key by `order` (add a unique tail to `order` for a reproducible choice).

    The rank filter is planned as a group limit on both sides of the shuffle, so a key that
    holds a large share of the rows leaves every map task as a single row.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def append_new(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Rows to append: first of each incoming key, unless the key is stored already.

    Of the stored table only the key columns are read. They are first reduced to the keys that
    occur in the input: an anti join cannot build on its left side, so a small batch would
    otherwise shuffle every stored key; the semi join lets Spark broadcast the batch's distinct
    keys when they are small. First-wins and the anti join share one shuffle of the input.
    """
    fresh = first_wins(incoming, keys, order)
    known = existing.select(*keys).join(incoming.select(*keys).distinct(), keys, "left_semi")
    return fresh.join(known, keys, "left_anti").select(*incoming.columns)


def rows_to_compare(stored: DataFrame, incoming: DataFrame, key: str, limit: int = MAX_KEYS) -> DataFrame:
    """The stored rows that can have a key of the input.

    The keys of a small input, at most `limit`, become a filter on the scan, which asks the statistics and Bloom filters of
    the stored row groups (`write_table` with `index`) and reads only those that may hold one. For a larger input all
    stored rows are returned, as nearly every row group would be read anyway; the join decides in both cases.
    """
    keys = [r[0] for r in incoming.select(key).distinct().limit(limit + 1).collect()]
    return stored if len(keys) > limit else stored.where(F.col(key).isin(keys))


def load_rules(columns: list[str]) -> dict[str, Column]:
    """What the raw table accepts: a key, a name, and texts within their declared length."""
    rules = {f"{c}_missing": F.col(c).isNotNull() for c in ("code", "product_name") if c in columns}
    for name, size in MAX_LENGTH.items():
        if name in columns:
            rules[f"{name}_too_long"] = F.char_length(F.col(name)) <= size
    return rules


def flag_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add `reject_reason`: names of the broken rules, NULL for a good row. An undecided rule counts as kept."""
    broken = [F.when(~ok, F.lit(name)) for name, ok in rules.items()]
    reason = F.concat_ws(",", *broken)
    return df.withColumn("reject_reason", F.when(reason != "", reason))


def validate_rows(df: DataFrame, rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """`(good, rejected)`; bad rows are set aside with the reason instead of failing the batch."""
    flagged = flag_rows(df, load_rules(df.columns) if rules is None else rules)
    good = flagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, flagged.where(F.col("reject_reason").isNotNull())
