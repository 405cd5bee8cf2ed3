"""Tag lists stored as text (`['en:a', 'fr:b']` or `["en:a","fr:b"]`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .literals import parse_array

EMPTY_LIST = "[]"


def has_tags(col: Column) -> Column:
    return col.isNotNull() & (col != EMPTY_LIST)


def empty_list_to_null(col: Column) -> Column:
    return F.when(col != EMPTY_LIST, col)


def first_tag(col: Column) -> Column:
    """First element without brackets and quotes; blanks inside it stay."""
    head = F.split_part(F.translate(col, "[]", ""), F.lit(","), F.lit(1))
    return F.trim(F.translate(head, "\"'", ""))


def clean_tag_list(col: Column) -> Column:
    """The list text without brackets, quotes and blanks."""
    return F.translate(col, "[]'\" ", "")


def split_tags(col: Column, mode: str = "legacy") -> Column:
    """Elements of a tag list.

    `legacy` splits the text on every comma, also inside a quoted tag, and removes all blanks;
    `array` reads the literal, so tags keep commas, quotes and inner blanks.
    """
    if mode == "legacy":
        return F.split(clean_tag_list(col), ",")
    if mode == "array":
        return F.transform(parse_array(col), lambda tag: F.trim(tag))
    raise ValueError(f"unknown mode: {mode}")


def explode_tags(df: DataFrame, key: list[str] | str, col: str, out: str, mode: str = "legacy") -> DataFrame:
    """One row per non-empty tag, repeated tags included; rows without tags vanish."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.where(has_tags(F.col(col)))
        .select(*keys, F.explode(split_tags(F.col(col), mode)).alias(out))
        .where(F.col(out) != "")
    )
