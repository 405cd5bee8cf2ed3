"""Staging views over the raw table. Everything is narrow; the range filters reach the Parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import LEVEL_COLUMNS, NUTRIENT_COLUMNS, RAW_COLUMNS

# Strict upper bounds of a plausible product, grades that mean "none", renamed epoch columns.
UPPER_BOUNDS = {"energy_kcal_100g": 1000, "sugars_100g": 100, "fat_100g": 100, "proteins_100g": 100, "salt_100g": 100}
NO_GRADE = ["not-applicable", "unknown"]
TIMES = {"created_t": "created_at", "last_modified_t": "last_modified_at", "last_updated_t": "last_updated_at"}
ENERGY_LIMIT = 900

STG_NUTRIENT_COLUMNS = ["code", *NUTRIENT_COLUMNS, *LEVEL_COLUMNS, "nutrient_levels", "batch_id", "ingested_at"]


def has_keys() -> Column:
    return F.col("code").isNotNull() & F.col("product_name").isNotNull()


def plausible(bounds: dict[str, float] | None = None) -> Column:
    """Every bounded nutrient is known and below its bound."""
    limits = UPPER_BOUNDS if bounds is None else bounds
    return reduce(lambda a, b: a & b, [F.col(c) < float(limit) for c, limit in limits.items()])


def grade(col: Column) -> Column:
    return F.when(F.trim(col).isin(NO_GRADE), F.lit(None)).otherwise(col)


def stg_products(raw: DataFrame, energy_rule: str = "filter") -> DataFrame:
    """Plausible products, 60 columns.

    `energy_rule='filter'` drops rows whose energy is unknown or too high; `'null'` keeps them and
    blanks energy above the limit instead.
    """
    if energy_rule not in ("filter", "null"):
        raise ValueError(f"unknown energy_rule: {energy_rule}")
    bounds = dict(UPPER_BOUNDS)
    if energy_rule == "null":
        del bounds["energy_kcal_100g"]

    def staged(name: str) -> Column | str:
        if name == "nutriscore_grade":
            return grade(F.col(name)).alias(name)
        if name in TIMES:
            return F.timestamp_seconds(name).alias(TIMES[name])
        if name == "energy_kcal_100g" and energy_rule == "null":
            return F.when(~(F.col(name) > ENERGY_LIMIT), F.col(name)).alias(name)
        return name

    return raw.where(has_keys() & plausible(bounds)).select(*[staged(name) for name in RAW_COLUMNS])


def stg_nutrients(raw: DataFrame) -> DataFrame:
    """Nutrition columns of every keyed row, implausible ones included."""
    return raw.where(has_keys()).select(*STG_NUTRIENT_COLUMNS)
