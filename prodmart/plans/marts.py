"""Nutrition summary marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import explode_tags
from ..schema import NUTRIENT_COLUMNS

# Nutrient -> averaged column.
AVERAGES = {
    "energy_kcal_100g": "avg_energy_kcal",
    "fat_100g": "avg_fat",
    "saturated_fat_100g": "avg_saturated_fat",
    "sugars_100g": "avg_sugars",
    "salt_100g": "avg_salt",
    "proteins_100g": "avg_proteins",
    "fiber_100g": "avg_fiber",
}
MIN_PRODUCTS = 3


def rounded_averages(columns: dict[str, str], digits: int = 2) -> list[Column]:
    """Averages over known values, rounded half away from zero."""
    return [F.round(F.avg(source), digits).alias(out) for source, out in columns.items()]


def summarise(df: DataFrame, group: Column, out: str, counted: str = "code") -> DataFrame:
    """Products and average nutrients per group; map-side partial sums keep heavy groups small."""
    return df.groupBy(group.alias(out)).agg(
        F.count(counted).alias("total_products"), *rounded_averages(AVERAGES)
    )


def mart_nutrient_profile(stg: DataFrame, nutrients: DataFrame | None = None, fused: bool = False) -> DataFrame:
    """Averages per food group.

    Both staging models carry the same nutrients of the same unique `code`, so `fused` reads the
    product side alone and needs no join.
    """
    grouped = stg.where(F.col("pnns_groups_1").isNotNull())
    if not fused:
        keys = grouped.select("code", "pnns_groups_1")
        grouped = keys.join(nutrients.select("code", *NUTRIENT_COLUMNS), "code")
    return summarise(grouped, F.col("pnns_groups_1"), "pnns_groups_1")


def mart_brand_quality(bridge: DataFrame, nutrients: DataFrame, min_products: int = MIN_PRODUCTS) -> DataFrame:
    """Averages per brand (upper case) over products carrying its tag."""
    rows = bridge.select("code", "brand_name").join(nutrients.select("code", *NUTRIENT_COLUMNS), "code")
    return _brand_quality(rows, min_products)


def mart_brand_quality_fused(stg: DataFrame, min_products: int = MIN_PRODUCTS) -> DataFrame:
    """The same mart in one scan: tags are exploded next to the nutrients, so nothing is joined by `code`."""
    return _brand_quality(
        explode_tags(stg, ["code", *NUTRIENT_COLUMNS], "brands_tags", "brand_name"), min_products
    )


def _brand_quality(rows: DataFrame, min_products: int) -> DataFrame:
    return summarise(rows, F.upper("brand_name"), "brand_name").where(F.col("total_products") >= min_products)


def rank_brands(mart: DataFrame, by: str = "avg_energy_kcal", limit: int | None = None) -> DataFrame:
    """Brands in ascending order of a column, unknown last; `limit` makes it a top-k."""
    ordered = mart.orderBy(F.col(by).asc_nulls_last(), "brand_name")
    return ordered if limit is None else ordered.limit(limit)
