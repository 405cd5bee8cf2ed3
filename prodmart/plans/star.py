"""Dimensions, bridges and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import explode_tags, first_tag, has_tags
from ..operators.ranks import dense_ids
from ..operators.stable_ids import IdDictionary
from ..schema import LEVEL_COLUMNS, NUTRIENT_COLUMNS

# The prefix a country name loses.
COUNTRY_PREFIX = "en:"


def _numbered(members: DataFrame, out: str, ids: IdDictionary | None) -> DataFrame:
    """Distinct members with ids in their order, or with those of a dictionary."""
    return dense_ids(members.distinct(), members.columns, out) if ids is None else ids.assign(members)


def dim_brand(stg: DataFrame, one_per_brand: bool = False, ids: IdDictionary | None = None) -> DataFrame:
    """Brands by first brand tag and owner; `one_per_brand` keeps the smallest owner only.

    With `ids`, here as in the other dimensions, members keep the id they once got.
    """
    pairs = (
        stg.where(has_tags(F.col("brands_tags")))
        .select(first_tag(F.col("brands_tags")).alias("brand_name"), "owner")
        .where("brand_name != ''")
    )
    if one_per_brand:
        # distinct first: it aggregates by hash, while a smallest text is found by sorting
        brands = pairs.distinct().groupBy("brand_name").agg(F.min("owner").alias("owner"))
        if ids is None:
            return dense_ids(brands, ["brand_name"], "brand_id")
        numbered = ids.assign(brands.select("brand_name"))  # the owner may change, the brand keeps its id
        return numbered.join(brands, "brand_name").select("brand_id", "brand_name", "owner")
    return _numbered(pairs, "brand_id", ids)


def dim_category(stg: DataFrame, ids: IdDictionary | None = None) -> DataFrame:
    groups = stg.where(F.col("pnns_groups_1").isNotNull()).select("pnns_groups_1", "pnns_groups_2")
    return _numbered(groups, "category_id", ids)


def dim_country(bridge: DataFrame, ids: IdDictionary | None = None) -> DataFrame:
    return _numbered(bridge.select("country_code", "country_name"), "country_id", ids)


def bridge_product_country(stg: DataFrame, mode: str = "legacy") -> DataFrame:
    """One row per product and country tag, repeated tags included."""
    return explode_tags(stg, "code", "countries_tags", "country_code", mode).withColumn(
        "country_name", F.replace("country_code", F.lit(COUNTRY_PREFIX), F.lit(""))
    )


def bridge_product_brand(stg: DataFrame, mode: str = "legacy") -> DataFrame:
    """One row per product and brand tag, repeated tags included."""
    return explode_tags(stg, "code", "brands_tags", "brand_name", mode)


# Columns of the fact table.
FACT_COLUMNS: list[str] = [
    "code", "product_name", "lang", "brand_id", "category_id",
    "nutriscore_grade", "nutriscore_score", "nova_group", "ecoscore_grade", "ecoscore_score",
    *NUTRIENT_COLUMNS, *LEVEL_COLUMNS,
    "ingredients_n", "additives_n", "created_at", "last_modified_at", "completeness", "ingested_at", "batch_id",
]


def fact_products(stg: DataFrame, brands: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with their brand and category ids, 28 columns.

    A product gets one row per dimension row of its brand (one per owner). No broadcast is forced:
    the dimensions grow with the feed, so Spark decides by their measured size. When both joins
    shuffle, AQE splits the partitions of heavy brands and of rows without a key.
    """
    brand_ids = brands.select("brand_id", F.col("brand_name").alias("_brand"))
    group_ids = categories.select(
        "category_id", F.col("pnns_groups_1").alias("_group_1"), F.col("pnns_groups_2").alias("_group_2")
    )
    return (
        stg.join(brand_ids, first_tag(F.col("brands_tags")) == F.col("_brand"), "left")
        .join(
            group_ids,
            (F.col("pnns_groups_1") == F.col("_group_1")) & (F.col("pnns_groups_2") == F.col("_group_2")),
            "left",
        )
        .select(*FACT_COLUMNS)
    )
