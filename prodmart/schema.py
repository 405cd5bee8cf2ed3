"""Column lists and read schema of the product feed.

The feed is schema-on-read and drifts (hundreds to a thousand field names per batch), so
every reader projects on this explicit keep-list and never infers types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# The 54 kept fields, in table order.
COLUMNS = """
    code product_name generic_name quantity product_quantity product_quantity_unit serving_size lang url
    brands brands_tags owner manufacturing_places_tags
    categories categories_tags categories_hierarchy pnns_groups_1 pnns_groups_2 food_groups food_groups_tags
    countries countries_tags countries_hierarchy origins origins_tags purchase_places
    nutriments nutrition_data_per nutriscore_grade nutriscore_score nova_group ecoscore_grade ecoscore_score
    nutrient_levels
    ingredients_text ingredients_n allergens_tags traces_tags additives_n additives_tags
    ingredients_analysis_tags labels labels_tags
    packaging packaging_tags packaging_materials_tags packaging_recycling_tags
    created_t last_modified_t last_updated_t completeness
    image_url image_front_url image_front_small_url
""".split()

# Free-text fields that get folded to plain lower case.
TEXT_COLUMNS = """
    product_name generic_name quantity product_quantity_unit serving_size lang brands owner
    manufacturing_places categories pnns_groups_1 pnns_groups_2 food_groups countries origins
    purchase_places nutrition_data_per nutriscore_grade ecoscore_grade ingredients_text labels packaging
""".split()

# Numeric fields; everything else is text, `code` included (leading zeros matter).
DOUBLE_COLUMNS = """
    product_quantity nutriscore_score nova_group ecoscore_score ingredients_n additives_n completeness
""".split()
EPOCH_COLUMNS = ["created_t", "last_modified_t", "last_updated_t"]

# Image and page links, dict-valued fields.
URL_COLUMNS = ["url", "image_url", "image_front_url", "image_front_small_url"]
MAP_COLUMNS = ["nutriments", "nutrient_levels"]
LIST_COLUMNS = [c for c in COLUMNS if c.endswith(("_tags", "_hierarchy"))]

# Source key -> output column.
LEVEL_FIELDS = {
    "fat": "fat_level",
    "salt": "salt_level",
    "saturated-fat": "saturated_fat_level",
    "sugars": "sugars_level",
}
NUTRIENT_FIELDS = {
    "energy-kcal_100g": "energy_kcal_100g",
    "fat_100g": "fat_100g",
    "saturated-fat_100g": "saturated_fat_100g",
    "sugars_100g": "sugars_100g",
    "salt_100g": "salt_100g",
    "proteins_100g": "proteins_100g",
    "fiber_100g": "fiber_100g",
}
LEVEL_COLUMNS = list(LEVEL_FIELDS.values())
NUTRIENT_COLUMNS = list(NUTRIENT_FIELDS.values())

# Reading position inside a batch, unique per row; it decides which duplicate of a key wins. `source_file` is
# the file's path in natural order, `page_no` the page's number (of an extract: the byte where a split
# starts), `pos` the place in there.
ORDER_COLUMNS = ["source_file", "page_no", "pos"]


def tag_twins(names: list[str]) -> list[str]:
    """Plain columns whose normalised `<name>_tags` twin is also present."""
    present = set(names)
    return [n for n in names if f"{n}_tags" in present]


def field_type(name: str) -> T.DataType:
    if name in DOUBLE_COLUMNS or name in NUTRIENT_COLUMNS:
        return T.DoubleType()
    if name in EPOCH_COLUMNS or name in ("page_no", "pos"):
        return T.LongType()
    if name == "ingested_at":
        return T.TimestampType()
    return T.StringType()


# Columns of the raw table: the keep-list without twinned plain columns, plus what cleaning derives.
RAW_COLUMNS = (
    [c for c in COLUMNS if c not in tag_twins(COLUMNS)]
    + ["batch_id", "ingested_at"]
    + LEVEL_COLUMNS
    + NUTRIENT_COLUMNS
)

# Declared text lengths of the raw table.
MAX_LENGTH = {"code": 50, "lang": 10, "batch_id": 50, "source": 50}


def struct_of(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, field_type(n)) for n in names])


def conform(df: DataFrame, names: list[str], strict: bool = False) -> DataFrame:
    """Project on `names` with their declared types.

    A column the input lacks becomes NULL, or raises when `strict`.
    """
    missing = [n for n in names if n not in df.columns]
    if strict and missing:
        raise ValueError(f"input lacks columns: {', '.join(missing)}")
    return df.to(struct_of(names))
