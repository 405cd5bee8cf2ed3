"""Product-shaped rows derived from `part`; the same expressions run in Spark SQL and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PRODUCT = {
    "page_no": "p_partkey % 10 + 1",
    "pos": "p_partkey",
    "code": """CASE WHEN p_partkey % 97 = 0 THEN NULL
        ELSE lpad(CAST(p_partkey - CASE WHEN p_partkey % 10 = 9 THEN 1 ELSE 0 END AS STRING), 13, '0') END""",
    "product_name": "CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE '  ' || p_name || ' É' END",
    "lang": "CASE p_partkey % 4 WHEN 0 THEN 'XX' WHEN 1 THEN 'fr' ELSE 'en' END",
    "owner": "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'org-' || CAST(p_partkey % 3 AS STRING) END",
    "brands_tags": """CASE WHEN p_partkey % 11 = 0 THEN '[]' WHEN p_partkey % 13 = 0 THEN NULL
        ELSE '[' || chr(39) || lower(p_brand) || chr(39) || ', ' || chr(39) || lower(p_type) || chr(39) || ']' END""",
    "countries_tags": """CASE WHEN p_partkey % 7 = 0 THEN '[]'
        ELSE '[' || chr(39) || 'en:country-' || CAST(p_partkey % 25 AS STRING) || chr(39) || ', '
          || chr(39) || 'fr:pays-' || CAST(p_size % 5 AS STRING) || chr(39) || ']' END""",
    "pnns_groups_1": "CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE lower(p_type) END",
    "pnns_groups_2": "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE 'sub-' || CAST(p_size % 4 AS STRING) END",
    "nutriscore_grade": """CASE p_partkey % 7 WHEN 0 THEN 'not-applicable' WHEN 1 THEN 'unknown' WHEN 2 THEN 'a'
        WHEN 3 THEN 'b' WHEN 4 THEN 'c' WHEN 5 THEN 'd' ELSE 'e' END""",
    "nutriscore_score": "CAST(p_partkey % 60 - 15 AS DOUBLE)",
    "nova_group": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_partkey % 4 + 1 AS DOUBLE) END",
    "completeness": "CAST(p_partkey % 13 AS DOUBLE) / 10",
    "created_t": "1600000000 + p_partkey * 3600",
    "last_modified_t": "1600000000 + p_partkey * 7200 - (p_partkey % 50) * 90000",
    "nutrient_levels": """CASE WHEN p_partkey % 29 = 0 THEN NULL
        ELSE '{' || chr(39) || 'fat' || chr(39) || ': ' || chr(39) || 'low' || chr(39)
          || CASE WHEN p_partkey % 2 = 0 THEN ', ' || chr(39) || 'saturated-fat' || chr(39) || ': '
                  || chr(39) || 'high' || chr(39) ELSE '' END || '}' END""",
    "nutriments": """CASE WHEN p_partkey % 31 = 0 THEN NULL
        ELSE '{' || chr(39) || 'energy-kcal_100g' || chr(39) || ': ' || CAST(p_partkey % 1100 AS STRING)
          || ', ' || chr(39) || 'fat_100g' || chr(39) || ': ' || CAST(p_size % 110 AS STRING) || '.5'
          || ', ' || chr(39) || 'sugars_100g' || chr(39) || ': ' || CAST(p_partkey % 104 AS STRING)
          || ', ' || chr(39) || 'salt_100g' || chr(39) || ': ' || CAST(p_partkey % 5 AS STRING)
          || ', ' || chr(39) || 'proteins_100g' || chr(39) || ': ' || CAST(p_partkey % 40 AS STRING)
          || CASE WHEN p_partkey % 3 = 0 THEN ', ' || chr(39) || 'fiber_100g' || chr(39) || ': '
                  || CAST(p_partkey % 12 AS STRING) ELSE '' END || '}' END""",
}

QUOTE = "chr(39)"


def _list(column: str, *items: str) -> str:
    """A list literal of the items; empty for every ninth row, missing for every fourteenth."""
    inner = " || ', ' || ".join(f"{QUOTE} || {item} || {QUOTE}" for item in items)
    return f"CASE WHEN p_partkey % 9 = {len(column) % 9} THEN '[]' WHEN p_partkey % 14 = 1 THEN NULL ELSE '[' || {inner} || ']' END"


# The other kept fields: foldable texts with blanks of several kinds around them, lists with a comma inside a tag,
# plain columns beside their normalised twins, missing shares, undefined numbers.
_TEXT = {
    "generic_name": "chr(9) || 'Crème ' || p_name || chr(160)",
    "quantity": "CAST(p_size AS STRING) || ' G' || chr(10)",
    "product_quantity_unit": "CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 6 = 1 THEN 'ML ' ELSE 'g' END",
    "serving_size": "' ' || CAST(p_size AS STRING) || ' Gräm'",
    "purchase_places": "CASE WHEN p_partkey % 5 = 0 THEN '' ELSE chr(13) || 'Orléans, Łódź'  END",
    "nutrition_data_per": "CASE WHEN p_partkey % 3 = 0 THEN '100G' ELSE 'Serving' END",
    "ecoscore_grade": "CASE p_partkey % 5 WHEN 0 THEN ' Unknown ' WHEN 1 THEN NULL WHEN 2 THEN 'A' ELSE 'b' END",
    "ingredients_text": "'Bœuf, Größe, None, ' || p_type || ' ½'",
}
_LISTS = """manufacturing_places_tags categories_tags categories_hierarchy food_groups_tags countries_hierarchy origins_tags
allergens_tags traces_tags additives_tags ingredients_analysis_tags labels_tags packaging_tags packaging_materials_tags
packaging_recycling_tags""".split()
TWINS = ["brands", "categories", "food_groups", "countries", "origins", "labels", "packaging"]
MORE = {
    **_TEXT,
    **{name: _list(name, "'en:' || lower(p_brand)", "'fr:é, " + name + "'") for name in _LISTS},
    **{name: f"'{name} ' || p_brand" for name in TWINS},
    "completeness": "CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 17 = 1 THEN CAST('NaN' AS DOUBLE) "
                    "ELSE CAST(p_partkey % 13 AS DOUBLE) / 10 - 0.1 END",
    "product_quantity": "CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) * 2.5 END",
    "ecoscore_score": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_partkey % 101 AS DOUBLE) END",
    "ingredients_n": "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_size % 12 AS DOUBLE) END",
    "additives_n": "CAST(p_partkey % 4 AS DOUBLE)",
    "last_updated_t": "CASE WHEN p_partkey % 15 = 0 THEN NULL ELSE 1650000000 + p_partkey * 60 END",
    **{name: f"'https://images.example.org/{name}/' || CAST(p_partkey AS STRING) || '?Q=É'"
       for name in ("url", "image_url", "image_front_url", "image_front_small_url")},
}
EVERY = PRODUCT | MORE
ROWS_PER_TASK = 20_000


def select_sql(columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in columns.items()) + " FROM part"


FX_SQL = select_sql(PRODUCT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fx(spark: SparkSession, sf_dir: str, columns: dict[str, str] = PRODUCT) -> DataFrame:
    """The rows are dealt to tasks by their number: those of `part` are short, and a scan cut by bytes would give a task
    so many of them that the wide rows made of them fill its memory."""
    parts = table(spark, sf_dir, "part")
    tasks = -(-parts.count() // ROWS_PER_TASK)
    if tasks > 1:
        parts = parts.repartition(tasks, *parts.columns)
    return parts.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])
