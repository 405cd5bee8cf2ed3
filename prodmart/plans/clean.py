"""From landed records to rows of the raw table."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean_text, clip, empty_list_to_null, nutrient_levels, nutrients, parse_fields, parse_map
from ..functions.text import replace_value
from ..schema import NUTRIENT_FIELDS, TEXT_COLUMNS, tag_twins

PLACES = "manufacturing_places_tags"


def new_batch_id(now: datetime) -> str:
    """Identity of one run; evaluate once on the driver."""
    return f"batch_id{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def drop_missing_keys(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["code", "product_name"])


def drop_tag_twins(df: DataFrame) -> DataFrame:
    """Drop plain columns that have a normalised `_tags` twin."""
    return df.drop(*tag_twins(df.columns))


def drop_time_travel(df: DataFrame) -> DataFrame:
    """Drop rows modified before they were created (not part of the default cleaning)."""
    return df.where(~(F.col("last_modified_t") < F.col("created_t")) | F.col("last_modified_t").isNull()
                    | F.col("created_t").isNull())


def modified_before_created(df: DataFrame) -> DataFrame:
    return df.where(F.col("last_modified_t") < F.col("created_t"))


def clean_products(
    df: DataFrame,
    batch_id: str,
    as_of: datetime | Column,
    legacy_null_places: bool = False,
    null_empty_tags: tuple[str, ...] = (PLACES,),
    drop_if_modified_before_created: bool = False,
) -> DataFrame:
    """Cleaning rules as one narrow projection; columns the input lacks are skipped.

    `null_empty_tags` lists the tag columns whose `[]` becomes NULL. `legacy_null_places` blanks
    the manufacturing places of every row, an older behaviour some histories depend on.
    """
    kept = drop_missing_keys(df)
    if drop_if_modified_before_created:
        kept = drop_time_travel(kept)
    kept = drop_tag_twins(kept)

    def cleaned(name: str) -> Column | str:
        col = F.col(name)
        if name == "completeness":
            result = clip(col, 0.0, 1.0)
        elif name == "lang":
            result = replace_value(clean_text(col), "xx", "unknown")
        elif name in TEXT_COLUMNS:
            result = clean_text(col)
        elif name == PLACES and legacy_null_places:
            result = F.lit(None).cast("string")
        elif name in null_empty_tags:
            result = empty_list_to_null(col)
        else:
            return name
        return result.alias(name)

    # Both dicts are parsed once, in a projection of their own.
    parsed = kept.withColumns(
        {
            "_levels": parse_map(F.col("nutrient_levels")),
            "_nutrients": parse_fields(F.col("nutriments"), list(NUTRIENT_FIELDS)),
        }
    )
    stamp = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return parsed.select(
        *[cleaned(name) for name in kept.columns],
        *nutrient_levels(F.col("nutrient_levels"), parsed=F.col("_levels")),
        *nutrients(F.col("nutriments"), parsed=F.col("_nutrients")),
        F.lit(batch_id).alias("batch_id"),
        stamp.cast("timestamp").alias("ingested_at"),
    )
