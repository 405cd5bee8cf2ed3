"""Product history."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schema import LEVEL_COLUMNS

# Versioned columns, key and change time.
SNAPSHOT_COLUMNS = [
    "code", "product_name", "nutriscore_grade", "nutriscore_score", "nova_group", "ecoscore_grade", "ecoscore_score",
    *LEVEL_COLUMNS, "owner", "brands_tags", "completeness", "last_modified_at",
]
SNAPSHOT_KEY = "code"
SNAPSHOT_UPDATED_AT = "last_modified_at"


def snapshot_rows(stg: DataFrame) -> DataFrame:
    return stg.select(*SNAPSHOT_COLUMNS)
