"""Data-quality checks. A check returns its failing rows; no rows means it passed.

`unique`, `accepted_values` and `relationships` return one row per failing value with the number
of records behind it: they aggregate before any shuffle, so a value that holds much of the table
stays one row per task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

RESULT_COLUMNS = ["check", "model", "column", "failures", "status"]


class DataQualityError(Exception):
    """At least one blocking check failed."""


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def expression(df: DataFrame, fails: Column) -> DataFrame:
    """Rows for which `fails` is true; an undecided row passes."""
    return df.where(fails)


def _per_value(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))


def unique(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return _per_value(df.where(F.col(col).isNotNull()), col).where("n_records > 1")


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Values outside the list; NULL passes."""
    return _per_value(df.where(~F.col(col).isin(values)), col)


def relationships(df: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL foreign keys without a parent; each distinct key is looked up once."""
    keys = parent.select(F.col(field).alias(col)).distinct()
    return _per_value(df.where(F.col(col).isNotNull()), col).join(keys, col, "left_anti")


def orphans(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent row (a NULL key has none)."""
    return df.join(parent.select(key).distinct(), key, "left_anti")


def freshness(df: DataFrame, col: str, as_of: datetime, warn_hours: float = 24, error_hours: float = 48) -> DataFrame:
    """One row: newest `col`, its age, and pass / warn / error. A table without rows is an error."""
    newest = df.agg(F.max(col).alias("max_loaded_at"))
    seconds = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))
    age = seconds / F.lit(3.6e9)
    status = (
        F.when(age.isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("pass")
    )
    return newest.select("max_loaded_at", age.alias("age_hours"), status.alias("status"))


@dataclass(frozen=True)
class Check:
    """A named check of one model. Row checks carry the failing condition, the others a function."""

    name: str
    model: str
    column: str
    fails: Column | None = None
    rows: Callable[[dict[str, DataFrame]], DataFrame] | None = None
    severity: str = "error"
    weight: str | None = None  # column of `rows` that is summed as the number of failures; default: their count

    def failing(self, frames: dict[str, DataFrame]) -> DataFrame:
        if self.rows is not None:
            return self.rows(frames)
        return expression(frames[self.model], self.fails)


def check_not_null(model: str, col: str) -> Check:
    return Check("not_null", model, col, fails=F.col(col).isNull())


def check_accepted(model: str, col: str, values: list) -> Check:
    """Counts failing values."""
    return Check("accepted_values", model, col, rows=lambda frames: accepted_values(frames[model], col, values))


def check_expression(name: str, model: str, col: str, fails: Column, severity: str = "error") -> Check:
    return Check(name, model, col, fails=fails, severity=severity)


def check_unique(model: str, col: str) -> Check:
    return Check("unique", model, col, rows=lambda frames: unique(frames[model], col))


def check_relationships(model: str, col: str, parent: str, field: str) -> Check:
    """Counts failing rows."""
    return Check(
        "relationships", model, col, rows=lambda frames: relationships(frames[model], col, frames[parent], field),
        weight="n_records",
    )


def check_orphans(name: str, model: str, parent: str, key: str) -> Check:
    return Check(name, model, key, rows=lambda frames: orphans(frames[model], frames[parent], key))


def _result(check: Check, failures: Column) -> Column:
    status = F.when(failures == 0, "pass").otherwise(check.severity)
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column"),
        failures.alias("failures"),
        status.alias("status"),
    )


def run_checks(checks: list[Check], frames: dict[str, DataFrame]) -> DataFrame:
    """One row per check: failing rows (`unique` and `accepted_values`: failing values) and status.

    All row checks of a model share one scan.
    """
    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        by_row = [c for c in checks if c.model == model and c.fails is not None]
        if by_row:
            counts = frames[model].agg(*[F.count_if(c.fails).alias(f"f{i}") for i, c in enumerate(by_row)])
            results = F.array(*[_result(c, F.col(f"f{i}")) for i, c in enumerate(by_row)])
            parts.append(counts.select(F.inline(results)))
        for c in checks:
            if c.model == model and c.fails is None:
                total = F.count(F.lit(1)) if c.weight is None else F.coalesce(F.sum(c.weight), F.lit(0))
                counts = c.failing(frames).agg(total.alias("n"))
                parts.append(counts.select(F.inline(F.array(_result(c, F.col("n"))))))
    return reduce(DataFrame.unionByName, parts)


def gate(checks: list[Check], frames: dict[str, DataFrame]) -> list:
    """Run checks and raise when a blocking one fails, so nothing downstream is built. Returns the results."""
    results = run_checks(checks, frames).collect()  # one row per check
    failed = [r for r in results if r["status"] == "error"]
    if failed:
        lines = [f"{r['check']}({r['model']}.{r['column']}): {r['failures']}" for r in failed]
        raise DataQualityError("; ".join(lines))
    return results


# Accepted grades and groups, and the plausible ranges.
NUTRISCORE_GRADES = ["a", "b", "c", "d", "e"]
NOVA_GROUPS = [1, 2, 3, 4]


def source_checks() -> list[Check]:
    return [
        check_not_null("raw_products", "code"),
        check_unique("raw_products", "code"),
        check_not_null("raw_products", "product_name"),
    ]


def staging_checks() -> list[Check]:
    completeness = F.col("completeness")
    return [
        check_not_null("stg_products", "code"),
        check_unique("stg_products", "code"),
        check_not_null("stg_products", "product_name"),
        check_accepted("stg_products", "nutriscore_grade", NUTRISCORE_GRADES),
        check_accepted("stg_products", "nova_group", NOVA_GROUPS),
        check_not_null("stg_products", "completeness"),
        check_expression("completeness_range", "stg_products", "completeness", (completeness < 0) | (completeness > 1)),
    ]


def dim_brand_checks() -> list[Check]:
    return [
        check_not_null("dim_brand", "brand_id"),
        check_unique("dim_brand", "brand_id"),
        check_not_null("dim_brand", "brand_name"),
    ]


def dim_category_checks() -> list[Check]:
    return [
        check_not_null("dim_category", "category_id"),
        check_unique("dim_category", "category_id"),
        check_not_null("dim_category", "pnns_groups_1"),
    ]


def dim_country_checks() -> list[Check]:
    return [
        check_not_null("dim_country", "country_id"),
        check_not_null("dim_country", "country_code"),
        check_unique("dim_country", "country_code"),
    ]


def bridge_country_checks() -> list[Check]:
    return [
        check_not_null("bridge_product_country", "code"),
        check_not_null("bridge_product_country", "country_code"),
    ]


def bridge_brand_checks() -> list[Check]:
    return [check_orphans("no_orphan_products", "bridge_product_brand", "stg_products", "code")]


def energy_out_of_range() -> Column:
    return (F.col("energy_kcal_100g") < 0) | (F.col("energy_kcal_100g") > 1000)


def share_above_100() -> Column:
    names = ["fat_100g", "sugars_100g", "proteins_100g", "salt_100g"]
    return reduce(lambda a, b: a | b, [F.col(n) > 100 for n in names])


def fact_checks() -> list[Check]:
    return [
        check_not_null("fact_products", "code"),
        check_relationships("fact_products", "brand_id", "dim_brand", "brand_id"),
        check_relationships("fact_products", "category_id", "dim_category", "category_id"),
        check_expression("energy_range", "fact_products", "energy_kcal_100g", energy_out_of_range()),
        check_expression("share_range", "fact_products", "nutrients", share_above_100()),
    ]


def star_checks() -> list[Check]:
    """Every declared check of the star schema."""
    return (
        source_checks() + staging_checks() + dim_brand_checks() + dim_category_checks() + dim_country_checks()
        + bridge_country_checks() + bridge_brand_checks() + fact_checks()
    )
