"""Report queries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def products_by_country(fact: DataFrame, bridge: DataFrame, countries: DataFrame) -> DataFrame:
    """Fact rows per country name; matched on the name, so codes sharing a name match each other."""
    names = countries.select("country_name")
    tagged = bridge.select(F.col("code").alias("code_bridge"), "country_name").join(names, "country_name")
    return fact.join(tagged, F.col("code") == F.col("code_bridge")).select(
        *fact.columns, "code_bridge", "country_name"
    )


def explore_products(
    fact: DataFrame,
    bridge: DataFrame | None = None,
    categories: DataFrame | None = None,
    country_names: list[str] | None = None,
    groups: list[str] | None = None,
    grades: list[str] | None = None,
    nova: list[int] | None = None,
    calories: tuple[float, float] | None = None,
) -> DataFrame:
    """Fact rows that satisfy every given filter; country and category are semi joins and add no rows."""
    rows = fact
    if grades is not None:
        rows = rows.where(F.col("nutriscore_grade").isin(grades))
    if nova is not None:
        rows = rows.where(F.col("nova_group").isin([float(n) for n in nova]))
    if calories is not None:
        rows = rows.where(F.col("energy_kcal_100g").between(*calories))
    if groups is not None:
        ids = categories.where(F.col("pnns_groups_1").isin(groups)).select("category_id")
        rows = rows.join(ids, "category_id", "left_semi")
    if country_names is not None:
        codes = bridge.where(F.col("country_name").isin(country_names)).select("code")
        rows = rows.join(codes, "code", "left_semi")
    return rows.select(*fact.columns)


def one_row_per_product(fact: DataFrame, columns: list[str]) -> DataFrame:
    """Undo the brand fan-out for columns that depend on the product alone."""
    return fact.groupBy("code").agg(*[F.min(c).alias(c) for c in columns])


def kpis(fact: DataFrame) -> DataFrame:
    """One row of headline numbers, each product counted once."""
    products = one_row_per_product(
        fact, ["nutriscore_score", "nova_group", "energy_kcal_100g", "completeness", "category_id"]
    )
    return products.agg(
        F.count(F.lit(1)).alias("n_products"),
        F.count_distinct("category_id").alias("n_categories"),
        F.round(F.avg("nutriscore_score"), 2).alias("avg_nutriscore_score"),
        F.round(F.avg("nova_group"), 2).alias("avg_nova_group"),
        F.round(F.avg("energy_kcal_100g"), 2).alias("avg_energy_kcal"),
        F.round(F.avg("completeness"), 4).alias("avg_completeness"),
    )


def chart_series(fact: DataFrame, column: str) -> DataFrame:
    """Distinct products per value of a column."""
    return (
        fact.select(column, "code").distinct().groupBy(column).agg(F.count("code").alias("n_products"))
    )
