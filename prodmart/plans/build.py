"""One build of the whole star schema: models, checks, history and audit log in dependency order."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality
from ..operators.scd2 import SnapshotTable
from ..operators.stable_ids import IdDictionary
from ..sources.tables import Lakehouse, init_audit
from .marts import (
    mart_brand_quality, mart_brand_quality_fused, mart_nutrient_profile,
)
from .snapshot import SNAPSHOT_KEY, SNAPSHOT_UPDATED_AT, snapshot_rows
from .staging import stg_nutrients, stg_products
from .star import (
    bridge_product_brand, bridge_product_country, dim_brand, dim_category, dim_country, fact_products,
)


def build_marts(
    spark: SparkSession,
    raw: DataFrame,
    out: str,
    as_of: datetime | None = None,
    gated: bool = True,
    fused: bool = True,
    stable_ids: bool = False,
) -> dict[str, DataFrame]:
    """Build every model below `out` and return the tables.

    Staging stays a view: each consumer reads only its columns of `raw`, which is cheaper than
    caching sixty columns. A model is checked after it is written and before it is published; a failing
    check raises, the build before stays in force, and nothing that depends on the model is built. `fused` computes the summary marts without
    joining by `code`, which the uniqueness check on the source justifies. `stable_ids` keeps the dimensions' ids from build
    to build. The audit log names every model that was built, those of a build that then fails a check included.
    """
    lake = Lakehouse(spark, out)
    init_audit(spark, lake.path("audit", "model_runs"))
    stg, nutrients = stg_products(raw), stg_nutrients(raw)
    tables: dict[str, DataFrame] = {"raw_products": raw, "stg_products": stg, "stg_nutrients": nutrients}

    def check(checks: list[quality.Check]) -> None:
        if gated and checks:
            quality.gate(checks, tables)

    def build(name: str, model: Callable[[], DataFrame], checks: list[quality.Check]) -> None:
        def accept(written: DataFrame) -> None:
            tables[name] = written
            lake.log_model_run(name, as_of or datetime.now(timezone.utc))
            check(checks)

        tables[name] = lake.refresh(model(), "marts", name, check=accept)

    check(quality.source_checks() + quality.staging_checks())
    snapshot = SnapshotTable(spark, lake.path("snapshots", "products_snapshot"), keep=2)
    snapshot.apply(snapshot_rows(stg), SNAPSHOT_KEY, SNAPSHOT_UPDATED_AT)

    def ids(out: str) -> IdDictionary | None:
        return IdDictionary(spark, lake.path("marts", f"ids_{out}"), out) if stable_ids else None

    build("dim_brand", lambda: dim_brand(stg, ids=ids("brand_id")), quality.dim_brand_checks())
    build("dim_category", lambda: dim_category(stg, ids("category_id")), quality.dim_category_checks())
    build("bridge_product_country", lambda: bridge_product_country(stg), quality.bridge_country_checks())
    build("bridge_product_brand", lambda: bridge_product_brand(stg), quality.bridge_brand_checks())
    build(
        "dim_country", lambda: dim_country(tables["bridge_product_country"], ids("country_id")), quality.dim_country_checks()
    )
    build(
        "fact_products",
        lambda: fact_products(stg, tables["dim_brand"], tables["dim_category"]),
        quality.fact_checks(),
    )
    build("mart_nutrient_profile", lambda: mart_nutrient_profile(stg, nutrients, fused=fused), [])
    build(
        "mart_brand_quality",
        lambda: mart_brand_quality_fused(stg) if fused
        else mart_brand_quality(tables["bridge_product_brand"], nutrients),
        [],
    )
    tables["products_snapshot"] = snapshot.read()
    tables["model_runs"] = lake.read("audit", "model_runs")
    return tables
