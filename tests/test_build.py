from datetime import datetime, timezone

import pytest

from catalog.spark_queries import Model
from prodmart.operators.quality import DataQualityError
from prodmart.plans.build import build_marts
from prodmart.plans.load import load_raw, read_raw
from prodmart.plans.marts import rank_brands
from prodmart.plans.star import FACT_COLUMNS
from prodmart.schema import RAW_COLUMNS
from prodmart.sources.tables import Lakehouse, layer_name, read_model_runs, write_batch

NOW = datetime(2024, 5, 1, tzinfo=timezone.utc)

# Row counts both engines agree on for the smallest tables.
EXPECTED = {
    "stg_products": 167, "stg_nutrients": 177, "bridge_product_country": 284, "bridge_product_brand": 276,
    "dim_brand": 66, "dim_category": 27, "dim_country": 30, "fact_products": 397, "mart_nutrient_profile": 6,
    "mart_brand_quality": 31, "products_snapshot": 167,
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lakehouse(spark, str(tmp_path_factory.mktemp("lake")))
    counts = load_raw(lake, Model(spark, "/root/testdata/sf0.001").cleaned, "batch")
    assert (counts.received, counts.inserted) == (195, 177)
    return lake


@pytest.fixture(scope="module")
def tables(spark, lake):
    return build_marts(spark, read_raw(lake), lake.root, as_of=NOW)


def test_counts(tables):
    assert {name: tables[name].count() for name in EXPECTED} == EXPECTED
    assert tables["fact_products"].columns == FACT_COLUMNS and len(FACT_COLUMNS) == 28
    assert len(tables["stg_products"].columns) == 60 and len(RAW_COLUMNS) == 60
    assert len(tables["stg_nutrients"].columns) == 15
    assert tables["fact_products"].where("category_id IS NULL").count() == 41


def test_audit_and_rebuild(spark, lake, tables):
    runs = read_model_runs(spark, lake.path("audit", "model_runs"))
    assert runs.count() == 8 and runs.select("run_at").distinct().first()[0] == datetime(2024, 5, 1)
    again = build_marts(spark, read_raw(lake), lake.root, as_of=NOW, fused=False)
    assert {name: again[name].count() for name in EXPECTED} == EXPECTED
    assert read_model_runs(spark, lake.path("audit", "model_runs")).count() == 16
    # the tables of the first build are still readable, and the marts agree with and without a join
    for name in ("mart_nutrient_profile", "mart_brand_quality"):
        assert sorted(map(tuple, again[name].collect()), key=str) == sorted(map(tuple, tables[name].collect()), key=str)


def test_refresh_keeps_two_builds_and_ignores_unfinished_ones(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "l"))
    for n in range(1, 5):
        lake.refresh(spark.range(n), "marts", "t")
    folder = tmp_path / "l" / "marts" / "t"
    assert sorted(p.name for p in folder.iterdir()) == ["build=3", "build=4"]
    (folder / "build=4" / "_COMMITTED").unlink()
    assert lake.latest("marts", "t").count() == 3
    with pytest.raises(FileNotFoundError):
        lake.latest("marts", "absent")


def test_failing_check_leaves_the_builds_before(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "l"))

    def refuse(written):
        raise DataQualityError(str(written.count()))

    lake.refresh(spark.range(1), "marts", "t")
    for n in (2, 3, 4):
        with pytest.raises(DataQualityError, match=str(n)):
            lake.refresh(spark.range(n), "marts", "t", check=refuse)
    assert lake.latest("marts", "t").count() == 1
    assert lake.refresh(spark.range(5), "marts", "t").count() == 5


def test_rank_brands(tables):
    ranked = rank_brands(tables["mart_brand_quality"], limit=5).collect()
    values = [r["avg_energy_kcal"] for r in ranked]
    assert len(ranked) == 5 and values == sorted(values)


def test_failing_check_stops_the_build(spark, lake, tmp_path):
    raw = read_raw(lake)
    doubled = raw.unionByName(raw.limit(1))
    with pytest.raises(DataQualityError, match="unique"):
        build_marts(spark, doubled, str(tmp_path / "bad"), as_of=NOW)
    assert not (tmp_path / "bad" / "marts").exists()


def test_views_and_layers(spark, lake, tables):
    assert layer_name(" marts ") == "marts" and layer_name(None) == "staging"
    lake.view(tables["stg_products"], "stg_products_view")
    assert spark.sql("SELECT count(*) FROM stg_products_view").first()[0] == 167


def test_batch_names(spark, tmp_path):
    with pytest.raises(ValueError):
        write_batch(spark.range(1), str(tmp_path), "../other")
