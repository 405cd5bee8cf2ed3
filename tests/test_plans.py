"""The physical plans are the intended ones."""

import re

import pytest
from pyspark.sql import functions as F

from catalog.spark_queries import Model
from prodmart.operators.keyed import append_new, first_wins
from prodmart.operators.ranks import dense_ids
from prodmart.plans import star
from prodmart.plans.load import load_raw, read_raw
from prodmart.plans.marts import mart_brand_quality_fused, mart_nutrient_profile
from prodmart.plans.staging import stg_products
from prodmart.schema import RAW_COLUMNS, struct_of
from prodmart.sources.tables import Lakehouse, path_exists, save_bucketed, scratch_folder, scratch_path, store


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    lake = Lakehouse(spark, str(tmp_path_factory.mktemp("lake")))
    load_raw(lake, Model(spark, "/root/testdata/sf0.001").cleaned, "batch")
    return read_raw(lake)


def test_first_wins_limits_before_the_shuffle(spark, sf_dir):
    plan = physical(first_wins(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_partkey"], ["l_orderkey"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_staging_filters_reach_the_scan(raw):
    text = physical(stg_products(raw).select("code", "nutriscore_grade"))
    pushed = re.search(r"PushedFilters: \[(.*?)\.\.\.|PushedFilters: \[(.*?)\]", text).group(0)
    assert "IsNotNull" in pushed and "Exchange" not in text
    scan = re.search(r"FileScan parquet \[(.*?)\]", text).group(1)
    assert "ingredients_text" not in scan and "nutriments" not in scan


def test_marts_without_join_shuffle_once(raw):
    stg = stg_products(raw)
    for mart in (mart_nutrient_profile(stg, fused=True), mart_brand_quality_fused(stg)):
        plan = physical(mart)
        assert plan.count("Exchange") == 1 and "Join" not in plan and "partial_avg" in plan


def test_append_shuffles_no_stored_keys_for_a_small_batch(spark, raw):
    incoming = raw.select("code").where("code < '0000000000020'")
    plan = physical(append_new(raw.select("code"), incoming, ["code"], ["code"]))
    assert "LeftSemi, BuildRight" in plan


def test_bucketed_table_needs_no_shuffle(spark, raw, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    save_bucketed(raw.select("code", "lang"), "stored_products", ["code"], 8, str(tmp_path / "stored"))
    try:
        stored = spark.table("stored_products")
        plan = physical(stored.join(raw.select("code").distinct(), "code", "left_semi"))
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert append_new(stored, raw.select("code", "lang"), ["code"], ["lang"]).count() == 0
    finally:
        spark.sql("DROP TABLE stored_products")


def test_ids_number_rows_in_ranges(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey")
    plan = physical(dense_ids(orders, ["o_custkey", "o_orderkey"], "id"))
    # the only window without partitions runs over the totals of the ranges
    single = re.search(r"Exchange SinglePartition.*\n(.*)\n", plan.split("Window")[-1]).group(1)
    assert "HashAggregate(keys=[_range" in single


def skewed_products(spark, n=40_000):
    """A third of the products has one brand, a third none."""
    names = [f.name for f in struct_of(RAW_COLUMNS).fields]
    brand = F.expr("CASE WHEN id % 3 = 0 THEN '[\\'hot\\']' WHEN id % 3 = 1 THEN concat('[\\'b', id % 997, '\\']') END")
    df = spark.range(n).repartition(8).select(
        F.col("id").cast("string").alias("code"), F.lit("n").alias("product_name"), brand.alias("brands_tags"),
        F.lit("g").alias("pnns_groups_1"), F.lit("h").alias("pnns_groups_2"), F.sha2(F.col("id").cast("string"), 512).alias("owner"),
        *[F.lit(1.0).alias(c) for c in ("energy_kcal_100g", "sugars_100g", "fat_100g", "proteins_100g", "salt_100g")],
    )
    return stg_products(df.to(struct_of(names)))


def test_heavy_brands_are_split(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    stg = skewed_products(spark)
    brands = stg.select("brands_tags").distinct().where("brands_tags IS NOT NULL").select(
        F.monotonically_increasing_id().alias("brand_id"), F.regexp_replace("brands_tags", r"[\[\]']", "").alias("brand_name")
    )
    categories = spark.createDataFrame([(1, "g", "h")], "category_id long, pnns_groups_1 string, pnns_groups_2 string")
    fact = star.fact_products(stg, brands, categories).select("code", "brand_id", "category_id", "product_name", "lang")
    rows = fact.collect()
    assert "SortMergeJoin(skew=true)" in physical(fact)
    assert len(rows) == 40_000 and sum(r["brand_id"] is None for r in rows) == 13_333


def test_intermediates_of_a_job_are_removed(spark):
    with scratch_folder(spark) as folder:
        kept = store(spark.range(5), "numbers")
        assert f"{folder}/numbers-" in kept.inputFiles()[0] and kept.count() == 5
        assert path_exists(spark, folder)
    assert not path_exists(spark, folder)
    assert not scratch_path(spark, "x").startswith(folder)
