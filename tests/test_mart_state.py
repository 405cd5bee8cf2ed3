import random
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from prodmart.plans import mart_state
from prodmart.plans.load import load_raw, read_raw
from prodmart.plans.mart_state import MARTS, MartState, averages, merge, sums
from prodmart.plans.marts import mart_brand_quality_fused, mart_nutrient_profile
from prodmart.plans.staging import stg_products
from prodmart.schema import ORDER_COLUMNS, RAW_COLUMNS, conform
from prodmart.sources.tables import Lakehouse

NOW = datetime(2024, 5, 1, tzinfo=timezone.utc)
SCHEMA = "page_no long, pos long, code string, product_name string, pnns_groups_1 string, brands_tags string, " \
         "energy_kcal_100g double, fat_100g double, sugars_100g double, proteins_100g double, salt_100g double, fiber_100g double"


def products(spark, seed, codes):
    rng = random.Random(seed)
    rows = []
    for i, code in enumerate(codes):
        tags = "[" + ", ".join(f"'b{rng.randrange(4)}'" for _ in range(rng.randrange(3))) + "]"
        numbers = [rng.choice([0.1, 0.7, 12.25, 99.0, None if rng.random() < 0.2 else 3.3]) for _ in range(6)]
        rows.append((1, i, f"c{code}", "n", rng.choice(["x", "y", None]), tags, *numbers))
    return conform(spark.createDataFrame(rows, SCHEMA), RAW_COLUMNS + ORDER_COLUMNS).withColumn("ingested_at", F.lit(NOW))


def mart_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def whole(lake, name):
    """The state of everything at once."""
    return sums(MARTS[name].rows(stg_products(read_raw(lake))))


@pytest.mark.parametrize("name", sorted(MARTS))
def test_state_after_batches_is_that_of_the_whole(spark, tmp_path, name):
    """New batches, a batch that changes nothing, and a replaced one; only the batches concerned are read."""
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    state = MartState(lake, name)
    assert state.advance() == 0 and state.read().count() == 0
    steps = [("a", 1, range(40)), ("b", 2, range(30, 70)), ("c", 3, range(20)), ("b", 4, range(50, 90)), ("a", 5, range(35))]
    for version, (batch, seed, codes) in enumerate(steps, 1):
        load_raw(lake, products(spark, seed, codes), batch)
        assert state.advance() == version
        columns = state.state().columns
        assert mart_rows(state.state()) == mart_rows(whole(lake, name).where("total_products > 0").select(columns))
    assert state.advance() == len(steps) and state.log.version() == len(steps) + 1
    assert len(list((tmp_path / "lake" / "marts" / f"state_{name}").glob("part=*"))) == 2


def test_marts_agree_with_a_full_build(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    for batch, codes in (("a", range(60)), ("b", range(40, 120))):
        load_raw(lake, products(spark, batch, codes), batch)
        for name in MARTS:
            MartState(lake, name).advance()
    stg = stg_products(read_raw(lake))
    full = {"mart_nutrient_profile": mart_nutrient_profile(stg, fused=True), "mart_brand_quality": mart_brand_quality_fused(stg)}
    for name, mart in full.items():
        kept = MartState(lake, name).read()
        assert kept.columns == mart.columns
        for a, b in zip(mart_rows(kept), mart_rows(mart), strict=True):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=0.0101, nan_ok=True)


def test_sums_do_not_depend_on_the_order(spark):
    """Values whose double sums depend on the order, undefined and unknown ones, and an average that ends in a tie."""
    values = [0.1, 0.2, 0.3, 1e15, -1e15, 0.005, float("nan"), None, 1e300] * 30
    rows = [("g", v) for v in values] + [("tie", 0.25), ("tie", 0.26)]
    df = spark.createDataFrame(rows, "name string, v double").select("name", *[F.col("v").alias(c) for c in mart_state.AVERAGES])
    found = [{r["name"]: (r["s_fat_100g"], r["n_fat_100g"], r["total_products"]) for r in sums(df.repartition(n)).collect()} for n in (1, 7)]
    assert found[0] == found[1] and found[0]["g"] == (Decimal("18.150000000000"), 180, 270)
    halves = merge([sums(df), sums(df, -1), sums(df)])
    assert {r["name"]: r["s_fat_100g"] for r in halves.collect()} == {k: v[0] for k, v in found[0].items()}
    assert {r["x"]: r["avg_fat"] for r in averages(sums(df), "x").collect()}["tie"] == 0.26
    assert merge([sums(df), sums(df, -1)]).count() == 0
