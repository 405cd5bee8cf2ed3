"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from prodmart.functions import (
    clean_text, clip, empty_list_to_null, explode_tags, first_tag, nutrient_levels, nutrients, parse_map,
)
from prodmart.functions.text import replace_value
from prodmart.operators import profile, quality
from prodmart.operators.keyed import append_new, first_wins, validate_rows
from prodmart.operators.layout import clustered
from prodmart.operators.ranks import dense_ids, exact_quantiles
from prodmart.operators.sketches import DISTINCT_ERROR, RANK_ERROR, estimates, merge_sketches, sketch_columns
from prodmart.operators.stable_ids import IdDictionary
from prodmart.operators.scd2 import SnapshotTable, first_versions, scd2_apply, valid_at
from prodmart.plans import marts, reports, staging, star
from prodmart.plans.clean import clean_products, drop_missing_keys, drop_time_travel, modified_before_created
from prodmart.plans.build import build_marts
from prodmart.plans.load import load_raw, read_raw
from prodmart.plans.mart_state import MARTS, MartState
from prodmart.plans.snapshot import snapshot_rows
from prodmart.schema import COLUMNS, ORDER_COLUMNS, RAW_COLUMNS, conform
from prodmart.session import pin_utc
from prodmart.sources.landing import read_extract_csv, read_pages, union_batches
from prodmart.sources.tables import Lakehouse, read_model_runs, scratch_path, store, write_csv
from prodmart.streaming.incremental import ingest_new_keys, ingest_pages

from .fixture import EVERY, PRODUCT, fx, table

BATCH = "batch"
AS_OF = datetime(2024, 1, 1, tzinfo=timezone.utc)
CUT = "1998-01-01"
BUNDLE = 250
MODELS = [
    "dim_brand", "dim_category", "bridge_product_country", "bridge_product_brand", "dim_country",
    "fact_products", "mart_nutrient_profile", "mart_brand_quality",
]

# Columns the narrow fixture fills; the other kept fields are NULL there and compared by the queries `q_..._all`.
FEED_ORDER = ["page_no", "pos"]
FILLED = [c for c in PRODUCT if c not in FEED_ORDER]
DERIVED = [c for c in RAW_COLUMNS if c not in COLUMNS]
STAGED = [staging.TIMES.get(c, c) for c in FILLED + DERIVED]


class Model:
    """The models of one scale-factor directory, wired together."""

    def __init__(self, spark: SparkSession, sf_dir: str, columns: dict[str, str] = PRODUCT):
        self.spark, self.sf_dir, self.columns = pin_utc(spark), sf_dir, columns

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def fx(self) -> DataFrame:
        return fx(self.spark, self.sf_dir, self.columns)

    @cached_property
    def every(self) -> "Model":
        """The same models with every kept field filled."""
        return Model(self.spark, self.sf_dir, EVERY)

    @cached_property
    def cleaned(self) -> DataFrame:
        return conform(clean_products(self.fx, BATCH, AS_OF), RAW_COLUMNS + ORDER_COLUMNS)

    @cached_property
    def raw(self) -> DataFrame:
        return first_wins(self.cleaned, ["code"], FEED_ORDER).select(*RAW_COLUMNS)

    @cached_property
    def stored(self) -> "Model":
        """The same models over a written raw table, for queries that read it more than once."""
        model = Model(self.spark, self.sf_dir, self.columns)
        model.raw = store(self.raw, "raw")
        return model

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stg_products(self.raw)

    @cached_property
    def nutrients(self) -> DataFrame:
        return staging.stg_nutrients(self.raw)

    @cached_property
    def bridge_country(self) -> DataFrame:
        return star.bridge_product_country(self.stg)

    @cached_property
    def bridge_brand(self) -> DataFrame:
        return star.bridge_product_brand(self.stg)

    @cached_property
    def dim_country(self) -> DataFrame:
        return star.dim_country(self.bridge_country)

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_products(self.stg, star.dim_brand(self.stg), star.dim_category(self.stg))

    @cached_property
    def brand_quality(self) -> DataFrame:
        return marts.mart_brand_quality(self.bridge_brand, self.nutrients)


def filled_fact(fact: DataFrame) -> DataFrame:
    return fact.drop("ecoscore_grade", "ecoscore_score", "ingredients_n", "additives_n")


def lineitem_order() -> list[str]:
    return ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus"]


def customer_state(orders: DataFrame) -> DataFrame:
    """Each customer's latest order."""
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return first_wins(orders, ["o_custkey"], newest).select(
        "o_custkey", F.col("o_orderstatus").alias("status"), "o_orderkey", F.col("o_orderdate").alias("seen_at")
    )


# --- functions -------------------------------------------------------------------------------------------------------

def q_clean_text(m: Model) -> DataFrame:
    return m.table("documents").select("doc_id", clean_text(F.col("text")).alias("clean"))


def q_clean_conversations(m: Model) -> DataFrame:
    return m.table("conversations").select("conv_id", "turn", clean_text(F.col("text")).alias("clean"))


def q_lang_unknown(m: Model) -> DataFrame:
    return m.fx.select("pos", replace_value(clean_text(F.col("lang")), "xx", "unknown").alias("lang"))


def q_clip_completeness(m: Model) -> DataFrame:
    return m.fx.select("pos", clip(F.col("completeness"), 0.0, 1.0).alias("completeness"))


def q_over_complete(m: Model) -> DataFrame:
    return m.fx.where("completeness > 1").agg(F.count(F.lit(1)).alias("n_rows"))


def q_nutrient_levels(m: Model) -> DataFrame:
    return m.fx.select("pos", *nutrient_levels(F.col("nutrient_levels")))


def q_nutrients(m: Model) -> DataFrame:
    return m.fx.select("pos", *nutrients(F.col("nutriments")))


def q_event_props(m: Model) -> DataFrame:
    props = parse_map(F.col("props"))
    return m.table("events").select("event_id", F.element_at(props, F.lit("k")).try_cast("bigint").alias("k"))


def q_first_tag(m: Model) -> DataFrame:
    return m.fx.select("pos", first_tag(F.col("brands_tags")).alias("tag"))


def q_empty_tags(m: Model) -> DataFrame:
    names = ["brands_tags", "countries_tags"]
    return m.fx.select("pos", *[empty_list_to_null(F.col(c)).alias(c) for c in names])


def q_explode_array(m: Model) -> DataFrame:
    return explode_tags(m.fx, "pos", "countries_tags", "tag", mode="array")


# --- cleaning and load -----------------------------------------------------------------------------------------------

def q_drop_missing(m: Model) -> DataFrame:
    return drop_missing_keys(m.fx).select("pos", "code", "product_name")


def q_clean_products(m: Model) -> DataFrame:
    return m.cleaned.select(*FEED_ORDER, *FILLED, *DERIVED)


def q_clean_products_all(m: Model) -> DataFrame:
    """Every kept field: blanks of several kinds, twins, empty lists, undefined numbers."""
    return m.every.cleaned.select(*FEED_ORDER, *RAW_COLUMNS)


def q_first_wins(m: Model) -> DataFrame:
    return first_wins(drop_missing_keys(m.fx), ["code"], FEED_ORDER).select("code", "page_no", "pos", "lang")


def q_first_wins_lineitem(m: Model) -> DataFrame:
    return first_wins(m.table("lineitem"), ["l_partkey"], lineitem_order())


def q_append_new(m: Model) -> DataFrame:
    rows = drop_missing_keys(m.fx).select("code", "page_no", "pos", "lang")
    stored = first_wins(rows.where("page_no <= 5"), ["code"], FEED_ORDER)
    return append_new(stored, rows, ["code"], FEED_ORDER)  # the whole feed comes again


def q_append_new_orders(m: Model) -> DataFrame:
    orders = m.table("orders")
    return append_new(
        orders.where(F.col("o_orderdate") < CUT), orders.where(F.col("o_orderdate") >= CUT),
        ["o_custkey"], ["o_orderdate", "o_orderkey"],
    )


def q_csv_extract(m: Model) -> DataFrame:
    """Written as CSV and read back."""
    path = scratch_path(m.spark, "extract")
    write_csv(conform(m.fx, COLUMNS), path)
    return read_extract_csv(m.spark, path).select(*FILLED)


def by_day(m: Model) -> DataFrame:
    """The feed dealt to two day folders, so that rows of one code lie in different files, the later row in the first day."""
    return m.fx.withColumn("day", F.expr("'d' || (2 - pos % 2)"))


def landed(m: Model) -> DataFrame:
    """Bodies of pages in several day folders, a broken one and one without records among them."""
    # All pages of a bundle are one task's, in their order, so that their file names tell it.
    feed = by_day(m).withColumn("page", F.expr("pos DIV 100")).withColumn("bundle", F.expr(f"page DIV {BUNDLE}"))
    records = feed.repartition("day", "bundle").groupBy("day", "bundle", "page").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.struct(*FILLED).alias("product")))).alias("records")
    )
    body = F.to_json(F.struct(F.col("records.product").alias("products"))).alias("value")
    odd = m.spark.createDataFrame(
        [("d3", 0, 0, "<html>502"), ("d3", 0, 1, '{"count": 0}')], "day string, bundle long, page long, value string"
    )
    return records.select("day", "bundle", "page", body).unionByName(odd)


def land(pages: DataFrame, path: str) -> None:
    """One file per page; a folder holds a bundle of pages, as one for each page takes longer to list than to read."""
    ordered = pages.sortWithinPartitions("day", "bundle", "page").drop("page")
    ordered.write.mode("append").partitionBy("day", "bundle").option("maxRecordsPerFile", 1).text(path)


def q_read_pages(m: Model) -> DataFrame:
    """Landed pages; first row of each code, and the bodies in quarantine."""
    path = scratch_path(m.spark, "landing")
    land(landed(m), path)

    rows, quarantine = read_pages(m.spark, path)
    first = first_wins(drop_missing_keys(rows), ["code"], ORDER_COLUMNS)
    return first.select(
        "code", "product_name", "lang", "nutriscore_score", "created_t", F.lit(None).cast("string").alias("body")
    ).unionByName(quarantine.select(F.btrim("body", F.lit("\n")).alias("body")), allowMissingColumns=True)


def q_ingest_pages(m: Model) -> DataFrame:
    """Two passes of the incremental ingest, the second day landing after the first pass."""
    path, checkpoint = scratch_path(m.spark, "landing"), scratch_path(m.spark, "ingest")
    lake = Lakehouse(m.spark, scratch_path(m.spark, "lake"))
    for late in (False, True):
        land(landed(m).where((F.col("day") == "d2") == F.lit(late)), path)
        ingest_pages(m.spark, path, lake, checkpoint, "feed", as_of=AS_OF).awaitTermination()
    return read_raw(lake).select("code", "product_name", "lang", "energy_kcal_100g", "fat_level")


def q_ingest_new_keys(m: Model) -> DataFrame:
    """The same passes with the known keys in the stream's state, which the second pass takes from the checkpoint."""
    path, checkpoint = scratch_path(m.spark, "landing"), scratch_path(m.spark, "ingest")
    lake = Lakehouse(m.spark, scratch_path(m.spark, "lake"))
    for late in (False, True):
        land(landed(m).where((F.col("day") == "d2") == F.lit(late)), path)
        ingest_new_keys(m.spark, path, lake, checkpoint, "feed", as_of=AS_OF).awaitTermination()
    return read_raw(lake).select("code", "product_name", "lang", "energy_kcal_100g", "fat_level")


def q_load_csv(m: Model) -> DataFrame:
    """Extracts of several folders loaded as one batch; first row of each code in file order."""
    path = scratch_path(m.spark, "extracts")
    extract = by_day(m).repartition("day").sortWithinPartitions("day", "pos")
    extract.select("day", *FILLED).write.partitionBy("day").csv(
        path, header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    lake = Lakehouse(m.spark, scratch_path(m.spark, "lake"))
    load_raw(lake, clean_products(read_extract_csv(m.spark, path, multi_line=False), "csv", AS_OF), "csv")
    return read_raw(lake).select("code", "product_name", "lang", "energy_kcal_100g", "fat_level")


def q_csv_headers(m: Model) -> DataFrame:
    """Extracts whose files differ in the order and number of their columns."""
    path = scratch_path(m.spark, "drifting")
    headers = [FILLED, sorted(FILLED), [c for c in reversed(FILLED) if c not in ("owner", "nova_group")]]
    for i, names in enumerate(headers):
        rows = m.fx.where(F.col("pos") % 3 == i).select(*names)
        write_csv(rows.withColumn("surplus", F.lit("x")) if i == 1 else rows, f"{path}/feed_{i}")
    return read_extract_csv(m.spark, f"{path}/*").select(*FILLED)


def q_union_batches(m: Model) -> DataFrame:
    return union_batches(m.table("documents"), m.table("conversations"))


def q_load_raw(m: Model) -> DataFrame:
    """Two batches: the English feed, then the whole feed."""
    lake = Lakehouse(m.spark, scratch_path(m.spark, "lake"))
    feed = m.fx
    for batch_id, rows in (("first", feed.where("lang = 'en'")), ("second", feed)):
        load_raw(lake, clean_products(rows, batch_id, AS_OF), batch_id)
    return read_raw(lake).select("code", "product_name", "lang", "energy_kcal_100g", "fat_level", "source", "batch_id")


def q_validate_rows(m: Model) -> DataFrame:
    rows = m.fx.select("pos", "code", "product_name", F.repeat("lang", F.col("pos").cast("int") % 9).alias("lang"))
    good, rejected = validate_rows(rows)
    return good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected)


def q_load_counts(m: Model) -> DataFrame:
    good, rejected = validate_rows(m.fx)
    parts = [("loaded", good), ("failed", rejected)]
    counts = [df.agg(F.lit(name).alias("outcome"), F.count(F.lit(1)).alias("n_rows")) for name, df in parts]
    return reduce(DataFrame.unionByName, counts)


def q_load_batch_counts(m: Model) -> DataFrame:
    """What `load_raw` counts while it writes: two batches, the second with names that are too long and known codes."""
    lake = Lakehouse(m.spark, scratch_path(m.spark, "lake"))
    long_lang = F.when(F.col("pos") % 6 == 0, F.repeat("lang", F.lit(9))).otherwise(F.col("lang"))
    feeds = {"first": m.fx.where("lang = 'en'"), "second": m.fx.withColumn("lang", long_lang)}
    rows = []
    for batch_id, feed in feeds.items():
        counts = load_raw(lake, clean_products(feed, batch_id, AS_OF), batch_id)
        rows.append((batch_id, counts.received, counts.rejected, counts.inserted))
    return m.spark.createDataFrame(rows, "batch_id string, received long, rejected long, inserted long")


def q_time_sanity(m: Model) -> DataFrame:
    return drop_time_travel(m.raw).select("code", "created_t", "last_modified_t")


def q_time_travel_rows(m: Model) -> DataFrame:
    return modified_before_created(m.raw).agg(F.count(F.lit(1)).alias("n_rows"))


# --- staging and star schema -----------------------------------------------------------------------------------------

def q_stg_products(m: Model) -> DataFrame:
    return m.stg.select(*STAGED)


def q_stg_products_all(m: Model) -> DataFrame:
    return m.every.stg


def q_stg_products_energy_null(m: Model) -> DataFrame:
    return staging.stg_products(m.raw, energy_rule="null").select("code", "energy_kcal_100g")


def q_stg_nutrients(m: Model) -> DataFrame:
    return m.nutrients


def q_bridge_country(m: Model) -> DataFrame:
    return m.bridge_country


def q_bridge_brand(m: Model) -> DataFrame:
    return m.bridge_brand


def q_dim_brand(m: Model) -> DataFrame:
    m = m.stored
    return star.dim_brand(m.stg)


def q_dim_brand_one_owner(m: Model) -> DataFrame:
    m = m.stored
    return star.dim_brand(m.stg, one_per_brand=True)


def q_dim_category(m: Model) -> DataFrame:
    m = m.stored
    return star.dim_category(m.stg)


def q_dim_country(m: Model) -> DataFrame:
    m = m.stored
    return m.dim_country


def q_dim_brand_stable(m: Model) -> DataFrame:
    """Ids after a second build that knows more brands: the first build's are kept."""
    ids = IdDictionary(m.spark, scratch_path(m.spark, "ids"), "brand_id")
    stg = m.stored.stg
    star.dim_brand(stg.where("lang = 'en'"), ids=ids)
    return star.dim_brand(stg, ids=ids)


def q_dense_ids_orders(m: Model) -> DataFrame:
    orders = m.table("orders").select("o_orderpriority", "o_custkey", "o_orderkey")
    return dense_ids(orders, ["o_orderpriority", "o_custkey", "o_orderkey"], "row_id")


def q_fact_products(m: Model) -> DataFrame:
    m = m.stored
    return filled_fact(m.fact)


def q_fact_products_all(m: Model) -> DataFrame:
    return m.every.stored.fact


def q_mart_nutrient_profile(m: Model) -> DataFrame:
    m = m.stored
    return marts.mart_nutrient_profile(m.stg, m.nutrients)


def q_mart_nutrient_profile_fused(m: Model) -> DataFrame:
    return marts.mart_nutrient_profile(m.stg, fused=True)


def q_mart_brand_quality(m: Model) -> DataFrame:
    m = m.stored
    return m.brand_quality


def q_mart_brand_quality_fused(m: Model) -> DataFrame:
    return marts.mart_brand_quality_fused(m.stg)


def q_mart_incremental(m: Model) -> DataFrame:
    """Both marts from stored sums: two batches, each taken in after its load, the second loaded twice."""
    lake = Lakehouse(m.spark, scratch_path(m.spark, "lake"))
    cleaned = store(m.cleaned, "cleaned")
    states = {name: MartState(lake, name) for name in MARTS}
    for batch_id, pages, half in (("a", "page_no < 6", None), ("b", "page_no > 5", "pos % 2 = 0"), ("b", "page_no > 5", None)):
        rows = cleaned.where(pages)
        load_raw(lake, rows if half is None else rows.where(half), batch_id)
        for state in states.values():
            state.advance()
    return reduce(DataFrame.unionByName, [
        state.read().withColumnRenamed(state.mart.out, "name").withColumn("mart", F.lit(name)) for name, state in states.items()
    ])


def q_rank_brands(m: Model) -> DataFrame:
    m = m.stored
    return marts.rank_brands(m.brand_quality, by="avg_energy_kcal", limit=10)


def q_group_profile_lineitem(m: Model) -> DataFrame:
    """Rounded averages over few large groups."""
    names = {"l_quantity": "avg_quantity", "l_extendedprice": "avg_price", "l_discount": "avg_discount"}
    return (
        m.table("lineitem").groupBy("l_returnflag")
        .agg(F.count("l_orderkey").alias("n_lines"), *marts.rounded_averages(names, 4))
        .where("n_lines > 2")
    )


def q_group_totals_lineitem(m: Model) -> DataFrame:
    """Totals over many small groups; the averages of small groups end in ties that doubles round either way."""
    return (
        m.table("lineitem").groupBy("l_suppkey", "l_returnflag")
        .agg(
            F.count("l_orderkey").alias("n_lines"), F.sum("l_quantity").alias("sum_quantity"),
            F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"),
        )
        .where("n_lines > 2")
    )


# --- history ---------------------------------------------------------------------------------------------------------

def generations(m: Model) -> tuple[DataFrame, DataFrame]:
    """All products twice, the second time with change times moved by NOVA group.

    Codes are changed by language in the first and by grade in the second, so that keys vanish and appear.
    """
    known = F.col("lang").isin("en", "unknown")
    stg = m.stg
    stored = snapshot_rows(stg.withColumn("code", F.when(known, F.col("code")).otherwise(F.concat(F.lit("old-"), "code"))))
    moved = (
        F.when(F.col("nova_group") <= 2, F.col("last_modified_at") + F.expr("INTERVAL 1 HOUR"))
        .when(F.col("nova_group") == 3, F.col("last_modified_at") - F.expr("INTERVAL 1 HOUR"))
        .otherwise(F.col("last_modified_at"))
    )
    fresh = F.when(F.col("nutriscore_grade") == "e", F.concat(F.lit("new-"), "code")).otherwise(F.col("code"))
    incoming = snapshot_rows(stg.withColumn("code", fresh))
    return stored, incoming.withColumn("last_modified_at", moved)


def q_products_snapshot(m: Model) -> DataFrame:
    return first_versions(snapshot_rows(m.stg), "code", "last_modified_at").drop("ecoscore_grade", "ecoscore_score")


def q_products_snapshot_all(m: Model) -> DataFrame:
    return first_versions(snapshot_rows(m.every.stg), "code", "last_modified_at")


def q_scd2_apply(m: Model) -> DataFrame:
    m = m.stored
    stored, incoming = generations(m)
    current = first_versions(stored, "code", "last_modified_at")
    return scd2_apply(current, incoming, "code", "last_modified_at").drop("ecoscore_grade", "ecoscore_score")


def q_snapshot_table(m: Model) -> DataFrame:
    """The same history through two versions of a stored table."""
    table = SnapshotTable(m.spark, scratch_path(m.spark, "snapshot"))
    for rows in generations(m.stored):
        table.apply(rows, "code", "last_modified_at")
    return table.read().drop("ecoscore_grade", "ecoscore_score")


def order_history(m: Model) -> DataFrame:
    orders = m.table("orders")
    states = [customer_state(orders.where(F.col("o_orderdate") < CUT)), customer_state(orders)]
    history = first_versions(states[0], "o_custkey", "seen_at")
    return scd2_apply(history, states[1], "o_custkey", "seen_at")


def q_scd2_orders(m: Model) -> DataFrame:
    return order_history(m)


def q_scd2_own_names(m: Model) -> DataFrame:
    """The order history when the input's columns are named like the history's own, through a stored table."""
    orders = m.table("orders")
    table = SnapshotTable(m.spark, scratch_path(m.spark, "snapshot"))
    for rows in (orders.where(F.col("o_orderdate") < CUT), orders):
        state = customer_state(rows).withColumnsRenamed({"seen_at": "updated_at", "status": "valid_to", "o_custkey": "scd_id"})
        table.apply(state, "scd_id", "updated_at")
    return table.read()


def q_scd2_valid_at(m: Model) -> DataFrame:
    return valid_at(order_history(m), F.lit(CUT).cast("timestamp")).select("o_custkey", "status", "seen_at")


# --- reports ---------------------------------------------------------------------------------------------------------

def q_products_by_country(m: Model) -> DataFrame:
    m = m.stored
    rows = reports.products_by_country(m.fact, m.bridge_country, m.dim_country)
    return filled_fact(rows)


def q_explore(m: Model) -> DataFrame:
    m = m.stored
    stg = m.stg
    categories = star.dim_category(stg)
    fact = star.fact_products(stg, star.dim_brand(stg), categories)
    rows = reports.explore_products(
        fact, m.bridge_country, categories, country_names=["country-3", "country-8"],
        groups=["economy", "promo", "standard"], grades=["a", "b", "c"], nova=[1, 2, 3], calories=(50, 900),
    )
    return filled_fact(rows)


def q_explore_clustered(m: Model) -> DataFrame:
    """The same filters on a fact table written along a curve over the columns they ask for."""
    m = m.stored
    stg = m.stg
    categories = star.dim_category(stg)
    fact = star.fact_products(stg, star.dim_brand(stg), categories)
    lake = Lakehouse(m.spark, scratch_path(m.spark, "lake"))
    stored = lake.refresh(clustered(fact, ["nutriscore_grade", "nova_group", "energy_kcal_100g", "category_id"], 8), "marts", "fact")
    rows = reports.explore_products(
        stored, m.bridge_country, categories, country_names=["country-3", "country-8"],
        groups=["economy", "promo", "standard"], grades=["a", "b", "c"], nova=[1, 2, 3], calories=(50, 900),
    )
    return filled_fact(rows)


def q_kpis(m: Model) -> DataFrame:
    m = m.stored
    return reports.kpis(m.fact)


def q_chart_series(m: Model) -> DataFrame:
    m = m.stored
    return reports.chart_series(m.fact, "nutriscore_grade")


# --- data quality ----------------------------------------------------------------------------------------------------

def q_dq_not_null(m: Model) -> DataFrame:
    return quality.not_null(m.fx, "code").select("pos")


def q_dq_unique(m: Model) -> DataFrame:
    return quality.unique(m.fx, "code")


def q_dq_accepted(m: Model) -> DataFrame:
    return quality.accepted_values(m.fx, "nutriscore_grade", quality.NUTRISCORE_GRADES)


def q_dq_relationships(m: Model) -> DataFrame:
    keys = m.table("customer").select(F.expr("IF(c_acctbal > 0, c_custkey, -c_custkey)").alias("c_custkey"))
    return quality.relationships(m.table("orders"), "o_custkey", keys, "c_custkey")


def q_dq_ranges(m: Model) -> DataFrame:
    rows = m.cleaned
    checks = [
        quality.check_expression("energy_range", "rows", "energy_kcal_100g", quality.energy_out_of_range()),
        quality.check_expression("share_range", "rows", "nutrients", quality.share_above_100()),
        quality.check_expression("completeness_range", "fx", "completeness", F.expr("completeness < 0 OR completeness > 1")),
    ]
    return quality.run_checks(checks, {"rows": rows, "fx": m.fx})


def q_dq_orphans(m: Model) -> DataFrame:
    m = m.stored
    bridge = star.bridge_product_brand(m.raw)
    return quality.orphans(bridge, m.stg, "code").select("code", "brand_name")


def q_dq_star(m: Model) -> DataFrame:
    m = m.stored
    stg = m.stg
    bridge = star.bridge_product_country(stg)
    brand, category = star.dim_brand(stg), star.dim_category(stg)
    frames = {
        "raw_products": m.raw, "stg_products": stg, "dim_brand": brand, "dim_category": category,
        "dim_country": star.dim_country(bridge), "bridge_product_country": bridge,
        "bridge_product_brand": star.bridge_product_brand(stg),
        "fact_products": star.fact_products(stg, brand, category),
    }
    return quality.run_checks(quality.star_checks(), frames)


def q_freshness(m: Model) -> DataFrame:
    return quality.freshness(m.table("events"), "ts", "2024-02-01 12:00:00")


# --- profiles and audit ----------------------------------------------------------------------------------------------

def q_profile_columns(m: Model) -> DataFrame:
    return profile.profile_columns(m.fx.select("code", "owner", "lang", "pos", "created_t", "nutriscore_grade"))


def q_null_counts(m: Model) -> DataFrame:
    return profile.null_counts(m.fx)


def rounded_description(df: DataFrame) -> DataFrame:
    numbers = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return df.select("column", "count", *[F.round(n, 4).alias(n) for n in numbers])


def q_describe(m: Model) -> DataFrame:
    return rounded_description(profile.describe_numeric(m.fx.drop("page_no")))


def q_describe_lineitem(m: Model) -> DataFrame:
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded_description(profile.describe_numeric(m.table("lineitem"), names))


def q_quantiles_lineitem(m: Model) -> DataFrame:
    """Quartiles of a group that is missing for a third of the rows."""
    lines = m.table("lineitem").selectExpr("nullif(l_returnflag, 'R') AS flag", "CAST(l_extendedprice AS DOUBLE) AS price")
    found = exact_quantiles(lines, "flag", "price", [0.25, 0.5, 0.75])
    return found.select("flag", *[F.round(f"q{i}", 4).alias(f"q{i}") for i in range(3)])


def q_sketch_profile(m: Model) -> DataFrame:
    """Sketches of the order lines in three parts, merged: exact counts, and whether the estimates keep their bounds."""
    lines = m.table("lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus")
    parts = [sketch_columns(lines.where(f"l_orderkey % 3 = {i}")) for i in range(3)]
    merged = estimates(merge_sketches(reduce(DataFrame.unionByName, parts)))
    entries = [(c, F.countDistinct(c).alias(f"d_{c}")) for c in lines.columns]
    exact = lines.agg(*[e for _, e in entries]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d_{c}").alias("exact")) for c in lines.columns]))
    )
    numbers = profile.numeric_columns(lines)
    quartiles = exact_quantiles(
        lines.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in numbers]))),
        "column", "v", [p + e for p in profile.QUARTILES for e in (-RANK_ERROR, RANK_ERROR)],
    )
    inside = [F.col(f"merged.q{i}").between(F.col(f"quartiles.q{2 * i}"), F.col(f"quartiles.q{2 * i + 1}")) for i in range(3)]
    joined = merged.alias("merged").join(exact, "column").join(quartiles.alias("quartiles"), "column", "left")
    return joined.select(
        "column", "n_rows", "n_known",
        (F.abs(F.col("n_distinct") - F.col("exact")) <= DISTINCT_ERROR * F.col("exact")).alias("distinct_within"),
        reduce(Column.__and__, inside).alias("quartiles_within"),
    )


def q_sample_values(m: Model) -> DataFrame:
    return profile.sample_values(m.fx)


def q_sample_documents(m: Model) -> DataFrame:
    return profile.sample_values(m.table("documents"), size=200)


def q_profile_map_keys(m: Model) -> DataFrame:
    return profile.map_key_profile(m.fx, "nutriments")


def q_profile_map_values(m: Model) -> DataFrame:
    return profile.map_value_profile(m.fx, "nutrient_levels")


def q_profile_event_values(m: Model) -> DataFrame:
    return profile.map_value_profile(m.table("events"), "props")


def q_profile_list(m: Model) -> DataFrame:
    return profile.list_profile(m.fx, "countries_tags")


def q_element_count(m: Model) -> DataFrame:
    return profile.element_count(m.fx, "brands_tags")


def q_audit(m: Model) -> DataFrame:
    """The audit log of a gated build over the loaded products."""
    tables = build_marts(m.spark, m.stored.raw, scratch_path(m.spark, "lake"), as_of=AS_OF)
    return tables["model_runs"]


def q_publish_after_gate(m: Model) -> DataFrame:
    """The build served after a second one, in which every tenth name is missing, failed its check."""
    lake = Lakehouse(m.spark, scratch_path(m.spark, "lake"))
    customers = m.table("customer").select("c_custkey", "c_name")
    broken = customers.withColumn("c_name", F.expr("IF(c_custkey % 10 = 0, NULL, c_name)"))
    checks = [quality.check_not_null("customer", "c_name")]
    for rows in (customers, broken):
        try:
            lake.refresh(rows, "marts", "customer", check=lambda written: quality.gate(checks, {"customer": written}))
        except quality.DataQualityError:
            continue
    return lake.latest("marts", "customer")


def q_build_marts(m: Model) -> DataFrame:
    """A gated build of every model: the audit log with the rows of each table."""
    tables = build_marts(m.spark, m.stored.raw, scratch_path(m.spark, "lake"), as_of=AS_OF)
    sizes = [
        tables[name].agg(F.lit(name).alias("model_name"), F.count(F.lit(1)).alias("n_rows")) for name in MODELS
    ]
    return tables["model_runs"].join(reduce(DataFrame.unionByName, sizes), "model_name")


def _bind(query: Callable[[Model], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(Model(spark, sf_dir))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {name: _bind(value) for name, value in list(globals().items()) if name.startswith("q_")}
