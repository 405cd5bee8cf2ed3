"""The SQL each query must agree with, for DuckDB."""

from __future__ import annotations

from .fixture import EVERY, FX_SQL, PRODUCT, TWINS, select_sql
from .spark_queries import CUT, FILLED, MODELS, STAGED

NUTRIENTS = ["energy_kcal_100g", "fat_100g", "saturated_fat_100g", "sugars_100g", "salt_100g", "proteins_100g", "fiber_100g"]
LEVELS = ["fat_level", "salt_level", "saturated_fat_level", "sugars_level"]
AVG_NAMES = ["avg_energy_kcal", "avg_fat", "avg_saturated_fat", "avg_sugars", "avg_salt", "avg_proteins", "avg_fiber"]
STAMP = "TIMESTAMP '2024-01-01 00:00:00'"


def clean(col: str) -> str:
    return f"strip_accents(lower(trim({col})))"


def level(key: str) -> str:
    return f"""CASE WHEN nutrient_levels IS NULL THEN NULL
        ELSE coalesce(json_extract_string(replace(nutrient_levels, chr(39), '"'), '$."{key}"'), 'unknown') END"""


def nutrient(key: str) -> str:
    return f"""TRY_CAST(json_extract_string(replace(nutriments, chr(39), '"'), '$."{key}"') AS DOUBLE)"""


LEVEL_SQL = ", ".join(f"{level(k)} AS {n}" for k, n in zip(["fat", "salt", "saturated-fat", "sugars"], LEVELS))
NUTRIENT_SQL = ", ".join(
    f"{nutrient(k)} AS {n}"
    for k, n in zip(
        ["energy-kcal_100g", "fat_100g", "saturated-fat_100g", "sugars_100g", "salt_100g", "proteins_100g", "fiber_100g"],
        NUTRIENTS,
    )
)
AVG_SQL = ", ".join(f"round(avg(n.{c}), 2) AS {a}" for c, a in zip(NUTRIENTS, AVG_NAMES))

CLEANED = {
    "product_name": clean("product_name"),
    "lang": f"CASE WHEN {clean('lang')} = 'xx' THEN 'unknown' ELSE {clean('lang')} END",
    "owner": clean("owner"),
    "pnns_groups_1": clean("pnns_groups_1"),
    "pnns_groups_2": clean("pnns_groups_2"),
    "nutriscore_grade": clean("nutriscore_grade"),
    "completeness": "CASE WHEN completeness IS NULL THEN NULL ELSE greatest(0.0, least(1.0, completeness)) END",
}
ALL_TEXTS = [
    "generic_name", "quantity", "product_quantity_unit", "serving_size", "purchase_places", "nutrition_data_per",
    "ecoscore_grade", "ingredients_text",
]


def clean_any(col: str) -> str:
    """As `clean`, with blanks of any kind, letters that do not decompose, and a fraction."""
    text = rf"lower(regexp_replace({col}, '^[\s\x0b\x{{a0}}]+|[\s\x0b\x{{a0}}]+$', '', 'g'))"
    return f"strip_accents(replace(replace(replace(replace({text}, 'ß', 'ss'), 'œ', 'oe'), 'ł', 'l'), '½', '1/2'))"


# An undefined share is unknown; DuckDB would take it for the largest number.
CLEANED_ALL = CLEANED | {c: clean_any(c) for c in ALL_TEXTS} | {
    "completeness": "CASE WHEN NOT isnan(completeness) THEN greatest(0.0, least(1.0, completeness)) END",
    "manufacturing_places_tags": "nullif(manufacturing_places_tags, '[]')",
}
CLEAN_ALL_SQL = ", ".join(f"{CLEANED_ALL.get(c, c)} AS {c}" for c in EVERY if c not in TWINS)
CLEAN_SQL = ", ".join(f"{CLEANED.get(c, c)} AS {c}" for c in PRODUCT)

# what stands before the first comma, without brackets and quotes
FIRST_TAG = r"""trim(regexp_extract(regexp_replace(brands_tags, '[][\x22\x27]', '', 'g'), '^[^,]*'))"""


def tags(col: str) -> str:
    return rf"""SELECT code, unnest(regexp_split_to_array(regexp_replace({col}, '[][\x22\x27 ]', '', 'g'), ',')) AS tag
        FROM stg WHERE {col} IS NOT NULL AND {col} != '[]'"""


def epoch(col: str) -> str:
    return f"make_timestamp({col} * 1000000)"


STG_SQL = ", ".join(
    {
        "nutriscore_grade": "CASE WHEN trim(nutriscore_grade) IN ('not-applicable', 'unknown') THEN NULL "
                            "ELSE nutriscore_grade END AS nutriscore_grade",
        "created_at": f"{epoch('created_t')} AS created_at",
        "last_modified_at": f"{epoch('last_modified_t')} AS last_modified_at",
    }.get(c, c)
    for c in STAGED
)
FACT_COLUMNS = (
    ["code", "product_name", "lang", "brand_id", "category_id", "nutriscore_grade", "nutriscore_score", "nova_group"]
    + NUTRIENTS + LEVELS + ["created_at", "last_modified_at", "completeness", "ingested_at", "batch_id"]
)
SNAPSHOT = (
    ["code", "product_name", "nutriscore_grade", "nutriscore_score", "nova_group"] + LEVELS
    + ["owner", "brands_tags", "completeness", "last_modified_at"]
)
META = "scd_id, updated_at, valid_from, valid_to"


def versions(source: str, key: str, at: str, moment: str = "epoch_us({})") -> str:
    """`moment` is what of the change time enters the id: microseconds, of a time without zone its text."""
    return f"""SELECT *, md5(CAST({key} AS VARCHAR) || '|' || CAST({moment.format(at)} AS VARCHAR)) AS scd_id, {at} AS updated_at,
        {at} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM {source}"""


def merged(old: str, new: str, key: str, columns: str) -> str:
    """Open versions `old` and versions of the input `new`."""
    return f"""SELECT {columns}, scd_id, updated_at, valid_from,
            (SELECT any_value(n.updated_at) FROM {new} n WHERE n.{key} = o.{key} AND n.updated_at > o.updated_at) AS valid_to
        FROM {old} o
        UNION ALL
        SELECT {columns}, scd_id, updated_at, valid_from, valid_to FROM {new} n
        WHERE NOT EXISTS (SELECT 1 FROM {old} o WHERE o.{key} = n.{key} AND n.updated_at <= o.updated_at)"""


MOVED = """CASE WHEN nova_group <= 2 THEN last_modified_at + INTERVAL 1 HOUR
    WHEN nova_group = 3 THEN last_modified_at - INTERVAL 1 HOUR ELSE last_modified_at END"""


def state(cut: str) -> str:
    return f"""SELECT o_custkey, o_orderstatus AS status, o_orderkey, o_orderdate AS seen_at FROM orders
        WHERE o_orderdate < TIMESTAMP '{cut}'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


KEEP = """energy_kcal_100g < 1000 AND sugars_100g < 100 AND fat_100g < 100 AND proteins_100g < 100 AND salt_100g < 100"""
FACT_ALL = FACT_COLUMNS + ["ecoscore_grade", "ecoscore_score", "ingredients_n", "additives_n"]
SNAPSHOT_ALL = SNAPSHOT + ["ecoscore_grade", "ecoscore_score"]


def joined_fact(staged: str, columns: list[str]) -> str:
    chosen = ", ".join({"brand_id": "b.brand_id", "category_id": "c.category_id"}.get(n, "s." + n) for n in columns)
    return f"""SELECT {chosen} FROM (SELECT *, {FIRST_TAG} AS first_tag FROM {staged}) s
        LEFT JOIN dim_brand b ON s.first_tag = b.brand_name
        LEFT JOIN dim_category c ON s.pnns_groups_1 = c.pnns_groups_1 AND s.pnns_groups_2 = c.pnns_groups_2"""


# Named steps in dependency order.
STEPS = {
    "fx": ([], FX_SQL),
    "cleaned": (
        ["fx"],
        f"""SELECT {CLEAN_SQL}, {LEVEL_SQL}, {NUTRIENT_SQL}, 'batch' AS batch_id, {STAMP} AS ingested_at
            FROM fx WHERE code IS NOT NULL AND product_name IS NOT NULL""",
    ),
    "raw": (["cleaned"], "SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY code ORDER BY page_no, pos) = 1"),
    "stg": (
        ["raw"],
        f"""SELECT {STG_SQL} FROM raw WHERE energy_kcal_100g < 1000 AND sugars_100g < 100 AND fat_100g < 100
            AND proteins_100g < 100 AND salt_100g < 100""",
    ),
    "nut": (
        ["raw"],
        f"SELECT code, {', '.join(NUTRIENTS + LEVELS)}, nutrient_levels, batch_id, ingested_at FROM raw",
    ),
    "bridge_country": (
        ["stg"],
        f"""SELECT code, tag AS country_code, replace(tag, 'en:', '') AS country_name
            FROM ({tags('countries_tags')}) WHERE tag != ''""",
    ),
    "bridge_brand": (["stg"], f"SELECT code, tag AS brand_name FROM ({tags('brands_tags')}) WHERE tag != ''"),
    "dim_brand": (
        ["stg"],
        f"""SELECT row_number() OVER (ORDER BY brand_name, owner NULLS LAST) AS brand_id, brand_name, owner
            FROM (SELECT DISTINCT {FIRST_TAG} AS brand_name, owner FROM stg
                  WHERE brands_tags IS NOT NULL AND brands_tags != '[]') WHERE brand_name != ''""",
    ),
    "dim_category": (
        ["stg"],
        """SELECT row_number() OVER (ORDER BY pnns_groups_1, pnns_groups_2 NULLS LAST) AS category_id,
            pnns_groups_1, pnns_groups_2
            FROM (SELECT DISTINCT pnns_groups_1, pnns_groups_2 FROM stg WHERE pnns_groups_1 IS NOT NULL)""",
    ),
    "dim_country": (
        ["bridge_country"],
        """SELECT row_number() OVER (ORDER BY country_code) AS country_id, country_code, country_name
            FROM (SELECT DISTINCT country_code, country_name FROM bridge_country)""",
    ),
    "fact": (
        ["stg", "dim_brand", "dim_category"],
        joined_fact("stg", FACT_COLUMNS),
    ),
    "all_fx": ([], select_sql(EVERY)),
    "all_cleaned": (
        ["all_fx"],
        f"""SELECT {CLEAN_ALL_SQL}, {LEVEL_SQL}, {NUTRIENT_SQL}, 'batch' AS batch_id, {STAMP} AS ingested_at
            FROM all_fx WHERE code IS NOT NULL AND product_name IS NOT NULL""",
    ),
    "all_stg": (
        ["all_cleaned"],
        f"""SELECT * EXCLUDE (page_no, pos, created_t, last_modified_t, last_updated_t)
                REPLACE (CASE WHEN trim(nutriscore_grade) IN ('not-applicable', 'unknown') THEN NULL ELSE nutriscore_grade END
                         AS nutriscore_grade),
                {epoch('created_t')} AS created_at, {epoch('last_modified_t')} AS last_modified_at, {epoch('last_updated_t')} AS last_updated_at
            FROM (FROM all_cleaned QUALIFY row_number() OVER (PARTITION BY code ORDER BY page_no, pos) = 1) WHERE {KEEP}""",
    ),
    "all_fact": (["all_stg", "dim_brand", "dim_category"], joined_fact("all_stg", FACT_ALL)),
    "quality": (
        ["bridge_brand", "nut"],
        f"""SELECT upper(b.brand_name) AS brand_name, count(b.code) AS total_products, {AVG_SQL}
            FROM bridge_brand b JOIN nut n ON b.code = n.code GROUP BY upper(b.brand_name) HAVING count(b.code) > 2""",
    ),
    "snap": (["stg"], f"SELECT {', '.join(SNAPSHOT)}, lang FROM stg"),
    "snap_old": (["snap"], versions(
        """(SELECT * EXCLUDE (lang) REPLACE (CASE WHEN lang IN ('en', 'unknown') THEN code ELSE 'old-' || code END AS code)
            FROM snap)""", "code", "last_modified_at",
    )),
    "snap_in": (
        ["snap"],
        f"""SELECT * EXCLUDE (lang) REPLACE ({MOVED} AS last_modified_at,
            CASE WHEN nutriscore_grade = 'e' THEN 'new-' || code ELSE code END AS code) FROM snap""",
    ),
    "snap_new": (["snap_in"], versions("snap_in", "code", "last_modified_at")),
    "state_old": ([], state(CUT)),
    "state_new": ([], state("9999-12-31")),
    "cust_old": (["state_old"], versions("state_old", "o_custkey", "seen_at", "{}")),
    "cust_new": (["state_new"], versions("state_new", "o_custkey", "seen_at", "{}")),
    "cust": (["cust_old", "cust_new"], merged("cust_old", "cust_new", "o_custkey", "o_custkey, status, o_orderkey, seen_at")),
}


def needed(names: list[str]) -> list[str]:
    found: list[str] = []
    for name in names:
        for step in needed(STEPS[name][0]) + [name]:
            if step not in found:
                found.append(step)
    return found


def sql(names: str, body: str) -> str:
    """`body` over the named steps."""
    steps = needed(names.split())
    return f"WITH {', '.join(f'{n} AS ({STEPS[n][1]})' for n in steps)} {body}" if steps else body


def check(name: str, model: str, column: str, failures: str, severity: str = "error") -> str:
    return f"""SELECT '{name}' AS "check", '{model}' AS model, '{column}' AS "column", f AS failures,
        CASE WHEN f = 0 THEN 'pass' ELSE '{severity}' END AS status FROM (SELECT ({failures}) AS f)"""


def null_check(label: str, table: str, column: str) -> str:
    return check("not_null", label, column, f"SELECT count(*) FROM {table} WHERE {column} IS NULL")


def unique_check(label: str, table: str, column: str) -> str:
    return check(
        "unique", label, column,
        f"""SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL
            GROUP BY {column} HAVING count(*) > 1)""",
    )


def count_check(name: str, label: str, column: str, table: str, condition: str) -> str:
    return check(name, label, column, f"SELECT count(*) FROM {table} WHERE {condition}")


def value_check(column: str, values: str) -> str:
    return check(
        "accepted_values", "stg_products", column,
        f"SELECT count(DISTINCT {column}) FROM stg WHERE {column} NOT IN {values}",
    )


def parent_check(column: str, parent: str) -> str:
    return check(
        "relationships", "fact_products", column,
        f"""SELECT count(*) FROM fact WHERE {column} IS NOT NULL
            AND {column} NOT IN (SELECT {column} FROM {parent})""",
    )


ENERGY = "energy_kcal_100g < 0 OR energy_kcal_100g > 1000"
SHARES = "fat_100g > 100 OR sugars_100g > 100 OR proteins_100g > 100 OR salt_100g > 100"
STAR = " UNION ALL ".join(
    [
        null_check("raw_products", "raw", "code"), unique_check("raw_products", "raw", "code"),
        null_check("raw_products", "raw", "product_name"),
        null_check("stg_products", "stg", "code"), unique_check("stg_products", "stg", "code"),
        null_check("stg_products", "stg", "product_name"),
        value_check("nutriscore_grade", "('a', 'b', 'c', 'd', 'e')"), value_check("nova_group", "(1, 2, 3, 4)"),
        null_check("stg_products", "stg", "completeness"),
        count_check("completeness_range", "stg_products", "completeness", "stg", "completeness < 0 OR completeness > 1"),
        null_check("dim_brand", "dim_brand", "brand_id"), unique_check("dim_brand", "dim_brand", "brand_id"),
        null_check("dim_brand", "dim_brand", "brand_name"),
        null_check("dim_category", "dim_category", "category_id"), unique_check("dim_category", "dim_category", "category_id"),
        null_check("dim_category", "dim_category", "pnns_groups_1"),
        null_check("dim_country", "dim_country", "country_id"), null_check("dim_country", "dim_country", "country_code"),
        unique_check("dim_country", "dim_country", "country_code"),
        null_check("bridge_product_country", "bridge_country", "code"),
        null_check("bridge_product_country", "bridge_country", "country_code"),
        count_check("no_orphan_products", "bridge_product_brand", "code", "bridge_brand",
                    "code NOT IN (SELECT code FROM stg)"),
        null_check("fact_products", "fact", "code"),
        parent_check("brand_id", "dim_brand"), parent_check("category_id", "dim_category"),
        count_check("energy_range", "fact_products", "energy_kcal_100g", "fact", ENERGY),
        count_check("share_range", "fact_products", "nutrients", "fact", SHARES),
    ]
)


def described(source: str, column: str) -> str:
    q = ", ".join(
        f"round(quantile_cont(CAST({column} AS DOUBLE), {p}), 4) AS {n}" for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    return f"""SELECT '{column}' AS "column", count({column}) AS count, round(avg({column}), 4) AS mean,
        round(stddev_samp({column}), 4) AS std, round(min(CAST({column} AS DOUBLE)), 4) AS min, {q},
        round(max(CAST({column} AS DOUBLE)), 4) AS max FROM {source}"""


def per_column(columns: list[str], body: str, source: str = "fx") -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", {body.replace('$c', c)} FROM {source}""" for c in columns)


TYPES = {"pos": "bigint", "created_t": "bigint"}
STRINGS = ["code", "product_name", "lang", "owner", "brands_tags", "countries_tags", "pnns_groups_1", "pnns_groups_2",
           "nutriscore_grade", "nutrient_levels", "nutriments"]
FX_NUMBERS = ["pos", "nutriscore_score", "nova_group", "completeness", "created_t", "last_modified_t"]
PRICE_CLEAN = r"replace(strip_accents(lower(regexp_replace(text, '^\s+|\s+$', '', 'g'))), 'ß', 'ss')"
JSON_LEVELS = """replace(nutrient_levels, chr(39), '"')"""
JSON_NUTRIMENTS = """replace(nutriments, chr(39), '"')"""
LIST_ITEMS = """unnest(CAST(replace({}, chr(39), '"') AS JSON[])) ->> '$'"""
BY_COUNTRY = f"""SELECT p.*, d.code_bridge, d.country_name FROM fact p JOIN (
    SELECT b.code AS code_bridge, c.country_name FROM bridge_country b JOIN dim_country c ON b.country_name = c.country_name
    ) d ON p.code = d.code_bridge"""

ORACLE = {
    "q_clean_text": f"SELECT doc_id, {PRICE_CLEAN} AS clean FROM documents",
    "q_clean_conversations": f"SELECT conv_id, turn, {PRICE_CLEAN} AS clean FROM conversations",
    "q_lang_unknown": sql("fx", f"SELECT pos, {CLEANED['lang']} AS lang FROM fx"),
    "q_clip_completeness": sql("fx", f"SELECT pos, {CLEANED['completeness']} AS completeness FROM fx"),
    "q_over_complete": sql("fx", "SELECT count(*) AS n_rows FROM fx WHERE completeness > 1"),
    "q_nutrient_levels": sql("fx", f"SELECT pos, {LEVEL_SQL} FROM fx"),
    "q_nutrients": sql("fx", f"SELECT pos, {NUTRIENT_SQL} FROM fx"),
    "q_event_props": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "q_first_tag": sql("fx", f"SELECT pos, {FIRST_TAG} AS tag FROM fx"),
    "q_empty_tags": sql("fx", "SELECT pos, nullif(brands_tags, '[]') AS brands_tags, "
                              "nullif(countries_tags, '[]') AS countries_tags FROM fx"),
    "q_explode_array": sql("fx", f"SELECT pos, {LIST_ITEMS.format('countries_tags')} AS tag FROM fx WHERE countries_tags != '[]'"),
    "q_drop_missing": sql("fx", "SELECT pos, code, product_name FROM fx WHERE code IS NOT NULL AND product_name IS NOT NULL"),
    "q_clean_products": sql("cleaned", "SELECT * FROM cleaned"),
    "q_first_wins": sql(
        "fx",
        """SELECT code, page_no, pos, lang FROM fx WHERE code IS NOT NULL AND product_name IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY code ORDER BY page_no, pos) = 1""",
    ),
    "q_first_wins_lineitem": """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey
        ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus) = 1""",
    "q_append_new": sql(
        "fx",
        """SELECT code, page_no, pos, lang FROM fx WHERE code IS NOT NULL AND product_name IS NOT NULL
        AND code NOT IN (SELECT code FROM fx WHERE page_no <= 5 AND code IS NOT NULL AND product_name IS NOT NULL)
        QUALIFY row_number() OVER (PARTITION BY code ORDER BY page_no, pos) = 1""",
    ),
    "q_append_new_orders": f"""SELECT * FROM orders o WHERE o_orderdate >= TIMESTAMP '{CUT}'
        AND NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderdate < TIMESTAMP '{CUT}' AND e.o_custkey = o.o_custkey)
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
    "q_validate_rows": sql(
        "fx",
        """SELECT pos, code, product_name, lang, nullif(concat_ws(',', CASE WHEN code IS NULL THEN 'code_missing' END,
            CASE WHEN product_name IS NULL THEN 'product_name_missing' END,
            CASE WHEN length(lang) > 10 THEN 'lang_too_long' END), '') AS reject_reason
        FROM (SELECT pos, code, product_name, repeat(lang, CAST(pos % 9 AS INTEGER)) AS lang FROM fx)""",
    ),
    "q_load_counts": sql(
        "fx",
        """SELECT CASE WHEN code IS NULL OR product_name IS NULL THEN 'failed' ELSE 'loaded' END AS outcome,
        count(*) AS n_rows FROM fx GROUP BY 1""",
    ),
    "q_time_sanity": sql("raw", "SELECT code, created_t, last_modified_t FROM raw WHERE NOT (last_modified_t < created_t)"),
    "q_time_travel_rows": sql("raw", "SELECT count(*) AS n_rows FROM raw WHERE last_modified_t < created_t"),
    "q_clean_products_all": sql("all_cleaned", "SELECT * FROM all_cleaned"),
    "q_stg_products_all": sql("all_stg", "SELECT * FROM all_stg"),
    "q_fact_products_all": sql("all_fact", "SELECT * FROM all_fact"),
    "q_products_snapshot_all": sql(
        "all_stg", versions(f"(SELECT {', '.join(SNAPSHOT_ALL)} FROM all_stg)", "code", "last_modified_at")
    ),
    "q_stg_products": sql("stg", "SELECT * FROM stg"),
    "q_stg_products_energy_null": sql(
        "raw",
        """SELECT code, CASE WHEN energy_kcal_100g > 900 THEN NULL ELSE energy_kcal_100g END AS energy_kcal_100g FROM raw
        WHERE sugars_100g < 100 AND fat_100g < 100 AND proteins_100g < 100 AND salt_100g < 100""",
    ),
    "q_stg_nutrients": sql("nut", "SELECT * FROM nut"),
    "q_bridge_country": sql("bridge_country", "SELECT * FROM bridge_country"),
    "q_bridge_brand": sql("bridge_brand", "SELECT * FROM bridge_brand"),
    "q_dim_brand": sql("dim_brand", "SELECT * FROM dim_brand"),
    "q_dim_brand_one_owner": sql(
        "stg",
        f"""SELECT row_number() OVER (ORDER BY brand_name) AS brand_id, brand_name, owner FROM (
            SELECT {FIRST_TAG} AS brand_name, min(owner) AS owner FROM stg
            WHERE brands_tags IS NOT NULL AND brands_tags != '[]' GROUP BY 1) WHERE brand_name != ''""",
    ),
    "q_dim_category": sql("dim_category", "SELECT * FROM dim_category"),
    "q_dim_country": sql("dim_country", "SELECT * FROM dim_country"),
    "q_dense_ids_orders": """SELECT row_number() OVER (ORDER BY o_orderpriority, o_custkey, o_orderkey) AS row_id,
        o_orderpriority, o_custkey, o_orderkey FROM orders""",
    "q_fact_products": sql("fact", "SELECT * FROM fact"),
    "q_mart_nutrient_profile": sql(
        "stg nut",
        f"""SELECT p.pnns_groups_1, count(p.code) AS total_products, {AVG_SQL} FROM stg p JOIN nut n ON p.code = n.code
        WHERE p.pnns_groups_1 IS NOT NULL GROUP BY p.pnns_groups_1""",
    ),
    "q_mart_brand_quality": sql("quality", "SELECT * FROM quality"),
    "q_rank_brands": sql("quality", "SELECT * FROM quality ORDER BY avg_energy_kcal NULLS LAST, brand_name LIMIT 10"),
    "q_group_profile_lineitem": """SELECT l_returnflag, count(l_orderkey) AS n_lines,
        round(avg(l_quantity), 4) AS avg_quantity, round(avg(l_extendedprice), 4) AS avg_price,
        round(avg(l_discount), 4) AS avg_discount FROM lineitem GROUP BY l_returnflag HAVING count(l_orderkey) > 2""",
    "q_group_totals_lineitem": """SELECT l_suppkey, l_returnflag, count(l_orderkey) AS n_lines,
        sum(l_quantity) AS sum_quantity, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
        FROM lineitem GROUP BY l_suppkey, l_returnflag HAVING count(l_orderkey) > 2""",
    "q_products_snapshot": sql("snap", versions("(SELECT * EXCLUDE (lang) FROM snap)", "code", "last_modified_at")),
    "q_scd2_apply": sql("snap_old snap_new", merged("snap_old", "snap_new", "code", ", ".join(SNAPSHOT))),
    "q_scd2_orders": sql("cust", "SELECT * FROM cust"),
    "q_scd2_valid_at": sql(
        "cust",
        f"""SELECT o_custkey, status, seen_at FROM cust WHERE valid_from <= TIMESTAMP '{CUT}'
        AND (valid_to IS NULL OR TIMESTAMP '{CUT}' < valid_to)""",
    ),
    "q_products_by_country": sql("fact bridge_country dim_country", BY_COUNTRY),
    "q_explore": sql(
        "fact bridge_country dim_category",
        """SELECT * FROM fact WHERE nutriscore_grade IN ('a', 'b', 'c') AND nova_group IN (1, 2, 3)
        AND energy_kcal_100g BETWEEN 50 AND 900
        AND category_id IN (SELECT category_id FROM dim_category WHERE pnns_groups_1 IN ('economy', 'promo', 'standard'))
        AND code IN (SELECT code FROM bridge_country WHERE country_name IN ('country-3', 'country-8'))""",
    ),
    "q_kpis": sql(
        "fact",
        """SELECT count(*) AS n_products, count(DISTINCT category_id) AS n_categories,
        round(avg(nutriscore_score), 2) AS avg_nutriscore_score, round(avg(nova_group), 2) AS avg_nova_group,
        round(avg(energy_kcal_100g), 2) AS avg_energy_kcal, round(avg(completeness), 4) AS avg_completeness
        FROM (SELECT DISTINCT code, category_id, nutriscore_score, nova_group, energy_kcal_100g, completeness FROM fact)""",
    ),
    "q_chart_series": sql(
        "fact", "SELECT nutriscore_grade, count(DISTINCT code) AS n_products FROM fact GROUP BY nutriscore_grade"
    ),
    "q_dq_not_null": sql("fx", "SELECT pos FROM fx WHERE code IS NULL"),
    "q_dq_unique": sql(
        "fx", "SELECT code, count(*) AS n_records FROM fx WHERE code IS NOT NULL GROUP BY code HAVING count(*) > 1"
    ),
    "q_dq_accepted": sql(
        "fx",
        """SELECT nutriscore_grade, count(*) AS n_records FROM fx
        WHERE nutriscore_grade NOT IN ('a', 'b', 'c', 'd', 'e') GROUP BY nutriscore_grade""",
    ),
    "q_dq_relationships": """SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL
        AND o_custkey NOT IN (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END FROM customer) GROUP BY o_custkey""",
    "q_dq_ranges": sql(
        "fx cleaned",
        " UNION ALL ".join(
            [
                count_check("energy_range", "rows", "energy_kcal_100g", "cleaned", ENERGY),
                count_check("share_range", "rows", "nutrients", "cleaned", SHARES),
                count_check("completeness_range", "fx", "completeness", "fx", "completeness < 0 OR completeness > 1"),
            ]
        ),
    ),
    "q_dq_orphans": sql(
        "raw stg",
        f"""SELECT code, tag AS brand_name FROM ({tags('brands_tags').replace('FROM stg', 'FROM raw')})
        WHERE tag != '' AND code NOT IN (SELECT code FROM stg)""",
    ),
    "q_dq_star": sql("raw stg dim_brand dim_category dim_country bridge_brand fact", STAR),
    "q_freshness": """SELECT max_loaded_at, age_hours, CASE WHEN age_hours IS NULL OR age_hours > 48 THEN 'error'
        WHEN age_hours > 24 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max(ts) AS max_loaded_at,
              (epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 3.6e9 AS age_hours FROM events)""",
    "q_profile_columns": sql(
        "fx",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{TYPES.get(c, 'string')}' AS dtype, count(*) AS n_rows,
            count(*) - count({c}) AS n_null, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value
            FROM fx""" for c in ["code", "owner", "lang", "pos", "created_t", "nutriscore_grade"]
        ),
    ),
    "q_null_counts": sql("fx", per_column(list(PRODUCT), "count(*) - count($c) AS n_null")),
    "q_describe": sql("fx", " UNION ALL ".join(described("fx", c) for c in FX_NUMBERS)),
    "q_describe_lineitem": " UNION ALL ".join(
        described("lineitem", c) for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ),
    "q_sample_values": sql("fx", per_column(STRINGS, "substr(min($c), 1, 200) AS sample")),
    "q_sample_documents": per_column(["text", "lang", "source"], "substr(min($c), 1, 200) AS sample", "documents"),
    "q_profile_map_keys": sql(
        "fx",
        f"""SELECT key, count(*) AS n_records FROM (SELECT unnest(json_keys({JSON_NUTRIMENTS})) AS key
        FROM fx WHERE nutriments IS NOT NULL) GROUP BY key""",
    ),
    "q_profile_map_values": sql(
        "fx",
        f"""SELECT value, count(*) AS n_records FROM (SELECT unnest(map_values(CAST(CAST({JSON_LEVELS} AS JSON)
        AS MAP(VARCHAR, VARCHAR)))) AS value FROM fx WHERE nutrient_levels IS NOT NULL) GROUP BY value""",
    ),
    "q_profile_event_values": """SELECT value, count(*) AS n_records FROM (
        SELECT json_extract_string(props, '$.' || k) AS value FROM (SELECT props, unnest(json_keys(props)) AS k FROM events))
        GROUP BY value""",
    "q_profile_list": sql(
        "fx",
        f"""SELECT element, count(*) AS n_records FROM (SELECT {LIST_ITEMS.format('countries_tags')} AS element FROM fx
        WHERE countries_tags IS NOT NULL) GROUP BY element""",
    ),
    "q_element_count": sql(
        "fx",
        f"""SELECT count(DISTINCT element) AS n_elements FROM (SELECT {LIST_ITEMS.format('brands_tags')} AS element FROM fx
        WHERE brands_tags IS NOT NULL)""",
    ),
    "q_audit": sql(
        "stg",
        f"""SELECT unnest([{', '.join(f"'{n}'" for n in MODELS)}]) AS model_name, {STAMP} AS run_at
        FROM (SELECT count(*) AS n FROM stg) WHERE n > 0""",
    ),
}
ORACLE["q_csv_extract"] = sql("fx", f"SELECT {', '.join(FILLED)} FROM fx")
ORACLE["q_csv_headers"] = sql(
    "fx",
    f"""SELECT {', '.join(f"CASE WHEN pos % 3 < 2 THEN {c} END AS {c}" if c in ('owner', 'nova_group') else c for c in FILLED)}
    FROM fx""",
)
ORACLE["q_load_batch_counts"] = sql(
    "cleaned",
    """SELECT 'first' AS batch_id, count(*) AS received, CAST(0 AS BIGINT) AS rejected, count(DISTINCT code) AS inserted
    FROM cleaned WHERE lang = 'en'
    UNION ALL SELECT 'second', count(*), count(*) FILTER (bad), count(DISTINCT code) FILTER (NOT bad AND NOT known)
    FROM (SELECT code, pos % 6 = 0 AND length(lang) > 1 AS bad, bool_or(lang = 'en') OVER (PARTITION BY code) AS known FROM cleaned)""",
)
ORACLE["q_scd2_own_names"] = sql(
    "cust",
    """SELECT o_custkey AS source_scd_id, status AS source_valid_to, o_orderkey, scd_id, updated_at, valid_from, valid_to
    FROM cust""",
)
ORACLE["q_quantiles_lineitem"] = """SELECT nullif(l_returnflag, 'R') AS flag,
    round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.25), 4) AS q0, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.5), 4) AS q1,
    round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.75), 4) AS q2 FROM lineitem GROUP BY 1"""
# Sums of numbers with at most two digits after the point, counted in hundredths; half away from zero without doubles.
EXACT_AVG_SQL = ", ".join(
    f"""(2 * 100 * CAST(round(sum({c}) * 100) AS BIGINT) + 100 * count({c})) // (2 * 100 * count({c})) / 100.0::DOUBLE AS {a}"""
    for c, a in zip(NUTRIENTS, AVG_NAMES)
)
ORACLE["q_mart_incremental"] = sql(
    "stg bridge_brand nut",
    f"""SELECT 'mart_nutrient_profile' AS mart, pnns_groups_1 AS name, count(*) AS total_products, {EXACT_AVG_SQL}
    FROM stg WHERE pnns_groups_1 IS NOT NULL GROUP BY pnns_groups_1
    UNION ALL SELECT 'mart_brand_quality', upper(brand_name), count(*), {EXACT_AVG_SQL}
    FROM bridge_brand JOIN nut USING (code) GROUP BY upper(brand_name) HAVING count(*) > 2""",
)
ORACLE["q_dim_brand_stable"] = sql(
    "stg",
    f""", member AS (SELECT {FIRST_TAG} AS brand_name, owner, bool_or(lang = 'en') AS early FROM stg
        WHERE brands_tags IS NOT NULL AND brands_tags != '[]' GROUP BY 1, 2 HAVING brand_name != '')
    SELECT row_number() OVER (ORDER BY NOT early, brand_name, owner NULLS LAST) AS brand_id, brand_name, owner FROM member""",
)
ORACLE["q_sketch_profile"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count({c}) AS n_known, true AS distinct_within,
    {'true' if number else 'CAST(NULL AS BOOLEAN)'} AS quartiles_within FROM lineitem"""
    for c, number in (("l_orderkey", 1), ("l_suppkey", 1), ("l_extendedprice", 1), ("l_returnflag", 0), ("l_linestatus", 0))
)
ORACLE["q_explore_clustered"] = ORACLE["q_explore"]
ORACLE["q_union_batches"] = """SELECT * FROM documents
    UNION ALL BY NAME SELECT conv_id, turn, role, text FROM conversations"""
ORACLE["q_load_raw"] = sql(
    "cleaned",
    """SELECT code, product_name, lang, energy_kcal_100g, fat_level, 'csv' AS source,
    CASE WHEN lang = 'en' THEN 'first' ELSE 'second' END AS batch_id
    FROM cleaned QUALIFY row_number() OVER (PARTITION BY code ORDER BY lang != 'en', page_no, pos) = 1""",
)
ORACLE["q_read_pages"] = sql(
    "fx",
    """SELECT code, product_name, lang, nutriscore_score, created_t, NULL AS body FROM fx
    WHERE code IS NOT NULL AND product_name IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY pos % 2 DESC, pos) = 1
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, '<html>502'""",
)
ORACLE["q_load_csv"] = sql(
    "cleaned",
    """SELECT code, product_name, lang, energy_kcal_100g, fat_level FROM cleaned
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY pos % 2 DESC, pos) = 1""",
)
ORACLE["q_ingest_pages"] = ORACLE["q_load_csv"]
ORACLE["q_ingest_new_keys"] = ORACLE["q_load_csv"]
ORACLE["q_publish_after_gate"] = "SELECT c_custkey, c_name FROM customer"
ORACLE["q_snapshot_table"] = ORACLE["q_scd2_apply"]
TABLES = {"dim_brand": "dim_brand", "dim_category": "dim_category", "bridge_product_country": "bridge_country",
          "bridge_product_brand": "bridge_brand", "dim_country": "dim_country", "fact_products": "fact",
          "mart_nutrient_profile": "profile", "mart_brand_quality": "quality"}
ORACLE["q_build_marts"] = sql(
    "dim_brand dim_category dim_country bridge_brand fact quality",
    f""", profile AS (SELECT DISTINCT pnns_groups_1 FROM stg WHERE pnns_groups_1 IS NOT NULL)
    {' UNION ALL '.join(f"SELECT '{n}' AS model_name, {STAMP} AS run_at, count(*) AS n_rows FROM {TABLES[n]}" for n in MODELS)}""",
)
ORACLE["q_mart_nutrient_profile_fused"] = ORACLE["q_mart_nutrient_profile"]
ORACLE["q_mart_brand_quality_fused"] = ORACLE["q_mart_brand_quality"]
