import itertools

from prodmart.operators.keyed import append_new, first_wins, validate_rows

SCHEMA = "code string, page_no long, pos long, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_wins_in_any_input_order(spark):
    data = [("a", 2, 0, "late"), ("a", 1, 5, "first"), ("a", 1, 9, "next"), ("b", 3, 0, "only")]
    for order in itertools.permutations(data):
        got = first_wins(spark.createDataFrame(order, SCHEMA), ["code"], ["page_no", "pos"])
        assert rows(got) == [("a", 1, 5, "first"), ("b", 3, 0, "only")]


def test_append_new(spark):
    stored = spark.createDataFrame([("a", 1, 0, "stored")], SCHEMA)
    incoming = spark.createDataFrame([("a", 1, 0, "x"), ("b", 2, 1, "second"), ("b", 2, 0, "first")], SCHEMA)
    assert rows(append_new(stored, incoming, ["code"], ["page_no", "pos"])) == [("b", 2, 0, "first")]
    assert rows(append_new(stored.limit(0), incoming, ["code"], ["page_no", "pos"])) == [
        ("a", 1, 0, "x"), ("b", 2, 0, "first"),
    ]


def test_hot_key_keeps_every_other_row(spark):
    hot = spark.range(30_000).selectExpr("'hot' AS code", "1 AS page_no", "id AS pos", "'v' AS v")
    rest = spark.range(1_000).selectExpr("CAST(id AS STRING) AS code", "1 AS page_no", "id AS pos", "'v' AS v")
    got = first_wins(hot.unionByName(rest).repartition(5), ["code"], ["page_no", "pos"])
    assert got.count() == 1_001
    assert got.where("code = 'hot'").first()["pos"] == 0


def test_validate_rows(spark):
    data = [("a", "n", "en"), (None, "n", "en"), ("b", None, "toolonglanguage"), ("x" * 51, "n", None)]
    good, rejected = validate_rows(spark.createDataFrame(data, "code string, product_name string, lang string"))
    assert [r["code"] for r in good.collect()] == ["a"]
    reasons = sorted(r["reject_reason"] for r in rejected.collect())
    assert reasons == ["code_missing", "code_too_long", "product_name_missing,lang_too_long"]


def test_store_and_work_dir(spark):
    from pathlib import Path

    from prodmart.sources.tables import store, work_dir

    folder = work_dir(spark)
    assert folder == work_dir(spark) and Path(folder).is_dir()
    assert store(spark.range(3), "numbers").count() == 3
    assert any(p.name.startswith("numbers-") for p in Path(folder).iterdir())
