import json

from pyspark.sql import functions as F

from prodmart.plans.load import STAGED_SCHEMA, RawLog, read_quarantine, read_raw, read_rejected
from prodmart.sources.tables import Lakehouse
from prodmart.streaming.first_seen import first_seen
from prodmart.streaming.incremental import ingest_new_keys, ingest_pages


def page(folder, name, *products):
    (folder / name).write_text(json.dumps({"products": [{"code": c, "product_name": n} for c, n in products]}))


def run(spark, folder, lake, tmp_path, **options):
    stamp = F.lit("2024-01-01").cast("timestamp")
    query = ingest_pages(spark, str(folder), lake, str(tmp_path / "checkpoint"), "feed", as_of=stamp, **options)
    query.awaitTermination()
    return sorted((r["code"], r["product_name"]) for r in read_raw(lake).collect())


def test_two_passes(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    page(folder, "page_1.json", ("a", "A1"), ("b", "B1"))
    page(folder, "page_2.json", ("a", "A2"))
    (folder / "page_3.json").write_text("<html>")
    assert run(spark, folder, lake, tmp_path) == [("a", "a1"), ("b", "b1")]
    # nothing new: nothing added
    assert run(spark, folder, lake, tmp_path) == [("a", "a1"), ("b", "b1")]
    page(folder, "page_4.json", ("b", "B2"), ("c", "C1"))
    assert run(spark, folder, lake, tmp_path) == [("a", "a1"), ("b", "b1"), ("c", "c1")]
    assert [r["body"] for r in read_quarantine(lake).collect()] == ["<html>"]


def test_one_file_per_batch(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    for i in range(3):
        page(folder, f"page_{i}.json", (f"c{i}", "x"), ("same", f"n{i}"))
    rows = run(spark, folder, lake, tmp_path, files_per_batch=1)
    assert [code for code, _ in rows] == ["c0", "c1", "c2", "same"]
    assert read_raw(lake).select("batch_id").distinct().count() == 3


def both(spark, folder, tmp_path):
    """The rows of the stateful ingest and of the plain one after another pass."""
    stamp = F.lit("2024-01-01").cast("timestamp")
    rows = []
    for start in (ingest_new_keys, ingest_pages):
        lake = Lakehouse(spark, str(tmp_path / start.__name__))
        start(spark, str(folder), lake, str(tmp_path / f"{start.__name__}_checkpoint"), "feed", as_of=stamp).awaitTermination()
        rows.append((
            sorted(map(str, read_raw(lake).drop("batch_id").collect())),
            sorted((r["body"], r["batch_id"]) for r in read_quarantine(lake).collect()),
            sorted((r["code"], r["reject_reason"]) for r in read_rejected(lake).collect()),
        ))
    return rows


def test_state_keeps_known_keys(spark, tmp_path, conf):
    """A restart from the checkpoint, late repetitions, a rejected first row: the rows of the plain ingest."""
    conf("spark.sql.shuffle.partitions", "2")
    folder = tmp_path / "landing"
    folder.mkdir()
    page(folder, "page_2.json", ("a", "A2"), ("b", "B1"), ("hot", "é\"\\n"), *[("hot", f"h{i}") for i in range(50)])
    page(folder, "page_10.json", ("a", "A10"), ("", "no code"))
    (folder / "page_4.json").write_text(json.dumps({"products": [{"code": "long", "product_name": "x", "lang": "x" * 11}]}))
    (folder / "page_3.json").write_text("<html>")
    got, expected = both(spark, folder, tmp_path)
    assert got == expected and [code for code, _ in got[2]] == ["long"]
    # late: an earlier page of a known key, a rejected key that comes again in a good row
    page(folder, "page_1.json", ("a", "A1"), ("long", "short now"), ("c", "C1"))
    got, expected = both(spark, folder, tmp_path)
    assert got == expected
    lake = Lakehouse(spark, str(tmp_path / "ingest_new_keys"))
    # the second batch staged its news alone
    staged = RawLog(lake).rows("staged", STAGED_SCHEMA, RawLog(lake).state()[1]).where("batch_id = 'feed_00000001'")
    assert sorted(r["code"] for r in staged.collect()) == ["c", "long"]


def test_keys_of_other_loads_do_not_enter_twice(spark, tmp_path, conf):
    conf("spark.sql.shuffle.partitions", "2")
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    stamp = F.lit("2024-01-01").cast("timestamp")
    for feed, products in (("one", [("a", "A1")]), ("two", [("a", "A2"), ("b", "B2")])):
        folder = tmp_path / feed
        folder.mkdir()
        page(folder, "page_1.json", *products)
        ingest_new_keys(spark, str(folder), lake, str(tmp_path / f"checkpoint_{feed}"), feed, as_of=stamp).awaitTermination()
    assert sorted((r["code"], r["product_name"]) for r in read_raw(lake).collect()) == [("a", "a1"), ("b", "b2")]


def test_state_is_asked_once_per_key_without_python(spark, tmp_path, conf):
    conf("spark.sql.shuffle.partitions", "2")
    folder = tmp_path / "landing"
    folder.mkdir()
    page(folder, "page_1.json", *[(f"k{i % 40}", f"n{i}") for i in range(200)], ("", "no code"))
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    stamp = F.lit("2024-01-01").cast("timestamp")
    query = ingest_new_keys(spark, str(folder), lake, str(tmp_path / "checkpoint"), "feed", as_of=stamp)
    query.awaitTermination()
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert {s["operatorName"] for s in states} == {"dedupe"} and max(s["numRowsTotal"] for s in states) == 40
    assert sorted((r["code"], r["product_name"]) for r in read_raw(lake).collect()) == sorted((f"k{i}", f"n{i}") for i in range(40))
    staged = RawLog(lake).rows("staged", STAGED_SCHEMA, RawLog(lake).state()[1])
    assert staged.count() == 40


def test_first_row_of_new_keys(spark):
    """A key with a NULL, rows that pass, keys without news, rows in any order."""
    data = [
        ("=a", False, False, "3", "late"), ("=a", False, False, "1", "first"), ("=a", False, True, None, None),
        ("=b", False, False, "2", "known"), ("", False, False, "4", "null"), ("", False, True, None, None),
        ("=a", True, False, "0", "passes"), ("=b", True, False, "5", "passes too"),
    ]
    batch = spark.createDataFrame(data, "_key string, _free boolean, _new boolean, place string, v string")
    got = first_seen(batch, ["place"])
    assert got.columns == ["place", "v"]
    assert sorted(r["v"] for r in got.collect()) == ["first", "null", "passes", "passes too"]
