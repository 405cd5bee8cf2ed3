"""How the catalog deals its input to tasks and files."""

from pyspark.sql import functions as F

from catalog import fixture
from catalog.spark_queries import Model, land, landed
from prodmart.schema import ORDER_COLUMNS
from prodmart.sources.landing import read_pages


def part(spark, tmp_path, keys):
    """A `part` table in one file with these keys."""
    rows = spark.createDataFrame([(k,) for k in keys], "p_partkey long").selectExpr(
        "p_partkey", "'name' AS p_name", "'Brand#1' AS p_brand", "'TYPE' AS p_type", "CAST(p_partkey % 50 AS INT) AS p_size", "1.5D AS p_retailprice"
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_rows_are_dealt_to_tasks_by_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixture, "ROWS_PER_TASK", 100, raising=False)
    sf_dir = part(spark, tmp_path, [*range(2000), 7, 7, None])
    rows = Model(spark, sf_dir, fixture.EVERY).fx
    largest = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 200
    plain = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(*[f"{e} AS {n}" for n, e in fixture.EVERY.items()])
    assert sorted(map(str, rows.collect())) == sorted(map(str, plain.collect()))


def test_pages_share_folders(spark, tmp_path):
    """One file per page, few folders, file names in the order of the pages."""
    m = Model(spark, part(spark, tmp_path / "tables", [101 * i for i in range(400)]))
    land(landed(m), str(tmp_path / "landing"))
    files = list((tmp_path / "landing").rglob("*.txt"))
    assert len(files) == 402 and len({f.parent for f in files}) == 5
    rows, quarantine = read_pages(spark, str(tmp_path / "landing"))
    assert [r["body"].strip() for r in quarantine.collect()] == ["<html>502"]
    read = [r["created_t"] for r in rows.orderBy(*ORDER_COLUMNS).select("created_t").collect()]
    days = [[1_600_000_000 + 3600 * 101 * i for i in range(400) if i % 2 == odd] for odd in (1, 0)]
    assert read == days[0] + days[1]
