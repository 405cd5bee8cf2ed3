import pytest
from pyspark.sql import functions as F

from prodmart.operators.layout import clustered, curve_position
from scans import rows_scanned


def test_curve_position(spark):
    rows = [(a, b) for a in range(4) for b in range(4)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = {(r.a, r.b): r.z for r in df.withColumn("z", curve_position([F.col("a"), F.col("b")], 2)).collect()}
    expected = {(a, b): int("".join(f"{x}{y}" for x, y in zip(f"{a:02b}", f"{b:02b}")), 2) for a, b in rows}
    assert got == expected


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The same rows along the curve and sorted by one column: a grade, a number, a text, NULLs in each."""
    folder = tmp_path_factory.mktemp("layout")
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 11 > 0, F.element_at(F.array(*map(F.lit, "abcde")), (F.hash("id") % 5 + F.when(F.hash("id") % 5 < 0, 6).otherwise(1)).cast("int"))).alias("grade"),
        F.when(F.col("id") % 13 > 0, F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double")).alias("energy"),
        F.when(F.col("id") % 17 > 0, F.concat(F.lit("name "), F.pmod(F.hash(F.col("id") + 7), F.lit(300)))).alias("name"),
        F.col("id"),
    )
    clustered(rows, ["grade", "energy", "name"], 64).write.parquet(f"{folder}/curve")
    rows.repartitionByRange(64, "grade").sortWithinPartitions("grade", "id").write.parquet(f"{folder}/sorted")
    return rows, spark.read.parquet(f"{folder}/curve"), spark.read.parquet(f"{folder}/sorted")


@pytest.mark.parametrize("condition", ["grade = 'b'", "energy BETWEEN 400 AND 430", "name = 'name 17'", "name IS NULL"])
def test_filters_on_any_column_skip_files(tables, condition):
    rows, curve, _ = tables
    found = curve.where(condition)
    assert found.select("id").exceptAll(rows.where(condition).select("id")).count() == 0
    assert found.count() == rows.where(condition).count()
    assert rows_scanned(found) < 20_000


def test_one_sorted_column_helps_that_column_only(tables):
    _, curve, by_grade = tables
    for condition in ("energy BETWEEN 400 AND 430", "name = 'name 17'"):
        assert rows_scanned(curve.where(condition)) < rows_scanned(by_grade.where(condition)) / 2


def test_all_rows_stay_and_equal_rows_are_spread(spark):
    df = spark.range(9000).selectExpr("1 AS a", "CAST(NULL AS STRING) AS b", "id")
    found = clustered(df, ["a", "b"], 8)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert found.columns == df.columns and sum(sizes) == 9000 and len(sizes) == 8 and max(sizes) < 2500
    assert clustered(df.limit(0), ["a"], 4).count() == 0
    with pytest.raises(ValueError):
        clustered(df, ["a", "b"], 4, bits=32)
