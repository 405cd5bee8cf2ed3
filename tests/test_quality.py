from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from prodmart.operators import quality as q


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def df(spark):
    data = [(1, "a", 1.0), (1, "a", 2.0), (2, None, 9.0), (None, "z", None)]
    return spark.createDataFrame(data, "id long, grade string, nova double")


def test_checks_return_failing_rows(spark, df):
    assert rows(q.not_null(df, "grade")) == [(2, None, 9.0)]
    assert rows(q.unique(df, "id")) == [(1, 2)]
    assert rows(q.accepted_values(df, "grade", ["a"])) == [("z", 1)]
    assert rows(q.accepted_values(df, "nova", [1, 2])) == [(9.0, 1)]
    assert rows(q.expression(df, F.col("nova") > 1)) == [(1, "a", 2.0), (2, None, 9.0)]
    parent = spark.createDataFrame([(1,)], "key long")
    assert rows(q.relationships(df, "id", parent, "key")) == [(2, 1)]
    assert rows(q.orphans(df.select("id"), parent.withColumnRenamed("key", "id"), "id")) == [(2,), (None,)]


def test_run_checks_and_gate(spark, df):
    parent = spark.createDataFrame([(1,)], "key long")
    checks = [
        q.check_not_null("m", "grade"), q.check_accepted("m", "grade", ["a"]), q.check_unique("m", "id"),
        q.check_relationships("m", "id", "p", "key"), q.check_not_null("p", "key"),
        q.check_expression("nova_high", "m", "nova", F.col("nova") > 5, severity="warn"),
    ]
    frames = {"m": df, "p": parent}
    got = {(r["check"], r["model"], r["column"]): (r["failures"], r["status"]) for r in q.run_checks(checks, frames).collect()}
    assert got == {
        ("not_null", "m", "grade"): (1, "error"), ("accepted_values", "m", "grade"): (1, "error"),
        ("unique", "m", "id"): (1, "error"), ("relationships", "m", "id"): (1, "error"),
        ("not_null", "p", "key"): (0, "pass"), ("nova_high", "m", "nova"): (1, "warn"),
    }
    with pytest.raises(q.DataQualityError, match=r"unique\(m.id\): 1"):
        q.gate(checks, frames)
    assert len(q.gate([checks[4], checks[5]], frames)) == 2


def test_failures_count_values_or_rows(spark):
    rows = spark.createDataFrame([("x", 5), ("x", 5), ("a", 1)], "grade string, id long")
    frames = {"m": rows, "p": spark.createDataFrame([(1,)], "key long")}
    checks = [q.check_accepted("m", "grade", ["a"]), q.check_relationships("m", "id", "p", "key"), q.check_unique("m", "id")]
    assert [r["failures"] for r in q.run_checks(checks, frames).collect()] == [1, 2, 1]


def test_declared_checks():
    kinds = [c.name for c in q.star_checks()]
    generic = {k: kinds.count(k) for k in ("not_null", "unique", "accepted_values", "relationships")}
    assert generic == {"not_null": 14, "unique": 5, "accepted_values": 2, "relationships": 2}
    assert len(kinds) - sum(generic.values()) == 4


@pytest.mark.parametrize("hours, status", [(1, "pass"), (24, "pass"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, hours, status):
    now = datetime(2024, 1, 10, tzinfo=timezone.utc)
    df = spark.createDataFrame([(now - timedelta(hours=hours),), (now - timedelta(days=9),)], "at timestamp")
    row = q.freshness(df, "at", now).first()
    assert (row["age_hours"], row["status"]) == (hours, status)
    assert q.freshness(df.limit(0), "at", now).first()["status"] == "error"
