import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prodmart.operators.ranks import RANGES, dense_ids, exact_quantiles, running_total, with_ranges


def test_dense_ids_nulls_last(spark):
    rows = [("b", None), ("a", "x"), (None, "q"), ("b", "a"), (None, None), ("a", None)]
    df = spark.createDataFrame(rows, "g string, o string")
    got = [tuple(r) for r in dense_ids(df, ["g", "o"], "id").orderBy("id").collect()]
    assert got == [
        (1, "a", "x"), (2, "a", None), (3, "b", "a"), (4, "b", None), (5, None, "q"), (6, None, None),
    ]


@pytest.mark.parametrize("n, ranges", [(0, 1024), (1, 1024), (5000, 1024), (5000, 8)])
def test_dense_ids_any_size_and_partitioning(spark, n, ranges):
    values = list(range(n))
    random.Random(1).shuffle(values)
    # a third of the keys share a long prefix, so value ranges must follow the data
    texts = [("same-prefix-" if v % 3 == 0 else "") + f"{v:06d}" for v in values]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(7)
    got = [tuple(r) for r in dense_ids(df, ["t"], "id", ranges=ranges).orderBy("id").collect()]
    assert got == [(i + 1, t) for i, t in enumerate(sorted(texts))]


def test_ranges_are_balanced(spark):
    df = spark.range(100_000).select(F.concat(F.lit("en:"), F.col("id").cast("string")).alias("t"))
    sizes = [r["count"] for r in with_ranges(df, ["t"]).groupBy("_range").count().collect()]
    assert len(sizes) == RANGES and max(sizes) < 100_000 / RANGES * 12


def test_cut_points_are_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("t"))
    plan = dense_ids(df, ["t"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "partial_min" in plan


def test_running_total(spark):
    df = spark.createDataFrame([("c", 5), ("a", 2), ("b", 3)], "k string, w long")
    got = [tuple(r) for r in running_total(df, ["k"], F.col("w"), "t").orderBy("k").collect()]
    assert got == [("a", 2, 2), ("b", 3, 5), ("c", 5, 10)]


def test_exact_quantiles(spark):
    rng = np.random.default_rng(0)
    data = {"u": rng.uniform(-5, 5, 4001), "hot": np.r_[np.zeros(3000), rng.normal(size=1000)], "one": np.array([7.0])}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("u", None)]
    points = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r[1:] for r in exact_quantiles(df, "g", "v", points).collect()}
    for name, values in data.items():
        assert got[name] == pytest.approx(np.quantile(values, points), abs=1e-12)


def test_exact_quantiles_with_a_null_group(spark):
    """Groups around NULL keep their offsets, and NULL itself has quantiles."""
    rows = [("a", 1.0), ("a", 3.0), (None, 5.0), (None, 6.0), ("b", 9.0), (None, None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["q0"], r["q1"]) for r in exact_quantiles(df, "g", "v", [0.5, 1.0]).collect()}
    assert got == {"a": (2.0, 3.0), None: (5.5, 6.0), "b": (9.0, 9.0)}


def test_many_groups_do_not_meet_in_one_task(spark):
    df = spark.range(3000).select((F.col("id") % 1000).alias("g"), F.col("id").cast("double").alias("v"))
    found = exact_quantiles(df, "g", "v", [0.0, 0.5])
    assert {(r["g"], r["q0"], r["q1"]) for r in found.collect()} == {(g, float(g), float(g + 1000)) for g in range(1000)}
