import random

import pytest

from prodmart.operators.sketches import DISTINCT_ERROR, RANK_ERROR, estimates, merge_sketches, sketch_columns
from prodmart.plans.batch_profile import BatchProfiles
from prodmart.plans.load import load_raw, read_raw
from prodmart.sources.tables import Lakehouse
from test_mart_state import products

POINTS = [0.0, 0.1, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def parts(spark):
    rng = random.Random(1)
    rows = [(i % 9000, rng.lognormvariate(0, 2), f"t{int(rng.paretovariate(0.3)) % 20000}", rng.choice([None, float("nan"), 1.5])) for i in range(60_000)]
    rows.sort(key=lambda r: r[1])  # the parts hold different ranges
    frames = [spark.createDataFrame(rows[i * 20_000 : (i + 1) * 20_000], "a long, b double, c string, d double") for i in range(3)]
    return rows, frames


def test_merged_sketches_are_within_their_bounds(parts):
    rows, frames = parts
    merged = merge_sketches(sketch_columns(frames[0]).unionByName(sketch_columns(frames[1])).unionByName(sketch_columns(frames[2])))
    got = {r["column"]: r for r in estimates(merged, POINTS).collect()}
    for i, name in enumerate("abcd"):
        known = sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i])
        assert (got[name]["n_rows"], got[name]["n_known"]) == (60_000, len(known))
        assert abs(got[name]["n_distinct"] - len(set(known))) <= DISTINCT_ERROR * len(set(known))
        for k, point in enumerate(POINTS):
            q = got[name][f"q{k}"]
            if name == "c":
                assert q is None
                continue
            below, upto = sum(v < q for v in known) / len(known), sum(v <= q for v in known) / len(known)
            assert below - RANK_ERROR <= point <= upto + RANK_ERROR


def test_columns_without_values(spark):
    df = spark.createDataFrame([(None, None, float("nan"))] * 3, "a string, b long, c double")
    empty = df.limit(0)
    for frame, n in ((df, 3), (empty, 0)):
        twice = merge_sketches(sketch_columns(frame).unionByName(sketch_columns(empty)))
        for r in estimates(twice).collect():
            assert (r["n_rows"], r["n_known"], r["n_distinct"], r["q1"]) == (n, 0, 0, None)


def test_profile_of_batches(spark, tmp_path):
    """Only batches without sketches are read, a replaced one counts with its new rows, older versions can be asked for."""
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    profiles = BatchProfiles(lake, ["code", "fat_100g"])
    assert {r["n_rows"] for r in profiles.read().collect()} == {0}
    read = []
    for batch, codes in (("a", range(30)), ("b", range(20, 60)), ("b", range(25, 90))):
        load_raw(lake, products(spark, batch, codes), batch)
        read.append(profiles.refresh())
        got = {r["column"]: r for r in profiles.read().collect()}
        assert got["code"]["n_rows"] == read_raw(lake).count() == got["code"]["n_distinct"]
        assert got["fat_100g"]["n_known"] == read_raw(lake).where("fat_100g IS NOT NULL").count()
    assert read == [["a"], ["b"], ["b"]] and profiles.refresh() == []
    assert {r["n_rows"] for r in profiles.read(1).collect()} == {30}
