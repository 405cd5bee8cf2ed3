import math

import pytest

from prodmart.operators import profile


@pytest.fixture(scope="module")
def df(spark):
    rows = [
        (1, 1.5, "b", "['x', 'y']", "{'fat': 'low', 'salt': 'high'}"), (2, math.nan, None, "['x']", "{'fat': 'low'}"),
        (3, None, "a" * 300, "[]", None), (4, 2.5, "c", None, "{}"),
    ]
    return spark.createDataFrame(rows, "i int, d double, s string, l string, m string")


def test_columns(df):
    assert profile.string_columns(df) == ["s", "l", "m"]
    assert profile.numeric_columns(df) == ["i", "d"]
    got = {r["column"]: r for r in profile.profile_columns(df).collect()}
    assert (got["s"]["n_rows"], got["s"]["n_null"], got["i"]["min_value"], got["i"]["max_value"]) == (4, 1, "1", "4")
    assert {r["column"]: r["n_null"] for r in profile.null_counts(df).collect()}["l"] == 1


@pytest.mark.parametrize("approximate", [False, True])
def test_describe(df, approximate):
    got = {r["column"]: r for r in profile.describe_numeric(df, approximate=approximate).collect()}
    assert (got["i"]["count"], got["i"]["mean"], got["i"]["min"], got["i"]["max"]) == (4, 2.5, 1.0, 4.0)
    assert (got["d"]["count"], got["d"]["mean"]) == (2, 2.0)
    if not approximate:
        assert (got["i"]["p25"], got["i"]["p50"], got["i"]["p75"]) == (1.75, 2.5, 3.25)


def test_samples(df):
    got = {r["column"]: r["sample"] for r in profile.sample_values(df).collect()}
    assert got["s"] == "a" * 200 and got["l"] == "['x', 'y']"


def test_maps_and_lists(df):
    assert {tuple(r) for r in profile.map_key_profile(df, "m").collect()} == {("fat", 2), ("salt", 1)}
    assert {tuple(r) for r in profile.map_value_profile(df, "m").collect()} == {("low", 2), ("high", 1)}
    assert {tuple(r) for r in profile.list_profile(df, "l").collect()} == {("x", 2), ("y", 1)}
    assert profile.element_count(df, "l").first()[0] == 2
    assert profile.element_count(df, "l", approximate=True).first()[0] == 2
