import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from prodmart.operators.scd2 import SnapshotTable, first_versions, scd2_apply, valid_at
from prodmart.sources.commits import CommitLog

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
SCHEMA = "code string, name string, changed timestamp"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)



def key(row):
    return tuple(str(v) for v in row)


def test_rules(spark):
    first = frame(spark, ("same", "s", T1), ("new", "n1", T1), ("old", "o", T2), ("gone", "g", T1))
    current = scd2_apply(None, first, "code", "changed")
    second = frame(spark, ("same", "changed text", T1), ("new", "n2", T3), ("old", "older", T1), ("add", "a", T2))
    got = history_sorted(scd2_apply(current, second, "code", "changed"))
    assert got == sorted(
        [
            ("same", "s", T1, None), ("new", "n1", T1, T3), ("new", "n2", T3, None), ("old", "o", T2, None),
            ("gone", "g", T1, None), ("add", "a", T2, None),
        ],
        key=key,
    )


def history_sorted(df):
    return sorted(((r["code"], r["name"], r["valid_from"], r["valid_to"]) for r in df.collect()), key=key)


def test_replay_changes_nothing(spark):
    first, second = frame(spark, ("a", "1", T1)), frame(spark, ("a", "2", T2), ("b", "1", T1))
    once = scd2_apply(scd2_apply(None, first, "code", "changed"), second, "code", "changed")
    twice = scd2_apply(once, second, "code", "changed")
    assert history_sorted(once) == history_sorted(twice)


def test_missing_change_time(spark):
    current = first_versions(frame(spark, ("a", "1", T1)), "code", "changed")
    got = history_sorted(scd2_apply(current, frame(spark, ("a", "2", None), ("b", "1", None)), "code", "changed"))
    assert got == sorted([("a", "1", T1, None), ("b", "1", None, None)], key=key)


def test_version_ids(spark):
    rows = first_versions(frame(spark, ("a", "1", T1), ("a", "2", T2)), "code", "changed").collect()
    assert len({r["scd_id"] for r in rows}) == 2


def test_snapshot_table(spark, tmp_path):
    path = str(tmp_path / "snap")
    table = SnapshotTable(spark, path)
    assert table.version() == 0
    inputs = [
        frame(spark, ("a", "a1", T1), ("b", "b1", T1)),
        frame(spark, ("a", "a2", T2)),
        frame(spark, ("a", "a2", T2), ("c", "c1", T2)),
        frame(spark, ("a", "a3", T3)),
    ]
    expected = None
    for number, rows in enumerate(inputs, 1):
        assert table.apply(rows, "code", "changed") == number
        expected = scd2_apply(expected, rows, "code", "changed")
        assert history_sorted(table.read()) == history_sorted(expected)
    assert history_sorted(table.read(2)) == sorted(
        [("a", "a1", T1, T2), ("a", "a2", T2, None), ("b", "b1", T1, None)], key=key
    )
    open_then = valid_at(table.read(), F.lit(T2).cast("timestamp"))
    assert sorted(r["name"] for r in open_then.collect()) == ["a2", "b1", "c1"]


def test_old_open_rows_are_removed_and_history_stays(spark, tmp_path):
    path = tmp_path / "snap"
    table = SnapshotTable(spark, str(path), keep=2)
    expected = None
    for rows in (
        frame(spark, ("a", "a1", T1), ("b", "b1", T1)), frame(spark, ("a", "a2", T2)), frame(spark, ("a", "a3", T3)),
    ):
        table.apply(rows, "code", "changed")
        expected = scd2_apply(expected, rows, "code", "changed")
    assert history_sorted(table.read()) == history_sorted(expected)
    # the bucket of `a` is kept for both versions, the one of `b` has never been written again
    parts = sorted((p.parent.parent.name[6], p.name) for p in path.glob("_part=*/_open=true/_bucket=*"))
    assert [number for number, _ in parts] == ["1", "2", "3"] and parts[1][1] == parts[2][1] != parts[0][1]
    assert history_sorted(table.read(2)) == sorted(
        [("a", "a1", T1, T2), ("a", "a2", T2, None), ("b", "b1", T1, None)], key=key
    )
    with pytest.raises(ValueError):
        table.read(1)


def test_empty_first_input(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "snap"))
    rows = frame(spark, ("a", "a1", T1))
    assert [table.apply(r, "code", "changed") for r in (rows.limit(0), rows, rows.limit(0))] == [1, 2, 3]
    assert history_sorted(table.read()) == [("a", "a1", T1, None)]


class Killed(Exception):
    pass


def test_unfinished_version_is_ignored(spark, tmp_path, monkeypatch):
    """A run that dies after its data and before its commit changes nothing, and the next one takes its number."""
    table = SnapshotTable(spark, str(tmp_path / "snap"))
    table.apply(frame(spark, ("a", "a1", T1)), "code", "changed")

    def die(*_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", die)
        with pytest.raises(Killed):
            table.apply(frame(spark, ("a", "zz", T2), ("zz", "zz", T1)), "code", "changed")
    assert table.version() == 1
    assert [r["code"] for r in table.read().collect()] == ["a"]
    assert table.apply(frame(spark, ("a", "a2", T2)), "code", "changed") == 2
    assert sorted(r["name"] for r in table.read().collect()) == ["a1", "a2"]


def test_writes_grow_with_the_input(spark, tmp_path):
    """A small input writes the buckets its changes fall in; rows that change nothing write nothing."""
    path = tmp_path / "snap"
    table = SnapshotTable(spark, str(path), buckets=16)
    table.apply(frame(spark, *((f"k{i}", "n", T1) for i in range(400))), "code", "changed")

    def written(version):
        return sorted(p.name for p in path.glob(f"_part={version}-*/_open=true/_bucket=*"))

    assert len(written(1)) == 16
    table.apply(frame(spark, ("k1", "m", T2), *((f"k{i}", "other", T1) for i in range(2, 50))), "code", "changed")
    assert len(written(2)) == 1
    table.apply(frame(spark, *((f"k{i}", "other", T1) for i in range(400))), "code", "changed")
    assert written(3) == [] and table.version() == 3
    rows = table.read().collect()
    assert len(rows) == 401 and sorted(r["name"] for r in rows if r["code"] == "k1") == ["m", "n"]


def test_concurrent_inputs_are_merged_one_after_the_other(spark, tmp_path):
    path, start, errors = str(tmp_path / "snap"), threading.Barrier(3), []
    SnapshotTable(spark, path, buckets=2).apply(frame(spark, ("a", "a0", T1)), "code", "changed")
    inputs = [frame(spark, ("a", f"a{i}", datetime(2024, 2, i)), (f"own{i}", "o", T1)) for i in (1, 2, 3)]

    def work(rows):
        try:
            start.wait()
            SnapshotTable(spark, path).apply(rows, "code", "changed")
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=work, args=(rows,)) for rows in inputs]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors
    table = SnapshotTable(spark, path)
    assert table.version() == 4
    rows = table.read().collect()
    assert sorted(r["code"] for r in rows if r["valid_to"] is None) == ["a", "own1", "own2", "own3"]
    chain = sorted((r["valid_from"], r["valid_to"]) for r in rows if r["code"] == "a" and r["valid_to"])
    assert all(until == begin for (_, until), (begin, _) in zip(chain, chain[1:]))
    assert [r["name"] for r in rows if r["code"] == "a" and r["valid_to"] is None] == ["a3"]


def test_columns_named_like_the_historys_own(spark, tmp_path):
    """A change column `updated_at` is the history's; other columns of such names get the prefix `source_`."""
    schema = "scd_id string, name string, updated_at timestamp, valid_to string, _bucket int"
    first = spark.createDataFrame([("a", "1", T1, "x", 7), ("b", "1", T1, "y", 7)], schema)
    second = spark.createDataFrame([("a", "2", T2, "z", 7)], schema)
    expected = [("a", "1", T1, T2, "x"), ("a", "2", T2, None, "z"), ("b", "1", T1, None, "y")]

    def seen(df):
        assert df.columns == ["source_scd_id", "name", "source_valid_to", *tail, "scd_id", "updated_at", "valid_from", "valid_to"]
        return sorted((tuple(r) for r in df.select("source_scd_id", "name", "updated_at", "valid_to", "source_valid_to").collect()), key=key)

    tail = ["_bucket"]
    history = scd2_apply(scd2_apply(None, first, "scd_id", "updated_at"), second, "scd_id", "updated_at")
    assert seen(history) == expected
    tail = []
    table = SnapshotTable(spark, str(tmp_path / "snap"))
    for rows in (first, second):
        table.apply(rows.drop("_bucket"), "scd_id", "updated_at")
    assert seen(table.read()) == expected
    # as a plain column beside another change column it is one of the input's
    other = first.withColumn("changed", F.col("updated_at")).select("name", "updated_at", "changed")
    assert first_versions(other, "name", "changed").columns == [
        "name", "source_updated_at", "changed", "scd_id", "updated_at", "valid_from", "valid_to"
    ]
    with pytest.raises(ValueError, match="columns of"):
        table.apply(frame(spark, ("a", "1", T1)), "code", "changed")


def test_versions_count_without_success_markers(spark, tmp_path, conf):
    conf("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    table = SnapshotTable(spark, str(tmp_path / "snap"))
    assert [table.apply(frame(spark, ("a", n, t)), "code", "changed") for n, t in (("a1", T1), ("a2", T2))] == [1, 2]
    assert history_sorted(table.read()) == [("a", "a1", T1, T2), ("a", "a2", T2, None)]


def test_repeated_and_missing_keys_leave_one_open_version(spark):
    current = scd2_apply(None, frame(spark, ("a", "x", T1), ("a", "w", T1), (None, "n", T1)), "code", "changed")
    second = frame(spark, ("a", "y", T2), ("a", "z", T3), (None, "n", T1), (None, "m", T2))
    got = history_sorted(scd2_apply(current, second, "code", "changed"))
    expected = [("a", "w", T1, T3), ("a", "z", T3, None), (None, "n", T1, T2), (None, "m", T2, None)]
    assert got == sorted(expected, key=key)


def test_ids_do_not_depend_on_the_session_zone(spark, conf):
    ids = []
    for zone in ("UTC", "Asia/Tokyo"):
        conf("spark.sql.session.timeZone", zone)
        moment = spark.range(1).select(F.lit("a").alias("code"), F.timestamp_micros(F.lit(1)).alias("changed"))
        ids.append(first_versions(moment, "code", "changed").first()["scd_id"])
    assert ids[0] == ids[1]
