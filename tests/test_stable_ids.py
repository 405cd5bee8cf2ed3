import threading

import pytest

from prodmart.operators.stable_ids import IdDictionary
from prodmart.sources.commits import CommitLog

SCHEMA = "name string, owner string"


def members(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def found(df):
    assert df.columns == ["id", "name", "owner"]
    return {(r["name"], r["owner"]): r["id"] for r in df.collect()}


def test_ids_are_kept(spark, tmp_path):
    ids = IdDictionary(spark, str(tmp_path / "ids"), "id")
    assert found(ids.assign(members(spark))) == {}
    first = found(ids.assign(members(spark, ("b", None), ("m", "x"), ("m", "x"), (None, None))))
    assert first == {("b", None): 1, ("m", "x"): 2, (None, None): 3}
    # earlier names, other owners and missing ones among the new members; one of the known ones is not asked for
    second = found(ids.assign(members(spark, ("a", "x"), ("m", None), ("m", "x"), (None, None), (None, "o"))))
    assert second == {("m", "x"): 2, (None, None): 3, ("a", "x"): 4, ("m", None): 5, (None, "o"): 6}
    assert found(ids.assign(members(spark, ("b", None), ("a", "x")))) == {("b", None): 1, ("a", "x"): 4}
    assert ids.log.version() == 2  # nothing new, nothing written


def test_a_run_that_dies_gives_out_nothing(spark, tmp_path, monkeypatch):
    ids = IdDictionary(spark, str(tmp_path / "ids"), "id")
    ids.assign(members(spark, ("a", None)))
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            ids.assign(members(spark, ("z", None)))
    assert found(ids.assign(members(spark, ("c", None), ("a", None)))) == {("a", None): 1, ("c", None): 2}


def test_two_builds_at_a_time(spark, tmp_path):
    path, start, results, errors = str(tmp_path / "ids"), threading.Barrier(3), {}, []

    def work(n):
        try:
            start.wait()
            results[n] = found(IdDictionary(spark, path, "id").assign(members(spark, ("shared", None), (f"own {n}", None))))
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=work, args=(n,)) for n in range(3)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors
    assert len({r[("shared", None)] for r in results.values()}) == 1
    assert sorted({i for r in results.values() for i in r.values()}) == [1, 2, 3, 4]
