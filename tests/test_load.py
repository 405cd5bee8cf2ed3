import threading
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from prodmart.plans.clean import clean_products, drop_tag_twins, drop_time_travel, new_batch_id
from prodmart.operators.keyed import append_new, rows_to_compare
from prodmart.plans import load
from prodmart.plans.load import RawLog, drop_dead_tries, load_raw, read_raw, read_rejected
from prodmart.schema import COLUMNS, ORDER_COLUMNS, RAW_COLUMNS, conform
from prodmart.sources import tables
from prodmart.sources.commits import CommitLog, Conflict, create_once
from prodmart.sources.tables import Lakehouse
from scans import rows_scanned

NOW = datetime(2024, 5, 1, tzinfo=timezone.utc)
SCHEMA = "page_no long, pos long, code string, product_name string, lang string, manufacturing_places_tags string, " \
         "nutriments string, nutrient_levels string, completeness double"


def batch(spark, *rows):
    full = [tuple(r) + (None,) * (9 - len(r)) for r in rows]
    return conform(spark.createDataFrame(full, SCHEMA), COLUMNS + ORDER_COLUMNS)


def stored(lake):
    return sorted((r["code"], r["product_name"], r["batch_id"], r["source"]) for r in read_raw(lake).collect())


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path / "lake"))


def test_clean_products_columns(spark):
    df = batch(spark, (1, 0, "1", " É ", "XX", "[]", "{'fat_100g': 2}", "{'fat': 'low'}", 1.5), (1, 1, None, "x"))
    cleaned = clean_products(df, "b1", NOW)
    assert set(cleaned.columns) == set(RAW_COLUMNS) | set(ORDER_COLUMNS)
    row = cleaned.first()
    assert cleaned.count() == 1
    assert (row["product_name"], row["lang"], row["manufacturing_places_tags"]) == ("e", "unknown", None)
    assert (row["completeness"], row["fat_100g"], row["fat_level"], row["salt_level"]) == (1.0, 2.0, "low", "unknown")
    assert row["batch_id"] == "b1" and row["ingested_at"] == datetime(2024, 5, 1)


def test_null_places_modes(spark):
    df = batch(spark, (1, 0, "1", "a", "en", "['paris']"))
    assert clean_products(df, "b", NOW).first()["manufacturing_places_tags"] == "['paris']"
    assert clean_products(df, "b", NOW, legacy_null_places=True).first()["manufacturing_places_tags"] is None


def test_drop_tag_twins(spark):
    df = spark.createDataFrame([("a", "b", "c")], "labels string, labels_tags string, owner string")
    assert drop_tag_twins(df).columns == ["labels_tags", "owner"]


def test_drop_time_travel(spark):
    rows = [(1, 2), (2, 1), (None, 1), (1, None)]
    df = spark.createDataFrame(rows, "created_t long, last_modified_t long")
    assert sorted(map(str, map(tuple, drop_time_travel(df).collect()))) == ["(1, 2)", "(1, None)", "(None, 1)"]


def test_new_batch_id():
    name = new_batch_id(NOW)
    assert name.startswith("batch_id20240501_000000_") and len(name) == len("batch_id20240501_000000_") + 8


def test_load_is_append_only_and_first_wins(spark, lake):
    first = clean_products(batch(spark, (1, 1, "a", "second"), (1, 0, "a", "first"), (1, 2, "b", "bee")), "b1", NOW)
    counts = load_raw(lake, first, "b1")
    assert (counts.received, counts.rejected, counts.inserted, counts.loaded) == (3, 0, 2, 3)
    second = clean_products(batch(spark, (1, 0, "a", "changed"), (1, 1, "c", "sea")), "b2", NOW)
    counts = load_raw(lake, second, "b2")
    assert (counts.received, counts.inserted) == (2, 1)
    expected = [("a", "first", "b1", "csv"), ("b", "bee", "b1", "csv"), ("c", "sea", "b2", "csv")]
    assert stored(lake) == expected
    # repeating either batch, as after a lost run, changes nothing
    load_raw(lake, first, "b1")
    load_raw(lake, second, "b2")
    assert stored(lake) == expected


def test_bad_rows_do_not_fail_the_batch(spark, lake):
    rows = clean_products(batch(spark, (1, 0, "x" * 51, "n"), (1, 1, "ok", "n"), (1, 2, "l", "n", "z" * 11)), "b1", NOW)
    counts = load_raw(lake, rows, "b1")
    assert (counts.received, counts.rejected, counts.inserted) == (3, 2, 1)
    assert sorted(r["reject_reason"] for r in read_rejected(lake).collect()) == ["code_too_long", "lang_too_long"]


def test_rows_without_a_reading_order_raise(spark, lake):
    rows = clean_products(batch(spark, (None, None, "a", "n")), "b1", NOW)
    with pytest.raises(ValueError, match="1 rows of b1 lack a reading order"):
        load_raw(lake, rows, "b1")


def test_empty_batch(spark, lake):
    rows = clean_products(batch(spark, (1, 0, None, "n")), "b1", NOW)
    counts = load_raw(lake, rows, "b1")
    assert (counts.received, counts.inserted) == (0, 0)
    assert stored(lake) == []


def rows_of(spark, batch_id, *codes):
    return clean_products(batch(spark, *((1, i, c, f"{batch_id} {c}") for i, c in enumerate(codes))), batch_id, NOW)


class Killed(Exception):
    pass


@pytest.mark.parametrize("table", ["staged", "rejected", "products", "commit"])
def test_killed_load_is_never_seen(spark, lake, monkeypatch, table):
    """A load that dies while or after it writes any of its tables, or before its commit, leaves the version before."""
    load_raw(lake, rows_of(spark, "b1", "a", "b"), "b1")
    before = stored(lake)

    def dying_write(df, path, mode="overwrite", index=None):
        df.write.mode(mode).parquet(path)
        if f"/{table}/" in path:
            raise Killed

    def dying_commit(*_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(load, "write_table", dying_write)
        if table == "commit":
            patch.setattr(CommitLog, "commit", dying_commit)
        with pytest.raises(Killed):
            load_raw(lake, rows_of(spark, "b2", "a", "c"), "b2")
    assert stored(lake) == before and RawLog(lake).state()[0] == 1
    # the dead directories go once their version exists; a repeated load is not disturbed by them
    assert drop_dead_tries(lake, timedelta(0)) == []
    assert load_raw(lake, rows_of(spark, "b2", "a", "c"), "b2").inserted == 1
    dead = drop_dead_tries(lake, timedelta(0))
    assert len(dead) == {"staged": 1, "rejected": 2}.get(table, 3) and all("/batch_id=b2/" in path for path in dead)
    assert drop_dead_tries(lake) == []
    assert [code for code, *_ in stored(lake)] == ["a", "b", "c"]


def test_repeated_batch_is_replaced_at_once(spark, lake, monkeypatch):
    """While a batch is written again its former rows stay readable, and a reader keeps the version it has opened."""
    load_raw(lake, rows_of(spark, "b1", "a", "b"), "b1")
    opened, seen = read_raw(lake), []
    commit = CommitLog.commit
    monkeypatch.setattr(CommitLog, "commit", lambda *a: (seen.append(stored(lake)), commit(*a)))
    load_raw(lake, rows_of(spark, "b1", "a"), "b1")
    assert [code for code, *_ in seen[0]] == ["a", "b"] and [code for code, *_ in stored(lake)] == ["a"]
    assert sorted(r["code"] for r in opened.collect()) == ["a", "b"]
    assert sorted(r["code"] for r in read_raw(lake, 1).collect()) == ["a", "b"]
    assert read_raw(lake, 0).count() == 0
    with pytest.raises(ValueError):
        read_raw(lake, 3)


def test_concurrent_loads_append_each_key_once(spark, lake):
    """Four writers at a time, all with the key `shared`: everything gets in, every key once."""
    start, counts, errors = threading.Barrier(4), {}, []

    def work(name):
        try:
            rows = rows_of(spark, name, "shared", f"own {name}")
            start.wait()
            counts[name] = load_raw(lake, rows, name)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=work, args=(f"w{i}",)) for i in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors
    codes = [code for code, *_ in stored(lake)]
    assert codes == ["own w0", "own w1", "own w2", "own w3", "shared"]
    assert sorted(c.inserted for c in counts.values()) == [1, 1, 1, 2] and RawLog(lake).state()[0] == 4


def test_lost_race_is_run_again(spark, lake, monkeypatch):
    """Another writer commits the same key between the look at the version and the commit."""
    commit, raced = CommitLog.commit, []

    def slow_commit(self, version, entry):
        if not raced:
            raced.append(version)
            load_raw(lake, rows_of(spark, "fast", "x", "y"), "fast")
        commit(self, version, entry)

    monkeypatch.setattr(CommitLog, "commit", slow_commit)
    assert load_raw(lake, rows_of(spark, "slow", "x", "z"), "slow").inserted == 1
    assert [(code, b) for code, _, b, _ in stored(lake)] == [("x", "fast"), ("y", "fast"), ("z", "slow")]
    raced.clear()
    monkeypatch.setattr(CommitLog, "commit", lambda *_: (_ for _ in ()).throw(Conflict("taken")))
    with pytest.raises(Conflict):
        load_raw(lake, rows_of(spark, "never", "q"), "never", attempts=2)


def test_commit_files(spark, tmp_path):
    path = str(tmp_path / "t")
    log = CommitLog(spark, path)
    assert log.version() == 0 and log.entries() == []
    log.commit(1, {"n": 1})
    with pytest.raises(Conflict):
        log.commit(1, {"n": 2})
    log.commit(2, {"n": "é"})
    assert log.entries() == [(1, {"n": 1}), (2, {"n": "é"})] and log.entries(1) == [(2, {"n": "é"})]
    # cut short by a crash: not a version, and free again after the repair
    (tmp_path / "t" / "_commits" / f"{3:020d}.json").write_text('{"n": ')
    assert log.version() == 2 and len(log.entries()) == 2
    with pytest.raises(Conflict):
        log.commit(3, {"n": 3})
    log.repair()
    log.commit(3, {"n": 3})
    assert log.version() == 3
    with pytest.raises(Conflict):
        create_once(spark, f"{path}/_commits/{3:020d}.json", "x")


def test_state_of_many_batches(spark, lake):
    """Entries with the whole state and entries of one batch give the same state at every version."""
    log, expected = RawLog(lake), {}
    for version in range(1, 71):
        name, tries = f"b{version % 40}", {"products": f"{version}-x"}
        log.commit(version, expected, name, tries)
        expected = {**expected, name: tries}
        assert log.state() == (version, expected)
    assert log.state(33)[1] == {f"b{v}": {"products": f"{v}-x"} for v in range(1, 34)}


def test_counts_come_from_the_write(spark, lake):
    """One batch is read once: its input counts every row it hands out."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    rows = rows_of(spark, "b", "a", "b", "c")
    assert load_raw(lake, rows.mapInArrow(counted, rows.schema), "b").received == 3 and reads.value == 3
    assert read_raw(lake).where(F.col("batch_id") == "b").count() == 3


def test_small_batches_read_only_what_may_hold_their_keys(spark, lake):
    """Keys of three batches interleave, so no range of keys tells them apart; their Bloom filters do."""
    for b in range(3):
        load_raw(lake, rows_of(spark, f"b{b}", *(f"{i:05d}" for i in range(b, 3000, 3))), f"b{b}")
    stored = read_raw(lake)
    for codes, batches in ((["00001", "01501"], 1), (["00000", "00002"], 2), (["00000x", "01500x"], 0)):
        asked = rows_to_compare(stored, spark.createDataFrame([(c,) for c in codes], "code string"), "code").select("code")
        assert rows_scanned(asked) <= 1000 * batches and asked.count() == (len(codes) if batches else 0)
    assert rows_scanned(stored.select("code")) == 3000
    assert load_raw(lake, rows_of(spark, "late", "00001", "00003", "00000x"), "late").inserted == 1
    incoming = spark.createDataFrame([(f"{i:05d}",) for i in range(50)], "code string")
    assert rows_to_compare(stored, incoming, "code", limit=49).count() == 3000
    fresh = [append_new(rows_to_compare(stored, incoming, "code", limit=n), incoming, ["code"], ["code"]).count() for n in (10, 100)]
    assert fresh == [0, 0]


def test_staged_files_hold_few_rows(spark, lake, monkeypatch):
    """One task's rows go to several files, so that those who read them again can share them."""
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 20, raising=False)
    rows = [(1, i, f"c{i % 90}", f"n{i}") for i in range(100)]
    counts = load_raw(lake, clean_products(batch(spark, *rows).coalesce(1), "b1", NOW), "b1")
    assert (counts.received, counts.inserted) == (100, 90)
    staged = RawLog(lake).rows("staged", load.STAGED_SCHEMA, RawLog(lake).state()[1])
    assert len(staged.inputFiles()) == 5 and staged.count() == 100
    assert {(r["code"], r["product_name"]) for r in read_raw(lake).collect()} == {(f"c{i}", f"n{i}") for i in range(90)}
