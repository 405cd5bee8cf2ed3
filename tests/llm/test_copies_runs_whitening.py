"""Whitening, exact copies and periodic runs against plain Python and numpy."""

import hashlib
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from prodmart.llm import periodic_runs as runs_module
from prodmart.llm.cover_lce import CoverLce, difference_cover, shifts
from prodmart.llm.exact_dedup import drop_exact_copies, exact_duplicates, full_hash
from prodmart.llm.periodic_runs import RunRules, collapse_runs, find_runs, periodic_runs
from prodmart.llm.queries import QUERIES
from prodmart.llm.whitening import eigen, exact_products, fit_whitening, identity_error, whiten

BLANK = re.compile(r"[\x20\x09-\x0D]+")


# ---- exact copies


def brute_copies(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[BLANK.sub(" ", text or "")].append(i)
    out = []
    for i, text in rows:
        t = BLANK.sub(" ", text or "")
        known = [x for x in groups[t] if x is not None]
        out.append((i, min(known, default=None), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def check_copies(df, rows, **options):
    found = exact_duplicates(df, ["doc_id"], more={"sha": full_hash}, **options).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.sha) for r in found), key=key) == sorted(brute_copies(rows), key=key)
    kept = defaultdict(int)
    for r in found:
        kept[r.sha] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}
    left = drop_exact_copies(df, **options).collect()
    assert sorted(((r.doc_id, BLANK.sub(" ", r.text or "")) for r in left), key=key) == sorted(
        {(k, t) for (_, k, _, _), (_, t) in zip(brute_copies(rows), [(i, BLANK.sub(" ", t or "")) for i, t in rows])}, key=key
    )


def test_exact_copies_of_edge_rows(spark, edge, nothing):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    check_copies(edge, rows)
    assert exact_duplicates(nothing, ["doc_id"]).count() == 0 and drop_exact_copies(nothing).count() == 0
    assert drop_exact_copies(edge).columns == edge.columns
    clash = edge.withColumn("kept", F.lit("x")).withColumn("_row", F.lit(1)).withColumn("_full", F.lit(1))
    assert exact_duplicates(clash, ["doc_id", "kept", "_row", "_full"]).columns == [
        "doc_id", "_row", "_full", "keep_id", "group_size", "kept"
    ]
    assert drop_exact_copies(clash).count() == drop_exact_copies(edge).count()


@pytest.mark.parametrize("options", [{}, {"prefix": 1, "max_bits": 64}, {"prefix": 3, "max_bits": 1 << 12}])
def test_exact_copies_with_one_hot_group(spark, options):
    """A third of the rows are copies; ids repeat and are null; prefixes and bits are shared by unlike texts."""
    rows = [(i % 50 if i % 7 else None, "hot  text" if i % 3 == 0 else f"text\t{i % 400}") for i in range(3000)]
    rows += [(9000 + i, "a b" + " " * (i % 3) + "c") for i in range(9)] + [(None, ""), (None, None), (None, " \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_copies(df, rows, **options)


def test_hot_groups_are_broadcast_and_never_shuffled_as_text(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    found = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_text" not in plan and "Window" not in plan


# ---- periodic runs


def brute_runs(w, min_words=24, min_periods=3):
    """All maximal stretches for every period, by a walk over each lag; the smallest period of a stretch counts."""
    found = {}
    for q in range(1, len(w) // min_periods + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(min_words, min_periods * q):
                found.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def random_texts(rng, count):
    for _ in range(count):
        n = int(rng.integers(0, 220))
        w = rng.integers(1, int(rng.integers(2, 6)), n).tolist()
        if n > 10 and rng.random() < 0.7:
            a, p = int(rng.integers(n)), int(rng.integers(1, 30))
            w = [w[i] if i < a else w[min(a + (i - a) % p, n - 1)] for i in range(n)]
            if rng.random() < 0.3:
                w[int(rng.integers(n))] = 9
        yield w


def test_cover_gives_every_shift():
    for v in (2, 7, 13, 31):
        cover, table = set(difference_cover(v)), shifts(v)
        assert all((i + table[i, j]) % v in cover and (j + table[i, j]) % v in cover for i in range(v) for j in range(v))
    assert len(difference_cover(31)) == 6


def test_extensions_equal_plain_comparison():
    rng = np.random.default_rng(5)
    for words in random_texts(rng, 120):
        w = np.array(words, np.int64)
        if len(w) < 2:
            continue
        i = rng.integers(0, len(w) - 1, 200)
        j = i + 1 + (rng.random(200) * (len(w) - 1 - i)).astype(np.int64)
        limit = ((len(w) - j) * rng.choice([1.0, 0.5], 200)).astype(np.int64)
        for a, b, most, got in zip(i, j, limit, CoverLce(w).extend(i, j, limit)):
            e = 0
            while e < most and w[a + e] == w[b + e]:
                e += 1
            assert e == got


def test_runs_equal_a_walk_over_all_lags(monkeypatch):
    monkeypatch.setattr(runs_module, "PAIRS", 997)
    rng, total = np.random.default_rng(6), 0
    for _ in range(100):
        texts = list(random_texts(rng, int(rng.integers(1, 8))))
        at = np.cumsum([0, *map(len, texts)])
        for rules in (RunRules(), RunRules(min_words=6, min_periods=4)):
            runs = find_runs(np.array([x for t in texts for x in t], np.int64), at, rules)
            got = [[] for _ in texts]
            for t, *run in zip(runs.text, runs.start, runs.length, runs.period):
                got[t].append(tuple(run))
            expected = [brute_runs(t, rules.min_words, rules.min_periods) for t in texts]
            assert got == expected
            total += sum(map(len, expected))
    assert total > 300


def test_runs_of_edge_rows(spark, edge, nothing):
    found = periodic_runs(edge)
    assert found.columns == ["doc_id", "text", "source", "n_words", "runs", "collapsed"]
    by_text = {r.text: r for r in found.collect()}
    for text in (None, ""):
        assert (by_text[text].n_words, by_text[text].runs, by_text[text].collapsed) == (0, [], "")
    long = next(r for t, r in by_text.items() if t and len(t) > 1000)
    assert [tuple(r) for r in long.runs] == [(0, 30000, 1)] and long.collapsed == "word end"
    assert found.count() == edge.count() and periodic_runs(nothing).count() == 0
    collapsed = collapse_runs(edge)
    assert collapsed.columns == edge.columns
    assert {r.text for r in collapsed.collect()} == {"word end" if t and len(t) > 1000 else t for t in by_text}


def planted(doc_id, text):
    w = [x for x in BLANK.split(text or "") if x]
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_periodic_runs_query(spark, sf_dir):
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    total = 0
    for d in docs:
        w = planted(d.doc_id, d.text)
        if len(w) > 4000:  # the walk over all lags takes the square of the words
            continue
        runs = brute_runs(w)
        total += len(runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        rest = " ".join(x for i, x in enumerate(w) if i not in dropped)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert got[d.doc_id] == (
            d.doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest(),
        )
    assert total > 20


# ---- whitening


def spectrum(rng, values):
    q = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("kind", ["plain", "near", "multiple", "graded", "zero"])
def test_refined_eigenvectors(kind):
    """Residuals at double precision, clustered and multiple eigenvalues included; float32 alone is a million times off."""
    rng, d = np.random.default_rng(7), 40
    values = {
        "plain": np.arange(1.0, d + 1), "near": np.r_[1 + 1e-9 * np.arange(20), np.arange(2.0, 22)],
        "multiple": np.r_[np.ones(25), 2 + 1e-5 * np.arange(15)], "graded": 10.0 ** -np.arange(d), "zero": np.zeros(d),
    }[kind]
    cov = spectrum(rng, values)
    found, rows = eigen(cov.astype(np.longdouble))
    assert np.abs(rows @ rows.T - np.eye(d)).max() < 4e-16 * d
    assert np.abs(cov @ rows.T - rows.T * found).max() <= 1e-14 * max(values.max(), 1e-300)
    assert np.all(np.diff(found) <= 0) and np.abs(np.sort(values)[::-1] - found).max() <= 1e-13


def test_near_vectors_are_told_apart():
    """Within a cluster 1e-9 wide, vectors agree with the ones the matrix was made of."""
    rng = np.random.default_rng(8)
    values = np.r_[1 + 1e-9 * np.arange(6), np.arange(3.0, 9)]
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(12) - q.T @ q) / 2
    found, rows = eigen((q * values.astype(np.longdouble)) @ q.T)
    agree = np.abs(rows.astype(np.longdouble) @ q[:, np.argsort(-values)])
    assert np.abs(agree - np.eye(12)).max() < 1e-6


def test_products_are_exact():
    rng = np.random.default_rng(9)
    for size in (10, 1 << 20, 1 << 40):
        y = rng.integers(-size, size, (50, 3))
        assert (exact_products(y) == y.astype(object).T @ y.astype(object)).all()


def test_whitening_query(spark, sf_dir):
    got = QUERIES["op11_whitening"](spark, sf_dir).toPandas().sort_values(["vec_id", "component"])
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    x = np.floor(64 * np.array([vectors[i] for i in sorted(vectors)], np.float64)) + 1000000
    n, k = len(x), 32
    centred = x - x.sum(axis=0) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    white = centred @ u / np.sqrt(e)
    found = got.whitened.to_numpy().reshape(n, k)
    assert np.abs(found * np.sign((found * white).sum(axis=0)) - white).max() < 1e-9
    assert np.abs(got.explained.to_numpy().reshape(n, k) / (e / np.trace(centred.T @ centred / n)) - 1).max() < 1e-10
    assert got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-10 and set(got.n) == {n}
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1).astype(np.int64)
    assert (got.deviation.to_numpy().reshape(n, k) == deviation[:, None]).all()


def test_whitening_of_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i), float(i * i % 7)], "x") for i in range(20)] + [(3, [3.0, 2.0], "x")]
    bad = [(90, None, None), (91, [1.0, None], "x"), (92, [nan, 1.0], "x"), (93, [inf, 1.0], "x"), (94, [], "x"), (95, [1.0], "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, whitened string").repartition(4)
    model = fit_whitening(df)
    found = whiten(df, model)
    assert model.n == 21 and found.columns == ["vec_id", "embedding", "whitened", "deviation"]
    assert sorted(r.vec_id for r in found.collect()) == sorted(r[0] for r in rows)
    assert identity_error(found, model.n, 2) < 1e-12
    again = fit_whitening(df.repartition(9))
    assert (again.components == model.components).all() and (again.eigenvalues == model.eigenvalues).all()


def test_whitening_without_rows_or_spread(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [])]):
        df = spark.createDataFrame(rows, schema)
        model = fit_whitening(df)
        assert model.n == 0 and whiten(df, model).count() == 0 and identity_error(whiten(df, model), 0, 0) is None
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0, 9.0])], schema)
    model = fit_whitening(df)
    assert [[x is None for x in r.whitened] for r in whiten(df, model).collect()] == [[False, True]] * 3
    assert identity_error(whiten(df, model), 3, 2) < 1e-12
    huge = spark.createDataFrame([(1, [1e300, -1e300]), (2, [0.0, 1.0])], schema)
    assert [r.deviation for r in whiten(huge, fit_whitening(huge)).collect()] == [None, None]
