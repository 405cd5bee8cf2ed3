"""Random inputs against plain Python."""

import ast
import random
import unicodedata
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from prodmart.functions import clean_text, explode_tags, first_tag, nutrient_levels, nutrients, parse_array, parse_map
from prodmart.operators.keyed import append_new
from prodmart.operators.scd2 import scd2_apply
from prodmart.plans.staging import plausible

START = datetime(2024, 1, 1)


def test_scd2_over_many_generations(spark):
    rng = random.Random(3)
    schema = "k string, v long, at timestamp"
    current, expected = None, {}
    for generation in range(4):
        rows = []
        for key in rng.sample(range(200), 120):
            rows.append((f"k{key}", generation, START + timedelta(hours=rng.randrange(6))))
        current = scd2_apply(current, spark.createDataFrame(rows, schema), "k", "at")
        for k, v, at in rows:
            versions = expected.setdefault(k, [])
            if not versions:
                versions.append([v, at, None])
            elif at > versions[-1][1]:
                versions[-1][2] = at
                versions.append([v, at, None])
    got = sorted((r["k"], r["v"], r["valid_from"], r["valid_to"]) for r in current.collect() if r["valid_to"]) + sorted(
        (r["k"], r["v"], r["valid_from"]) for r in current.collect() if not r["valid_to"]
    )
    flat = [(k, *v) for k, versions in expected.items() for v in versions]
    assert got == sorted(f for f in flat if f[3]) + sorted(f[:3] for f in flat if not f[3])


def test_append_new_over_many_batches(spark):
    rng = random.Random(4)
    schema = "code string, page_no long, pos long"
    stored = spark.createDataFrame([], schema)
    expected: dict[str, tuple] = {}
    for _ in range(3):
        spots = rng.sample(range(1000), 300)
        # a third of the rows share one key
        batch = [("hot" if s % 3 == 0 else f"c{rng.randrange(150)}", s // 100, s % 100) for s in spots]
        fresh = append_new(stored, spark.createDataFrame(batch, schema), ["code"], ["page_no", "pos"])
        stored = spark.createDataFrame(fresh.collect(), schema).unionByName(spark.createDataFrame(stored.collect(), schema))
        known = set(expected)
        for row in sorted(batch, key=lambda r: r[1:]):
            if row[0] not in known:
                expected.setdefault(row[0], row)
    assert sorted(map(tuple, stored.collect())) == sorted(expected.values())


def test_tags_follow_the_text_rules(spark):
    rng = random.Random(5)
    words = ["en:france", "fr:pays bas", "l'eau", 'say "x"', "a, b", "é", "", " x "]
    lists = [str(rng.choices(words, k=rng.randrange(4))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(lists)), "i long, tags string")
    bare = lambda t: "".join(ch for ch in t if ch not in "[]'\" ")
    expected = sorted((i, tag) for i, t in enumerate(lists) for tag in bare(t).split(",") if tag and t != "[]")
    assert sorted(map(tuple, explode_tags(df, "i", "tags", "tag").collect())) == expected

    def head(text):
        return text.replace("[", "").replace("]", "").split(",")[0].replace('"', "").replace("'", "").strip(" ")

    firsts = [r[0] for r in df.orderBy("i").select(first_tag(F.col("tags"))).collect()]
    assert firsts == [head(t) for t in lists]
    arrays = [r[0] for r in df.orderBy("i").select(parse_array(F.col("tags"))).collect()]
    assert arrays == [ast.literal_eval(t) for t in lists]


def test_dict_literals_follow_python(spark):
    rng = random.Random(6)
    keys = ["fat", "salt", "saturated-fat", "sugars", "fat_100g", "salt_100g", "note's", "other"]
    values = ["low", "high", None, 1.5, 3, 2e-07, True, "it's", 'say "None", ok', [1, "x"], {"a": None}]
    texts = []
    for _ in range(300):
        texts.append(str({k: rng.choice(values) for k in rng.sample(keys, rng.randrange(len(keys)))}))
    df = spark.createDataFrame(list(enumerate(texts)), "i long, x string")
    got = df.orderBy("i").select(*nutrient_levels(F.col("x")), *nutrients(F.col("x"))).collect()
    for text, row in zip(texts, got):
        parsed = ast.literal_eval(text)
        for key, column in (("fat", "fat_level"), ("salt", "salt_level"), ("saturated-fat", "saturated_fat_level")):
            value = parsed.get(key, "unknown")
            if value is None or isinstance(value, str):
                assert row[column] == value
        for key in ("fat_100g", "salt_100g"):
            value = parsed.get(key)
            number = isinstance(value, (int, float)) and not isinstance(value, bool)
            assert row[key] == (float(value) if number else None)


def test_clean_text_follows_python(spark):
    rng = random.Random(7)
    letters = [c for c in map(chr, range(0x20, 0x250)) if unicodedata.normalize("NFKD", c)[0].isascii() and c.isprintable()]
    texts = ["".join(rng.choices(letters, k=rng.randrange(30))) for _ in range(500)]
    # signs and modifiers whose decomposition is not a letter plus marks are left out
    plain = {c: "".join(p for p in unicodedata.normalize("NFKD", c) if not unicodedata.combining(p)) for c in letters}
    texts = [
        "".join(c for c in t if len(plain[c]) == 1 and plain[c].isascii() and (c == " " or plain[c] != " ") and len(c.lower()) == 1)
        for t in texts
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, x string")
    got = [r[0] for r in df.orderBy("i").select(clean_text(F.col("x"))).collect()]
    fold = lambda t: "".join(
        p for c in t.lower().strip() for p in unicodedata.normalize("NFKD", c) if not unicodedata.combining(p)
    )
    assert got == [fold(t) for t in texts]


def test_loose_literals_follow_python(spark):
    """Keys of any plain kind, commas after the last element, blanks anywhere; text that looks like such things stays."""
    rng = random.Random(9)
    texts, expected = [], []
    keys = [7, 23, -4, 2.5, "k", "fat_100g", "a b", None, True, "x: 1, }", "it's"]
    values = ["'v'", "\"it's, }\"", "None", "3", "'{1: 2,}'", "True", "'a,]'", "''"]
    for _ in range(300):
        chosen = rng.sample(keys, rng.randrange(len(keys)))
        blank = lambda: rng.choice(["", " ", "\n ", "\t"])
        items = [f"{blank()}{k!r}{blank()}:{blank()}{rng.choice(values)}{blank()}" for k in chosen]
        text = "{" + ",".join(items) + ("," + blank() if items and rng.random() < 0.5 else "") + "}"
        texts.append(text)
        shown = lambda v: None if v is None else str(v)
        expected.append({str(k): shown(v) for k, v in ast.literal_eval(text).items()})
    df = spark.createDataFrame(list(enumerate(texts)), "i long, x string")
    got = [r[0] for r in df.orderBy("i").select(parse_map(F.col("x"))).collect()]
    assert got == expected
    lists = ["['a', 'b',]", "['a' , ]", "[',]', 1,\n]", "[]", "['{1: 2}']"]
    df = spark.createDataFrame(list(enumerate(lists)), "i long, x string")
    got = [r[0] for r in df.orderBy("i").select(parse_array(F.col("x"))).collect()]
    assert got == [[str(v) for v in ast.literal_eval(x)] for x in lists]


def test_plausible_is_three_valued(spark):
    rng = random.Random(8)
    names = ["energy_kcal_100g", "sugars_100g", "fat_100g", "proteins_100g", "salt_100g"]
    choices = [None, 0.0, 99.9, 100.0, 999.9, 1000.0, -1.0, float("nan")]
    rows = [tuple(rng.choice(choices) for _ in names) for _ in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    limits = [1000, 100, 100, 100, 100]
    keep = sum(all(v is not None and v < limit for v, limit in zip(row, limits)) for row in rows)
    assert df.where(plausible()).count() == keep
