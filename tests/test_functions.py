import math
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from prodmart import functions as fn
from prodmart.functions.text import SPELLED, replace_value, strip


def apply(spark, values, build, kind="string"):
    """Results of a column function over a one-column frame, in input order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("CREMA", "crema"), ("Crème", "creme"), ("CRÈME", "creme"), (" crema ", "crema"), (None, None),
        ("", ""), (" \t\n\xa0　x y　\x1f", "x y"), ("Straße Œuvre Ærø", "strasse oeuvre aero"),
        ("Łódź Đặng", "lodz dang"), ("été", "ete"), ("İzmir", "izmir"), ("½ l'eau “crème”…", "1/2 l'eau \"creme\"..."),
        ("Борщ и Ёж", "borshch i iozh"), ("Ψωμί Θάλασσα", "psomi thalassa"), ("10 € – 5°", "10 EUR - 5deg"),
        ("日本 É", "日本 e"), ("ＡＢＣ１", "abc1"),
        ("ﬁsh ﬂour eﬃcient", "fish flour efficient"), ("⅓ ¼", "1/3 1/4"), ("£5 ±2 №1 ¿", "PS5 +-2 No1 ?"), ("5−3′ ŉ", "5-3' 'n"),
        ("Об'єкт Їжа", "ob'iekt yizha"), ("Подъезд День", "pod'ezd den'"), ("Љубав Ђак", "ljubav djak"),
        ("すし カツ ﾊ", "sushi katsu ha"), ("ガンギ", "gangi"), ("a\u00adb\u200bc", "abc"), ("¥5=|x|", "Y=5=|x|"), ("Ǿ Ǽ ① ²", "o ae 1 2"),
    ],
)
def test_clean_text(spark, text, expected):
    assert apply(spark, [text], fn.clean_text) == [expected]


def test_every_mapped_character_becomes_ascii(spark):
    blocks = [(0xA1, 0x17F), (0x3B1, 0x3C9), (0x430, 0x45F), (0x2010, 0x2027), (0x2150, 0x215E), (0x3041, 0x3096), (0x30A1, 0x30FA)]
    inside = [chr(c) for first, last in blocks for c in range(first, last + 1)]
    got = apply(spark, ["x" + ch + "x" for ch in inside], fn.clean_text)
    left = {ch for ch, text in zip(inside, got) if not text.isascii()}
    assert left <= set("¤¬†‡‣‥‧‗‖‟‴ʼ"), left


def test_clean_text_keeps_whole_long_texts(spark):
    text = "É" + "abc é " * 50_000 + "Ж"
    assert apply(spark, [text], fn.clean_text) == ["e" + "abc e " * 50_000 + "zh"]


def test_strip_equals_python_strip(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    values = [s + "a" + s + "b" + s for s in spaces]
    assert apply(spark, values, strip) == [v.strip() for v in values]


def test_replace_value(spark):
    build = lambda c: replace_value(fn.clean_text(c), "xx", "unknown")
    assert apply(spark, ["XX", "xx", "xxl", None], build) == ["unknown", "unknown", "xxl", None]


LEVELS = "{'salt': 'high', 'sugars': 'moderate', 'fat': 'low', 'saturated-fat': 'moderate'}"


@pytest.mark.parametrize(
    "text, expected",
    [
        (LEVELS, ("low", "high", "moderate", "moderate")),
        (LEVELS.replace("'", '"'), ("low", "high", "moderate", "moderate")),
        ("{'salt': 'moderate', 'fat': 'high', }", ("high", "moderate", "unknown", "unknown")),
        ("{1: 'x', 'fat': 'low', None: 2, -1.5: 'say {2: 3,}', True: [1, ], }", ("low", "unknown", "unknown", "unknown")),
        ("{'fat': None}", (None, "unknown", "unknown", "unknown")),
        ("{}", ("unknown",) * 4),
        ("", (None,) * 4), (None, (None,) * 4), ("garbage", (None,) * 4), ("[]", (None,) * 4),
    ],
)
def test_nutrient_levels(spark, text, expected):
    row = spark.createDataFrame([(text,)], "x string").select(*fn.nutrient_levels(F.col("x"))).first()
    assert tuple(row) == expected


def test_nutrients(spark):
    texts = [
        "{'energy-kcal_100g': 250, 'fat_100g': '1.5', 'other': {'deep': [1]}, 'fiber_100g': 2e-05}",
        "{'fat_100g': 'x', 'salt_100g': nan, 'sugars_100g': None}", "garbage", "{}", "", None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    rows = [tuple(r) for r in df.orderBy("i").select(*fn.nutrients(F.col("x"))).collect()]
    assert rows[0] == (250.0, 1.5, None, None, None, None, 2e-05)
    assert rows[1:] == [(None,) * 7] * 5


@pytest.mark.parametrize(
    "text, expected",
    [
        ("{'fat': None, 'b': True, 'n': nan, 'z': 1.5}", {"fat": None, "b": "True", "n": None, "z": "1.5"}),
        ("{'t': 'say None, ok', 'u': 'None'}", {"t": "say None, ok", "u": "None"}),
        ('{"k": 69}', {"k": "69"}),
        ("{'t': 'salt, None, sugar', 'n': None}", {"t": "salt, None, sugar", "n": None}),
        ('{"t": "a, True, b", "k": 1}', {"t": "a, True, b", "k": "1"}),
        ("{'fat':     None, 'a': 'b'}", {"fat": None, "a": "b"}),
        ("{'t': \"it's: nan, inf\", 'x': -inf, 'y': False}", {"t": "it's: nan, inf", "x": None, "y": "False"}),
        (r"{'p': 'c\\x41', 'q': '\x41', 'u': None}", {"p": r"c\x41", "q": "A", "u": None}),
        (r"{'e': 'it\'s, None, ok', 'Nones': nan}", {"e": "it's, None, ok", "Nones": None}),
        ("{'long': '" + "None, " * 50_000 + "', 'n': None}", {"long": "None, " * 50_000, "n": None}),
        ("{'a': \"l'eau\", 'b': 'x\\'y', 'c': 'p\\xa0q'}", {"a": "l'eau", "b": "x'y", "c": "p\xa0q"}),
        ("{}", {}), ("[]", None), ("nope", None), ("", None), (None, None),
    ],
)
def test_parse_map(spark, text, expected):
    assert apply(spark, [text], fn.parse_map) == [expected]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("['a', 'b']", ["a", "b"]), ("[]", []), ("[\"l'eau\", 'b']", ["l'eau", "b"]),
        ("[None, None, 'a']", [None, None, "a"]), ('["a, True, b"]', ["a, True, b"]), ("['a, True, b', True]", ["a, True, b", "True"]),
        ("x", None), (None, None),
    ],
)
def test_parse_array(spark, text, expected):
    assert apply(spark, [text], fn.parse_array) == [expected]


def test_map_fields_default(spark):
    df = spark.createDataFrame([("{'a': 1}",), (None,)], "x string")
    rows = df.select(*fn.map_fields(fn.parse_map(F.col("x")), ["a", "b"], default="unknown")).collect()
    assert [tuple(r) for r in rows] == [("1", "unknown"), (None, None)]


def test_clip(spark):
    got = apply(spark, [1.4, -2.0, 0.5, None, math.nan], lambda c: fn.clip(c, 0.0, 1.0), "double")
    assert got == [1.0, 0.0, 0.5, None, None]


def test_numbers(spark):
    assert apply(spark, ["1.5", "x", "NaN", None, "Infinity", "-inf"], fn.parse_double) == [1.5] + [None] * 5
    assert apply(spark, ["1600000000", "1600000000.0", "x"], fn.parse_long) == [1600000000, 1600000000, None]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("['nestle waters', 'b']", "nestle waters"), ("[\"l'eau\"]", "leau"), ("[]", ""), (None, None),
        ('["en:a","b"]', "en:a"),
    ],
)
def test_first_tag(spark, text, expected):
    assert apply(spark, [text], fn.first_tag) == [expected]


def test_explode_tags(spark):
    rows = [(1, "['nestle waters', 'a, b']"), (2, "[]"), (3, None), (4, "['x', 'x']"), (5, "[\"l'eau\", '']")]
    df = spark.createDataFrame(rows, "code int, tags string")
    legacy = [tuple(r) for r in fn.explode_tags(df, "code", "tags", "tag").orderBy("code", "tag").collect()]
    assert legacy == [(1, "a"), (1, "b"), (1, "nestlewaters"), (4, "x"), (4, "x"), (5, "leau")]
    array = [tuple(r) for r in fn.explode_tags(df, "code", "tags", "tag", "array").orderBy("code", "tag").collect()]
    assert array == [(1, "a, b"), (1, "nestle waters"), (4, "x"), (4, "x"), (5, "l'eau")]
    with pytest.raises(ValueError):
        fn.split_tags(F.lit("x"), "other")


def test_empty_list_to_null(spark):
    assert apply(spark, ["[]", "['a']", None], fn.empty_list_to_null) == [None, "['a']", None]


@pytest.mark.parametrize("text, expected", [
    ("한국어 김치 닭갈비", "hangugeo gimci dalggalbi"), ("없다 왜 의", "eobsda wae yi"), ("שלום עולם", "shlvm `vlm"), ("בְּרֵאשִׁית", "brashyt"),
    ("مرحبا، ١٢٣؟", "mrhba, 123?"), ("أَحْمَد گلابی", "ahmd glaby"), ("नमस्ते भारत १२", "nmste bhaart 12"), ("হলুদ ৫", "hlud 5"),
    ("தமிழ்", "tmilll"), ("ａｂｃ Ünï 漢", "abc uni 漢"), ("cafè 한 ß שׁ", "cafe han ss sh"),
])
def test_scripts_are_spelled(spark, text, expected):
    assert spark.createDataFrame([(text,)], "x string").select(fn.clean_text(F.col("x"))).first()[0] == expected


def test_every_mapped_character_becomes_ascii(spark):
    """All of Korean, which its syllables' Unicode names spell out, and every letter and digit of the other scripts added."""
    korean = [chr(c) for c in range(0xAC00, 0xD7A4)]
    others = [chr(c) for a, b in ((0x5D0, 0x5EB), (0x620, 0x64B), (0x660, 0x66A), (0x900, 0xD80)) for c in range(a, b)]
    others = [c for c in others if unicodedata.category(c) in ("Lo", "Nd") and spelled(c)]
    df = spark.createDataFrame(list(enumerate(korean + others)), "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(fn.clean_text(F.col("x"))).collect()]
    assert got[: len(korean)] == [unicodedata.name(c).split()[-1].lower() for c in korean]
    assert len(others) > 400 and all(g.isascii() for g in got[len(korean) :])


def spelled(c):
    """Letters with a plain name; the few signs with names of several words pass through."""
    name = unicodedata.name(c)
    return unicodedata.category(c) == "Nd" or 0x5D0 <= ord(c) < 0x64B and c in SPELLED or bool(
        re.match(r"\w+ LETTER [A-Z]{1,5}$", name) and not name.startswith(("ARABIC", "HEBREW"))
    )
