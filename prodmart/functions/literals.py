"""List and dict literals stored as text, in Python or JSON notation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Any option stops the optimizer from splitting one parse into one parse per accessed field;
# this one is also needed for quotes escaped inside quotes.
_JSON = {"allowBackslashEscapingAnyCharacter": "true"}

# Pieces of a literal that are stepped over whole: quoted text with its escapes, and bare text up to
# the next token. All loops are possessive, so long texts are matched without recursion or backtracking.
_QUOTED = r"""\"(?:[^\"\\]++|\\.)*+\"|'(?:[^'\\]++|\\.)*+'"""


def _bare_token(token: str) -> str:
    """Pattern of `token` outside quotes: group 1 is the text since the match before, group 2 the token."""
    return rf"(?s)\G((?:[^\"'\w-]++|{_QUOTED}|(?!(?:{token})\b)(?:-|\w++))*+)({token})\b"


_MISSING = _bare_token("-?(?:None|nan|inf)")
_BOOLEAN = _bare_token("True|False")
# A bare key (number, None, True...) before its colon, and a comma before a closing bracket.
_KEY = r"[-+.\w]++"
_BARE_KEY = rf"(?s)\G((?:[^\"'\w.+-]++|{_QUOTED}|(?!{_KEY}\s*+:){_KEY})*+)({_KEY})(?=\s*+:)"
_LAST_COMMA = rf"(?s)\G((?:[^\"',]++|{_QUOTED}|,(?!\s*+[\]}}]))*+),(?=\s*+[\]}}])"
_HEX_ESCAPE = r"(?s)\G((?:[^\\]++|\\[^x])*+)\\x([0-9a-fA-F]{2})"

# What the patterns look for.
_TOKENS = ["None", "nan", "inf", "True", "False", "\\x"]
_LOOSE = r",\s*+[\]}]|[{,]\s*+[-+.\w]++\s*+:"


def to_json_notation(col: Column) -> Column:
    """Rewrite what Python writes and JSON does not; quoted text stays as it is.

    These are bare None/nan/True/False values, \\xNN escapes, keys without quotes (their text becomes the key) and a
    comma after the last element.
    """
    loose = col.rlike(_LOOSE)
    keyed = F.when(loose, F.regexp_replace(F.regexp_replace(col, _LAST_COMMA, "$1"), _BARE_KEY, '$1"$2"')).otherwise(col)
    rewritten = F.regexp_replace(keyed, _MISSING, "$1null")
    rewritten = F.regexp_replace(rewritten, _BOOLEAN, '$1"$2"')
    rewritten = F.regexp_replace(rewritten, _HEX_ESCAPE, r"$1\\u00$2")
    suspect = loose
    for token in _TOKENS:
        suspect = suspect | col.contains(token)
    return F.when(suspect, rewritten).otherwise(col)


def parse_map(col: Column) -> Column:
    """Dict literal -> map<string,string>; NULL, empty text and anything that is not a dict give NULL."""
    return F.from_json(to_json_notation(col), "map<string,string>", _JSON)


def parse_array(col: Column) -> Column:
    """List literal -> array<string>; `[]` gives an empty array, unparsable text NULL."""
    return F.from_json(to_json_notation(col), "array<string>", _JSON)


def parse_fields(col: Column, keys: list[str]) -> Column:
    """Dict literal -> struct of the named keys as text; the parser skips every other key."""
    schema = ", ".join(f"`{k}` string" for k in keys)
    return F.from_json(to_json_notation(col), schema, _JSON)


def map_fields(parsed: Column, keys: list[str], default: str | None = None) -> list[Column]:
    """Values of `keys`; a missing key gives `default`, a NULL map gives NULL everywhere."""
    return [
        F.when(parsed.isNull(), F.lit(None))
        .when(F.map_contains_key(parsed, F.lit(k)), F.element_at(parsed, F.lit(k)))
        .otherwise(F.lit(default))
        .cast("string")
        for k in keys
    ]
