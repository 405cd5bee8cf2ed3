"""Text normalisation: lower case, strip, fold to ASCII."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, functions as F

# What counts as white space when stripping (Unicode space characters and separators).
WHITESPACE = "".join(
    map(
        chr,
        [
            0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)

# Letters without a canonical decomposition, then signs, then Greek and Cyrillic romanisation.
SPELLED = {
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th",
    "ħ": "h", "ı": "i", "ŋ": "ng", "ĳ": "ij", "ĸ": "k", "ŧ": "t", "ƒ": "f", "ə": "e", "µ": "u",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": '"', "′": "'", "″": '"', "ʼ": "'", "ʻ": "'",
    "‹": "<", "›": ">", "«": "<<", "»": ">>", "¡": "!", "¿": "?", "´": "'", "¨": '"', "¯": "-", "¸": ",",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "−": "-", "⁄": "/", "∕": "/", "÷": "/", "×": "x",
    "±": "+-", "•": "*", "·": "*", "…": "...", "¦": "|", "°": "deg", "§": "SS", "¶": "P", "©": "(c)", "®": "(r)", "™": "(tm)",
    "€": "EUR", "£": "PS", "¥": "Y=", "¢": "C/",
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i",
    "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s",
    "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i",
    "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s",
    "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia", "ё": "io",
    "ђ": "dj", "ѓ": "gj", "є": "ie", "ѕ": "dz", "і": "i", "ї": "yi", "ј": "j", "љ": "lj", "њ": "nj",
    "ћ": "tsh", "ќ": "kj", "ў": "u", "џ": "dzh", "ґ": "g",
}

# Hebrew and Arabic letters (with those of Persian) and Arabic punctuation.
SPELLED |= {
    "א": "a", "ב": "b", "ג": "g", "ד": "d", "ה": "h", "ו": "v", "ז": "z", "ח": "kh", "ט": "t", "י": "y", "ך": "k", "כ": "k",
    "ל": "l", "ם": "m", "מ": "m", "ן": "n", "נ": "n", "ס": "s", "ע": "`", "ף": "p", "פ": "p", "ץ": "ts", "צ": "ts", "ק": "k",
    "ר": "r", "ש": "sh", "ת": "t", "־": "-", "׳": "'", "״": '"',
    "ء": "'", "ا": "a", "ب": "b", "ت": "t", "ث": "th", "ج": "j", "ح": "h", "خ": "kh", "د": "d", "ذ": "dh", "ر": "r", "ز": "z",
    "س": "s", "ش": "sh", "ص": "s", "ض": "d", "ط": "t", "ظ": "z", "ع": "`", "غ": "gh", "ف": "f", "ق": "q", "ك": "k", "ل": "l",
    "م": "m", "ن": "n", "ه": "h", "و": "w", "ى": "a", "ي": "y", "ة": "h", "پ": "p", "چ": "ch", "ژ": "zh", "ک": "k", "گ": "g",
    "ی": "y", "،": ",", "؛": ";", "؟": "?", "٪": "%", "٫": ".", "٬": ",",
}

# The parts of a Korean syllable in the order of their numbers: first consonant, vowel, last consonant.
HANGUL = (
    "g gg n d dd r m b bb s ss - j jj c k t p h".split(),
    "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split(),
    "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".split(),
)
HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3

# Letters of the scripts of India are spelled by their Unicode names, a consonant without the vowel in its name.
INDIC = re.compile(
    r"(?:DEVANAGARI|BENGALI|GURMUKHI|GUJARATI|ORIYA|TAMIL|TELUGU|KANNADA|MALAYALAM) (LETTER|VOWEL SIGN) (?:CANDRA |SHORT )?([A-Z]{1,5})$"
)

# Japanese syllables whose spelling differs from their Unicode name.
SYLLABLES = {"si": "shi", "ti": "chi", "tu": "tsu"}
KANA = re.compile(r"(?:HIRAGANA|KATAKANA) LETTER (?:SMALL )?([A-Z]{1,3})$")

# Blocks that are folded as a whole: Latin, Greek, Cyrillic, punctuation, currency, letter-like signs, fractions,
# enclosed numbers, kana, ligatures, full and half width, Hebrew, Arabic, the scripts of India. Korean syllables are counted out.
BLOCKS = [
    (0xA0, 0x24F), (0x2B0, 0x2FF), (0x370, 0x45F), (0x490, 0x491), (0x5BE, 0x5F4), (0x60C, 0x6F9), (0x900, 0xD7F), (0x1E00, 0x1FFF), (0x2000, 0x209C), (0x20A0, 0x20BF), (0x2100, 0x218B),
    (0x2212, 0x2215), (0x2460, 0x24FF), (0x3000, 0x30FF), (0xFB00, 0xFB4F), (0xFF01, 0xFF9F),
]
INVISIBLE = "\u0640\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"


def _spell(ch: str) -> str | None:
    """ASCII for one character: as listed, a digit by its value, a kana or an Indian letter by its name, or by what it
    decomposes to, marks left out."""
    if ch.isascii() or ch in SPELLED:
        return SPELLED.get(ch, ch)
    kana = KANA.match(unicodedata.name(ch, ""))
    if kana:
        return SYLLABLES.get(kana[1].lower(), kana[1].lower())
    indic = INDIC.match(unicodedata.name(ch, ""))
    if indic:
        name = indic[2].lower()
        return name[:-1] if indic[1] == "LETTER" and len(name) > 1 and name[0] not in "aeiou" and name.endswith("a") else name
    if unicodedata.decimal(ch, None) is not None:
        return str(unicodedata.decimal(ch))
    parts = [p for p in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(p)]
    spelled = [_spell(p) for p in parts] if parts != [ch] else [None]
    return None if None in spelled else "".join(spelled)


def _blocks() -> dict[str, str]:
    """Every character of `BLOCKS` that has a spelling. A voiced kana keeps its own name, not that of its base."""
    table = {chr(point): _spell(chr(point)) for first, last in BLOCKS for point in range(first, last + 1)}
    return {ch: spelled for ch, spelled in table.items() if spelled}


_TABLE = _blocks() | SPELLED
_SINGLE = {source: spelled for source, spelled in _TABLE.items() if len(spelled) == 1}
_FROM, _TO = "".join(_SINGLE) + INVISIBLE, "".join(_SINGLE.values())
_SEVERAL = {source: spelled for source, spelled in _TABLE.items() if len(spelled) > 1}
_FREQUENT = ["ß", "æ", "œ"]
# Where characters spelled with several letters may lie; wider than they are, as a class of few ranges is quickly asked.
_RARE_CLASS = (
    "[\u0080-\u02ff\u0370-\u0482\u048a-\u0590\u05be-\u05f4\u060c-\u06ff\u0900-\u0dff\u1e00-\u20cf\u2100-\u2bff\u3000-\u3029\u3030-\u30ff"
    "\uac00-\ud7a3\ufb00-\ufb4f\uff00-\uffef]"
)
# Upper ends of the ranges in which a character is looked for.
_RANGES = [0x400, 0x590, 0x600, *range(0x900, 0xD81, 0x80), 0x1E00, 0x3000, 0x10000]


def strip(col: Column) -> Column:
    """Remove white space of any kind at both ends (`trim` alone removes blanks only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_ascii(col: Column) -> Column:
    """As many bytes as characters."""
    return F.octet_length(col) == F.char_length(col)


def _quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _lookup(first: str, last: str) -> str:
    """Spelling of `ch` among those of one script, so that a character is looked for in few entries."""
    entries = "|".join(f"{source}={spelled}" for source, spelled in _SEVERAL.items() if first <= source <= last)
    return f"coalesce(try_element_at(str_to_map({_quoted(entries)}, '\\\\|', '='), ch), ch)"


def _jamo(parts: list[str], number: str) -> str:
    listed = ", ".join(_quoted(p.replace("-", "")) for p in parts)
    return f"get(array({listed}), CAST({number} AS INT))"


def _hangul(n: str) -> str:
    """Spelling of the syllable of number `n`, which counts last consonants within vowels within first consonants."""
    first, vowel, last = HANGUL
    per_vowel, per_first = len(last), len(last) * len(vowel)
    return f"concat({_jamo(first, f'{n} DIV {per_first}')}, {_jamo(vowel, f'{n} % {per_first} DIV {per_vowel}')}, {_jamo(last, f'{n} % {per_vowel}')})"


# One character at a time, those spelled with several letters replaced.
_SPELL_OUT = f"""
    array_join(transform(split(t, ''), ch -> CASE
        WHEN ch < '\u0080' THEN ch
        WHEN ch BETWEEN '{chr(HANGUL_FIRST)}' AND '{chr(HANGUL_LAST)}' THEN {_hangul(f"(ascii(ch) - {HANGUL_FIRST})")}
        {" ".join(f"WHEN ch < '{chr(end) if end < 0x10000 else chr(0x10000)}' THEN {_lookup(chr(begin), chr(end - 1))}"
                  for begin, end in zip([0x80, *_RANGES], _RANGES))}
        ELSE ch END), '')
"""

# Western text is ASCII after its letters are translated; only what is left needs the costly passes.
_FINISH = f"""
    t -> CASE WHEN octet_length(t) = char_length(t) THEN t
              ELSE regexp_replace(CASE WHEN t RLIKE {_quoted(_RARE_CLASS)} THEN {_SPELL_OUT} ELSE t END, '\\\\p{{M}}+', '')
         END
"""


def fold_text(col: Column) -> Column:
    """Fold to ASCII; expects lower case. Scripts that are neither in `BLOCKS` nor Korean (Han, Thai, Armenian...) pass unchanged."""
    latin = col
    for source in _FREQUENT:
        latin = F.replace(latin, F.lit(source), F.lit(_SEVERAL[source]))
    translated = F.translate(latin, _FROM, _TO)
    # The lambda binds the translated text, which it mentions several times but computes once.
    return F.get(F.call_function("transform", F.array(translated), F.expr(_FINISH)), 0)


def clean_text(col: Column) -> Column:
    """Lower case, strip, fold; values that are ASCII from the start skip the folding."""
    text = col.cast("string")
    plain = strip(F.lower(text))
    return F.when(is_ascii(text), plain).otherwise(fold_text(plain))


def replace_value(col: Column, old: str, new: str) -> Column:
    """Whole-value replacement; NULL stays NULL."""
    return F.when(col == old, F.lit(new)).otherwise(col)
