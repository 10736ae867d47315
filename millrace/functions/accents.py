"""Letters with accents, Greek, Cyrillic and full-width letters, and common signs to ASCII."""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import is_ascii, let, per_word

# Characters that Unicode does not decompose to one ASCII letter, with their usual spelling.
SPELLED = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th", "ĳ": "ij", "Ĳ": "IJ",
    "ŉ": "'n", "ŋ": "ng", "Ŋ": "NG",
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ħ": "h", "Ħ": "H", "ı": "i", "ł": "l", "Ł": "L",
    "ŀ": "l", "Ŀ": "L", "ŧ": "t", "Ŧ": "T", "ĸ": "k",
    " ": " ", "¡": "!", "¢": "C/", "£": "PS", "¥": "Y=", "§": "SS", "©": "(c)", "«": "<<", "»": ">>",
    "®": "(r)", "°": "deg", "±": "+-", "´": "'", "·": "*", "¼": "1/4", "½": "1/2", "¾": "3/4", "×": "x", "÷": "/",
    "–": "-", "—": "--", "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": ",,", "•": "*", "…": "...",
    "‹": "<", "›": ">", "€": "EUR",
}


# The usual romanisation of lower-case letters; capitals follow by rule.
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
    "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph",
    "χ": "kh", "ψ": "ps", "ω": "o",
}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh",
    "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia",
    "ё": "io", "є": "ie", "і": "i", "ї": "yi", "ґ": "g", "ў": "u", "ђ": "dj", "ј": "j", "љ": "lj", "њ": "nj",
    "ћ": "c", "џ": "dz", "ѓ": "gj", "ѕ": "dz", "ќ": "kj",
}
# Blocks of letters with a compatibility form, first and last code point: Latin and IPA, Greek, phonetic
# extensions to Greek extended, super- and subscripts, letter-like signs, Latin ligatures, full-width forms.
BLOCKS = (
    (0x00AA, 0x02B8), (0x0370, 0x03FF), (0x1D00, 0x1FFF), (0x2070, 0x209C), (0x2100, 0x214F), (0xFB00, 0xFB06),
    (0xFF01, 0xFF5E),
)
# Fixed value: the combining marks, which go.
MARKS = "".join(chr(point) for point in (*range(0x0300, 0x0370), *range(0x1AB0, 0x1AFF), *range(0x20D0, 0x20F1)))


def _capitals(letters: dict[str, str]) -> dict[str, str]:
    return letters | {k.upper(): v[:1].upper() + v[1:] for k, v in letters.items() if k.upper() != k}


def _bare(letter: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))


def _spelled() -> dict[str, str]:
    """Every letter and sign with its ASCII spelling: the tables, and by rule what decomposes into them."""
    known = {**_capitals(GREEK), **_capitals(CYRILLIC), **SPELLED}
    found = dict(known)
    for first, last in BLOCKS:
        for point in range(first, last + 1):
            letter = chr(point)
            bare = "".join(known.get(c, c) for c in _bare(letter))
            if letter not in known and bare and bare.isascii() and bare != letter and bare.strip():
                found[letter] = bare
    return found


def _decomposed_letters() -> dict[str, str]:
    """The letters that end as one ASCII letter."""
    return {k: v for k, v in _spelled().items() if len(v) == 1}


def _long_forms() -> dict[str, str]:
    return {k: v for k, v in _spelled().items() if len(v) > 1}


def _single_map() -> tuple[str, str]:
    """Letters and their single signs; the combining marks stand last, without a sign, and are deleted."""
    pairs = _decomposed_letters()
    return "".join(pairs) + MARKS, "".join(pairs.values())


def remove_accented_chars(text: Column) -> Column:
    source, target = _single_map()
    table = F.from_json(F.lit(json.dumps(_long_forms())), "map<string,string>")

    def spell(t: Column) -> Column:
        # The few words left are looked up letter by letter, in one pass.
        letters = F.transform(F.split(t, ""), lambda c: F.coalesce(F.element_at(table, c), c))
        return F.array_join(letters, "")

    def to_ascii(t: Column) -> Column:
        # One pass for the single letters; what is left needs the spelled forms, in few words.
        rest = lambda word: ~is_ascii(word)
        return let(
            F.translate(t, source, target), lambda u: F.when(is_ascii(u), u).otherwise(per_word(u, rest, spell))
        )

    # Plain ASCII text, the common case, skips the work.
    return let(text, lambda t: F.when(is_ascii(t), t).otherwise(to_ascii(t)))
