"""Text cleaning as column expressions. NULL stays NULL unless ``null_sentinel`` asks for the legacy text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .accents import remove_accented_chars
from .common import SPACE_CLASS, WORD_CLASS, let, null_as_text, per_word
from .contractions import expand_apostrophes, expand_contractions, expand_joined, has_apostrophe
from .html import remove_html

# The schemes, the address shape and the digit groups that count.
URL_PATTERN = (
    r"(?=[hfsw])(?:http|https|ftp|ssh|sftp|www)://"
    rf"[{WORD_CLASS}-]++(?:\.[{WORD_CLASS}-]++)++"
    rf"(?:[{WORD_CLASS}.,@?^=%&:/~+#-]*[{WORD_CLASS}@?^=%&/~+#-])?"
)
# An address is looked for only at the start of a run of its characters (or right behind the last
# match), which keeps a long run without an at-sign linear.
EMAIL_SHAPE = r"[a-z0-9+._-]++@[a-z0-9+._-]+\.[a-z0-9+_-]+"
EMAIL_PATTERN = rf"((?:(?<![a-z0-9+._-])|\G){EMAIL_SHAPE})"
PUNCTUATION_PATTERN = r"[!-/:-@\[-`{-~]"
NOT_ASCII_PATTERN = r"[?\x80-\x{10FFFF}]"
DIGIT_PATTERN = r"\p{Nd}[./:-]\p{Nd}|\p{Nd}"


def remove_tabs(text: Column) -> Column:
    """Tab, carriage return and line feed become one space each."""
    for sign in "\t\r\n":
        text = F.replace(text, F.lit(sign), F.lit(" "))
    return text


def remove_blanks(text: Column) -> Column:
    """Runs of spaces become one; the ends are kept."""
    return F.regexp_replace(text, " {2,}", " ")


def remove_digits(text: Column) -> Column:
    return F.regexp_replace(text, DIGIT_PATTERN, "")


def remove_all_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION_PATTERN, "")


def ascii_to_string(text: Column) -> Column:
    """Keep ASCII; genuine question marks go as well."""
    return F.regexp_replace(text, NOT_ASCII_PATTERN, "")


def remove_special_characters(text: Column, remove_digits: bool = False, strict: bool = False) -> Column:
    """Keep letters, white space and (by default) digits. The legacy range ``A-z`` also keeps
    ``[ \\ ] ^ _ ` ``; ``strict`` closes that gap."""
    upper = "A-Z" if strict else "A-z"
    digits = "" if remove_digits else "0-9"
    return F.regexp_replace(text, rf"[^a-z{upper}{digits}{SPACE_CLASS}]", "")


def to_lower(text: Column) -> Column:
    return F.lower(text)


def remove_url(text: Column) -> Column:
    """``www`` counts only when ``://`` follows; a bare ``www.host`` stays."""
    return F.regexp_replace(text, URL_PATTERN, "")


def _email_pattern(ignore_case: bool) -> str:
    return f"(?i){EMAIL_PATTERN}" if ignore_case else EMAIL_PATTERN


def _has_at(text: Column) -> Column:
    return text.contains("@")


def remove_email_address(text: Column, ignore_case: bool = False) -> Column:
    def remove(word: Column) -> Column:
        return F.regexp_replace(word, _email_pattern(ignore_case), "")

    return let(text, lambda t: F.when(_has_at(t), per_word(t, _has_at, remove)).otherwise(t))


def _words_with(text: Column, sign: str) -> Column:
    return F.filter(F.split(text, " "), lambda word: word.contains(sign))


def get_email_address(text: Column, ignore_case: bool = False) -> Column:
    pattern = F.lit(_email_pattern(ignore_case))
    found = F.transform(_words_with(text, "@"), lambda word: F.regexp_extract_all(word, pattern, F.lit(1)))
    return F.flatten(found)


def _tokens_starting(text: Column, sign: str) -> Column:
    """Tokens between white space of any kind; only the parts around ``sign`` are looked at closely."""
    parts = F.transform(_words_with(text, sign), lambda word: F.split(word, rf"[{SPACE_CLASS}]+"))
    return F.filter(F.flatten(parts), lambda token: token.startswith(sign))


def get_hashtag(text: Column) -> Column:
    return _tokens_starting(text, "#")


def get_mention(text: Column) -> Column:
    return _tokens_starting(text, "@")


def array_as_text(items: Column) -> Column:
    """The legacy rendering of a list column: ``[#a, #b]``."""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def clean_two_step(text: Column) -> Column:
    return remove_accented_chars(remove_html(text))


# Fixed order of the cleaning steps.
CLEAN_STEPS = (
    remove_url, remove_html, remove_accented_chars, remove_tabs, ascii_to_string, remove_email_address,
    to_lower, expand_contractions, remove_all_punctuation, remove_tabs, remove_blanks,
)


def _email_lower_contractions(text: Column) -> Column:
    """Three steps with one pass over the words: addresses and apostrophes sit in few of them."""

    def concerned(word: Column) -> Column:
        return _has_at(word) | has_apostrophe(word)

    def change(word: Column) -> Column:
        return expand_apostrophes(F.lower(F.regexp_replace(word, EMAIL_PATTERN, "")))

    changed = let(text, lambda t: F.when(concerned(t), per_word(t, concerned, change)).otherwise(t))
    return expand_joined(F.lower(changed))


# The same steps with the word-wise ones taken together.
_FUSED = {remove_email_address: _email_lower_contractions, to_lower: None, expand_contractions: None}


def clean_text(text: Column, null_sentinel: bool = False) -> Column:
    """All steps in order. Every step is a plain expression, so modular and fused form are one plan."""
    out = null_as_text(text) if null_sentinel else text
    for step in CLEAN_STEPS:
        step = _FUSED.get(step, step)
        out = out if step is None else step(out)
    return out


def contains_any_phrase(text: Column, phrases: list[str]) -> Column:
    """Keyword tracking: true when one of the phrases occurs, whatever its case."""
    lowered = [phrase.lower() for phrase in dict.fromkeys(phrases)]
    folded = F.lower(text)
    hit = F.lit(False)
    for phrase in lowered:
        hit = hit | folded.contains(phrase)
    return hit
