"""The text functions under SQL names, as SQL functions: their bodies are inlined into the plan,
so nested calls in SQL text run without a Python worker."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .accents import _long_forms, _single_map
from .common import MARK, SPACE_CHARS, SPACE_CLASS
from .contractions import APOSTROPHE_WORD, CONTRACTIONS, JOINED_WORD
from .html import _MARKUP, _SPACE_ENTITY, _entity_table
from .text import CLEAN_STEPS, DIGIT_PATTERN, EMAIL_PATTERN, NOT_ASCII_PATTERN, PUNCTUATION_PATTERN, URL_PATTERN


def _quoted(text: str) -> str:
    """A SQL string literal."""
    escapes = {"\\": "\\\\", "'": "\\'", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
    return "'" + "".join(escapes.get(c, c) for c in text) + "'"


def _map(pairs: dict[str, str]) -> str:
    return "map(" + ", ".join(f"{_quoted(k)}, {_quoted(v)}" for k, v in pairs.items()) + ")"


def _swap(text: str, pattern: str, replacement: str = "") -> str:
    return f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(replacement)})"


def _accents(text: str) -> str:
    source, target = _single_map()
    body = f"translate({text}, {_quoted(source)}, {_quoted(target)})"
    letters = f"transform(split(w, ''), c -> coalesce(element_at({_map(_long_forms())}, c), c))"
    spelled = f"CASE WHEN octet_length(w) > char_length(w) THEN array_join({letters}, '') ELSE w END"
    body = f"array_join(transform(split({body}, ' '), w -> {spelled}), ' ')"
    return f"CASE WHEN octet_length({text}) > char_length({text}) THEN {body} ELSE {text} END"


def _per_word(text: str, sign: str, change: str) -> str:
    """``change`` is an expression over the word ``x``."""
    words = f"transform(split({text}, ' '), x -> CASE WHEN contains(x, {_quoted(sign)}) THEN {change} ELSE x END)"
    return f"array_join({words}, ' ')"


def _known_words(text: str, pattern: str) -> str:
    full = f"element_at({_map(CONTRACTIONS)}, lower(w))"
    word = (
        f"coalesce(CASE WHEN w RLIKE '^[A-Z]' THEN concat(upper(substr({full}, 1, 1)), substr({full}, 2)) "
        f"ELSE {full} END, w)"
    )
    marked = _swap(text, pattern, f"{MARK}$1{MARK}")
    return f"array_join(transform(split({marked}, {_quoted(MARK)}), w -> {word}), '')"


def _entities(text: str) -> str:
    head = "substring_index(p, ';', 1)"
    rest = f"substr(p, length({head}) + 2)"
    named = f"element_at({_map(_entity_table())}, substr({head}, 2))"

    def numbered(shape: str, point: str) -> str:
        char = f"decode(unhex(lpad(hex({point}), 8, '0')), 'UTF-32')"
        valid = f"{point} BETWEEN 1 AND 1114111 AND NOT {point} BETWEEN 55296 AND 57343"
        return f"WHEN {head} RLIKE {_quoted(shape)} AND {valid} THEN concat({char}, {rest})"

    decimal = numbered(r"^&#0*+[0-9]{0,7}$", f"try_cast(substr({head}, 3) AS INT)")
    hexa = numbered(r"^&#[xX]0*+[0-9A-Fa-f]{0,6}$", f"try_cast(conv(substr({head}, 4), 16, 10) AS INT)")
    piece = (
        f"CASE WHEN NOT startswith(p, '&') OR length({head}) = length(p) THEN p "
        f"WHEN {named} IS NOT NULL THEN concat({named}, {rest}) {decimal} {hexa} ELSE p END"
    )
    return f"array_join(transform(split({text}, '(?=&)'), p -> {piece}), '')"


def _visible(text: str) -> str:
    edges = _quoted(SPACE_CHARS)
    spaced = _swap(text, _SPACE_ENTITY, "\u00a0")
    nodes = f"transform(split({spaced}, {_quoted(_MARKUP)}), n -> trim(BOTH {edges} FROM n))"
    return f"array_join(filter({nodes}, n -> n <> ''), ' ')"


def _words_with(sign: str) -> str:
    return f"filter(split(t, ' '), x -> contains(x, '{sign}'))"


def _tokens(sign: str) -> str:
    parts = f"transform({_words_with(sign)}, x -> split(x, {_quoted(f'[{SPACE_CLASS}]+')}))"
    return f"filter(flatten({parts}), x -> startswith(x, '{sign}'))"


def sql_bodies() -> dict[str, tuple[str, str]]:
    """Name to (result type, body over the parameter ``t``)."""
    text = {
        "remove_html": _entities(_visible("t")),
        "remove_accented_chars": _accents("t"),
        "remove_tabs": r"replace(replace(replace(t, '\t', ' '), '\r', ' '), '\n', ' ')",
        "remove_blanks": _swap("t", " {2,}", " "),
        "remove_digits": _swap("t", DIGIT_PATTERN),
        "remove_all_punctuation": _swap("t", PUNCTUATION_PATTERN),
        "remove_special_characters": _swap("t", f"[^a-zA-z0-9{SPACE_CLASS}]"),
        "ascii_to_string": _swap("t", NOT_ASCII_PATTERN),
        "to_lower": "lower(t)",
        "remove_url": _swap("t", URL_PATTERN),
        "remove_email_address": _per_word("t", "@", _swap("x", EMAIL_PATTERN)),
        "expand_contractions": _known_words(_per_word("t", "'", _known_words("x", APOSTROPHE_WORD)), JOINED_WORD),
    }
    lists = {
        "get_email_address": f"flatten(transform({_words_with('@')}, x -> regexp_extract_all(x, {_quoted(EMAIL_PATTERN)}, 1)))",
        "get_hashtag": _tokens("#"),
        "get_mention": _tokens("@"),
    }
    chain = "t"
    for step in CLEAN_STEPS:
        chain = f"{step.__name__}_udf({chain})"
    return {
        **{f"{name}_udf": ("STRING", body) for name, body in text.items()},
        **{f"{name}_udf": ("ARRAY<STRING>", body) for name, body in lists.items()},
        "apply_all_udf": ("STRING", chain),
    }


def register_sql_functions(spark: SparkSession, names: list[str] | None = None) -> None:
    """The functions asked for, or all: each body is analysed when it is registered, which takes its time for the chain."""
    bodies = sql_bodies()
    for name in names or bodies:
        kind, body = bodies[name]
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS {kind} RETURN {body}")
