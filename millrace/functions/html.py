"""Visible text of HTML as a column expression."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import MARK, let, strip

# A quote opens a string only behind an equals sign. Every alternative starts at one literal character, so other positions cost next to nothing. Possessive
# groups run as loops in Java: a tag with thousands of attributes cannot overflow the stack.
_MARKUP = (
    r"(?s)<(?:"
    r"!--.*?-->"
    r"|(?i:script)\b[^>]*+>.*?</(?i:script)\s*>"
    r"|(?i:style)\b[^>]*+>.*?</(?i:style)\s*>"
    r"|(?i:template)\b[^>]*+>.*?</(?i:template)\s*>"
    r"|[!?][A-Za-z][^>]*+>"
    r"""|/?[A-Za-z](?:[^>=]++|=[ \t\r\n]*+(?:"[^"]*+"|'[^']*+')?)*+>"""
    r")"
)
_SPACE_ENTITY = r"&(?:nbsp|#0*160|#[xX]0*[aA]0);"


def _entity_table() -> dict[str, str]:
    """The HTML 4 names from the standard library, plus the apostrophe."""
    return {**{name: chr(point) for name, point in name2codepoint.items()}, "apos": "'"}


def _entity_map() -> Column:
    # A constant: Catalyst folds it into one literal map.
    return F.from_json(F.lit(json.dumps(_entity_table())), "map<string,string>")


def _code_point(head: Column) -> Column:
    digits = F.regexp_replace(F.substring(head, 3, 1_000_000), "^([xX]?)0+", "$1")
    return (
        F.when(digits.rlike(r"^[0-9]{1,7}$"), digits.try_cast("int"))
        .when(digits.rlike(r"^[xX][0-9A-Fa-f]{1,6}$"), F.conv(F.substring(digits, 2, 6), 16, 10).try_cast("int"))
    )


def _char(point: Column) -> Column:
    valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))


_ENTITY = r"(&(?:#0*+[0-9]{0,7}|#[xX]0*+[0-9A-Fa-f]{0,6}|[A-Za-z][A-Za-z0-9]{1,15});)"


def _decode_piece(piece: Column) -> Column:
    """The character of a piece that is an entity; any other piece as it is."""
    head = F.substring_index(piece, ";", 1)
    named = F.element_at(_entity_map(), F.substring(head, 2, 16))
    char = F.when(piece.startswith("&#"), _char(_code_point(head))).otherwise(named)
    is_entity = piece.startswith("&") & piece.endswith(";")
    return F.when(is_entity, F.coalesce(char, piece)).otherwise(piece)


def decode_entities(text: Column) -> Column:
    """Named and numeric entities, each decoded once: ``&amp;lt;`` ends as ``&lt;``."""

    def decode(t: Column) -> Column:
        pieces = F.split(F.regexp_replace(t, _ENTITY, f"{MARK}$1{MARK}"), MARK)
        return F.when(t.contains("&"), F.array_join(F.transform(pieces, _decode_piece), "")).otherwise(t)

    return let(text, decode)


def remove_html(text: Column) -> Column:
    """Text nodes without scripts, styles and comments: stripped, joined by one space, entities decoded."""

    def visible(t: Column) -> Column:
        # A space entity at the edge of a node is stripped like a space.
        maybe = t.contains("&nbsp;") | t.contains("&#")
        spaced = F.when(maybe, F.regexp_replace(t, _SPACE_ENTITY, "\u00a0")).otherwise(t)
        nodes = F.filter(F.transform(F.split(spaced, _MARKUP), strip), lambda node: node != "")
        return F.when(t.contains("<"), F.array_join(nodes, " ")).otherwise(strip(spaced))

    return decode_entities(let(text, visible))
