"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes that mean the same in Java and in RE2.
SPACE_CLASS = r"\t-\r\x1c-\x1f\x85\p{Z}"
WORD_CLASS = r"\p{L}\p{N}_"
# A code point that Unicode reserves as no character: marks places inside a text while it is worked on.
MARK = "\uffff"
# The same white space as single characters, for trimming.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    Without it a nested chain of functions repeats its argument at every step and the expression
    tree grows exponentially.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def per_word(text: Column, concerns: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """Apply ``change`` to the words, cut at single spaces, that ``concerns`` picks; all else stays as it is.

    For a change that never looks across a space this equals ``change(text)``, but a pattern that
    would be tried at every character runs on the few words that can contain it.
    """
    words = F.transform(F.split(text, " "), lambda w: F.when(concerns(w), change(w)).otherwise(w))
    return F.array_join(words, " ")


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def strip(text: Column) -> Column:
    """White space off both ends."""
    return F.trim(text, F.lit(SPACE_CHARS))


def null_as_text(text: Column) -> Column:
    """Legacy behaviour: a missing text becomes the four letters NULL."""
    return F.coalesce(text, F.lit("NULL"))
