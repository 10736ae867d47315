"""The cleaning chain by words: each distinct word of a task is cleaned once and looked up afterwards.

After addresses of the web and markup are gone, every further step looks at single characters or stays between two
blanks, so a text is its cleaned words. Few words of a text are new, and most of these are plain letters, which need
their long form looked up and no pattern. The rows are those of ``text.clean_text``.
"""

from __future__ import annotations

import re
import string
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .accents import MARKS, _spelled
from .batches import in_slices
from .common import SPACE_CHARS, WORD_CLASS
from .contractions import APOSTROPHE_WORD, CONTRACTIONS, JOINED_WORD
from .html import _MARKUP, _SPACE_ENTITY, _entity_table
from .text import EMAIL_SHAPE, PUNCTUATION_PATTERN, URL_PATTERN

# The function travels to the Python workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words that are remembered at once, and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 100_000, 200

_URL = re.compile(URL_PATTERN.replace(WORD_CLASS, r"\w"))
_TAG = re.compile(_MARKUP)
_SPACES = re.compile(_SPACE_ENTITY)
_ENTITY = re.compile(r"&(?:#(0*+[0-9]{0,7})|#[xX](0*+[0-9A-Fa-f]{0,6})|([A-Za-z][A-Za-z0-9]{1,15}));")
_EMAIL = re.compile(EMAIL_SHAPE)
_LONG = re.compile(f"{APOSTROPHE_WORD}|{JOINED_WORD}")
_ASCII = str.maketrans({**dict.fromkeys(MARKS, ""), **_spelled(), "\t": " ", "\r": " ", "\n": " "})
_PUNCTUATION = str.maketrans("", "", string.punctuation)
_NAMED = _entity_table()
# Lower-case words that more than the marks have to go from.
_CONCERNED = rf"[^!-~]|['@&]|\b(?:{'|'.join(w for w in CONTRACTIONS if "'" not in w)})\b"


def _character(m: re.Match) -> str:
    if m[3] is not None:
        return _NAMED.get(m[3], m[0])
    digits, base = (m[1], 10) if m[1] is not None else (m[2], 16)
    point = int(digits, base) if digits else 0
    return chr(point) if 0 < point <= 0x10FFFF and not 0xD800 <= point < 0xE000 else m[0]


def clean_word(word: str) -> str:
    """All steps behind the markup on what stands between two blanks."""
    if word.isascii():
        if word.isalpha():
            low = word.lower()
            return CONTRACTIONS.get(low, low).translate(_PUNCTUATION)
        out = word
    else:
        out = word
    if "&" in out:
        out = _ENTITY.sub(_character, out)
    out = out.translate(_ASCII).encode("ascii", "ignore").decode("ascii").replace("?", "")
    if "@" in out:
        out = _EMAIL.sub("", out)
    return _LONG.sub(lambda m: CONTRACTIONS.get(m[0], m[0]), out.lower()).translate(_PUNCTUATION)


def without_addresses(text: str) -> str:
    """The text without addresses of the web, which are looked for in the words around a ``://`` only."""
    out, at, sign = [], 0, text.find("://")
    while sign >= 0:
        start = max(at, text.rfind(" ", at, sign) + 1)
        end = text.find(" ", sign)
        end = len(text) if end < 0 else end
        out += [text[at:start], _URL.sub("", text[start:end])]
        at, sign = end, text.find("://", end)
    return "".join([*out, text[at:]])


def visible_text(text: str) -> str:
    """The text without addresses of the web and markup; text nodes stripped and joined by one blank."""
    if "://" in text:
        text = without_addresses(text)
    if "&nbsp;" in text or "&#" in text:
        text = _SPACES.sub(" ", text)
    if "<" not in text:
        return text.strip(SPACE_CHARS)
    return " ".join(filter(None, (node.strip(SPACE_CHARS) for node in _TAG.split(text))))


class _Remembered(dict):
    """Words that are cleaned when they are first asked for."""

    def __missing__(self, word: str) -> str:
        out = clean_word(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = out
        return out


def clean_by_words(text: str | None, known: dict[str, str]) -> str | None:
    """One text; ``clean_batch`` is the form for many."""
    if text is None:
        return None
    out = " ".join(map(known.__getitem__, visible_text(text).split(" ")))
    while "  " in out:
        out = out.replace("  ", " ")
    return out


def clean_distinct(words: pa.Array, known: dict[str, str]) -> pa.Array:
    """Every word cleaned: those of ASCII letters and marks that no step but two concerns by kernels, the others one by one."""
    low = pc.ascii_lower(words)
    odd = pc.match_substring_regex(low, _CONCERNED)
    plain = pc.replace_substring_regex(low, PUNCTUATION_PATTERN, "")
    return pc.replace_with_mask(plain, odd, pa.array(map(known.__getitem__, words.filter(odd).to_pylist()), words.type))


def clean_batch(texts: pa.Array, known: dict[str, str]) -> pa.Array:
    """Many texts: cut, numbered, joined and freed of double blanks by kernels of Arrow, which know each word once."""
    visible = pa.array([None if t is None else visible_text(t) for t in texts.to_pylist()], pa.large_string())
    cut = pc.split_pattern(visible, " ")
    numbered = cut.flatten().dictionary_encode()
    cleaned = clean_distinct(numbered.dictionary, known)
    lengths = pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
    words = pa.ListArray.from_arrays(ends, cleaned.take(numbered.indices))
    joined = pc.binary_join(words, pa.scalar(" ", pa.large_string()))
    while pc.any(pc.match_substring(joined, "  ")).as_py():
        joined = pc.replace_substring(joined, "  ", " ")
    return pc.if_else(visible.is_valid(), joined, None).cast(pa.string())


def _known() -> _Remembered:
    """The words of this Python worker, kept from task to task."""
    return sys.modules.setdefault("_cleaned_words", _Remembered())


def _clean_batch(texts: pa.Array) -> pa.Array:
    return in_slices(lambda part: clean_batch(part, _known()))(texts)


clean_text_words = F.arrow_udf(_clean_batch, StringType())


def register_word_cleaning(spark: SparkSession, name: str = "clean_words_udf") -> None:
    """The chain under a SQL name."""
    spark.udf.register(name, clean_text_words)
