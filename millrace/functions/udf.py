"""The Python UDF surface: functions over Arrow batches for what has no expression, and the cleaning chain in plain
Python, which tests and the benchmark compare the expressions with."""

from __future__ import annotations

import html
import re
import string
import sys
import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .accents import MARKS, _spelled
from .batches import in_slices
from .common import WORD_CLASS
from .contractions import APOSTROPHE_WORD, CONTRACTIONS, JOINED_WORD
from .text import EMAIL_SHAPE, URL_PATTERN

# The functions travel to the Python workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_URL = re.compile(URL_PATTERN.replace(WORD_CLASS, r"\w"))
_MARKUP = re.compile(
    r"<!--.*?-->|<(?:script|style|template)\b[^>]*>.*?</(?:script|style|template)\s*>"
    r"""|<[!?][A-Za-z][^>]*>|</?[A-Za-z](?:[^>=]|=[ \t\r\n]*(?:"[^"]*"|'[^']*')?)*+>""",
    re.DOTALL | re.IGNORECASE,
)
_EMAIL = re.compile(EMAIL_SHAPE)
_ENTITY = re.compile(r"&(?:#0*[0-9]{1,7}|#[xX]0*[0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,15});")
_WORD = re.compile(f"{APOSTROPHE_WORD}|{JOINED_WORD}")
_ASCII = str.maketrans({**dict.fromkeys(MARKS, ""), **_spelled(), "\t": " ", "\r": " ", "\n": " "})
_PUNCTUATION = str.maketrans("", "", string.punctuation)


def clean_text_python(text: str | None) -> str | None:
    """All cleaning steps on one text."""
    if text is None:
        return None
    nodes = (node.strip() for node in _MARKUP.split(_URL.sub("", text)))
    visible = " ".join(node for node in nodes if node)
    out = _ENTITY.sub(lambda m: html.unescape(m[0]), visible).translate(_ASCII)
    out = out.encode("ascii", "ignore").decode("ascii").replace("?", "")
    out = _EMAIL.sub("", out).lower()
    out = _WORD.sub(lambda m: CONTRACTIONS.get(m[0], m[0]), out).translate(_PUNCTUATION)
    return re.sub(" +", " ", out)


@F.pandas_udf(StringType())
def clean_text_arrow(texts: pd.Series) -> pd.Series:
    return texts.map(clean_text_python)


clean_text_row_udf = F.udf(clean_text_python, StringType(), useArrow=False)


def _compose(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())


def _compose_batch(texts: pa.Array) -> pa.Array:
    """Unicode normal form C: letters and the marks behind them become single code points."""
    return in_slices(_compose)(texts)


compose_text = F.arrow_udf(_compose_batch, StringType())


def register_python_udfs(spark: SparkSession) -> None:
    """The Python function under a SQL name, on Arrow batches."""
    spark.udf.register("py_compose", compose_text)
