"""Payload codec: gzip has no built-in expression, so these two run on Arrow batches."""

from __future__ import annotations

import gzip
import sys
import zlib

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType, StringType

# The functions travel to the Python workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GZIP_MAGIC = b"\x1f\x8b"


@pandas_udf(BinaryType())
def encode_payload(text: pd.Series) -> pd.Series:
    """UTF-8, then gzip with a fixed time stamp: equal texts give equal payloads."""
    return text.map(lambda t: None if t is None else gzip.compress(t.encode("utf-8"), mtime=0))


def _decode(payload: bytes | None) -> str | None:
    if payload is None:
        return None
    data = bytes(payload)
    try:
        if data.startswith(GZIP_MAGIC):
            data = gzip.decompress(data)
        return data.decode("utf-8")
    except (OSError, EOFError, zlib.error, UnicodeDecodeError):
        return None


@pandas_udf(StringType())
def _decode_batch(payload: pd.Series) -> pd.Series:
    return payload.map(_decode)


def decode_payload(payload: Column | str) -> Column:
    """Text of a payload, gzipped or plain; NULL when it is damaged.

    Declared non-deterministic so that a filter on the text is not pushed below the decoding, which
    would decode every payload twice.
    """
    return _decode_batch.asNondeterministic()(payload)
