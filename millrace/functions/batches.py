"""Arrow functions over slices of a batch, so that a worker holds the objects of few texts at a time.

Spark bounds a batch by its rows, 10,000 of them, and not by their bytes. What a function makes on its way (Python
strings, lists of words, copies) takes many times the bytes of its texts.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# The functions travel to the Python workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of texts that are worked on at once.
SLICE_BYTES = 4 << 20


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Stretches of about ``limit`` bytes, none larger but for a single text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 8)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield texts.slice(at, end - at)
        at = end


def in_slices(function: Callable[[pa.Array], pa.Array]) -> Callable[[pa.Array], pa.Array]:
    """The function of texts to texts, applied slice by slice."""

    def run(texts: pa.Array) -> pa.Array:
        parts = [function(part) for part in slices(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return run
