"""Periodic runs of words by multi-scale minimizers.

A run is a maximal stretch of words with smallest period q that is at least three periods, and 24 words, long. The
texts of a slice of rows are laid behind each other with a word of its own after each, so that all are searched by the
same numpy steps and no run leaves its text.

Periods up to ``LAGS`` are found by comparing the words with themselves so many places on. Longer ones are found by
scales of growing ratio 1.5: a scale with windows of W words is for the periods from ``low`` to W. The hash of W words
tells the phase within a run whose period is W at most, so equal hashes inside are exactly one period apart. Of the
hashes only the minima of ``2 * low - W + 1`` neighbours are kept; a run of three periods holds two such neighbourhoods
one period apart, alike, and so keeps both of a pair at least. A pair of neighbouring equal minimizers at a distance
that belongs to the scale is a seed; it is extended word by word on both sides, in blocks of doubling size, and
counts if the stretch is long enough. A stretch found with several periods has the smallest.

Defined cases: a null or empty text has no words and no runs. Equal rows give equal results; extra columns are ignored;
an empty table gives an empty result. A text of any length is searched whole, in time about words x scales.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, documents, scan, words
from .hashing import BASE, mix

by_value(__name__)

# Periods that are searched by direct comparison.
LAGS = 16
LEAST_WORDS = 24
LEAST_PERIODS = 3


@dataclass(frozen=True)
class Scale:
    """Windows of ``width`` words, minima over ``reach`` of them, for the periods from ``low`` to ``width``."""

    low: int
    width: int

    @property
    def reach(self) -> int:
        return 2 * self.low - self.width + 1


def scales(longest: int) -> list[Scale]:
    """The scales for texts of so many words at most."""
    out, below = [], LAGS
    while (below + 1) * LEAST_PERIODS <= longest:
        width = below + below // 2
        out.append(Scale(below + 1, width))
        below = width
    return out


def least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_PERIODS * period)


def window_extremes(values: np.ndarray, reach: int, pick: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``reach`` neighbours, by doubling."""
    out, have = values, 1
    while have < reach:
        step = min(have, reach - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def window_hashes(ids: np.ndarray, width: int, sums: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Hash of every ``width`` words from running sums of a polynomial: lifted to one power, so equal words agree."""
    n = len(ids) - width + 1
    return mix((sums[width : width + n] - sums[:n]) * power[len(ids) - np.arange(n)])


def minimizers(hashes: np.ndarray, reach: int) -> np.ndarray:
    """Places whose hash is the least of some ``reach`` neighbours."""
    if len(hashes) < reach:
        return np.zeros(0, dtype=np.int64)
    least = window_extremes(hashes, reach, np.minimum)
    pad = np.zeros(reach - 1, dtype=hashes.dtype)
    most = window_extremes(np.concatenate([pad, least, pad]), reach, np.maximum)
    return np.flatnonzero(most == hashes)


def seeds(ids: np.ndarray, scale: Scale, sums: np.ndarray, power: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of neighbouring equal minimizers that are a period of this scale apart."""
    if len(ids) < scale.width:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    hashes = window_hashes(ids, scale.width, sums, power)
    at = minimizers(hashes, scale.reach)
    at = at[np.argsort(hashes[at], kind="stable")]
    gap = np.diff(at)
    hit = (hashes[at[1:]] == hashes[at[:-1]]) & (gap >= scale.low) & (gap <= scale.width)
    return at[:-1][hit], gap[hit]


def stretch_end(same_from: np.ndarray, same_to: np.ndarray) -> int:
    """How many values agree from the start, compared in blocks of doubling size."""
    n, at, block = min(len(same_from), len(same_to)), 0, 32
    while at < n:
        end = min(n, at + block)
        differ = same_from[at:end] != same_to[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, block = end, 2 * block
    return n


def extend(ids: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around a place in which words one period apart are alike: start and end."""
    right = stretch_end(ids[at:], ids[at + period :])
    left = stretch_end(ids[:at][::-1], ids[: at + period][::-1])
    return at - left, at + right + period


def lag_runs(ids: np.ndarray, period: int) -> list[tuple[int, int, int]]:
    """All stretches of one period that are long enough, by direct comparison."""
    if len(ids) <= period:
        return []
    same = np.zeros(len(ids) - period + 2, dtype=np.int8)
    same[1:-1] = ids[:-period] == ids[period:]
    edges = np.diff(same)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + period
    keep = ends - starts >= least_length(period)
    return [(int(s), int(e), period) for s, e in zip(starts[keep], ends[keep])]


def scale_runs(ids: np.ndarray, scale: Scale, sums: np.ndarray, power: np.ndarray) -> list[tuple[int, int, int]]:
    """All stretches of the periods of one scale that are long enough."""
    at, gap = seeds(ids, scale, sums, power)
    order = np.lexsort((at, gap))
    out, last, end = [], 0, 0
    for place, period in zip(at[order].tolist(), gap[order].tolist()):
        if period == last and place + period < end:
            continue  # inside the stretch that the seed before has found
        start, end = extend(ids, place, period)
        last = period
        if end - start >= least_length(period):
            out.append((start, end, period))
    return out


def runs_of_texts(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Start, length and period of the runs of every text, given as numbered words, by start and then period."""
    found: list[list] = [[] for _ in texts]
    order = sorted((i for i, t in enumerate(texts) if len(t) >= LEAST_WORDS), key=lambda i: len(texts[i]))
    if not order:
        return found
    own = 1 + max(int(texts[i].max()) for i in order)
    joined, begins, at = [], [], 0
    for k, i in enumerate(order):
        begins.append(at)
        joined += [texts[i], np.array([own + k])]
        at += len(texts[i]) + 1
    ids, begins = np.concatenate(joined), np.array(begins)
    lengths = np.array([len(texts[i]) for i in order])
    with np.errstate(over="ignore"):
        power = np.cumprod(np.r_[np.uint64(1), np.full(len(ids), BASE, dtype=np.uint64)])
        terms = mix(ids.astype(np.uint64) * np.uint64(BASE)) * power[:-1]
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms)])
        every = [run for period in range(1, LAGS + 1) for run in lag_runs(ids, period)]
        for scale in scales(int(lengths[-1])):
            first = int(np.searchsorted(lengths, LEAST_PERIODS * scale.low))
            cut = int(begins[first])  # the texts are in order of length: those behind are long enough for the scale
            part = scale_runs(ids[cut:], scale, sums[cut:], power[: len(ids) - cut + 1])
            every += [(start + cut, end + cut, period) for start, end, period in part]
    smallest: dict[tuple[int, int], int] = {}
    for start, end, period in every:
        smallest[start, end] = min(period, smallest.get((start, end), period))
    for (start, end), period in smallest.items():
        k = int(np.searchsorted(begins, start, side="right")) - 1
        found[order[k]].append((start - int(begins[k]), end - start, period))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; of equal ones that which starts first, then that of the smaller period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run shrinks to its first period."""
    keep = np.ones(n, dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return keep


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """For one document in ten, by the checksum of its id, which word stands where: a repeated stretch to its end.

    None where the words stay as they are; so for a null id.
    """
    if n == 0 or doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % period
    return places


def hexdigest(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


ADDED = {
    "n_words": "long", "n_runs": "long", "start": "long", "length": "long", "period": "long", "exponent_milli": "long",
    "runs": "array<array<long>>", "runs_sha256": "string", "collapsed": "string", "collapsed_sha256": "string",
}


def find_runs(
    docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text", plant: bool = False
) -> DataFrame:
    """Per document its id and the ``columns`` asked for, out of ``ADDED``.

    ``runs``: start, length and period of each; ``start`` to ``exponent_milli``: of the strongest; ``collapsed``: the
    words joined by blanks, every run cut to its first period. ``plant`` first puts repeats into one text in ten.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))

    def start():
        def work(read: dict) -> dict:
            out = {c: [] for c in ADDED}
            numbers: dict[bytes, int] = {}
            texts, found = [], []
            for doc_id, body in zip(read["id"], read["body"]):
                own = words(body)
                ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int64, len(own))
                places = planted(len(own), doc_id) if plant else None
                if places is not None:
                    ids, own = ids[places], [own[i] for i in places.tolist()]
                texts.append(ids)
                found.append(own)
            for own, runs in zip(found, runs_of_texts(texts)):
                keep = kept_words(len(own), runs)
                collapsed = b" ".join([w for w, k in zip(own, keep.tolist()) if k] if runs else own)
                best = strongest(runs)
                values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                listed = b"".join(b"%d,%d,%d\n" % run for run in runs)
                row = (len(own), len(runs), *values, runs, hexdigest(listed),
                       collapsed.decode("utf-8", "replace"), hexdigest(collapsed))
                for column, value in zip(out.values(), row):
                    column.append(value)
            return {c: out[c] for c in columns}

        return work

    return scan(rows, ["id"], {c: ADDED[c] for c in columns}, start).withColumnRenamed("id", id_col)


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, runs and the text with every run cut to its first period."""
    return find_runs(docs, ["runs", "collapsed"], id_col, text_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return find_runs(documents(spark, sf_dir), columns, plant=True)
