"""64-bit hashes of all words of a text at once, in numpy."""

from __future__ import annotations

import numpy as np

from .common import BLANKS, by_value

by_value(__name__)

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
BLOCK = 1 << 20
# Texts are hashed together up to so many bytes: a call on a short one costs more than its bytes.
TOGETHER = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all others (the finisher of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHasher:
    """Hash of every word: the polynomial of its bytes, from differences of one running sum over the text.

    ``lower`` folds A to Z first; ``blanks`` are the bytes between words. With ``prefixes`` a word has a row of hashes:
    its own, and one for each prefix of so many bytes, 0 where the word is shorter. Long texts are taken in blocks that end
    between words.
    """

    def __init__(self, lower: bool = True, blanks: bytes = BLANKS.encode(), prefixes: tuple[int, ...] = ()):
        self.prefixes = prefixes
        # bytes translate themselves many times faster than numpy looks them up
        self.folded = bytes(b + 32 if lower and 65 <= b < 91 else b for b in range(256))
        self.solid = bytes(b not in blanks for b in range(256))
        self.between = blanks[:1]
        self.power = np.ones(1, dtype=np.uint64)
        self.inverse = self.power

    def _grow(self, n: int) -> None:
        if n > len(self.power):
            n = max(n, 2 * len(self.power))
            with np.errstate(over="ignore"):
                self.power = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, BASE, dtype=np.uint64)])
                self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(BASE, -1, 1 << 64), dtype=np.uint64)])

    def __call__(self, raw: bytes) -> np.ndarray:
        return self.spans(raw)[0]

    def each(self, raws: list[bytes]) -> list[np.ndarray]:
        """Hashes of the words of every text."""
        out, at = [], 0
        sizes = np.cumsum([0, *[len(raw) + 1 for raw in raws]])
        while at < len(raws):
            end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + TOGETHER, side="right")) - 1)
            hashes, starts, _ = self.spans(self.between.join(raws[at:end]))
            bounds = np.searchsorted(starts, sizes[at : end + 1] - sizes[at]).tolist()
            out.extend(hashes[a:b] for a, b in zip(bounds, bounds[1:]))
            at = end
        return out

    def spans(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and end of every word."""
        whole = np.frombuffer(raw.translate(self.folded), dtype=np.uint8)
        solid = np.frombuffer(raw.translate(self.solid), dtype=np.int8)
        if len(whole) <= BLOCK:
            return self._block(whole, solid)
        gaps = np.flatnonzero(solid == 0)
        parts, at = [], 0
        while at < len(whole):
            k = np.searchsorted(gaps, at + BLOCK)
            end = int(gaps[k]) + 1 if k < len(gaps) else len(whole)
            hashes, starts, ends = self._block(whole[at:end], solid[at:end])
            parts.append((hashes, starts + at, ends + at))
            at = end
        return tuple(np.concatenate(column) for column in zip(*parts))

    def _block(self, a: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        edged = np.zeros(len(a) + 2, dtype=np.int8)
        edged[1:-1] = solid
        edges = np.flatnonzero(edged[1:] != edged[:-1])
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.zeros((0, 1 + len(self.prefixes)) if self.prefixes else 0, dtype=np.uint64), starts, ends
        self._grow(len(a))
        sums = np.zeros(len(a) + 1, dtype=np.uint64)
        powers = a.astype(np.uint64)
        powers += np.uint64(1)
        powers *= self.power[: len(a)]
        np.cumsum(powers, out=sums[1:])
        inverse, lengths = self.inverse[starts], ends - starts
        own = mix((sums[ends] - sums[starts]) * inverse + lengths.astype(np.uint64))
        if not self.prefixes:
            return own, starts, ends
        columns = [own]
        for n in self.prefixes:
            part = mix((sums[np.minimum(starts + n, ends)] - sums[starts]) * inverse + np.uint64(n << 32))
            columns.append(np.where(lengths >= n, part, np.uint64(0)))
        return np.column_stack(columns), starts, ends


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if it is shorter; sorted and distinct."""
    n = min(size, len(hashes))
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    out = np.full(len(hashes) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(BASE) + hashes[i : len(hashes) - n + 1 + i]
    return np.unique(mix(out).view(np.int64))
