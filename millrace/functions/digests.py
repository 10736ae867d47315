"""Draws from the MD5 digests of many pairs of texts at once, in numpy: a lane of the arithmetic is a pair.

``md5`` as an expression makes objects for every row. Where rows are all pairs of a few texts, the steps of the digest
run over arrays of pairs, and what only one text of the pair decides is worked out once for that text.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle

# The functions travel to the Python workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pairs worked on at once: the arrays of a step stay in a core's cache.
TILE = 1 << 15

# The digest of RFC 1321: constants, turns and words of its steps, and the state it starts from.
CONSTANTS = [np.array([int(abs(math.sin(i + 1)) * 2**32)], np.uint32) for i in range(64)]
TURNS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
LEFT, RIGHT = ([np.array([s], np.uint32) for s in turns] for turns in (TURNS, [32 - s for s in TURNS]))
WORDS = [(m * i + k) % 16 for m, k in ((1, 0), (5, 1), (3, 5), (7, 0)) for i in range(16)]
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def pair_draws(left: list[bytes], right: list[bytes], n: int) -> np.ndarray:
    """For every left and right text, a whole number below ``n``, at most 256, from the first seven hex digits of
    ``md5(left:right)``."""
    out = np.empty((len(left), len(right)), np.uint8)
    right_lengths = np.array([len(t) for t in right], np.int64)
    for length, lines in _alike(len(t) for t in left):
        texts = np.frombuffer(b"".join(left[i] for i in lines), np.uint8).reshape(len(lines), length)
        for blocks, columns in _alike(((length + 1 + right_lengths + 8) // 64 + 1).tolist()):
            terms = _terms(_tails([right[j] for j in columns], length, blocks))
            step = max(1, TILE // len(columns))
            for at in range(0, len(lines), step):
                heads = np.zeros((min(step, len(lines) - at), 64 * blocks), np.uint8)
                heads[:, :length] = texts[at : at + step]
                digits = _first_words(heads.view("<u4"), terms, length, len(columns)).byteswap() >> np.uint32(4)
                out[np.ix_(lines[at : at + step], columns)] = digits - digits // np.uint32(n) * np.uint32(n)
    return out


def _alike(kinds) -> Iterator[tuple[int, np.ndarray]]:
    """Every kind with the places that have it."""
    kinds = np.fromiter(kinds, np.int64)
    for kind in np.unique(kinds).tolist():
        yield kind, np.flatnonzero(kinds == kind)


def _tails(texts: list[bytes], length: int, blocks: int) -> np.ndarray:
    """The message words of texts that follow ``length`` bytes and a colon, with the padding behind them."""
    lengths = np.array([len(t) for t in texts], np.int64)
    out = np.zeros((len(texts), 64 * blocks), np.uint8)
    out[:, length] = ord(":")
    starts = np.cumsum(lengths) - lengths
    rows = np.repeat(np.arange(len(texts)), lengths)
    out[rows, length + 1 + np.arange(len(rows)) - starts[rows]] = np.frombuffer(b"".join(texts), np.uint8)
    out[np.arange(len(texts)), length + 1 + lengths] = 0x80
    out.view("<u8")[:, -1] = 8 * (length + 1 + lengths)
    return out.view("<u4")


def _terms(tails: np.ndarray) -> list[list[np.ndarray]]:
    """What the tails' words and the constant add in every step of every block, one number where all tails add the same."""
    words = [tails[:1, w] if (tails[:, w] == tails[0, w]).all() else tails[:, w] for w in range(tails.shape[1])]
    return [[words[at + WORDS[i]] + CONSTANTS[i] for i in range(64)] for at in range(0, len(words), 16)]


def _first_words(heads: np.ndarray, terms: list[list[np.ndarray]], length: int, tails: int) -> np.ndarray:
    """The first word of the digest for every row of ``heads`` with every tail."""
    state = [np.full((len(heads), 1), v, np.uint32) for v in START]
    for block, added in enumerate(terms):
        head = [heads[:, w : w + 1] for w in range(16 * block, min(16 * block + 16, (length + 3) // 4))]
        own = min(max(length // 4 - 16 * block, 0), 16)  # until a tail's word comes in, a head has one lane
        now = [v.copy() for v in state]
        if own == 16:
            now = _steps(now, head, added, 0, 64)
        else:
            now = [np.repeat(v, tails, axis=1) if v.shape[1] < tails else v for v in _steps(now, head, added, 0, own)]
            if block == len(terms) - 1:  # the last three steps do not change the first word
                return _steps(now, head, added, own, 61)[1] + state[0]
            now = _steps(now, head, added, own, 64)
        state = [v + w for v, w in zip(now, state, strict=True)]
    raise AssertionError("padding follows every text")


def _steps(state: list[np.ndarray], head: list[np.ndarray], added: list[np.ndarray], first: int, last: int) -> list[np.ndarray]:
    """Steps of one block, in the arrays of ``state``."""
    a, b, c, d = state
    t, u = np.empty_like(a), np.empty_like(a)
    for i in range(first, last):
        if i < 16:
            np.bitwise_xor(c, d, out=t)
            t &= b
            t ^= d
        elif i < 32:
            np.bitwise_xor(b, c, out=t)
            t &= d
            t ^= c
        elif i < 48:
            np.bitwise_xor(b, c, out=t)
            t ^= d
        else:
            np.invert(d, out=t)
            t |= b
            t ^= c
        a += t
        word = WORDS[i]
        if word >= len(head):
            a += added[i]
        elif added[i].size == 1:
            a += head[word] + added[i]
        else:
            a += head[word]
            a += added[i]
        np.left_shift(a, LEFT[i], out=t)
        np.right_shift(a, RIGHT[i], out=u)
        t |= u
        t += b
        a, b, c, d, t = d, t, b, c, a
    return [a, b, c, d]
