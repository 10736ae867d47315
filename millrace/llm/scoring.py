"""Language-model scores by masked pseudo-likelihood.

A small network predicts every word from the two words on either side; a document's score is the sum of the
conditional log-probabilities of all its words. All words of the corpus are counted. The most frequent ones have own
codes, the more the more distinct words there are; all others share codes by hash, and the probability of such a word is
that of its code times its share of the code's counts, with one count in each code kept for all words never seen. A code
has two digits, predicted one after the other, so the cost of a word grows slowly with the codes.

The network is trained in numpy where the data are: every word of every document is a training example in every round,
each task trains on its own examples, and the tasks' weights are averaged in a tree of bounded groups, ``rounds`` times.

Defined cases: a null or empty text, or one without words, has no words, score 0 and no mean. Repeated rows get equal
scores; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import ceil, isqrt, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Scratch, by_value, documents, scan, utf8
from .hashing import WordHasher

by_value(__name__)

SHIFTS = (-2, -1, 1, 2)
SIDE = 2
# Logarithms of counts are summed as whole numbers of this unit, so that no order of summing changes a score.
UNIT = 10**9


@dataclass(frozen=True)
class Options:
    """``digit``: codes per digit, and ``frequent``: words with an own code, both at least; ``hidden``: width of the network; ``stride``: 1
    trains on every word in every round, n on every n-th, another one in each round. Weights are averaged in slices of
    ``part``, ``group`` networks at once."""

    digit: int = 32
    frequent: int = 512
    hidden: int = 24
    stride: int = 1
    rounds: int = 2
    batch: int = 512
    rate: float = 0.1
    group: int = 32
    part: int = 1 << 16

    @property
    def codes(self) -> int:
        return self.digit * self.digit


def sized(options: Options, distinct: int) -> Options:
    """Options for so many distinct words: own codes grow with their square root, and as many codes are shared."""
    frequent = 2 * isqrt(distinct)
    if frequent <= options.frequent:
        return options
    return replace(options, frequent=frequent, digit=max(options.digit, ceil(sqrt(2 * frequent))))


class Vocabulary:
    """Word hash to code: the frequent words first, the rest by hash behind them. ``within``: for every code, the
    logarithm of its counts and the one kept for unseen words; 0 for own codes, which stand for one word."""

    def __init__(self, frequent: np.ndarray, options: Options, within: np.ndarray | None = None):
        self.within = np.zeros(options.codes) if within is None else within
        self.order = np.argsort(frequent)
        self.sorted = frequent[self.order]
        self.shared = options.codes - options.frequent
        self.first = options.frequent
        # where the frequent words with the same first bits begin; there are few of them, mostly none
        bits = len(frequent).bit_length() + 3
        self.drop = np.uint64(64 - bits)
        self.begin = np.searchsorted(self.sorted >> self.drop, np.arange((1 << bits) + 1, dtype=np.uint64))
        self.most = int(np.diff(self.begin).max())

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        shared = np.uint64(self.shared)
        out = self.first + (hashes - hashes // shared * shared).astype(np.int64)
        if not len(self.sorted):
            return out
        bits = (hashes >> self.drop).astype(np.intp)
        at, open_ = self.begin.take(bits), np.arange(len(hashes))
        for i in range(self.most):
            if i:
                open_ = open_[self.begin.take(bits[open_] + 1) > at[open_] + i]
            place = at.take(open_) + i if i else at
            found = np.flatnonzero(self.sorted.take(place, mode="clip") == hashes.take(open_))
            out[open_[found]] = self.order[place[found]]
        return out


def spread(hashes: list[np.ndarray], vocabulary: Vocabulary, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of several texts in one array with padding between them, and the places of the words."""
    lengths = [len(h) for h in hashes]
    codes = np.full(sum(lengths) + SIDE * (len(lengths) + 1), pad, dtype=np.int64)
    places = np.concatenate([np.zeros(0, np.int64), *[
        np.arange(n) + SIDE * (i + 1) + before for i, (n, before) in enumerate(zip(lengths, np.cumsum([0, *lengths])))
    ]])
    if len(places):
        codes[places] = vocabulary.codes(np.concatenate(hashes))
    return codes, places


class Network:
    """Two words on either side, one hidden layer, two softmax digits. All weights are one flat vector."""

    def __init__(self, options: Options, flat: np.ndarray | None = None):
        d, h, v = options.digit, options.hidden, options.codes
        self.shapes = [(len(SHIFTS), v + 1, h), (h,), (h, d), (d,), (h, d), (d, d)]
        self.digit, self.pad = d, v
        sizes = [int(np.prod(s)) for s in self.shapes]
        if flat is None:
            flat = np.random.default_rng(5).normal(0, 0.1, sum(sizes)).astype(np.float32)
        self.flat = flat
        parts = np.split(self.flat, np.cumsum(sizes)[:-1])
        self.context, self.bias, self.high, self.high_bias, self.low, self.low_bias = (
            p.reshape(s) for p, s in zip(parts, self.shapes)
        )

    def log_probability(self, around: np.ndarray, target: np.ndarray, at_once: int = 1024) -> np.ndarray:
        out = np.zeros(len(target), dtype=np.float32)
        if not len(target):
            return out
        high, low = np.divmod(target, self.digit)
        x = around + np.arange(len(SHIFTS)) * self.context.shape[1]
        softmax = Softmax(self, min(at_once, len(target)))
        for at in range(0, len(target), at_once):
            some = slice(at, at + at_once)
            out[some] = softmax.log_probability(np.ascontiguousarray(x[some].T), high[some], low[some])
        return out

    def train(self, codes: np.ndarray, places: np.ndarray, options: Options, together: int = 32) -> None:
        """One pass over the words at these places, in mini-batches with steps scaled by the gradients so far. So many steps
        ``together`` are prepared at once."""
        context = self.context.reshape(-1, self.context.shape[-1])
        squares = np.full(context.shape, 1e-3, dtype=np.float32)
        dense_squares = np.full(len(self.flat) - context.size, 1e-3, dtype=np.float32)
        whole = len(places) // options.batch * options.batch
        parts = [places[at : min(at + together * options.batch, whole)] for at in range(0, whole, together * options.batch)]
        for part in [*parts, places[whole:]]:
            if len(part):
                self.steps(codes, part.reshape(-1, min(options.batch, len(part))), np.float32(options.rate), squares, dense_squares)

    def steps(self, codes: np.ndarray, batches: np.ndarray, rate: np.float32, squares: np.ndarray, dense_squares: np.ndarray) -> None:
        """A step for each row of places. Equal places are found for all steps at once; a step only computes, in memory that
        the steps share."""
        d, n, width = self.digit, batches.shape[1], self.context.shape[-1]
        context = self.context.reshape(-1, width)
        dense = self.flat[context.size :]
        x = np.stack([codes[batches + s] + i * self.context.shape[1] for i, s in enumerate(SHIFTS)], axis=1)
        high, low = np.divmod(codes[batches], d)
        contexts, highs = Sums(x.reshape(len(x), -1), n), Sums(high, n)
        # rows as single items, which numpy puts in their places fastest
        item = np.dtype(f"V{4 * width}")
        context_items, square_items = context.view(item).ravel(), squares.view(item).ravel()
        softmax = Softmax(self, n)
        back, other, scaled = (np.zeros((rows, columns), dtype=np.float32) for rows, columns in ((n + 1, width), (n, width), (n, width + 1)))
        seen, rows = (np.empty((contexts.most, width), dtype=np.float32) for _ in range(2))
        ones, g_dense, again = np.ones(n, dtype=np.float32), np.zeros_like(dense), np.empty_like(dense)
        g_bias, g_high, g_low, g_lows = np.split(g_dense, np.cumsum([width, (width + 1) * d, width * d]))
        g_high, g_low, g_lows = g_high.reshape(-1, d), g_low.reshape(-1, d), g_lows.reshape(d, d)
        for step, at in enumerate(x):
            softmax(at, high[step], low[step])
            h, h1, (by_high, by_low) = softmax.h, softmax.h1, softmax.misses()
            # the first digit's misses have yet to be multiplied by by_high, the second's are scaled for their sums
            miss_high, miss_low = softmax.high[:n], softmax.low
            miss_low[:n] *= by_low[:, None]
            g = np.matmul(miss_high, self.high.T, out=back[:n])
            g *= by_high[:, None]
            g += np.matmul(miss_low[:n], self.low.T, out=other)
            np.multiply(h, h, out=other)
            g *= np.subtract(1, other, out=other)
            np.dot(ones, g, out=g_bias)
            np.matmul(np.multiply(h1, by_high[:, None], out=scaled).T, miss_high, out=g_high)
            np.matmul(h.T, miss_low[:n], out=g_low)
            g_lows[:] = 0
            used, sums = highs(step, miss_low)
            g_lows[used] = sums
            dense_squares += np.multiply(g_dense, g_dense, out=again)
            g_dense *= rate
            g_dense /= np.sqrt(dense_squares, out=again)
            dense += g_dense
            used, g = contexts(step, back)
            some, total = rows[: len(used)], seen[: len(used)]
            np.multiply(g, g, out=total)
            total += squares.take(used, axis=0, out=some, mode="clip")
            np.put(square_items, used, total.view(item))
            g *= rate
            g /= np.sqrt(total, out=total)
            g += context.take(used, axis=0, out=some, mode="clip")
            np.put(context_items, used, g.view(item))


class Softmax:
    """Hidden layer and both softmaxes of ``n`` examples at most, in memory that is used again. An example is a row; ``x`` has
    a row of context places for each shift."""

    def __init__(self, network: Network, n: int):
        d, width = network.digit, network.context.shape[-1]
        self.network, self.ones, self.begin = network, np.ones(d, dtype=np.float32), np.arange(n) * d
        self.context = network.context.reshape(-1, width)
        # the first digit's bias stands behind its weights and goes with a column of ones
        self.first = network.flat[self.context.size + width :][: (width + 1) * d].reshape(-1, d)
        self.around = np.empty((len(SHIFTS) * n, width), dtype=np.float32)
        self.hidden, self.with_one = np.empty((n, width), dtype=np.float32), np.ones((n, width + 1), dtype=np.float32)
        # the last row stays zero, as ``Sums`` asks
        self.high, self.low = (np.zeros((n + 1, d), dtype=np.float32) for _ in range(2))
        self.biases, self.totals = np.empty((n, d), dtype=np.float32), np.empty(2 * n, dtype=np.float32)

    def __call__(self, x: np.ndarray, high: np.ndarray, low: np.ndarray) -> None:
        """Exponentials, their sums, and ``picked``, the exponents at the targets. A maximum is taken off the exponents only
        where sums leave the range in which they are exact."""
        n, width = len(high), self.hidden.shape[1]
        around = self.context.take(x.ravel(), axis=0, out=self.around[: x.size], mode="clip")
        h = self.h = around.reshape(len(SHIFTS), n, width).sum(axis=0, out=self.hidden[:n])
        h += self.network.bias
        np.tanh(h, out=h)
        self.h1 = self.with_one[:n]
        self.h1[:, :width] = h
        self.at, self.sums = (self.begin[:n] + high, self.begin[:n] + low), self.totals[: 2 * n].reshape(2, n)
        with np.errstate(over="ignore"):
            self.exponentials(*self.exponents(high))
        if not (self.sums.min() > 1e-30 and self.sums.max() < 1e30):
            exponents = self.exponents(high)
            for z in exponents:
                z -= z.max(axis=1, keepdims=True)
            self.exponentials(*exponents)

    def exponents(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(high)
        second = np.matmul(self.h, self.network.low, out=self.low[:n])
        second += self.network.low_bias.take(high, axis=0, out=self.biases[:n], mode="clip")
        return np.matmul(self.h1, self.first, out=self.high[:n]), second

    def exponentials(self, *exponents: np.ndarray) -> None:
        self.picked = [z.ravel().take(at) for z, at in zip(exponents, self.at)]
        for z, total in zip(exponents, self.sums):
            np.dot(np.exp(z, out=z), self.ones, out=total)

    def log_probability(self, x: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        self(x, high, low)
        return sum(self.picked) - np.log(self.sums).sum(axis=0)

    def misses(self) -> np.ndarray:
        """Leave the exponentials less their sum at the target; times the factors returned these are the digits' misses."""
        for z, at, total in zip((self.high, self.low), self.at, self.sums):
            flat = z.ravel()
            flat[at] = flat.take(at) - total
        return np.float32(-1 / self.sums.shape[1]) / self.sums


class Sums:
    """Sums of rows with equal keys, a batch at a time: ``keys`` has a line for each batch, and the key at place i belongs to
    row i modulo ``n``.

    Equal keys are found for all batches at once. Those that occur once are taken as they are; those that occur 2 to 4, 5 to
    16, 17 to 32 times and so on are taken together, filled up with a row of zeros, so that few calls add up whole arrays.
    """

    def __init__(self, keys: np.ndarray, n: int):
        batches, places = keys.shape
        bits = n.bit_length()
        kind = np.int32 if (int(keys.max()) + 1) << bits <= 1 << 31 else np.int64
        packed = keys.astype(kind) << kind(bits) | np.tile(np.arange(n, dtype=kind), places // n)
        packed.sort(axis=1)
        rows = packed & kind((1 << bits) - 1)
        packed >>= kind(bits)
        new = np.ones((batches, places + 1), dtype=bool)
        np.not_equal(packed[:, 1:], packed[:, :-1], out=new[:, 1:-1])
        starts, ends = new[:, :-1], new[:, 1:]
        alone = starts & ends
        packed, rows, first = packed.ravel(), rows.ravel(), np.flatnonzero(starts > ends)
        many = np.flatnonzero(ends > starts) - first + 1
        each = alone.sum(axis=1)
        self.levels = [(bounds_of(each), packed[alone.ravel()], rows[alone.ravel()].astype(np.intp))]
        distinct, most = each, int(many.max(initial=1))
        low, high = 1, 4
        while low < most:
            some = np.flatnonzero((many > low) & (many <= high))
            within = np.arange(min(high, most))[:, None]
            at = rows.take(first[some] + within, mode="clip")
            each = np.bincount(first[some] // places, minlength=batches)
            self.levels.append((bounds_of(each), packed[first[some]], np.where(within < many[some], at, n).astype(np.intp)))
            distinct = distinct + each
            low, high = high, high * (4 if high < 16 else 2)
        self.most = int(distinct.max())

    def __call__(self, batch: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys of a batch and the sums of their rows. Behind the batch's rows stands one of zeros."""
        keys, sums = [], []
        for bounds, level, places in self.levels:
            a, b = bounds[batch : batch + 2]
            if b > a:
                keys.append(level[a:b])
                part = rows.take(places[..., a:b], axis=0, mode="clip")
                sums.append(part if places.ndim == 1 else part.sum(axis=0))
        return np.concatenate(keys, dtype=np.intp), np.concatenate(sums)


def bounds_of(each: np.ndarray) -> list[int]:
    """Where the part of each batch begins, and the end of the last."""
    return np.cumsum([0, *each]).tolist()


def summed(place: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct places, and for each the sum of its rows of ``back``, which has one row for as many places as there are
    shifts."""
    n = len(back)
    places, sums = Sums(place.reshape(n, -1).T.reshape(1, -1), n)(0, np.concatenate([back, np.zeros_like(back[:1])]))
    order = np.argsort(places)
    return places[order], sums[order]


def around_of(codes: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.stack([codes[places + s] for s in SHIFTS], axis=1)


def count_words(texts: DataFrame) -> DataFrame:
    """word (its hash) and many, of all words of all documents."""

    def start():
        hasher = WordHasher()

        def work(read: dict) -> dict:
            parts = hasher.each([utf8(t) for t in read["body"]])
            word, many = np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]), return_counts=True)
            return {ROW: np.zeros(len(word), np.int64), "word": word.view(np.int64), "many": many}

        return work

    return scan(texts, [], {"word": "long", "many": "long"}, start).groupBy("word").agg(F.sum("many").alias("many"))


def vocabulary_of(counted: DataFrame, options: Options) -> Vocabulary:
    """The most frequent words get own codes; the counts of all others are added up by code."""
    top = counted.orderBy(F.desc("many"), "word").limit(options.frequent).select("word").toArrow()
    frequent = top.column(0).to_numpy().view(np.uint64)

    def start():
        vocabulary = Vocabulary(frequent, options)

        def work(read: dict) -> dict:
            codes = vocabulary.codes(np.array(read["word"], dtype=np.int64).view(np.uint64))
            sums = np.bincount(codes, np.array(read["many"], dtype=np.float64), options.codes).astype(np.int64)
            sums[: vocabulary.first] = 0
            used = np.flatnonzero(sums)
            return {ROW: np.zeros(len(used), np.int64), "code": used, "many": sums[used]}

        return work

    by_code = scan(counted, [], {"code": "long", "many": "long"}, start).groupBy("code").agg(F.sum("many").alias("many"))
    within = np.zeros(options.codes)
    for r in by_code.collect():
        within[r["code"]] = np.log(r["many"] + 1)
    return Vocabulary(frequent, options, within)


def examples(texts: DataFrame, vocabulary: Vocabulary, options: Options, words_at_once: int = 100_000) -> DataFrame:
    """The codes of all words of all documents, with padding between them, as 32-bit numbers; some documents a row."""

    def start():
        hasher = WordHasher()

        def work(read: dict) -> dict:
            out, waiting, size = [], [], 0
            for i, hashes in enumerate(hasher.each([utf8(t) for t in read["body"]]), 1):
                waiting.append(hashes)
                size += len(waiting[-1])
                if size >= words_at_once or (size and i == len(read["body"])):
                    out.append(spread(waiting, vocabulary, options.codes)[0].astype(np.int32).tobytes())
                    waiting, size = [], 0
            return {ROW: np.zeros(len(out), np.int64), "examples": out}

        return work

    return scan(texts, [], {"examples": "binary"}, start)


def targets(codes: np.ndarray, pad: int, stride: int, turn: int) -> np.ndarray:
    """Places of the words that a round trains on; ``stride`` rounds together see every word once."""
    places = np.flatnonzero(codes != pad)
    if stride == 1 or not len(places):
        return places
    first = np.flatnonzero(codes[places - 1] == pad)
    lengths = np.diff(np.r_[first, len(places)])
    within = np.arange(len(places)) - np.repeat(first, lengths)
    # the offset differs by document, so that short ones are trained on as well
    return places[(within + np.repeat(codes[places[first]], lengths) + turn) % stride == 0]


def train(table: DataFrame, options: Options, scratch: Scratch) -> Network:
    network = Network(options)
    for turn in range(options.rounds):
        network = Network(options, averaged(trained(table, network, options, turn), options, scratch, network))
    return network


def trained(table: DataFrame, network: Network, options: Options, turn: int = 0) -> DataFrame:
    """One network per task: task, many (its examples), flat (its weights)."""
    flat = network.flat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, many = Network(options, flat.copy()), 0
        for batch in batches:
            for raw in batch.column(0):
                codes = np.frombuffer(raw.as_buffer(), dtype=np.int32).astype(np.int64)
                places = targets(codes, own.pad, options.stride, turn)
                own.train(codes, np.random.default_rng(len(places)).permutation(places), options)
                many += len(places)
        if many:
            arrays = [pa.array([TaskContext.get().partitionId()]), pa.array([many]), pa.array([own.flat.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["task", "many", "flat"])

    return table.select("examples").mapInArrow(run, "task long, many long, flat binary")


def averaged(models: DataFrame, options: Options, scratch: Scratch, before: Network) -> np.ndarray:
    """Mean of the weights by examples, taken where the networks are, in slices of the weights.

    Of a slice at most ``group`` networks are averaged at once, then as many of these means; one network reaches the
    driver.
    """
    size = options.part

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task, many, raw in zip(*[column.to_pylist() for column in batch.columns]):
                parts = [raw[at : at + 4 * size] for at in range(0, len(raw), 4 * size)]
                arrays = [[task] * len(parts), range(len(parts)), [many] * len(parts)]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(a, pa.int64()) for a in arrays], pa.array(parts, pa.binary())], names=["task", "part", "many", "flat"]
                )

    def mean(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        many = table.column("many").to_numpy()
        total = sum(n * np.frombuffer(raw.as_buffer(), dtype=np.float32).astype(np.float64) for n, raw in zip(many, table.column("flat")))
        flat = (total / many.sum()).astype(np.float32).tobytes()
        return pa.table({"task": [key[0].as_py()], "part": [key[1].as_py()], "many": [int(many.sum())], "flat": pa.array([flat], pa.binary())})

    kinds = "task long, part long, many long, flat binary"
    held = scratch.stage(models.mapInArrow(cut, kinds))
    tasks = held.filter("part = 0").agg(F.count(F.lit(1)), F.max("task")).first()
    if not tasks[0]:
        scratch.drop(held)
        return before.flat
    last = tasks[1]
    while last > 0:
        teams = held.withColumn("team", F.expr(f"task div {options.group}")).groupBy("team", "part")
        step = scratch.stage(teams.applyInArrow(mean, kinds))
        scratch.drop(held)
        held, last = step, last // options.group
    flat = b"".join(held.orderBy("part").select("flat").toArrow().column(0).to_pylist())
    scratch.drop(held)
    return np.frombuffer(flat, dtype=np.float32).copy()


def score(
    texts: DataFrame, vocabulary: Vocabulary, network: Network, counted: DataFrame, scratch: Scratch, words_at_once: int = 50_000
) -> DataFrame:
    """id, n_words, log_likelihood and its mean by word. The counts of the words that share codes come by a join."""

    def start():
        hasher = WordHasher()

        def work(read: dict) -> dict:
            lengths, sums, shared = [], [], []
            waiting, size = [], 0

            def flush() -> None:
                codes, places = spread(waiting, vocabulary, network.pad)
                found = np.concatenate([np.zeros(0), *[
                    network.log_probability(around_of(codes, part), codes[part]).astype(np.float64)
                    for part in np.array_split(places, max(1, len(places) // words_at_once))
                ]])
                own = codes[places]
                found -= vocabulary.within[own]
                ends = np.cumsum([0, *[len(h) for h in waiting]])
                sums.extend(float(found[a:b].sum()) for a, b in zip(ends, ends[1:]))
                shared.extend(h[own[a:b] >= vocabulary.first].view(np.int64) for h, a, b in zip(waiting, ends, ends[1:]))
                waiting.clear()

            for hashes in hasher.each([utf8(t) for t in read["body"]]):
                lengths.append(len(hashes))
                waiting.append(hashes)
                size += len(hashes)
                if size >= words_at_once:
                    flush()
                    size = 0
            flush()
            return {"n_words": lengths, "codes": sums, "shared": shared}

        return work

    read = scan(texts, ["id"], {"n_words": "long", "codes": "double", "shared": "array<long>"}, start)
    read = scratch.stage(read.withColumn("row", F.monotonically_increasing_id()))
    # a word seen once, or never, has the one count whose logarithm is 0
    logs = counted.filter("many > 1").select("word", F.round(F.log("many") * UNIT).cast("long").alias("log"))
    added = read.select("row", F.explode("shared").alias("word")).join(logs, "word").groupBy("row").agg(F.sum("log").alias("log"))
    total = F.col("codes") + F.coalesce(F.col("log") / UNIT, F.lit(0.0))
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    scored = read.join(added, "row", "left").select("id", "n_words", total.alias("log_likelihood"))
    return scored.withColumn("mean_log_likelihood", mean)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: Options = Options()) -> DataFrame:
    """Count the corpus, train on it, score it: three passes over the text, of which the counts and the words that share
    codes are shuffled."""
    scratch = Scratch(docs.sparkSession, "scoring")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    counted = scratch.stage(count_words(texts.select("body")))
    options = sized(options, counted.count())
    vocabulary = vocabulary_of(counted, options)
    table = scratch.stage(examples(texts.select("body"), vocabulary, options))
    network = train(table, options, scratch)
    scratch.drop(table)
    return score(texts, vocabulary, network, counted, scratch).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
