"""Toxicity by a linear-chain conditional random field.

Labels mark documents, a field tags tokens. So the toxic features are first found: words, and beginnings of words, in a
fair part of the different toxic documents and hardly in any clean one. Tokens of toxic documents with such a feature
are the labelled tokens, all others, and those of clean documents, are not. The field learns from them the weights of
words and beginnings and of the transitions; forward and backward passes over a whole text give each token's chance to
be toxic. The document's score is a logistic curve, learned on the same documents, of its most toxic token and of how
many toxic ones to expect.

Learning takes at most ``toxic`` and ``clean`` documents of the learning part, the first in hash order, and a bounded
number of stretches of each; every text is scored. Words are runs of letters, in lower case.

Defined cases: a null or empty text, or one without words, has the score of a text without toxic tokens. Documents
with several labels count as toxic if any says so; null labels and labels without a document are ignored. Without
labels of both kinds the score is the share of toxic ones, or one half. Repeated rows get equal scores; a null id is
scored, and counts as not held out. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Scratch, by_value, documents, scan, utf8
from .hashing import WordHasher

by_value(__name__)

NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class Options:
    """Bounds of the learning sample and settings of the field."""

    toxic: int = 2000
    clean: int = 3000
    features: int = 400
    support: float = 0.02
    odds: float = 8.0
    stretches: int = 4
    frequent: int = 3
    margin: int = 10
    rounds: int = 300
    rate: float = 0.2
    penalty: float = 1e-5


@dataclass
class Field:
    """Weights of a two-state chain: per known feature and for all words, for tag 1 against tag 0; and transitions."""

    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    transitions: np.ndarray  # 2 x 2, from and to
    slopes: tuple[float, float] = (1.0, 0.0)
    offset: float = 0.0

    def emissions(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of every token; ``rows`` holds its features."""
        if not len(self.words) or not len(rows):
            return np.full(len(rows), self.bias)
        at = np.minimum(np.searchsorted(self.words, rows), len(self.words) - 1)
        return self.bias + np.where(self.words[at] == rows, self.weights[at], 0.0).sum(axis=1)

    def score(self, summary: np.ndarray) -> np.ndarray:
        """Calibrated chance of toxicity of documents."""
        return 1 / (1 + np.exp(-np.clip(summary @ np.array(self.slopes) + self.offset, -40, 40)))


NOTHING = -12.0  # log-odds of a text without words, and the least that count


def summarise(p: np.ndarray) -> tuple[float, float]:
    """Log-odds of the most toxic token, and the logarithm of how many to expect besides."""
    if not len(p):
        return NOTHING, 0.0
    top = min(max(float(p.max()), 1e-9), 1 - 1e-9)
    return float(np.clip(np.log(top / (1 - top)), NOTHING, -NOTHING)), float(np.log1p(p[p >= 0.5].sum()))


def passes(e: np.ndarray, transitions: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward ratios of tag 1 to tag 0 for padded rows whose lengths do not rise; columns are positions.

    A two-state chain needs only the ratio, so a step over all rows is a few vector operations.
    """
    (a, b), (c, d) = np.exp(transitions)
    rows, width = e.shape
    x = np.exp(np.clip(e, -60, 60))
    forward, backward = np.ones_like(x), np.ones_like(x)
    active = (lengths[None, :] > np.arange(width)[:, None]).sum(axis=1)
    if width:
        forward[:, 0] = x[:, 0]
    for t in range(1, width):
        k = active[t]
        r = forward[:k, t - 1]
        forward[:k, t] = x[:k, t] * (b + r * d) / (a + r * c)
    for t in range(width - 2, -1, -1):
        k = active[t + 1]
        s = x[:k, t + 1] * backward[:k, t + 1]
        backward[:k, t] = (c + d * s) / (a + b * s)
    return forward, backward


def marginals(e: np.ndarray, transitions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    forward, backward = passes(e, transitions, lengths)
    odds = forward * backward
    return odds / (1 + odds)


def tag_documents(sequences: list[np.ndarray], field: Field, cells: int = 1 << 20) -> list[np.ndarray]:
    """Marginals of every token of every sequence; rows of similar length share a padded block of bounded size."""
    out: list[np.ndarray] = [np.zeros(0)] * len(sequences)
    order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: -len(sequences[i]))
    at = 0
    while at < len(order):
        width = len(sequences[order[at]])
        block = order[at : at + max(1, cells // width)]
        lengths = np.array([len(sequences[i]) for i in block])
        e = np.zeros((len(block), width))
        for row, i in enumerate(block):
            e[row, : lengths[row]] = field.emissions(sequences[i])
        p = marginals(e, field.transitions, lengths)
        for row, i in enumerate(block):
            out[i] = p[row, : lengths[row]]
        at += len(block)
    return out


def stretches(rows: np.ndarray, toxic: bool, marked: np.ndarray, options: Options) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and tags around tokens with a toxic feature, also in clean texts, and in the middle of the text."""
    if not len(rows):
        return []
    hit = np.isin(rows, marked).any(axis=1)
    centres, last = [len(rows) // 2], -1
    for at in np.flatnonzero(hit):
        if at > last and len(centres) < options.stretches:
            centres.append(int(at))
            last = at + options.margin
    parts = [slice(max(0, c - options.margin), c + options.margin + 1) for c in centres]
    return [(rows[p], (hit[p] & toxic).astype(float)) for p in parts]


def fit_field(tagged: list[tuple[np.ndarray, np.ndarray]], options: Options = Options()) -> Field:
    """Learn on tagged stretches by gradient steps on the conditional log-likelihood."""
    tagged = sorted(tagged, key=lambda part: -len(part[1]))
    lengths = np.array([len(t) for _, t in tagged])
    found, many = np.unique(np.concatenate([r for r, _ in tagged]), return_counts=True)
    vocabulary = found[(many >= options.frequent) & (found > 0)]
    kinds, width, none = tagged[0][0].shape[1], int(lengths.max()), len(vocabulary)
    inside = np.arange(width)[None, :] < lengths[:, None]
    known = np.full((len(tagged), width, kinds), none)
    y = np.zeros((len(tagged), width))
    for i, (r, t) in enumerate(tagged):
        at = np.minimum(np.searchsorted(vocabulary, r), max(none - 1, 0))
        known[i, : len(r)] = np.where(vocabulary[at] == r, at, none) if none else none
        y[i, : len(r)] = t
    weights, bias, trans = np.zeros(none + 1), 0.0, np.zeros((2, 2))
    moment = [np.zeros_like(weights), np.zeros_like(weights)], [0.0, 0.0], [np.zeros((2, 2)), np.zeros((2, 2))]
    both = inside[:, 1:]
    seen = np.array([[((y[:, :-1] == p) & (y[:, 1:] == q) & both).sum() for q in (0, 1)] for p in (0, 1)], dtype=float)
    tokens = inside.sum()
    for step in range(1, options.rounds + 1):
        e = np.where(inside, weights[known].sum(axis=2) + bias, 0.0)
        f, b = passes(e, trans, lengths)
        odds = f * b
        miss = np.where(inside, y - odds / (1 + odds), 0.0)
        x = np.exp(np.clip(e, -60, 60))
        joint = np.empty((2, 2) + both.shape)
        for i in (0, 1):
            for j in (0, 1):
                joint[i, j] = np.exp(trans[i, j]) * (f[:, :-1] if i else 1.0) * ((x * b)[:, 1:] if j else 1.0)
        expected = (joint / joint.sum(axis=(0, 1)) * both).sum(axis=(2, 3))
        weight_step = np.bincount(known.ravel(), np.repeat(miss.ravel(), kinds), minlength=none + 1)
        weight_step -= options.penalty * tokens * weights
        weight_step[-1] = 0.0  # features that are not known have no weight of their own
        grads = weight_step / tokens, miss.sum() / tokens, (seen - expected) / tokens
        moved = []
        for g, m, value in zip(grads, moment, (weights, bias, trans)):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            moved.append(value + options.rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8))
        weights, bias, trans = moved
    return Field(vocabulary, weights[:-1], float(bias), trans)


def blank_field(share: float) -> Field:
    """Without labels of both kinds: the share of toxic ones for every text."""
    share = min(max(share, 1e-3), 1 - 1e-3)
    none = np.zeros(0, np.uint64), np.zeros(0)
    return Field(*none, -20.0, np.zeros((2, 2)), (0.0, 0.0), float(np.log(share / (1 - share))))


def calibrate(field: Field, summary: np.ndarray, labels: np.ndarray, rounds: int = 200) -> Field:
    """Slopes and offset of the logistic curve, by Newton steps."""
    design = np.column_stack([summary, np.ones(len(summary))])
    w = np.array([0.5, 0.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-design @ w))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(3)
        step = np.linalg.solve(hessian, design.T @ (labels - p) - 1e-2 * w)
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    field.slopes, field.offset = (float(max(w[0], 1e-3)), float(max(w[1], 0.0))), float(w[2])
    return field


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learning_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, options: Options) -> DataFrame:
    """mark and body of the bounded sample; equal texts with equal labels count once."""
    marked = labels.filter("toxic IS NOT NULL").groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("mark"))
    marked = marked.filter(~held_out(F.col("id")) & F.col("id").isNotNull())
    first = lambda toxic, n: marked.filter((F.col("mark") > 0) == toxic).orderBy(F.xxhash64("id"), "id").limit(n)
    ids = first(True, options.toxic).union(first(False, options.clean)).toPandas()
    if not len(ids):
        return docs.sparkSession.createDataFrame([], "mark boolean, body string")
    chosen = F.broadcast(docs.sparkSession.createDataFrame(ids, marked.schema))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")).join(chosen, "id")
    return rows.select((F.col("mark") > 0).alias("mark"), "body").distinct()


def hasher_of() -> WordHasher:
    return WordHasher(blanks=NOT_LETTERS, prefixes=PREFIXES)


def toxic_features(sample: DataFrame, n_toxic: int, n_clean: int, options: Options) -> np.ndarray:
    """Features of a fair part of the toxic documents that clean ones hardly have: at most ``features`` of them."""

    def start():
        hasher = hasher_of()

        def work(read: dict) -> dict:
            own = [np.unique(hasher.spans(utf8(t))[0]) for t in read["body"]]
            feature, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]), return_inverse=True)
            mark = np.repeat(np.array(read["mark"], dtype=bool), [len(o) for o in own])
            toxic = np.bincount(at[mark], minlength=len(feature))
            clean = np.bincount(at[~mark], minlength=len(feature))
            return {ROW: np.zeros(len(feature), np.int64), "feature": feature.view(np.int64), "toxic": toxic, "clean": clean}

        return work

    counted = scan(sample, [], {"feature": "long", "toxic": "long", "clean": "long"}, start)
    counted = counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = (F.col("toxic") / n_toxic) / ((F.col("clean") + 0.5) / n_clean)
    least = max(3, options.support * n_toxic)
    good = counted.filter((F.col("feature") != 0) & (F.col("toxic") >= least) & (ratio >= options.odds))
    top = good.orderBy(F.desc(ratio * F.col("toxic")), "feature").limit(options.features).select("feature").toArrow()
    return top.column(0).to_numpy().view(np.uint64)


def tagged_stretches(sample: DataFrame, marked: np.ndarray, options: Options) -> list[tuple[np.ndarray, np.ndarray]]:
    """The bounded stretches of the sample, in a fixed order."""

    def start():
        hasher = hasher_of()

        def work(read: dict) -> dict:
            out = {ROW: [], "features": [], "tags": []}
            for i, (toxic, text) in enumerate(zip(read["mark"], read["body"])):
                for rows, tags in stretches(hasher.spans(utf8(text))[0], toxic, marked, options):
                    out[ROW].append(i)
                    out["features"].append(np.ascontiguousarray(rows).tobytes())
                    out["tags"].append(tags.astype(np.int8).tobytes())
            return out

        return work

    table = scan(sample, [], {"features": "binary", "tags": "binary"}, start).toArrow()
    kinds = 1 + len(PREFIXES)
    pairs = sorted(zip(table.column("features").to_pylist(), table.column("tags").to_pylist()))
    return [(np.frombuffer(f, np.uint64).reshape(-1, kinds), np.frombuffer(t, np.int8).astype(float)) for f, t in pairs]


def summaries(sample: DataFrame, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """What the field says about the whole texts of the sample, and their labels."""

    def start():
        hasher = hasher_of()

        def work(read: dict) -> dict:
            found = [summarise(p) for p in tag_documents([hasher.spans(utf8(t))[0] for t in read["body"]], field)]
            return {"top": [f[0] for f in found], "more": [f[1] for f in found]}

        return work

    table = scan(sample, ["mark"], {"top": "double", "more": "double"}, start).toPandas().sort_values(["mark", "top", "more"])
    return table[["top", "more"]].to_numpy(), table["mark"].to_numpy(dtype=float)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: Options = Options()) -> Field:
    """The field, from the labelled documents that are not held out."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.stage(learning_sample(docs, labels, id_col, text_col, options))
    counts = {r["mark"]: r["count"] for r in sample.groupBy("mark").count().collect()}
    n_toxic, n_clean = counts.get(True, 0), counts.get(False, 0)
    if not n_toxic or not n_clean:
        return blank_field(n_toxic / (n_toxic + n_clean) if counts else 0.5)
    tagged = tagged_stretches(sample, toxic_features(sample, n_toxic, n_clean, options), options)
    field = fit_field(tagged, options) if tagged else blank_field(n_toxic / (n_toxic + n_clean))
    field = calibrate(field, *summaries(sample, field)) if tagged else field
    scratch.drop_all()
    return field


def score_documents(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, and the toxic tokens as code point offsets start:end, in one pass without a shuffle."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))

    def start():
        hasher = hasher_of()

        def work(read: dict) -> dict:
            summary, spans = np.zeros((len(read["body"]), 2)), [""] * len(read["body"])
            for first in range(0, len(read["body"]), 1000):
                raws = [utf8(t) for t in read["body"][first : first + 1000]]
                found = [hasher.spans(raw) for raw in raws]
                for i, p in enumerate(tag_documents([f[0] for f in found], field)):
                    summary[first + i] = summarise(p)
                    marks = []
                    for at in np.flatnonzero(p >= 0.5):
                        s = len(raws[i][: found[i][1][at]].decode("utf-8", "surrogatepass"))
                        e = s + len(raws[i][found[i][1][at] : found[i][2][at]].decode("utf-8", "surrogatepass"))
                        marks.append(f"{s}:{e}")
                    spans[first + i] = ",".join(marks)
            return {"score": field.score(summary), "spans": spans}

        return work

    return scan(rows, ["id"], {"score": "double", "spans": "string"}, start).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    scored = score_documents(docs, learn(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans",
    )
