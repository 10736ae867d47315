"""Secret scans by grammar inference.

Three plain patterns find the base spans. Their credentials, by kind, are the labelled examples from which one
probabilistic automaton per kind is learned: a prefix tree over character classes whose states are merged as long as
their frequencies are statistically compatible. Every other credential-like run in every text is then scored by its
likelihood under these automata, whole and in its parts, and becomes a span if it is as likely as the labelled ones are.

Defined cases: a null or empty text has no spans and stays as it is. Repeated rows get equal results; extra columns are
ignored by ``find`` and kept by ``masked``. Without labelled credentials there are no automata and only base spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, by_value, documents, scan, sliced

by_value(__name__)

KINDS = ("assign", "access", "hex")
LEARNED = "format"
ORDER = {kind: i for i, kind in enumerate((*KINDS, LEARNED))}

# The base patterns.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs, so the same as every run of which the short ones are dropped
RUN_LEAST = 12  # the shortest credential that a base span can teach
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}")
MARKS = "+/_.=-"
# A run is scored whole, and in the parts that each of these leaves.
CUTS = tuple(re.compile(rf"[^{marks}]+") for marks in ("=", "=/", "=/."))


@dataclass(frozen=True)
class Options:
    """``sampled``: labelled credentials per kind, the first in hash order; ``least``: fewer teach nothing;
    ``alpha``: confidence of the merge test; ``quantile``: share of the labelled credentials that may score lower than
    a new span."""

    sampled: int = 1000
    least: int = 8
    alpha: float = 0.05
    quantile: float = 0.02


def base_spans(text: str | None) -> list[tuple[int, str, int, str]]:
    """start, kind, end and the credential itself, in order of start and kind."""
    if not text:
        return []
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), "assign", m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), "hex", m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], ORDER[s[1]]))


class Covers:
    """Which base spans reach a place: they are few in number at each, but many in a long text."""

    def __init__(self, taken: list[tuple[int, str, int, str]]):
        self.starts = [s for s, *_ in taken]
        self.reach = list(accumulate((e for _, _, e, _ in taken), max))  # the furthest end so far

    def hold(self, start: int, end: int) -> bool:
        """Whether one span holds all of the stretch: the furthest reaching one of those that start before it does."""
        at = bisect_right(self.starts, start)
        return at > 0 and self.reach[at - 1] >= end


def candidates(text: str | None, taken: list[tuple[int, str, int, str]]) -> list[tuple[int, int, str]]:
    """Credential-like runs, their parts, and both without the marks at their ends, as far as no base span holds them."""
    found, covers = set(), Covers(taken)
    for m in RUN.finditer(text or ""):
        pieces = {m.span()}
        for cut in CUTS:
            pieces.update(p.span() for p in cut.finditer(text, m.start(), m.end()))
        for start, end in pieces:
            value = text[start:end]
            inner = start + len(value) - len(value.lstrip(MARKS))
            for a, b in ((start, end), (start, start + len(value.rstrip(MARKS))), (inner, start + len(value.rstrip(MARKS)))):
                if b - a >= RUN_LEAST and not covers.hold(a, b):
                    found.add((a, b))
    return [(a, b, text[a:b]) for a, b in sorted(found)]


def symbols(value: str) -> str:
    """The value as character classes: digit, a-f, other lower case, A-F, other upper case; marks stand for themselves."""
    return value.translate(_CLASSES)


def _classes() -> dict[int, str]:
    table = {ord(c): "0" for c in "0123456789"}
    table |= {c: "a" if c <= ord("f") else "z" for c in range(ord("a"), ord("z") + 1)}
    return table | {c: "A" if c <= ord("F") else "Z" for c in range(ord("A"), ord("Z") + 1)}


_CLASSES = _classes()


class Automaton:
    """A probabilistic automaton learned by merging the compatible states of a prefix tree.

    ``count``: how many values reach a state, ``ends``: how many end in it, ``next``: symbol to state and ``uses``:
    symbol to how many take it.
    """

    def __init__(self, values: list[str], alpha: float):
        self.alpha = alpha
        self.count, self.ends, self.next, self.uses = [0], [0], [{}], [{}]
        for value in values:
            self._add(symbols(value))
        self._merge_all()

    def _state(self) -> int:
        for column, empty in ((self.count, 0), (self.ends, 0), (self.next, {}), (self.uses, {})):
            column.append(empty.copy() if isinstance(empty, dict) else empty)
        return len(self.count) - 1

    def _add(self, value: str) -> None:
        at = 0
        self.count[at] += 1
        for s in value:
            if s not in self.next[at]:
                self.next[at][s] = self._state()
            self.uses[at][s] = self.uses[at].get(s, 0) + 1
            at = self.next[at][s]
            self.count[at] += 1
        self.ends[at] += 1

    def _differ(self, f: int, n: int, g: int, m: int) -> bool:
        """Hoeffding bound on two frequencies."""
        if not n or not m:
            return False
        bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return abs(f / n - g / m) > bound

    def _compatible(self, a: int, b: int) -> bool:
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            n, m = self.count[a], self.count[b]
            if self._differ(self.ends[a], n, self.ends[b], m):
                return False
            for s in self.next[a].keys() | self.next[b].keys():
                if self._differ(self.uses[a].get(s, 0), n, self.uses[b].get(s, 0), m):
                    return False
                if s in self.next[a] and s in self.next[b]:
                    waiting.append((self.next[a][s], self.next[b][s]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to a."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            self.count[a] += self.count[b]
            self.ends[a] += self.ends[b]
            for s, target in self.next[b].items():
                self.uses[a][s] = self.uses[a].get(s, 0) + self.uses[b][s]
                if s in self.next[a]:
                    waiting.append((self.next[a][s], target))
                else:
                    self.next[a][s] = target

    def _merge_all(self) -> None:
        """Kept states stay; each state at their border merges with the first compatible one, or is kept as well."""
        kept = [0]
        while True:
            inside = set(kept)
            border = [(a, s, t) for a in kept for s, t in sorted(self.next[a].items()) if t not in inside]
            if not border:
                break
            a, s, t = max(border, key=lambda edge: self.count[edge[2]])
            for k in kept:
                if self._compatible(k, t):
                    self.next[a][s] = k
                    self._fold(k, t)
                    break
            else:
                kept.append(t)
        self.states = len(kept)

    def score(self, value: str) -> float:
        """Mean log-likelihood of a symbol, the end included; minus infinity where the automaton has no path."""
        at, total = 0, 0.0
        for s in symbols(value):
            used = self.uses[at].get(s, 0)
            if not used:
                return -math.inf
            total += math.log(used / self.count[at])
            at = self.next[at][s]
        if not self.ends[at]:
            return -math.inf
        return (total + math.log(self.ends[at] / self.count[at])) / (len(value) + 1)


@dataclass
class Formats:
    """The learned automata and, for each, the score that a new span must reach."""

    automata: dict[str, tuple[Automaton, float]]

    def accepts(self, value: str) -> bool:
        return any(automaton.score(value) >= least for automaton, least in self.automata.values())


def learn(labelled: dict[str, list[str]], options: Options = Options()) -> Formats:
    automata = {}
    for kind, values in sorted(labelled.items()):
        if len(values) >= options.least:
            automaton = Automaton(values, options.alpha)
            scores = sorted(automaton.score(v) for v in values)
            automata[kind] = (automaton, scores[int(options.quantile * len(scores))])
    return Formats(automata)


def spans_of(text: str | None, formats: Formats) -> list[tuple[int, str, int]]:
    base = base_spans(text)
    more = [(start, LEARNED, end) for start, end, value in candidates(text, base) if formats.accepts(value)]
    return sorted([(s, kind, e) for s, kind, e, _ in base] + more, key=lambda s: (s[0], ORDER[s[1]]))


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def read_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document: base spans, their credentials by kind, and the other candidates."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))

    def start():
        def work(read: dict) -> dict:
            out = {"base": [], "labelled": [], "others": []}
            for text in read["body"]:
                base = base_spans(text)
                out["base"].append(joined([s[:3] for s in base]))
                out["labelled"].append([f"{kind}:{value}" for _, kind, _, value in base])
                out["others"].append([f"{start}:{end}:{value}" for start, end, value in candidates(text, base)])
            return out

        return work

    return scan(rows, ["id"], {"base": "string", "labelled": "array<string>", "others": "array<string>"}, start)


def sample_labelled(found: DataFrame, options: Options) -> dict[str, list[str]]:
    """Distinct credentials by kind, the first ``sampled`` in hash order."""
    each = found.select(F.explode("labelled").alias("both")).distinct()
    each = each.select(F.substring_index("both", ":", 1).alias("kind"), F.expr("substring(both, instr(both, ':') + 1)").alias("value"))
    out = {}
    for kind in KINDS:
        first = each.filter(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(options.sampled)
        out[kind] = [r["value"] for r in first.select("value").collect()]
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: Options = Options()) -> DataFrame:
    """id, base (spans), spans (all, as kind:start:end) of every row."""
    found = Scratch(docs.sparkSession, "secrets").stage(read_texts(docs, id_col, text_col))
    formats = learn(sample_labelled(found, options), options)

    def start():
        def work(read: dict) -> dict:
            out = []
            for base, others in zip(read["base"], read["others"]):
                spans = [(int(s), kind, int(e)) for kind, s, e in (x.split(":") for x in base.split(",") if x)]
                for other in others:
                    s, e, value = other.split(":", 2)
                    if formats.accepts(value):
                        spans.append((int(s), LEARNED, int(e)))
                out.append(joined(sorted(spans, key=lambda x: (x[0], ORDER[x[1]]))))
            return {"spans": out}

        return work

    return scan(found, ["id", "base"], {"spans": "string"}, start).withColumnRenamed("id", id_col)


def mask(text: str | None, formats: Formats, mark: str = "<SECRET>") -> str | None:
    """The text with every span, overlapping ones as one, replaced by a mark."""
    spans = spans_of(text, formats)
    if not spans:
        return text
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, text_col: str = "text", options: Options = Options()) -> DataFrame:
    """The same rows and columns without the secrets in their texts; ``n_chars`` follows the text where it is there."""
    scratch = Scratch(docs.sparkSession, "mask")
    found = scratch.stage(read_texts(docs.select(F.lit(0).alias("none"), F.col(text_col).alias("body")), "none", "body"))
    formats = learn(sample_labelled(found, options), options)
    scratch.drop_all()

    hide = F.arrow_udf(sliced(pa.string(), lambda texts: [mask(t, formats) for t in texts]), "string")
    out = docs.withColumn(text_col, hide(F.col(text_col)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(text_col).cast(dict(docs.dtypes)["n_chars"]))
    return out


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def count_of(kind: str):
    return F.coalesce(F.size(F.filter(F.split("base", ","), lambda s: s.startswith(f"{kind}:"))), F.lit(0)).cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(documents(spark, sf_dir))
    return found.select(
        "doc_id", *[count_of(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2("base", 256).alias("base_sha256"), "spans",
    )
