"""Quality rules by distribution divergence.

Every document gets two histograms: its characters by class and its common words of the language. They are compared
with the mean histograms of all documents of that language by the Jensen-Shannon distance (0: alike, 1: disjoint).

Defined cases: a null or empty text has no words and is rejected by the base rule. A null or unlisted language is
compared with the mean of all unlisted ones, by character classes only. A language with fewer than
``least_documents`` documents has no reference, and only the base rule speaks. Repeated rows are judged alike; extra
columns are carried through ``keep_documents`` untouched. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, Scratch, by_value, documents, scan, sliced, utf8

by_value(__name__)

# The most common words of each listed language.
COMMON_WORDS = {
    "en": "the of and to in is it that for was on are as with be by at this or an from not he she they".split(),
    "de": "der die und das in den von zu mit sich des auf ist ein eine nicht dem im als auch es an für er sie".split(),
    "fr": "de la le et les des en un une du est que dans qui pour au par sur il elle pas plus ne se et".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus".split(),
}
SYMBOLS = b"#*$%&|<>"
CLASSES = ("vowel", "consonant", "upper", "digit", "blank", "line", "stop", "symbol", "other", "lead", "trail")
WORD_BINS = max(len(set(w)) for w in COMMON_WORDS.values()) + 1


@dataclass(frozen=True)
class Limits:
    """Distances above which a text is rejected, and how long it must be to be compared at all."""

    chars: float = 0.33
    words: float = 0.285
    char_words: int = 50
    word_words: int = 200
    least_documents: int = 30
    least_words: int = 50
    repeated_percent: int = 50


def _class_of_byte() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"))
    for name, members in (
        ("consonant", b"bcdfghjklmnpqrstvwxyz"), ("vowel", b"aeiou"), ("upper", bytes(range(65, 91))),
        ("digit", b"0123456789"), ("blank", b" \t\x0b\x0c\r"), ("line", b"\n"), ("stop", b".,;:!?'\"()-"),
        ("symbol", SYMBOLS), ("trail", bytes(range(128, 192))), ("lead", bytes(range(192, 256))),
    ):
        table[list(members)] = CLASSES.index(name)
    return table


def class_matrix() -> np.ndarray:
    """256 x classes: adds the counts of single bytes up to classes."""
    matrix = np.zeros((256, len(CLASSES)), dtype=np.int64)
    matrix[np.arange(256), _class_of_byte()] = 1
    return matrix


def word_bins() -> dict[str, dict[bytes, int]]:
    """Language to word to bin; the last bin holds all other words."""
    return {lang: {w.encode(): i for i, w in enumerate(dict.fromkeys(listed))} for lang, listed in COMMON_WORDS.items()}


def repeated_words(found: list[bytes]) -> int:
    """Words that lie in a window of three words which occurs at least twice."""
    if len(found) < 4:
        return 0
    ids: dict[bytes, int] = {}
    row = np.fromiter((ids.setdefault(w, len(ids)) for w in found), np.int64, len(found))
    if len(ids) == len(found):
        return 0
    pairs = row[:-2] * len(ids) + row[1:-1]
    pairs = np.unique(pairs, return_inverse=True)[1]
    key = pairs * len(ids) + row[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    starts = np.zeros(len(key) + 2, dtype=bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    covered = starts.copy()
    covered[1:] |= starts[:-1]
    covered[2:] |= starts[:-2]
    return int(covered.sum())


def measure(text: str | None, lang: str | None, matrix: np.ndarray, bins: dict) -> list[int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then the two histograms."""
    raw = utf8(text)
    found = raw.split()
    solid = raw.translate(None, BLANKS.encode())
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    trail = int(counts[128:192].sum())
    seen, repeats = set(), 0
    if b"\n" in raw:
        for line in raw.split(b"\n"):
            if line in seen:
                repeats += 1
            elif line.strip(BLANKS.encode()):
                seen.add(line)
    chars = counts @ matrix
    by_word = [0] * WORD_BINS
    listed = bins.get(lang)
    if listed is not None:
        for w in raw.lower().split():
            at = listed.get(w)
            if at is not None:
                by_word[at] += 1
        by_word[-1] = len(found) - sum(by_word)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return [len(found), len(solid) - trail, symbols, repeats, repeated_words(found), *chars.tolist(), *by_word]


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
CHAR_COLUMNS = [f"chars_{c}" for c in CLASSES]
WORD_COLUMNS = [f"word_{i}" for i in range(WORD_BINS)]
MEASURES = [*BASE, *CHAR_COLUMNS, *WORD_COLUMNS]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One narrow row per document: id, listed language (else empty) and all measures."""
    listed = F.when(F.col(lang_col).isin(*COMMON_WORDS), F.col(lang_col)).otherwise("")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"), listed.alias("listed"))

    def start():
        matrix, bins = class_matrix(), word_bins()

        def work(read: dict) -> dict:
            values = [measure(t, lang, matrix, bins) for t, lang in zip(read["body"], read["listed"])]
            table = np.array(values, dtype=np.int64).reshape(len(values), len(MEASURES))
            return {m: table[:, i] for i, m in enumerate(MEASURES)}

        return work

    return scan(rows, ["id", "listed"], dict.fromkeys(MEASURES, "long"), start)


def failed(limits: Limits):
    return (F.col("n_words") < limits.least_words) | (
        100 * F.col("n_repeat_words") > limits.repeated_percent * F.col("n_words")
    )


def references(measured: DataFrame, limits: Limits) -> dict[str, tuple[list[float], list[float]]]:
    """Mean histograms by language, over every document that passes the base rule; at most five rows reach the driver.

    Shares are counted in millionths, so the sums do not depend on the order of the rows.
    """
    letters = sum((F.col(c) for c in CHAR_COLUMNS), F.lit(0))
    share = lambda c, all_of: F.sum(F.floor(1_000_000 * F.col(c) / F.greatest(all_of, F.lit(1)))).alias(c)
    sums = measured.filter(~failed(limits)).groupBy("listed").agg(
        F.count(F.lit(1)).alias("documents"), *[share(c, letters) for c in CHAR_COLUMNS],
        *[share(c, F.col("n_words")) for c in WORD_COLUMNS],
    )
    out = {}
    for row in sums.collect():
        if row["documents"] >= limits.least_documents:
            out[row["listed"]] = ([row[c] for c in CHAR_COLUMNS], [row[c] for c in WORD_COLUMNS])
    return out


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of each row of counts to one histogram; 0 where either has no mass."""
    total = counts.sum(axis=1, keepdims=True)
    if not len(counts) or reference.sum() <= 0:
        return np.zeros(len(counts))
    p = counts / np.maximum(total, 1)
    q = reference / reference.sum()
    m = (p + q) / 2

    def kl(a: np.ndarray) -> np.ndarray:
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)

    divergence = (kl(p) + kl(np.broadcast_to(q, p.shape))) / 2
    return np.where(total[:, 0] > 0, np.sqrt(np.clip(divergence, 0, 1)), 0.0)


def verdicts(table: pd.DataFrame, known: dict, limits: Limits) -> pd.DataFrame:
    """Adds js_chars, js_words, base_failed and kept to a frame with all measures."""
    js_chars, js_words = np.zeros(len(table)), np.zeros(len(table))
    listed = table["listed"].to_numpy()
    for lang, (chars, common) in known.items():
        at = np.flatnonzero(listed == lang)
        js_chars[at] = js_distance(table[CHAR_COLUMNS].to_numpy()[at], np.array(chars, dtype=float))
        if lang:
            js_words[at] = js_distance(table[WORD_COLUMNS].to_numpy()[at], np.array(common, dtype=float))
    n = table["n_words"].to_numpy()
    bad = (n < limits.least_words) | (100 * table["n_repeat_words"].to_numpy() > limits.repeated_percent * n)
    far = ((n >= limits.char_words) & (js_chars > limits.chars)) | ((n >= limits.word_words) & (js_words > limits.words))
    return table.assign(js_chars=js_chars, js_words=js_words, base_failed=bad, kept=~bad & ~far)


def judge(measured: DataFrame, known: dict, limits: Limits = Limits()) -> DataFrame:
    """Measures of a staged feature table with the verdicts."""
    added = {"js_chars": "double", "js_words": "double", "base_failed": "boolean", "kept": "boolean"}

    def start():
        def work(read: dict) -> dict:
            table = pd.DataFrame({c: read[c] for c in ["listed", *MEASURES]})
            return {c: v.to_numpy() for c, v in verdicts(table, known, limits)[[*added]].items()}

        return work

    return scan(measured, ["id", *BASE], added, start)


def keep_documents(
    docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The documents that pass, with all their columns. The text is read twice and never shuffled."""
    scratch = Scratch(docs.sparkSession, "quality")
    measured = scratch.stage(features(docs, id_col, text_col, lang_col))
    known = references(measured, limits)
    scratch.drop_all()

    matrix, bins = class_matrix(), word_bins()

    def kept(texts: list, langs: list) -> np.ndarray:
        values = [measure(t, lang, matrix, bins) for t, lang in zip(texts, langs)]
        table = pd.DataFrame(np.array(values, dtype=np.int64).reshape(len(values), len(MEASURES)), columns=MEASURES)
        return verdicts(table.assign(listed=langs), known, limits)["kept"].to_numpy()

    passes = F.arrow_udf(sliced(pa.bool_(), kept), "boolean")
    listed = F.when(F.col(lang_col).isin(*COMMON_WORDS), F.col(lang_col)).otherwise("")
    return docs.filter(passes(F.col(text_col), listed))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = Limits()
    measured = Scratch(spark, "op9").stage(features(documents(spark, sf_dir)))
    return judge(measured, references(measured, limits), limits).withColumnRenamed("id", "doc_id")
