"""Cross-tokenizer alignment by lockstep merging.

A text is encoded by two tokenizers, A (byte-level BPE, with a blank before the text) and B (sentencepiece BPE, which
adds that blank itself). Byte offsets at which a token of A and one of B both end cut the tokens into groups; tokens of
one group are linked, each of A with each of B.

All texts of a slice of rows are merged at once: the state is a small matrix with a column per lane (a text, or a
stretch of a long one that starts at a cut) and rows for the places in A and B, the start of the group and the end of
the lane. One step compares the ends of both tokens of every lane, moves the place whose token ends first, or both
where they end together, emits the cuts and links found, and drops the lanes that are done.

How many documents hold a pair of ids linked is counted for the whole corpus: each slice gives its distinct pairs with
their documents, these are summed by a shuffle, and the sums go back to the slices that hold the pair. So what is
shuffled and held at once are distinct pairs of slices of bounded bytes, whatever the corpus.

Defined cases: a text that is null or empty, or that a tokenizer does not give back byte by byte, has no tokens: its
numbers are 0 and its groups ''. Special tokens in a text are plain text. Equal rows count as documents of their own;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, by_value, documents, scan, small, worker_cache

by_value(__name__)

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
# Tokens of A in a lane, more where its end is no cut.
LANE = 256
# Pairs of a group that are written out one by one; a larger group gives its distinct pairs with their numbers.
PAIRS = 1 << 16
# Codes of pairs are a * RADIX + b.
RADIX = 1 << 20

# Fixed value: the byte-level split of words, numbers, marks and blanks.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in own}
    letters.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in own)})
    return letters


class Tokenizers:
    """Ids of texts by both tokenizers, and the bytes of their tokens.

    Where the ids of A follow its merges, which is looked up in the file, the merges are run by rank, several times
    as fast as by the file's own library and with the same ids (see the tests).
    """

    def __init__(self, first: str, second: str):
        import sentencepiece
        from tokenizers import Tokenizer

        with open(first, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        self.whole = Tokenizer.from_file(first)
        self.whole.encode_special_tokens = True
        known = self.whole.get_vocab(with_added_tokens=True)
        self.a_bytes: list[bytes] = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            plain = all(c in letters for c in token) and token in model["vocab"]
            self.a_bytes[i] = bytes(letters[c] for c in token) if plain else token.encode()
        self.ranked = self._ranked(model, letters)
        if self.ranked is not None:
            self.whole = None
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=second)
        self.b_bytes = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        # A token as text with the mark behind it: within its side, or at the end of the side, the group, the text.
        self.written = [b"%d%s" % (i, mark) for mark in (b",", b"|") for i in range(len(self.a_bytes))]
        self.written += [b"%d%s" % (i, mark) for mark in (b",", b";", b"") for i in range(len(self.b_bytes))]

    @staticmethod
    def _ranked(model: dict, letters: dict[str, int]):
        import tiktoken

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"].get(left + right) for left, right in merges]
        if None in made or any(a >= b for a, b in zip(made, made[1:])):
            return None
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        parts = {bytes([b]) for b in range(256)} | {bytes(letters[c] for c in a + b) for a, b in merges}
        return tiktoken.Encoding("ranked", pat_str=SPLIT, special_tokens={}, mergeable_ranks={
            t: i for t, i in ranks.items() if t in parts
        })

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of a blank and the text by A, and of the text by B."""
        spaced = f" {text}"
        if self.ranked is not None:
            first = self.ranked.encode_ordinary(spaced)
        else:
            first = self.whole.encode(spaced, add_special_tokens=False).ids
        return first, self.pieces.encode(text, num_threads=1)

    def lossless(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = f" {text}".encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))


@dataclass
class Merged:
    """Groups of all texts of a slice: ends of each group in A and B, links as places in A and B, and large groups."""

    a_cuts: np.ndarray
    b_cuts: np.ndarray
    a_links: np.ndarray
    b_links: np.ndarray
    large: list[tuple[int, int, int, int]]


def group_links(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each of ``n`` places from ``a`` with each of ``m`` places from ``b``, group by group."""
    each = n * m
    group = np.repeat(np.arange(len(a)), each)
    within = np.arange(len(group)) - np.repeat(np.cumsum(each) - each, each)
    return a[group] + within // m[group], b[group] + within % m[group]


def merge(a_ends: np.ndarray, b_ends: np.ndarray, a_starts: np.ndarray, b_starts: np.ndarray) -> Merged:
    """Cut and link the tokens of all texts, given the ends of their bytes and where each text starts, in lockstep."""
    a_from, b_from = lanes(a_ends, b_ends, a_starts, b_starts)
    stops = np.append(a_from, len(a_ends))[1:]
    state = np.stack([a_from, b_from, a_from, b_from, stops])  # places in A and B, starts of the group, end of the lane
    a_cuts, b_cuts, a_links, b_links, large = [], [], [], [], []
    while state.shape[1]:
        a_end, b_end = a_ends[state[0]], b_ends[state[1]]
        state[0] += a_end <= b_end
        state[1] += b_end <= a_end
        cut = np.flatnonzero(a_end == b_end)
        if not len(cut):
            continue
        a, b, a_first, b_first, stop = state[:, cut]
        a_cuts.append(a)
        b_cuts.append(b)
        n, m = a - a_first, b - b_first
        single = (n == 1) & (m == 1)
        a_links.append(a_first[single])
        b_links.append(b_first[single])
        if not single.all():
            wide = n * m > PAIRS
            several = ~single & ~wide
            pairs = group_links(a_first[several], n[several], b_first[several], m[several])
            a_links.append(pairs[0])
            b_links.append(pairs[1])
            large += zip(a_first[wide].tolist(), a[wide].tolist(), b_first[wide].tolist(), b[wide].tolist())
        state[2, cut], state[3, cut] = a, b
        done = a == stop
        if done.any():
            left = np.ones(state.shape[1], dtype=bool)
            left[cut[done]] = False
            state = state[:, left]
    whole = lambda parts: np.concatenate([np.zeros(0, dtype=np.int64), *parts])
    return Merged(np.sort(whole(a_cuts)), np.sort(whole(b_cuts)), whole(a_links), whole(b_links), large)


def lanes(a_ends: np.ndarray, b_ends: np.ndarray, a_starts: np.ndarray, b_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the lanes in A and B: of all texts, and every ``LANE`` tokens of A where a token of B ends as well."""
    at = np.arange(LANE, len(a_ends), LANE)
    offset = a_ends[at - 1]
    other = np.searchsorted(b_ends, offset)
    meets = b_ends[np.minimum(other, len(b_ends) - 1)] == offset if len(at) else np.zeros(0, dtype=bool)
    a = np.concatenate([a_starts, at[meets]]).astype(np.int64)
    b = np.concatenate([b_starts, other[meets] + 1]).astype(np.int64)
    a, keep = np.unique(a, return_index=True)
    return a, b[keep]


def large_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of ids of one group, and how often each is linked."""
    a_ids, a_times = np.unique(a, return_counts=True)
    b_ids, b_times = np.unique(b, return_counts=True)
    return (a_ids[:, None] * RADIX + b_ids).ravel(), (a_times[:, None] * b_times).ravel()


def slice_pairs(a: np.ndarray, b: np.ndarray, text_of: np.ndarray, found: Merged) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, pair) of a slice by text and pair: the text, the code of the pair, how often it is linked."""
    span = np.int64(RADIX) * RADIX
    keys = text_of[found.a_links] * span + a[found.a_links] * RADIX + b[found.b_links]
    keys, times = np.unique(keys, return_counts=True)
    if found.large:
        more = [large_pairs(a[i:j], b[k:n]) for i, j, k, n in found.large]
        keys = np.concatenate([keys, *(text_of[g[0]] * span + codes for g, (codes, _) in zip(found.large, more))])
        times = np.concatenate([times, *(n for _, n in more)])
        keys, where = np.unique(keys, return_inverse=True)
        times = np.bincount(where, weights=times).astype(np.int64)
    return keys // span, keys % span, times


def written_groups(tools: Tokenizers, a: np.ndarray, b: np.ndarray, bounds: np.ndarray, found: Merged) -> list[bytes]:
    """The groups of each text, ``a1,a2|b1;a3|b2,b3``; ``bounds``: where each text ends in A and B together."""
    a_cuts, b_cuts = found.a_cuts, found.b_cuts
    a_group = np.repeat(np.arange(len(a_cuts)), np.diff(a_cuts, prepend=0))
    b_group = np.repeat(np.arange(len(b_cuts)), np.diff(b_cuts, prepend=0))
    marks = np.zeros(len(a), dtype=np.int64)
    marks[a_cuts - 1] = 1
    ordered = np.empty(len(a) + len(b), dtype=np.int64)
    ordered[np.arange(len(a)) + np.append(0, b_cuts)[a_group]] = a + marks * len(tools.a_bytes)
    marks = np.zeros(len(b), dtype=np.int64)
    marks[b_cuts - 1] = 1
    codes = b + marks * len(tools.b_bytes) + 2 * len(tools.a_bytes)
    ordered[np.arange(len(b)) + a_cuts[b_group]] = codes
    ordered[bounds[1:] - 1] += len(tools.b_bytes)  # no mark behind the last token
    lookup = tools.written.__getitem__
    return [b"".join(map(lookup, ordered[i:j].tolist())) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
ADDED = {
    **dict.fromkeys(COUNTS, "long"), "groups_sha256": "string", "groups": "string", "block": "long",
    "at": "array<int>", "times": "array<int>", "codes": "array<long>", "docs": "array<int>",
}


def encoded(tools: Tokenizers, bodies: list[str | None]):
    """Ids of A and B of all texts that both give back, behind each other; which texts, and where each starts."""
    a, b, kept = [], [], []
    for i, text in enumerate(bodies):
        if text:
            first, second = tools.encode(text)
            if tools.lossless(text, first, second):
                a.append(np.array(first, dtype=np.int32))
                b.append(np.array(second, dtype=np.int32))
                kept.append(i)
    join = lambda lists: np.concatenate([np.zeros(0, np.int32), *lists]).astype(np.int64)
    starts = lambda lists: np.cumsum([0, *map(len, lists)], dtype=np.int64)
    return join(a), join(b), kept, starts(a), starts(b)


def aligned(docs: DataFrame, first: str, second: str, columns: list[str], id_col: str, text_col: str) -> DataFrame:
    """Id and the ``columns`` asked for, out of ``ADDED``.

    ``block`` names the slice of a row; the first row of a slice holds its distinct pairs (``codes``) and how many
    of its rows hold each (``docs``). ``at`` points into these and ``times`` says how often a row links the pair.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))

    def start():
        cache = worker_cache(f"aligned:{first}:{second}")
        tools = cache.get("tools") or cache.setdefault("tools", Tokenizers(first, second))
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        done = iter(range(1 << 31))

        def work(read: dict) -> dict:
            bodies = read["body"]
            a, b, texts, a_starts, b_starts = encoded(tools, bodies)
            a_ends, b_ends = np.cumsum(tools.a_sizes[a]), np.cumsum(tools.b_sizes[b])
            found = merge(a_ends, b_ends, a_starts[:-1], b_starts[:-1])
            text_of = np.repeat(np.array(texts, dtype=np.int64), np.diff(a_starts))
            text, code, times = slice_pairs(a, b, text_of, found)
            codes, at, held = np.unique(code, return_inverse=True, return_counts=True)
            n = len(bodies)
            of_row = np.searchsorted(text, np.arange(n + 1))
            ragged = lambda values: pa.ListArray.from_arrays(
                pa.array(of_row.astype(np.int32)), pa.array(values.astype(np.int32)))
            numbers = np.zeros((n, len(COUNTS)), dtype=np.int64)
            numbers[texts, 0], numbers[texts, 1] = np.diff(a_starts), np.diff(b_starts)
            numbers[texts, 2] = np.diff(np.searchsorted(found.a_cuts, a_starts, side="right"))
            np.add.at(numbers[:, 3], text, times)
            groups = [b""] * n
            if "groups" in columns or "groups_sha256" in columns:
                for i, value in zip(texts, written_groups(tools, a, b, a_starts + b_starts, found)):
                    groups[i] = value
            out = {
                **{c: numbers[:, i] for i, c in enumerate(COUNTS)},
                "groups_sha256": [hashlib.sha256(g).hexdigest() if g else "" for g in groups],
                "block": np.full(n, (task << 31) + next(done), dtype=np.int64),
                "at": ragged(at), "times": ragged(times),
                "codes": [codes] + [None] * (n - 1), "docs": [held.astype(np.int32)] + [None] * (n - 1),
            }
            if "groups" in columns:
                out["groups"] = [g.decode() for g in groups]
            return {c: out[c] for c in columns}

        return work

    return scan(rows, ["id"], {c: ADDED[c] for c in columns}, start)


def alignments(
    docs: DataFrame, first: str | None = None, second: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document its id, the numbers of tokens, groups and links, and the groups as text."""
    paths = first or tokenizer_path(FIRST), second or tokenizer_path(SECOND)
    return aligned(docs, *paths, [*COUNTS, "groups"], id_col, text_col).withColumnRenamed("id", id_col)


def pairs_of_blocks(rows: DataFrame) -> DataFrame:
    """Block, place in the block, code and documents of every distinct pair of a slice."""
    pairs = rows.filter(F.col("codes").isNotNull()).select("block", F.posexplode(F.arrays_zip("codes", "docs")).alias("at", "p"))
    return pairs.select("block", "at", F.col("p.codes").alias("code"), F.col("p.docs").alias("docs"))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Code, number of documents that hold the pair linked, and whether no pair of the same A id has more."""
    held = pairs.groupBy("code").agg(F.sum("docs").alias("held"))
    first = F.shiftright("code", RADIX.bit_length() - 1)
    most = held.groupBy(first.alias("first")).agg(F.max("held").alias("most"))
    return held.join(most, first == F.col("first")).select("code", "held", (F.col("held") == F.col("most")).alias("is_best"))


def link_counts(
    docs: DataFrame, first: str | None = None, second: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every linked pair of ids of the corpus: a_id, b_id, docs, and whether it is the best of its A id."""
    paths = first or tokenizer_path(FIRST), second or tokenizer_path(SECOND)
    rows = aligned(docs, *paths, ["block", "codes", "docs"], id_col, text_col)
    staged = Scratch(docs.sparkSession, "links").stage(rows.filter(F.col("codes").isNotNull()))
    counts = pair_counts(pairs_of_blocks(staged))
    return counts.select(
        F.expr(f"code div {RADIX}").alias("a_id"), F.expr(f"code % {RADIX}").alias("b_id"),
        F.col("held").alias("docs"), "is_best",
    )


def scored(rows: DataFrame, scratch: Scratch, id_col: str) -> DataFrame:
    """The staged rows with ``n_best`` and ``count_sum``, from the counts of the whole corpus, block by block."""
    pairs = pairs_of_blocks(rows)
    counts = small(scratch.stage(pair_counts(pairs)), 24)
    known = pairs.join(counts, "code").select(F.col("block").alias("of_block"), "at", "held", "is_best")
    narrow = rows.drop("codes", "docs")
    kept = ["id", *COUNTS, "groups_sha256"]
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in kept] + ["n_best long", "count_sum long"])

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        held = np.zeros(right.num_rows, dtype=np.int64)
        best = np.zeros(right.num_rows, dtype=np.int64)
        at = right.column("at").to_numpy()
        held[at] = right.column("held").to_numpy()
        best[at] = right.column("is_best").to_numpy()
        left = left.combine_chunks()
        lists = [left.column(c).combine_chunks() for c in ("at", "times")]
        places, times = (np.asarray(x.flatten(), dtype=np.int64) for x in lists)
        ends = np.append(0, np.cumsum(np.asarray(lists[0].value_lengths(), dtype=np.int64)))
        sums = [np.append(0, np.cumsum(v)) for v in (times * best[places], times * held[places])]
        out = left.select(kept)
        for name, total in zip(("n_best", "count_sum"), sums):
            out = out.append_column(name, pa.array(total[ends[1:]] - total[ends[:-1]]))
        return out

    grouped = narrow.groupBy("block").cogroup(known.groupBy("of_block"))
    return grouped.applyInArrow(block, schema).withColumnRenamed("id", id_col)


def align(
    docs: DataFrame, first: str | None = None, second: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document the numbers of tokens, groups and links, how many links are the best of their A id over the whole
    corpus, the sum of the links' document counts, and the checksum of the groups. Texts are tokenised once."""
    paths = first or tokenizer_path(FIRST), second or tokenizer_path(SECOND)
    scratch = Scratch(docs.sparkSession, "align")
    columns = [*COUNTS, "groups_sha256", "block", "at", "times", "codes", "docs"]
    return scored(scratch.stage(aligned(docs, *paths, columns, id_col, text_col)), scratch, id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))
