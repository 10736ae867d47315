"""Best-fit packing of token pieces into sequences by bin completion.

Documents are tokenised whole; only one longer than a sequence is cut, into full pieces and a last shorter one. How many
pieces there are of each length is all the packing needs, so the search runs on that histogram, which has at most as
many entries as a sequence has tokens, however many documents there are: for the largest length left it enumerates the
undominated fillings of the room beside it, best first, and goes depth first with a bound on the waste; best fit
decreasing gives the first incumbent. A filling is used as often as the counts allow. The outcome is a list of
patterns with multiplicities, and every piece finds its slot from its rank among the pieces of its length.

Defined cases: a null or empty text is a piece of one token, the end mark. Repeated rows are packed one by one, equal
ones in any order; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Scratch, by_value, documents, number_within, scan

by_value(__name__)

SEQUENCE = 4096
END = 1
TOKENIZER = "word_bpe_49k.json"
# Entries of a task's caches of words and of their parts; one that is full is emptied. Longer words are not kept.
CACHED_WORDS = 300_000
CACHED_LENGTH = 64

# Fixed value: the tokenizer's own split into words, digits and marks.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of a text as little-endian 32-bit bytes, from a cache of white-space separated words, which ends with the task:
    a reused Python worker holds none of it in the stages that follow.

    A word of Latin-1 characters goes through the tokenizer's model directly: that range is already in normal form and
    is lower-cased letter by letter. All other words, and those that may hold a special token, take the whole tokenizer.
    Texts with the control characters that Python takes for blanks, and the tokenizer does not, are encoded at once.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.pieces = regex.compile(PIECES)
        self.visible = self._visible_bytes()
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.odd = re.compile("[\x1c-\x1f]")
        self.narrow = re.compile("[\x00-\xff]*").fullmatch

    @staticmethod
    def _visible_bytes() -> dict[int, str]:
        """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {b: chr(b) for b in own}
        for n, b in enumerate(b for b in range(256) if b not in letter):
            letter[b] = chr(256 + n)
        return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}

    def part(self, piece: str) -> bytes:
        ids = [token.id for token in self.model.tokenize(piece.translate(self.visible))]
        return np.array(ids, dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        if not self.narrow(word) or "<|" in word:
            return np.array(self.whole.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        out = []
        for piece in self.pieces.findall(word.lower()):
            known = self.parts.get(piece)
            if known is None:
                known = self.part(piece)
                keep(self.parts, piece, known)
            out.append(known)
        return b"".join(out)

    def text(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.odd.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        words = self.words
        out = []
        for w in text.split():
            ids = words.get(w)
            if ids is None:
                ids = self.word(w)
                keep(words, w, ids)
            out.append(ids)
        return b"".join(out)


def keep(cache: dict[str, bytes], word: str, ids: bytes) -> None:
    if len(word) <= CACHED_LENGTH:
        if len(cache) >= CACHED_WORDS:
            cache.clear()
        cache[word] = ids


def cut(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE) -> DataFrame:
    """One row per piece: id, piece, start, length and the checksum of its ids."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    end = np.array([END], dtype="<u4").tobytes()

    def start():
        encoder = Encoder(path)

        def work(read: dict) -> dict:
            out = {ROW: [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for i, text in enumerate(read["body"]):
                ids = encoder.text(text) + end
                for n, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    for name, value in zip(out, (i, n, at // 4, len(part) // 4, zlib.crc32(part))):
                        out[name].append(value)
            return out

        return work

    return scan(rows, ["id"], {"piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}, start)


def best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over a histogram: open sequences with equal room are filled together."""
    open_by_room: dict[int, list[list]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in open_by_room if r >= length):
            groups = open_by_room.get(room)
            while left and groups:
                lengths, many = groups.pop()
                used = min(many, left)
                if many > used:
                    groups.append([lengths, many - used])
                open_by_room.setdefault(room - length, []).append([(*lengths, length), used])
                left -= used
            if not left:
                break
        fit = size // length
        if left >= fit:
            open_by_room.setdefault(size - fit * length, []).append([(length,) * fit, left // fit])
        if left % fit:
            open_by_room.setdefault(size - (left % fit) * length, []).append([(length,) * (left % fit), 1])
    return [(lengths, many) for groups in open_by_room.values() for lengths, many in groups]


def fillings(room: int, lengths: list[int], counts: dict[int, int], limit: int, nodes: int) -> list[tuple[int, tuple[int, ...]]]:
    """Undominated fillings of a room, least waste first, at most ``limit``; ``lengths`` descend.

    A filling is maximal: nothing that is left fits beside it. It is dominated, and left out, if one of its lengths
    could be exchanged for a longer one that is left. A branch ends when even all smaller pieces could not bring its
    waste under that of the ``limit`` best so far. The first descent takes the longest that fits each time, which
    nothing dominates, so there is always a filling.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    budget = [nodes]
    rising = lengths[::-1]
    below = np.cumsum([0] + [n * counts[n] for n in rising])[::-1].tolist()

    def leaf(left: int, taken: dict[int, int]) -> None:
        if len(found) == limit and left >= found[-1][0]:
            return
        for n in taken:
            at = bisect_right(rising, n)
            while at < len(rising) and rising[at] <= n + left:
                if counts[rising[at]] > taken.get(rising[at], 0):
                    return
                at += 1
        found.append((left, tuple(n for n, k in taken.items() for _ in range(k))))
        found.sort()
        del found[limit:]

    def descend(at: int, left: int, taken: dict[int, int]) -> None:
        budget[0] -= 1
        at = max(at, len(rising) - bisect_right(rising, left))
        if at >= len(lengths):
            leaf(left, taken)
            return
        for i in range(at, len(lengths)):
            if budget[0] <= 0 or (len(found) == limit and left - below[i] >= found[-1][0]):
                return
            n = lengths[i]
            for k in range(min(counts[n], left // n), 0, -1):
                descend(i + 1, left - k * n, {**taken, n: k})
                if budget[0] <= 0 or (len(found) == limit and found[-1][0] == 0):
                    return

    descend(0, room, {})
    return found


def complete(counts: dict[int, int], size: int = SEQUENCE, branches: int = 3, nodes: int = 400, tries: int = 40) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence, how often) that hold all pieces in as few sequences as found.

    Branch and bound over bin completions: a branch ends as soon as its sequences, plus what the tokens left need at
    least, cannot beat the incumbent; it stops when the incumbent meets the lower bound or after ``tries`` descents.
    The limits bound the search, not the result: every piece is packed in any case.
    """
    counts = {n: c for n, c in counts.items() if c > 0}
    total = sum(n * c for n, c in counts.items())
    least = max(-(-total // size), sum(c for n, c in counts.items() if 2 * n > size))
    best = best_fit(counts, size)
    best_used = sum(many for _, many in best)
    left_tries = [tries]

    def descend(counts: dict[int, int], lengths: list[int], tokens: int, used: int, done: list) -> None:
        nonlocal best, best_used
        trail: list[tuple[dict, list, int, int, list, tuple]] = []
        while True:
            if used + -(-tokens // size) >= best_used or best_used == least:
                left_tries[0] -= 1
            elif not lengths:
                best, best_used = list(done), used
                left_tries[0] -= 1
            else:
                first = lengths[0]
                rest = {**counts, first: counts[first] - 1}
                room = size - first
                choices = fillings(room, [n for n in lengths if n <= room and rest[n] > 0], rest, branches, nodes)
                for _, other in choices[1:]:
                    trail.append((counts, lengths, tokens, used, list(done), (first, *other)))
                del trail[:-64]  # the most recent alternatives are enough for the tries left
                pattern = (first, *choices[0][1])
                counts, lengths, tokens, used, done = apply(counts, lengths, tokens, used, done, pattern)
                continue
            if not trail or left_tries[0] <= 0 or best_used == least:
                return
            counts, lengths, tokens, used, done, pattern = trail.pop()
            counts, lengths, tokens, used, done = apply(counts, lengths, tokens, used, done, pattern)

    def apply(counts, lengths, tokens, used, done, pattern):
        needed = {n: pattern.count(n) for n in set(pattern)}
        many = min(counts[n] // k for n, k in needed.items())
        counts = {**counts, **{n: counts[n] - k * many for n, k in needed.items()}}
        lengths = [n for n in lengths if counts[n] > 0]
        return counts, lengths, tokens - many * sum(pattern), used + many, [*done, (pattern, many)]

    if best_used > least:
        descend(counts, sorted(counts, reverse=True), total, 0, [])
    return best


def slot_table(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Length to its slots: first rank, first sequence and offset of every run of equal slots, by rank."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for lengths, many in patterns:
        offset = 0
        for n in lengths:
            runs.setdefault(n, []).append((ranks.get(n, 0), first, offset))
            ranks[n] = ranks.get(n, 0) + many
            offset += n
        first += many
    return {n: tuple(np.array(column, dtype=np.int64) for column in zip(*listed)) for n, listed in runs.items()}


def place(ranked: DataFrame, slots: dict[int, tuple[np.ndarray, ...]]) -> DataFrame:
    """Sequence and offset of every ranked piece. The table has at most a few entries per pattern position."""

    def start():
        def work(read: dict) -> dict:
            sequence, offset = [], []
            for n, rank in zip(read["length"], read["rank"]):
                ranks, firsts, offsets = slots[n]
                at = int(np.searchsorted(ranks, rank, side="right")) - 1
                sequence.append(int(firsts[at]) + rank - int(ranks[at]))
                offset.append(int(offsets[at]))
            return {"sequence_id": sequence, "offset": offset}

        return work

    keep = [c for c in ranked.columns if c != "rank"]
    return scan(ranked, keep, {"sequence_id": "long", "offset": "long"}, start)


def pack(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE) -> DataFrame:
    """Pieces with their sequence and offset; the texts are read once and only short rows are shuffled."""
    spark = docs.sparkSession
    pieces = Scratch(spark, "pieces").stage(cut(docs, path or tokenizer_path(), id_col, text_col, size))
    histogram = {r["length"]: r["many"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("many")).collect()}
    slots = slot_table(complete(histogram, size))
    order = [F.col("id"), F.col("piece"), F.col("ids_crc32")]
    ranked = number_within(pieces, ["length"], order, "rank", sum(histogram.values()))
    return place(ranked, slots).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
