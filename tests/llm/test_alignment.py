"""Alignment of two tokenizers against a merge token by token with plain dictionaries, and on odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import alignment
from millrace.llm.common import documents

SF = "/root/testdata/sf0.001"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """The files' own libraries: A's tokenizer and byte-level letters, B's processor."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path(alignment.FIRST))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.SECOND))


def groups_of(plain, text):
    """Lists of A and B ids of each group, by the sets of byte offsets at which tokens end."""
    if not text:
        return []
    letters = alignment.byte_letters()
    encoded = plain[0].encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(letters[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)]
    b = []
    for i in plain[1].encode(text):
        piece = plain[1].id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if plain[1].is_byte(i) else piece.replace("▁", " ").encode()))
    raw = f" {text}".encode()
    if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
        return []

    def ends(tokens):
        at, out = 0, []
        for _, t in tokens:
            at += len(t)
            out.append(at)
        return out

    a_ends, b_ends = ends(a), ends(b)
    cuts = sorted(set(a_ends) & set(b_ends))
    inside = lambda tokens, stops, low, high: [t[0] for t, e in zip(tokens, stops) if low < e <= high]
    return [
        (inside(a, a_ends, low, high), inside(b, b_ends, low, high)) for low, high in zip([0, *cuts], cuts)
    ] if len(raw) < 400 else fast_groups(a, b, a_ends, b_ends, set(cuts))


def fast_groups(a, b, a_ends, b_ends, cuts):
    def split(tokens, stops):
        out, now = [], []
        for (i, _), e in zip(tokens, stops):
            now.append(i)
            if e in cuts:
                out.append(now)
                now = []
        return out

    return list(zip(split(a, a_ends), split(b, b_ends)))


def expected(plain, texts):
    groups = [groups_of(plain, t) for t in texts]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    held = Counter(pair for own in links for pair in set(own))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for g, own in zip(groups, links):
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own),
            sum(held[p] == best[p[0]] for p in own), sum(held[p] for p in own),
            hashlib.sha256(written.encode()).hexdigest() if g else "",
        ))
    return out


def test_query_as_by_brute_force(spark, plain):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, SF).collect()}
    want = dict(zip(texts, expected(plain, list(texts.values()))))
    rows = alignment.query(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == want[r["doc_id"]]


ODD = [
    "a", " a", "  two  blanks ", "tabs\tand\nlines\r\n", "<s> </s> <unk> <|endoftext|>", "low ▁ bar", "<0x41>",
    "中文字符 and ✓ 🙂🙂", "é é ﬁ", "\x00 zero", "=" * 300, " " * 500, "  x", "x" * 5000, "１２３ ½",
]


def test_odd_texts_and_rows(spark, plain, edges, empty):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()] + [(100 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    want = sorted(map(repr, ((i, *w) for (i, _), w in zip(rows, expected(plain, [t for _, t in rows])))))
    assert sorted(repr(tuple(r)) for r in alignment.align(df).select("doc_id", *COLUMNS).collect()) == want
    assert alignment.align(edges).count() == edges.count()
    out = alignment.align(empty)
    assert out.count() == 0 and set(out.columns) == {"doc_id", *COLUMNS}
    kinds = dict(out.dtypes)
    assert all(kinds[c] == "bigint" for c in ["doc_id", *COLUMNS[:-1]])


def test_ranks_give_the_ids_of_the_merges(plain):
    tools = alignment.Tokenizers(*map(alignment.tokenizer_path, (alignment.FIRST, alignment.SECOND)))
    assert tools.ranked is not None
    rng = random.Random(3)
    parts = [*"ab1= \n\té中🙂\xa0\x85\x00▁", "  ", "'s", "<|endoftext|>", "the", "ing"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += [f" a{chr(c)}b {chr(c)}1 {chr(c) * 2}." for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    whole = plain[0].encode_batch(texts, add_special_tokens=False)
    assert all(tools.ranked.encode_ordinary(t) == w.ids for t, w in zip(texts, whole))


def cuts_by_sets(a_ends, b_ends):
    return np.intersect1d(a_ends, b_ends)


@pytest.mark.parametrize("seed", range(20))
def test_lockstep_merge_of_random_ends(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 3000, size=rng.integers(1, 9))
    a_parts, b_parts, a_starts, b_starts, at = [], [], [0], [0], 0
    for n in lengths:
        for parts, starts, chance in ((a_parts, a_starts, 0.4), (b_parts, b_starts, rng.choice([0.02, 0.5]))):
            ends = np.append(np.flatnonzero(rng.random(n - 1) < chance) + 1, n) + at
            parts.append(ends)
            starts.append(starts[-1] + len(ends))
        at += n
    a_ends, b_ends = np.concatenate(a_parts), np.concatenate(b_parts)
    found = alignment.merge(a_ends, b_ends, np.array(a_starts[:-1]), np.array(b_starts[:-1]))
    cuts = cuts_by_sets(a_ends, b_ends)
    assert np.array_equal(a_ends[found.a_cuts - 1], cuts) and np.array_equal(b_ends[found.b_cuts - 1], cuts)
    a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
    want = {(i, j) for g in range(len(cuts)) for i in np.flatnonzero(a_group == g) for j in np.flatnonzero(b_group == g)}
    got = list(zip(found.a_links.tolist(), found.b_links.tolist()))
    assert not found.large and len(got) == len(want) and set(got) == want


def test_large_groups_give_the_same_pairs(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 9, 400), rng.integers(0, 9, 300)
    a_ends, b_ends = np.append(np.arange(1, 800, 2)[:399], 1000), np.append(np.arange(2, 1000, 2)[:299], 1000)
    monkeypatch.setattr(alignment, "PAIRS", len(a) * len(b))
    whole = alignment.merge(a_ends, b_ends, np.array([0]), np.array([0]))
    monkeypatch.setattr(alignment, "PAIRS", 1)
    parts = alignment.merge(a_ends, b_ends, np.array([0]), np.array([0]))
    assert parts.large and not whole.large
    texts = np.zeros(len(a), dtype=np.int64)
    for left, right in zip(alignment.slice_pairs(a, b, texts, whole), alignment.slice_pairs(a, b, texts, parts)):
        assert np.array_equal(left, right)


def test_counts_of_pairs_and_groups_as_text(spark):
    df = spark.createDataFrame([(1, "the cat"), (2, "the cat"), (3, "the dog"), (4, None)], "doc_id BIGINT, text STRING")
    groups = {r["doc_id"]: r["groups"] for r in alignment.alignments(df).collect()}
    assert groups[1] == groups[2] != groups[3] and groups[4] == "" and groups[1].count("|") == 2
    counts = alignment.link_counts(df).collect()
    assert sorted(r["docs"] for r in counts) == [1, 2, 3] and all(r["is_best"] for r in counts)
