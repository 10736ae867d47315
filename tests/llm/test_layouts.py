"""Sharding, packing and mixing against brute force, rules and odd rows."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing, packing, sharding
from millrace.llm.common import documents, number_within
from millrace.workspace import fresh_dir

from .conftest import clashing, prose

SF = "/root/testdata/sf0.001"

# --- numbering


def test_numbers_are_gapless_also_for_a_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 5).alias("k"), "id")
    rows = number_within(df, ["k"], [F.col("id")], "at", 400_000).collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r["k"], []).append(r["at"])
    assert len(rows) == 5000 and all(sorted(v) == list(range(len(v))) for v in by_key.values())


# --- sharding


def cheapest(supply, capacity, cost):
    """All ways to send whole units, by brute force."""
    best = [np.inf]

    def go(i, j, left, room, spent):
        if spent >= best[0]:
            return
        if i == len(supply):
            best[0] = spent
            return
        if j == len(capacity):
            if left[i] == 0:
                go(i + 1, 0, left, room, spent)
            return
        for amount in range(min(left[i], room[j]) + 1):
            left[i] -= amount
            room[j] -= amount
            go(i, j + 1, left, room, spent + amount * cost[i][j])
            left[i] += amount
            room[j] += amount

    go(0, 0, list(supply), list(capacity), 0)
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_cheapest(seed):
    rng = np.random.default_rng(seed)
    supply, capacity = rng.integers(0, 4, 3).tolist(), rng.integers(0, 4, 3).tolist()
    capacity[0] += max(0, sum(supply) - sum(capacity))
    cost = rng.integers(0, 5, (3, 3)).astype(float)
    flow = sharding.minimum_cost_flow(supply, capacity, cost)
    assert [sum(a for (i, _), a in flow.items() if i == k) for k in range(3)] == supply
    assert all(sum(a for (_, j), a in flow.items() if j == k) <= capacity[k] for k in range(3))
    assert sum(a * cost[i, j] for (i, j), a in flow.items()) == cheapest(supply, capacity, cost.tolist())


def test_fewest_bytes_move():
    supply, new = [50, 10, 30], 4
    flow = sharding.minimum_cost_flow(supply, sharding.near_equal(90, new), sharding.moving_cost(3, new))
    stay = sum(a for (i, j), a in flow.items() if i == j)
    assert stay == 23 + 10 + 22


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_resharding_rules(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, sf).collect()}
    rows = sharding.query(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    shards = {}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        shards.setdefault(r["shard"], []).append(r)
    assert set(shards) <= set(range(40))
    sizes = [sum(r["size"] for r in shards.get(j, [])) for j in range(40)]
    assert max(sizes) - min(sizes) <= max(r["size"] for r in rows)
    if sf != SF:
        assert max(sizes) - min(sizes) < 0.01 * max(sizes)
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in shards.values())


def test_only_affected_shards_are_written(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 84).alias("text"))
    old = F.when(F.col("doc_id") % 4 == 3, 0).otherwise(F.col("doc_id") % 4).cast("int")  # 2000, 1000, 1000
    key = sharding.row_key(F.col("doc_id"), F.col("text"))
    digest = docs.select(old.alias("old"), key.alias("key"), sharding.text_bytes(F.col("text")).alias("size"))
    placement = sharding.plan(digest, 3, 4, [100_000] * 4)
    assert {k: v for k, v in placement.flow.items() if k[0] != k[1]} == {(0, 3): 100_000}
    assert placement.affected == [0, 3]
    path = sharding.rewrite(docs, placement, old, key, fresh_dir(spark, "shards"))
    counts = {r["shard"]: r["count"] for r in spark.read.parquet(path).groupBy("shard").count().collect()}
    assert counts == {0: 1000, 3: 1000}


def test_rows_of_untouched_shards_are_returned(spark, monkeypatch):
    plan = sharding.plan

    def one_untouched(*args):
        placement = plan(*args)
        placement.affected = placement.affected[1:]
        return placement

    monkeypatch.setattr(sharding, "plan", one_untouched)
    ids = sorted(r["doc_id"] for r in documents(spark, SF).select("doc_id").collect())
    assert sorted(r["doc_id"] for r in sharding.query(spark, SF).collect()) == ids


def test_sharding_edges(spark, edges, empty):
    for docs, n in ((edges, 13), (empty, 0)):
        old, key = sharding.old_layout(F.col("source"), 3), sharding.row_key(F.col("doc_id"), F.col("text"))
        digest = docs.select(old.alias("old"), key.alias("key"), sharding.text_bytes(F.col("text")).alias("size"))
        placement = sharding.plan(digest, 3, 5)
        named = docs.drop("old")
        placed = placement.apply(named.drop("shard", "key", "size"), old, key)
        assert placed.count() == n and placed.filter("shard IS NULL OR shard NOT BETWEEN 0 AND 4").count() == 0
        path = sharding.rewrite(docs, placement, old, key, fresh_dir(spark, "edge-shards"))
        if n:
            back = spark.read.parquet(path)
            assert "doc_shard" in back.columns and back.count() <= n


# --- packing


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    encoder = packing.Encoder(packing.tokenizer_path())
    texts = [
        prose(3), "Don't we'LL 'S x's it's'", "é É ß ÀÞ ª º ² ½ µ \xa0 a\x85b", "中文 Ελλάς ΣΑΣ İ é", "a<|endoftext|>b <|startoftext|>",
        "tab\tnew\nline\r\n  \x0b\x0c", "ctl \x1c a\x1db \x00 z", " a　b ᠎", "", "   ", "123 4.5e6 #$%", "a" * 5000, "\U0001f642 fun",
    ]
    for text in texts * 2:  # the second time from the cache
        want = np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert encoder.text(text) == want, text


def fewest(counts, size):
    """Optimal number of sequences, by trying all placements."""
    pieces = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    best = [len(pieces)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(pieces):
            best[0] = len(rooms)
            return
        for r in set(rooms):
            if r >= pieces[i]:
                at = rooms.index(r)
                go(i + 1, rooms[:at] + [r - pieces[i]] + rooms[at + 1 :])
        go(i + 1, [*rooms, size - pieces[i]])

    go(0, [])
    return best[0]


def test_word_caches_are_bounded_and_end_with_the_task(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    path = packing.tokenizer_path()
    encoder, fresh = packing.Encoder(path), packing.Encoder(path)
    text = " ".join([*(f"word{i} rare-{i}" for i in range(500)), "x" * 5000, "word1"])
    ids = encoder.whole.encode(text, add_special_tokens=False).ids
    for _ in range(2):
        assert encoder.text(text) == np.array(ids, dtype="<u4").tobytes()
        assert len(encoder.words) <= 50 and len(encoder.parts) <= 50
    encoder.text("x" * 5000)
    assert max(map(len, [*encoder.words, *encoder.parts])) <= packing.CACHED_LENGTH
    assert not fresh.words and not packing.Encoder(path).words


@pytest.mark.parametrize("seed", range(15))
def test_packing_is_optimal_on_small_cases(seed):
    rng = np.random.default_rng(seed)
    counts = {}
    for n in rng.integers(1, 30, 9).tolist():
        counts[n] = counts.get(n, 0) + 1
    for method in (packing.best_fit, packing.complete):
        patterns = method(counts, 30)
        used = {}
        for lengths, many in patterns:
            assert sum(lengths) <= 30 and many > 0
            for n in lengths:
                used[n] = used.get(n, 0) + many
        assert used == counts
    assert sum(many for _, many in packing.complete(counts, 30)) == fewest(counts, 30)


def test_fillings_are_undominated():
    counts = {9: 1, 7: 2, 5: 1, 3: 3, 1: 1}
    lengths = sorted(counts, reverse=True)
    for room in range(1, 25):
        found = packing.fillings(room, lengths, counts, 5, 10_000)
        sums = {
            sum(n * k for n, k in zip(lengths, ks))
            for ks in itertools.product(*[range(counts[n] + 1) for n in lengths])
        }
        assert found[0][0] == room - max(s for s in sums if s <= room)
        assert all(left == room - sum(taken) >= 0 for left, taken in found)


def test_many_tiny_pieces_and_huge_counts():
    counts = {1: 100_000, 4096: 7, 4095: 3, 2: 50_000_000_000}
    patterns = packing.complete(counts)
    total = sum(n * c for n, c in counts.items())
    assert sum(many for _, many in patterns) <= -(-total // 4096) + 1


def check_packing(rows, expected):
    """``expected``: doc_id to list of id arrays, one per row of the document."""
    from collections import Counter

    want = Counter()
    for doc, arrays in expected.items():
        for ids in arrays:
            for i, a in enumerate(range(0, len(ids), 4096)):
                part = ids[a : a + 4096]
                want[doc, i, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r["length"] for r in rows)
    assert len(places) <= -(-total // 4096) + 1


def test_packed_documents(spark, edges, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    ids = lambda t: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
    texts = {r["doc_id"]: [ids(r["text"])] for r in documents(spark, SF).collect()}
    check_packing(packing.query(spark, SF).collect(), texts)
    rows = {}
    for r in edges.collect():
        rows.setdefault(r["doc_id"], []).append(ids(r["text"]))
    check_packing(packing.pack(edges).collect(), rows)
    assert packing.pack(empty).collect() == []


# --- mixing


def brute_split(total, children):
    """Water level by raising it in whole steps of full children: name to budget."""
    out = {name: 0 for name, w, _ in children if w == 0}
    rest = sorted((c * 1000 // w, name, w, c) for name, w, c in children if w > 0)
    left, weight = total, sum(w for _, _, w, _ in rest)
    for i, (_, name, w, c) in enumerate(rest):
        if left * w >= c * weight:
            out[name] = c
            left, weight = max(left - c, 0), weight - w
        else:
            for _, name, w, c in rest[i:]:
                out[name] = min(c, left * w // weight)
            break
    return out


@pytest.mark.parametrize("seed", range(4))
def test_budgets_fill_siblings_first(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(f"domain{i % 3}", f"l{i % 4}", f"s{i}", int(rng.integers(1, 1000))) for i in range(24)]
    plan = mixing.Plan(weights={"domain": {"domain0": 6, "domain2": 0}, "language": {"l1": 3}, "source": {"s5": 4}}, share=70, epochs=2)
    tokens = spark.createDataFrame(rows, "domain STRING, language STRING, source STRING, n_tokens BIGINT")
    got = {(r["domain"], r["language"], r["source"]): r["source_budget"] for r in mixing.budgets(mixing.leaves(tokens, plan), plan).collect()}
    weight = lambda level, name: plan.weights[level].get(name, 1)
    capacity = lambda keep: 2 * sum(n for *path, n in rows if keep(path))
    total = sum(n for *_, n in rows) * 70 // 100
    domains = sorted({r[0] for r in rows})
    top = brute_split(total, [(d, weight("domain", d), capacity(lambda p: p[0] == d)) for d in domains])
    for d in domains:
        langs = sorted({r[1] for r in rows if r[0] == d})
        mid = brute_split(top[d], [(k, weight("language", k), capacity(lambda p: p[:2] == [d, k])) for k in langs])
        for k in langs:
            leaves = [(r[2], weight("source", r[2]), 2 * r[3]) for r in rows if r[:2] == (d, k)]
            for name, budget in brute_split(mid[k], leaves).items():
                assert got[d, k, name] == budget
    assert total - 24 <= sum(got.values()) <= total


def test_prefix_of_each_leaf(spark):
    rows = [(i, "d", "en", "s" if i % 3 else "t", 1 + i % 7) for i in range(400)]
    tokens = spark.createDataFrame(rows, "id BIGINT, domain STRING, language STRING, source STRING, n_tokens BIGINT")
    got = mixing.select_copies(tokens, mixing.Plan(weights={}, share=90, epochs=3)).collect()
    copies = {r["id"]: r["copies"] for r in got}
    import hashlib

    for source in "st":
        own = [(i, n) for i, *_, s, n in rows if s == source]
        budget = next(r["leaf_budget"] for r in got if r["source"] == source)
        full, rest = divmod(budget, sum(n for _, n in own))
        at = 0
        for i, n in sorted(own, key=lambda r: hashlib.md5(f"mix-1:{full}:{r[0]}".encode()).hexdigest()):
            assert copies.get(i, 0) == full + (at < rest)
            at += n


def test_mixing_edges(spark, edges, empty):
    rows = mixing.mix_documents(edges, mixing.Plan(share=300)).collect()
    assert rows and mixing.mix_documents(edges).columns == edges.columns
    assert mixing.mix_documents(empty).collect() == []
    plan = mixing.mix_documents(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_clashing_columns_survive(spark):
    docs = clashing(documents(spark, SF))
    assert mixing.mix_documents(docs).columns == docs.columns
