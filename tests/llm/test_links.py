"""Jaccard join, components, nearest neighbours and the pipeline against brute force and on odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import jaccard, neighbours, secrets
from millrace.llm.common import Scratch, documents
from millrace.llm.components import components

from .conftest import prose

SF = "/root/testdata/sf0.001"


class Sets:
    """Union by smallest member."""

    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# --- components


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)]
    sets = Sets({x for link in links for x in link})
    for a, b in links:
        sets.join(a, b)
    scratch = Scratch(spark, "t")
    got = components(scratch.stage(spark.createDataFrame(links, "a BIGINT, b BIGINT")), scratch)
    assert {r["node"]: r["component"] for r in got.collect()} == {x: sets.find(x) for x in sets.up}
    assert components(scratch.stage(spark.createDataFrame([], "a BIGINT, b BIGINT")), scratch).collect() == []


# --- Jaccard join


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    """doc_id to (size, component) over all pairs."""
    own = {i: shingle_set(t) for i, t in rows if i is not None}
    ids = sorted(own)
    sets = Sets(ids)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = own[a], own[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                sets.join(a, b)
    return {i: (len(own[i]), sets.find(i)) for i in ids}


def varied(base, rng, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def near_copies(seed):
    """Families of near copies around the limit, chains of them, exact copies, shared passages and short texts."""
    rng = random.Random(seed)
    shared = prose(999, 60)
    rows = []
    for family in range(6):
        base = prose(family, 80 + 20 * family)
        rows += [varied(base, rng, rng.randrange(6)) for _ in range(12)]
        text = base
        for _ in range(8):
            text = varied(text, rng, 1)
            rows.append(text)
        rows += [base, base.upper()]
    rows += [f"{prose(100 + i, 30)} {shared}" for i in range(20)] + [f"{shared} {i}" for i in range(10)]
    rows += ["", None, "  ", "a b", "A  b", "a b c d e", "a b c d e", "a b c d e f", "a b c d", "x " * 50, "x " * 60]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("options", [
    jaccard.Options(), jaccard.Options(common=2), jaccard.Options(sparse=0, rounds=3), jaccard.Options(rounds=0),
])
@pytest.mark.parametrize("seed", [1, 2])
def test_links_are_those_of_all_pairs(spark, seed, options, monkeypatch):
    if options.sparse == 0:  # force the sparse rounds
        monkeypatch.setattr(jaccard, "pairs_left", lambda lists: 10**9)
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(docs, options=options).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize("options", [jaccard.Options(common=2), jaccard.Options(common=10**6)])
def test_one_large_family_of_all_distances(spark, options):
    """Copies with few to many edits, words left out or added: positions may exclude no pair that links."""
    rng = random.Random(5)
    base, texts = prose(77, 150), []
    for i in range(140):
        words = varied(base, rng, rng.randrange(16)).split()
        start = rng.randrange(len(words))
        texts.append(" ".join(words[:start] + words[start + rng.randrange(25):] + prose(500 + i, rng.randrange(12)).split()))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(docs, options=options).collect()}
    want = brute_components(rows)
    assert got == want and 5 < len({c for _, c in want.values()}) < 140


def test_shingles_of_more_documents_come_later():
    own, common, many = np.array([1, 3, 5, 7, 9]), np.array([3, 5, 9]), np.array([8, 30, 8], dtype=np.int32)
    assert jaccard.rarest_first(own, common, many).tolist() == [1, 7, 3, 9, 5]
    assert jaccard.rarest_first(own, common[:0], many[:0]).tolist() == own.tolist()
    assert jaccard.rarest_first(own[:0], common, many).tolist() == []


def test_limit_is_exact():
    assert jaccard.enough(8, 9, 9, 80) and not jaccard.enough(7, 9, 9, 80)
    assert jaccard.enough(80, 100, 80, 80) and not jaccard.enough(79, 100, 79, 80)


def test_one_document_of_each_group_stays(spark):
    rows = near_copies(3)
    docs = spark.createDataFrame(rows + rows[:5] + [(None, "a b"), (None, None)], "doc_id BIGINT, text STRING")
    kept = jaccard.one_of_each(docs.withColumn("gone_id", F.lit(1)))
    ids = [r["doc_id"] for r in kept.collect()]
    want = {c for _, c in brute_components(rows).values()}
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2
    assert kept.columns == ["doc_id", "text", "gone_id"]


def test_jaccard_edges(spark, edges, empty):
    rows = jaccard.link_documents(edges).collect()
    want = brute_components([(r["doc_id"], r["text"]) for r in edges.select("doc_id", "text").collect()])
    assert len(rows) == 13 and all(
        (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] if r["doc_id"] is not None else r["component_id"] is None
        for r in rows
    )
    assert jaccard.link_documents(empty).collect() == []


# --- nearest neighbours


def brute_nearest(vectors, wanted, k=10):
    ids = np.array(sorted(vectors))
    data = np.array([vectors[i] for i in ids], dtype=np.float64)
    out = {}
    for q in wanted:
        d = np.sqrt(((data - np.array(vectors[q], dtype=np.float64)) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def test_neighbours_of_few_rows_are_exact(spark):
    rng = np.random.default_rng(1)
    vectors = {i: rng.normal(size=8).astype(np.float32).tolist() for i in range(300)}
    for i in range(40):  # copies of one vector, a query among them
        vectors[1000 + i] = vectors[100]
    odd = [(5000, None), (5001, []), (5002, [0.0] * 8), (5003, [1.0] * 7 + [None]), (5004, [math.nan] + [1.0] * 7),
           (5005, [math.inf] + [1.0] * 7), (5006, [1.0] * 3), (None, [1.0] * 8), (0, vectors[0])]
    df = spark.createDataFrame([*vectors.items(), *odd], "vec_id BIGINT, embedding ARRAY<FLOAT>").withColumn("node", F.lit(1))
    got = {}
    for r in neighbours.nearest_rows(df, lambda i: i % 100 == 0).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got.setdefault(r["query_id"], [])) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = brute_nearest(vectors, [i for i in vectors if i % 100 == 0])
    assert got.keys() == want.keys()
    assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want)
    assert all(np.allclose([d for _, d in got[q]], [d for _, d in want[q]], rtol=1e-12) for q in want)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (7, [1.0, 2.0]), (100, [1.0, 2.0])]])
def test_neighbours_of_hardly_any_rows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.nearest_rows(df, lambda i: i % 100 == 0).collect()]
    assert sorted(got) == ([] if len(rows) < 2 else [(0, 1, 7, 0.0), (0, 2, 100, 0.0), (100, 1, 0, 0.0), (100, 2, 7, 0.0)])


def recall(got, want):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) for q, near in want.items())
    return hit / sum(len(near) for near in want.values())


def test_recall_on_small_leaves(spark):
    """Leaves far smaller than the table, so that the graph and the walk have to find the neighbours."""
    rng = np.random.default_rng(2)
    vectors = {i: rng.normal(size=24).astype(np.float32).tolist() for i in range(4000)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id BIGINT, embedding ARRAY<FLOAT>")
    got = {}
    options = neighbours.Options(leaf=200)
    for r in neighbours.nearest_rows(df, lambda i: i % 100 == 0, options=options).collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert recall(got, brute_nearest(vectors, range(0, 4000, 100))) >= 0.9


def test_descent_and_walks_go_on_until_they_settle(spark):
    """From one round and one step, in narrow lists and pools, on poor first lists."""
    rng = np.random.default_rng(4)
    vectors = {i: rng.normal(size=16).astype(np.float32).tolist() for i in range(4000)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id BIGINT, embedding ARRAY<FLOAT>")
    got = {}
    options = neighbours.Options(trees=3, leaf=100, rounds=1, walks=0, opened=8)
    for r in neighbours.nearest_rows(df, lambda i: i % 100 == 0, options=options).collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert recall(got, brute_nearest(vectors, range(0, 4000, 100))) >= 0.9


@pytest.mark.parametrize("size", [3000, 9000])
def test_recall_at_two_sizes_with_the_production_options(spark, size):
    rng = np.random.default_rng(size)
    data = rng.normal(size=(size, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    got = {}
    for r in neighbours.nearest_rows(df, lambda i: i % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert recall(got, brute_nearest(dict(enumerate(data.tolist())), range(0, size, 100))) >= 0.95


def test_a_query_from_outside_walks_from_the_entries(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(2000, 12))
    scratch, options = Scratch(spark, "t"), neighbours.Options(leaf=300, walks=8)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id BIGINT, v ARRAY<DOUBLE>")
    vectors = scratch.stage(neighbours.valid_vectors(rows, "id", "v"))
    nodes = scratch.stage(neighbours.nodes_of(vectors, 2000, 11))
    shorts = scratch.stage(neighbours.short_vectors(nodes))
    graph = neighbours.build(nodes, shorts, 2000, scratch, options)
    outside = rng.normal(size=(30, 12))
    q, step = neighbours.quantised(outside)
    asked = [(10_000 + i, None, bytearray(s.tobytes() + row.tobytes())) for i, (s, row) in enumerate(zip(step.astype(np.float32), q))]
    queries = spark.createDataFrame(asked, "query BIGINT, home BIGINT, query_short BINARY")
    found = {}
    for r in neighbours.walk(queries, graph, shorts, scratch, options).collect():
        found.setdefault(r["query"] - 10_000, []).append((r["d"], r["node"]))
    hit = 0
    for i, v in enumerate(outside):
        want = set(np.argsort(((data - v) ** 2).sum(axis=1))[:10].tolist())
        hit += len(want & {n for _, n in sorted(found[i])[:10]})
    assert hit / 300 >= 0.9


def test_runs_keep_groups_whole():
    import pyarrow as pa

    keys = [1, 1, 2, 2, 2, 2, 2, 3, 4, 4]
    for cuts in ([3, 4, 6, 8], [1, 2, 3], [5], [], [2, 7]):
        parts = np.split(np.array(keys), cuts)
        batches = [pa.RecordBatch.from_arrays([pa.array(p)], names=["k"]) for p in parts]
        tables = [t.column("k").to_pylist() for t in neighbours.runs(iter(batches), "k")]
        assert sum(tables, []) == keys
        assert all(not set(a) & set(b) for i, a in enumerate(tables) for b in tables[:i])


def test_quantised_vectors_are_close():
    v = np.random.default_rng(4).normal(size=(50, 16))
    q, step = neighbours.quantised(v)
    raw = [s.tobytes() + row.tobytes() for s, row in zip(step.astype(np.float32), q)]
    assert np.abs(neighbours.restore(raw) - v).max() < 0.02


# --- pipeline


def test_pipeline_against_its_rules(spark):
    """Every stage on its own input: what goes and what stays, by brute force."""
    raw = documents(spark, SF)
    stages = dict(corpus_pipeline.STAGES)
    scratch = Scratch(spark, "t")
    good = scratch.stage(stages["quality"](spark, raw, SF))
    assert good.columns == raw.columns and 0 < good.count() < raw.count()
    unique = scratch.stage(stages["near_copies"](spark, good, SF))
    groups = brute_components([(r["doc_id"], r["text"]) for r in good.collect()])
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted({c for _, c in groups.values()})
    clean = scratch.stage(stages["secrets"](spark, unique, SF))
    texts = {r["doc_id"]: r["text"] for r in unique.collect()}
    for r in clean.collect():
        assert not secrets.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not secrets.base_spans(texts[r["doc_id"]]):
            assert r["text"] == texts[r["doc_id"]] or "<SECRET>" in r["text"]
    mixed = scratch.stage(stages["mixing"](spark, clean, SF))
    assert mixed.columns == raw.columns and {r["doc_id"] for r in mixed.collect()} <= set(texts)
    packed = stages["packing"](spark, mixed, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed.select("doc_id").collect()}
    assert sorted(corpus_pipeline.run(spark, SF).columns) == sorted(packed[0].asDict())


def test_pipeline_on_odd_rows(spark, edges, empty):
    for docs in (edges, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = Scratch(spark, "t").stage(out)
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
