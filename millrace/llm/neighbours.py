"""Approximate nearest neighbours by NN-descent.

Equal vectors are one node. The first lists of neighbours come from exact searches inside the leaves of a few random
trees. Then, round by round, every node brings its neighbours and some of those that point to it together in a Spark
join, all pairs among these few are measured, and each node keeps the nearest it has seen: neighbours of neighbours. The
rounds end when hardly an entry of the lists changes any more. A query walks the finished graph greedily: it opens the
nearest nodes it knows, measures their neighbours and goes on with the nearest of all, until a step changes the
nearest of no query. Vectors of eight bits serve for walking, the final candidates are measured in double
precision on the original vectors.

Defined cases: vectors that are null, empty, zero, of another length than most, or that hold null or non-finite
components take no part. Rows that share an id and a vector count once. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, Scratch, buckets, by_value, documents, scan, small

by_value(__name__)


@dataclass(frozen=True)
class Options:
    """``leaf``: nodes of a tree's leaf; ``keep``: neighbours of a node; ``near`` and ``back``: neighbours, and nodes
    pointing to it, that a node brings together; ``rounds``: of descent, at least, and ``settled``: share of changed list
    entries below which it ends; ``walks``: steps of a walk after the first, at least; ``pool``: nodes a query remembers, ``opened``: opened per round;
    ``paths``: links against their direction that a walk may take from a node; ``splits``: nodes, at most, from whose
    sample the trees take their cuts."""

    trees: int = 10
    leaf: int = 1500
    keep: int = 32
    near: int = 16
    back: int = 16
    rounds: int = 4
    settled: float = 0.001
    paths: int = 32
    pool: int = 240
    opened: int = 48
    walks: int = 6
    entries: int = 16
    splits: int = 20_000
    seed: int = 11


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and the vector as the bytes of 64-bit numbers, of the most common length."""
    some = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).filter(
        "id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0"
    )
    sizes = some.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    wanted = some.filter(F.size("vector") == (sizes[0]["n"] if sizes else 0))

    def start():
        def work(read: dict) -> dict:
            at, out = [], []
            for i, vector in enumerate(read["vector"]):
                if None not in vector:
                    v = np.array(vector, dtype=np.float64) + 0.0  # no negative zero
                    if np.isfinite(v).all() and v.any():
                        at.append(i)
                        out.append(v.tobytes())
            return {ROW: at, "raw": out}

        return work

    return scan(wanted, ["id"], {"raw": "binary"}, start)


def nodes_of(vectors: DataFrame, rows: int, members: int) -> DataFrame:
    """node (smallest id), raw, and its ``members`` smallest ids; a vector that very many rows share is cut in buckets."""
    salted = vectors.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(buckets(rows))))
    by_part = Window.partitionBy("raw", "part").orderBy("id")
    first = salted.dropDuplicates(["raw", "id"]).withColumn("k", F.row_number().over(by_part)).filter(F.col("k") <= members)
    ranked = first.withColumn("k", F.row_number().over(Window.partitionBy("raw").orderBy("id"))).filter(F.col("k") <= members)
    return ranked.groupBy("raw").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("members"))


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows as 8-bit numbers and their steps."""
    step = np.abs(v).max(axis=1) / 127
    return np.round(v / step[:, None]).astype(np.int8), step


def matrix(column: list[bytes], kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=kind).reshape(len(column), -1)


def short_vectors(nodes: DataFrame) -> DataFrame:
    """node and its 8-bit vector: the step as a 32-bit number, then the components."""

    def start():
        def work(read: dict) -> dict:
            if not read["raw"]:
                return {"short": []}
            q, step = quantised(matrix(read["raw"]))
            return {"short": [s.tobytes() + row.tobytes() for s, row in zip(step.astype(np.float32), q)]}

        return work

    return scan(nodes.select("node", "raw"), ["node"], {"short": "binary"}, start)


def restore(column: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), -1)
    step = np.ascontiguousarray(raw[:, :4]).view(np.float32)
    return raw[:, 4:].view(np.int8).astype(np.float32) * step


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y, also for stacks of matrices."""
    cross = x @ np.swapaxes(y, -1, -2)
    return np.maximum((x * x).sum(-1)[..., :, None] + (y * y).sum(-1)[..., None, :] - 2 * cross, 0)


def tree_cuts(nodes: DataFrame, rows: int, options: Options) -> tuple[np.ndarray, np.ndarray]:
    """Directions and medians of every level of every tree, from a bounded sample of nodes."""
    depth = max(0, int(np.ceil(np.log2(max(rows, 1) / options.leaf))))
    sample = nodes.select("raw").orderBy(F.xxhash64("node")).limit(options.splits).toArrow().column(0).to_pylist()
    rng = np.random.default_rng(options.seed)
    v = matrix(sample)
    directions = rng.normal(size=(options.trees, depth, v.shape[1]))
    return directions, np.median(np.einsum("tdk,nk->tdn", directions, v), axis=2)


def leaves(shorts: DataFrame, cuts: tuple[np.ndarray, np.ndarray], options: Options) -> DataFrame:
    """tree, leaf, part, node, short: every node once per tree; leaves that are too large are cut by hash."""
    directions, medians = cuts

    def start():
        def work(read: dict) -> dict:
            n = len(read["short"])
            if not n:
                return {ROW: [], "tree": [], "leaf": []}
            side = np.einsum("tdk,nk->ntd", directions, restore(read["short"])) > medians[None]
            code = (side * (1 << np.arange(medians.shape[1]))).sum(axis=2)
            return {ROW: np.repeat(np.arange(n), options.trees), "tree": np.tile(np.arange(options.trees), n), "leaf": code.ravel()}

        return work

    placed = scan(shorts, ["node", "short"], {"tree": "long", "leaf": "long"}, start)
    codes = scan(shorts, ["node", "short"], {"tree": "long", "leaf": "long"}, start).groupBy("tree", "leaf").count()
    parts = F.ceil(F.col("count") / (2 * options.leaf)).alias("parts")
    sized = placed.join(codes.select("tree", "leaf", parts), ["tree", "leaf"])
    return sized.withColumn("part", F.pmod(F.xxhash64("node", "tree"), F.col("parts"))).drop("parts")


LISTS = "node long, near array<long>, far array<double>"


def lists_batch(node: np.ndarray, ends: np.ndarray, near: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(ends, pa.int32())
    arrays = [
        pa.array(node, pa.int64()),
        pa.ListArray.from_arrays(offsets, pa.array(near, pa.int64())),
        pa.ListArray.from_arrays(offsets, pa.array(far, pa.float64())),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["node", "near", "far"])


def leaf_lists(placed: DataFrame, options: Options) -> DataFrame:
    """Exact nearest neighbours inside every leaf."""
    keep = options.keep

    def search(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        v = restore(table.column("short").to_pylist())
        k = min(keep, len(node) - 1)
        near, far = [], []
        for at in range(0, len(node), 512):
            d = squared(v[at : at + 512], v)
            d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
            best = np.argpartition(d, max(k - 1, 0), axis=1)[:, :k]
            near.append(node[best])
            far.append(np.take_along_axis(d, best, axis=1))
        near, far = np.concatenate(near), np.concatenate(far)
        return pa.Table.from_batches([lists_batch(node, np.arange(len(node) + 1) * k, near.ravel(), far.ravel())])

    return placed.groupBy("tree", "leaf", "part").applyInArrow(search, LISTS)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys, from the batches of a partition sorted by the key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], side="left"))  # the last run may go on
        if held and (cut > 0 or held[-1].column(key)[-1].as_py() != keys[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
            batch = batch.slice(cut)
        elif not held and cut > 0:
            yield pa.Table.from_batches([batch.slice(0, cut)])
            batch = batch.slice(cut)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def flat_lists(table: pa.Table, owner: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, neighbour and distance of every list entry."""
    near = table.column("near").combine_chunks()
    far = table.column("far").combine_chunks()
    size = np.diff(near.offsets.to_numpy())
    own = np.repeat(table.column(owner).to_numpy(), size)
    return own, near.flatten().to_numpy(), far.flatten().to_numpy()


def nearest(own: np.ndarray, near: np.ndarray, far: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """The ``keep`` nearest distinct neighbours of every owner: owners, ends of their lists, lists."""
    order = np.lexsort((near, own))
    own, near, far = own[order], near[order], far[order]
    new = np.ones(len(own), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (near[1:] != near[:-1])
    far = np.minimum.reduceat(far, np.flatnonzero(new)) if len(own) else far
    own, near = own[new], near[new]
    order = np.lexsort((near, far, own))
    own, near, far = own[order], near[order], far[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.r_[starts, len(own)]))
    chosen = rank < keep
    owners = own[starts]
    ends = np.r_[0, np.cumsum(np.minimum(np.diff(np.r_[starts, len(own)]), keep))]
    return owners, ends, near[chosen], far[chosen]


def merged(lists: DataFrame, keep: int) -> DataFrame:
    """One list per node, from any number of lists; a node gets at most a bounded number of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "node"):
            own, near, far = flat_lists(table, "node")
            other = own != near
            yield lists_batch(*nearest(own[other], near[other], far[other], keep))

    return lists.repartition("node").sortWithinPartitions("node").mapInArrow(run, LISTS)


def pointing_back(edges: DataFrame, most: int) -> DataFrame:
    """node, other: for every node the ``most`` nodes in whose lists it stands first; ``edges``: node, at, other.

    A node that very many point to is cut in parts first.
    """
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(8)))
    by_salt = Window.partitionBy("other", "salt").orderBy("at", "node")
    few = salted.withColumn("k", F.row_number().over(by_salt)).filter(F.col("k") <= most)
    few = few.withColumn("k", F.row_number().over(Window.partitionBy("other").orderBy("at", "node"))).filter(F.col("k") <= most)
    return few.select(F.col("other").alias("node"), F.col("node").alias("other"))


def meetings(graph: DataFrame, options: Options) -> DataFrame:
    """pivot, node, worst: which nodes meet at which, and the distance that a new neighbour must beat."""
    worst = F.when(F.size("far") < options.keep, F.lit(float("inf"))).otherwise(F.element_at("far", -1))
    edges = graph.select("node", F.posexplode("near").alias("at", "other")).filter(F.col("at") < options.near)
    back = pointing_back(edges, options.back)
    met = edges.select(F.col("node").alias("pivot"), F.col("other").alias("node")).union(
        back.select(F.col("node").alias("pivot"), F.col("other").alias("node"))
    ).distinct()
    return met.join(graph.select("node", worst.alias("worst")), "node")


def paths(graph: DataFrame, options: Options) -> DataFrame:
    """node, near: where a walk can go from a node, along the links and, as nodes that few point to would be out of
    reach, against them."""
    edges = graph.select("node", F.posexplode("near").alias("at", "other"))
    back = pointing_back(edges, options.paths)
    return edges.select("node", "other").union(back).groupBy("node").agg(F.collect_set("other").alias("near"))


def descend(met: DataFrame, shorts: DataFrame, options: Options) -> DataFrame:
    """New neighbours from every meeting: all pairs of the few nodes at a pivot, as far as they are near enough."""
    size, keep = options.near + options.back, options.keep // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "pivot"):
            pivot = table.column("pivot").to_numpy()
            starts = np.flatnonzero(np.r_[True, pivot[1:] != pivot[:-1]])
            lengths = np.diff(np.r_[starts, len(pivot)])
            row = np.repeat(np.arange(len(starts)), lengths)
            place = np.arange(len(pivot)) - np.repeat(starts, lengths)
            v = restore(table.column("short").to_pylist())
            ids, worst = table.column("node").to_numpy(), table.column("worst").to_numpy()
            width = min(size, int(lengths.max()))
            for first in range(0, len(starts), 1000):
                part = (row >= first) & (row < first + 1000)
                r, p = row[part] - first, place[part]
                count = int(r.max()) + 1
                block = np.zeros((count, width, v.shape[1]), dtype=np.float32)
                node = np.full((count, width), -1, dtype=np.int64)
                limit = np.zeros((count, width))
                block[r, p], node[r, p], limit[r, p] = v[part], ids[part], worst[part]
                filled = np.zeros((count, width), dtype=bool)
                filled[r, p] = True
                d = squared(block, block)
                d[~filled[:, :, None] | ~filled[:, None, :]] = np.inf
                d[:, np.arange(width), np.arange(width)] = np.inf
                k = min(keep, width)
                best = np.argpartition(d, k - 1, axis=2)[:, :, :k]
                far = np.take_along_axis(d, best, axis=2)
                near = np.take_along_axis(np.broadcast_to(node[:, None, :], d.shape), best, axis=2)
                good = np.isfinite(far) & (far < limit[:, :, None])
                own = np.broadcast_to(node[:, :, None], far.shape)[good]
                if len(own):
                    yield lists_batch(*nearest(own, near[good], far[good], options.keep))

    rows = met.join(shorts, "node").select("pivot", "node", "worst", "short")
    return rows.repartition("pivot").sortWithinPartitions("pivot", "node").mapInArrow(run, LISTS)


def build(nodes: DataFrame, shorts: DataFrame, rows: int, scratch: Scratch, options: Options = Options()) -> DataFrame:
    """The neighbour graph: node, near (ids, nearest first), far (squared distances)."""
    placed = leaves(shorts, tree_cuts(nodes, rows, options), options)
    graph = scratch.stage(merged(leaf_lists(placed, options), options.keep))
    done, share = 0, 1.0
    while done < options.rounds or share >= options.settled:
        better = descend(meetings(graph, options), shorts, options)
        new = scratch.stage(merged(graph.union(better), options.keep))
        share = changed_share(graph, new)
        scratch.drop(graph)
        graph, done = new, done + 1
    return graph


def changed_share(before: DataFrame, after: DataFrame) -> float:
    """Share of the entries of all lists that a round has brought in. Lists only get nearer, so it ends at 0."""
    old = before.select("node", F.col("near").alias("old"))
    fresh = F.size(F.array_except("near", F.coalesce("old", F.array().cast("array<long>"))))
    r = after.select("node", "near").join(old, "node", "left").agg(F.sum(fresh).alias("fresh"), F.sum(F.size("near")).alias("n")).first()
    return r["fresh"] / r["n"] if r["n"] else 0.0


def measured(pairs: DataFrame, queries: DataFrame, shorts: DataFrame) -> DataFrame:
    """Squared distance of every pair of query and node, on the 8-bit vectors: query, node, d."""

    def start():
        def work(read: dict) -> dict:
            if not read["short"]:
                return {"d": []}
            difference = restore(read["short"]) - restore(read["query_short"])
            return {"d": (difference.astype(np.float64) ** 2).sum(axis=1)}

        return work

    rows = pairs.join(shorts, "node").join(queries, "query").select("query", "node", "short", "query_short")
    return scan(rows, ["query", "node"], {"d": "double"}, start)


def walk(
    queries: DataFrame, graph: DataFrame, shorts: DataFrame, scratch: Scratch, options: Options = Options(), k: int = 10
) -> DataFrame:
    """query, node, d: the nearest nodes that greedy search finds; it ends with a step that changes the nearest ``k`` of no
    query. ``queries``: query, query_short, and home, the node
    of an equal vector, if there is one; other queries start at a few entry nodes."""
    entries = [r["node"] for r in graph.select("node").orderBy(F.xxhash64("node")).limit(options.entries).collect()]
    starts = F.coalesce(F.array("home"), F.array(*[F.lit(e).cast("long") for e in entries]))
    starts = F.when(F.col("home").isNull(), F.array(*[F.lit(e).cast("long") for e in entries])).otherwise(starts)
    vectors = queries.select("query", "query_short")
    begin = queries.select("query", F.explode(starts).alias("node"))
    roads = scratch.stage(paths(graph, options))
    held = pool = scratch.stage(measured(begin, vectors, shorts).withColumn("opened", F.lit(False)))
    done, changed = 0, True
    while done <= options.walks or changed:
        rank = F.row_number().over(Window.partitionBy("query", "opened").orderBy("d", "node"))
        marked = pool.withColumn("now", ~F.col("opened") & (rank <= options.opened))
        seen = marked.select("query", "node", "d", (F.col("opened") | F.col("now")).alias("opened"), F.lit(False).alias("fresh"))
        around = marked.filter("now").select("query", "node").join(roads, "node").select("query", F.explode("near").alias("node"))
        fresh = around.distinct().join(pool.select("query", "node"), ["query", "node"], "left_anti")
        found = seen.union(measured(fresh, vectors, shorts).select("*", F.lit(False).alias("opened"), F.lit(True).alias("fresh")))
        best = F.row_number().over(Window.partitionBy("query").orderBy("d", "node"))
        new = scratch.stage(found.withColumn("k", best).filter(F.col("k") <= max(options.pool, k)))
        changed = new.filter((F.col("k") <= k) & F.col("fresh")).limit(1).count() > 0
        scratch.drop(held)
        held, pool, done = new, new.select("query", "node", "d", "opened"), done + 1
    scratch.drop(roads)
    return pool.select("query", "node", "d")


def nearest_rows(
    rows: DataFrame, wanted, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", options: Options = Options()
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) for the rows whose id meets the condition ``wanted``."""
    scratch = Scratch(rows.sparkSession, "neighbours")
    vectors = scratch.stage(valid_vectors(rows, id_col, vector_col))
    count = vectors.count()
    nodes = scratch.stage(nodes_of(vectors, count, k + 1))
    n = nodes.count()
    asked = vectors.filter(wanted(F.col("id"))).dropDuplicates(["id", "raw"]).select(F.col("id").alias("query_id"), "raw")
    asked = scratch.stage(asked.join(nodes.select("raw", F.col("node").alias("home")), "raw").select("query_id", "home"))
    if n < 2:
        found = asked.select(F.col("home").alias("query"), F.col("home").alias("node")).distinct()
    else:
        shorts = scratch.stage(short_vectors(nodes))
        graph = build(nodes, shorts, n, scratch, options)
        queries = asked.select("home").distinct().join(shorts, F.col("home") == F.col("node"))
        queries = scratch.stage(queries.select(F.col("home").alias("query"), "home", F.col("short").alias("query_short")))
        found = walk(queries, graph, shorts, scratch, options, k + 1).select("query", "node")
        scratch.drop(graph, shorts)
    best = Window.partitionBy("query").orderBy("score", "node")
    exact = distances(scratch.stage(found), nodes).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    listed = exact.join(nodes.select("node", "members"), "node").select("query", "score", F.explode("members").alias("vec_id"))
    each = asked.join(listed, asked["home"] == listed["query"]).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def distances(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """query, node, score: the distance in double precision on the original vectors."""

    def start():
        def work(read: dict) -> dict:
            if not read["raw"]:
                return {"score": []}
            difference = matrix(read["raw"]) - matrix(read["query_raw"])
            return {"score": np.sqrt((difference**2).sum(axis=1))}

        return work

    own = nodes.select(F.col("node").alias("query"), F.col("raw").alias("query_raw"))
    rows = pairs.join(nodes.select("node", "raw"), "node").join(own, "query")
    return scan(rows.select("query", "node", "raw", "query_raw"), ["query", "node"], {"score": "double"}, start)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_rows(documents(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)
