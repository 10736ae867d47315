"""Similarity join of documents on word shingles by grouped prefixes.

A document is the set of its distinct 5-word shingles. Under one order of all shingles, two sets with a Jaccard
similarity of at least t share one of their first ``n - ceil(t n) + 1`` shingles, their prefixes. Documents with the
same set are one class; classes with the same prefix and size are one group. Groups that share a prefix shingle and
agree in size and position are candidate pairs: before the shingle they share at most what either has in lists, behind it
at most what either has left. They are expanded to their classes, and each pair is verified on its whole sets.

Only the components of the links are asked for, so pairs that are connected already need no test. While all candidate
pairs would be too many, a sparse round takes from every list of groups with a common shingle only each group with the
one before it in some order, and with one chosen group: the one that shares most, or in later rounds one drawn by lot.
That is linear in the lists. Then the pairs not yet connected are taken in full. For every pair the number of common
prefix shingles is counted, and with it the most that two whole sets can share; only pairs for which that suffices are
verified. No pair is ever dropped: each candidate pair is tested, excluded by that bound, or already connected.

The order of shingles takes those last that many documents share, the most frequent at the very end, counted over all
documents; each task hands in what it has at least twice. Any order is right; this one keeps passages that many documents
share out of the prefixes, or where all shingles of a document are common, takes the rarest of them.

Defined cases: a null or empty text, or one without words, has an empty set, is linked with nothing and is its own
component. A row without an id is linked with nothing and has no component. Rows that share an id are one document,
linked if any of its texts is. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, by_value, documents, free_prefix, scan, slices, small, small_batches, utf8
from .components import files_for, joined_components
from .hashing import WordHasher, shingles

by_value(__name__)


@dataclass(frozen=True)
class Options:
    """``common``: documents that make a shingle common; ``listed``: so many common shingles at most, the most frequent,
    are known to all tasks; a task counts so many distinct ones (``counted``) at once. These steer the work, not the result.
    ``sparse``: sparse rounds end when the pairs left are at most so many times the list entries, when a round has spared
    less than three tenths of them, or after ``rounds``."""

    size: int = 5
    percent: int = 80
    common: int = 8
    listed: int = 1_000_000
    counted: int = 2_000_000
    sparse: int = 2
    rounds: int = 12


def enough(shared: int, a: int, b: int, percent: int) -> bool:
    return 100 * shared >= percent * (a + b - shared)


def added_counts(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of two tables of sorted distinct keys and their counts."""
    at = np.searchsorted(keys, more)
    known = np.zeros(len(more), dtype=bool)
    if len(keys):
        known = keys[np.minimum(at, len(keys) - 1)] == more
        counts = counts.copy()
        counts[at[known]] += times[known]
    return np.insert(keys, at[~known], more[~known]), np.insert(counts, at[~known], times[~known])


def common_shingles(docs: DataFrame, options: Options) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that most documents share, sorted, and how many share each; bounded by ``listed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        shingle, many = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def batch(keep: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(shingle[keep]), pa.array(many[keep])], names=["shingle", "many"])

        for part in (part for whole in batches for part in slices(whole)):
            sets = [shingles(hasher(utf8(t)), options.size) for t in part.column(0).to_pylist()]
            found, times = np.unique(np.concatenate(sets), return_counts=True)
            shingle, many = added_counts(shingle, many, found, times)
            if len(shingle) > options.counted:
                yield batch(many > 1)
                shingle, many = shingle[:0], many[:0]
        yield batch(many > 1)

    small_batches(docs.sparkSession)
    counted = docs.select("body").mapInArrow(run, "shingle long, many long")
    counted = counted.groupBy("shingle").agg(F.sum("many").alias("many")).filter(F.col("many") >= options.common)
    top = counted.orderBy(F.desc("many"), "shingle").limit(options.listed).toArrow()
    shingle, many = top["shingle"].to_numpy(), np.minimum(top["many"].to_numpy(), np.iinfo(np.int32).max)
    order = np.argsort(shingle)
    return shingle[order], many[order].astype(np.int32)


def rarest_first(own: np.ndarray, common: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The sorted shingles of a document in the order of all shingles: by documents that share them, then by value."""
    if not len(common) or not len(own):
        return own
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    late = common[at] == own
    if not late.any():
        return own
    last = own[late][np.argsort(many[at[late]], kind="stable")]
    return np.concatenate([own[~late], last])


def digests(docs: DataFrame, common: np.ndarray, many: np.ndarray, options: Options) -> DataFrame:
    """id, size of the set, fingerprints of set and prefix, and the prefix itself."""

    def start():
        hasher = WordHasher()

        def fingerprint(values: np.ndarray) -> tuple[int, int]:
            raw = np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), dtype=np.int64)
            return int(raw[0]), int(raw[1])

        def work(read: dict) -> dict:
            out = {name: [] for name in ("n", "set_a", "set_b", "prefix_a", "prefix_b", "prefix")}
            for text in read["body"]:
                own = shingles(hasher(utf8(text)), options.size)
                n = len(own)
                length = n + options.percent * -n // 100 + 1 if n else 0
                prefix = rarest_first(own, common, many)[:length]
                values = (n, *fingerprint(own), *fingerprint(prefix), prefix)
                for name, value in zip(out, values):
                    out[name].append(value)
            return out

        return work

    added = dict.fromkeys(["n", "set_a", "set_b", "prefix_a", "prefix_b"], "long") | {"prefix": "array<long>"}
    return scan(docs, ["id"], added, start)


def sets_of(docs: DataFrame, wanted: DataFrame, options: Options) -> DataFrame:
    """The whole shingle sets of the documents whose ids are wanted, as bytes."""

    def start():
        hasher = WordHasher()

        def work(read: dict) -> dict:
            return {"shingles": [shingles(hasher(utf8(t)), options.size).tobytes() for t in read["body"]]}

        return work

    return scan(docs.join(wanted, "id", "left_semi"), ["id"], {"shingles": "binary"}, start)


def verified(pairs: DataFrame, docs: DataFrame, options: Options, scratch: Scratch) -> DataFrame:
    """The staged pairs (a, b) that link, by their whole sets."""
    ids = scratch.stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), files_for(pairs.count()))
    held = scratch.stage(sets_of(docs, small(ids, 16), options))
    left = held.select(F.col("id").alias("a"), F.col("shingles").alias("set_of_a"))
    right = held.select(F.col("id").alias("b"), F.col("shingles").alias("set_of_b"))
    both = pairs.join(left, "a").join(right, "b")

    def start():
        def work(read: dict) -> dict:
            linked = []
            for x, y in zip(read["set_of_a"], read["set_of_b"]):
                x, y = np.frombuffer(x, dtype=np.int64), np.frombuffer(y, dtype=np.int64)
                shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                linked.append(enough(shared, len(x), len(y), options.percent))
            return {"linked": linked}

        return work

    links = scratch.stage(scan(both, ["a", "b"], {"linked": "boolean"}, start).filter("linked").select("a", "b"))
    scratch.drop(ids, held)
    return links


def prefix_length(n: Column, percent: int) -> Column:
    return n - F.ceil(percent * n / F.lit(100.0)).cast("long") + 1


def sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def can_share(met: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether sets of n and m shingles that share ``met`` of their prefixes can be similar enough.

    Behind the prefix that ends first, a set has no more shingles left than its size less its prefix.
    """
    rest = F.greatest(n - prefix_length(n, percent), m - prefix_length(m, percent))
    return share_enough(met + rest, n, m, percent)


def prefix_lists(groups: DataFrame, percent: int) -> DataFrame:
    """shingle, gid, n, many_classes, known, rest, degree: the prefix shingles that at least two groups share.

    ``known`` is how many shingles before this one the group may share with others, as they are in lists, and ``rest`` how
    many it has from this one on: no set that meets it here shares more than both. Entries for which that is too little
    for the smallest set of the list are left out. ``degree`` is how often a group meets others in all its lists.
    """
    entries = groups.select("gid", "n", "many_classes", F.posexplode("prefix").alias("at", "shingle"))
    by, least = Window.partitionBy("shingle"), F.ceil(percent * F.col("n") / F.lit(100.0))
    met = entries.withColumn("many", F.count(F.lit(1)).over(by)).withColumn("smallest", F.min("n").over(by)).filter("many > 1")
    own = Window.partitionBy("gid")
    met = met.withColumn("known", F.row_number().over(own.orderBy("at")) - 1).withColumn("rest", F.col("n") - F.col("at"))
    met = met.withColumn("degree", F.sum("many").over(own))
    most, other = F.col("known") + F.col("rest"), F.greatest("smallest", least)
    return met.filter(share_enough(most, F.col("n"), other, percent)).drop("many", "smallest", "at")


def share_enough(most: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether sets of n and m shingles that share ``most`` are similar enough."""
    return (100 + percent) * most >= percent * (n + m)


LISTED = ("gid", "n", "component", "many_classes")


def apart(x: str, y: str) -> Column:
    """Different groups not known to be connected; of a group of several classes only one component is known."""
    several = F.col(f"{x}.many_classes") | F.col(f"{y}.many_classes")
    return (F.col(f"{x}.gid") != F.col(f"{y}.gid")) & ((F.col(f"{x}.component") != F.col(f"{y}.component")) | several)


def sparse_pairs(lists: DataFrame, shared: DataFrame, options: Options, turn: int) -> DataFrame:
    """Pairs along each list, where not connected: every group with the one before it, and with the chosen one.

    In the first round the order is the size and the chosen group the one of the highest degree; in the later ones
    both are drawn anew for every list, so that a group meets others in each of its lists.
    """
    lot = F.xxhash64("gid", "shingle", F.lit(turn))
    by = Window.partitionBy("shingle")
    before = by.orderBy(F.col("n"), F.col("gid")) if turn == 0 else by.orderBy(lot, F.col("gid"))
    rank = F.struct(F.col("degree") if turn == 0 else lot, F.col("gid"))
    own = F.struct(*LISTED)
    rows = lists.select(own.alias("x"), F.array(F.lag(own).over(before), F.max_by(own, rank).over(by)).alias("others"))
    met = rows.select("x", F.explode(F.array_distinct("others")).alias("y"))
    met = met.filter(F.col("y").isNotNull() & apart("x", "y") & sizes_fit(F.col("x.n"), F.col("y.n"), options.percent))
    ga, gb = F.least("x.gid", "y.gid"), F.greatest("x.gid", "y.gid")
    first = F.col("x.gid") == ga
    n, m = F.when(first, F.col("x.n")).otherwise(F.col("y.n")), F.when(first, F.col("y.n")).otherwise(F.col("x.n"))
    pairs = met.select(ga.alias("ga"), gb.alias("gb"), n.alias("n"), m.alias("m")).distinct()
    left = shared.select(F.col("gid").alias("ga"), F.col("shingles").alias("shingles_a"))
    right = shared.select(F.col("gid").alias("gb"), F.col("shingles").alias("shingles_b"))
    both = pairs.join(left, "ga").join(right, "gb")
    common = F.size(F.array_intersect("shingles_a", "shingles_b")).cast("long")
    return both.filter(can_share(common, F.col("n"), F.col("m"), options.percent)).select("ga", "gb")


def all_pairs_left(lists: DataFrame, options: Options) -> DataFrame:
    """All candidate pairs of groups in different components that can share enough."""
    most = F.least("x.known", "y.known") + F.least("x.rest", "y.rest")
    met = lists.alias("x").join(lists.alias("y"), F.col("x.shingle") == F.col("y.shingle")).filter(
        (F.col("x.gid") < F.col("y.gid")) & apart("x", "y") & sizes_fit(F.col("x.n"), F.col("y.n"), options.percent)
        & share_enough(most, F.col("x.n"), F.col("y.n"), options.percent)
    )
    counted = met.groupBy(F.col("x.gid").alias("ga"), F.col("y.gid").alias("gb"), F.col("x.n").alias("n"), F.col("y.n").alias("m"))
    counted = counted.agg(F.count(F.lit(1)).alias("met"))
    return counted.filter(can_share(F.col("met"), F.col("n"), F.col("m"), options.percent)).select("ga", "gb")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: Options = Options()) -> DataFrame:
    """id, n_shingles and component_id of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    digest = scratch.stage(digests(texts, *common_shingles(texts, options), options))
    labels = class_components(digest, texts, options, scratch)

    out = digest.join(labels, ["n", "set_a", "set_b"], "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def class_components(digest: DataFrame, texts: DataFrame, options: Options, scratch: Scratch) -> DataFrame:
    """n, set_a, set_b and component of every class of equal sets."""
    files = files_for(digest.count(), 5_000, 16)
    named = digest.filter("id IS NOT NULL AND n > 0")
    group = Window.partitionBy("n", "prefix_a", "prefix_b")
    classes = named.groupBy("n", "set_a", "set_b").agg(
        F.min("id").alias("cid"), F.first("prefix_a").alias("prefix_a"), F.first("prefix_b").alias("prefix_b")
    )
    classes = scratch.stage(classes.select(
        "n", "set_a", "set_b", "cid", F.min("cid").over(group).alias("gid"),
        (F.count(F.lit(1)).over(group) > 1).alias("many_classes"),
    ), files)
    several = scratch.stage(classes.filter("many_classes").select("gid", "cid"), files)
    gids = classes.filter("cid = gid").select(F.col("gid").alias("id"), F.col("n").alias("size"), "many_classes")
    groups = named.join(small(gids, 24), "id").filter("n = size").select(F.col("id").alias("gid"), "n", "many_classes", "prefix")
    lists = scratch.stage(prefix_lists(groups, options.percent), files)
    entries = lists.count()
    shared = None

    tested, known, last, left = None, None, False, float("inf")
    for turn in range(options.rounds + 1):
        labelled = lists.withColumn("component", F.col("gid"))
        if known is not None:
            label = small(known.select(F.col("node").alias("gid"), F.col("component").alias("label")), 24)
            labelled = lists.join(label, "gid", "left").withColumn("component", F.coalesce("label", "gid")).drop("label")
        before, left = left, pairs_left(labelled)
        # Pairs that are no links stay, however many rounds there are: without progress the rest is taken in full.
        last = turn == options.rounds or left <= max(400_000, options.sparse * entries) or 10 * left > 7 * before
        if not last and shared is None:  # the shingles that a group shares with any other: at most its prefix
            shared = scratch.stage(lists.groupBy("gid").agg(F.collect_list("shingle").alias("shingles")), files)
        pairs = all_pairs_left(labelled, options) if last else sparse_pairs(labelled, shared, options, turn)
        pairs = expand(pairs, several, inside=known, whole=last)
        if tested is not None:
            pairs = pairs.join(small(tested, 32), ["a", "b"], "left_anti")
        pairs = scratch.stage(pairs, files)
        found = verified(pairs, texts, options, scratch)
        tested = pairs if tested is None else scratch.stage(tested.union(pairs), files)
        known = joined_components(known, found, scratch)
        scratch.drop(found)
        if last:
            break
    label = small(known.select(F.col("node").alias("cid"), F.col("component").alias("label")), 24)
    out = classes.join(label, "cid", "left").select("n", "set_a", "set_b", F.coalesce("label", "cid").alias("component"))
    out = scratch.stage(out, files)
    scratch.drop(lists, tested, several, classes, *([shared] if shared is not None else []))
    return out


def pairs_left(lists: DataFrame) -> int:
    """Pairs of groups in one list but in different components, summed over the lists."""
    each = lists.groupBy("shingle", "component").agg(F.count(F.lit(1)).cast("double").alias("k"))
    left = each.groupBy("shingle").agg(((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("left"))
    return int(left.agg(F.coalesce(F.sum("left"), F.lit(0.0)).alias("s")).first()["s"])


def expand(pairs: DataFrame, several: DataFrame, inside: DataFrame | None, whole: bool) -> DataFrame:
    """Pairs of groups as pairs of their classes, with the pairs inside groups of several classes.

    Such groups have one prefix and size but different sets. Their classes are first compared along the group, in the
    last round with all classes of the group that are not connected yet.
    """
    rows = several.count()
    if not rows:
        return pairs.select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    member_a = small(several.select(F.col("gid").alias("ga"), F.col("cid").alias("class_a")), 24, rows)
    member_b = small(several.select(F.col("gid").alias("gb"), F.col("cid").alias("class_b")), 24, rows)
    out = pairs.join(member_a, "ga", "left").join(member_b, "gb", "left")
    out = out.select(F.coalesce("class_a", "ga").alias("a"), F.coalesce("class_b", "gb").alias("b"))
    if whole:
        own = several.withColumn("component", F.col("cid"))
        if inside is not None:
            label = small(inside.select(F.col("node").alias("cid"), F.col("component").alias("label")), 24)
            own = several.join(label, "cid", "left").select("gid", "cid", F.coalesce("label", "cid").alias("component"))
        met = own.alias("x").join(own.alias("y"), "gid").filter("x.cid < y.cid AND x.component <> y.component")
        within = met.select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
    else:
        by = Window.partitionBy("gid").orderBy("cid")
        lined = several.select("cid", F.array(F.lag("cid").over(by), F.first("cid").over(by)).alias("others"))
        within = lined.select(F.explode("others").alias("a"), F.col("cid").alias("b")).filter("a IS NOT NULL")
    ordered = out.union(within).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.distinct()


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: Options = Options()) -> DataFrame:
    """The documents that are the first of their component, with all columns; rows without an id stay.

    The ids of the others are joined by a broadcast only if they are few, else by a shuffle.
    """
    scratch = Scratch(docs.sparkSession, "unique")
    found = link_documents(docs.select(id_col, text_col), id_col, text_col, options)
    own = free_prefix(docs)
    gone_id, twice_id = f"{own}gone", f"{own}twice"
    gone = scratch.stage(found.filter(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias(gone_id)).distinct())
    kept = docs.join(small(gone, 16), docs[id_col] == gone[gone_id], "left_anti")
    ids = docs.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias(twice_id)).agg(F.count(F.lit(1)).alias("rows"))
    twice = scratch.stage(ids.filter("rows > 1").select(twice_id))
    if not twice.take(1):
        return kept
    single = kept.join(small(twice, 16), kept[id_col] == twice[twice_id], "left_anti")
    repeated = kept.join(small(twice, 16), kept[id_col] == twice[twice_id], "left_semi")
    # Of rows that share an id the one with the smallest checksum of all columns stays, whichever task runs again.
    lot = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in docs.columns])
    numbered = repeated.withColumn(f"{own}lot", F.struct(lot, *[F.col(f"`{c}`") for c in (text_col,)]))
    first = Window.partitionBy(id_col).orderBy(f"{own}lot")
    chosen = numbered.withColumn(f"{own}nth", F.row_number().over(first)).filter(F.col(f"{own}nth") == 1)
    return single.union(chosen.select(*[F.col(f"`{c}`") for c in docs.columns]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(documents(spark, sf_dir).select("doc_id", "text"))
