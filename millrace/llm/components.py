"""Connected components of a table of links, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small


def components(links: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) for all nodes with a link; ``links`` is staged, with columns a and b.

    Each round gives every node the smallest label around it and then the label of that label, so that chains shrink by
    doubling. Labels are summed up before the shuffle, so a node with very many links is no hot group. Labels
    only fall, so their sum tells when nothing changes any more.
    """
    files = files_for(2 * links.count())
    ways = F.explode(F.array(*[F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in (("a", "b"), ("b", "a"))]))
    around = scratch.stage(links.select(ways.alias("e")).select("e.node", "e.other"), files)
    labels = around.groupBy("node").agg(F.least("node", F.min("other")).alias("label"))
    labels = scratch.stage(labels, files)
    nodes, total = _size(labels)
    for _ in range(rounds):
        known = small(labels.select(F.col("node").alias("other"), "label"), 24, nodes)
        seen = around.join(known, "other").select("node", "label").union(labels.select("node", "label"))
        lowered = scratch.stage(seen.groupBy("node").agg(F.min("label").alias("label")), files)
        farther = small(lowered.select(F.col("node").alias("label"), F.col("label").alias("farther")), 24, nodes)
        new = scratch.stage(lowered.join(farther, "label").select("node", F.col("farther").alias("label")), files)
        scratch.drop(labels, lowered)
        labels, before = new, total
        _, total = _size(labels)
        if total == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    scratch.drop(around)
    return labels.select("node", F.col("label").alias("component"))


def joined_components(known: DataFrame | None, links: DataFrame, scratch: Scratch) -> DataFrame:
    """The components after more links: node, component, staged.

    Only the links between components known so far matter, so the work is on the graph of these, which shrinks.
    """
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if known is None:
        found = components(links, scratch)
        return scratch.stage(found, files_for(links.count()))
    rows = known.count()
    label = lambda end: small(known.select(F.col("node").alias(end), F.col("component").alias(f"{end}_label")), 24, rows)
    between = links.join(label("a"), "a", "left").join(label("b"), "b", "left").select(
        F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")
    )
    between = between.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    between = scratch.stage(between, files_for(links.count()))
    moved = components(between, scratch).select(F.col("node").alias("component"), F.col("component").alias("moved"))
    new = nodes.join(small(known.select("node"), 16, rows), "node", "left_anti").withColumn("component", F.col("node"))
    everyone = known.unionByName(new).join(small(moved, 24), "component", "left")
    out = scratch.stage(everyone.select("node", F.coalesce("moved", "component").alias("component")), files_for(rows))
    scratch.drop(between, known)
    return out


def files_for(rows: int, rows_per_file: int = 100_000, least: int = 8) -> int:
    """How many files a table of so many short rows is worth."""
    return max(least, rows // rows_per_file)


def _size(labels: DataFrame) -> tuple[int, int]:
    row = labels.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("decimal(38,0)")).alias("total")).first()
    return row["n"], int(row["total"] or 0)
