"""Resharding by minimum-cost flow.

From the bytes in the old shards and the capacities of the new ones, a transportation problem says how many bytes go
from where to where so that as few as possible move. Its flows become cuts through the key order of the old shards, so
that whole blocks of neighbouring rows travel together. A bounded last step evens out what the cuts through whole rows
left. The placement is a function of the row alone, and only shards that gain or lose rows are written again.

Law: ``bytes``. The sizes of the shards are as near as whole documents allow; ``grown_shard`` belongs to another law
and is null.

Defined cases: a null or empty text has 16 bytes and checksum 0. Repeated rows share a key and stay together; rows with
a null id are told apart by their text. Columns named like the placement's own are kept by ``rewrite`` under the prefix
``doc_``. An empty table gives no files and an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..workspace import fresh_dir
from .common import Scratch, documents, free_prefix, number_within

NEW_SHARDS = 40
OLD_SHARDS = 32
# Each old shard is seen as so many blocks of neighbouring keys, at most; the driver gets one row per block.
MOST_BLOCKS = 1024
ROWS_PER_BLOCK = 2_000
OWN = ("shard", "shard_part")


def text_bytes(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 16).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def minimum_cost_flow(supply: list[int], capacity: list[int], cost: np.ndarray) -> dict[tuple[int, int], int]:
    """Flows from rows to columns of least cost, by successive cheapest paths. All supply must fit.

    Each path uses up a row, a column or an earlier flow, so the work depends on the number of shards only.
    """
    rows, columns = len(supply), len(capacity)
    left, room = list(supply), list(capacity)
    flow = np.zeros((rows, columns), dtype=object)
    while any(left):
        distance = [0 if left[i] else np.inf for i in range(rows)] + [np.inf] * columns
        parent = [-1] * (rows + columns)
        changed = True
        while changed:  # Bellman-Ford, as arcs back have negative cost
            changed = False
            for i in range(rows):
                if distance[i] == np.inf:
                    continue
                for j in range(columns):
                    if distance[i] + cost[i, j] < distance[rows + j] - 1e-9:
                        distance[rows + j], parent[rows + j], changed = distance[i] + cost[i, j], i, True
            for j in range(columns):
                if distance[rows + j] == np.inf:
                    continue
                for i in range(rows):
                    if flow[i, j] and distance[rows + j] - cost[i, j] < distance[i] - 1e-9:
                        distance[i], parent[i], changed = distance[rows + j] - cost[i, j], rows + j, True
        end = min((j for j in range(columns) if room[j]), key=lambda j: distance[rows + j])
        path, at = [], rows + end
        while at != -1:
            path.append(at)
            at = parent[at]
        path.reverse()
        amount = min(left[path[0]], room[end])
        for a, b in zip(path, path[1:]):
            if a >= rows:
                amount = min(amount, flow[b, a - rows])
        for a, b in zip(path, path[1:]):
            if a < rows:
                flow[a, b - rows] += amount
            else:
                flow[b, a - rows] -= amount
        left[path[0]] -= amount
        room[end] -= amount
    return {(i, j): int(flow[i, j]) for i in range(rows) for j in range(columns) if flow[i, j]}


def near_equal(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def moving_cost(old: int, new: int) -> np.ndarray:
    """A byte that stays in its shard costs nothing, any other one."""
    cost = np.ones((old, new))
    np.fill_diagonal(cost, 0.0)
    return cost


@dataclass
class Placement:
    """What decides a row's shard: the cuts through the key order of every old shard, and single rows moved after."""

    old_shards: int
    new_shards: int
    cuts: pd.DataFrame  # old, low, high, shard: keys from low to high, both included
    moves: pd.DataFrame  # key, shard
    flow: dict[tuple[int, int], int]
    affected: list[int]

    def apply(self, df: DataFrame, old: Column, key: Column) -> DataFrame:
        """Adds ``shard``. Both tables are bounded by the numbers of shards, whatever the rows."""
        spark = df.sparkSession
        own = free_prefix(df)
        cuts = spark.createDataFrame(self.cuts, f"{own}cut int, {own}low long, {own}high long, {own}shard int")
        moves = spark.createDataFrame(self.moves, f"{own}move long, {own}target int")
        keyed = df.withColumns({f"{own}old": old, f"{own}key": key})
        place = F.col(f"{own}key")
        inside = (F.col(f"{own}old") == F.col(f"{own}cut")) & place.between(F.col(f"{own}low"), F.col(f"{own}high"))
        out = keyed.join(F.broadcast(cuts), inside, "left").join(F.broadcast(moves), place == F.col(f"{own}move"), "left")
        shard = F.coalesce(F.col(f"{own}target"), F.col(f"{own}shard")).cast("int")
        return out.select(*[F.col(f"`{c}`") for c in df.columns], shard.alias("shard"))


def row_key(id_col: Column, text: Column) -> Column:
    """Place of a row in its old shard, from 0 to 2^63 - 1."""
    return F.xxhash64(id_col, text_crc(text)).bitwiseAND(F.lit(2**63 - 1))


def even_out(sizes: dict[int, int], rows: pd.DataFrame, new: int, steps: int = 4000) -> dict[int, int]:
    """Single rows to move so that the sizes come closer: key to shard.

    ``rows`` (key, size, shard) are a few of every size in every shard. Each step takes the largest and the smallest
    shard and moves the row, or exchanges the pair of rows, that levels the two best.
    """
    total = [sizes.get(j, 0) for j in range(new)]
    held = {j: {int(k): int(s) for k, s in zip(g["key"], g["size"])} for j, g in rows.groupby("shard")}
    for j in range(new):
        held.setdefault(j, {})
    moved: dict[int, int] = {}
    for _ in range(steps):
        by_size = sorted(range(new), key=lambda j: total[j])
        done = True
        for high, low in ((by_size[-1], by_size[0]), (by_size[-1], by_size[1 % new]), (by_size[-2 % new], by_size[0])):
            gap = total[high] - total[low]
            if gap < 2 or not held[high]:
                continue
            keys, sizes_high = list(held[high]), np.array(list(held[high].values()))
            others, sizes_low = [None, *held[low]], np.array([0, *held[low].values()])
            off = np.abs(2 * (sizes_high[:, None] - sizes_low[None, :]) - gap)
            a, b = np.unravel_index(int(off.argmin()), off.shape)
            if off[a, b] >= gap:
                continue
            change = int(sizes_high[a] - sizes_low[b])
            held[low][keys[a]] = held[high].pop(keys[a])
            moved[keys[a]] = low
            if others[b] is not None:
                held[high][others[b]] = held[low].pop(others[b])
                moved[others[b]] = high
            total[high] -= change
            total[low] += change
            done = False
            break
        if done:
            break
    return moved


def plan(digest: DataFrame, old_shards: int, new_shards: int, capacity: list[int] | None = None) -> Placement:
    """Solve the flow and turn it into cuts. ``digest`` is a staged table with old (0 to old_shards - 1), key, size."""
    spark, n = digest.sparkSession, digest.count()
    blocks = int(min(MOST_BLOCKS, max(8, n // (old_shards * ROWS_PER_BLOCK))))
    width = -(-(2**63) // blocks)
    block = F.expr(f"key div {width}L")
    summed = digest.groupBy("old", block.alias("block")).agg(F.sum("size").alias("bytes"))
    table = summed.toPandas().sort_values(["old", "block"]).astype("int64")
    supply = [int(table.loc[table["old"] == i, "bytes"].sum()) for i in range(old_shards)]
    capacity = capacity or near_equal(sum(supply), new_shards)
    flow = minimum_cost_flow(supply, capacity, moving_cost(old_shards, new_shards))

    wanted = []  # a cut: in this block, behind so many of its bytes, the next shard begins
    targets = {i: sorted((j != i, j, amount) for (o, j), amount in flow.items() if o == i) for i in range(old_shards)}
    for i in range(old_shards):
        own = table[table["old"] == i]
        ends = own["bytes"].cumsum().to_numpy()
        at = 0
        for _, _, amount in targets[i][:-1]:
            at += amount
            k = int(np.searchsorted(ends, at, side="left"))
            wanted.append((i, int(own["block"].iloc[k]), int(at - (ends[k] - own["bytes"].iloc[k]))))
    cut_keys = _cut_keys(digest, block, wanted)

    cuts = []
    place = iter(cut_keys)
    for i in range(old_shards):
        low = 0
        for n_target, (_, j, _) in enumerate(targets[i]):
            high = 2**63 - 1 if n_target == len(targets[i]) - 1 else next(place) - 1
            if high >= low:
                cuts.append((i, low, high, j))
                low = high + 1
    cuts = pd.DataFrame(cuts, columns=["old", "low", "high", "shard"]).astype("int64")
    first = Placement(old_shards, new_shards, cuts, pd.DataFrame({"key": [], "shard": []}).astype("int64"), flow, [])
    placed = first.apply(digest, F.col("old"), F.col("key"))
    sizes = {r["shard"]: r["bytes"] for r in placed.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    # a few rows of every size in every shard: bounded by shards x sizes in half octaves x 8
    octave = F.floor(2 * F.log2(F.col("size").cast("double"))).cast("int")
    single = placed.groupBy("shard", octave.alias("octave"), F.pmod(F.xxhash64("key"), F.lit(8)).alias("one_of")).agg(
        F.min(F.struct("key", "size")).alias("row")
    )
    rows = single.select("shard", "row.key", "row.size").toPandas()
    picked = spark.createDataFrame(rows[["key"]].drop_duplicates(), "key long")
    twice = digest.join(F.broadcast(picked), "key", "left_semi").groupBy("key").count().filter("count > 1")
    rows = rows[~rows["key"].isin([r["key"] for r in twice.collect()])]
    moved = even_out(sizes, rows, new_shards)
    moves = pd.DataFrame({"key": list(moved), "shard": list(moved.values())}).astype("int64")
    changed = {j for (i, j) in flow if i != j} | {i for (i, j) in flow if i != j and i < new_shards} | set(moved.values())
    changed |= set(rows.loc[rows["key"].isin(list(moved)), "shard"].astype(int))
    return Placement(old_shards, new_shards, cuts, moves, flow, sorted(changed | set(range(old_shards, new_shards))))


def _cut_keys(digest: DataFrame, block: Column, wanted: list[tuple[int, int, int]]) -> list[int]:
    """For every wanted cut, the first key of its block whose middle byte lies behind it.

    Only the blocks with a cut are sorted, each in its own task.
    """
    if not wanted:
        return []
    spark = digest.sparkSession
    cuts = spark.createDataFrame([(n, *w) for n, w in enumerate(wanted)], "cut int, cut_old int, cut_block long, behind long")
    blocks = F.broadcast(cuts.select("cut_old", "cut_block").distinct())
    rows = digest.select("old", "key", "size", block.alias("block"))
    rows = rows.join(blocks, (F.col("old") == F.col("cut_old")) & (F.col("block") == F.col("cut_block")), "left_semi")
    order = Window.partitionBy("old", "block").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.groupBy("old", "block", "key").agg(F.sum("size").alias("size"))
    rows = rows.withColumn("middle", F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("size") / 2)
    hit = rows.join(F.broadcast(cuts), (F.col("old") == F.col("cut_old")) & (F.col("block") == F.col("cut_block")))
    first = hit.filter("middle > behind").groupBy("cut").agg(F.min("key").alias("first_key"))
    found = {r["cut"]: r["first_key"] for r in first.collect()}
    ends = [found.get(n) for n in range(len(wanted))]
    if None in ends:  # the cut lies behind the last middle: the next block begins the next shard
        last = {(r["old"], r["block"]): r["k"] for r in rows.groupBy("old", "block").agg(F.max("key").alias("k")).collect()}
        ends = [last[w[0], w[1]] + 1 if e is None else e for e, w in zip(ends, wanted)]
    return ends


def rewrite(docs: DataFrame, placement: Placement, old: Column, key: Column, path: str, bytes_per_file: int = 128 << 20) -> str:
    """Write the rows of the affected shards below ``path``, one folder per shard; other shards keep their files.

    A shard is spread over as many tasks as its bytes ask for, by row key, so a large one is no single task.
    """
    spare = {c: f"doc_{c}" for c in docs.columns if c in OWN}
    named = docs.withColumnsRenamed(spare)
    placed = placement.apply(named, old, key).filter(F.col("shard").isin(placement.affected))
    total = sum(placement.flow.values())
    parts = max(1, -(-total // (placement.new_shards * bytes_per_file)))
    part = F.pmod(F.xxhash64(*[c for c in named.columns]), F.lit(parts)).alias("shard_part")
    dealt = placed.select("*", part).repartition(min(4000, placement.new_shards * parts), "shard", "shard_part")
    dealt.drop("shard_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    return path


def old_layout(source: Column, shards: int = OLD_SHARDS) -> Column:
    """The layout before: one shard per group of sources, so a hot source makes a hot shard."""
    return F.pmod(F.xxhash64(F.coalesce(source.cast("string"), F.lit(""))), F.lit(shards)).cast("int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "op1")
    old, key = old_layout(F.col("source")), row_key(F.col("doc_id"), F.col("text"))
    digest = scratch.stage(docs.select(old.alias("old"), key.alias("key"), text_bytes(F.col("text")).alias("size")))
    placement = plan(digest, OLD_SHARDS, NEW_SHARDS)
    rewrite(docs, placement, old, key, fresh_dir(spark, "op1-shards"))
    # the rows of all shards, also of those that keep their files
    rows = scratch.stage(placement.apply(docs, old, key).select(
        "doc_id", text_bytes(F.col("text")).alias("size"), text_crc(F.col("text")).alias("text_crc32"), "shard",
    ))
    numbered = number_within(rows, ["shard"], [F.col("doc_id"), F.col("text_crc32")], "slot", rows.count())
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
