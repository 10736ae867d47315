"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

The tree is domain, language, source. A token budget runs down it: every node splits its budget over its children by
weight, no child gets more than it can give (its tokens times the epochs allowed), and what a child cannot give goes to
its siblings by their weights. Only what all siblings together cannot give is left to the level above, whose own split
has already given it to the node's siblings, since a node's capacity is the sum of its leaves.

A leaf gives whole epochs while its budget lasts, then a prefix of one more epoch: its documents in an order
drawn from the seed and the epoch, as long as the tokens before a document are below what is left of the budget.

Defined cases: null domain, language or source form nodes of their own (shown as ''). A null or empty text has no
tokens; such a document is taken whenever the leaf's prefix reaches it and never when its leaf has no budget. Repeated
rows are drawn alike. A node of weight 0 gets nothing. An empty table, or no tokens, gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, documents, free_prefix, small

LEVELS = ("domain", "language", "source")
# Sources are grouped into so many domains by the first digit of the MD5 of their name, as the tables have no domain column.
DOMAINS = 3


@dataclass(frozen=True)
class Plan:
    """Integer weights by level and name; names not listed get 1. ``share`` is the budget as percent of all tokens."""

    weights: dict[str, dict[str, int]] = field(default_factory=lambda: {
        "domain": {"domain0": 5, "domain1": 3, "domain2": 2}, "language": {"en": 4, "de": 2, "fr": 2, "es": 2},
        "source": {"src1": 3, "src2": 2},
    })
    share: int = 60
    epochs: int = 3
    seed: str = "mix-1"


def weight(level: str, plan: Plan) -> Column:
    out = F.lit(1)
    for name, value in plan.weights.get(level, {}).items():
        out = F.when(F.col(level) == name, value).otherwise(out)
    return out.cast("long")


def token_count(text: Column) -> Column:
    """Words: runs of characters other than the six ASCII blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    digit = F.conv(F.substring(F.md5(F.coalesce(source, F.lit(""))), 1, 1), 16, 10).cast("int")
    return F.concat(F.lit("domain"), (digit % DOMAINS).cast("string"))


def leaves(tokens: DataFrame, plan: Plan) -> DataFrame:
    """Tokens, capacity and weights of every leaf."""
    sums = tokens.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("leaf_tokens"), F.count(F.lit(1)).alias("leaf_documents"))
    out = sums.withColumn("capacity", F.col("leaf_tokens") * plan.epochs)
    for level in LEVELS:
        out = out.withColumn(f"{level}_weight", weight(level, plan))
    return out


def split_budget(children: DataFrame, parents: list[str], name: str, capacity: str, budget: str) -> DataFrame:
    """Split each parent's budget (a column of the child rows) by weight under the capacities.

    Water level in closed form: in the order of capacity per weight, the children that fill up come first. A child is
    full if its share of what the ones before it leave is at least its capacity.
    """
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.col("fill_order"), F.col(name)).rowsBetween(Window.unboundedPreceding, -1)
    w, c = F.col(f"{name}_weight"), F.col(capacity)
    ready = children.withColumn("fill_order", F.when(w > 0, F.floor(c * 1000 / w)).otherwise(F.lit(2**62).cast("long")))
    ready = ready.withColumns({
        "taken_before": F.coalesce(F.sum(F.when(w > 0, c).otherwise(0)).over(order), F.lit(0)),
        "weight_after": F.sum(w).over(by) - F.coalesce(F.sum(w).over(order), F.lit(0)),
    })
    left = F.greatest(F.col(budget) - F.col("taken_before"), F.lit(0))
    full = (w > 0) & (left * w >= c * F.col("weight_after"))
    ready = ready.withColumn("is_full", full)
    # the first child that is not full sets the level for itself and all behind it
    ready = ready.withColumns({
        "level_left": F.max(F.when(~F.col("is_full") & (w > 0), left)).over(by),
        "level_weight": F.max(F.when(~F.col("is_full") & (w > 0), F.col("weight_after"))).over(by),
    })
    share = F.expr(f"least({capacity}, level_left * {name}_weight div level_weight)")
    given = F.when(w <= 0, F.lit(0)).when(F.col("is_full"), c).otherwise(share).cast("long")
    drop = ["fill_order", "taken_before", "weight_after", "is_full", "level_left", "level_weight"]
    return ready.withColumn(f"{name}_budget", given).drop(*drop)


def budgets(leaf: DataFrame, plan: Plan) -> DataFrame:
    """Budget of every leaf. The tree has one row per leaf; each level is split among the children of one node only."""
    domain = leaf.groupBy("domain").agg(
        F.max("domain_weight").alias("domain_weight"), F.sum("capacity").alias("domain_capacity"),
        F.sum("leaf_tokens").alias("domain_tokens"),
    )
    whole = F.sum("domain_tokens").over(Window.partitionBy(F.lit(0)))
    domain = domain.withColumn("tokens_of_all", whole).withColumn("total_budget", F.expr(f"tokens_of_all * {plan.share} div 100"))
    domain = split_budget(domain, [], "domain", "domain_capacity", "total_budget").select("domain", "domain_budget")
    language = leaf.groupBy("domain", "language").agg(
        F.max("language_weight").alias("language_weight"), F.sum("capacity").alias("language_capacity")
    ).join(domain, "domain")
    language = split_budget(language, ["domain"], "language", "language_capacity", "domain_budget")
    source = leaf.join(language.select("domain", "language", "language_budget"), ["domain", "language"])
    return split_budget(source, ["domain", "language"], "source", "capacity", "language_budget")


def draw_order(plan: Plan, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(plan.seed), epoch.cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(""))))


def select_copies(tokens: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """id, tree columns, tokens and ``copies`` (how often the document enters the mix, 0 left out) of a staged table
    with id, domain, language, source, n_tokens.

    The prefix of a leaf is found without sorting the leaf: sums by the first three digits of the draw order give the
    boundary bucket, and only inside a bucket do rows need a running sum.
    """
    leaf = budgets(leaves(tokens, plan), plan)
    leaf = Scratch(tokens.sparkSession, "leaves").stage(leaf.select(
        *LEVELS, F.col("source_budget").alias("leaf_budget"),
        F.expr("if(leaf_tokens = 0, 0, source_budget div leaf_tokens)").alias("full_epochs"),
        F.expr("if(leaf_tokens = 0, 0, source_budget % leaf_tokens)").alias("rest"),
    ), partitions=1)
    rows = tokens.join(small(leaf, 200), [*LEVELS]).withColumn("draw", draw_order(plan, F.col("full_epochs")))
    rows = rows.withColumn("draw_bucket", F.substring("draw", 1, 3))
    keys = [*LEVELS, "draw_bucket"]
    bucket = rows.groupBy(*keys).agg(F.sum("n_tokens").alias("bucket_tokens"))
    before = Window.partitionBy(*LEVELS).orderBy("draw_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucket = bucket.select(*keys, F.coalesce(F.sum("bucket_tokens").over(before), F.lit(0)).alias("bucket_start"))
    inside = Window.partitionBy(*keys).orderBy("draw", "id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("in_bucket", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(bucket, keys)
    taken = F.col("bucket_start") + F.col("in_bucket") < F.col("rest")
    copies = (F.col("full_epochs") + taken.cast("long")).cast("long")
    return rows.select("id", *LEVELS, "n_tokens", "leaf_budget", copies.alias("copies")).filter("copies > 0")


def token_table(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"), domain_of(F.col(source_col).cast("string")).alias("domain"),
        named(lang_col).alias("language"), named(source_col).alias("source"),
        token_count(F.col(text_col)).alias("n_tokens"),
    )


def mix_documents(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The mix itself: documents with all their columns, each as often as its leaf repeats it."""
    scratch = Scratch(docs.sparkSession, "mixing")
    tokens = scratch.stage(token_table(docs))
    own = free_prefix(docs)
    drawn = select_copies(tokens, plan).select(F.col("id").alias(f"{own}id"), F.col("copies").alias(f"{own}copies"))
    drawn = scratch.stage(drawn.distinct())
    scratch.drop(tokens)
    joined = docs.join(small(drawn, 24), docs["doc_id"].eqNullSafe(drawn[f"{own}id"]))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{own}copies")))
    return joined.withColumn(f"{own}copy", each).select(*[docs[c] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = Scratch(spark, "op10").stage(token_table(documents(spark, sf_dir)))
    return select_copies(tokens).withColumnRenamed("id", "doc_id")


def _cases(level: str, plan: Plan) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{n}' THEN {v}" for n, v in plan.weights[level].items()) + " ELSE 1 END"


def oracle(plan: Plan = Plan()) -> str:
    """The same mix in SQL; the level of a split is found by trying every child as the first that does not fill up."""

    def split(table: str, parents: str, name: str, capacity: str, budget: str) -> str:
        same = " AND ".join(f"b.{p} = a.{p}" for p in parents.split()) or "true"
        lower = f"({same} AND (b.ratio < a.ratio OR (b.ratio = a.ratio AND b.{name} < a.{name})))"
        return f"""(
          SELECT a.* EXCLUDE (ratio, w, cap, bud, taken, rest_w, is_full),
            CASE WHEN is_full THEN cap ELSE least(cap, level_left * w // level_w) END AS {name}_budget
          FROM (SELECT *, max(CASE WHEN NOT is_full THEN greatest(bud - taken, 0) END) OVER ({'PARTITION BY ' + ', '.join(parents.split()) if parents else ''}) AS level_left,
                  max(CASE WHEN NOT is_full THEN rest_w END) OVER ({'PARTITION BY ' + ', '.join(parents.split()) if parents else ''}) AS level_w
                FROM (SELECT *, greatest(bud - taken, 0) * w >= cap * rest_w AS is_full
                      FROM (SELECT a.*, CAST(coalesce((SELECT sum(b.cap) FROM {table}_r b WHERE {lower}), 0) AS HUGEINT) AS taken,
                              CAST((SELECT sum(b.w) FROM {table}_r b WHERE {same}) - coalesce((SELECT sum(b.w) FROM {table}_r b WHERE {lower}), 0) AS HUGEINT) AS rest_w
                            FROM {table}_r a))) a)"""

    def ratio(table: str, name: str, capacity: str, budget: str) -> str:
        return (f"{table}_r AS (SELECT *, {name}_weight AS w, CAST({capacity} AS HUGEINT) AS cap, CAST({budget} AS HUGEINT) AS bud, "
                f"floor({capacity} * 1000 / {name}_weight) AS ratio FROM {table})")

    return f"""
    WITH tok AS (
      SELECT doc_id, 'domain' || CAST((instr('0123456789abcdef', md5(coalesce(source, ''))[1]) - 1) % {DOMAINS} AS VARCHAR) AS domain,
        coalesce(lang, '') AS language, coalesce(source, '') AS source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
      FROM documents),
    leaf AS (SELECT domain, language, source, sum(n_tokens) AS leaf_tokens, sum(n_tokens) * {plan.epochs} AS capacity,
      {_cases('domain', plan)} AS domain_weight, {_cases('language', plan)} AS language_weight, {_cases('source', plan)} AS source_weight
      FROM tok GROUP BY domain, language, source),
    d AS (SELECT domain, max(domain_weight) AS domain_weight, sum(capacity) AS c,
      (SELECT sum(leaf_tokens) * {plan.share} // 100 FROM leaf) AS b FROM leaf GROUP BY domain),
    {ratio('d', 'domain', 'c', 'b')},
    db AS (SELECT domain, domain_budget FROM {split('d', '', 'domain', 'c', 'b')}),
    l AS (SELECT domain, language, max(language_weight) AS language_weight, sum(capacity) AS c, max(domain_budget) AS b
      FROM leaf JOIN db USING (domain) GROUP BY domain, language),
    {ratio('l', 'language', 'c', 'b')},
    lb AS (SELECT domain, language, language_budget FROM {split('l', 'domain', 'language', 'c', 'b')}),
    s AS (SELECT leaf.*, language_budget AS b FROM leaf JOIN lb USING (domain, language)),
    {ratio('s', 'source', 'capacity', 'b')},
    sb AS (SELECT domain, language, source, leaf_tokens, source_budget FROM {split('s', 'domain language', 'source', 'capacity', 'b')}),
    drawn AS (
      SELECT tok.*, CAST(source_budget AS BIGINT) AS leaf_budget,
        CAST(CASE WHEN leaf_tokens = 0 THEN 0 ELSE source_budget // leaf_tokens END AS BIGINT) AS full_epochs,
        CAST(CASE WHEN leaf_tokens = 0 THEN 0 ELSE source_budget % leaf_tokens END AS BIGINT) AS rest
      FROM tok JOIN sb USING (domain, language, source)),
    run AS (
      SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, language, source
          ORDER BY md5('{plan.seed}:' || full_epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, n_tokens
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM drawn)
    SELECT doc_id, domain, language, source, n_tokens, leaf_budget,
      CAST(full_epochs + CASE WHEN before < rest THEN 1 ELSE 0 END AS BIGINT) AS copies
    FROM run WHERE full_epochs > 0 OR before < rest"""


ORACLE = oracle()
