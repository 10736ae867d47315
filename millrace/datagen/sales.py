"""Customers, orders and order lines as expressions over given ids: a table's keys, or ``spark.range``.

All draws come from MD5 digits of the row's identity: a repeated task, a second run and another
engine give the same rows. Only the lines, far more than all other rows, come from Python workers, by whole blocks.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.dates import add_days, add_years
from ..functions.digests import pair_draws
from ..workspace import fits_broadcast

# The functions travel to the Python workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Building blocks of the invented people and companies.
FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gwen", "Hugo", "Iris", "Jon", "Kim", "Leo"]
LAST_NAMES = ["Abel", "Brook", "Cole", "Dale", "Ernst", "Frost", "Grant", "Hale", "Irwin", "Jones"]
STREETS = ["Oak Street", "Mill Lane", "High Street", "Station Road", "Park Avenue"]
CITIES = ["Ashford", "Brighton", "Carlisle", "Durham", "Exeter", "Fairview", "Georgetown"]
STATES = ["Alabama", "California", "Georgia", "Nevada", "Ohio", "Texas", "Utah", "Vermont"]
COMPANIES = ["Arrow Freight", "Blue Parcel", "Comet Cargo", "Delta Post", "Eagle Express"]
GENDERS = ["0", "1", "2", "9"]

# Ranges of the draws.
FIRST_BIRTH, LAST_BIRTH_YEAR = "1940-01-01", 2005
BIRTH_DAYS = 24107  # 1940-01-01 to 2005-12-31
ADULT_YEARS = 15
SHIPPING_DAYS, DELIVERY_DAYS, MAX_QUANTITY = 15, 45, 14

# Order lines that one task makes: at most, and what a task is worth.
MOST_LINES, LEAST_LINES = 5_000_000, 100_000

# So many steps of a Poisson distribution are compared one by one, in compiled code.
FEW_CUTS = 32

# Orders, or offers, of a round that are taken together, and lines that a Python worker hands back at once.
BLOCK_ROWS, BATCH_LINES = 1024, 1 << 17
LINE_COLUMNS = ["order_id", "uniq_id", "quantity"]


def digest(*parts) -> Column:
    return F.md5(F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def draw(digits: Column, position: int, n: int | Column) -> Column:
    """A whole number below ``n`` from seven hex digits of a digest."""
    return F.conv(F.substring(digits, position, 7), 16, 10).cast("bigint") % n


def pick(digits: Column, position: int, choices: list[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in choices]), draw(digits, position, len(choices)).cast("int"))


def poisson_cuts(mean: float) -> list[float]:
    """Cumulative Poisson probabilities, as far as seven hex digits can tell them apart. Terms come from their
    logarithms, as the first ones of a large mean are too small for a number."""
    cuts, total, k = [], 0.0, 0
    while mean > 0 and total < 1 - 1e-8 and k < mean + 12 * math.sqrt(mean) + 40:
        total += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
        cuts.append(min(total, 1.0))
        k += 1
    return cuts


def poisson_count(digits: Column, position: int, mean: float) -> Column:
    """How often a row is drawn by sampling with replacement at that mean."""
    u = draw(digits, position, 1 << 28) / F.lit(float(1 << 28))
    cuts = [F.lit(c) for c in poisson_cuts(mean)]
    if len(cuts) <= FEW_CUTS:
        return sum([F.coalesce((cut <= u).cast("int"), F.lit(0)) for cut in cuts], F.lit(0))
    # The number drawn is bound first: inside the inner function it would be worked out for every cut.
    return F.get(F.transform(F.array(u), lambda v: F.size(F.filter(F.array(*cuts), lambda cut: cut <= v))), 0)


def customers(ids: DataFrame) -> DataFrame:
    """A customer with the columns of schemas.CUSTOMER for every row's ``id``; nobody is born after 2005."""
    base = ids.select(
        "id", digest("customer", F.col("id")).alias("h"), digest("person", F.col("id")).alias("p")
    )
    h, p = F.col("h"), F.col("p")
    base = base.withColumn("born", F.date_add(F.lit(FIRST_BIRTH).cast("date"), draw(h, 1, BIRTH_DAYS).cast("int")))
    base = base.withColumn("name", pick(p, 1, FIRST_NAMES)).withColumn("last", pick(p, 8, LAST_NAMES))
    unique = F.concat(
        F.lit("3"), F.lpad(F.conv(F.substring(h, 8, 14), 16, 10), 17, "0"), F.lpad(F.col("id").cast("string"), 12, "0")
    )
    return base.select(
        F.col("id").cast("int").alias("row_id"),
        F.concat_ws(" ", "name", "last").alias("full_name"),
        "name",
        pick(p, 15, GENDERS).alias("gender"),
        F.concat_ws(" ", (draw(p, 22, 999) + 1).cast("string"), pick(h, 22, STREETS)).alias("address"),
        F.concat(F.lower("name"), F.lit("."), F.lower("last"), F.col("id").cast("string"), F.lit("@example.com"))
        .alias("email"),
        F.concat(F.lit("555-"), F.lpad(draw(p, 24, 10_000_000).cast("string"), 7, "0")).alias("telephone"),
        pick(p, 5, CITIES).alias("city"),
        pick(p, 12, STATES).alias("state"),
        F.col("born").cast("string").alias("birth_date"),
        unique.alias("cust_id"),
        add_years(F.col("born"), ADULT_YEARS).cast("string").alias("user_create_date"),
    )


def _order_columns(base: DataFrame, day: Column) -> DataFrame:
    """``base`` has cust_id and a digest ``o`` that identifies the order."""
    o = F.col("o")
    dated = base.withColumn("day", day)
    dated = dated.withColumn("shipped", add_days(F.col("day"), draw(o, 8, SHIPPING_DAYS).cast("int")))
    dated = dated.withColumn("delivered", add_days(F.col("shipped"), draw(o, 15, DELIVERY_DAYS).cast("int")))
    clock = F.concat_ws(
        ":", *[F.lpad(draw(F.reverse("o"), p, n).cast("string"), 2, "0") for p, n in ((1, 24), (8, 60), (15, 60))]
    )
    return dated.select(
        F.col("o").alias("order_id"), "cust_id",
        *[
            F.concat_ws(" ", F.col(c).cast("string"), clock).alias(name)
            for c, name in (("day", "order_date"), ("shipped", "shipping_date"), ("delivered", "delivery_date"))
        ],
        pick(o, 22, COMPANIES).alias("shipping_company"),
    )


def _numbered(counted: DataFrame) -> DataFrame:
    """A row ``n`` times, numbered from 1 in ``i``. A filter on ``n`` would move below and work it out twice."""
    return counted.withColumn("i", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(1), F.col("n")))))


def _drawn(customer: DataFrame, label: str, mean: float) -> DataFrame:
    """Each customer as often as sampling with replacement would draw them."""
    counted = customer.select(
        "cust_id", "user_create_date", poisson_count(digest(label, F.col("cust_id")), 1, mean).alias("n")
    )
    return _numbered(counted).withColumn("o", digest(label, F.col("cust_id"), F.col("i")))


def orders(customer: DataFrame, end_year: int, rounds: int = 30, fraction: float = 0.1) -> DataFrame:
    """Orders of a sample with replacement, ``rounds`` times; dated between the year of registration
    and ``end_year``, shipped within 14 days, delivered within 44 more."""
    base = _drawn(customer, "order", rounds * fraction)
    first = F.make_date(F.year(F.col("user_create_date").cast("date")), F.lit(1), F.lit(1))
    days = F.greatest(F.datediff(F.make_date(F.lit(end_year), F.lit(12), F.lit(31)), first) + 1, F.lit(1))
    return _order_columns(base, F.date_add(first, draw(F.col("o"), 1, days).cast("int")))


def skew_orders(customer: DataFrame, day: str, rounds: int = 10, fraction: float = 0.1) -> DataFrame:
    """Orders that all carry the same date."""
    return _order_columns(_drawn(customer, "skew", rounds * fraction), F.lit(day).cast("date"))


def hot_customer_orders(ids: DataFrame, cust_ids: list[str], day: str) -> DataFrame:
    """For every row's ``id`` an order on one date of each of a few customers."""
    hot = F.array(*[F.lit(c) for c in cust_ids])
    base = ids.select("id").withColumn("cust_id", F.explode(hot))
    base = base.withColumn("o", digest("hot", F.col("cust_id"), F.col("id"))).drop("id")
    return _order_columns(base, F.lit(day).cast("date"))


def order_lines(
    order: DataFrame,
    product: DataFrame,
    product_rows: int,
    rounds: int = 100,
    order_fraction: float = 0.001,
    products_per_round: int = 8,
    order_id: str = "order_id",
    uniq_id: str = "uniq_id",
) -> DataFrame:
    """In every round a sample of the orders meets a small sample of the products.

    The product sample of all rounds together has about ``rounds * products_per_round`` rows, so the
    lines come from an equi-join on the round and grow with the orders alone. A round's orders and products meet in blocks,
    which are dealt over tasks by the lines expected: whole blocks are digested at once, and their lines made last.
    """
    chance = products_per_round / max(product_rows, 1)
    offered = _in_rounds(product.select(F.col(uniq_id).alias("uniq_id")), "uniq_id", "offer", rounds, chance)
    bought = _in_rounds(order.select(F.col(order_id).alias("order_id")), "order_id", "buy", rounds, order_fraction)
    tasks = line_tasks(order.sparkSession, order.count() * order_fraction * offered.count())
    offers = _blocks(offered, "uniq_id", "offer", F.col("uniq_id"), F.col("round"))
    blocks = _blocks(bought, "order_id", "order", F.lit("line"), F.col("order_id"))
    pairs = blocks.join(F.broadcast(offers) if fits_broadcast(offered) else offers, "round").drop("round").repartition(tasks)
    ids = [pairs.schema[c].dataType.elementType for c in ("order_ids", "offer_ids")]
    return pairs.mapInArrow(_lines_of_blocks, StructType([StructField(*f) for f in zip(LINE_COLUMNS, [*ids, IntegerType()])]))


def line_tasks(spark: SparkSession, lines: float) -> int:
    """Tasks for so many lines: enough that none makes more than ``MOST_LINES``, and for all cores where it is worth it."""
    return int(max(lines // MOST_LINES + 1, min(2 * spark.sparkContext.defaultParallelism, lines // LEAST_LINES + 1)))


def _blocks(df: DataFrame, key: str, name: str, *parts: Column) -> DataFrame:
    """The rows of a round in blocks of ``BLOCK_ROWS``: their keys, and their parts of the text that is digested for a line."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    texts = df.select("round", F.col(key).alias("id"), text.cast("binary").alias("text"))
    order = Window.partitionBy("round").orderBy(F.length("text"), "text")
    numbered = texts.withColumn("block", F.floor((F.row_number().over(order) - 1) / BLOCK_ROWS))
    grouped = numbered.groupBy("round", "block").agg(F.collect_list(F.struct("id", "text")).alias("rows"))
    return grouped.select("round", F.col("rows.id").alias(f"{name}_ids"), F.col("rows.text").alias(f"{name}_texts"))


def _lines_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every order of a block with every offer of the other, and a quantity; ``BATCH_LINES`` at a time."""
    for batch in batches:
        for row in range(batch.num_rows):
            cell = {name: batch.column(name).slice(row, 1).flatten() for name in batch.schema.names}
            offers, offer_texts = cell["offer_ids"], cell["offer_texts"].to_pylist()
            step = max(1, BATCH_LINES // len(offers))
            for at in range(0, len(cell["order_ids"]), step):
                drawn = pair_draws(cell["order_texts"].slice(at, step).to_pylist(), offer_texts, MAX_QUANTITY)
                orders = cell["order_ids"].slice(at, step).take(pa.array(np.repeat(np.arange(len(drawn)), len(offers))))
                quantities = pa.array(drawn.ravel().astype(np.int32) + 1)
                yield pa.RecordBatch.from_arrays([orders, pa.concat_arrays([offers] * len(drawn)), quantities], LINE_COLUMNS)


def _in_rounds(df: DataFrame, key: str, label: str, rounds: int, chance: float) -> DataFrame:
    """The rounds a row takes part in: a Poisson number of draws, each naming a round."""
    drawn = _numbered(df.withColumn("n", poisson_count(digest(label, F.col(key)), 1, rounds * chance)))
    return drawn.select(key, draw(digest(label, F.col(key), F.col("i")), 8, rounds).cast("int").alias("round"))
