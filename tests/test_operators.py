"""Joins, numbering, profiles and samples against brute force, on data with hot and missing keys."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators.dump import DETAIL_FIELDS, clean_field_names, infer_json_schema, parse_json_column
from millrace.operators.grouping import group_cardinality
from millrace.operators.joins import left_join_hot_right
from millrace.operators.keys import hot_salts, hot_values_by_median, top_keys
from millrace.operators.merge import merge_sales
from millrace.operators.numbering import number_rows
from millrace.operators.sampling import hash_fraction, pair_with_sample, sample_by_hash
from millrace.workspace import lookup_table
from millrace.schemas import CUSTOMER, ORDERS, ORDERS_PRODUCT, PRODUCT


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def sides(spark):
    left = [(k, f"c{k}") for k in range(50)] + [(None, "no key"), (None, "no key"), (7, "twice")]
    right = [(7, i % 3) for i in range(900)] + [(9, i) for i in range(400)] + [(k, k) for k in range(0, 50, 4)]
    right += [(99, 1)] * 300 + [(None, 5)] * 300  # hot without a partner, and rows without a key
    return (
        spark.createDataFrame(left, "lk INT, name STRING"),
        spark.createDataFrame(right, "rk INT, v INT").repartition(6),
    )


@pytest.mark.parametrize("rows_per_task", [20, 100, 10**6])
def test_left_join_equals_plain_join(spark, sides, rows_per_task):
    left, right = sides
    got = left_join_hot_right(left, right, "lk", "rk", rows_per_task=rows_per_task)
    assert rows(got) == rows(left.join(right, left["lk"] == right["rk"], "left"))


def test_hot_keys_are_found_and_null_is_none_of_them(spark, sides):
    found = {r["hot_key"]: r["salts"] for r in hot_salts(sides[1], "rk", 100).collect()}
    assert set(found) == {7} and found[7] >= 3  # of 1613 rows by 8 tasks, 2 x 202 make a key hot
    assert hot_salts(sides[1], "rk", 10**6).isEmpty() and hot_salts(sides[1].limit(0), "rk", 1).isEmpty()


def test_lookup_table_is_staged_when_large(spark):
    df = spark.range(500)
    local, staged = lookup_table(df, rows=500), lookup_table(df, rows=100)
    assert rows(local) == rows(staged) == rows(df)
    assert "LocalTableScan" in local._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in staged._jdf.queryExecution().executedPlan().toString()


def test_each_side_is_scanned_once(spark, tmp_path):
    for name in ("l", "r"):
        spark.range(3000).select((F.col("id") % 7).alias(f"{name}k"), F.col("id").alias(f"{name}v")).write.parquet(f"{tmp_path}/{name}")
    left, right = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("l", "r"))
    joined = left_join_hot_right(left, right, "lk", "rk", rows_per_task=50)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Union" not in plan


def test_merge_sales_edge_rows(spark):
    customer = spark.createDataFrame(
        [(i, f"n{i}", "n", "1", "a", "e", "t", "c", "s", "1990-01-01", f"{10**38 + i}", "2005-01-01") for i in range(4)],
        CUSTOMER,
    )
    cust = lambda i: f"{10**38 + i}"
    orders = spark.createDataFrame(
        [("o1", cust(0), "2020-01-01 10:00:00", "s", "d", "x"), ("o2", cust(0), "bad", "s", "d", "x"),
         ("o3", cust(1), None, "s", "d", "x")] + [(f"h{i}", cust(2), "2021-01-01", "s", "d", "x") for i in range(60)],
        ORDERS,
    )
    lines = spark.createDataFrame(
        [("o1", "p1", 2), ("o1", "p2", 3), ("o1", "p9", 1), ("h1", "p1", 4)] + [("h2", "p1", 1)] * 50, ORDERS_PRODUCT
    )
    product = spark.createDataFrame(
        [("p1", "one", "m", "9.99", "d"), ("p2", "two", "m", "abc", "d"), ("p3", "three", "m", "", "d")], PRODUCT
    )
    plain = rows(merge_sales(customer, orders, lines, product))
    assert plain == rows(merge_sales(customer, orders, lines, product, rows_per_task=5))
    merged = merge_sales(customer, orders, lines, product)
    assert len(merged.columns) == 24
    found = {(r.order_id, r.uniq_id): r for r in merged.collect()}
    assert found[("o1", "p1")].total_sales == 9.99 * 2
    assert found[("o1", "p2")].price is None and found[("o1", "p9")].product_name is None
    assert found[("o2", None)].order_date is None
    assert found[(None, None)].row_id == 3  # a customer without orders stays
    assert sum(plain.values()) == 3 + 1 + 1 + 58 + 1 + 50 + 1


@pytest.mark.parametrize("rows_per_task", [50, 10**6])
def test_row_numbers(spark, rows_per_task):
    data = [("a", i * 7 % 1000) for i in range(1000)] + [("b", 1), ("b", 2)] + [(None, i) for i in range(300)]
    df = spark.createDataFrame(data, "k STRING, v INT").repartition(5)
    want = defaultdict(list)
    for k, v in data:
        want[k].append(v)
    expected = {(k, v): n for k, vs in want.items() for n, v in enumerate(sorted(vs), 1)}
    got = number_rows(df, ["k"], ["v"], rows_per_task=rows_per_task).collect()
    assert {(r.k, r.v): r.row_num for r in got} == expected and len(got) == len(data)


def test_row_numbers_by_any_type_and_direction(spark):
    data = [("same" if i % 3 else f"s{i}", i * 37 % 3000) for i in range(3000)] + [(None, 4000), (None, 4001)]
    df = spark.createDataFrame(data, "a STRING, b INT").repartition(5)
    got = number_rows(df, [], [F.desc("a"), "b"])
    want = sorted(data, key=lambda r: r[1])
    want = sorted(want, key=lambda r: (r[0] is not None, r[0] or ""), reverse=True)
    assert [(r.a, r.b, r.row_num) for r in got.orderBy("row_num").collect()] == [
        (a, b, n) for n, (a, b) in enumerate(want, 1)
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # only the counts of the ranges


def test_row_numbers_over_everything(spark):
    df = spark.range(5000).withColumn("v", F.xxhash64("id"))
    got = number_rows(df, [], ["v"]).orderBy("v").collect()
    assert [r.row_num for r in got] == list(range(1, 5001))


def test_group_cardinality_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k INT")
    assert group_cardinality(df, F.col("k")).first()[0] == 3
    assert group_cardinality(df.filter("k = 1"), F.col("k")).first()[0] == 1
    assert group_cardinality(df.filter("false"), F.col("k")).first()[0] == 0


def test_top_keys_and_median(spark):
    df = spark.createDataFrame([("x",)] * 20 + [("y",)] * 2 + [("z",)] * 2 + [(None,)] * 50, "k STRING")
    assert [tuple(r) for r in top_keys(df.filter("k is not null"), "k", 2).collect()] == [("x", 20), ("y", 2)]
    assert {r["key"] for r in hot_values_by_median(df, F.col("k")).collect()} == {"x"}


def test_samples(spark):
    df = spark.range(20000)
    picked = sample_by_hash(df, F.col("id"), 0.1, "s")
    assert 1800 < picked.count() < 2200
    assert rows(picked) == rows(sample_by_hash(df.repartition(3), F.col("id"), 0.1, "s"))
    low, high = df.agg(F.min(hash_fraction(F.col("id"))), F.max(hash_fraction(F.col("id")))).first()
    assert 0 <= low < high < 1
    right = spark.range(100).withColumnRenamed("id", "r")
    pairs = pair_with_sample(spark.range(50), right, "r", 4)
    assert pairs.count() == 200 and pairs.select("r").distinct().count() == 4
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_schema_inference_and_names(spark):
    df = spark.createDataFrame(
        [('{"     _date":"x","a b":1,"ab":2.5,"AB":true,"s":{"k 1":[1]},"n":null,"mixed":1}',),
         ('{"mixed":{"x":1},"e":{}}',), ("not json",), (None,)], "j STRING",
    )
    schema = infer_json_schema(df, "j")
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert kinds["     _date"] == "string" and kinds["a b"] == "bigint" and kinds["ab"] == "double"
    assert kinds["mixed"] == "string" and kinds["n"] == "string" and kinds["e"] == "string"
    clean = clean_field_names(schema)
    assert len({n.lower() for n in clean.names}) == len(clean.names)
    assert "field_date" in clean.names and clean["s"].dataType.names == ["k1"]
    parsed = parse_json_column(df.limit(1), "j", schema, "p").select("p.*").first().asDict(recursive=True)
    assert parsed["field_date"] == "x" and parsed["s"] == {"k1": [1]}
    assert len(DETAIL_FIELDS) == 72


def test_fields_of_repeated_keys_are_kept(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"b":1,"b":2,"c":3}',), (None,)], "t STRING")
    schema = infer_json_schema(df, "t")
    assert schema.simpleString() == "struct<a:bigint,b:string,c:string>"
    parsed = parse_json_column(df, "t", schema, "d").filter("d.c IS NOT NULL").select("d.c").collect()
    assert [r["c"] for r in parsed] == ["3"]


def test_poisson_of_a_large_mean():
    from millrace.datagen.sales import poisson_cuts

    cuts = poisson_cuts(800)
    assert abs(next(k for k, c in enumerate(cuts) if c >= 0.5) - 800) <= 1 and poisson_cuts(0) == []


def test_wiki_marks_of_large_pages_take_linear_time(spark):
    import time

    from millrace.sources.articles import _outside

    cases = {
        "{{a}} b {{c {{d}} e}} f": " b  f", "x }} y {{z": "x  y ", "{{{x}}} t": "} t", "{{{{x}} y}} z": " z", "none": "none",
        "{{" * 30 + "in" + "}}" * 30 + " out": " out", "{{}}a": "a", "a{{b": "a",
    }
    page = "".join(f"{{{{box {i}|v={{{{n {i}}}}}}}}} w{i} " for i in range(60_000))
    df = spark.createDataFrame([(t,) for t in cases] + [(page,)], "t STRING").coalesce(1)
    started = time.perf_counter()
    got = {r["t"]: r["o"] for r in df.select("t", _outside(F.col("t"), "{{", "}}").alias("o")).collect()}
    assert time.perf_counter() - started < 20
    for text, outside in cases.items():
        assert got[text].split() == outside.split(), text
    assert got[page].split() == [f"w{i}" for i in range(60_000)]


def test_json_is_checked_by_one_parse_as_by_two(spark):
    from millrace.operators.dump import _END, checked_json, json_is_valid

    texts = [
        '{"a":1}', '{"a":1} x', '{"a":1}  ', '{"a":1,"a":2}', '{"a":NaN}', "{'a':1}", "", None, "[1]", "7", '"s"', '{"a":1}{"b":2}', "1,2",
        "{", "null", '  {"a":2}', '{"a":1}] junk {"b":2}', f'{{"a":1}},"{_END}"] x', f'{{"a":"{_END}"}}', "1],[2", '1},{"v":2', "[", "]",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for r in df.select("t", checked_json(F.col("t")).alias("c"), json_is_valid(F.col("t")).alias("ok")).collect():
        assert r["c"]["is_valid"] == r["ok"], r["t"]
        assert r["ok"] or r["c"]["details"] is None


def test_no_salts_without_hot_keys(spark):
    from millrace.operators.joins import left_join_hot_right

    left = spark.range(50).withColumnRenamed("id", "a")
    right = spark.range(100).select((F.col("id") % 60).alias("b"), "id")
    joined = left_join_hot_right(left, right, "a", "b")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "salt" not in plan and "SortMergeJoin" not in plan and joined.count() == left.join(right, F.col("a") == F.col("b"), "left").count()


def test_many_keys_are_dealt_over_tasks_by_their_number(spark):
    from millrace.operators.keys import key_counts

    df = spark.range(6000).select((F.col("id") % 2000).alias("k")).union(spark.range(500).select(F.lit(7).alias("k")))
    want = Counter({(k, 3 + 500 * (k == 7)): 1 for k in range(2000)})
    counts = key_counts(df, "k", keys_per_task=200)
    sizes = counts.groupBy(F.spark_partition_id()).count().collect()
    assert rows(counts) == rows(key_counts(df, "k")) == want
    assert len(sizes) > 10 and max(r["count"] for r in sizes) < 300


def test_merge_joins_products_before_the_rows_are_wide(spark, monkeypatch):
    from millrace.operators import merge

    customer = spark.createDataFrame([(1,), (2,), (3,)], "c INT")
    orders = spark.createDataFrame([(10 + i, 1 + i % 2) for i in range(40)], "o INT, oc INT")
    lines = spark.createDataFrame([(10 + i % 30, i % 5 if i % 7 else None) for i in range(200)] + [(10, 1)] * 300, "lo INT, lp INT")
    product = spark.createDataFrame([(i, f"p{i}") for i in range(4)], "p INT, name STRING")
    want = customer.join(orders, F.col("c") == F.col("oc"), "left").join(lines, F.col("o") == F.col("lo"), "left")
    want = rows(want.join(product, F.col("lp") == F.col("p"), "left"))
    keys = (("c", "oc"), ("o", "lo"), ("lp", "p"))
    for small in (True, False):
        monkeypatch.setattr(merge, "fits_broadcast", lambda df, small=small: small)
        for rows_per_task in (20, 10**6):
            assert rows(merge.merge_chain(customer, orders, lines, product, *keys, rows_per_task=rows_per_task)) == want


def test_order_lines_of_one_file_are_dealt_over_tasks(spark):
    """Orders that one task reads give their lines in several, the same lines as a plain join."""
    from millrace.datagen import sales as gen

    ids = spark.range(20_000, numPartitions=1).withColumnRenamed("id", "order_id")
    products = spark.range(100, numPartitions=1).withColumnRenamed("id", "uniq_id")
    lines = gen.order_lines(ids, products, 10)
    each = [r["count"] for r in lines.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(each) > 1 and max(each) < 0.8 * sum(each)
    bought = gen._in_rounds(ids, "order_id", "buy", 100, 0.001).withColumnRenamed("round", "r")
    offered = gen._in_rounds(products, "uniq_id", "offer", 100, 0.8)
    key = gen.digest("line", F.col("order_id"), F.col("uniq_id"), F.col("round"))
    plain = bought.join(offered, F.col("r") == F.col("round"))
    plain = plain.select("order_id", "uniq_id", (gen.draw(key, 1, 14) + 1).cast("int").alias("quantity"))
    assert sum(each) == plain.count() and lines.exceptAll(plain).count() == 0
    assert gen.line_tasks(spark, 15e9) == 3001 and gen.line_tasks(spark, 0) == 1


def test_digests_of_pairs_are_those_of_md5():
    """Texts of all lengths around the blocks of the digest, with bytes of all values."""
    import hashlib
    import random

    from millrace.functions.digests import pair_draws

    some = random.Random(5)
    left = [some.randbytes(k) for k in (*range(0, 9), 31, 54, 55, 56, 62, 63, 64, 65, 119, 127, 128) for _ in range(2)]
    right = [some.randbytes(k) for k in (*range(0, 6), 47, 54, 55, 63, 64, 70) for _ in range(2)]
    some.shuffle(left)
    for n in (14, 256):
        want = [[int(hashlib.md5(a + b":" + b).hexdigest()[:7], 16) % n for b in right] for a in left]
        assert pair_draws(left, right, n).tolist() == want


def test_order_lines_come_from_blocks_of_pairs(spark, monkeypatch):
    """No digest is worked out row by row behind the join; the lines are those of a plain join, whatever the blocks."""
    from millrace.datagen import sales as gen

    ids = [str(i) if i % 3 else f"é{i}" * (1 + i % 40) for i in range(400)] + ["twice"] * 20 + [None] * 5
    order = spark.createDataFrame([(i,) for i in ids], "order_id STRING")
    product = spark.createDataFrame([(i % 40 if i % 9 else None,) for i in range(60)], "uniq_id INT")
    bought = gen._in_rounds(order, "order_id", "buy", 10, 0.3).withColumnRenamed("round", "r")
    offered = gen._in_rounds(product, "uniq_id", "offer", 10, 0.2)
    key = gen.digest("line", F.col("order_id"), F.concat_ws(":", "uniq_id", "round"))
    want = bought.join(offered, F.col("r") == F.col("round"))
    want = rows(want.select("order_id", "uniq_id", (gen.draw(key, 1, 14) + 1).cast("int").alias("quantity")))
    assert len(want) > 1000
    for small, size in ((True, 1024), (False, 7)):
        monkeypatch.setattr(gen, "fits_broadcast", lambda df, small=small: small)
        monkeypatch.setattr(gen, "BLOCK_ROWS", size)
        monkeypatch.setattr(gen, "BATCH_LINES", 3 * size)
        lines = gen.order_lines(order, product, 60, rounds=10, order_fraction=0.3, products_per_round=12)
        assert rows(lines) == want
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "md5" not in plan[: plan.index("Join")]


def test_draws_work_out_a_row_s_number_once(spark):
    from millrace.datagen import sales as gen

    ids = spark.range(3000).withColumnRenamed("id", "k")
    drawn = gen._in_rounds(ids, "k", "buy", 100, 0.01)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan and "lambda" not in plan
    for mean in (0.0, 0.3, 5.0, 200.0):
        u = gen.draw(gen.digest("x", F.col("k")), 1, 1 << 28) / F.lit(float(1 << 28))
        got = ids.select(u.alias("u"), gen.poisson_count(gen.digest("x", F.col("k")), 1, mean).alias("n")).collect()
        cuts = gen.poisson_cuts(mean)
        assert [r["n"] for r in got] == [sum(c <= r["u"] for c in cuts) for r in got]
