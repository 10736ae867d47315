"""Files per partition value, rows kept, repeatability, pruning."""

import glob
import os

from pyspark.sql import functions as F

from millrace.functions.common import let  # noqa: F401
from millrace.operators.grouping import layout_files
from millrace.operators.keys import counts_of_all_keys, skew_profile
from millrace.sinks import (
    add_year_month, cache_then_coalesce, date_predicates, write_bounded, write_by_value, write_dynamic, write_skew_split,
)
from millrace.workspace import fresh_dir, shared_root, stage


def files_per_value(path, column="d"):
    found = {}
    for folder in glob.glob(f"{path}/{column}=*"):
        found[folder.split("=")[-1]] = len(glob.glob(f"{folder}/*.orc"))
    return found


def skewed(spark):
    day = F.expr("CASE WHEN id % 3 = 0 THEN DATE '2020-01-01' WHEN id % 50 = 1 THEN NULL "
                 "ELSE date_add(DATE '2020-01-02', CAST(id % 9 AS INT)) END")
    return stage(spark.range(0, 6000, 1, 6).select("id", F.lit("same").alias("x"), day.alias("d")))


def same_rows(spark, path, df):
    back = spark.read.orc(path).withColumn("d", F.col("d").cast("date")).select(*df.columns)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_one_file_per_value(spark):
    df, path = skewed(spark), fresh_dir(spark, "one")
    write_by_value(df, "d", path, partitions=8)
    counts = files_per_value(path)
    assert set(counts.values()) == {1} and len(counts) == 8
    same_rows(spark, path, df)


def test_large_value_gets_the_files_it_needs(spark):
    df, path = skewed(spark), fresh_dir(spark, "bounded")
    write_by_value(df, "d", path, rows_per_file=600, partitions=32)
    counts = files_per_value(path)
    assert counts.pop("2020-01-01") >= 2 and max(counts.values()) <= 2
    same_rows(spark, path, df)


def test_identical_rows_are_spread(spark):
    base = stage(spark.range(0, 4000, 1, 8).select(F.lit(1).alias("x"), F.lit("hot").alias("d")))
    path = fresh_dir(spark, "copies")
    write_by_value(base, "d", path, rows_per_file=700, partitions=32)
    assert files_per_value(path)["hot"] >= 3
    assert spark.read.orc(path).count() == 4000


def test_skew_split_is_repeatable(spark):
    df, path = skewed(spark), fresh_dir(spark, "split")
    hot = spark.createDataFrame([("2020-01-01",)], "v STRING").select(F.col("v").cast("date").alias("hot_key"))
    for _ in range(2):
        write_skew_split(df, "d", path, hot, hot_files=4, partitions=16)
        counts = files_per_value(path)
        assert 2 <= counts.pop("2020-01-01") <= 4
        assert set(counts.values()) == {1}
        assert "__HIVE_DEFAULT_PARTITION__" in counts
        same_rows(spark, path, df)


def test_bounded_writers(spark):
    df, path = spark.range(1000), fresh_dir(spark, "bounded")
    assert write_bounded(df, path, rows=1000) == 1
    assert len(glob.glob(f"{path}/*.parquet")) == 1
    assert write_bounded(df, fresh_dir(spark, "b"), rows_per_file=300) == 4
    assert cache_then_coalesce(df, fresh_dir(spark, "c"), rows_per_file=600) == 2


def test_dynamic_overwrite_keeps_the_other_partitions(spark):
    df, path = skewed(spark).filter("d is not null"), fresh_dir(spark, "dynamic")
    write_dynamic(df, ["d"], path)
    one = df.filter("d = DATE '2020-01-02'").withColumn("x", F.lit("new"))
    write_dynamic(one, ["d"], path)
    back = spark.read.orc(path)
    assert back.count() == df.count()
    assert back.filter("x = 'new'").count() == one.count()


def test_hot_month_is_spread_over_files(spark):
    path = fresh_dir(spark, "ym-hot")
    df = add_year_month(skewed(spark), F.col("d"))
    write_dynamic(df, ["order_year", "order_month"], path, rows_per_file=1500, partitions=16)
    hot = glob.glob(f"{path}/order_year=2020/order_month=1/*.orc")
    assert len(hot) >= 3
    assert len(glob.glob(f"{path}/order_year=__HIVE*/*/*.orc")) == 1
    assert spark.read.orc(path).count() == df.count()


def test_year_month_pruning(spark):
    path = fresh_dir(spark, "ym")
    write_dynamic(
        add_year_month(skewed(spark).filter("d is not null"), F.col("d")), ["order_year", "order_month"], path
    )
    pruned = spark.read.orc(path).filter(date_predicates(["2020-01-01", "2020-01-05"], day="d"))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "order_year" in filters.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert pruned.count() == skewed(spark).filter("d in (DATE '2020-01-01', DATE '2020-01-05')").count()


def test_orc_filter_reaches_the_scan(spark):
    path = fresh_dir(spark, "pushed")
    spark.range(100).write.orc(path)
    plan = spark.read.orc(path).filter("id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,7)]" in plan


def test_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_root(spark) == configured.rstrip("/")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_observed_write_of_an_empty_table(spark):
    from millrace.sinks import write_observed

    df = spark.createDataFrame([], "a STRING, b INT")
    assert write_observed(df, fresh_dir(spark, "none")) == {"rows": 0, "nulls": 0, "bytes": 0}
    rows = spark.createDataFrame([("é", None), (None, 1)], "a STRING, b INT")
    assert write_observed(rows, fresh_dir(spark, "two")) == {"rows": 2, "nulls": 2, "bytes": 2}


def test_catalogue_table_opens_the_days_asked_for_only(spark):
    from millrace.sinks import write_table_by_value

    location = fresh_dir(spark, "days")
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    df = skewed(spark)
    write_table_by_value(df, "d", name, location, partitions=8)
    some = spark.table(name).filter("d IN (DATE '2020-01-01', DATE '2020-01-04')")
    assert len(some.inputFiles()) == 2 and some.count() == df.filter("d IN (DATE '2020-01-01', DATE '2020-01-04')").count()
    assert spark.table(name).count() == df.count()
    changed = df.filter("d = DATE '2020-01-04'").withColumn("x", F.lit("new"))
    write_table_by_value(changed, "d", name, location, partitions=8)
    assert spark.table(name).count() == df.count() and spark.table(name).filter("x = 'new'").count() == changed.count()
    spark.sql(f"DROP TABLE {name}")


def test_sizes_of_files_are_those_on_disk(spark):
    path = fresh_dir(spark, "sizes")
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("d"))
    write_by_value(df, "d", path, rows_per_file=700)
    want = {}
    for file in glob.glob(f"{path}/d=*/*.orc"):
        day = file.split("/d=")[1].split("/")[0]
        want.setdefault(None if day.startswith("__") else int(day), []).append(os.path.getsize(file))
    rows = {r["d"]: r["n"] for r in df.groupBy("d").agg(F.count("*").alias("n")).collect()}
    found = layout_files(spark.read.orc(path), "d").collect()
    assert {r["d"]: r["n_rows"] for r in found} == rows
    for r in found:
        sizes = want[r["d"]]
        assert (r["n_files"], r["least_bytes"], r["most_bytes"]) == (len(sizes), min(sizes), max(sizes))
        assert (r["n_files"] > 1) == (r["n_rows"] > 700) and abs(r["avg_bytes"] - sum(sizes) / len(sizes)) < 1e-6


def test_sizes_of_an_empty_layout(spark):
    path = fresh_dir(spark, "sizes")
    spark.range(0).select("id", F.col("id").alias("d")).write.orc(path)
    assert layout_files(spark.read.schema("id long, d long").orc(path), "d").count() == 0


def test_profile_of_all_keys_scans_each_table_once(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 5 > 0, 0).otherwise(F.col("id")).alias("a"), F.lit(None).cast("int").alias("b"))
    path = fresh_dir(spark, "profile")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    counts = counts_of_all_keys({"a": (stored, F.col("a")), "b": (stored, F.col("b"))})
    assert counts._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    found = skew_profile({"a": (stored, F.col("a")), "b": (stored, F.col("b"))}).collect()
    assert [tuple(r) for r in found] == [("a", 200, 1000, 801, 1.0, 801.0, 1)]


def test_values_counted_on_a_narrow_table_that_stands_for_more_rows(spark):
    base = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("d"))
    narrow = base.filter("id % 8 < 2").select("d")  # one row in four of the hot value
    path = fresh_dir(spark, "stands-for")
    write_by_value(base, "d", path, rows_per_file=300, count_on=narrow, rows_each=4.0)
    back = spark.read.schema("id BIGINT, d STRING").orc(path)
    sizes = back.groupBy("d", F.input_file_name().alias("file")).count().collect()
    hot = [r["count"] for r in sizes if r["d"] == "hot"]
    assert back.count() == 4000 and sum(hot) == 2000
    tasks = {r["file"].rsplit("/", 1)[-1].split("-")[1] for r in sizes if r["d"] == "hot"}
    assert len(tasks) >= 4  # 500 counted rows stand for 2,000, which need seven tasks, dealt by a hash
    assert {r["d"] for r in sizes if r["d"] != "hot"} == {str(i) for i in range(1, 40, 2)}
