"""Codec, restart, damaged payloads, generator rules, sources."""

import gzip
import subprocess
import sys

from pyspark.sql import functions as F

from millrace.datagen import sales as gen
from millrace.operators.dump import accepted, typed_lines
from millrace.schemas import TWEET
from millrace.sources import article_lines, read_dataset, read_delimited, read_wiki_xml
from millrace.functions.tweets import add_text_columns, effective_text, flatten_tweets
from millrace.sinks import write_csv
from millrace.streaming import consume, decode_payload, encode_payload, parse_records, read_record_stream
from millrace.workspace import fresh_dir


def test_codec(spark):
    text = '{"id":1,"t":"é"}'
    packed = gzip.compress(text.encode())
    payloads = [packed, text.encode(), packed[:12], b"\xff\xfe", b"", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i INT, payload BINARY")
    got = [r[0] for r in df.orderBy("i").select(decode_payload("payload")).collect()]
    assert got == [text, text, None, None, "", None]
    back = spark.createDataFrame([(text,), (None,)], "t STRING").select(decode_payload(encode_payload("t")).alias("x"))
    assert {r["x"] for r in back.collect()} == {text, None}
    flags = [r["is_decoded"] for r in parse_records(df, "id INT").orderBy("i").collect()]
    assert flags == [True, True, False, False, False, False]


def test_restart_adds_nothing_and_new_records_arrive_once(spark):
    source, out, position = fresh_dir(spark, "s"), fresh_dir(spark, "o"), fresh_dir(spark, "p")

    def arrive(first, last):
        rows = spark.range(first, last).select(
            F.uuid().alias("partition_key"), encode_payload(F.to_json(F.struct("id"))).alias("payload"),
            (F.col("id") % 2).cast("int").alias("shard"),
        )
        rows.write.mode("append").partitionBy("shard").parquet(source)

    def drain():
        consume(read_record_stream(spark, source), "id BIGINT", out, position).awaitTermination()
        return sorted(r["id"] for r in spark.read.schema("id BIGINT").json(out).collect())

    arrive(0, 10)
    assert drain() == list(range(10))
    assert drain() == list(range(10))
    arrive(10, 15)
    assert drain() == list(range(15))


def test_paced_consumption_ends_when_stopped(spark):
    source, out = fresh_dir(spark, "paced"), fresh_dir(spark, "paced-out")
    rows = spark.range(20).select(
        F.uuid().alias("partition_key"), encode_payload(F.to_json(F.struct("id"))).alias("payload"),
        (F.col("id") % 2).cast("int").alias("shard"),
    )
    rows.write.partitionBy("shard").parquet(source)
    query = consume(read_record_stream(spark, source, 1), "id BIGINT", out, fresh_dir(spark, "paced-p"), pace="100 milliseconds")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert sorted(r["id"] for r in spark.read.schema("id BIGINT").json(out).collect()) == list(range(20))


def test_one_notion_of_valid_json(spark):
    bodies = ['{"id":1} garbage', '{"id":1,"id":2}', '{"id":1}', '[1]', '{"id":1},{"id":2}', ""]
    df = spark.createDataFrame([(i, b.encode()) for i, b in enumerate(bodies)], "i INT, payload BINARY")
    assert [r["is_decoded"] for r in parse_records(df, "id INT").orderBy("i").collect()] == [False, True, True, False, False, False]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_costly_steps_run_once(spark):
    records = spark.createDataFrame([("k", b"{}")], "partition_key STRING, payload BINARY")
    assert executed(parse_records(records, "id INT").filter("is_decoded").select("record.*")).count("ArrowEvalPython") == 1
    lines = spark.createDataFrame([("a\tb\t1\tx\t{}",)], "value STRING")
    assert executed(accepted(typed_lines(lines))).count("split(") == 1
    pages = spark.createDataFrame([("t", "words")], "title STRING, text STRING")
    assert executed(article_lines(pages)).count("regexp_extract_all") == 1


def test_tweet_branches(spark):
    lines = [
        '{"id":1,"lang":"en","text":"RT @a: cut","truncated":false,"retweeted_status":{"truncated":true,"extended_tweet":{"full_text":"full"}}}',
        '{"id":2,"lang":"en","text":"RT @a: short","truncated":false,"retweeted_status":{"truncated":false,"text":"short"}}',
        '{"id":3,"lang":"en","text":"cut","truncated":true,"extended_tweet":{"full_text":"long"}}',
        '{"id":4,"lang":"en","text":"own #x @y a@b.cd","truncated":false}',
        '{"id":5,"lang":"en","text":"own"}',
        '{"id":6,"lang":"en","text":"RT by hand","truncated":false}',
        '{"id":7,"lang":"en","truncated":false}',
        '{"id":8,"lang":"de","text":"x","truncated":false}',
    ]
    path = fresh_dir(spark, "tweets")
    spark.createDataFrame([(line,) for line in lines * 2], "value STRING").write.text(path)
    tweets = spark.read.schema(TWEET).json(path)
    texts = {r["id"]: r["t"] for r in tweets.select("id", effective_text().alias("t")).collect()}
    assert texts == {1: "full", 2: "short", 3: "long", 4: "own #x @y a@b.cd", 5: None, 6: None, 7: None, 8: "x"}
    flat = flatten_tweets(tweets)
    assert flat.count() == 7
    assert {r["id"] for r in add_text_columns(flat).collect()} == {1, 2, 3, 4}
    assert add_text_columns(flat, null_sentinel=True).count() == 7
    row = add_text_columns(flat).filter("id = 4").first()
    assert (row["hashtag"], row["mention"], row["emails"]) == (["#x"], ["@y"], ["a@b.cd"])
    assert row["clean_tweet_text"] == "own x y "


def test_headers_and_bad_values(spark):
    root = fresh_dir(spark, "csv")
    lines = spark.createDataFrame([("o1", "p1", 3), ("o2", "p2", None)], "order_id STRING, uniq_id STRING, quantity INT")
    write_csv(lines, root, "orders_product")
    assert read_dataset(spark, root, "orders_product", "*.gz").count() == 2  # no row lost to a header
    product = spark.createDataFrame([("p1", "n", "m", "9.99", "d")], "uniq_id STRING, product_name STRING, "
                                    "manufacturer STRING, price STRING, description STRING")
    write_csv(product, root, "product")
    assert read_dataset(spark, root, "product").first()["price"] == "9.99"
    path = fresh_dir(spark, "bad")
    spark.createDataFrame([("a|b|x",), ("a|b|7",)], "value STRING").write.text(path)
    got = read_delimited(spark, path, "order_id STRING, uniq_id STRING, quantity INT").collect()
    assert {r["quantity"] for r in got} == {None, 7}


def test_wiki_dump_with_root_splits_between_pages(spark, tmp_path):
    body = "word " * 60
    pages = "".join(
        f"  <page>\n <title>T{i}</title><revision><text xml:space='preserve'>{{{{box|{{{{x}}}}}}}} "
        f"'''{body}''' [[link|shown]] n{i}</text></revision>\n  </page>\n" for i in range(300)
    )
    broken = "<page><title>bad</title><revision><text>open</revision></page>"
    short = "<page><title>short</title><revision><text>few words</text></revision></page>"
    file = tmp_path / "dump.xml"
    file.write_text(f"<mediawiki>\n<siteinfo>x</siteinfo>{pages}{broken}{short}</mediawiki>\n")
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    reader.conf.set("spark.sql.files.openCostInBytes", "0")
    articles = read_wiki_xml(reader, str(file))
    assert articles.rdd.getNumPartitions() > 3
    lines = {r["title"]: r["line"] for r in article_lines(articles).collect()}
    assert set(lines) == {f"T{i}" for i in range(300)}
    assert lines["T5"] == " ".join(["word"] * 60 + ["shown"]) or lines["T5"].endswith("shown n")


def test_generated_rules(spark):
    people = gen.customers(spark.range(500)).cache()
    assert people.select("cust_id").distinct().count() == 500
    assert people.filter("birth_date > '2005-12-31'").count() == 0
    assert people.filter("substr(birth_date, 6) = '02-29' AND substr(user_create_date, 6) NOT IN ('03-01', '02-29')").count() == 0
    orders = gen.orders(people, 2021).join(people, "cust_id")
    assert 1200 < orders.count() < 1800
    first = F.year(F.col("user_create_date").cast("date"))
    assert orders.filter(F.year(F.col("order_date").cast("timestamp")) < first).count() == 0
    assert orders.filter("shipping_date < order_date OR delivery_date < shipping_date").count() == 0
    assert orders.select("order_id").distinct().count() == orders.count()
    skew = gen.skew_orders(people, "2020-01-01")
    assert skew.filter("order_date NOT LIKE '2020-01-01 %'").count() == 0
    product = spark.range(100).select(F.col("id").cast("string").alias("uniq_id"))
    order_ids = spark.range(3000).select(F.col("id").cast("string").alias("order_id"))
    lines = gen.order_lines(order_ids, product, 100).cache()
    assert 1200 < lines.count() < 4000
    assert lines.filter("quantity NOT BETWEEN 1 AND 14").count() == 0


def test_functions_travel_without_the_package(tmp_path):
    from pyspark import cloudpickle

    from millrace.functions.udf import clean_text_python
    from millrace.streaming.codec import _decode

    blob = tmp_path / "functions.bin"
    blob.write_bytes(cloudpickle.dumps((clean_text_python, _decode)))
    code = (
        "import pickle; clean, decode = pickle.load(open('functions.bin', 'rb')); "
        "print(clean(\"Don't <b>stop</b>\"), decode(b'x'))"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert out.stdout.strip() == "do not stop x", out.stderr


def records_of(spark, ids, shard):
    from millrace.streaming import to_records

    return to_records(spark.createDataFrame([(i,) for i in ids], "n BIGINT"), 2, shard=F.lit(shard))


def paced_run(spark, log, checkpoint, out, start="earliest"):
    from millrace.streaming.shards import read_paced

    run = read_paced(spark, log, checkpoint, 3, start).writeStream.format("parquet").option("path", out)
    run = run.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return [p["numInputRows"] for p in run.recentProgress]


def test_paced_source_advances_by_shard_and_goes_on_after_a_restart(spark, tmp_path):
    from millrace.streaming.shards import PacedReader, publish_batch

    log, checkpoint, out = (str(tmp_path / n) for n in ("log", "position", "out"))
    assert publish_batch(records_of(spark, range(7), 0), log, 0)
    publish_batch(records_of(spark, range(100, 102), 1), log, 1)
    assert not publish_batch(records_of(spark, range(50), 0), log, 0)
    late = str(tmp_path / "late")
    assert sum(paced_run(spark, log, late, str(tmp_path / "late-out"), "latest")) == 0
    moved = [sum(paced_run(spark, log, checkpoint, out)) for _ in range(4)]
    assert moved == [5, 3, 1, 0]
    publish_batch(records_of(spark, range(7, 9), 0), log, 2)
    publish_batch(records_of(spark, range(200, 201), 2), log, 3)
    assert sum(paced_run(spark, log, checkpoint, out)) == 3
    got = spark.read.parquet(out).select(F.from_json(decode_payload("payload"), "n BIGINT")["n"].alias("n"), "shard").collect()
    assert sorted((r["n"], r["shard"]) for r in got) == [*((i, 0) for i in range(9)), (100, 1), (101, 1), (200, 2)]
    assert sum(paced_run(spark, log, late, str(tmp_path / "late-out"), "latest")) == 3
    reader = PacedReader({"path": str(tmp_path / "none"), "checkpoint": str(tmp_path / "x"), "records": "5"})
    assert reader.latestOffset() == {} and reader.partitions({}, {}) == []


def test_sums_of_squares_beyond_a_bigint(spark):
    from millrace.plans.streams import shard_totals

    def totals(ids):
        rows = spark.createDataFrame([(i, 0, t) for t, i in enumerate(ids)], "event_id BIGINT, shard INT, trigger BIGINT")
        return shard_totals(rows)

    large = [3_000_000_000, 3_000_000_001, -9_000_000_000_000_000_000]
    row = totals(large).first()
    assert int(row["square_sum"]) == sum(i * i for i in large) and row["id_sum"] == sum(large) and row["n_triggers"] == 3
    few = totals([3_000_000_000])
    assert dict(few.dtypes)["square_sum"] == "bigint" and few.first()["square_sum"] == 9 * 10**18
    assert dict(totals([]).dtypes)["square_sum"] == "bigint"
