"""Text functions over whole documents, and the record-cleaning job."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.accents import remove_accented_chars
from ..functions.contractions import expand_contractions
from ..functions.sql_names import register_sql_functions
from ..functions.tweets import add_text_columns, effective_text, flatten_tweets, flatten_wide, retweet_flag
from ..functions.udf import compose_text, register_python_udfs
from ..functions.words import clean_text_words, register_word_cleaning
from ..operators.phrases import mentions
from ..schemas import TWEET
from ..sinks import write_bounded
from ..sources import read_json_lines
from ..workspace import fresh_dir
from .registry import query, table, wide_table

# Social-media features behind every document. The same text is SQL for both engines; chr(39) is the apostrophe.
POST = """
text || ' <b>bold &amp; caf&eacute; &#233;</b> Don' || chr(39) || 't it' || chr(39) || 's John' || chr(39) || 's '
|| chr(9) || 'tab' || chr(13) || chr(10) || 'line #tag' || CAST(doc_id % 7 AS STRING) || ' @user'
|| CAST(doc_id % 11 AS STRING) || ' mail me.' || CAST(doc_id AS STRING) || '@example.com or ME@EX.COM see https://t.co/'
|| CAST(doc_id AS STRING) || '?q=1 and www.foo.com at 12:30 on 1/2 okay? we' || chr(39) || 're gonna [stop]_^ <!-- no --> end <a title=don' || chr(39) || 't>kept</a> &#00000233; &#x00000E9; they'
|| chr(39) || 'd' || chr(39) || 've București Tiếng Việt Привет мир Αθήνα ＡＢ１'
"""
# What the other scripts of the posts become.
FOREIGN = {"București": "Bucuresti", "Tiếng Việt": "Tieng Viet", "Привет мир": "Privet mir", "Αθήνα": "Athena", "ＡＢ１": "AB1"}


def posts(spark, sf):
    documents = wide_table(spark, sf, "documents", "doc_id", "lang", "text")
    return documents.select("doc_id", "lang", F.expr(POST).alias("post"))


POSTS_SQL = f"(SELECT doc_id, lang, {POST} AS post FROM documents)"

# --- the same steps in the other engine's SQL ------------------------------------------------------

SPACES = r"\t-\r\x1c-\x1f\x85\p{Z}"
URL_RE = (
    r"(?:http|https|ftp|ssh|sftp|www)://[\p{L}\p{N}_-]+(?:\.[\p{L}\p{N}_-]+)+"
    r"(?:[\p{L}\p{N}_.,@?^=%&:/~+#-]*[\p{L}\p{N}_@?^=%&/~+#-])?"
)
EMAIL_RE = r"[a-z0-9+._-]+@[a-z0-9+._-]+\.[a-z0-9+_-]+"
TAGS_RE = r"""(?s)<!--.*?-->|</?[A-Za-z](?:[^>=]|=[ \t\r\n]*"[^"]*"|=[ \t\r\n]*''[^'']*''|=)*>"""


def sql_url(x):
    return f"regexp_replace({x}, '{URL_RE}', '', 'g')"


def sql_html(x):
    nodes = (
        f"array_to_string(list_filter(list_transform(string_split(regexp_replace({x}, '{TAGS_RE}', chr(1), 'g'), chr(1)), "
        f"lambda n: regexp_replace(n, '^[{SPACES}]+|[{SPACES}]+$', '', 'g')), lambda n: n <> ''), ' ')"
    )
    for entity in ("&eacute;", "&#233;", "&#00000233;", "&#x00000E9;"):
        nodes = f"replace({nodes}, '{entity}', 'é')"
    return f"replace({nodes}, '&amp;', '&')"


def sql_accents(x):
    for text, ascii_text in FOREIGN.items():
        x = f"replace({x}, '{text}', '{ascii_text}')"
    return f"replace(strip_accents({x}), 'ß', 'ss')"


def sql_tabs(x):
    return f"regexp_replace({x}, '[\\t\\r\\n]', ' ', 'g')"


def sql_ascii(x):
    return f"regexp_replace({x}, '[^\\x00-\\x7F]|\\?', '', 'g')"


def sql_email(x):
    return f"regexp_replace({x}, '{EMAIL_RE}', '', 'g')"


def sql_contractions(x):
    """Only words of the posts need to be spelled out here."""
    words = {"they'd've": "they would have", "don't": "do not", "it's": "it is", "we're": "we are", "gonna": "going to"}
    out = x
    for word, full in words.items():
        quoted = word.replace("'", "''")
        for a, b in ((quoted, full), (quoted.capitalize(), full.capitalize())):
            out = f"regexp_replace({out}, '\\b{a}\\b', '{b}', 'g')"
    return out


def sql_punctuation(x):
    return f"regexp_replace({x}, '[!-/:-@\\[-`{{-~]', '', 'g')"


def sql_blanks(x):
    return f"regexp_replace({x}, ' +', ' ', 'g')"


def sql_clean(x):
    x = sql_email(sql_ascii(sql_tabs(sql_accents(sql_html(sql_url(x))))))
    return sql_blanks(sql_tabs(sql_punctuation(sql_contractions(f"lower({x})"))))


def sql_tokens(x, sign):
    return f"array_to_string(list_filter(regexp_split_to_array({x}, '[{SPACES}]+'), lambda t: starts_with(t, '{sign}')), ' ')"


def _register_step(name, function, expression):
    @query(name, f"SELECT doc_id, {expression} AS clean FROM {POSTS_SQL}")
    def _step(spark, sf, function=function):
        return posts(spark, sf).select("doc_id", function(F.col("post")).alias("clean"))


_register_step("text_remove_accents", remove_accented_chars, sql_accents("post"))
_register_step("text_remove_tabs", T.remove_tabs, sql_tabs("post"))
_register_step("text_remove_blanks", T.remove_blanks, sql_blanks("post"))
_register_step(
    "text_remove_digits", T.remove_digits, "regexp_replace(post, '\\p{Nd}[./:-]\\p{Nd}|\\p{Nd}', '', 'g')"
)
_register_step("text_remove_punct", T.remove_all_punctuation, sql_punctuation("post"))
_register_step("text_ascii", T.ascii_to_string, sql_ascii("post"))
_register_step(
    "text_remove_special", T.remove_special_characters,
    f"regexp_replace(post, '[^a-zA-Z\\[\\\\\\]^_`0-9{SPACES}]', '', 'g')",
)
_register_step(
    "text_remove_special_strict",
    lambda c: T.remove_special_characters(c, remove_digits=True, strict=True),
    f"regexp_replace(post, '[^a-zA-Z{SPACES}]', '', 'g')",
)
_register_step("text_lower", T.to_lower, "lower(post)")
_register_step("text_remove_url", T.remove_url, sql_url("post"))
_register_step("text_remove_email", T.remove_email_address, sql_email("post"))
_register_step(
    "text_remove_email_any_case", lambda c: T.remove_email_address(c, ignore_case=True),
    f"regexp_replace(post, '(?i){EMAIL_RE}', '', 'g')",
)
_register_step("text_contractions", expand_contractions, sql_contractions("post"))
_register_step(
    "text_emails", lambda c: F.array_join(T.get_email_address(c), " "),
    f"array_to_string(regexp_extract_all(post, '{EMAIL_RE}'), ' ')",
)
_register_step("text_hashtags", lambda c: F.array_join(T.get_hashtag(c), " "), sql_tokens("post", "#"))
_register_step(
    "text_mentions", lambda c: T.array_as_text(T.get_mention(c)),
    "'[' || replace(" + sql_tokens("post", "@") + ", ' ', ', ') || ']'",
)
_register_step("text_clean_chain", clean_text_words, sql_clean("post"))
_register_step("text_clean_expressions", T.clean_text, sql_clean("post"))
_register_step("text_clean_two_step", T.clean_two_step, sql_accents(sql_html("post")))


@query("text_clean_fused", f"SELECT doc_id, {sql_clean('post')} AS clean FROM {POSTS_SQL}")
def _text_clean_fused(spark, sf):
    """All steps behind one SQL name."""
    register_word_cleaning(spark)
    return posts(spark, sf).select("doc_id", F.call_function("clean_words_udf", F.col("post")).alias("clean"))


@query("filter_track", f"""
SELECT doc_id FROM {POSTS_SQL}
WHERE contains(lower(post), '#tag3') OR contains(lower(post), 'threa the') OR contains(lower(post), 'nicht')""")
def _filter_track(spark, sf):
    hit = T.contains_any_phrase(F.col("post"), ["#TAG3", "threa the", "Nicht"])
    return posts(spark, sf).filter(hit).select("doc_id")


@query("filter_track_many", """
SELECT d.doc_id, b.item_id FROM documents d JOIN (
 SELECT item_id, text FROM benchmark UNION ALL SELECT -1, 'the and' UNION ALL SELECT -2, 'QUE' UNION ALL SELECT -3, '') b
ON b.text <> '' AND contains(lower(d.text), lower(b.text))""")
def _filter_track_many(spark, sf):
    """All benchmark passages as phrases, and three short ones."""
    passages = table(spark, sf, "benchmark").select("item_id", "text")
    more = spark.createDataFrame([(-1, "the and"), (-2, "QUE"), (-3, "")], passages.schema)
    return mentions(wide_table(spark, sf, "documents", "doc_id", "text"), passages.union(more))


# --- nested records --------------------------------------------------------------------------------


def tweets(spark, sf):
    """Every document as two identical records of one of six kinds, in the pinned record schema."""
    kind = F.col("doc_id") % 6
    post = F.col("post")
    empty = F.lit(None).cast("string")
    author = F.col("doc_id").cast("string")
    record = posts(spark, sf).select(
        F.col("doc_id").alias("id"),
        author.alias("id_str"),
        F.lit("Fri Oct 23 03:28:59 +0000 2020").alias("created_at"),
        "lang",
        F.lit("web").alias("source"),
        F.when(kind.isin(0, 1), F.concat(F.lit("RT @someone: "), post)).otherwise(post).alias("text"),
        (kind == 2).alias("truncated"),
        F.lit("1603423739000").alias("timestamp_ms"),
        F.struct(
            F.col("doc_id").alias("id"), author.alias("id_str"), F.concat(F.lit("name "), author).alias("name"),
            F.concat(F.lit("user"), author).alias("screen_name"), F.col("lang").alias("location"),
            empty.alias("description"),
        ).alias("user"),
        F.when(kind == 2, F.struct(post.alias("full_text"))).alias("extended_tweet"),
        F.when(
            kind.isin(0, 1),
            F.struct(
                post.alias("text"), (kind == 0).alias("truncated"),
                F.struct(F.lit("someone").alias("screen_name")).alias("user"),
                F.when(kind == 0, F.struct(post.alias("full_text"))).alias("extended_tweet"),
            ),
        ).alias("retweeted_status"),
        F.when(
            kind == 3,
            F.struct(
                F.lit("quoted").alias("text"), F.struct(F.lit("other").alias("screen_name")).alias("user"),
                F.lit(None).cast("struct<full_text:string>").alias("extended_tweet"),
            ),
        ).alias("quoted_status"),
        F.when(kind == 5, F.struct(F.lit("Spain").alias("country"), F.lit("ES").alias("country_code"))).alias("place"),
    )
    return record.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")


def stored_tweets(spark, sf):
    path = fresh_dir(spark, "records")
    tweets(spark, sf).write.json(path)
    return read_json_lines(spark, path, TWEET)


TWICE = "(SELECT doc_id, lang, post, unnest([1, 2]) AS copy FROM " + POSTS_SQL + ")"


@query("flag_retweet", f"""
SELECT doc_id AS id, CASE WHEN doc_id % 6 IN (0, 1) OR starts_with(post, 'RT') THEN 'Y' ELSE 'N' END AS is_it_a_retweet
FROM {TWICE}""")
def _flag_retweet(spark, sf):
    return tweets(spark, sf).select("id", retweet_flag(F.col("text")).alias("is_it_a_retweet"))


@query("tweet_effective_text", f"SELECT doc_id AS id, post AS tweet_text FROM {TWICE}")
def _tweet_effective_text(spark, sf):
    return tweets(spark, sf).select("id", effective_text().alias("tweet_text"))


@query("nested_flatten", f"""
SELECT doc_id AS id, CAST(doc_id AS VARCHAR) AS user_id_str, 'name ' || CAST(doc_id AS VARCHAR) AS user_name,
       lang AS user_location, CASE WHEN doc_id % 6 = 0 THEN post END AS full_text,
       CASE WHEN doc_id % 6 IN (0, 1) THEN post END AS retweeted_text,
       CASE WHEN doc_id % 6 IN (0, 1) THEN 'RT @someone: ' || post ELSE post END AS text FROM {TWICE}""")
def _nested_flatten(spark, sf):
    return tweets(spark, sf).select(
        "id", F.col("user.id_str").alias("user_id_str"), F.col("user.name").alias("user_name"),
        F.col("user.location").alias("user_location"),
        F.col("retweeted_status.extended_tweet.full_text").alias("full_text"),
        F.col("retweeted_status.text").alias("retweeted_text"), "text",
    )


@query("tweet_flatten_wide", f"""
SELECT 'user' || CAST(doc_id AS VARCHAR) AS user_screen_name, lang AS user_location,
       CASE WHEN k = 2 THEN post END AS extended_tweet_full_text,
       CASE WHEN k IN (0, 1) THEN 'someone' END AS retweeted_status_user_screen_name,
       CASE WHEN k IN (0, 1) THEN post END AS retweeted_status_text,
       CASE WHEN k = 0 THEN post END AS retweeted_status_extended_tweet_full_text,
       CASE WHEN k = 3 THEN 'other' END AS quoted_status_user_screen_name,
       CASE WHEN k = 3 THEN 'quoted' END AS quoted_status_text,
       CAST(NULL AS VARCHAR) AS quoted_status_extended_tweet_full_text,
       CASE WHEN k = 5 THEN 'Spain' END AS place_country, CASE WHEN k = 5 THEN 'ES' END AS place_country_code,
       '1603423739000' AS timestamp_ms
FROM (SELECT *, doc_id % 6 AS k FROM {TWICE})""")
def _tweet_flatten_wide(spark, sf):
    return flatten_wide(stored_tweets(spark, sf))


TWEET_JOB_SQL = f"""
SELECT doc_id AS id, lang, CAST(doc_id AS VARCHAR) AS user_id_str, post AS tweet_text,
       {sql_tokens("post", "#")} AS hashtag, {sql_tokens("post", "@")} AS mention,
       array_to_string(regexp_extract_all(post, '{EMAIL_RE}'), ' ') AS emails, {sql_clean("post")} AS clean_tweet_text
FROM {POSTS_SQL} WHERE lang = 'en'"""


@query("tweet_job", TWEET_JOB_SQL)
def _tweet_job(spark, sf):
    """Read JSON lines, flatten, clean, store as Parquet, read back."""
    path = fresh_dir(spark, "tweets")
    cleaned = add_text_columns(flatten_tweets(stored_tweets(spark, sf)))
    write_bounded(cleaned, path, files=4, rows=table(spark, sf, "documents").count())
    stored = spark.read.parquet(path)
    lists = {c: F.array_join(c, " ") for c in ("hashtag", "mention", "emails")}
    return stored.withColumns(lists).select(
        "id", "lang", "user_id_str", "tweet_text", "hashtag", "mention", "emails", "clean_tweet_text"
    )


@query("tweet_job_sql", TWEET_JOB_SQL)
def _tweet_job_sql(spark, sf):
    """The same job as SQL text with nested calls of the registered functions."""
    lists = {"hashtag": "get_hashtag_udf", "mention": "get_mention_udf", "emails": "get_email_address_udf"}
    register_sql_functions(spark, ["remove_url_udf", *lists.values()])
    register_word_cleaning(spark)
    flatten_tweets(stored_tweets(spark, sf)).createOrReplaceTempView("flat_posts")
    cleaned = "clean_words_udf(remove_url_udf(tweet_text))"
    columns = [f"array_join({function}(tweet_text), ' ') AS {name}" for name, function in lists.items()]
    return spark.sql(
        f"SELECT id, lang, user_id_str, tweet_text, {', '.join(columns)}, {cleaned} AS clean_tweet_text "
        "FROM flat_posts WHERE tweet_text IS NOT NULL"
    )


# --- user-defined functions ------------------------------------------------------------------------


# What a Python function is for: Unicode normal forms, which no built-in expression has, over whole Arrow batches. The
# letters with an acute accent come in two code points and leave as one.
APART = "replace(replace(post, 'é', 'e' || chr(769)), 'á', 'a' || chr(769))"


@query("udf_dataframe", f"""
SELECT doc_id, nfc_normalize({APART}) AS composed, length(nfc_normalize({APART})) AS chars, length({APART}) AS chars_apart
FROM {POSTS_SQL}""")
def _udf_dataframe(spark, sf):
    apart = posts(spark, sf).select("doc_id", F.expr(APART.replace("chr(769)", "'\\u0301'")).alias("apart"))
    composed = apart.select("doc_id", "apart", compose_text(F.col("apart")).alias("composed"))
    lengths = {name: F.char_length(c).cast("bigint") for name, c in (("chars", "composed"), ("chars_apart", "apart"))}
    return composed.withColumns(lengths).drop("apart")


@query("udf_sql", f"SELECT doc_id, nfc_normalize({APART}) AS composed FROM {POSTS_SQL} WHERE length({APART}) > length(post)")
def _udf_sql(spark, sf):
    register_python_udfs(spark)
    posts(spark, sf).createOrReplaceTempView("posts_for_udf")
    apart = APART.replace("chr(769)", "'\\u0301'")
    return spark.sql(f"SELECT doc_id, py_compose({apart}) AS composed FROM posts_for_udf WHERE length({apart}) > length(post)")
