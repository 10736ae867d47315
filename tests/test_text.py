"""Column functions against plain Python with the same specified behaviour."""

import json
import re
import string

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.accents import remove_accented_chars
from millrace.functions.contractions import CONTRACTIONS, expand_contractions
from millrace.functions.html import decode_entities, remove_html
from millrace.functions.sql_names import register_sql_functions, sql_bodies
from millrace.functions.udf import clean_text_python
from millrace.operators.dump import json_is_valid

ALPHABET = "abzAZ019 .,;:!?#@&<>/-_+'\"\\[]^`~\t\r\n\x0b\x1c\x85\u00a0\u2003éÉßñçøÆœ’“…€½—ž中🙂"
WORDS = [
    "http://a.b", "https://t.co/x?y=1.", "www://x.y", "www.x.y", "ftp://ü.de/ä", "a@b.cd", "A@B.CD", "x.@y.z.",
    "#tag", "@me", "don't", "Don't", "it's", "gonna", "12:30", "1/2", "  ", "\t\t", "?", "é",
]
texts = st.lists(st.one_of(st.text(ALPHABET, max_size=12), st.sampled_from(WORDS)), max_size=8).map("".join)
batches = st.lists(texts, min_size=20, max_size=40)

# The patterns whose results must be met.
URL = re.compile(
    r"(http|https|ftp|ssh|sftp|www)://([\w_-]+(?:(?:\.[\w_-]+)+))([\w.,@?^=%&:/~+#-]*[\w@?^=%&/~+#-])?"
)
EMAIL = re.compile(r"([a-z0-9+._-]+@[a-z0-9+._-]+\.[a-z0-9+_-]+)")
DIGITS = re.compile(r"\d[./:-]\d|\d")
SPECIAL, SPECIAL_AND_DIGITS = re.compile(r"[^a-zA-z0-9\s]"), re.compile(r"[^a-zA-z\s]")

EXPECTED = {
    "url": (T.remove_url, lambda t: URL.sub("", t)),
    "email": (T.remove_email_address, lambda t: EMAIL.sub("", t)),
    "emails": (T.get_email_address, lambda t: EMAIL.findall(t)),
    "tabs": (T.remove_tabs, lambda t: re.sub("[\t\r\n]", " ", t)),
    "blanks": (T.remove_blanks, lambda t: re.sub(" +", " ", t)),
    "digits": (T.remove_digits, lambda t: DIGITS.sub("", t)),
    "punct": (T.remove_all_punctuation, lambda t: "".join(c for c in t if c not in string.punctuation)),
    "special": (T.remove_special_characters, lambda t: SPECIAL.sub("", t)),
    "special_digits": (lambda c: T.remove_special_characters(c, True), lambda t: SPECIAL_AND_DIGITS.sub("", t)),
    "ascii": (T.ascii_to_string, lambda t: "".join(c for c in t if c.isascii() and c != "?")),
    "lower": (T.to_lower, str.lower),
    "hashtags": (T.get_hashtag, lambda t: [w for w in t.split() if w.startswith("#")]),
    "mentions": (T.get_mention, lambda t: [w for w in t.split() if w.startswith("@")]),
    "clean": (T.clean_text, clean_text_python),
}


def step_by_step(column):
    for step in T.CLEAN_STEPS:
        column = step(column)
    return column


EXPECTED["steps"] = (step_by_step, clean_text_python)


def run(spark, rows, columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i INT, t STRING")
    return df.select("i", "t", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()


@settings(max_examples=6, deadline=None, phases=[Phase.generate])
@given(batches)
def test_like_python(spark, rows):
    columns = {name: function(F.col("t")) for name, (function, _) in EXPECTED.items()}
    for row in run(spark, rows, columns):
        for name, (_, python) in EXPECTED.items():
            assert row[name] == python(row["t"]), (name, row["t"])


def test_null_stays_null_or_becomes_text(spark):
    columns = {name: function(F.col("t")) for name, (function, _) in EXPECTED.items()}
    columns["sentinel"] = T.clean_text(F.col("t"), null_sentinel=True)
    row = run(spark, [None], columns)[0]
    assert row["sentinel"] == "null"
    assert all(row[name] is None for name in EXPECTED)


def test_html(spark):
    cases = {
        "<p>a</p><p> b </p>": "a b",
        "x<br>y": "x y",
        "<a title=\"1 > 0\" href='>'>link</a>": "link",
        "<script>var t='</p>';</script>a<style>p{}</style> b<!-- <p>c</p> -->": "a b",
        "a &lt;b&gt; &amp;lt; c": "a <b> &lt; c",
        "&copy; &eacute;&#233;&#xE9; &nosuch; &amp": "© ééé &nosuch; &amp",
        "<p>&nbsp;</p><p>x&nbsp;</p>": "x",
        "&#0; &#1114112; &#55296;": "&#0; &#1114112; &#55296;",
        "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
        "  plain  ": "plain",
        "<b></b>": "",
        "<br>" * 20000 + "end": "end",
        " " * 50000 + "x": "x",
    }
    rows = run(spark, list(cases), {"clean": remove_html(F.col("t"))})
    assert [r["clean"] for r in rows] == list(cases.values())


def test_entities_are_decoded_once(spark):
    row = run(spark, ["&amp;amp;lt;"], {"x": decode_entities(F.col("t"))})[0]
    assert row["x"] == "&amp;lt;"


def test_accents(spark):
    cases = {
        "Café Ünïté": "Cafe Unite", "straße Æon œuvre": "strasse AEon oeuvre", "Łódź Đà ø": "Lodz Da o",
        "don’t “x” – … €5 ½": "don't \"x\" - ... EUR5 1/2", "plain": "plain", "中文": "中文",
    }
    rows = run(spark, list(cases), {"x": remove_accented_chars(F.col("t"))})
    assert [r["x"] for r in rows] == list(cases.values())


def test_contractions(spark):
    cases = {
        "don't stop, it's we're.": "do not stop, it is we are.",
        "Don't IT's John's": "Do not It is John's",
        "I'm gonna go": "I am going to go",
        "gonnas undon't": "gonnas undon't",
    }
    rows = run(spark, list(cases), {"x": expand_contractions(F.col("t"))})
    assert [r["x"] for r in rows] == list(cases.values())
    assert len(CONTRACTIONS) < 200


def test_long_runs_stay_linear(spark):
    rows = ["a" * 400_000, "a." * 100_000 + "@", "http://" + "a." * 50_000 + "b", "'" * 100_000]
    out = run(spark, rows, {"x": F.length(T.clean_text(F.col("t")))})
    assert out[0]["x"] == 400_000
    assert out[2]["x"] == 0


def test_sql_functions_equal_columns(spark):
    register_sql_functions(spark)
    rows = ["<b>Caf&eacute; &#233; &amp;</b> Don't a@b.cd https://t.co/x #t @u 1/2 [x]_ ?\t é", "x", "", "Žluť’s ½"]
    columns = {
        "remove_html": remove_html, "remove_accented_chars": remove_accented_chars, "remove_tabs": T.remove_tabs,
        "remove_blanks": T.remove_blanks, "remove_digits": T.remove_digits,
        "remove_all_punctuation": T.remove_all_punctuation,
        "remove_special_characters": T.remove_special_characters, "ascii_to_string": T.ascii_to_string,
        "to_lower": T.to_lower, "remove_url": T.remove_url, "remove_email_address": T.remove_email_address,
        "expand_contractions": expand_contractions, "get_email_address": T.get_email_address,
        "get_hashtag": T.get_hashtag, "get_mention": T.get_mention, "apply_all": T.clean_text,
    }
    assert {f"{n}_udf" for n in columns} == set(sql_bodies())
    df = spark.createDataFrame([(t,) for t in rows], "t STRING")
    df.createOrReplaceTempView("sql_names_input")
    for name, function in columns.items():
        by_column = [r["x"] for r in df.select(function(F.col("t")).alias("x")).collect()]
        by_sql = [r["x"] for r in spark.sql(f"SELECT {name}_udf(t) AS x FROM sql_names_input").collect()]
        assert by_sql == by_column, name


def test_no_python_worker_in_the_cleaning_plan(spark):
    df = spark.createDataFrame([("x",)], "t STRING").select(T.clean_text(F.col("t")).alias("c"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


JSONISH = st.one_of(
    st.recursive(
        st.none() | st.booleans() | st.integers(-10**6, 10**6) | st.text(max_size=5),
        lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=3), inner, max_size=3),
        max_leaves=6,
    ).map(json.dumps),
    st.text('{}[]":,1a \t', max_size=10),
)


@settings(max_examples=6, deadline=None, phases=[Phase.generate])
@given(st.lists(st.tuples(JSONISH, st.text('{}[]":,1 ', max_size=3)).map("".join), min_size=30, max_size=60))
def test_json_validity_like_python(spark, rows):
    def valid(t):
        try:
            json.loads(t)
            return True
        except ValueError:
            return False

    rows = rows + ['{"a":1,"a":2}', '{"a":NaN}', "{'a':1}", "", "1] , [2", '1, "v":2', "{\"", "null", "[1,]"]
    for row in run(spark, rows, {"ok": json_is_valid(F.col("t"))}):
        assert row["ok"] == valid(row["t"]), row["t"]


def test_cleaning_by_words_gives_the_rows_of_the_expressions(spark):
    from millrace.functions.text import clean_text
    from millrace.functions.words import clean_by_words, clean_text_words

    texts = [
        None, "", " ", "  a  b ", "http://a.b/c d", "x https://a.b?c=d&e a@b.c", " \t\nlead <b>Bold</b>\ttail\r\n", "&nbsp;x&nbsp; y",
        "it's don't GONNA gonna, wanna. they'd've", "é ß Ł ﬁ １２ 中文 🙂 \xa0z\xa0", "&lt;b&gt; &amp;lt; &eacute; &#233; &#x0; &#xD800; &#99999999; &bogus;",
        "a.b@c.d@e.f x@y", "A@B.C a@b.c", "<script>x < y</script> shown <a href='>'>link</a>", "a?b??", "tab\tin\tword's", "##tag @me!",
        "ftp://x.y/<b>z</b>", "\x85\x1cedge\x1d", "x" * 5000 + "'s", "she's’ o'clock 'tis", "&nbsp;", "a &nbsp; b",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING").repartition(3)
    got = df.select("i", "t", clean_text_words(F.col("t")).alias("w"), clean_text(F.col("t")).alias("e")).orderBy("i").collect()
    for r in got:
        assert r["w"] == r["e"], r
        assert r["w"] == clean_by_words(r["t"], _Cleaned()), r


class _Cleaned(dict):
    def __missing__(self, word):
        from millrace.functions.words import clean_word

        return clean_word(word)


def test_arrow_functions_work_on_slices_of_bounded_bytes(monkeypatch):
    import pyarrow as pa

    from millrace.functions import batches, udf, words

    texts = pa.array([None, "Don't <b>stop</b> é", "", "word " * 200_000] * 12)
    seen = []

    def watched(function):
        return lambda part, *more: seen.append(part.nbytes) or function(part, *more)

    want = words.clean_batch(texts, words._Remembered())
    monkeypatch.setattr(words, "clean_batch", watched(words.clean_batch))
    assert words._clean_batch(texts) == want
    assert len(seen) >= 3 and max(seen) < 2 * batches.SLICE_BYTES < texts.nbytes
    assert len(words._clean_batch(texts.slice(0, 0))) == 0
    apart = pa.array(["é" * 500_000, None, "é"] * 8)
    assert udf._compose_batch(apart).to_pylist() == ["é" * 500_000, None, "é"] * 8


def test_remembered_words_are_bounded():
    from millrace.functions import words

    known = words._Remembered()
    long = "X" * 1000
    assert known[long] == long.lower() and not known
    for i in range(words.REMEMBERED + 5):
        known[f"W{i}"]
    assert len(known) <= words.REMEMBERED <= 100_000
