"""Articles as one line of space-joined tokens: from a wiki XML dump or from HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import let
from ..functions.html import decode_entities, remove_html

WIKI_PAGE = "title STRING, ns INT, revision STRUCT<text: STRING>"

# Tokens are runs of letters and underscores; those of 2 to 15 characters that do not
# start with an underscore count, and an article needs 50 of them.
TOKEN_PATTERN = r"[\p{L}\p{Nl}\p{No}_]+"
TOKEN_MIN, TOKEN_MAX = 2, 15
ARTICLE_MIN_TOKENS = 50
# The namespace of articles, and the prefixes of titles that belong to others where a page names none.
ARTICLES = 0
OTHER_TITLES = (
    "Talk", "User", "User talk", "Wikipedia", "File", "Image", "MediaWiki", "Template", "Help", "Category", "Portal",
    "Book", "Draft", "Module", "Special", "Media",
)
# Links to files and categories, whose texts may hold links of their own.
FILE_LINK = (
    r"(?i)\[\[(?:file|image|category|media):(?:[^\[\]]++|\[\[[^\[\]]*+\]\]|\[[^\[\]]*+\])*+\]\]"
)


def read_wiki_xml(spark: SparkSession, path, row_tag: str = "page") -> DataFrame:
    """Columns ``title`` and ``text``, one row per article: pages of other namespaces and redirects are left out.

    The end tag serves as the line separator of the text source, so one large dump (plain or bzip2)
    is split between pages and read by many tasks; a damaged page gives NULLs and harms no other.
    """
    chunks = spark.read.text(path, lineSep=f"</{row_tag}>")
    start = F.locate(f"<{row_tag}>", F.col("value"))
    page = F.concat(F.substring(F.col("value"), start, F.length("value")), F.lit(f"</{row_tag}>"))
    record = F.from_xml(page, WIKI_PAGE, {"rowTag": row_tag})
    pages = chunks.filter(start > 0).select(record.alias("page"))
    text = F.col("page.revision.text")
    prefix = F.substring_index(F.col("page.title"), ":", 1)
    other = F.col("page.title").contains(":") & prefix.isin(*OTHER_TITLES)
    article = F.when(F.col("page.ns").isNull(), ~F.coalesce(other, F.lit(False))).otherwise(F.col("page.ns") == ARTICLES)
    redirect = F.coalesce(text.rlike(r"(?i)^\s*#redirect\b"), F.lit(False))
    return pages.filter(article & ~redirect).select("page.title", text.alias("text"))


# Code points that Unicode reserves as no characters stand for the two marks of a pair.
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"


def _outside(text: Column, opening: str, closing: str) -> Column:
    """The text outside all pairs of two marks, nested to any depth: innermost pairs go until none is left.

    A round takes time in proportion to the text, and there are as many as pairs are nested; rounds behind the last one
    cost nothing. A closing mark without an opening one changes nothing, an opening one without a closing one drops the
    rest.
    """
    marked = F.translate(text, _OPEN + _CLOSE, "")
    marked = F.replace(F.replace(marked, F.lit(opening), F.lit(_OPEN)), F.lit(closing), F.lit(_CLOSE))

    def without(start: Column) -> Column:
        def step(state: Column, _: Column) -> Column:
            def settled(bare: Column) -> Column:
                return F.struct(bare.alias("text"), (F.length(bare) == F.length(state["text"])).alias("done"))

            inner = F.regexp_replace(state["text"], f"{_OPEN}[^{_OPEN}{_CLOSE}]*+{_CLOSE}", " ")
            return F.when(state["done"], state).otherwise(let(inner, settled))

        # Every pair is longer than the blank it leaves, and there are at most as many rounds as opening marks.
        rounds = F.sequence(F.lit(0), F.length(start) - F.length(F.replace(start, F.lit(_OPEN), F.lit(""))))
        first = F.struct(start.alias("text"), F.lit(False).alias("done"))
        bare = F.aggregate(rounds, first, step, lambda state: state["text"])
        return F.replace(F.substring_index(bare, _OPEN, 1), F.lit(_CLOSE), F.lit(""))

    return F.when(text.contains(opening), let(marked, without)).otherwise(text)


def _plain_wiki(text: Column) -> Column:
    """Drop the wiki markup: entities first, then comments, templates, tables, references, tags, files, links, emphasis."""
    bare = F.regexp_replace(decode_entities(text), r"(?s)<!--.*?-->", " ")
    bare = let(bare, lambda t: _outside(t, "{{", "}}"))
    bare = let(bare, lambda t: _outside(t, "{|", "|}"))
    bare = F.regexp_replace(bare, r"(?s)<ref[^>/]*>.*?</ref>", " ")
    bare = F.regexp_replace(bare, r"<[^>]*>", " ")
    bare = F.regexp_replace(bare, FILE_LINK, " ")
    bare = F.regexp_replace(bare, r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", "$1")
    bare = F.regexp_replace(bare, r"\[(?:https?|ftp)://[^\s\]]++\s*+([^\]]*+)\]", "$1")
    bare = F.regexp_replace(bare, r"(?:https?|ftp)://[^\s\]]++", " ")
    return F.regexp_replace(bare, r"'{2,}", "")


def article_tokens(text: Column, shortest: int = TOKEN_MIN, longest: int = TOKEN_MAX) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.filter(words, lambda w: F.length(w).between(shortest, longest) & ~w.startswith("_"))


def _as_lines(articles: DataFrame, tokens: Column, out: str, min_tokens: int) -> DataFrame:
    # A generator of one row: the filter stays above it and the tokens are made once.
    made = articles.select("*", F.explode(F.array(tokens)).alias("_tokens"))
    return made.filter(F.size("_tokens") >= min_tokens).withColumn(out, F.array_join("_tokens", " ")).drop("_tokens")


def article_lines(
    articles: DataFrame, text: str = "text", out: str = "line", min_tokens: int = ARTICLE_MIN_TOKENS,
    shortest: int = TOKEN_MIN, longest: int = TOKEN_MAX,
) -> DataFrame:
    """Add the article's tokens joined with one space; articles of fewer than ``min_tokens`` are left out."""
    return _as_lines(articles, article_tokens(_plain_wiki(F.col(text)), shortest, longest), out, min_tokens)


def html_articles(
    pages: DataFrame, html: str = "html", out: str = "line", min_tokens: int = ARTICLE_MIN_TOKENS,
    shortest: int = TOKEN_MIN, longest: int = TOKEN_MAX,
) -> DataFrame:
    return _as_lines(pages, article_tokens(remove_html(F.col(html)), shortest, longest), out, min_tokens)
