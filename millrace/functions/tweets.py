"""Nested social-media records to flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import null_as_text
from .text import get_email_address, get_hashtag, get_mention
from .words import clean_text_words


def retweet_flag(text: Column) -> Column:
    """Y when the text starts with RT; a missing text gives N."""
    return F.when(F.substring(text, 1, 2) == "RT", "Y").otherwise("N")


def effective_text() -> Column:
    """The full text of a record, from one of four places; NULL when ``truncated`` is missing."""
    retweet = retweet_flag(F.col("text")) == "Y"
    inner_truncated = F.col("retweeted_status.truncated")
    truncated = F.col("truncated")
    return (
        F.when(retweet & inner_truncated, F.col("retweeted_status.extended_tweet.full_text"))
        .when(retweet & ~inner_truncated, F.col("retweeted_status.text"))
        .when(~retweet & truncated, F.col("extended_tweet.full_text"))
        .when(~retweet & ~truncated, F.col("text"))
    )


def flatten_tweets(tweets: DataFrame, lang: str = "en") -> DataFrame:
    """Distinct flat rows of one language. The language filter reaches the scan."""
    return (
        tweets.filter(F.col("lang") == lang)
        .select(
            "id", "lang", "created_at", "source",
            F.col("user.id_str").alias("user_id_str"),
            F.col("user.name").alias("user_name"),
            F.col("user.location").alias("user_location"),
            F.col("user.description").alias("user_description"),
            effective_text().alias("tweet_text"),
        )
        .distinct()
    )


def flatten_wide(tweets: DataFrame) -> DataFrame:
    """Author, retweeted, quoted and place fields as twelve columns."""
    return tweets.select(
        F.col("user.screen_name").alias("user_screen_name"),
        F.col("user.location").alias("user_location"),
        F.col("extended_tweet.full_text").alias("extended_tweet_full_text"),
        F.col("retweeted_status.user.screen_name").alias("retweeted_status_user_screen_name"),
        F.col("retweeted_status.text").alias("retweeted_status_text"),
        F.col("retweeted_status.extended_tweet.full_text").alias("retweeted_status_extended_tweet_full_text"),
        F.col("quoted_status.user.screen_name").alias("quoted_status_user_screen_name"),
        F.col("quoted_status.text").alias("quoted_status_text"),
        F.col("quoted_status.extended_tweet.full_text").alias("quoted_status_extended_tweet_full_text"),
        F.col("place.country").alias("place_country"),
        F.col("place.country_code").alias("place_country_code"),
        "timestamp_ms",
    )


def add_text_columns(flat: DataFrame, text: str = "tweet_text", null_sentinel: bool = False) -> DataFrame:
    """Hashtags, mentions, addresses and the cleaned text; rows without text are removed.

    The cleaned text is missing exactly where the text is, so the filter tests the text: a filter on
    the result would be pushed down and clean every text twice.
    """
    source = F.col(text)
    kept = flat if null_sentinel else flat.filter(source.isNotNull())
    return kept.select(
        "*",
        get_hashtag(source).alias("hashtag"),
        get_mention(source).alias("mention"),
        get_email_address(source).alias("emails"),
        clean_text_words(null_as_text(source) if null_sentinel else source).alias("clean_tweet_text"),
    )
