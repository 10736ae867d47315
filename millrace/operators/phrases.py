"""Texts that mention phrases, for any number of phrases: a join on one rare word of each phrase, then the exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import fits_broadcast, stage

# Inner words of a phrase that are counted to find its rarest.
TRIED = 4
# Phrases without an inner word are tested one by one against every text; so many at most.
SHORT = 1_000


def _inner_words(phrase: Column) -> Column:
    """The longest words of a phrase that have a blank on both sides, so they are whole words of a text that has it."""
    parts = F.split(phrase, " ")
    inner = F.array_distinct(F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda w: w != ""))
    longest = F.reverse(F.array_sort(F.transform(inner, lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w")))))
    return F.transform(F.slice(longest, 1, TRIED), lambda s: s["w"])


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def mentions(
    texts: DataFrame, phrases: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrase_id: str = "item_id",
    phrase_col: str = "text",
) -> DataFrame:
    """``id_col`` and ``phrase_id`` of every text that contains a phrase, upper and lower case alike.

    Each text is cut into words once. Of these only the longest inner words of the phrases are kept, their texts are
    counted, and a text is a candidate for the phrases whose rarest word it has; only candidates are compared in full.
    Null and empty phrases are in no text. Ids identify the rows of both tables.
    """
    named = phrases.select(F.col(phrase_id).alias("_phrase"), F.lower(phrase_col).alias("_wanted")).filter("_wanted <> ''")
    wanted = stage(named.withColumn("_words", _inner_words(F.col("_wanted"))), "phrases")
    folded = texts.select(F.col(id_col).alias("_id"), F.lower(text_col).alias("_text"))

    words = wanted.select("_phrase", F.explode("_words").alias("_word"))
    known = stage(words.select("_word").distinct(), "phrase-words")
    held = folded.select("_id", F.explode(F.array_distinct(F.split("_text", " "))).alias("_word"))
    held = stage(held.join(_small(known), "_word"), "text-words")
    counted = known.join(held.groupBy("_word").agg(F.count(F.lit(1)).alias("_many")), "_word")  # words of no text go
    rarest = Window.partitionBy("_phrase").orderBy(F.coalesce("_many", F.lit(0)), "_word")
    keys = words.join(counted, "_word", "left").withColumn("_nth", F.row_number().over(rarest)).filter("_nth = 1")
    keys = stage(keys.select("_phrase", "_word"), "phrase-keys")

    candidates = held.join(_small(keys), "_word").select("_id", "_phrase")
    compared = candidates.join(_small(wanted.select("_phrase", "_wanted")), "_phrase").join(folded, "_id")
    found = compared.filter(F.col("_text").contains(F.col("_wanted"))).select("_id", "_phrase")

    short = wanted.filter(F.size("_words") == 0).select("_phrase", "_wanted").limit(SHORT + 1).collect()
    if len(short) > SHORT:
        raise ValueError(f"more than {SHORT} phrases without an inner word")
    if short:
        hits = F.filter(
            F.array(*[F.when(F.col("_text").contains(r["_wanted"]), F.lit(r["_phrase"])) for r in short]), lambda p: p.isNotNull()
        )
        found = found.union(folded.select("_id", F.explode(hits)))
    return found.select(F.col("_id").alias(id_col), F.col("_phrase").alias(phrase_id))
