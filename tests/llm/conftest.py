import pytest

DOCUMENT = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# Names that operators might use for columns of their own.
CLASHING = ["size", "shard", "slot", "id", "body", "n", "piece", "length", "rank", "component", "copies", "key", "score", "old"]

PROSE = "the cat and the dog went to the park and it was a fine day for all of them in the city "


def prose(seed: int, words: int = 120) -> str:
    """Different running words with common ones between them."""
    common = "the of and to in is it that for was".split()
    out = []
    for i in range(words):
        n = (seed * 7919 + i * 104729) % 99991
        out.append(common[n % 10] if i % 3 == 0 else "w" + "".join(chr(97 + (n // 26**k) % 26) for k in range(4)))
    return " ".join(out)


def edge_rows():
    long_text = " ".join(prose(i) for i in range(60))
    rows = [
        (1, prose(1), "en", "src0", 1), (2, prose(2), "en", "src0", 1), (2, prose(2), "en", "src0", 1),
        (3, None, "en", "src1", None), (4, "", "de", None, 0), (5, "   \n\t ", None, "src1", 6),
        (6, long_text, "en", "src0", len(long_text)), (7, prose(1), "en", "src2", 1), (8, "two words", "fr", "src2", 9),
        (9, "two words", "fr", "src2", 9), (None, prose(9), "en", "src0", 1), (None, None, None, None, None),
        (10, 'password = "0123456789abcdef0123" and Ä é 中文 \U0001f642 \x1c end', "es", "src3", 1),
    ]
    return rows


def clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("other").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def edges(spark):
    return clashing(spark.createDataFrame(edge_rows(), DOCUMENT)).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return clashing(spark.createDataFrame([], DOCUMENT))
