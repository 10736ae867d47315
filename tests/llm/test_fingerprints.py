"""Multiset fingerprints: sums, equality, likeness and the order of the documents."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import fingerprints as fp

from .conftest import clashing, prose

TEXTS = "doc_id BIGINT, text STRING"


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), TEXTS)
    return {r[0]: r[1] for r in fp.fingerprints(df).collect()}


def test_order_of_paragraphs_is_immaterial_and_their_number_is_not(spark):
    own = prints(spark, ["a b\nc\nd", "d\na b\nc", "a b\nc\nd\nd", "a b\nc", None, "", "\n", "a b\nc\nd"])
    assert own[0] == own[1] == own[7] and own[4] == own[5]
    assert len({tuple(v) for v in own.values()}) == 5


def test_paragraphs_are_put_in_and_taken_out(spark):
    pairs = [(0, prose(1)), (1, "one\ntwo two two two two\n\n"), (2, ""), (3, "x"), (4, " \n".join(prose(i) for i in range(50)))]
    rows = [(i, a, b, f"{a}\n{b}") for i, a in pairs for _, b in pairs]
    df = spark.createDataFrame(rows, "i INT, a STRING, b STRING, whole STRING")
    df = df.select(*[fp.fingerprint(F.col(c)).alias(c) for c in ("a", "b", "whole")])
    for r in df.select("*", fp.plus(F.col("a"), F.col("b")).alias("sum"), fp.minus(F.col("whole"), F.col("b")).alias("rest")).collect():
        assert r["sum"] == r["whole"] and r["rest"] == r["a"]


def test_lanes_wrap_without_touching_each_other(spark):
    many = "w\n" * ((1 << 19) + 5)
    one, all_of = prints(spark, ["w", many]).values()
    mask = fp.LANE_MASK
    for single, total in zip(one[fp.EXACT + 1:], all_of[fp.EXACT + 1:]):
        for i in range(3):
            shift = fp.STRIDE * i
            assert (total >> shift) & mask == ((single >> shift) & 1) * ((1 << 19) + 5) % (1 << 19)
    assert all_of[fp.EXACT] == (1 << 19) + 5


def test_likeness_follows_the_share_of_common_pieces(spark):
    lines = [" ".join(f"w{i}x{k}" for k in range(8)) for i in range(400)]
    rows = []
    for share in (0, 25, 50, 75, 100):
        other = lines[:share] + [" ".join(f"o{i}x{k}" for k in range(8)) for i in range(100 - share)]
        rows.append((share, "\n".join(lines[:100]), "\n".join(random.Random(share).sample(other, 100))))
    df = spark.createDataFrame(rows, "share INT, a STRING, b STRING")
    near = fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b")))
    for r in df.select("share", near.alias("near")).collect():
        assert abs(r["near"] - r["share"] / 100) < 0.3
    got = [r["near"] for r in df.select("share", near.alias("near")).orderBy("share").collect()]
    assert got == sorted(got) and got[0] < 0.3 and got[-1] == 1.0


def expected(rows):
    """Edited text and next text of every (id, text), in the order of the module."""
    texts = sorted(((i, t or "") for i, t in rows if i is not None), reverse=True)
    after = [t for _, t in texts[1:] + texts[:1]]
    loose = [(None, t or "") for i, t in rows if i is None]
    out = []
    for (i, t), following in [*zip(texts, after), *((x, texts[0][1] if texts else "") for x in loose)]:
        half = len(t) // 2
        changed = t[: len(t) - half] + following[:half]
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest()))
    return sorted(out, key=repr)


def outcome(df):
    rows = fp.compare_with_edits(df).collect()
    for r in rows:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=repr)


@pytest.mark.parametrize("ids", [
    range(500), range(0, 5_000_000, 10_000), [*range(300), *range(1 << 40, (1 << 40) + 300)], [-(1 << 62), -1, 0, 5, (1 << 62)],
    [7], [], [2, 2, 2, 1, 1],
])
def test_next_document_of_any_ids(spark, monkeypatch, ids):
    monkeypatch.setattr(fp, "LEAST_IDS", 4)
    monkeypatch.setattr(fp, "RANGE_ROWS", 16)
    monkeypatch.setattr(fp, "MOST_ROWS", 64)
    rows = [(i, f"{n} " + prose(n % 9, 1 + n % 13) + "é🙂" * (n % 3)) for n, i in enumerate(ids)]
    assert outcome(spark.createDataFrame(rows, TEXTS).repartition(5)) == expected(rows)


def test_odd_rows(spark, edges, empty):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    assert outcome(edges) == expected(rows)
    loose = [(None, "some words here"), (None, None), (None, "some words here")]
    assert outcome(clashing(spark.createDataFrame(loose, TEXTS))) == expected(loose)
    out = fp.compare_with_edits(empty)
    assert out.count() == 0 and out.columns[0] == "doc_id"


def test_a_very_long_text(spark):
    text = "\n".join(prose(i, 300) for i in range(1000))
    df = spark.createDataFrame([(1, text), (2, "short one")], TEXTS)
    rows = {r["doc_id"]: r for r in fp.compare_with_edits(df).collect()}
    assert rows[1]["n_chars"] == len(text) and 0.6 < rows[1]["near_edited"] and rows[1]["near_next"] < 0.3
