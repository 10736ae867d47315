"""Periodic runs against a search of every period, planted repeats and odd rows."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import periods
from millrace.llm.common import documents

SF = "/root/testdata/sf0.001"


def every_run(ids):
    """Stretches of every period by direct comparison; of equal stretches the smallest period."""
    n, out = len(ids), {}
    for q in range(1, n // 3 + 1):
        t = 0
        while t + q < n:
            s = t
            while t + q < n and ids[t] == ids[t + q]:
                t += 1
            if t > s and t + q - s >= max(24, 3 * q):
                out.setdefault((s, t + q), q)
            t += t == s
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n and doc_id is not None:
        g = h // 10
        a, original = g % n, list(words)
        p = 1 + (n - a) // (3 + g % 8)
        words = [original[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = every_run(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        len(runs), *(best if best else (None,) * 3), 1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def pieces(rng):
    out = []
    for _ in range(rng.randint(0, 6)):
        letters, kind = rng.choice([2, 3, 10, 1000]), rng.random()
        if kind < 0.3:
            out += [rng.randrange(letters) for _ in range(rng.randint(0, 150))]
        elif kind < 0.8:
            p = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 7, 16, 17, 18, 24, 25, 36, 37, 50, 80]))]
            times = rng.choice([2, 3, 3, 4])
            out += (p * (times + 2))[: len(p) * times + rng.randint(-1, len(p))]
        else:  # runs within the period of a run
            inner = [rng.randrange(letters) for _ in range(5)] * rng.randint(3, 6)
            out += (inner + [rng.randrange(letters) for _ in range(rng.randint(0, 10))]) * rng.randint(3, 5)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_as_by_comparing_every_period(seed):
    rng = random.Random(seed)
    for _ in range(25):
        texts = [pieces(rng) for _ in range(rng.randint(1, 8))]
        found = periods.runs_of_texts([np.array(t, dtype=np.int64) for t in texts])
        assert found == [every_run(t) for t in texts]


def test_scales_leave_no_period_out():
    for longest in (0, 24, 51, 52, 1000, 100_000):
        below = periods.LAGS
        for scale in periods.scales(longest):
            assert scale.low == below + 1 and scale.width >= scale.low and scale.reach >= 1
            assert scale.reach + scale.width - 1 <= 2 * scale.low
            below = scale.width
        assert (below + 1) * 3 > longest or below == periods.LAGS


def test_query_as_by_brute_force(spark):
    rows = periods.query(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in documents(spark, SF).collect()}
    assert len(rows) == len(texts) and sum(r["n_runs"] > 0 for r in rows) > 10
    short = [r for r in rows if len(texts[r["doc_id"]]) < 12_000]
    assert len(short) > 0.9 * len(rows)
    for r in short:
        assert tuple(r[c] for c in COLUMNS) == expected(r["doc_id"], texts[r["doc_id"]])


def test_odd_rows(spark, edges, empty):
    got = periods.find_runs(edges, COLUMNS, plant=True).collect()
    want = sorted(map(repr, ((r["doc_id"], *expected(r["doc_id"], r["text"])) for r in edges.collect())))
    assert sorted(repr(tuple(r)) for r in got) == want
    out = periods.find_runs(empty, COLUMNS)
    assert out.count() == 0 and out.columns == ["doc_id", *COLUMNS]


def test_a_very_long_text_and_its_collapse(spark):
    head = " ".join(f"h{i}" for i in range(1000))
    loop = " ".join(f"p{i % 9973}" for i in range(9973 * 12))
    short = "go " * 200_000
    df = spark.createDataFrame([(1, f"{head} {loop} {short}end"), (2, "a b c")], "doc_id BIGINT, text STRING")
    rows = {r["doc_id"]: r for r in periods.collapse(df).collect()}
    assert rows[1]["runs"] == [[1000, 9973 * 12, 9973], [1000 + 9973 * 12, 200_000, 1]]
    assert rows[1]["collapsed"] == f"{head} " + " ".join(f"p{i}" for i in range(9973)) + " go end"
    assert rows[2]["runs"] == [] and rows[2]["collapsed"] == "a b c"


def test_equal_rows_and_columns_of_the_result(spark, edges):
    out = periods.find_runs(edges.filter(F.col("doc_id") == 2), COLUMNS)
    rows = out.collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    kinds = dict(out.dtypes)
    assert all(kinds[c] == "bigint" for c in COLUMNS[:5]) and kinds["runs_sha256"] == "string"
