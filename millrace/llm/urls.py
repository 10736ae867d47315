"""URL filters: host and path rules, and a logistic regression on hashed character n-grams for all other URLs.

Defined cases: a null URL, or one without ``://``, has empty host and path; no rule fits it and the model judges two
empty strings. Repeated URLs are judged alike, extra columns are ignored, an empty table gives an empty result.
Ties of equally long rules go to ``block``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa  # noqa: F401  (worker functions)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, documents, scan

by_value(__name__)

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

# The labelled URL table: host and path, 1 to block. Names of either kind with the usual prefixes and paths.
LABELLED = [
    ("www.adult-x.example.com", "/en/12", 1), ("m.spam-farm.example.org", "/de/7/", 1),
    ("blog.cheap-pills.example.com", "/fr/815.html", 1), ("ads-track.example.org", "/en/42", 1),
    ("www.casino-win.example.com", "/es/90", 1), ("free-bets.example.org", "/en/77/", 1),
    ("casino-win.example.org", "/de/4", 1), ("cheap-pills.example.org", "/en/33", 1),
    ("adult-x.example.org", "/es/18/", 1), ("spam-farm.example.com", "/fr/61", 1),
    ("m.free-bets.example.com", "/en/3.html", 1), ("blog.ads-track.example.com", "/en/5", 1),
    ("xxx-videos.example.com", "/watch/1", 1), ("online-poker-bets.example.org", "/bonus", 1),
    ("viagra-pills.example.com", "/buy/now", 1), ("win-lottery.example.com", "/free/prize", 1),
    ("www.example.com", "/en/12", 0), ("m.example.org", "/de/7/", 0), ("blog.example.com", "/fr/815.html", 0),
    ("news.example.org", "/en/42", 0), ("www.ththat.example.com", "/es/90", 0), ("therent.example.org", "/en/77/", 0),
    ("m.tionble.example.org", "/de/4", 0), ("blog.thther.example.com", "/en/33", 0), ("thering.example.org", "/es/18/", 0),
    ("library.example.com", "/fr/61", 0), ("m.university.example.com", "/en/3.html", 0), ("docs.example.org", "/en/5", 0),
    ("ththre.example.com", "/watch/1", 0), ("ththin.example.org", "/about", 0), ("weather.example.com", "/city/now", 0),
    ("thered.example.com", "/free/software", 0), ("tionsh.example.com", "/en/5000", 0), ("theron.example.org", "/de/2980", 0),
    ("history.example.org", "/fr/9689/", 0), ("recipes.example.com", "/es/9255", 0), ("www.ththes.example.org", "/en/1", 0),
    ("m.ththnd.example.com", "/fr/2", 0), ("garden.example.com", "/de/8", 0), ("", "", 0),
]

WIDTH = 1 << 14
SIZES = (3, 4, 5)


def grams(host: str, path: str) -> np.ndarray:
    """Hashed character n-grams of host and path, kept apart, each counted once."""
    found = set()
    for mark, part in (("h", f"^{host}$"), ("p", f"^{path}$")):
        raw = part.encode("utf-8", "surrogatepass")
        head = mark.encode()
        for n in SIZES:
            found.update(head + raw[i : i + n] for i in range(len(raw) - n + 1))
    return np.array(sorted({zlib.crc32(g) % WIDTH for g in found}), dtype=np.int64)


def fit(labelled: list[tuple[str, str, int]], rounds: int = 300, rate: float = 0.5, penalty: float = 1e-3) -> tuple:
    """Weights and bias: full-batch gradient steps on a table of labelled URLs, which is small by definition.

    Rows are scaled to unit length; a deterministic start makes the model reproducible.
    """
    rows = [grams(h, p) for h, p, _ in labelled]
    y = np.array([label for _, _, label in labelled], dtype=float)
    x = np.zeros((len(rows), WIDTH))
    for i, at in enumerate(rows):
        x[i, at] = 1 / np.sqrt(max(len(at), 1))
    w, b = np.zeros(WIDTH), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        w -= rate * (10 * x.T @ (p - y) / len(y) + penalty * w)
        b -= rate * (p - y).mean()
    return w, b


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule whose host is the URL's or a parent of it and whose path starts the URL's."""
    out = F.lit(None).cast("string")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[1] == "block")):
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str]] = RULES, labelled: list[tuple[str, str, int]] = LABELLED,
    id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5,
) -> DataFrame:
    """page id, host, path, rule, verdict and the model's score for every row. One pass, no shuffle."""
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    ruled = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    w, b = fit(labelled)
    listed = dict(rules)

    def start():
        def work(read: dict) -> dict:
            known: dict[tuple[str, str], float] = {}
            scores = []
            for host, path in zip(read["host"], read["path"]):
                score = known.get((host, path))
                if score is None:
                    at = grams(host, path)
                    score = float(1 / (1 + np.exp(-(w[at].sum() / np.sqrt(max(len(at), 1)) + b))))
                    known[host, path] = score
                scores.append(score)
            verdicts = [listed[r] if r is not None else "block" if s >= threshold else "allow" for r, s in zip(read["rule"], scores)]
            return {"verdict": verdicts, "score": scores}

        return work

    return scan(ruled, ["page_id", "host", "path", "rule"], {"verdict": "string", "score": "double"}, start)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(documents(spark, sf_dir, "pages"))
