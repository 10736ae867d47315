"""Document fingerprints by a homomorphic multiset hash, in DataFrame operations only.

A text is a multiset of paragraphs (its lines, empty ones included). Every paragraph is hashed to a wide vector and a
fingerprint is the sum of these vectors, each component modulo a power of two. So the order of the paragraphs is
immaterial, and a paragraph is put in or taken out by adding or subtracting its vector (``plus``, ``minus``).

A vector has two parts. Four sums modulo 2^60 of the SHA-256 of the paragraph decide equality. ``LANES`` sums of signs
grade likeness: every piece of a paragraph (up to four words) gives +1 or -1 to each lane by the bits of its MD5, so
the cosine of the lanes of two fingerprints estimates that of their multisets of pieces, with an error of
1 / sqrt(LANES). A lane holds the number of its plus signs modulo 2^19; three lanes share one number, with a bit between
them that takes the carry and is cleared. The sign sum 2c - n is read as the nearest to zero, so it is right as long
as it stays below 2^19, however many pieces there are.

The next document of each is found without one task that sees all: ids are cut into ranges of one width, one shuffle
by range carries the texts, and the first document of a range goes to the range before as a guest, too.

Defined cases: a null text counts as empty, which is one empty paragraph. Rows that share an id follow each other by
descending text. A row without an id has no place in the order; the document that follows it is the first. Where no
row has an id, nothing follows. A single document follows itself. Extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.numbering import number_table
from .common import Scratch, documents, small

LANES = 120
# Lanes by number of the MD5, and of a number by bit: bits k, k + STRIDE and k + 2 * STRIDE share a sum.
STRIDE = 20
PER_NUMBER = 60
SUMS = LANES // PER_NUMBER * STRIDE
EXACT = 4
EXACT_MASK = (1 << PER_NUMBER) - 1
PICK = sum(1 << (STRIDE * i) for i in range(3))
LANE_MASK = (1 << (STRIDE - 1)) - 1
CLEAR = LANE_MASK * PICK
WORDS = 4
BLANK, SOLID = r"[\x20\x09\x0B-\x0D]", r"[^\x20\x09-\x0D]"
PIECE = rf"{SOLID}+(?:{BLANK}+{SOLID}+){{0,{WORDS - 1}}}"

# Ids in a range at least, documents in a range on average, and at most where ids are clustered.
LEAST_IDS = 11  # as a power of two
RANGE_ROWS = 2048
MOST_ROWS = 8192
# Rows without an id are dealt over so many groups.
UNORDERED = 64


def digits(digest: Column, number: int) -> Column:
    """Fifteen hexadecimal digits of a digest as a number below 2^60."""
    return F.conv(F.substring(digest, 15 * number + 1, 15), 16, 10).cast("long")


def exact_sums(text: Column) -> Column:
    """Sums of the SHA-256 of all paragraphs, as an array."""
    digests = F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256))
    numbers = F.transform(digests, lambda d: F.struct(*[digits(d, i).alias(f"e{i}") for i in range(EXACT)]))
    zero = F.struct(*[F.lit(0).cast("long").alias(f"e{i}") for i in range(EXACT)])
    add = lambda acc, x: F.struct(*[
        (acc[f"e{i}"] + x[f"e{i}"]).bitwiseAND(F.lit(EXACT_MASK)).alias(f"e{i}") for i in range(EXACT)
    ])
    return F.aggregate(numbers, zero, add, lambda acc: F.array(*[acc[f"e{i}"] for i in range(EXACT)]))


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lane_sum(numbers: Column, shift: int) -> Column:
    """The sum of three lanes: of the bits ``shift``, ``shift + STRIDE`` and ``shift + 2 * STRIDE`` of all numbers."""
    add = lambda acc, x: (acc + F.shiftright(x, shift).bitwiseAND(F.lit(PICK))).bitwiseAND(F.lit(CLEAR))
    return F.aggregate(numbers, F.lit(0).cast("long"), add)


def lane_sums(text: Column) -> Column:
    """Number of pieces, then the packed sums of their plus signs, as an array."""
    digests = F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda p: F.md5(p))

    def number_sums(hashed: Column, number: int) -> Column:
        numbers = F.transform(hashed, lambda d: digits(d, number))
        return bound(numbers, lambda every: F.array(*[lane_sum(every, i) for i in range(STRIDE)]))

    return bound(digests, lambda hashed: F.concat(
        F.array(F.size(hashed).cast("long")), *[number_sums(hashed, i) for i in range(LANES // PER_NUMBER)]
    ))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as an array: sums for equality, the number of pieces, packed lane sums."""
    body = F.coalesce(text, F.lit(""))
    return F.concat(exact_sums(body), lane_sums(body))


def _combine(a: Column, b: Column, op) -> Column:
    def one(i: int) -> Column:
        x, y = F.get(a, F.lit(i)), F.get(b, F.lit(i))
        if i < EXACT:
            return op(x, y, EXACT_MASK, EXACT_MASK + 1)
        if i == EXACT:
            return op(x, y, None, None)
        return op(x, y, CLEAR, PICK << (STRIDE - 1))

    return F.array(*[one(i) for i in range(EXACT + 1 + SUMS)])


def plus(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both."""
    return _combine(a, b, lambda x, y, mask, _: x + y if mask is None else (x + y).bitwiseAND(F.lit(mask)))


def minus(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of the first without those of the second."""
    return _combine(
        a, b, lambda x, y, mask, borrow: x - y if mask is None else (x + F.lit(borrow) - y).bitwiseAND(F.lit(mask))
    )


def as_text(fp: Column) -> Column:
    """Fifteen hexadecimal digits for each number."""
    return F.array_join(F.transform(fp, lambda v: F.lpad(F.lower(F.hex(v)), 15, "0")), "")


def sign_sums(fp: Column) -> Column:
    """The sums of signs of all lanes of a fingerprint."""
    n = F.get(fp, F.lit(EXACT))
    packed = F.slice(fp, EXACT + 2, SUMS)
    counts = F.flatten(F.transform(packed, lambda v: F.array(*[
        F.shiftright(v, STRIDE * i).bitwiseAND(F.lit(LANE_MASK)) for i in range(3)
    ])))
    half = LANE_MASK + 1  # a sign sum is known modulo twice this
    return F.transform(counts, lambda c: F.pmod(2 * c - n + half, F.lit(2 * half)) - half)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the cosine of their sign sums, at least 0; 0 where one has no pieces."""
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("ab", "aa", "bb")])
    pairs = F.zip_with(sign_sums(a), sign_sums(b), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    add = lambda acc, p: F.struct(
        (acc["ab"] + p["x"] * p["y"]).alias("ab"), (acc["aa"] + p["x"] * p["x"]).alias("aa"),
        (acc["bb"] + p["y"] * p["y"]).alias("bb"),
    )

    def cosine(acc: Column) -> Column:
        length = F.sqrt(acc["aa"].cast("double") * acc["bb"].cast("double"))
        return F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), acc["ab"].cast("double") / length))).otherwise(0.0)

    return F.when(a == b, F.lit(1.0)).otherwise(F.aggregate(pairs, zero, add, cosine))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and fingerprint (an array, see ``fingerprint``) of every document."""
    return docs.select(F.col(id_col), fingerprint(F.col(text_col)).alias("fingerprint"))


def range_shift(ids: DataFrame, rows: int, low: int, high: int) -> int:
    """How many low bits of an id are left out of its range: few enough that no range is large."""
    dense = max(1, (high - low + 1) // max(1, rows)) * RANGE_ROWS
    shift = max(LEAST_IDS, dense.bit_length() - 1)
    if shift > LEAST_IDS:
        fullest = ids.groupBy(F.shiftright("id", shift)).count().agg(F.max("count")).first()[0]
        shift = shift if fullest <= MOST_ROWS else LEAST_IDS
    return shift


def guests(ids: DataFrame, shift: int) -> DataFrame:
    """The first id of every range and the range before it in the order; of the topmost range, the last one."""
    heads = ids.groupBy(F.shiftright("id", shift).alias("bucket")).agg(F.max("id").alias("head"))
    placed = number_table(heads, ["bucket"], "place")
    last = placed.agg(F.max("place")).first()[0]
    target = placed.select(F.col("bucket").alias("target"), (F.col("place") - 1).alias("before"))
    before = F.when(F.col("place") == last, F.lit(0)).otherwise(F.col("place"))
    return placed.select("head", before.alias("before")).join(target, "before").select("head", "target")


def with_next(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``id``, ``body`` and ``fp`` of every row, and those of the row that follows by descending id, as ``next_body`` and
    ``next_fp``; null where nothing follows."""
    stats = docs.agg(F.count(F.lit(1)).alias("all"), F.count("id").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).first()
    marked = docs.withColumn("fp", fingerprint(F.col("body")))
    unordered = marked.filter(F.col("id").isNull())
    if stats["n"] == 0:
        return unordered.withColumns({"next_body": F.lit(None).cast("string"), "next_fp": F.lit(None).cast("array<bigint>")})
    ids = docs.filter(F.col("id").isNotNull()).select("id")
    shift = range_shift(ids, stats["n"], stats["low"], stats["high"])
    sent = small(scratch.stage(guests(ids, shift)), 24)
    placed = marked.filter(F.col("id").isNotNull()).join(sent, F.col("id") == F.col("head"), "left")
    place = lambda bucket, guest: F.struct(bucket.alias("bucket"), F.lit(guest).alias("guest"))
    own = F.array(place(F.shiftright("id", shift), 0))
    also = F.array(place(F.col("target"), 1))
    dealt = placed.select("id", "body", "fp", F.inline(F.when(F.col("target").isNull(), own).otherwise(F.concat(own, also))))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("id"), F.desc("body"))
    following = dealt.withColumns({"next_body": F.lead("body").over(order), "next_fp": F.lead("fp").over(order)})
    out = following.filter(F.col("guest") == 0).drop("bucket", "guest")
    if stats["all"] == stats["n"]:
        return out
    first = marked.filter(F.col("id") == stats["high"]).orderBy(F.desc("body")).limit(1)
    copies = first.select(
        F.col("body").alias("next_body"), F.col("fp").alias("next_fp"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(UNORDERED - 1).cast("long"))).alias("copy"),
    )
    spread = unordered.withColumn("copy", F.pmod(F.xxhash64("body"), F.lit(UNORDERED)))
    return out.unionByName(spread.join(copies, "copy").drop("copy"))


def edited(body: Column, next_body: Column) -> Column:
    """The text whose last half of code points gives way to as many from the start of the next text."""
    n = F.char_length(body)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(body, F.lit(1), n - half), F.substr(F.coalesce(next_body, F.lit("")), F.lit(1), half))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and the likeness to that and to the next document's."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    followed = with_next(rows, Scratch(docs.sparkSession, "prints"))
    changed = followed.select("id", F.char_length("body").cast("long").alias("n_chars"), "fp", "next_fp",
                              edited(F.col("body"), F.col("next_body")).alias("changed"))
    marked = changed.select("id", "n_chars", "fp", "next_fp", F.sha2("changed", 256).alias("edited_sha256"),
                            fingerprint(F.col("changed")).alias("changed_fp"))
    nothing = F.array(*[F.lit(0).cast("long")] * (EXACT + 1 + SUMS))
    return marked.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("changed_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("changed_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.coalesce("next_fp", nothing)).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(documents(spark, sf_dir))


def _sql_sums(source: str, out: str) -> str:
    """SQL for the fingerprints of a table (key, t): the same numbers, lane by lane."""
    number = lambda digest, i: f"CAST('0x' || substr({digest}, {15 * i + 1}, 15) AS BIGINT)"
    exact = ", ".join(f"CAST(sum(CAST({number('d', i)} AS HUGEINT)) % {EXACT_MASK + 1} AS BIGINT) AS e{i}" for i in range(EXACT))
    lanes = ", ".join(
        f"CAST(coalesce(sum((x{i // PER_NUMBER} >> {i % PER_NUMBER}) & 1), 0) % {LANE_MASK + 1} AS BIGINT) AS c{i}"
        for i in range(LANES)
    )
    parts = ", ".join(f"{number('h', i)} AS x{i}" for i in range(LANES // PER_NUMBER))
    packed = [
        " + ".join(f"(c{PER_NUMBER * (i // STRIDE) + i % STRIDE + STRIDE * k} << {STRIDE * k})" for k in range(3))
        for i in range(SUMS)
    ]
    words = [f"e{i}" for i in range(EXACT)] + ["n", *packed]
    text = " || ".join(f"printf('%015x', {w})" for w in words)
    half = LANE_MASK + 1
    signs = ", ".join(f"((2 * c{i} - n + {half}) % {2 * half} + {2 * half}) % {2 * half} - {half}" for i in range(LANES))
    return f"""
{out}_exact AS (SELECT key, {exact} FROM (SELECT key, sha256(unnest(string_split(t, chr(10)))) AS d FROM {source}) GROUP BY key),
{out}_lanes AS (SELECT key, count(h) AS n, {lanes} FROM (SELECT key, h, {parts} FROM (
  SELECT key, md5(unnest(regexp_extract_all(t, '{PIECE}'))) AS h FROM {source})) GROUP BY key),
{out} AS (SELECT key, {text} AS fp, [{signs}] AS signs FROM {out}_exact JOIN (
  SELECT s.key, coalesce(n, 0) AS n, {", ".join(f"coalesce(c{i}, 0) AS c{i}" for i in range(LANES))}
  FROM {source} s LEFT JOIN {out}_lanes l USING (key)) USING (key))"""


def _sql_near(a: str, b: str) -> str:
    dot = lambda x, y: f"CAST(list_sum(list_transform(list_zip({x}.signs, {y}.signs), lambda p: p[1] * p[2])) AS DOUBLE)"
    length = f"sqrt({dot(a, a)} * {dot(b, b)})"
    return f"CASE WHEN {a}.fp = {b}.fp THEN 1.0 WHEN {length} > 0 THEN greatest(0.0, least(1.0, {dot(a, b)} / {length})) ELSE 0.0 END"


ORACLE = f"""
WITH ordered AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id DESC, coalesce(text, '') DESC) AS key
  FROM documents),
followed AS (SELECT *, coalesce(lead(key) OVER (ORDER BY key), 1) AS after, coalesce(lead(t) OVER (ORDER BY key),
  first_value(t) OVER (ORDER BY key)) AS next_t FROM ordered),
changed AS (SELECT key, left(t, length(t) - length(t) // 2) || left(next_t, length(t) // 2) AS t FROM followed),
{_sql_sums("ordered", "own")}, {_sql_sums("changed", "new")}
SELECT doc_id, length(f.t) AS n_chars, sha256(c.t) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint,
  CAST({_sql_near("a", "b")} AS DOUBLE) AS near_edited, CAST({_sql_near("a", "z")} AS DOUBLE) AS near_next
FROM followed f JOIN changed c USING (key) JOIN own a USING (key) JOIN new b USING (key) JOIN own z ON z.key = f.after
"""
