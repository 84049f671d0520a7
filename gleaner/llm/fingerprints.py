"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A text is the multiset of its lines. Every line is hashed (SHA-256) and the
digest is widened into ``LANES`` 8-bit values; a document's fingerprint is the
lane-wise sum modulo 2**30, with the number of lines. Sums commute, so the order of paragraphs does not
matter, and adding or removing a paragraph adds or subtracts its lanes. Because
the lane values are centred on zero, the cosine of two fingerprints estimates the cosine of the
documents' counts of paragraphs, with a standard error of at most 1 / sqrt(LANES), about 0.07. Sums are
exact, and so is that bound, up to 2**22 equal lines in a text.

Everything is built-in DataFrame functions; no Python runs on the executors.

Defined cases: a null text is an empty text, whose one paragraph is empty. Rows
with the same ``doc_id`` are ordered by the hash of their text; a row without an
id follows the smallest id. A single row is its own next document. An empty table
gives no rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import ordered_buckets, table

LANES = 192
ROWS_PER_BUCKET = 64
#: A long holds two lanes of 30 bits, each in a field of 32, so that adding two
#: longs carries into no other lane and never overflows. A hash gives the values of eight lanes.
FIELDS, BYTES = (0, 32), (0, 8, 16, 24)
LANE = (1 << 30) - 1
LANE_MASK = sum(LANE << f for f in FIELDS)
BYTE_MASK = sum(0xFF << f for f in FIELDS)


def add(a: Column, b: Column) -> Column:
    """The sum of two multisets' vectors, lane by lane modulo 2**30."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(LANE_MASK)))


def subtract(a: Column, b: Column) -> Column:
    """The vector of a multiset from which another, contained in it, was taken."""
    return F.zip_with(a, b, lambda x, y: (x + (F.lit(LANE_MASK) - y) + F.lit(sum(1 << f for f in FIELDS))).bitwiseAND(F.lit(LANE_MASK)))


def paragraphs_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def fingerprint(text: Column, lanes: int = LANES) -> Column:
    """array<long>: packed sums over the lines of ``text``, and last their number."""
    lines = paragraphs_of(text)
    digests = F.transform(lines, lambda p: F.sha2(p, 256))
    zero = F.array_repeat(F.lit(0).cast("long"), lanes // 2)
    seeds = F.sequence(F.lit(1), F.lit(lanes // 8))
    low = lambda w, k: F.call_function("shiftrightunsigned", w, F.lit(k)).bitwiseAND(F.lit(BYTE_MASK))
    bytes_at = lambda ws, k: F.transform(ws, lambda w: low(w, k))
    words = lambda d: F.transform(seeds, lambda i: F.xxhash64(i, d))
    step = lambda acc, ws: add(acc, F.concat(*[bytes_at(ws, k) for k in BYTES]))
    return F.concat(F.aggregate(F.transform(digests, words), zero, step), F.array(F.size(lines).cast("long")))


def lane_values(vector: Column) -> Column:
    """array<long>: the lanes, centred on zero, modulo 2**30 and signed."""
    n = F.element_at(vector, -1)
    packed = F.slice(vector, 1, F.size(vector) - 1)
    field = lambda x, f: F.call_function("shiftrightunsigned", x, F.lit(f)).bitwiseAND(F.lit(LANE))
    centred = lambda x, f: F.pmod(field(x, f) - n * F.lit(128) + F.lit(1 << 29), F.lit(1 << 30)) - F.lit(1 << 29)
    lanes = lambda f: F.transform(packed, lambda x: centred(x, f))
    return F.concat(*[lanes(f) for f in FIELDS])


def to_hex(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two fingerprints' centred lanes, cut to 0..1; equal ones give 1."""
    signed = lambda v: F.transform(lane_values(v), lambda x: x.cast("double"))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    sums = F.transform(F.array(F.struct(signed(a).alias("x"), signed(b).alias("y"))), lambda v: F.struct(
        total(F.zip_with(v["x"], v["y"], lambda p, q: p * q)).alias("dot"),
        F.sqrt(total(F.transform(v["x"], lambda p: p * p)) * total(F.transform(v["y"], lambda p: p * p))).alias("norm"),
    ))[0]
    cosine = F.transform(F.array(sums), lambda s: F.when(s["norm"] == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s["dot"] / s["norm"]))))[0]
    return F.when(a == b, F.lit(1.0)).otherwise(cosine)


def with_next(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Each row of ``docs(doc_id, text, vector)`` beside the next one in descending id.

    Rows are dealt by narrow id ranges, so one shuffle brings neighbours together.
    Only the last row of a range needs the first row of the next lower range that
    has rows; those few rows meet in a second, small join.
    """
    keys = docs.select("doc_id", F.xxhash64("text").alias("tie"))
    bucket = ordered_buckets(keys, "doc_id", "tie", rows_per_bucket)
    rows = docs.withColumn("tie", F.xxhash64("text")).withColumn("bucket", bucket)
    inside = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    seen = rows.withColumns({
        "before": F.lag(F.lit(1)).over(inside),
        "next_text": F.lead("text").over(inside),
        "next_vector": F.lead("vector").over(inside),
    })
    ids = keys.select(bucket.alias("bucket")).distinct().withColumn("super", F.floor(F.col("bucket") / F.lit(4096)))
    tops = ids.groupBy("super").agg(F.max("bucket").alias("top"))
    ends = tops.select("super", F.coalesce(F.lead("top").over(Window.orderBy(F.col("super").desc())), F.max("top").over(Window.partitionBy(F.lit(1)))).alias("beyond"))
    lower = ids.join(ends, "super").select("bucket", F.coalesce(F.lead("bucket").over(Window.partitionBy("super").orderBy(F.col("bucket").desc())), F.col("beyond")).alias("lower"))
    first = seen.where(F.col("before").isNull()).select(F.col("bucket").alias("lower"), F.col("text").alias("next_text"), F.col("vector").alias("next_vector"))
    last = seen.where(F.col("next_text").isNull()).drop("next_text", "next_vector").join(lower, "bucket", "left").join(first, "lower", "left").drop("lower")
    return seen.where(F.col("next_text").isNotNull()).unionByName(last).drop("bucket", "tie", "before")


def fingerprint_documents(docs: DataFrame, lanes: int = LANES) -> DataFrame:
    """doc_id, text, vector, and the edited text and its vector, and both likenesses.

    The edited text is the text with its last floor(n/2) code points replaced by
    the first as many (or all) of the next document's.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    pairs = with_next(docs.select("doc_id", text.alias("text")).withColumn("vector", fingerprint(F.col("text"), lanes)))
    n = F.length("text")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.expr("left(next_text, cast(floor(length(text) / 2) as int))"))
    pairs = pairs.select("doc_id", "text", n.cast("long").alias("n_chars"), "vector", "next_vector", edited.alias("edited_text"))
    pairs = pairs.withColumn("edited_vector", fingerprint(F.col("edited_text"), lanes))
    return pairs.withColumns({"near_edited": likeness(F.col("vector"), F.col("edited_vector")), "near_next": likeness(F.col("vector"), F.col("next_vector"))})


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint_documents(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        to_hex(F.col("vector")).alias("fingerprint"), to_hex(F.col("edited_vector")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
