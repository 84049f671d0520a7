"""Line dedup by levelled sorted runs of line hashes.

A line's key is the line without white space at its ends and with A-Z in lower case; keys of ``MIN_CHARS``
code points or more count. Documents come in batches. A batch is reduced to one entry
for each 128-bit hash of a key: in how many of its documents it stands, and the
largest of their ids. The store (``Runs``) keeps entries in runs: tables in the shared folder, bucketed by the hash
and sorted by it in each bucket, so that a batch meets a run by a merge join for which the
run is neither shuffled nor sorted again. Entries that a run settles already (it
counts ``MIN_DOCS`` documents or more, and no smaller id) are anti-joined away; the others are
the batch's own run on level 0. A level holds one run: a second one is merged with it, to one of
the next level, so a store of n batches has log2(n) runs at most, and every entry is
rewritten log2(n) times. Compacting all runs gives the totals.

``deduplicate`` deals the documents into ``BATCHES`` batches, the largest ids first, so that frequent lines are
settled early, and then drops, of each line in ``MIN_DOCS`` documents or more, all but
those of the document with the largest id. Documents are read twice: for the hashes, and to be cut;
frequent lines are summed before each shuffle, and meet the lines again by a broadcast of
at most ``HOT`` entries (``join_hot``).

Defined cases: a null or empty text is one empty line and stays as it is (null as empty
in ``kept_sha256``); rows are documents of their own, also those that share an id, and all rows of the largest id keep
the line; a null id is smaller than any other; a line of any length is hashed whole; empty tables
give no rows; other columns pass through ``deduplicate``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.chunks import numbered
from gleaner.llm.common import bounded_batches, fresh_name, join_hot, shared_folder, table

MIN_CHARS, MIN_DOCS = 20, 3
BATCHES = 8
SPACE = b" \t\n\v\f\r"
HASH = ["h1", "h2"]


def key_of(line: bytes) -> bytes | None:
    """The key of a line in UTF-8; none if it is too short to count."""
    key = line.strip(SPACE).lower()  # of bytes: A-Z only
    if len(key) < MIN_CHARS or not key.isascii() and len(key.decode("utf-8", "surrogatepass")) < MIN_CHARS:
        return None
    return key


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, _nth, _batch, h1, h2, at): for each key of a row of ``docs(doc_id, _nth, _batch, text)``
    its hash and the numbers of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, digests, at, ends = [], [], [], [0]
            for row, text in enumerate(batch.column("text").to_pylist()):
                found: dict[bytes, list[int]] = {}
                for number, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n") if text else ()):
                    if key := key_of(line):
                        found.setdefault(key, []).append(number)
                rows += [row] * len(found)
                digests += [hashlib.blake2b(key, digest_size=16).digest() for key in found]
                for numbers in found.values():
                    at += numbers
                    ends.append(len(at))
            hashes = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))
            own = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("doc_id", "_nth", "_batch")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(hashes[:, 0].copy()), pa.array(hashes[:, 1].copy()), lists], ["doc_id", "_nth", "_batch", *HASH, "at"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("_nth").cast("long"), F.col("_batch").cast("int"), "text")
    return rows.mapInArrow(run, "doc_id long, _nth long, _batch int, h1 long, h2 long, at array<int>")


def entries(lines: DataFrame) -> DataFrame:
    """(h1, h2, n, last): in how many documents each key stands, and the largest id of those."""
    return lines.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))


class Runs:
    """Sorted runs of entries in levels; see the module. ``name`` makes its tables' names, which
    ``forget`` takes out of the catalog again; the files stay in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, min_docs: int = MIN_DOCS) -> None:
        self.spark, self.folder, self.min_docs = spark, folder, min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name, self.made = f"line_runs_{uuid.uuid4().hex}", 0
        self.levels: list[str | None] = []

    def write(self, rows: DataFrame) -> str:
        """A run of ``rows``, which an aggregation or a merge has dealt by their hash already."""
        name = f"{self.name}_{self.made}"
        self.made += 1
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def add(self, batch: DataFrame) -> None:
        """The entries of a batch: those that no run settles become a run of level 0."""
        fresh = batch.alias("new")
        for name in filter(None, reversed(self.levels)):  # the oldest, and largest, first
            settled = self.spark.table(name).where(F.col("n") >= self.min_docs).alias("run")
            same = (F.col("new.h1") == F.col("run.h1")) & (F.col("new.h2") == F.col("run.h2"))
            newer = F.coalesce(F.col("run.last") < F.col("new.last"), F.col("run.last").isNull() & F.col("new.last").isNotNull())
            fresh = fresh.join(settled.hint("merge"), same & ~newer, "left_anti").alias("new")
        self.put(self.write(fresh), 0)

    def put(self, name: str, level: int) -> None:
        """A run on its level, or with the run that is there as one on the next."""
        if level == len(self.levels):
            self.levels.append(None)
        if self.levels[level] is None:
            self.levels[level] = name
        else:
            old, self.levels[level] = self.levels[level], None
            self.put(self.merged(old, name), level + 1)

    def merged(self, one: str, two: str) -> str:
        """Two runs as one, bucket by bucket: a merge join, without a shuffle. The two are forgotten."""
        a, b = self.spark.table(one).alias("a"), self.spark.table(two).alias("b")
        same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))
        hashes = [F.coalesce(f"a.{h}", f"b.{h}").alias(h) for h in HASH]
        n = F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))
        name = self.write(a.join(b.hint("merge"), same, "full_outer").select(*hashes, n.alias("n"), F.greatest("a.last", "b.last").alias("last")))
        self.drop(one, two)
        return name

    def totals(self) -> DataFrame:
        """(h1, h2, n, last) of the keys in ``min_docs`` documents or more, all runs being compacted to
        one. ``n`` is a lower bound, for settled entries are not counted on."""
        names = [x for x in self.levels if x]
        while len(names) > 1:
            names = [self.merged(names[0], names[1]), *names[2:]]
        self.levels = names
        return self.spark.table(names[0]).where(F.col("n") >= self.min_docs)

    def drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def forget(self) -> None:
        self.drop(*filter(None, self.levels))
        self.levels = []


def batch_number(docs: DataFrame, batches: int) -> Column:
    """Batches of about equal size, the largest ids first, rows without an id in the last."""
    edges = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    below = [(F.col("doc_id") <= edge).cast("int") for edge in edges]
    return F.coalesce(sum(below, F.lit(0)), F.lit(batches - 1))


def dropped(docs: DataFrame, batches: int = BATCHES, min_docs: int = MIN_DOCS) -> DataFrame:
    """(_doc, _row, _at): the numbers of the lines to drop from each row of ``docs(doc_id, _nth, text)`` that has any."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    found = line_rows(docs.withColumn("_batch", batch_number(docs, batches)))
    found.write.partitionBy("_batch").parquet(f"{folder}/lines")
    lines = spark.read.schema(found.schema).parquet(f"{folder}/lines")
    store = Runs(spark, folder, min_docs)
    for number in range(batches):
        store.add(entries(lines.where(F.col("_batch") == number)))
    store.totals().write.parquet(f"{folder}/totals")
    store.forget()
    totals = spark.read.parquet(f"{folder}/totals")
    held = join_hot(lines.drop("_batch"), totals, HASH, "n").where(~F.col("doc_id").eqNullSafe(F.col("last")))
    return held.groupBy(F.col("doc_id").alias("_doc"), F.col("_nth").alias("_row")).agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("_at"))  # of one text


def without(texts: pd.Series, numbers: pd.Series) -> pd.Series:
    """Each text without the lines of those numbers."""
    return pd.Series([text if at is None else rest(text, at) for text, at in zip(texts, numbers, strict=True)], dtype=object)


def rest(text: str, at: np.ndarray) -> str:
    gone = set(at.tolist())
    return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)


def deduplicate(docs: DataFrame, batches: int = BATCHES, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with lines dropped from ``text``, and ``n_dropped``, how many; a column of that name is kept as ``n_dropped_aside``."""
    if clash := {"_doc", "_row", "_nth", "_at", "_id", "n_dropped"} & {c.lower() for c in docs.columns}:  # set aside, put back below
        aside = {c: fresh_name(docs, f"{c}_aside") for c in docs.columns if c.lower() in clash}
        return deduplicate(docs.withColumnsRenamed(aside), batches, min_docs).withColumnsRenamed({v: k for k, v in aside.items() if k.lower() != "n_dropped"})
    docs = numbered(docs)
    gone = dropped(docs.select("doc_id", "_nth", "text"), batches, min_docs)
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_nth") == F.col("_row")), "left")
    return joined.withColumns({"text": F.pandas_udf(without, "string")("text", "_at"), "n_dropped": F.coalesce(F.size("_at"), F.lit(0)).cast("long")}).drop("_doc", "_row", "_nth", "_at")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many go, and the digest of those that stay."""
    bounded_batches(spark)
    text = F.coalesce("text", F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    found = deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text", lines.cast("long").alias("n_lines")))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


OP13_SQL = r"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
 l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM d),
 y AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
 g AS (SELECT key, max(doc_id) AS last FROM y WHERE length(key) >= 20 GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3)
 SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE g.key IS NOT NULL AND last <> doc_id)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE g.key IS NULL OR last = doc_id), '')) AS kept_sha256 FROM y LEFT JOIN g USING (key) GROUP BY doc_id"""
