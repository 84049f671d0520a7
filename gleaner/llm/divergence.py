"""Source divergence audit with run-length columns.

A group is a source within a language. Each text is counted where it is read, groups are summed
before and after the shuffle, and a language's vocabulary, the terms in at least ``MIN_DOCS``
of its documents, becomes a table with one row a term: its total and its count in each group that
has it. The vocabulary is then reordered, by range over (language, total, term), and inside each slice by the
groups' counts, the largest group first, so that terms of equal counts stand together.
A slice's counts of one group are one column, kept as runs: the ends of the runs, and p of each. For a
pair of groups the ends are merged, f is computed once for each piece between two ends,
multiplied by its length, and summed; slices are summed by Spark.

All arithmetic is in 64-bit integers and exact: 10^9 * (count + 2) div (N + 2 V) is divided in three steps of
1000, so counts up to 9 * 10^15 fit; (p - q)^2 is at most 10^18.

Defined cases: a null text has no terms; null lang and source are ''; a group whose texts
have no term is a group all the same, and one of a language without a kept term gets value
0 with all others; equal values are ranked by the item's UTF-8; repeated rows count
each; empty tables give no rows; other columns are not looked at. The sizes of the groups (one row a group)
go to all tasks: languages with over ``GROUPS`` groups in all are worked on in
rounds, and a single language of so many raises an error, for its result would have GROUPS^2 rows.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import bounded_batches, shared_folder, table
from gleaner.llm.terms import spacing, terms_of

TABLE = spacing(digits=False)
MIN_DOCS, TOP = 10, 10
#: Counted terms that a task holds before it passes them on; groups of a round; cells of a slice.
HELD, GROUPS, CELLS = 300_000, 1_000_000, 4_000_000
SCHEMA = "part string, lang string, source string, item string, value long"


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences and documents of the terms, summed in each task."""

    def rows(counts: dict, holds: dict) -> pa.RecordBatch:
        langs, sources, terms, n, d = [], [], [], [], []
        for (lang, source), found in counts.items():
            langs += [lang] * len(found)
            sources += [source] * len(found)
            terms += found.keys()
            n += found.values()
            d += map(holds[lang, source].__getitem__, found)
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.int64())], ["lang", "source", "term", "n", "d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, holds = defaultdict(Counter), defaultdict(Counter)
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                words = terms_of(text, TABLE)
                counts[lang, source].update(words)
                holds[lang, source].update(set(words))
            if sum(map(len, counts.values())) > HELD:
                yield rows(counts, holds)
                counts.clear()
                holds.clear()
        yield rows(counts, holds)

    found = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, d long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def vocabulary(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, total, per): the kept terms; ``per`` holds (source, n) of the groups that have it."""
    per = F.collect_list(F.struct("source", "n")).alias("per")  # a row a source
    return counted(docs).groupBy("lang", "term").agg(F.sum("d").alias("d"), F.sum("n").alias("total"), per).where(F.col("d") >= min_docs).drop("d")


def shares(counts: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """p: 1 + floor(10^9 * (count + 2) / whole), in three exact steps."""
    p, rest = np.divmod(counts + 2, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        p = p * 1000 + digits
    return 1 + p


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return ((p - q) * (p - q)) // (p + q)


class Slice:
    """Some terms of a language: the counts of each group, as columns of runs."""

    def __init__(self, counts: np.ndarray, wholes: np.ndarray) -> None:
        """``counts``: a row a term, a column a group; ``wholes``: N + 2 V of the groups."""
        largest = np.argsort(counts.sum(axis=0), kind="stable")  # lexsort looks at its last key first
        ordered = counts[np.lexsort(counts.T[largest])]
        self.columns = []
        for k in range(counts.shape[1]):
            column = ordered[:, k]
            ends = np.append(np.flatnonzero(np.diff(column)) + 1, len(column))
            self.columns.append((ends, shares(column[ends - 1], wholes[k])))

    def pair(self, a: int, b: int) -> int:
        """The sum of f over the slice's terms: f of each piece between run ends, times its length."""
        (ends_a, p), (ends_b, q) = self.columns[a], self.columns[b]
        ends = np.union1d(ends_a, ends_b)
        f = apart(p[np.searchsorted(ends_a, ends)], q[np.searchsorted(ends_b, ends)])
        return int((f * np.diff(ends, prepend=0)).sum())


def highest(terms: pa.Array, rows: np.ndarray, values: np.ndarray, top: int) -> list[tuple[str, int]]:
    """The ``top`` terms by value, equal ones by their UTF-8."""
    if len(values) > top:
        stay = values >= np.partition(values, -top)[-top]
        rows, values = rows[stay], values[stay]
    found = zip(terms.take(pa.array(rows)).to_pylist(), values.tolist(), strict=True)
    return sorted(found, key=lambda x: (-x[1], x[0].encode("utf-8", "surrogatepass")))[:top]


def sliced(kept: DataFrame, sizes: dict, top: int) -> DataFrame:
    """Rows of SCHEMA of each slice: its share of the sum of every pair of groups, and its
    highest terms of each group. ``sizes``: language -> (V, N, {source: N})."""
    shared = kept.sparkSession.sparkContext.broadcast(sizes)

    def slice_rows(lang: str, parts: list[pa.Table]) -> Iterator[tuple]:
        v, n, sources = shared.value[lang]
        names, wholes = list(sources), np.array([x + 2 * v for x in sources.values()], np.int64)
        number = {x: k for k, x in enumerate(names)}
        rows = pa.concat_tables(parts)
        per = rows.column("per").combine_chunks()
        inner = per.flatten()
        coded = inner.field("source").dictionary_encode()
        columns = np.array([number[x] for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
        at, held = np.repeat(np.arange(len(per)), per.value_lengths().to_numpy()), inner.field("n").to_numpy()
        counts = np.zeros((len(per), len(names)), np.int64)
        counts[at, columns] = held
        runs = Slice(counts, wholes)
        for a in range(len(names)):
            for b in range(a):
                value = runs.pair(a, b)
                yield "pair", lang, names[a], names[b], value
                yield "pair", lang, names[b], names[a], value
        p, q = shares(held, wholes[columns]), shares(rows.column("total").to_numpy(), n + 2 * v)[at]
        f, terms = np.where(p > q, apart(p, q), -1), rows.column("term").combine_chunks()
        for k in range(len(names)):
            own = np.flatnonzero((columns == k) & (f >= 0))
            for term, value in highest(terms, at[own], f[own], top):
                yield "term", lang, names[k], term, value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, parts in slices(batches, lambda lang: CELLS // max(1, len(shared.value[lang][2]))):
            out = list(zip(*slice_rows(lang, parts), strict=True))
            if out:
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in out[:4]), pa.array(out[4], pa.int64())], ["part", "lang", "source", "item", "value"])

    return kept.repartitionByRange("lang", "total", "term").sortWithinPartitions("lang", "total", "term").mapInArrow(run, SCHEMA)


def slices(batches: Iterator[pa.RecordBatch], most) -> Iterator[tuple[str, list[pa.Table]]]:  # noqa: ANN001
    """The rows of a task, by language (which they are sorted by) and in slices of ``most(lang)`` rows and a batch at most."""
    lang, held, count = None, [], 0
    for batch in map(lambda b: pa.Table.from_batches([b]), batches):
        for found in pc.unique(batch.column("lang")).to_pylist():
            part = batch.filter(pc.equal(batch.column("lang"), found))
            if held and (found != lang or count >= most(lang)):
                yield lang, held
                held, count = [], 0
            lang, count = found, count + part.num_rows
            held.append(part)
    if held:
        yield lang, held


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, most: int = GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each group of ``docs(lang, source, text)``
    is from each other group of its language, and its terms that stand out most."""
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], "text")
    folder = f"{shared_folder(spark)}/divergence-{uuid.uuid4().hex}"
    vocabulary(docs, min_docs).write.parquet(f"{folder}/vocabulary")
    kept = spark.read.parquet(f"{folder}/vocabulary")
    held = kept.select("lang", F.explode("per").alias("x")).groupBy("lang", "x.source").agg(F.sum("x.n").alias("n"))
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("whole"))
    groups = docs.select("lang", "source").distinct().join(held, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "whole")]).write.parquet(f"{folder}/groups")
    groups = spark.read.parquet(f"{folder}/groups")
    rounds = max(1, math.ceil(groups.count() / most))
    turn, found = F.pmod(F.xxhash64("lang"), F.lit(rounds)), None
    for r in range(rounds):
        own, sizes = groups.where(turn == r), {}
        rows = own.sort("lang", "source").limit(4 * most + 1).collect()  # a row a group, of about ``most``
        if len(rows) > 4 * most:
            raise ValueError(f"a language has over {most} sources: its pairs are too many")
        for row in rows:
            sizes.setdefault(row["lang"], (row["v"], row["whole"], {}))[2][row["source"]] = row["n"]
        part = sliced(kept.where(turn == r), sizes, top).unionByName(unlike(own))
        found = part if found is None else found.unionByName(part)
    summed = found.groupBy("part", "lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("part", "lang", "source").orderBy(F.desc("value"), "item"))
    ranked = summed.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")


def unlike(groups: DataFrame) -> DataFrame:
    """Pairs of the groups of languages without a kept term: their value is 0."""
    bare = groups.where("v = 0").select("lang", "source")
    other = bare.select("lang", F.col("source").alias("item"))
    return bare.join(other, "lang").where("source <> item").select(F.lit("pair").alias("part"), "lang", "source", "item", F.lit(0).cast("long").alias("value"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of sources of a language, and each source's ten telling terms."""
    bounded_batches(spark)
    return divergence(table(spark, sf_dir, "documents"))


OP12_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
 t AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
 v AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10), vv AS (SELECT lang, count(*) AS v FROM v GROUP BY ALL),
 c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN v USING (lang, term) GROUP BY ALL), g AS (SELECT DISTINCT lang, source FROM d),
 n AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS nn FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
 p AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (nn + 2 * v) AS p
  FROM g JOIN v USING (lang) JOIN vv USING (lang) JOIN n USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
 l AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL), q AS (SELECT l.lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // ((sum(n) OVER (PARTITION BY l.lang))::HUGEINT + 2 * v) AS q FROM l JOIN vv USING (lang)),
 s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
 r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
 SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r QUALIFY part = 'pair' OR rank <= 10"""
