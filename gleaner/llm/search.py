"""Ranked lexical search by pair-bound MaxScore.

Documents are read once: each gives its length and how often it holds the terms asked for
(``postings``, a table in the shared folder). The tasks of the second pass form blocks of ``BLOCK``
documents. For each block and before any item is looked at, the inverted lists are laid
out with the impact of each posting and each list's largest, and beside them, for pairs of
terms that stand together in items, the lists of documents that hold both, with the
largest joint impact. An item's terms form a path from the most frequent to the rarest, whose
neighbours are such pairs. No document gets more from two neighbours than the larger
of their joint maximum and their own maxima; the least sum over all ways to cover the path's beginning
by single terms and pairs bounds what those terms together can give (a minimum by
dynamic programming). The longest beginning that is bounded below the score of the k-th document so far
is not essential: only documents on the other lists are looked at, and those are given up as
soon as score and bound stay below. While fewer than k are known, the documents of the
rarest pairs' lists are scored first, for an early threshold. Every skip is by a strict
bound, so results are exact.

Each task keeps k documents an item, whose best k are taken by two windows, the first over
salted shares. No list of documents and no score is shuffled besides those.

Defined cases: a null or empty text has no terms; a document without terms counts in
neither N nor L; an item without terms, or with none that occurs, has no rows; items and
documents are rows, so those of equal ids are each ranked; of equal scores the smallest doc_id comes
first, and one that is null last; terms of weight 0 give nothing; empty tables give no
rows; other columns are not looked at. The terms of all items are held by every task:
items of over ``QUERY_TERMS`` terms in all are searched in rounds.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import bounded_batches, cut, shared_folder, table
from gleaner.llm.terms import spacing, terms_of

TABLE = spacing(digits=True)
#: Documents of a block, results of an item, terms of the items of a round, salts of the first window.
BLOCK, RESULTS, QUERY_TERMS, SALTS = 8192, 50, 500_000, 32


def asked_terms(items: DataFrame) -> DataFrame:
    """(_item, item_id, terms): a number, the id and the distinct terms of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(x, TABLE))) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_item"), batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], ["_item", "item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select(F.monotonically_increasing_id().alias("_item"), "item_id", "text")
    return rows.mapInArrow(run, f"_item long, item_id {kind}, terms array<binary>")


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): the terms of each document, and how often it holds those that are asked for."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for batch in batches:
            lengths, terms, tfs, ends = [], [], [], [0]
            for text in batch.column("text").to_pylist():
                words = terms_of(text, TABLE)
                counts = Counter(words)
                held = counts.keys() & numbers.keys()
                lengths.append(len(words))
                terms += map(numbers.__getitem__, held)
                tfs += map(counts.__getitem__, held)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Block:
    """The inverted lists of some documents, and the lists of pairs of terms."""

    def __init__(self, lengths: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n: int, total: int, pairs: np.ndarray) -> None:
        at = np.repeat(np.arange(len(lengths)), np.diff(ends))
        m = 50 + (50 * n * lengths) // max(total, 1)
        impacts = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[at]))
        given = np.flatnonzero(impacts > 0)
        order = given[np.argsort(terms[given], kind="stable")]
        self.size, self.at, self.impacts = len(lengths), at[order], impacts[order]
        self.ends = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.tops = np.zeros(len(weights), np.int64)
        some = np.flatnonzero(np.diff(self.ends))
        if len(some):
            self.tops[some] = np.maximum.reduceat(self.impacts, self.ends[some])
        self.both, self.joint = [None] * len(pairs), np.zeros(len(pairs), np.int64)
        slots, filled = np.zeros(self.size, np.int64), -1
        for k, (a, b) in enumerate(pairs.tolist()):  # by a, whose list is laid out once
            if not self.tops[a] or not self.tops[b]:
                continue
            if a != filled:
                slots[:] = 0
                at_a, of_a = self.of(a)
                slots[at_a], filled = of_a, a
            at_b, of_b = self.of(b)
            found = np.flatnonzero(slots[at_b])
            if len(found):
                self.both[k] = at_b[found]
                self.joint[k] = (slots[at_b[found]] + of_b[found]).max()

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.ends[term], self.ends[term + 1]
        return self.at[lo:hi], self.impacts[lo:hi]

    def add(self, term: int, found: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """``scores`` of the documents ``found`` with what ``term`` gives them."""
        at, impacts = self.of(term)
        if not len(at):
            return scores
        k = np.minimum(np.searchsorted(at, found), len(at) - 1)
        return scores + np.where(at[k] == found, impacts[k], 0)

    def bounds(self, path: np.ndarray, pairs: np.ndarray) -> list[int]:
        """What the path's first 0, 1, 2, ... terms can give together at most."""
        tops, joint = self.tops[path], self.joint[pairs]
        two = np.maximum(np.maximum(tops[1:], tops[:-1]), joint).tolist()
        best = [0, *tops[:1].tolist()]
        for one, pair in zip(tops[1:].tolist(), two, strict=True):
            best.append(min(best[-1] + one, best[-2] + pair))
        return best

    def early(self, path: np.ndarray, pairs: np.ndarray, k: int) -> int:
        """The k-th score among the documents of the rarest pairs' lists; 0 if they are fewer."""
        lists, count = [], 0
        for pair in pairs[::-1].tolist():
            if self.both[pair] is not None:
                lists.append(self.both[pair])
                count += len(lists[-1])
            if count >= 2 * k:
                break
        found = np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.int64)
        if len(found) < k:
            return 0
        scores = np.zeros(len(found), np.int64)
        for term in path.tolist():
            scores = self.add(term, found, scores)
        return int(np.partition(scores, -k)[-k])

    def search(self, path: np.ndarray, pairs: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents that score ``least`` or more, and over 0, and their scores; of those that
        cannot be among the first k some are left out."""
        best = self.bounds(path, pairs)
        if best[-1] < max(least, 1):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = max(least, self.early(path, pairs, k), 1) if least <= 1 else least
        split = bisect_left(best, least) - 1  # the first ``split`` terms are not essential
        dense = np.zeros(self.size, np.int64)
        for term in path[split:].tolist():
            at, impacts = self.of(term)
            dense[at] += impacts
        found = np.flatnonzero((dense > 0) & (dense + best[split] >= least))
        scores = dense[found]
        for i in range(split - 1, -1, -1):
            if not len(found):
                break
            scores = self.add(int(path[i]), found, scores)
            stay = scores + best[i] >= least
            found, scores = found[stay], scores[stay]
        return found, scores


def paths(items: list[list[int]], weights: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of each item its terms from the most frequent to the rarest and the numbers of their
    neighbours' pairs; and all pairs (a, b), a < b, in order."""
    ordered = [np.array(sorted((t for t in terms if weights[t] > 0), key=lambda t: (weights[t], t)), np.int64) for terms in items]
    sides = [np.stack([np.minimum(p[1:], p[:-1]), np.maximum(p[1:], p[:-1])], 1) for p in ordered]
    every = np.unique(np.concatenate([*sides, np.zeros((0, 2), np.int64)]), axis=0)
    number = {pair: k for k, pair in enumerate(map(tuple, every.tolist()))}
    return ordered, [np.array([number[tuple(x)] for x in side.tolist()], np.int64) for side in sides], every


def best_of(rows: DataFrame, k: int) -> DataFrame:
    """(_item, rank, doc_id, score): the first k of each item's rows."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    share = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    first = rows.withColumn("_share", share).withColumn("_r", F.row_number().over(Window.partitionBy("_item", "_share").orderBy(*order))).where(F.col("_r") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("_item").orderBy(*order))).where(F.col("rank") <= k).select("_item", "rank", "doc_id", "score")


def search_round(docs: DataFrame, asked: list, k: int, block: int) -> DataFrame:
    """(_item, rank, doc_id, score) for the items ``asked``: rows (_item, terms)."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for row in asked for t in row["terms"]}))}
    path = f"{shared_folder(spark)}/postings-{uuid.uuid4().hex}"
    postings(docs, vocabulary).write.parquet(path)
    forward = spark.read.parquet(path)
    n, total = forward.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holds = dict(forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row for each term asked for at most
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * holds[i] + 1))) if i in holds else 0 for i in range(len(vocabulary))], np.int64)
    shared = spark.sparkContext.broadcast((weights, *paths([[vocabulary[bytes(t)] for t in row["terms"]] for row in asked], weights)))
    numbers = [row["_item"] for row in asked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, ordered, sides, pairs = shared.value
        none = np.zeros(0, np.int64)
        kept = [(none, none, none)] * len(ordered)  # scores, whether the id is null, ids
        for part in blocks(batches, block):
            lists, tfs = part.column("terms").combine_chunks(), part.column("tfs").combine_chunks()
            ids = part.column("doc_id").combine_chunks()
            nulls, ids = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(0).to_numpy()
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            index = Block(part.column("n").to_numpy(), ends, lists.flatten().to_numpy(), tfs.flatten().to_numpy(), weights, n, total, pairs)
            for i, (terms, beside) in enumerate(zip(ordered, sides, strict=True)):
                least = int(kept[i][0][-1]) if len(kept[i][0]) == k else 0
                found, scores = index.search(terms, beside, least, k)
                if len(found):
                    joined = [np.concatenate(x) for x in zip(kept[i], (scores, nulls[found], ids[found]), strict=True)]
                    order = np.lexsort((joined[2], joined[1], -joined[0]))[:k]
                    kept[i] = tuple(x[order] for x in joined)
        for number, (scores, nulls, ids) in zip(numbers, kept, strict=True):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number)), pa.array(ids, mask=nulls > 0), pa.array(scores)], ["_item", "doc_id", "score"])

    return best_of(forward.mapInArrow(run, "_item long, doc_id long, score long"), k)


def blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches of a task as tables of about ``rows`` rows."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def search(docs: DataFrame, items: DataFrame, k: int = RESULTS, block: int = BLOCK, query_terms: int = QUERY_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best of ``docs(doc_id, text)`` for each of ``items(item_id, text)``."""
    asked = cut(asked_terms(items))
    count = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    rounds, found = max(1, math.ceil(count / query_terms)), None
    for r in range(rounds):
        rows = asked.where((F.pmod(F.xxhash64("_item"), F.lit(rounds)) == r) & (F.size("terms") > 0)).select("_item", "terms").collect()  # about query_terms terms
        part = search_round(docs, rows, k, block)
        found = part if found is None else found.unionByName(part)
    return found.join(asked.select("_item", "item_id"), "_item").select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    bounded_batches(spark)
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = rf"""WITH d AS (SELECT doc_id, unnest({WORDS.format("text")}) AS t FROM documents), k AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
 n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM k GROUP BY ALL), s AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM n), f AS (SELECT t, count(*) AS df FROM k GROUP BY ALL),
 w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM f, s), i AS (SELECT DISTINCT item_id, unnest({WORDS.format("text")}) AS t FROM benchmark),
 p AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // ll)))))::BIGINT AS score FROM i JOIN w USING (t) JOIN k USING (t) JOIN n USING (doc_id), s GROUP BY ALL)
 SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM p WHERE score > 0 QUALIFY rank <= 50"""
