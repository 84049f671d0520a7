"""Search over fetched pages, for many queries at once.

A page answers a query if it holds all of its words. Queries of the same words are one. Pages are dealt into blocks
and meet the queries there: a block's task lays out its pages under the words asked for, looks for each query under its
rarest word and keeps the block's first few answers of it. So the pages that are looked at, which grow faster than the pages
there are, are never rows; a page is moved once, and of a query its words and a few answers for each block. Answers are ranked by BM25
in whole numbers (k1 1.2, b 0.75), and of each query the first few stay.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import scalars as X
from gleaner.operators import links
from gleaner.sources.tables import cut

#: Characters of a block's words, words of the queries that it meets at a time, and pages whose words are apart at once.
BLOCK, ASKED, ROWS = 2**25, 2**22, 1024


def words_of(text: Column) -> Column:
    """The words, in lower case: runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1)


def visible(html: Column) -> Column:
    """What stands between tags."""
    return F.regexp_replace(html, "<[^>]*>", " ")


def headings(html: Column) -> Column:
    """The title and the headings of the first two levels, as text."""
    found = F.regexp_extract_all(html, F.lit(r"(?s)<(?:title|h1|h2)>(.*?)</(?:title|h1|h2)>"), 1)
    return F.array_join(F.transform(found, visible), " ")


def page_index(pages: DataFrame) -> DataFrame:
    """(page, n, words) of ``pages(page, text)``, a row for each page: its words in order, repeats included, one blank apart,
    and how many they are."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    blanks = F.length("words") - F.length(F.replace("words", F.lit(" ")))
    return pages.select("page", words.alias("words")).select("page", F.when(F.col("words") == "", 0).otherwise(blanks + 1).cast("long").alias("n"), "words")


def first_answers(pages: pa.Table, asked: pa.Table, first: int, count: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one block: the rows of ``asked`` and of ``pages`` that meet, and their scores; of each query the first few, the highest score
    first, then the first row. ``count`` pages have ``total`` words in all."""
    split = lambda x: pc.split_pattern(x.combine_chunks(), " ")
    sets = split(asked["words"])
    wanted = sets.flatten().unique()
    numbered = lambda x: pc.index_in(x.flatten(), value_set=wanted).fill_null(-1).to_numpy()
    laid, base = [], 300 + (900 * pages["n"].to_numpy() * count) // total
    for k in range(0, pages.num_rows, ROWS):
        held = split(pages["words"].slice(k, ROWS))
        terms, rows = numbered(held), np.repeat(np.arange(len(held)), pc.list_value_length(held).to_numpy())
        keys, tf = np.unique(terms[terms >= 0].astype(np.int64) * ROWS + rows[terms >= 0], return_counts=True)
        part = (2200000 * tf) // (1000 * tf + base[keys % ROWS + k])
        laid.append([x.astype(np.int32) for x in (keys // ROWS, keys % ROWS + k, part)])
    terms, at, part = (np.concatenate(x) for x in zip(*laid, strict=True))
    del laid[:]
    order = np.argsort(terms, kind="stable")  # by word, then by page
    ends, at, part = np.searchsorted(terms[order], np.arange(len(wanted) + 1)), at[order], part[order].astype(np.int64)
    codes, weights = numbered(sets), asked["weights"].combine_chunks().flatten().to_numpy().astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(sets).to_numpy())])
    whole = np.flatnonzero(np.minimum.reduceat(np.diff(ends)[codes], starts[:-1]))  # all words occur in the block
    lengths, found, given = np.zeros(len(sets), np.int64), bytearray(), bytearray()  # small arrays would take far more
    for k in whole.tolist():
        mine = range(starts[k], starts[k + 1])
        rows = scores = None
        for lo, hi, weight in zip(ends[codes[mine]].tolist(), ends[codes[mine] + 1].tolist(), weights[mine].tolist(), strict=True):
            if rows is None:
                rows, scores = at[lo:hi], weight * part[lo:hi]
                continue
            place = np.minimum(np.searchsorted(at[lo:hi], rows), hi - lo - 1) + lo
            both = at[place] == rows
            rows, scores = rows[both], scores[both] + weight * part[place[both]]
        if len(rows) > first:
            best = np.flatnonzero(scores >= np.partition(scores, -first)[-first])
            rows, scores = rows[best], scores[best]
        order = np.lexsort((rows, -scores))[:first]
        lengths[k] = len(order)
        found += rows[order].tobytes()
        given += scores[order].tobytes()
    return np.repeat(np.arange(len(sets)), lengths), np.frombuffer(found, np.int32), np.frombuffer(given, np.int64)


def answers(index: DataFrame, queries: DataFrame, first: int = 5, block: int = BLOCK, most: int = ASKED) -> DataFrame:
    """(query, page, score, rank) of ``queries(query, text)``: the ``first`` pages that hold every word of it, the highest score first, then the smallest
    page. A query without words, and one with a word of no page, has no answer; ``index`` is used several times and
    should be a table or cut. Equal queries are answered once. A block is pages of about ``block`` characters of
    words, and meets queries of about ``most`` words at a time."""
    spark = index.sparkSession
    index = index.where("n > 0")
    rows, ids = index.agg(F.count(F.lit(1)), F.count_distinct("page")).first()
    if rows > ids:  # rows of one page are one, and so are those of none, which no query finds
        index = cut(index.groupBy("page").agg(F.sum("n").alias("n"), F.array_join(F.collect_list("words"), " ").alias("words")))
    count, total, size = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1)), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    held = index.select(F.explode(F.array_distinct(F.split("words", " "))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    asked = queries.select("query", F.explode(words_of(F.col("text"))).alias("word")).groupBy("query").agg(F.sort_array(F.collect_set("word")).alias("_words"))  # words of one query
    sets = cut(asked.select("_words").distinct().withColumn("set", F.monotonically_increasing_id()))
    parts = max(1, math.ceil((sets.agg(F.sum(F.size("_words"))).first()[0] or 0) / most))
    blocks = max(math.ceil(size / block), 2 * spark.sparkContext.defaultParallelism)
    weight = F.floor(1000 * F.log((2 * F.lit(count).cast("long") + 2) / (2 * F.col("df") + 1))).cast("int")
    known = sets.select("set", F.size("_words").alias("_n"), F.explode("_words").alias("word")).join(held, "word")
    whole = known.groupBy("set", "_n").agg(F.sort_array(F.collect_list(F.struct("df", weight.alias("weight"), "word"))).alias("_x")).where(F.size("_x") == F.col("_n"))  # the rarest first
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    sides = index.where(F.col("page").isNotNull()).select(dealt("page", blocks).alias("block"), every(parts).alias("part"), "page", "n", "words"), whole.select(every(blocks).alias("block"), dealt("set", parts).alias("part"), "set", F.array_join("_x.word", " ").alias("words"), F.col("_x.weight").alias("weights"))

    def meet(pages: pa.Table, asked: pa.Table) -> pa.Table:
        if not pages.num_rows or not asked.num_rows:
            none = np.zeros(0, np.int64)
            return pa.table({"set": asked["set"].take(none), "page": pages["page"].take(none), "score": none})
        pages = pages.sort_by("page")
        mine, rows, scores = first_answers(pages, asked, first, count, total)
        return pa.table({"set": asked["set"].take(mine), "page": pages["page"].take(rows), "score": scores})

    schema = T.StructType([T.StructField("set", T.LongType()), T.StructField("page", index.schema["page"].dataType), T.StructField("score", T.LongType())])
    left, right = (x.groupBy("block", "part") for x in sides)
    met = left.cogroup(right).applyInArrow(meet, schema)
    place = F.row_number().over(Window.partitionBy("set").orderBy(F.desc("score"), "page"))
    best = met.withColumn("rank", place).where(F.col("rank") <= first)
    return asked.join(sets, "_words").join(best, "set").select("query", "page", "score", "rank")


def find_lists(pages: DataFrame, index: DataFrame, venues: DataFrame, first: int = 5) -> DataFrame:
    """(id, url): for each of ``venues(id, name)`` the page of ``pages(page, url, html)`` that two passes of search find: with the
    word 'pdf' and then without, each by its first few answers, of which the first counts that is a list of the hub and bears the
    name in its title or headings. Null where no pass finds one; a blank name finds nothing."""
    passes = venues.select(F.col("name").alias("_name"), F.explode(F.array(F.struct(F.lit(1).alias("pass"), F.concat_ws(" ", "name", F.lit("pdf")).alias("text")), F.struct(F.lit(2).alias("pass"), F.col("name").alias("text")))).alias("p"))
    queries = passes.where(F.col("_name").isNotNull()).select(F.struct("_name", "p.pass").alias("query"), "p.text").distinct()
    found = answers(index, queries, first).select(F.col("query._name").alias("name"), F.col("query.pass").alias("pass"), "rank", "page")
    results = found.join(pages.select("page", "url", headings(F.col("html")).alias("page_text")), "page")
    by_name = links.two_passes(results.withColumn("key", F.col("name")), "key", "name")
    spread = F.coalesce(F.length("name").cast("long"), F.xxhash64("id"))  # else all venues without a name are one task's
    return venues.join(by_name, (F.col("name") == F.col("key")) & (spread == F.length("key").cast("long")), "left").select("id", "url")
