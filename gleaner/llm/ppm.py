"""Language-model scoring by prediction by partial matching over bytes.

Training counts every ``ORDER + 1`` bytes of all training texts, in Spark. The trie
of contexts, of every order from ``ORDER`` to none, follows from those counts. A
byte that its longest known context has seen is coded with the context's counts;
otherwise an escape (method D: half a count for each distinct byte, taken from that
byte) leads to the next shorter context, where the bytes that the longer one has
seen are excluded.
A text's score is the sum of log10 of its bytes' probabilities.

All training rows and contexts are counted. A context is frequent if it holds at
least one in ``CONTEXTS`` of all training bytes; the trie that every worker gets has
the frequent contexts (at most ``CONTEXTS`` of each order) and all of up to ``WHOLE``
bytes. A byte after any other context is decided from the table of all counts, once
for each gram of a text, where that table lies, so ``CONTEXTS`` changes no score. Word counts for the base score are exact and distributed:
words that hold at least one in ``FREQUENT`` of all tokens (so at most that many)
are broadcast, all others are joined.

Defined cases: a null or empty text is the end token alone; a row without an id is a
training row; repeated rows are counted and scored each; with no training rows the
base is that of an empty table (one possible token) and every byte is equally
likely; texts of any length are scored whole; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import bounded_batches, cut, fold, shared_folder, table
from gleaner.llm.hashmap import HashMap
from gleaner.sources.tables import snapshot

ORDER = 5
CONTEXTS = 2_000_000
#: Contexts of up to so many bytes are broadcast whole; the table of counts is dealt by the next longer ones.
WHOLE = 2
#: Rows of that table that are decided together.
TABLE_ROWS = 1_000_000
FREQUENT = 50_000
#: The end token: no word holds white space.
END = b"\n"
FLUSH = 3_000_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over all rows of ``docs(text)``, with the end token of each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update(words_of(text))
            found[END] += len(batch)
            if len(found) > FLUSH // 10:
                yield pd.DataFrame({"word": list(found), "c": np.fromiter(found.values(), np.int64, len(found))})
                found.clear()
        yield pd.DataFrame({"word": list(found), "c": np.fromiter(found.values(), np.int64, len(found))})

    return docs.select("text").mapInPandas(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def grams_of(texts: list[str | None], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The last ``order + 1`` bytes at each place of all texts as integers, and how
    many places each text has: its words, one blank apart, and the end token."""
    lines = [b" ".join(words_of(t)) + END for t in texts]
    sizes = np.array([len(x) for x in lines], np.int64)
    lead = END * order  # the context of a text's first bytes
    raw = np.frombuffer(b"".join([y for x in lines for y in (lead, x)]), np.uint8)
    keys = np.zeros(len(raw), np.int64)
    for k in range(order + 1):
        keys[order:] |= raw[order - k : len(raw) - k].astype(np.int64) << (8 * k)
    inside = np.ones(len(raw), bool)
    starts = np.cumsum(sizes + order) - sizes - order
    for k in range(order):
        inside[starts + k] = False
    return keys[inside], sizes


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n) over all rows of ``docs(text)``."""

    def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        k, n = np.concatenate(keys), np.concatenate(counts)
        unique, place = np.unique(k, return_inverse=True)
        return unique, np.bincount(place, weights=n, minlength=len(unique)).astype(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts = [], []
        for batch in batches:
            for i in range(0, len(batch), 1000):
                k, n = np.unique(grams_of(batch["text"].iloc[i : i + 1000].tolist(), order)[0], return_counts=True)
                keys.append(k)
                counts.append(n)
                if len(keys) >= 8:
                    k, n = merged(keys, counts)
                    if len(k) > FLUSH:
                        yield pd.DataFrame({"gram": k, "n": n})
                        k, n = k[:0], n[:0]
                    keys, counts = [k], [n]
        if keys:
            k, n = merged(keys, counts)
            yield pd.DataFrame({"gram": k, "n": n})

    return docs.select("text").mapInPandas(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class Trie:
    """Counts of contexts and bytes of each order, and log10 probabilities."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int = ORDER) -> None:
        """``grams``: kept grams of the highest order down to single bytes, each
        level's keys marked by its order in the bits above."""
        self.order = order
        self.levels = []
        for k in range(order + 1):  # k bytes of context
            at = grams >> 56 == k
            gram, n = grams[at] & ((1 << 56) - 1), counts[at]
            by = np.argsort(gram)
            gram, n = gram[by], n[by]
            context, first, distinct = np.unique(gram >> 8, return_index=True, return_counts=True)
            total = np.add.reduceat(n, first) if len(first) else np.zeros(0, np.int64)
            level = {"gram": gram, "n": n, "context": context, "total": total, "distinct": distinct}
            # mass, in the next shorter context, of the bytes that this context has seen
            if k:
                low = self.levels[-1]
                short = (gram >> 8 & ((1 << (8 * (k - 1))) - 1)) << 8 | gram & 255
                inner = np.searchsorted(low["gram"], short)
                mass = low["n"][np.minimum(inner, len(low["n"]) - 1)] if len(low["n"]) else np.zeros(len(gram), np.int64)
                level["excluded"] = np.add.reduceat(mass, first) if len(first) else np.zeros(0, np.int64)
            else:
                level["excluded"] = np.zeros(len(context), np.int64)
            self.levels.append(level)
        self.maps: list | None = None

    def open(self) -> None:
        self.maps = [(HashMap(x["gram"]), HashMap(x["context"])) for x in self.levels]
        top = self.levels[-1]
        place = np.searchsorted(top["context"], top["gram"] >> 8)
        self.seen = np.log10((top["n"] - 0.5) / top["total"][place]) if len(top["gram"]) else np.zeros(1)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last byte after the others."""
        if self.maps is None:
            self.open()
        place = self.maps[-1][0].find(keys)
        out = self.seen[place]
        missing = np.flatnonzero(place < 0)
        if len(missing):
            distinct, back = np.unique(keys[missing], return_inverse=True)
            out[missing] = self.escape(distinct)[back]
        return out

    def frequent(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same, 0 after contexts that this trie lacks; and where those are."""
        if self.maps is None:
            self.open()
        place = self.maps[-1][0].find(keys)
        out = self.seen[place]
        missing = np.flatnonzero(place < 0)
        distinct, back = np.unique(keys[missing], return_inverse=True)
        held = self.maps[-1][1].find(distinct >> 8) >= 0 if self.order > WHOLE else np.ones(len(distinct), bool)
        found = np.zeros(len(distinct))
        found[held] = self.escape(distinct[held])
        out[missing] = found[back]
        return out, missing[~held[back]]

    def escape(self, keys: np.ndarray) -> np.ndarray:
        """The same for grams that the highest order may not have seen, by way of
        escapes with exclusion of what longer contexts have seen."""
        n = len(keys)
        out, open_ = np.zeros(n), np.ones(n, bool)
        shut, shut_mass = np.zeros(n, np.int64), np.zeros(n, np.int64)  # distinct bytes and mass excluded at this level
        for k in range(self.order, -1, -1):
            level, (grams, contexts) = self.levels[k], self.maps[k]
            at = np.flatnonzero(open_)
            if not len(at):
                return out
            gram = keys[at] & ((1 << (8 * (k + 1))) - 1)
            c = contexts.find(gram >> 8)
            known = c >= 0
            at, gram, c = at[known], gram[known], c[known]
            g = grams.find(gram)
            rest = level["total"][c] - shut_mass[at]
            fresh = level["distinct"][c] - shut[at]
            hit = g >= 0
            out[at[hit]] += np.log10((level["n"][g[hit]] - 0.5) / rest[hit])
            open_[at[hit]] = False
            miss = ~hit & (fresh > 0)
            out[at[miss]] += np.log10(0.5 * fresh[miss] / rest[miss])
            gone = at[~hit]
            shut[gone], shut_mass[gone] = level["distinct"][c[~hit]], level["excluded"][c[~hit]]
        out[open_] -= np.log10(256 - shut[open_])
        return out


def fit(top: DataFrame, order: int = ORDER, contexts: int = CONTEXTS) -> Trie:
    """The trie of the frequent contexts of ``top(gram, n)``. What reaches the driver
    is bounded: contexts with at least one in ``contexts`` of all bytes, and all of
    up to ``WHOLE`` bytes."""
    least = (top.agg(F.sum("n")).first()[0] or 0) / contexts
    keys, counts = [], []
    for k in range(order, -1, -1):
        bits = (1 << (8 * (k + 1))) - 1
        level = top.groupBy(F.col("gram").bitwiseAND(F.lit(bits)).alias("gram")).agg(F.sum("n").alias("n"))
        if k > WHOLE:
            context = F.shiftright("gram", 8)
            kept = level.groupBy(context.alias("context")).agg(F.sum("n").alias("total")).where(F.col("total") >= least)
            level = level.withColumn("context", context).join(kept, "context")
        found = level.select("gram", "n").toArrow()
        keys.append(found["gram"].to_numpy() | k << 56)
        counts.append(found["n"].to_numpy())
    return Trie(np.concatenate(keys), np.concatenate(counts), order)


def decide(top: DataFrame, asked: DataFrame, model, order: int = ORDER) -> DataFrame:
    """(row, p): parts of the sum, over ``asked(row, gram, k)``, of k times log10 of the gram's
    probability by all counts of ``top(gram, n)``. Grams whose contexts end in the same bytes
    meet in one task, and with the broadcast ``model`` of shorter contexts that is all a gram
    needs. Of an ending the counts come first, so that what is asked is not held."""

    def learned(gram: np.ndarray, n: np.ndarray) -> Trie:
        keys = [x["gram"] | k << 56 for k, x in enumerate(model.value.levels[: WHOLE + 1])]
        counts = [x["n"] for x in model.value.levels[: WHOLE + 1]]
        for k in range(WHOLE + 1, order + 1):
            unique, back = np.unique(gram & ((1 << (8 * (k + 1))) - 1), return_inverse=True)
            keys.append(unique | k << 56)
            counts.append(np.bincount(back, weights=n, minlength=len(unique)).astype(np.int64))
        return Trie(np.concatenate(keys), np.concatenate(counts), order)

    def solved(trie: Trie, part: list[np.ndarray]) -> pa.RecordBatch:
        _, gram, n, row = part
        rows, back = np.unique(row, return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.bincount(back, weights=-n * trie.log10(gram), minlength=len(rows)))], names=["row", "p"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        rows, last, trie, of = 0, 0, None, None  # the trie of the ending that goes on, if its counts have all come
        for batch in chain(batches, [None]):
            if batch is not None:
                parts.append([batch.column(x).to_numpy() for x in ("ending", "gram", "n", "row")])
                rows += batch.num_rows
            if not parts or (rows < TABLE_ROWS and batch is not None):
                continue
            held = [np.concatenate(x) for x in zip(*parts, strict=True)]
            if trie is not None:
                upto = np.searchsorted(held[0], of, "right")
                if upto:
                    yield solved(trie, [x[:upto] for x in held])
                held = [x[upto:] for x in held]
            if len(held[0]):  # else all of it was of the ending that goes on
                trie, of = None, held[0][-1]
                last = len(held[0]) if batch is None else np.searchsorted(held[0], of)
                if not last and held[2][-1] < 0:  # one ending, whose counts have all come
                    trie, last = learned(held[1][held[2] > 0], held[2][held[2] > 0]), len(held[0])
                if last:
                    asks, head = held[2][:last] < 0, [x[:last] for x in held]
                    if asks.any():
                        yield solved(trie or learned(head[1][~asks], head[2][~asks]), [x[asks] for x in head])
                    held = [x[last:] for x in held]
            parts, rows = [held], len(held[0]) if last else 0

    # counts are positive, those of what is asked negative
    both = top.select("gram", "n", F.lit(0).cast("long").alias("row")).unionByName(asked.select("gram", (-F.col("k")).cast("long").alias("n"), "row"))
    ending = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << (8 * (WHOLE + 1))) - 1))
    both = both.repartition(ending).withColumn("ending", ending).sortWithinPartitions("ending", F.desc("n"))
    return both.mapInArrow(run, "row long, p double")


def per_row(keys: np.ndarray, owner: np.ndarray, rows: int) -> tuple[list, list]:
    """The distinct keys of each row, and how often the row has each."""
    by = np.lexsort((keys, owner))
    keys, owner = keys[by], owner[by]
    first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]))) if len(keys) else np.zeros(0, int)
    times = np.diff(np.append(first, len(keys))).astype(np.int32)
    at = np.searchsorted(owner[first], np.arange(1, rows))
    return np.split(keys[first], at), np.split(times, at)


def score(docs: DataFrame, training: F.Column, order: int = ORDER, contexts: int = CONTEXTS) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: the counts, the base score and the score."""
    docs = docs.select("doc_id", "text", (~training).alias("held_out"))
    learned = docs.where(~F.col("held_out"))
    words = cut(count_words(learned))
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = F.col("c") >= max(1, n / FREQUENT)
    heavy = {bytes(w): float(np.log10(c + 0.5)) for w, c in zip(*words.where(frequent).toArrow().to_pydict().values(), strict=True)}
    context = docs.sparkSession.sparkContext
    top = cut(count_grams(learned, order))
    model, common = context.broadcast(fit(top, order, contexts)), context.broadcast(heavy)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, trie = common.value, model.value
        for batch in batches:
            for i in range(0, len(batch), 500):
                part = batch.iloc[i : i + 500]
                texts = part["text"].tolist()
                keys, sizes = grams_of(texts, order)
                logs, others = trie.frequent(keys)
                sums = np.add.reduceat(logs, np.cumsum(sizes) - sizes)
                grams, often = per_row(keys[others], np.repeat(np.arange(len(sizes)), sizes)[others], len(sizes))
                rows = []
                for text in texts:
                    found = Counter(words_of(text))
                    found[END] += 1
                    base, hits, total, rare, times = 0.0, 0, 0, [], []
                    for word, k in found.items():
                        total += k
                        logged = known.get(word)
                        if logged is None:
                            rare.append(word)
                            times.append(k)
                        else:
                            base += k * logged
                            hits += k
                    rows.append((total, hits, base, rare, times))
                out = pd.DataFrame(rows, columns=["n_tokens", "hits", "base", "rare", "times"])
                yield out.assign(doc_id=part["doc_id"].array, held_out=part["held_out"].array, score=sums, grams=grams, often=often)

    schema = "doc_id long, held_out boolean, n_tokens long, hits long, base double, score double, rare array<binary>, times array<int>, grams array<long>, often array<int>"
    scored = docs.mapInPandas(run, schema).withColumn("row", F.monotonically_increasing_id())
    scored = snapshot(scored, f"{shared_folder(docs.sparkSession)}/scored")  # by columns and compressed; read three times
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("k"))
    logged = F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5)) * F.col("k")
    others = rare.join(words.where(~frequent), "word", "left").groupBy("row").agg(F.sum(logged).alias("more"), F.sum(F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0)).alias("found"))
    asked = scored.select("row", F.explode(F.arrays_zip("grams", "often")).alias("x")).select("row", F.col("x.grams").alias("gram"), F.col("x.often").alias("k"))
    escaped = decide(top, asked, model, order).groupBy("row").agg(F.sum("p").alias("rest"))
    norm = float(np.log10(n + 0.5 * (v + 1)))
    return scored.drop("rare", "times", "grams", "often").join(others, "row", "left").join(escaped, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("hits") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)).alias("base_score"), (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"),
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) != 1)
