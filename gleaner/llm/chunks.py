"""Substring dedup by content-defined chunking with a gear rolling hash.

A gear hash at a position sums one table value per preceding code point, each
doubled once per step, so that its low ``BITS`` bits depend on the last ``BITS``
code points alone. A chunk ends where the masked bits are zero: cut points follow
the content, and an insertion shifts none but the chunks it touches. Chunks are
compared by a 128-bit digest over the whole table. A run of chunks that other
documents (or earlier places of the same one) already hold is removed when it is
at least ``MIN_RUN`` code points long; the document with the smallest id keeps it.

Only digests and numbers are shuffled to find repeats; frequent digests are summed
before the shuffle, and the chunks of those that hold over one in ``HOT`` of all shared
chunks (at most so many, hence broadcast) are dealt to ``SALTS`` tasks, not to one. Texts
move once, to be cut.

Defined cases: a null text stays null and has no chunks; an empty text stays empty;
a row without an id never owns a passage that a row with an id holds; each is a document of its own, as is each row that repeats an id (such rows, and
only they, are written to the shared folder to number them); a text of any length is cut whole; no rows give no
rows; other columns pass through ``remove_repeats`` untouched.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import bounded_batches, cut, fresh_name, shared_folder, table

#: Code points that decide a cut, and the bits of the hash that must be zero there:
#: a chunk has 2**MASK_BITS code points on average beyond the smallest.
BITS, MASK_BITS = 16, 5
MIN_CHUNK, MAX_CHUNK = 16, 256
#: Code points; shorter repeats are common phrases, not copied passages.
MIN_RUN = 100
#: Digests of over one in HOT of all shared chunks, and of over HOT_ROWS, are dealt by salts.
HOT, HOT_ROWS, SALTS = 1000, 1000, 64


def gear_table(size: int = 4096) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << BITS, size, dtype=np.uint16)


GEAR = gear_table()


def gear_hash(points: np.ndarray) -> np.ndarray:
    """The rolling hash after each code point, by doubling the window four times."""
    h = GEAR[points & (len(GEAR) - 1)]
    step = 1
    while step < BITS:
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint16(step)
        h = longer
        step *= 2
    return h


def ends_of(points: np.ndarray) -> list[int]:
    """Ends of the chunks, the last at the text's end."""
    n = len(points)
    found = (np.flatnonzero(gear_hash(points) >> np.uint16(BITS - MASK_BITS) == 0) + 1).tolist() if n else []
    out, at = [], 0
    for end in [*found, n]:
        if end - at < MIN_CHUNK and end < n:
            continue
        while end - at > MAX_CHUNK:
            at += MAX_CHUNK
            out.append(at)
        if end > at:
            out.append(end)
            at = end
    return out


def chunk_rows(docs: DataFrame, nth: bool = False) -> DataFrame:
    """(doc_id, start, size, d1, d2, again): a row per chunk; ``again`` marks a
    chunk that the same text holds before; and ``_nth`` if asked for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 200):
                part = batch.iloc[lo : lo + 200]
                ids, numbers, starts, sizes, digests, again = [], [], [], [], [], []
                for doc, number, text in zip(part["doc_id"].array, part["_nth"] if nth else [0] * len(part), part["text"], strict=True):
                    if not text:
                        continue
                    raw = text.encode("utf-32-le", "surrogatepass")
                    at, seen = 0, set()
                    ends = ends_of(np.frombuffer(raw, np.uint32))
                    for end in ends:
                        digest = hashlib.blake2b(raw[4 * at : 4 * end], digest_size=16).digest()
                        starts.append(at)
                        sizes.append(end - at)
                        digests.append(digest)
                        again.append(digest in seen)
                        seen.add(digest)
                        at = end
                    ids += [None if pd.isna(doc) else int(doc)] * len(ends)
                    numbers += [number] * len(ends)
                words = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                out = pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "start": np.array(starts, np.int32), "size": np.array(sizes, np.int32), "d1": words[:, 0], "d2": words[:, 1], "again": np.array(again, bool)})
                yield out.assign(_nth=np.array(numbers, np.int64)) if nth else out

    schema = "doc_id long, start int, size int, d1 long, d2 long, again boolean" + ", _nth long" * nth
    return docs.select("doc_id", "text", *["_nth"] * nth).mapInPandas(run, schema)


LAST = (1 << 63) - 1


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_nth``: with the id it tells rows apart. It is a constant 0 if all
    ids are there once; else only the other rows are numbered, from 1."""
    ids = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_id"))
    if ids.isEmpty():
        return docs.withColumn("_nth", F.lit(0).cast("long"))
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    path = f"{shared_folder(docs.sparkSession)}/numbered-{uuid.uuid4().hex}"
    docs.join(ids, same, "left_semi").withColumn("_nth", F.monotonically_increasing_id() + 1).write.parquet(path)
    return docs.join(ids, same, "left_anti").withColumn("_nth", F.lit(0).cast("long")).unionByName(docs.sparkSession.read.parquet(path))


def repeats(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, _nth, spans): the spans (start, size, first_doc) to take out of each
    row of ``docs``, as numbered, that has any, in order."""
    plain = F.coalesce("doc_id", F.lit(LAST))
    many = docs.where("_nth > 0").select("doc_id", "_nth", "text")
    chunks, key = chunk_rows(docs.where("_nth = 0")).withColumn("_nth", F.lit(0).cast("long")), plain
    if not many.isEmpty():
        chunks, key = chunks.unionByName(chunk_rows(many, nth=True)), F.struct(plain.alias("o"), "_nth")
    shared = chunks.groupBy("d1", "d2").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.max("again").alias("twice"), F.count(F.lit(1)).alias("n"))
    shared = cut(shared.where((F.col("first") < F.col("last")) | F.col("twice")).select("d1", "d2", "first", "n"))
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.col("n") > max(total / HOT, HOT_ROWS)
    frequent = F.broadcast(shared.where(hot).select("d1", "d2", F.lit(True).alias("hot")))  # at most HOT rows
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "_nth", "start"), F.lit(SALTS))).otherwise(0).cast("int")
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = chunks.join(frequent, ["d1", "d2"], "left").withColumn("salt", salt).drop("hot")
    held = dealt.join(shared.select("d1", "d2", "first", F.explode(salts).alias("salt")), ["d1", "d2", "salt"]).where((key > F.col("first")) | F.col("again"))
    held = held.withColumn("first_doc", F.col("first") if key is plain else F.col("first.o"))

    @F.pandas_udf("array<struct<start:int,size:int,first_doc:long>>")
    def runs(series: pd.Series) -> pd.Series:
        return pd.Series([merged(x, min_run) for x in series])

    lists = held.groupBy("doc_id", "_nth").agg(F.collect_list(F.struct("start", "size", "first_doc")).alias("all"))
    return lists.select("doc_id", "_nth", runs("all").alias("spans")).where(F.size("spans") > 0)


def merged(chunks: list[dict], min_run: int) -> list[dict]:
    """Neighbouring chunks joined to runs; the long enough ones are returned."""
    out: list[dict] = []
    for start, size, first in sorted({(c["start"], c["size"], c["first_doc"]) for c in chunks}):
        if out and start <= out[-1]["start"] + out[-1]["size"]:
            out[-1]["size"] = max(out[-1]["size"], start + size - out[-1]["start"])
        else:
            out.append({"start": start, "size": size, "first_doc": first})
    return [x for x in out if x["size"] >= min_run]


def remove_repeats(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, and ``_spans``, what was cut. A
    column of that name is kept as ``_spans_aside``."""
    if clash := {"_doc", "_row", "_nth", "_spans", "_id"} & {c.lower() for c in docs.columns}:  # set aside, put back below
        aside = {c: fresh_name(docs, f"{c}_aside") for c in docs.columns if c.lower() in clash}
        return remove_repeats(docs.withColumnsRenamed(aside), min_run).withColumnsRenamed({v: k for k, v in aside.items() if k.lower() != "_spans"})
    docs = numbered(docs)
    spans = repeats(docs, min_run).select(F.col("doc_id").alias("_doc"), F.col("_nth").alias("_row"), F.col("spans").alias("_spans"))
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_nth") == F.col("_row")), "left").drop("_doc", "_row", "_nth")
    # the kept pieces: before each span from the end of the one before, and after the last
    ends = F.concat(F.array(F.lit(0)), F.transform("_spans", lambda s: s["start"] + s["size"]))
    starts = F.concat(F.transform("_spans", lambda s: s["start"]), F.array(F.length("text")))
    kept = F.array_join(F.zip_with(ends, starts, lambda a, b: F.call_function("substring", F.col("text"), a + 1, b - a)), "")
    return joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(kept))


def without_repeats(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` with repeated passages cut out; documents of which only white space
    is left after a cut go, all others stay. ``n_chars`` is counted anew."""
    found = remove_repeats(docs, min_run)
    kept = found.where(F.col("_spans").isNull() | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    counted = F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")) if "n_chars" in docs.columns else None
    kept = kept if counted is None else kept.withColumn("n_chars", counted)
    aside = {c: f"{c}_aside" for c in docs.columns if c.lower() == "_spans"}
    return kept.drop("_spans").withColumnsRenamed({v: k for k, v in aside.items()}).select(docs.columns)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its text without passages that it shares, and what was cut."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.length("text").alias("before"))
    found = remove_repeats(docs)
    return found.select(
        "doc_id", F.col("before").cast("long").alias("n_chars"), F.length("text").cast("long").alias("kept_chars"),
        F.coalesce(F.size("_spans"), F.lit(0)).alias("n_spans"), F.transform("_spans", lambda s: s["start"].cast("long")).alias("span_starts"),
        F.transform("_spans", lambda s: s["size"].cast("long")).alias("span_sizes"), F.transform("_spans", lambda s: s["first_doc"]).alias("first_docs"), "text",
    )
