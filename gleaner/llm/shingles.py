"""SimHash near-dedup whose links are decided by the exact likeness of shingle sets.

Two texts are linked if the sets of their five-word shingles have a Jaccard likeness of
0.8 or more, and one document of each group of linked texts stays, the first by id.

Candidates share a key. Fifteen keys are those of the covering tables over the 64-bit
SimHash fingerprint (``simhash``), which miss no pair within three bits. At a likeness
of 0.8 fingerprints differ by 9 bits in the middle and by 14 and more in every tenth
pair, and covering tables for 14 bits would be 32,767 a document; so every set has
``BANDS`` keys more, each of ``ROWS`` minima of hashes of its shingles, and two sets of
likeness j share none of those with probability (1 - j**ROWS)**BANDS, 3e-6 at 0.8.
Every candidate is then decided by the two sets themselves.

Texts with one set of shingles are folded before the search. Every member of a bucket is
first compared with the bucket's first document, and what that links is one component;
only buckets that still hold several components are looked at again: the small ones pair
by pair, large ones in blocks of at most ``BLOCK`` documents, where documents that are
connected already are not compared. Only a spanning set of links leaves a task.

Defined cases: texts without a word are copies of each other; fewer words than a
shingle give the whole sequence as the one shingle; rows without an id come last;
rows that repeat an id are documents of their own; of rows that repeat both id and
text one stays; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import components, cut, fresh_name
from gleaner.llm.simhash import covering_masks, majority, shingle_hashes

SHINGLE = 5
BANDS, ROWS = 24, 4
#: A likeness of NEAR / (NEAR + 1) and more makes near copies: 0.8.
NEAR = 4
#: Buckets of up to SMALL documents are compared by joins; documents of a block of larger ones.
SMALL, BLOCK = 4, 500
LAST = (1 << 63) - 1
TEXTS = 500

_random = np.random.default_rng(11)
FACTORS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
MIX = _random.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MASKS = np.array(covering_masks(), np.uint64)
TABLE = _random.integers(0, 1 << 63, len(MASKS), dtype=np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingle_hashes(text, SHINGLE))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 1024):
        np.minimum(low, (hashes[i : i + 1024, None] * FACTORS + OFFSETS).min(axis=0), out=low)
    low ^= low >> np.uint64(29)
    bands = (low.reshape(BANDS, ROWS) * MIX).sum(axis=1, dtype=np.uint64)
    covering = ((majority(hashes) & MASKS) + TABLE) * FACTORS[: len(MASKS)]
    return np.append(bands, covering).view(np.int64)


def row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with 128 bits of the text, which with the id tell rows apart."""
    return docs.withColumns({"_k1": F.xxhash64(F.lit(1), "text"), "_k2": F.xxhash64(F.lit(2), "text")})


def signatures(docs: DataFrame) -> DataFrame:
    """Per row its key, the digest of its set of shingles, the set's size and bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for lo in range(0, len(whole), TEXTS):
                batch = whole.iloc[lo : lo + TEXTS]
                sets = [shingle_set(t) for t in batch["text"]]
                digests = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
                out = batch[["o", "id", "_k1", "_k2"]].assign(s1=digests[:, 0], s2=digests[:, 1], n=[len(s) for s in sets])
                yield out.assign(bands=[band_keys(s) for s in sets])

    # no null in the id: pandas would make floats of the column
    rows = row_key(docs.select(F.col("doc_id").isNull().alias("o"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), "text"))
    found = rows.mapInPandas(run, "o boolean, id long, _k1 long, _k2 long, s1 long, s2 long, n int, bands array<long>")
    return found.withColumn("doc_id", F.when(~F.col("o"), F.col("id"))).drop("o", "id")


def near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of ``pairs(lo, hi)`` those whose sets of ``sets(e, hashes)`` are near copies."""
    both = pairs.join(sets.select(F.col("e").alias("hi"), F.col("hashes").alias("_a")), "hi").join(sets.select(F.col("e").alias("lo"), F.col("hashes").alias("_b")), "lo")
    shared = F.size(F.array_intersect("_a", "_b"))
    return both.where(shared * (2 * NEAR + 1) >= (F.size("_a") + F.size("_b")) * NEAR).select("lo", "hi")


def like_size(n: str, m: str) -> F.Column:
    """Sets of other sizes cannot be near copies."""
    return (F.col(n) * (NEAR + 1) >= F.col(m) * NEAR) & (F.col(m) * (NEAR + 1) >= F.col(n) * NEAR)


#: Names that ``keep_one`` gives to columns of its own.
OWN = {"_k1", "_k2", "_doc", "_a", "_b", "_row"}


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near copies, the first by id. Columns of OWN's names are set aside meanwhile."""
    if clash := OWN & {c.lower() for c in docs.columns}:
        aside = {c: fresh_name(docs, f"{c}_aside") for c in docs.columns if c.lower() in clash}
        return keep_one(docs.withColumnsRenamed(aside)).withColumnsRenamed({v: k for k, v in aside.items()})
    rows = cut(signatures(docs))
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("o"), "doc_id", "_k1", "_k2")).alias("low")
    folded = rows.groupBy("s1", "s2").agg(first, F.any_value("n").alias("n"), F.any_value("bands").alias("bands"))
    ents = cut(folded.select("low", F.monotonically_increasing_id().alias("e"), "n", "bands"))
    named = ents.select("low", "e")
    found = components(links(docs, named.select("low.*", "e"), ents.select("e", "n", F.explode("bands").alias("b"))))
    grouped = named.join(found, F.col("e") == F.col("node"), "left").groupBy(F.coalesce("component", "e").alias("c")).agg(F.min("low").alias("low"))
    kept = grouped.select(F.col("low.doc_id").alias("_doc"), F.col("low._k1").alias("_a"), F.col("low._k2").alias("_b"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_k1") == F.col("_a")) & (F.col("_k2") == F.col("_b"))
    found = row_key(docs).join(kept, same, "left_semi")
    many = cut(rows.groupBy("doc_id", "_k1", "_k2").count().where("count > 1").select(F.col("doc_id").alias("_doc"), F.col("_k1").alias("_a"), F.col("_k2").alias("_b")))
    if many.isEmpty():
        return found.select(docs.columns)
    one = found.join(many, same, "left_semi").groupBy("doc_id", "_k1", "_k2").agg(F.any_value(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return found.join(many, same, "left_anti").select(docs.columns).unionByName(one)


def sets_of(docs: DataFrame, named: DataFrame) -> DataFrame:
    """(e, hashes): the sets of the documents ``named(e, doc_id, _k1, _k2)``."""

    @F.pandas_udf("array<long>")
    def hashes(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t).view(np.int64) for t in texts])

    wanted = named.select("e", F.col("doc_id").alias("_doc"), F.col("_k1").alias("_a"), F.col("_k2").alias("_b"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_k1") == F.col("_a")) & (F.col("_k2") == F.col("_b"))
    texts = row_key(docs.select("doc_id", "text")).join(wanted, same).select("e", "text")
    return texts.select("e", hashes("text").alias("hashes")).dropDuplicates(["e"])


def links(docs: DataFrame, named: DataFrame, keys: DataFrame) -> DataFrame:
    """(a, b): links that connect all near copies that share one of ``keys(e, n, b)``,
    where n is the size of a set."""
    heads = keys.groupBy("b").agg(F.min(F.struct("e", "n")).alias("low"), F.count(F.lit(1)).alias("k")).where("k > 1")
    members = cut(keys.join(heads, "b"))
    sets = cut(sets_of(docs, members.select("e").distinct().join(named, "e")))
    star = members.where((F.col("low.e") != F.col("e")) & like_size("n", "low.n")).select(F.col("low.e").alias("lo"), F.col("e").alias("hi")).distinct()
    star = cut(near(star, sets))
    # what is left: buckets of three and more, in which several components are; of those that hold the same documents one
    known = components(star.select(F.col("lo").alias("a"), F.col("hi").alias("b")))
    tagged = members.where("k > 2").select("b", "e", "n").join(known, F.col("e") == F.col("node"), "left").select("b", "e", "n", F.coalesce("component", "e").alias("c"))
    left = tagged.groupBy("b").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("e")).alias("h")).where("c0 < c1")
    left = left.groupBy("k", "h").agg(F.min("b").alias("b"))
    rest = cut(tagged.join(left.select("b", "k"), "b"))
    x, y = rest.where(F.col("k") <= SMALL), rest.where(F.col("k") <= SMALL).select("b", F.col("e").alias("lo"), F.col("n").alias("m"), F.col("c").alias("d"))
    pairs = x.withColumnRenamed("e", "hi").join(y, "b").where((F.col("lo") < F.col("hi")) & (F.col("c") != F.col("d")) & like_size("n", "m")).select("lo", "hi").distinct()
    found = star.unionByName(near(pairs, sets)).select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    return found.unionByName(block_links(rest.where(F.col("k") > SMALL), sets))


def block_links(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links between documents of one bucket in ``rest(b, e, c, k)``, of different
    components c before; each pair of the bucket's blocks is one unit of work."""
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    placed = rest.withColumn("x", F.pmod(F.xxhash64("e"), blocks).cast("int")).withColumn("y", F.explode(F.sequence(F.lit(0), blocks - 1)))
    side = F.when(F.col("x") == F.col("y"), 2).when(F.col("x") < F.col("y"), 0).otherwise(1)
    units = placed.select("b", F.least("x", "y").alias("p"), F.greatest("x", "y").alias("q"), side.alias("side"), "e", "c").join(sets, "e")

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = spanning(frame["side"].to_numpy(), frame["c"].to_numpy(np.int64), frame["hashes"].tolist())
        e = frame["e"].to_numpy(np.int64)
        return pd.DataFrame({"a": e[i], "b": e[j]})

    return units.groupBy("b", "p", "q").applyInPandas(work, "a long, b long")


def spanning(side: np.ndarray, component: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows i, j of linked sets that connect all linked components. Side 0 is compared with
    side 1, side 2 within itself."""
    sizes = np.array([len(x) for x in sets], np.int64)
    unique, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    held = np.zeros(len(unique), bool)
    component, a, b = component.copy(), [], []
    for i in np.flatnonzero(side != 1):
        other = (component != component[i]) & (side != 0) & (sizes * (NEAR + 1) >= sizes[i] * NEAR) & (sizes[i] * (NEAR + 1) >= sizes * NEAR)
        if side[i] == 2:
            other[: i + 1] = False
        at = np.flatnonzero(other)
        if not len(at):
            continue
        own = flat[ends[i] - sizes[i] : ends[i]]
        held[own] = True
        within = np.repeat(ends[at] - np.cumsum(sizes[at]), sizes[at]) + np.arange(sizes[at].sum())
        total = np.append(0, np.cumsum(held[flat[within]]))
        stop = np.cumsum(sizes[at])
        shared = total[stop] - total[stop - sizes[at]]
        for j in at[shared * (2 * NEAR + 1) >= (sizes[i] + sizes[at]) * NEAR].tolist():
            if component[j] != component[i]:
                a.append(i)
                b.append(j)
                component[component == component[j]] = component[i]
        held[own] = False
    return np.array(a, int), np.array(b, int)
