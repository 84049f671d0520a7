"""SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint has 64 bits, by the majority of its word shingles' XXH64 bits. To
find every pair within ``radius`` bits, each bit position gets a vector of
``radius + 1`` bits; each non-zero vector v gives one mask, of the positions whose
vector has an odd product with v. Two fingerprints that differ in at most
``radius`` positions agree on at least one mask: that few vectors cannot span the
space, so some v has an even product with all of them (Pagh, 2016, "Locality-sensitive hashing without false negatives").

Equal fingerprints are folded to one before the search, so groups of exact copies
cost nothing. Inside a collision group, links are found by growing neighbourhoods
with vectorised Hamming distances; a group of over ``GROUP`` fingerprints is first dealt
again by covering masks over the bits in which its members can still differ, so its
cost stays near its size. Only a spanning set of links leaves the task.

Defined cases: a null, empty or blank text has fingerprint zero and links like any
other; fewer words than a shingle give the whole sequence as the one shingle;
repeated rows and repeated ids each return a row; rows without an id never give a
component its number unless no row of the component has one. Other columns are kept
by ``near_duplicates`` only if asked for; the query reads ``doc_id`` and ``text``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import bounded_batches, components, cut, join_hot, table

RADIUS = 3
SHINGLE = 3
BITS = 64
#: Fingerprints of a collision group that are compared without dealing them again.
GROUP = 4096


def shingle_hashes(text: str | None, size: int = SHINGLE, seed: int = 42) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a : b - 1], seed) for a, b in zip([0, *ends], ends[size - 1 :], strict=False)], np.uint64)


def majority(hashes: np.ndarray) -> np.uint64:
    """The bits set in over half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0]


def simhash(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    return int(majority(shingle_hashes(text, size)).view(np.int64))


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    @F.pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, size) for t in texts], dtype="int64")

    return docs.withColumn("fp", udf("text"))


def covering_masks(radius: int = RADIUS, seed: int = 1, free: int = (1 << BITS) - 1) -> list[int]:
    """2**(radius+1)-1 masks of ``free`` bits, of which any two words that differ in at most
    ``radius`` bits, all of them free, share one."""
    places = [i for i in range(BITS) if free >> i & 1]
    vectors = np.random.default_rng(seed).permutation(np.arange(len(places)) % ((1 << (radius + 1)) - 1) + 1)
    return [sum(1 << i for i, w in zip(places, vectors.tolist(), strict=True) if (w & v).bit_count() % 2 == 1) for v in range(1, 1 << (radius + 1))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def spanning_links(fps: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """A forest that connects exactly the values joined by chains of links."""
    a, b = [], []
    left = np.unique(fps).view(np.uint64)  # bitwise_count takes the absolute value of signed numbers
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                a += [signed(int(x))] * len(found)
                b += found.view(np.int64).tolist()
                front += list(found)
                left = left[~near]
    return a, b


def group_links(fps: np.ndarray, radius: int, free: int) -> tuple[list[int], list[int]]:
    """The same for many values that differ in ``free`` bits alone."""
    fps = np.unique(fps)
    if len(fps) <= GROUP or free.bit_count() <= 8:
        return spanning_links(fps, radius)
    a, b = [], []
    for mask in covering_masks(radius, free.bit_count(), free):
        key = fps.view(np.uint64) & np.uint64(mask)
        by = np.argsort(key, kind="stable")
        starts = np.append(np.flatnonzero(np.append(True, key[by][1:] != key[by][:-1])), len(by))
        for i in np.flatnonzero(np.diff(starts) > 1):
            x, y = group_links(fps[by[starts[i] : starts[i + 1]]], radius, free & ~mask)
            a += x
            b += y
    return a, b


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fps(fp)`` that connect all
    those within ``radius`` bits; no pair within the radius stays unconnected."""
    every = covering_masks(radius)
    masks = F.array(*[F.struct(F.lit(i).cast("byte").alias("t"), F.lit(signed(m)).cast("long").alias("m")) for i, m in enumerate(every)])
    keyed = fps.select("fp", F.explode(masks).alias("x")).select(F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("key"), "fp")
    keyed = keyed.repartition("t", "key").sortWithinPartitions("t", "key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, open_ = None, []  # the last group of a batch may go on in the next one
        for batch in batches:
            t, key, fp = (batch[c].to_numpy() for c in ("t", "key", "fp"))
            if not len(t):
                continue
            starts = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (key[1:] != key[:-1])))
            groups = [fp[i:j] for i, j in zip(starts, [*starts[1:], len(fp)], strict=True)]
            if (t[0], key[0]) == last:
                open_.append(groups.pop(0))
                starts = starts[1:]
            if not groups:
                continue
            ended = [(last[0], np.concatenate(open_))] if open_ else []
            yield linked(ended + [(t[i], g) for i, g in zip(starts, groups[:-1], strict=False)])
            last, open_ = (t[-1], key[-1]), [groups[-1]]
        if open_:
            yield linked([(last[0], np.concatenate(open_))])

    def linked(groups: list[tuple]) -> pd.DataFrame:
        a, b = [], []
        for t, group in groups:
            if len(group) > 1:
                x, y = group_links(group, radius, ~every[t] & ((1 << BITS) - 1))
                a += x
                b += y
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return keyed.mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs(doc_id, text)``."""
    signatures = cut(fingerprints(docs.select("doc_id", "text"), size).select("doc_id", "fp"))
    distinct = cut(signatures.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")))
    found = components(links(distinct.select("fp"), radius))
    grouped = distinct.join(found, F.col("fp") == F.col("node"), "left").select("fp", "low", "n", F.coalesce("component", "fp").alias("component"))
    lowest = grouped.groupBy("component").agg(F.min("low").alias("component_id"))
    numbered = cut(grouped.join(lowest, "component").select("fp", "n", "component_id"))
    return join_hot(signatures, numbered, ["fp"], "n").select("doc_id", "fp", "component_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
