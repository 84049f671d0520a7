"""Popularity ranking, built from its specification: an item's score is the sum of
its venues' coefficients over its listings. The specification is ambiguous about
repeated listings in one venue: both readings are modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.sources.tables import cut

#: Fixed values, by distinction: three stars, two, one, bib, selected; none is 1.0.
COEFFICIENTS = {"3-stars": "1.5", "2-stars": "1.4", "1-star": "1.3", "bib-gourmand": "1.2", "selected": "1.1"}
OTHER = "1.0"


def coefficient(kind: Column, weights: dict[str, str] = COEFFICIENTS) -> Column:
    out = None
    for value, weight in weights.items():
        hit = F.lit(weight).cast("decimal(3,1)")
        out = F.when(kind == value, hit) if out is None else out.when(kind == value, hit)
    return out.otherwise(F.lit(OTHER).cast("decimal(3,1)"))


def scores(listings: DataFrame, item: str, venue: str, kind: str, weights: dict[str, str] = COEFFICIENTS, mode: str = "listings") -> DataFrame:
    """(item, score, n): ``listings`` mode counts each listing, and is summed before the
    shuffle; ``venues`` mode counts each venue of an item once."""
    rows = listings if mode == "listings" else listings.select(item, venue, kind).distinct()
    return rows.groupBy(item).agg(F.sum(coefficient(F.col(kind), weights)).cast("decimal(28,1)").alias("score"), F.count(F.lit(1)).alias("n"))


def normalised(ranked: DataFrame, low: float = 1.0, high: float = 10.0) -> DataFrame:
    """Scores on a scale from 1 to 10, beside the raw ones; one row is joined to all."""
    ends = ranked.agg(F.min("score").alias("_min"), F.max("score").alias("_max"))
    span = F.col("_max") - F.col("_min")
    scaled = F.when(span > 0, low + (high - low) * (F.col("score") - F.col("_min")).cast("double") / span.cast("double")).otherwise(high)
    return ranked.crossJoin(F.broadcast(ends)).withColumn("rank_1_10", scaled).drop("_min", "_max")


def places(ranked: DataFrame, item: str) -> DataFrame:
    """D2r: (item, score, place, dense, share_below, percent_rank) of every item of ``ranked(item, score)``: its place among all, the
    highest score first, ties sharing one; the same without gaps; the share of the others that score less; and
    (place - 1) / (items - 1). Where there is one item alone both shares are 0. A null score comes last.

    Scores are counted, and the distinct ones dealt by ranges into ordered parts, written down so that a part
    stays what it is. A part's items before it are a sum over the parts, one row each; inside a part a window
    counts on. So no window holds more than a part, and no score is compared with all others."""
    counted = ranked.groupBy("score").agg(F.count(F.lit(1)).alias("_n"))
    parts = cut(counted.repartitionByRange(F.desc_nulls_last("score")).withColumn("_part", F.spark_partition_id()))
    sums = parts.groupBy("_part").agg(F.sum("_n").alias("_items"), F.count(F.lit(1)).alias("_scores"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    total = F.sum("_items").over(Window.partitionBy())
    starts = sums.select("_part", *[F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"{x}_before") for x in ("_items", "_scores")], total.alias("_all"))
    inside = Window.partitionBy("_part").orderBy(F.desc_nulls_last("score")).rowsBetween(Window.unboundedPreceding, -1)
    above = F.col("_items_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    dense = F.col("_scores_before") + F.count(F.lit(1)).over(inside) + 1
    share = lambda x: F.when(F.col("_all") > 1, x / (F.col("_all") - 1)).otherwise(F.lit(0.0))
    found = parts.join(F.broadcast(starts), "_part").withColumns({"place": above + 1, "dense": dense})
    found = found.select(F.col("score").alias("_score"), "place", "dense", share(F.col("_all") - F.col("place") + 1 - F.col("_n")).alias("share_below"), share(F.col("place") - 1).alias("percent_rank"))
    return ranked.select(item, "score").join(found, F.col("score").eqNullSafe(F.col("_score"))).drop("_score")


def versus(ranked: DataFrame, pairs: DataFrame, item: str) -> DataFrame:
    """D4r: ``pairs(item, other)`` with ``verdict``: better, worse, equal, or null where one has no score."""
    a = ranked.select(F.col(item).alias("item"), F.col("score").alias("_x"))
    b = ranked.select(F.col(item).alias("other"), F.col("score").alias("_y"))
    verdict = F.when(F.col("_x") > F.col("_y"), "better").when(F.col("_x") < F.col("_y"), "worse").when(F.col("_x") == F.col("_y"), "equal")
    return pairs.join(a, "item", "left").join(b, "other", "left").select("item", "other", verdict.alias("verdict"))


def top_per(ranked: DataFrame, group: str, item: str, n: int = 10) -> DataFrame:
    """D3r, D7r: the ``n`` best of each group with their dense rank; ties by the item. The limit by
    place is known before the shuffle; the dense rank looks at what is left alone, which
    holds the best of the group, so it is the rank among all."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.col("score").desc(), F.col(item)))
    best = ranked.withColumn("place", place).where(F.col("place") <= n)
    return best.withColumn("dense", F.dense_rank().over(Window.partitionBy(group).orderBy(F.col("score").desc())))


def entity_key(name: Column) -> Column:
    """Names that differ in case, punctuation, year or the order of words are one."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(name), r"\b(19|20)\d\d\b", " "), r"[^a-z0-9]+", " ")
    return F.array_join(F.array_sort(F.filter(F.split(bare, " "), lambda w: w != "")), " ")
