"""What the corpus operators share: reading, cutting lineage, neighbours in a
global order, running totals and connected components, all without a global
sort, a single-partition window over the data, or a driver-side collect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.sources.tables import cut, shared_folder

__all__ = ["cut", "shared_folder"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch where whole texts go to Python: a few MB, not tens.
TEXT_ROWS = 1000


def bounded_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """For queries, not operators: bound the Arrow batches of the session to ``rows`` rows, for
    each task holds a batch of texts several times. A smaller bound of the user's stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to be none of ``df``'s columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(column: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a null id counts as 0."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % F.lit(modulus), F.lit(0))


def ordered_buckets(df: DataFrame, key: str, tie: str, rows_per_bucket: int, ranges: int = 64) -> Column:
    """The number of a row's bucket: buckets follow the order of (key, tie), rows
    without a key come first, and a bucket holds about ``rows_per_bucket`` rows.

    Keys are cut into ``ranges`` by approximate quantiles, and each range evenly by its
    own ends, so an outlying key widens the buckets of its own range alone; a key that
    holds a range of its own is cut by ``tie``, an evenly spread hash. At most
    2 * ``ranges`` + 2 rows of statistics reach the driver."""
    k = F.col(key).cast("long")
    found = df.agg(F.percentile_approx(k, [i / ranges for i in range(ranges)], 10 * ranges)).first()[0] or []
    edges = sorted(set(found) | {x + 1 for x in found if found.count(x) > 1 and x < 2**63 - 1})

    def number(low: int, high: int) -> Column:  # how many edges are up to the key, by halves
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(k < F.lit(edges[middle]).cast("long"), number(low, middle)).otherwise(number(middle + 1, high))

    rank = F.when(k.isNull(), F.lit(-1)).otherwise(number(0, len(edges)))
    stats = {r["r"]: r for r in df.groupBy(rank.alias("r")).agg(F.count(F.lit(1)).alias("n"), F.min(k).alias("lo"), F.max(k).alias("hi")).collect()}
    first, cells = 0, []
    for r in range(-1, len(edges) + 1):
        n, lo, hi = (stats[r]["n"], stats[r]["lo"], stats[r]["hi"]) if r in stats else (0, None, None)
        count = -(-n // rows_per_bucket)
        cells.append((first, max(count, 1), float(lo or 0), float(hi - lo + 1) if n and lo is not None and hi > lo else 0.0))
        first += count
    at = lambda i, kind: F.element_at(F.lit([c[i] for c in cells]).cast(f"array<{kind}>"), rank + F.lit(2))
    evenly = F.col(tie).cast("double") / F.lit(2.0**64) + F.lit(0.5)
    share = F.when(at(3, "double") > 0, (k.cast("double") - at(2, "double")) / at(3, "double")).otherwise(evenly)
    inside = F.least(F.floor(share * at(1, "long")).cast("long"), at(1, "long") - 1)
    # never null, and known not to be, so that no filter of nulls tells one use of it from another
    return F.coalesce(at(0, "long") + F.greatest(F.coalesce(inside, F.lit(0)), F.lit(0)), F.lit(0).cast("long"))


def bases(sums: DataFrame, group: str, bucket: str, value: str, fan: int = 1024) -> DataFrame:
    """Add ``base``: the sum of ``value`` over the lower buckets of the group.

    Two levels, so that no window holds more than ``fan`` buckets or one row
    per ``fan`` buckets: the buckets of one group need not meet in one task.
    """
    rows = sums.withColumn("_super", F.floor(F.col(bucket) / F.lit(fan)))

    inner = F.coalesce(F.sum(value).over(Window.partitionBy(group, "_super").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    supers = rows.groupBy(group, "_super").agg(F.sum(value).alias("_sum"))
    supers = supers.select(
        F.col(group).alias("_g"), F.col("_super").alias("_s"),
        F.coalesce(F.sum("_sum").over(Window.partitionBy(group).orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )

    return (
        rows.withColumn("_inner", inner)
        .join(supers, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_super") == F.col("_s")))
        .withColumn("base", F.col("_inner") + F.col("_before"))
        .drop("_super", "_inner", "_g", "_s", "_before")
    )


#: A key of over one in HOT rows is hot, and there are at most HOT such keys; joins of
#: fewer than HOT_ROWS rows need no care.
HOT, HOT_ROWS = 1000, 200_000


def join_hot(rows: DataFrame, keyed: DataFrame, on: list[str], n: str) -> DataFrame:
    """``rows`` joined with ``keyed``, which holds each key once and in ``n`` how many of the
    rows have it. Rows of hot keys stay where they are: what belongs to those keys, at
    most HOT rows, is broadcast; all others are joined as usual."""
    total = keyed.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) > total / HOT
    if total < HOT_ROWS or keyed.where(hot).isEmpty():
        return rows.join(keyed, on)
    few = F.broadcast(keyed.where(hot))
    return rows.join(few, on).unionByName(rows.join(few.select(*on), on, "left_anti").join(keyed.where(~hot), on))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row (node, component) for
    each node that has an edge; ``component`` is the smallest node reached.

    Alternating large-star and small-star steps (Kiveris et al., 2014). A hub only ever
    meets an aggregated minimum, and its edges are not brought together for that. Each
    round is materialised in the shared checkpoint folder. Raises an error if ``rounds``
    are not enough.
    """
    one = cut(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    size = one.count()
    seen = None
    for _ in range(rounds):
        # large star: link every larger neighbour of u, and u itself, to the smallest of the neighbourhood
        both = one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = lowest(both, size)
        star = join_hot(both, low, ["u"], "n") if size >= HOT_ROWS else both.join(low, "u")
        large = star.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: link every smaller neighbour of u, and u itself, to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        one = cut(small)
        size, *state = one.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if (size, state) == seen:
            break
        seen = (size, state)
    else:
        raise RuntimeError(f"components have not converged in {rounds} rounds")
    return one.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionByName(one.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def lowest(both: DataFrame, size: int) -> DataFrame:
    """(u, m, n): the smallest of each node and its neighbours, and how many those are."""
    low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return cut(low) if size >= HOT_ROWS else low
