"""A3-A8 kept up to date: aggregates to which changes are added, not recounted.

A change of a table is signed rows: what is gone with -1, what is new with +1, an updated row as both. Counts, sums and counts by a
condition over signed rows are sums of products with the sign, so the aggregate of a change can be added to the
stored one; groups whose rows are all gone go. An aggregate that is not a sum, such as a least value, is kept as counts of
each value, which are sums again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = "n_rows"


def signed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The columns of both tables and ``sign``: rows by which ``new`` differs from ``old``, compared by ``key``, which each holds once. Rows that are
    equal in both, nulls included, are left out. A row without a key is gone from the old and new in the new one: the sum is right all the same."""
    columns = old.columns
    a, b = (df.select(F.col(key).alias("_key"), F.struct(*columns).alias(name)) for df, name in ((old, "_old"), (new, "_new")))
    both = a.join(b, "_key", "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    rows = F.array(F.struct(F.col("_old").alias("row"), F.lit(-1).alias("sign")), F.struct(F.col("_new").alias("row"), F.lit(1).alias("sign")))
    return both.select(F.explode(F.filter(rows, lambda x: x["row"].isNotNull())).alias("x")).select("x.row.*", "x.sign")


def totals(rows: DataFrame, by: list[str], sums: dict[str, Column], sign: str | None = None) -> DataFrame:
    """(by..., n_rows, sums...) of ``rows``, or of signed rows: how many there are of each group, and the sum of each value; a null
    value counts as 0."""
    s = F.col(sign) if sign else F.lit(1)
    return rows.groupBy(*by).agg(F.sum(s.cast("long")).alias(ROWS), *[F.sum(F.coalesce(v, F.lit(0)) * s).alias(name) for name, v in sums.items()])


def merged(stored: DataFrame, change: DataFrame, by: list[str]) -> DataFrame:
    """``stored`` totals with those of a ``change``; a group with no row left is gone. Null groups are groups."""
    values = [c for c in stored.columns if c not in by]
    together = stored.unionByName(change.select(stored.columns))
    summed = together.groupBy(*by).agg(*[F.sum(c).alias(c) for c in values])
    return summed.where(F.col(ROWS) != 0).select([F.col(c).cast(stored.schema[c].dataType).alias(c) for c in stored.columns])
