"""Names looked for by parts of them, many at once: an inverted index of character grams.

Every name stands under each distinct run of each of ``SIZES`` characters that it holds and that a text asks for, so
that a text of any length has a gram to look under. A wanted text looks under the rarest of the longest
grams that it has; the names found there are candidates, and ``contains`` decides. So a text is
compared with the names that share its rarest gram, not with all names, and the join is an equi-join on
grams. Wildcards of the text split it: only runs between them have grams, and ILIKE decides.
Joins are by merging, for each side grows with the data: none is broadcast through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import scalars as X
from gleaner.sources.tables import cut

SIZES, SALTS = (1, 2, 3, 5, 8), 64


def grams(text: Column, size: int) -> Column:
    """The distinct runs of ``size`` characters; null for a null or shorter text."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(starts, lambda k: F.substring(text, k, F.lit(size)))))


def name_index(names: DataFrame) -> DataFrame:
    """(gram, name) of ``names(name)``: each distinct name in lower case under its runs of each of SIZES characters."""
    low = names.where(F.col("name").isNotNull()).select(F.lower("name").alias("name")).distinct()
    every = F.flatten(F.array(*[F.coalesce(grams(F.col("name"), k), F.array().cast("array<string>")) for k in SIZES]))
    return low.select("name", F.explode(every).alias("gram"))


def text_grams(text: Column) -> Column:
    """The grams to look under: of each run between wildcards those of the longest of SIZES that fits in it."""
    runs = F.filter(F.split(text, "[%_]"), lambda r: r != "")
    return F.flatten(F.transform(runs, lambda r: F.coalesce(*[grams(r, k) for k in reversed(SIZES)])))


def like(text: Column, around: str = "") -> Column:
    """A text as a pattern of LIKE: its wildcards count, a backslash stands for itself."""
    return F.concat(F.lit(around), F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(around))


def holding(names: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text, name) for ``names(name)`` and ``wanted(text)``: each distinct name, in lower case, that holds
    the distinct text, without regard to case; wildcards of LIKE count. Texts of wildcards alone have no gram and are
    held against all names, dealt by ``SALTS``. Null and empty texts are held by nothing."""
    texts = wanted.where(F.col("text") != "").select("text").distinct().withColumn("_low", F.lower("text"))
    fits = F.when(F.col("text").rlike("[%_]"), F.like(F.col("name"), like(F.col("_low"), "%"))).otherwise(F.contains("name", "_low"))
    asked = cut(texts.select("text", "_low", F.explode(text_grams(F.col("_low"))).alias("gram")))
    index = cut(name_index(names).join(asked.select("gram").distinct().hint("merge"), "gram", "left_semi"))
    sizes = index.groupBy("gram").agg(F.count(F.lit(1)).alias("_n"))
    # a left join, for a gram that no name has is the rarest there can be: nothing holds the text
    under = asked.join(sizes.hint("merge"), "gram", "left")
    rarest = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "gram")).alias("x")
    probes = under.groupBy("text", "_low").agg(rarest).where("x.n > 0").select("text", "_low", "x.gram")
    found = probes.join(index.hint("merge"), "gram").where(fits).select("text", "name")
    loose = texts.where(F.col("text").rlike("^[%_]+$")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = names.where(F.col("name").isNotNull()).select(F.lower("name").alias("name")).distinct().withColumn("_salt", F.pmod(F.hash("name"), F.lit(SALTS)))
    return found.unionByName(loose.join(salted.hint("merge"), "_salt").where(fits).select("text", "name"))


def resolve_many(venues: DataFrame, wanted: DataFrame) -> DataFrame:
    """P10 for ``wanted(wanted, site)`` over ``venues(id, name, site)``: (wanted, site, id, tier), one row
    for each distinct wanted text and site that is found.

    Tiers: 0, digits are an id, of any site; 1, the whole name without regard to case; 2, a part of the
    name. The first tier that fits counts, the smallest id of it; names are looked for in
    ``site`` alone, if it is given. Wildcards of LIKE count. Null and blank texts,
    and digits that are no id, however many, find nothing; a null name is never found."""
    rows = cut(wanted.select("wanted", "site").distinct().withColumn("_v", X.strip(F.col("wanted"))).where(F.col("_v") != ""))
    digits = F.col("_v").rlike("^[0-9]+$")
    ids = rows.where(digits).join(venues.select("id").distinct().hint("merge"), F.col("_v").try_cast("long") == F.col("id")).select("wanted", "site", "id", F.lit(0).alias("tier"))
    named = rows.where(~digits).withColumn("_low", F.lower("_v"))
    at = venues.where(F.col("name").isNotNull()).select("id", "site", F.lower("name").alias("name"))
    none = F.lit(None).cast(at.schema["site"].dataType)
    owners = at.where(F.col("site").isNotNull()).groupBy("name", "site").agg(F.min("id").alias("id"))
    owners = owners.unionByName(at.groupBy("name").agg(F.min("id").alias("id")).withColumn("site", none))  # a null site: all sites
    own = owners.select(F.col("name").alias("_name"), F.col("site").alias("_site"), "id")
    scoped = F.col("site").eqNullSafe(F.col("_site"))
    whole = named.where(~F.col("_low").rlike("[%_]")).join(own.hint("merge"), (F.col("_low") == F.col("_name")) & scoped).select("wanted", "site", "id", F.lit(1).alias("tier"))
    done = whole.select(F.col("wanted").alias("_w"), F.col("site").alias("_s"))
    left = named.join(done.hint("merge"), (F.col("wanted") == F.col("_w")) & F.col("site").eqNullSafe(F.col("_s")), "left_anti")
    left = cut(left)
    parts = holding(at.select("name"), left.select(F.col("_low").alias("text")))
    tier = F.when(F.like(F.col("name"), like(F.col("text"))), 1).otherwise(2)
    # of each text and site, or of all sites, the best is taken before the wanted rows meet it
    best = parts.join(own.hint("merge"), F.col("name") == F.col("_name")).groupBy("text", "_site").agg(F.min(F.struct(tier.alias("tier"), "id")).alias("x"))
    pairs = left.join(best.hint("merge"), (F.col("_low") == F.col("text")) & scoped).select("wanted", "site", "x.id", "x.tier")
    found = ids.unionByName(whole).unionByName(pairs)
    return found.groupBy("wanted", "site").agg(F.min(F.struct("tier", "id")).alias("x")).select("wanted", "site", "x.id", "x.tier")
