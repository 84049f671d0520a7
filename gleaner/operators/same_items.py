"""D8r: the same item under different names: a weighted set-similarity join with prefix
filtering, and the groups that its links form.

A name is its set of words, without case, punctuation and years; a word weighs the more the fewer names have
it. Two names are alike if the weight of their common words is at least ``share`` of the weight of all
their words. Names of equal sets are one, with a count. Words of a set are put in one order for all, the rarest
first; of a set W only the beginning is looked under, up to the word after which the rest weighs less
than share * W: two alike sets share a word of both beginnings. So sets meet under the rarest word that they may have in common.
Where over ``MANY`` sets are under one word, they are parted by the next word that may be common, and so on, as long as that
at least halves the pairs that meet; a set of which a beginning is all that may be common is also under that, ``ended``.
A pair has its common words once, in one order, and counts under their beginning alone. Sets meet in an equi-join on (beginning, band),
where a set's band is the logarithm of its weight: alike sets are in the same or in neighbouring bands.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.ranking import entity_key
from gleaner.sources.tables import cut

#: Of 100: the weight of common words among all words of two alike names.
SHARE = 70
#: Sets under one beginning from which on they are parted.
MANY = 64
#: The greatest weight that a code has room for, and the bits of a word's number.
HEAVIEST, NUMBER_BITS = 32_767, 48


def word_sets(items: DataFrame) -> DataFrame:
    """(entity, first_id, n) of ``items(id, name)``: names of the same words, how many, and the smallest id; a null name is in none."""
    words = F.array_join(F.array_distinct(F.split(entity_key(F.col("name")), " ")), " ")
    return items.where(F.col("name").isNotNull()).groupBy(words.alias("entity")).agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))


def weighted_sets(sets: DataFrame) -> DataFrame:
    """``sets`` with ``words``, the codes of their words, the rarest first, and ``weight``: a word weighs floor(1000 ln((sets + 1) / sets
    with it)), 1 at least. A code has the weight in its upper bits, so that codes sort by falling weight, and a number of the word."""
    words = sets.select("entity", F.explode(F.split("entity", " ")).alias("word")).where("word <> ''")
    held = words.groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
    total = sets.agg(F.count(F.lit(1)).alias("_total"))  # one row
    weight = F.greatest(F.floor(1000 * F.log((F.col("_total") + 1) / F.col("_n"))).cast("long"), F.lit(1))
    code = F.shiftleft(HEAVIEST - F.col("w"), NUMBER_BITS) + F.monotonically_increasing_id()
    weighed = cut(held.join(F.broadcast(total), how="cross").select("word", weight.alias("w")).withColumn("x", code))
    per = words.join(weighed, "word").groupBy("entity").agg(F.sort_array(F.collect_list("x")).alias("words"), F.sum("w").alias("weight"))  # words of one name
    return sets.join(per, "entity")


def weight_of(code: Column) -> Column:
    return HEAVIEST - F.shiftright(code, NUMBER_BITS)


def total_weight(codes: Column) -> Column:
    return F.aggregate(codes, F.lit(0).cast("long"), lambda a, x: a + weight_of(x))


def longer(rows: DataFrame, share: int) -> DataFrame:
    """``rows(entity, words, weight, start, last, missed)`` with each next word that may be common too: ``start``, the rarest common words, has
    it at its end, ``last`` is its place, and ``missed`` the weight of the words before it that are not common."""
    later = F.sequence(F.col("last") + 1, F.size("words"))
    missed = lambda k: F.col("missed") + total_weight(F.slice("words", F.col("last") + 1, k - F.col("last") - 1))
    next_ = F.transform(later, lambda k: F.struct(k.alias("last"), missed(k).alias("missed")))
    may = F.filter(next_, lambda x: 100 * (F.col("weight") - x["missed"]) >= share * F.col("weight"))
    grown = rows.where(F.col("last") < F.size("words")).withColumn("x", F.explode(may))
    start = F.concat("start", F.array(F.element_at("words", F.col("x.last"))))
    return grown.select("entity", "words", "weight", start.alias("start"), F.col("x.last").alias("last"), F.col("x.missed").alias("missed"))


def beginnings(sets: DataFrame, share: int, many: int) -> DataFrame:
    """(entity, words, weight, start, ended): each set under the possible beginnings of what it has in common with an alike one; see the module."""
    rows = cut(longer(sets.select("entity", "words", "weight", F.array().cast("array<long>").alias("start"), F.lit(0).alias("last"), F.lit(0).cast("long").alias("missed")), share))
    kept, columns = [], ["entity", "words", "weight", "start"]
    while True:
        full = rows.groupBy("start").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > many)
        if full.isEmpty():
            return reduce(DataFrame.unionByName, kept, rows.select(*columns, F.lit(False).alias("ended")))
        under = rows.join(full.select("start"), "start", "left_semi")
        ends = under.where(100 * total_weight(F.col("start")) >= share * F.col("weight")).select(*columns, F.col("start").alias("_above"), F.lit(True).alias("ended"), "last", "missed")
        on = longer(under, share).select(*columns, F.slice("start", F.lit(1), F.size("start") - 1).alias("_above"), F.lit(False).alias("ended"), "last", "missed")
        split = cut(ends.unionByName(on))
        # where the sets under a beginning are nearly the same, longer ones would not part them
        met = split.groupBy("_above", "start", "ended").agg(F.count(F.lit(1)).alias("_k")).groupBy("_above").agg(F.sum(F.col("_k") * F.col("_k")).alias("_pairs"))
        parted = full.join(met, F.col("start") == F.col("_above"), "left").where(F.coalesce("_pairs", F.lit(0)) * 2 <= F.col("_n") * F.col("_n")).select("start")
        parted = cut(parted)
        kept.append(rows.join(parted, "start", "left_anti").select(*columns, F.lit(False).alias("ended")))
        split = split.join(parted.withColumnRenamed("start", "_above"), "_above", "left_semi")
        kept.append(split.where("ended").select(*columns, "ended"))
        rows = split.where("not ended").drop("_above", "ended")


def alike(sets: DataFrame, share: int = SHARE, many: int = MANY) -> DataFrame:
    """(a, b, common, all_): the pairs of ``weighted_sets`` that are alike, a < b, each once."""
    if not 0 < share < 100:
        raise ValueError("a share of 1 to 99 hundredths")
    band = F.floor(F.log("weight") / (1.001 * math.log(100 / share))).cast("int")  # a little wide, for rounding
    one = cut(beginnings(sets, share, many).withColumn("band", band))
    two = one.select(F.col("entity").alias("b"), F.col("words").alias("_words"), F.col("weight").alias("_weight"), "start", "ended", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    near = (F.col("entity") < F.col("b")) & (100 * F.least("weight", "_weight") >= share * F.greatest("weight", "_weight"))
    met = one.join(two, ["start", "ended", "band"]).where(near).select(F.col("entity").alias("a"), "b", "weight", "_weight", "start", "ended", F.array_intersect("words", "_words").alias("both"))
    # of the beginnings that two sets share, the one of all their common words counts
    own = F.when(F.col("ended"), F.col("both") == F.col("start")).otherwise(F.slice("both", F.lit(1), F.size("start")) == F.col("start"))
    found = met.where(own).withColumn("common", total_weight(F.col("both"))).withColumn("all_", F.col("weight") + F.col("_weight") - F.col("common"))
    return found.where(100 * F.col("common") >= share * F.col("all_")).select("a", "b", "common", "all_")


def groups(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, first): of each node of ``links(a, b)`` the smallest node that links lead to. In each round
    a node takes the smallest label around it, and then that label's own; hubs only meet sums."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("first")))
    for _ in range(rounds):
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("first").alias("_x"))
        lower = labels.join(around, "node").select("node", F.least("first", "_x").alias("first"), F.col("first").alias("_old"))
        jump = lower.select(F.col("node").alias("_n"), F.col("first").alias("_f"))
        moved = cut(lower.join(jump, F.col("first") == F.col("_n"), "left").select("node", F.least("first", "_f").alias("first"), "_old"))
        if moved.where(F.col("first") < F.col("_old")).isEmpty():
            return moved.select("node", "first")
        labels = moved.select("node", "first")
    raise RuntimeError(f"groups have not settled in {rounds} rounds")


def same_items(items: DataFrame, share: int = SHARE) -> DataFrame:
    """(id, n_links, item_id) of ``items(id, name)``: how many other rows are the same item by a direct link or by equal words, and
    the smallest id of all rows that links lead to. A row without a name, or without a word in it, is an item of its own."""
    sets = cut(weighted_sets(word_sets(items)))
    pairs = cut(alike(sets, share).join(sets.select(F.col("entity").alias("a"), F.col("n").alias("_na")), "a").join(sets.select(F.col("entity").alias("b"), F.col("n").alias("_nb")), "b").select("a", "b", "_na", "_nb"))
    each = pairs.select("a", F.col("_nb").alias("k")).unionByName(pairs.select(F.col("b").alias("a"), F.col("_na").alias("k"))).groupBy(F.col("a").alias("entity")).agg(F.sum("k").alias("_linked"))
    member = groups(pairs).withColumnsRenamed({"node": "entity", "first": "_group"})
    joined = sets.select("entity", "first_id", "n").join(each, "entity", "left").join(member, "entity", "left").withColumn("_group", F.coalesce("_group", "entity"))
    first = joined.groupBy("_group").agg(F.min("first_id").alias("item_id"))
    found = joined.join(first, "_group").select("entity", (F.col("n") - 1 + F.coalesce("_linked", F.lit(0))).alias("n_links"), "item_id")
    words = F.array_join(F.array_distinct(F.split(entity_key(F.col("name")), " ")), " ")
    rows = items.select("id", words.alias("_words")).join(found, F.col("_words") == F.col("entity"), "left")
    return rows.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("item_id", "id").alias("item_id"))
