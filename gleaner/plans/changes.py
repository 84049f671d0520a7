"""Registered queries on changes of stored tables and of aggregates, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import maintained
from gleaner.plans.reports import load, query
from gleaner.sources.keyed import Keyed, Published, delete_cascade
from gleaner.sources.tables import shared_folder
from gleaner.streaming import jobs as streams


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("""WITH u AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer), s AS (SELECT s_suppkey * 29 AS id, s_name AS name, CASE WHEN s_suppkey % 4 > 0 THEN 'S' || s_suppkey % 4 ELSE '' END AS segment, s_acctbal AS balance FROM supplier),
 j AS (SELECT coalesce(u.id, s.id) AS id, coalesce(u.name, s.name) AS name, CASE WHEN u.id IS NULL THEN s.segment ELSE coalesce(nullif(s.segment, ''), u.segment) END AS segment, coalesce(u.balance, s.balance) AS balance FROM u FULL OUTER JOIN s ON u.id = s.id),
 c AS (SELECT id, name, segment, CASE WHEN id % 37 = 5 THEN 0.5 ELSE balance END AS balance FROM j WHERE id % 41 <> 7), o AS (SELECT o_custkey, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1)
 SELECT id, name, segment, balance, coalesce(n, 0) AS n_lists, CAST(coalesce(keys, 0) AS BIGINT) AS keys FROM c LEFT JOIN o ON o_custkey = id""")
def keyed_changes(spark: SparkSession, d: str) -> DataFrame:
    """M2, M3, M6: a stored table of venues after an upsert, an update and a delete that takes their lists along; each
    rewrites the partitions that it touches."""
    c, s, o = load(spark, d, "customer", "supplier", "orders")
    venues = Keyed(spark, place(spark, "venues"), parts=16).create(c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")))
    lists = Keyed(spark, place(spark, "lists"), "venue_id", 16).create(o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("venue_id")))
    k = F.col("s_suppkey") % 4
    venues.upsert(s.select((F.col("s_suppkey") * 29).alias("id"), F.col("s_name").alias("name"), F.when(k > 0, F.concat(F.lit("S"), k.cast("string"))).otherwise("").alias("segment"), F.col("s_acctbal").alias("balance")), ["segment"])
    venues.update(venues.read().where("id % 37 = 5").select("id", F.lit(0.5).alias("balance")))
    delete_cascade(venues, venues.read().where("id % 41 = 7").select("id"), [(lists, "venue_id")])
    per = lists.read().groupBy("venue_id").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("keys"))
    rows = venues.read().join(per, F.col("id") == F.col("venue_id"), "left")
    return rows.select("id", "name", "segment", "balance", F.coalesce("n", F.lit(0)).alias("n_lists"), F.coalesce("keys", F.lit(0)).alias("keys"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 = 0 THEN 'F' WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS status, o_orderpriority AS priority, CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 5 = 0 THEN 100 ELSE 0 END AS cents FROM orders WHERE o_orderkey % 13 <> 1)
 SELECT status, priority, c_mktsegment AS segment, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS cents, count(*) FILTER (WHERE cents > 20000000) AS large FROM o JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def maintained_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of lists by status, priority and the venue's segment, after two batches of inserts, updates and deletes whose differences alone were added."""
    o, c = load(spark, d, "orders", "customer")
    k, cents = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100).cast("long")
    rows = o.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), cents.alias("cents"))
    closed = F.when(k % 11 == 0, "F")
    first = rows.where(k % 10 < 7)
    second = rows.where((k % 10 < 9) & (k % 13 != 0)).withColumn("status", F.coalesce(closed, "status"))
    third = rows.where(k % 13 != 1).withColumns({"status": closed.when(k % 17 == 0, None).otherwise(F.col("status")), "cents": F.col("cents") + F.when(k % 5 == 0, 100).otherwise(0)})
    by, sums = ["status", "priority", "segment"], {"cents": F.col("cents"), "large": (F.col("cents") > 20_000_000).cast("long")}
    of = c.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    with_venues = lambda df: df.join(of, F.col("o_custkey") == F.col("c_custkey"))
    stored = maintained.totals(with_venues(first), by, sums)
    for old, new in ((first, second), (second, third)):
        change = maintained.totals(with_venues(maintained.signed(old, new, "o_orderkey")), by, sums, "sign")
        stored = maintained.merged(stored, change, by)
    return stored


@query("""WITH v AS (SELECT c_custkey AS id, c_mktsegment AS segment FROM customer WHERE c_custkey % 7 <> 3), l AS (SELECT o_orderkey AS id, o_custkey AS venue_id FROM orders WHERE o_custkey % 7 <> 3)
 SELECT segment, count(DISTINCT v.id) AS venues, count(l.id) AS lists FROM v LEFT JOIN l ON venue_id = v.id GROUP BY segment""")
def published_counts(spark: SparkSession, d: str) -> DataFrame:
    """Venues and their lists as of the last of two commits, which removes from both at once."""
    c, o = load(spark, d, "customer", "orders")
    store = Published(spark, place(spark, "published"))
    store.commit(lambda _: {"venues": c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")), "lists": o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("venue_id"))})

    def without(t: dict[str, DataFrame], rest: int) -> dict[str, DataFrame]:
        return {"venues": t["venues"].where(F.col("id") % 7 != rest), "lists": t["lists"].where(F.col("venue_id") % 7 != rest)}

    store.commit(lambda t: without(t, 3))
    t = store.tables()
    per = t["lists"].groupBy("venue_id").agg(F.count(F.lit(1)).alias("n"))
    rows = t["venues"].join(per, F.col("id") == F.col("venue_id"), "left")
    return rows.groupBy("segment").agg(F.count(F.lit(1)).alias("venues"), F.coalesce(F.sum("n"), F.lit(0)).alias("lists"))


@query("""SELECT user_id, count(*) AS attempts, count(*) FILTER (WHERE event_type = 'error') AS failures, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY user_id""")
def streamed_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Totals of jobs from a stream of their events, whose batches are written so that each counts once."""
    schema = ", ".join(f"{c} {kind}" for c, kind in load(spark, d, "events")[0].dtypes)
    folder = place(spark, "rolled-up")
    events = streams.read_events(spark, f"{d}/events.parquet*", schema)  # a stream reads folders or patterns
    streams.rollup_into(events, f"{folder}/totals", f"{folder}/checkpoint", "user_id", "event_type = 'error'", "value").awaitTermination()
    return streams.rolled_up(spark, f"{folder}/totals", "user_id").withColumn("total", F.col("total").cast("double"))
