"""The registered reports over the fixture tables, each with its SQL.

Nations stand for sites, customers for venues (segments for distinctions), orders
for lists, line items for listings, parts for items and events for job attempts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.functions import pagetext
from gleaner.functions import scalars as X
from gleaner.operators import display, lifecycle, links, ranking
from gleaner.sources.tables import bounded_pages, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
WEIGHTS = {"AUTOMOBILE": "1.5", "BUILDING": "1.4", "FURNITURE": "1.3", "HOUSEHOLD": "1.2", "MACHINERY": "1.1"}
WEIGHT_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN CAST({v} AS DECIMAL(3,1))" for k, v in WEIGHTS.items()) + " ELSE CAST(1.0 AS DECIMAL(3,1)) END"


def query(sql: str | None = None):  # noqa: ANN201
    def register(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def load(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [table(spark, d, n) for n in names]


def count(alias: str, column: str | None = None) -> F.Column:
    return F.count(F.col(column) if column else F.lit(1)).alias(alias)


@query("""SELECT count(*) AS n_venues, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS n_building,
 count(*) FILTER (WHERE c_acctbal < 0) AS n_negative, count(*) FILTER (WHERE c_mktsegment IN ('BUILDING','MACHINERY')) AS n_two FROM customer""")
def total_counts(spark: SparkSession, d: str) -> DataFrame:
    (c,) = load(spark, d, "customer")
    return c.agg(count("n_venues"), F.count_if(F.col("c_mktsegment") == "BUILDING").alias("n_building"), F.count_if(F.col("c_acctbal") < 0).alias("n_negative"), F.count_if(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).alias("n_two"))


@query("""SELECT n_name, c_mktsegment, count(c_custkey) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
 WHERE c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD') GROUP BY n_name, c_mktsegment""")
def heatmap(spark: SparkSession, d: str) -> DataFrame:
    c, n = load(spark, d, "customer", "nation")
    counted = c.where(F.col("c_mktsegment").isin(*SEGMENTS)).groupBy("c_nationkey", "c_mktsegment").agg(count("n", "c_custkey"))
    return counted.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "c_mktsegment").agg(F.sum("n").alias("n"))


@query("""SELECT n_name, c_mktsegment, count(o_orderkey) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 WHERE c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD') GROUP BY n_name, c_mktsegment""")
def heatmap_lists(spark: SparkSession, d: str) -> DataFrame:
    o, c, n = load(spark, d, "orders", "customer", "nation")
    per = o.groupBy("o_custkey").agg(count("k", "o_orderkey"))  # before the join: one row a venue
    rows = per.join(c.where(F.col("c_mktsegment").isin(*SEGMENTS)), F.col("o_custkey") == F.col("c_custkey"))
    return rows.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "c_mktsegment").agg(F.sum("k").alias("n"))


@query("""WITH k AS (SELECT n_name, s.seg FROM nation CROSS JOIN (SELECT unnest(['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD']) AS seg) s),
 g AS (SELECT n_name, c_mktsegment AS seg, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000 GROUP BY 1, 2)
 SELECT k.n_name AS n_name, k.seg AS segment, CAST(coalesce(g.n, 0) AS BIGINT) AS n FROM k LEFT JOIN g ON k.n_name = g.n_name AND k.seg = g.seg""")
def heatmap_dense(spark: SparkSession, d: str) -> DataFrame:
    c, n = load(spark, d, "customer", "nation")
    keys = n.select("n_name", "n_nationkey", F.explode(F.array(*map(F.lit, SEGMENTS))).alias("segment"))
    counted = c.where("c_acctbal > 9000").groupBy("c_nationkey", "c_mktsegment").agg(count("k"))
    joined = keys.join(counted, (F.col("n_nationkey") == F.col("c_nationkey")) & (F.col("segment") == F.col("c_mktsegment")), "left")
    return joined.select("n_name", "segment", F.coalesce("k", F.lit(0)).alias("n"))


@query("""SELECT n_name, count(*) FILTER (WHERE c_mktsegment='AUTOMOBILE') AS automobile, count(*) FILTER (WHERE c_mktsegment='BUILDING') AS building,
 count(*) FILTER (WHERE c_mktsegment='FURNITURE') AS furniture, count(*) FILTER (WHERE c_mktsegment='HOUSEHOLD') AS household
 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def heatmap_pivot(spark: SparkSession, d: str) -> DataFrame:
    c, n = load(spark, d, "customer", "nation")
    wide = c.groupBy("c_nationkey").pivot("c_mktsegment", list(SEGMENTS)).agg(count("n")).na.fill(0)
    return wide.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", *[F.col(s).alias(s.lower()) for s in SEGMENTS])


@query("""SELECT n_name, count(s_suppkey) AS n FROM nation LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 8000) s ON n_nationkey = s_nationkey GROUP BY n_name""")
def site_counts_outer(spark: SparkSession, d: str) -> DataFrame:
    n, s = load(spark, d, "nation", "supplier")
    per = s.where("s_acctbal > 8000").groupBy("s_nationkey").agg(count("k", "s_suppkey"))
    return n.join(per, F.col("n_nationkey") == F.col("s_nationkey"), "left").groupBy("n_name").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"))


@query("""SELECT coalesce(CAST(quality AS VARCHAR), 'Unknown') AS quality, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""")
def group_nullable(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = load(spark, d, "documents", "labels")
    joined = docs.select("doc_id").join(labels, "doc_id", "left")
    return joined.groupBy(F.coalesce(F.col("quality").cast("string"), F.lit("Unknown")).alias("quality")).agg(count("n"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def group_status(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(count("n"))


@query("""SELECT CAST(coalesce(sum(CAST(value AS DECIMAL(18,4))), 0) AS DOUBLE) AS total, CAST(coalesce(sum(user_id), 0) AS BIGINT) AS tokens, count(*) AS n,
 round(CAST(coalesce(avg(CAST(value AS DECIMAL(18,4))), 0) AS DOUBLE), 4) AS mean FROM events WHERE nullif(event_type, 'error') IS NOT NULL""")
def crawl_stats(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where(F.nullif(F.col("event_type"), F.lit("error")).isNotNull())
    v = F.col("value").cast("decimal(18,4)")
    total = F.coalesce(F.sum(v).cast("double"), F.lit(0.0))
    return e.agg(total.alias("total"), F.coalesce(F.sum("user_id"), F.lit(0)).cast("long").alias("tokens"), count("n"), F.round(F.coalesce(F.sum(v).cast("double") / F.count(v), F.lit(0.0)), 4).alias("mean"))


@query("""SELECT n_name, CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE c_acctbal > 0) AS DOUBLE) / count(*) ELSE 0 END AS share
 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    c, n = load(spark, d, "customer", "nation")
    per = c.groupBy("c_nationkey").agg(F.count_if(F.col("c_acctbal") > 0).alias("good"), count("all_"))
    return per.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(X.ratio(F.sum("good").cast("double"), F.sum("all_")).alias("share"))


@query("""SELECT event_id, event_type, user_id, c_name FROM events LEFT JOIN customer ON user_id = c_custkey ORDER BY ts DESC NULLS FIRST, event_id LIMIT 10""")
def recent_jobs(spark: SparkSession, d: str) -> DataFrame:
    e, c = load(spark, d, "events", "customer")
    top = e.orderBy(F.desc_nulls_first("ts"), "event_id").limit(10)
    return top.join(c, F.col("user_id") == F.col("c_custkey"), "left").select("event_id", "event_type", "user_id", "c_name")


@query("""SELECT l_orderkey, l_linenumber, p_name, p_brand, c_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
 JOIN customer ON o_custkey = c_custkey WHERE (p_name ILIKE '%green%' OR p_brand ILIKE '%#1%') AND l_returnflag = 'R'
 ORDER BY p_name NULLS LAST, l_orderkey, l_linenumber LIMIT 100""")
def listing_search(spark: SparkSession, d: str) -> DataFrame:
    li, p, o, c = load(spark, d, "lineitem", "part", "orders", "customer")
    found = p.where(F.col("p_name").ilike("%green%") | F.col("p_brand").ilike("%#1%"))
    top = li.where("l_returnflag = 'R'").join(found, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_name", "p_brand")
    rows = top.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(c.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.orderBy(F.asc_nulls_last("p_name"), "l_orderkey", "l_linenumber").limit(100).select("l_orderkey", "l_linenumber", "p_name", "p_brand", "c_name")


def filtered(df: DataFrame, name: str | None = None, segments: list[str] | None = None, site: int | None = None, has_balance: bool | None = None, site_name: str | None = None, sites: DataFrame | None = None) -> DataFrame:
    """Only the filters that are given; wildcards in ``name`` are left as they are. J7: a
    ``site_name`` is looked up in ``sites``, and one that is unknown filters nothing."""
    if site_name and sites is not None:
        found = sites.where(F.col("n_name") == site_name).agg(F.min("n_nationkey").alias("_site"))  # one row
        df = df.join(F.broadcast(found), F.col("_site").isNull() | (F.col("c_nationkey") == F.col("_site"))).drop("_site")
    if name:
        df = df.where(F.col("c_name").ilike(f"%{name}%"))
    if segments:
        df = df.where(F.col("c_mktsegment").isin(*segments))
    if site is not None:
        df = df.where(F.col("c_nationkey") == site)
    if has_balance is not None:
        value = F.nullif(F.greatest(F.col("c_acctbal"), F.lit(0.0)), F.lit(0.0))
        df = df.where(value.isNotNull() if has_balance else value.isNull())
    return df


@query("""SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name ILIKE '%00%' AND c_mktsegment IN ('BUILDING','MACHINERY') AND nullif(greatest(c_acctbal, 0.0), 0.0) IS NOT NULL""")
def venue_filter(spark: SparkSession, d: str) -> DataFrame:
    return filtered(table(spark, d, "customer"), "00", ["BUILDING", "MACHINERY"], None, True).select("c_custkey", "c_name", "c_mktsegment").orderBy(F.asc_nulls_last("c_name"), "c_custkey")


@query("""SELECT c_name, o_orderkey, CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey) AS INTEGER) AS place FROM orders JOIN customer ON o_custkey = c_custkey""")
def list_order(spark: SparkSession, d: str) -> DataFrame:
    """The order of lists: by venue, then the newest first; the order is a column."""
    o, c = load(spark, d, "orders", "customer")
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc_nulls_first("o_orderdate"), "o_orderkey"))
    ranked = o.select("o_custkey", "o_orderkey", place.alias("place"))
    return ranked.join(c.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")).select("c_name", "o_orderkey", "place")


@query("""SELECT c_name, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS lists, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name""")
def lists_by_name(spark: SparkSession, d: str) -> DataFrame:
    o, c = load(spark, d, "orders", "customer")
    joined = o.select("o_custkey", "o_orderkey").join(c.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_name").agg(F.array_join(F.sort_array(F.collect_list("o_orderkey")).cast("array<string>"), ",").alias("lists"), count("n"))


@query("""SELECT n_name, CAST(coalesce(c.n, 0) AS BIGINT) AS venues, CAST(coalesce(s.n, 0) AS BIGINT) AS jobs FROM nation
 LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c ON n_nationkey = c_nationkey
 LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON n_nationkey = s_nationkey""")
def child_counts(spark: SparkSession, d: str) -> DataFrame:
    n, c, s = load(spark, d, "nation", "customer", "supplier")
    a, b = c.groupBy("c_nationkey").agg(count("venues")), s.groupBy("s_nationkey").agg(count("jobs"))
    joined = n.join(a, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(b, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return joined.select("n_name", F.coalesce("venues", F.lit(0)).alias("venues"), F.coalesce("jobs", F.lit(0)).alias("jobs"))


NAME_SQL = "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) WHEN o_orderkey % 3 = 1 THEN ' customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') ELSE 'CUSTOMER#' || lpad(CAST(o_custkey + 1 AS VARCHAR), 9, '0') || ' ' END"


@query(f"""WITH w AS (SELECT DISTINCT {NAME_SQL} AS wanted FROM orders), t AS (SELECT wanted, trim(wanted) AS v FROM w)
 SELECT wanted, min(c_custkey) AS id FROM t JOIN customer ON (regexp_full_match(v, '[0-9]+') AND CAST(c_custkey AS VARCHAR) = v) OR (NOT regexp_full_match(v, '[0-9]+') AND lower(c_name) = lower(v)) GROUP BY wanted""")
def resolve_name(spark: SparkSession, d: str) -> DataFrame:
    """P10: every order's customer by what it is called: digits are an id, else a name
    without regard to case; the smallest id of equals."""
    o, c = load(spark, d, "orders", "customer")
    k, n = F.col("o_orderkey") % 3, F.col("o_custkey")
    name = lambda x: F.concat(F.lit("customer#"), F.lpad(x.cast("string"), 9, "0"))
    wanted = o.select(F.when(k == 0, n.cast("string")).when(k == 1, F.concat(F.lit(" "), name(n))).otherwise(F.concat(F.upper(name(n + 1)), F.lit(" "))).alias("wanted")).distinct()
    return resolve_all(c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), wanted)


def resolve_all(venues: DataFrame, wanted: DataFrame) -> DataFrame:
    """(wanted, id) of many: by id if all digits, else by the whole name. Two equi-joins
    over aggregated names; parts of names are looked for by ``names.resolve_many``."""
    value = X.strip(F.col("wanted"))
    rows = wanted.select("wanted", value.alias("_v"), value.rlike("^[0-9]+$").alias("_digits")).where(value != "")
    ids = rows.where("_digits").join(venues.select("id"), F.col("_v").try_cast("long") == F.col("id")).select("wanted", "id")
    names = venues.groupBy(F.lower("name").alias("_n")).agg(F.min("id").alias("id"))
    return ids.unionByName(rows.where("NOT _digits").join(names, F.lower("_v") == F.col("_n")).select("wanted", "id"))


def resolve(venues: DataFrame, identifier: str, site: int | None = None) -> DataFrame:
    """P10 for one identifier: digits are an id of any site; else an exact name, else
    a part of one, of the site if given. At most one row, the smallest id of a tier; none
    for a blank one. Wildcards are left as they are."""
    value = identifier.strip()
    if not value:
        return venues.limit(0)
    if value.isdigit():
        return venues.where(F.col("id") == int(value))
    if site is not None:
        venues = venues.where(F.col("site_id") == site)
    tier = F.when(F.col("name").ilike(value), 0).when(F.col("name").ilike(f"%{value}%"), 1)
    return venues.withColumn("_tier", tier).where(F.col("_tier").isNotNull()).orderBy("_tier", "id").limit(1).drop("_tier")


def resolve_sites(sites: DataFrame, wanted: DataFrame) -> DataFrame:
    """(wanted, id): a site by its whole name, else by the last words of it, without
    regard to case; the smallest id of the first tier that fits; blank names resolve to none."""
    words = F.split(F.lower("site_name"), " ")
    tails = F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.struct(F.array_join(F.slice(words, k, F.size(words)), " ").alias("form"), (k > 1).cast("int").alias("tier")))
    forms = sites.select("id", F.explode(tails).alias("f")).select("f.form", F.struct("f.tier", "id").alias("rank")).groupBy("form").agg(F.min("rank").alias("rank"))
    value = F.lower(X.strip(F.col("wanted")))
    return wanted.where(value != "").join(forms, value == F.col("form")).select("wanted", F.col("rank.id").alias("id"))


@query("""WITH c AS (SELECT c_custkey, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
 q AS (SELECT DISTINCT CASE o_orderkey % 4 WHEN 0 THEN n_name WHEN 1 THEN ' ' || c_mktsegment || ' ' || n_name WHEN 2 THEN c_mktsegment ELSE '' END AS wanted FROM orders JOIN c ON o_custkey = c_custkey),
 s AS (SELECT c_custkey AS id, lower(c_mktsegment || ' ' || n_name) AS n FROM c),
 t AS (SELECT wanted, id, CASE WHEN n = lower(trim(wanted)) THEN 0 WHEN ends_with(n, ' ' || lower(trim(wanted))) THEN 1 END AS tier FROM q CROSS JOIN s WHERE wanted <> '')
 SELECT wanted, arg_min(id, tier * 1000000000 + id) AS id FROM t WHERE tier IS NOT NULL GROUP BY wanted""")
def resolve_site(spark: SparkSession, d: str) -> DataFrame:
    """P11 over names of two and more words, asked for whole, by their last words, by their first or by none."""
    o, c, n = load(spark, d, "orders", "customer", "nation")
    sites = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", "n_name")
    k = F.col("o_orderkey") % 4
    whole = F.concat_ws(" ", "c_mktsegment", "n_name")
    asked = o.join(sites, F.col("o_custkey") == F.col("c_custkey")).select(F.when(k == 0, F.col("n_name")).when(k == 1, F.concat(F.lit(" "), whole)).when(k == 2, F.col("c_mktsegment")).otherwise("").alias("wanted")).distinct()
    return resolve_sites(sites.select(F.col("c_custkey").alias("id"), whole.alias("site_name")), asked)


@query("""SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def seed_missing(spark: SparkSession, d: str) -> DataFrame:
    o, li = load(spark, d, "orders", "lineitem")
    return o.join(li.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("""SELECT sha256(text) AS file_hash, min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY 1""")
def content_dedup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("file_hash")).agg(F.min("doc_id").alias("first_id"), count("copies"))


@query("""SELECT coalesce(c_custkey, k) AS id, coalesce(nullif(fresh, ''), c_mktsegment) AS segment, coalesce(c_name, 'new') AS name FROM customer
 FULL OUTER JOIN (SELECT o_custkey + 10 AS k, CASE WHEN max(o_orderstatus) = 'P' THEN '' ELSE max(o_orderstatus) END AS fresh FROM orders GROUP BY 1) o ON c_custkey = k""")
def upsert_snapshot(spark: SparkSession, d: str) -> DataFrame:
    c, o = load(spark, d, "customer", "orders")
    status = F.max("o_orderstatus")
    new = o.groupBy((F.col("o_custkey") + 10).alias("id")).agg(F.when(status == "P", "").otherwise(status).alias("segment")).withColumn("name", F.lit("new"))
    merged = lifecycle.upsert(c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name")), new, "id", ["segment"])
    return merged.withColumn("segment", X.nullif_blank(F.col("segment")))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'download_list_failed' WHEN url <> '' AND path <> '' THEN 'wine_list_found' WHEN url <> '' THEN 'download_list_failed'
 WHEN site <> '' THEN 'no_wine_list' ELSE 'no_website' END AS status, (o_orderstatus = 'O') AND NOT (o_orderkey % 2 = 0) AS skipped FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE '' END AS path,
 CASE WHEN o_orderkey % 5 < 2 THEN 'u' END AS url, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 's' END AS site FROM orders) t""")
def outcome_status(spark: SparkSession, d: str) -> DataFrame:
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    found = lifecycle.outcome(F.when(k % 5 < 2, "u"), F.when(k % 3 == 0, "x").otherwise(""), status == "F", F.when(k % 7 == 0, "").otherwise("s"))
    return table(spark, d, "orders").select("o_orderkey", found.alias("status"), lifecycle.skipped(F.when(status == "O", "wine_list_found").otherwise("pending"), k % 2 == 0).alias("skipped"))


STATE_SQL = """SELECT o_orderkey, o_orderkey % 11 <> 0 AS venue, CASE o_orderkey % 3 WHEN 0 THEN 'w' WHEN 1 THEN '' END AS website, CASE o_orderstatus WHEN 'O' THEN 'wine_list_found' WHEN 'F' THEN 'pending' END AS status,
 o_orderkey % 2 = 0 AS force, CASE WHEN o_orderkey % 5 < 3 THEN 'u' END AS url, CASE WHEN o_orderkey % 7 < 4 THEN '/p' END AS path, CASE o_orderkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS failed, o_orderkey % 6 = 0 AS searched,
 CAST(o_orderkey % 4 AS INTEGER) AS idx, CAST(o_orderkey % 3 AS INTEGER) AS urls, CAST(o_orderkey % 5 + 1 AS INTEGER) AS page, CAST(o_orderkey % 6 AS INTEGER) AS pages, CAST(CASE WHEN o_orderkey % 8 > 0 THEN o_orderkey % 8 - 1 END AS INTEGER) AS failures FROM orders"""


@query(f"""SELECT o_orderkey,
 CASE WHEN NOT venue OR (coalesce(status, '') = 'wine_list_found' AND NOT force) THEN 'save' WHEN coalesce(website, '') <> '' THEN 'crawl' ELSE 'search' END AS after_process,
 CASE WHEN NOT venue THEN 'save' WHEN url IS NOT NULL THEN 'download' ELSE 'search' END AS after_crawl,
 CASE WHEN venue AND path IS NOT NULL AND NOT coalesce(failed, FALSE) THEN 'extract' WHEN venue AND coalesce(failed, FALSE) AND NOT searched THEN 'search' ELSE 'save' END AS after_download,
 CASE WHEN venue AND url IS NOT NULL THEN 'download' ELSE 'save' END AS after_search,
 CASE WHEN coalesce(failures, 0) >= 3 AND urls = 0 THEN CASE WHEN pages > 0 AND page <= pages THEN 'next_page' ELSE 'done' END WHEN idx < urls THEN 'next_venue' WHEN pages > 0 AND page + 1 <= pages THEN 'next_page' ELSE 'done' END AS after_save
 FROM ({STATE_SQL}) t""")
def routes(spark: SparkSession, d: str) -> DataFrame:
    """What comes after each step, for every state of a venue."""
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "O", "wine_list_found").when(F.col("o_orderstatus") == "F", "pending")
    venue, website = k % 11 != 0, F.when(k % 3 == 0, "w").when(k % 3 == 1, "")
    url, path, failed = F.when(k % 5 < 3, "u"), F.when(k % 7 < 4, "/p"), F.when(k % 4 == 0, True).when(k % 4 == 1, False)
    return table(spark, d, "orders").select(
        "o_orderkey", lifecycle.route_after_process(venue, website, status, k % 2 == 0).alias("after_process"), lifecycle.route_after_crawl(venue, url).alias("after_crawl"),
        lifecycle.route_after_download(venue, path, failed, k % 6 == 0).alias("after_download"), lifecycle.route_after_search(venue, url).alias("after_search"),
        lifecycle.route_after_save(k % 4, k % 3, k % 5 + 1, k % 6, F.when(k % 8 > 0, k % 8 - 1)).alias("after_save"),
    )


ODD_URLS = ("/list.pdf", "/Wine%20List.PDF?x=1", "/Login;a=1", "/shop/#", "/a/b/;p?q#f", "")
HOSTS = ("hub.binwise.com", "bw-winelist.s3.org", "www.starwinelist.com", "ENOWINE.com", "wineby.com", "binwise.com/restaurant", "opentable.com", "plain.org")
URL_SQL = "SELECT page_id, CASE CAST(page_id % 9 AS INTEGER) " + " ".join(f"WHEN {k} THEN 'HTTPS://{h}' || x" for k, h in enumerate(HOSTS)) + " ELSE url || x END AS u FROM (SELECT page_id, url, CASE CAST(page_id % 7 AS INTEGER) " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(ODD_URLS)) + " ELSE '/careers' END AS x FROM pages) p"
SKIPPED_SQL = X.SKIPPED.replace("'", "''")


@query(rf"""WITH s AS ({URL_SQL}), t AS (SELECT page_id, u, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host,
 regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', '') AS path FROM s)
 SELECT page_id, scheme || '://' || host || CASE WHEN length(path) > 1 THEN regexp_replace(path, '/$', '') ELSE path END AS normal, lower(host) AS host, ends_with(lower(url_decode(path)), '.pdf') AS pdf,
 regexp_matches(u, '(?i)hub\.binwise\.com|bw-winelist|binwise\.com/restaurant|starwinelist\.com|enowine\.com|wineby\.com') AS platform, regexp_matches(u, '{SKIPPED_SQL}') AS skipped FROM t""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    """X2-X6 over the pages' urls, in many forms and on many hosts."""
    p = table(spark, d, "pages")
    end = F.get(F.array(*map(F.lit, ODD_URLS)), (F.col("page_id") % 7).cast("int"))
    host = F.get(F.array(*map(F.lit, HOSTS)), (F.col("page_id") % 9).cast("int"))
    rows = p.select("page_id", F.concat(F.coalesce(F.concat(F.lit("HTTPS://"), host), F.col("url")), F.coalesce(end, F.lit("/careers"))).alias("u"))
    u = F.col("u")
    return rows.select("page_id", X.normalize_url(u).alias("normal"), X.domain(u).alias("host"), X.is_pdf(u).alias("pdf"), X.is_platform(u).alias("platform"), X.is_skipped(u).alias("skipped"))


@query("""SELECT event_id, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's' WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS shown
 FROM (SELECT event_id, CAST(floor(value * 60) AS BIGINT) AS s FROM events) t""")
def duration_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", X.duration_text(F.floor(F.col("value") * 60)).alias("shown"))


@query("""SELECT event_id, CASE WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS job, CASE WHEN s = 0 THEN '' ELSE (s // 60) || 'm ' || (s % 60) || 's' END AS in_table,
 strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M') AS minute, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second FROM (SELECT event_id, ts, CAST(floor(value * 60) AS BIGINT) % 400 AS s FROM events) t""")
def shown_times(spark: SparkSession, d: str) -> DataFrame:
    """The other rules for durations, and the date formats."""
    s = F.floor(F.col("value") * 60).cast("long") % 400
    return table(spark, d, "events").select("event_id", X.duration_of_job(s).alias("job"), X.duration_in_table(s).alias("in_table"), X.day_text(F.col("ts")).alias("day"), X.minute_text(F.col("ts")).alias("minute"), X.second_text(F.col("ts")).alias("second"))


@query("""SELECT o_custkey, count(*) AS total, CAST(greatest(1, ceil(count(*) / 4.0)) AS BIGINT) AS pages, 'base' || CASE WHEN o_custkey % 3 = 1 THEN '/bib-gourmand' ELSE '' END || CASE WHEN count(*) > 1 THEN '/page/' || count(*) ELSE '' END AS url FROM orders GROUP BY o_custkey""")
def page_math(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "orders").groupBy("o_custkey").agg(count("total"))
    level = F.when(F.col("o_custkey") % 3 == 1, "gourmand").otherwise("all")
    return per.select("o_custkey", "total", X.page_count(F.col("total"), 4).alias("pages"), X.listing_url(F.lit("base"), level, F.col("total")).alias("url"))


@query("""SELECT c_custkey AS id, coalesce(n_name, '—') AS site, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS distinction, CASE WHEN o.u <> '' THEN '✓' ELSE '✗' END AS has_list,
 CASE WHEN o.n IS NULL THEN '' WHEN o.n * 7 < 60 THEN format('{:.1f}s', o.n * 7.0::DOUBLE) ELSE format('{:.1f}m', o.n * 7.0::DOUBLE / 60) END AS crawl_time, coalesce(o.n, 0) AS pages, coalesce(strftime(o.t, '%Y-%m-%d'), 'Never') AS last_crawled
 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 5 <> 0 LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS t, CASE WHEN count(*) % 3 = 0 THEN '' ELSE 'u' END AS u FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def display_rows(spark: SparkSession, d: str) -> DataFrame:
    """Venues as they are shown: missing values, ticks, durations and dates."""
    c, n, o = load(spark, d, "customer", "nation", "orders")
    per = o.groupBy("o_custkey").agg(count("n"), F.max("o_orderdate").alias("t"))
    rows = c.join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    lit = lambda kind: F.lit(None).cast(kind)
    venues = rows.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("distinction"),
        *[lit("string").alias(x) for x in ("address", "city", "state", "zip_code", "country", "cuisine", "price_range", "crawl_status")], F.when(F.col("n") % 3 == 0, "").when(F.col("n") > 0, "u").alias("list_url"),
        (F.col("n") * 7).cast("decimal(10,2)").alias("crawl_duration_seconds"), lit("int").alias("llm_tokens_used"), F.col("n").alias("pages_visited"), F.col("t").alias("last_crawled_at"), F.col("c_nationkey").alias("site_id"),
    )
    sites = n.where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("site_name"))
    return display.venues(venues, sites).select("id", "site", "name", "distinction", "has_list", "crawl_time", "pages", "last_crawled")


@query("""SELECT c_custkey AS id, CASE WHEN r.f > 0 THEN 'download_list_failed' WHEN r.n % 3 = 0 THEN 'wine_list_found' WHEN r.n % 3 = 1 THEN 'no_wine_list' WHEN r.n % 3 = 2 THEN 'no_website' ELSE 'pending' END AS crawl_status,
 CASE WHEN r.f > 0 OR r.n % 3 = 0 THEN 'u' ELSE 'old' END AS list_url, CAST(coalesce(r.n, 0) AS INTEGER) AS pages_visited FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'P') AS f FROM orders GROUP BY 1) r ON o_custkey = c_custkey""")
def saved_results(spark: SparkSession, d: str) -> DataFrame:
    """Venues after the results of their crawls."""
    c, o = load(spark, d, "customer", "orders")
    got = o.groupBy("o_custkey").agg(count("n"), F.count_if(F.col("o_orderstatus") == "P").alias("f"))
    k = F.col("n") % 3
    results = got.select(
        F.col("o_custkey").alias("id"), F.when((k == 0) | (F.col("f") > 0), "u").alias("list_url"), F.when(k == 0, "/p").alias("local_file_path"), (F.col("f") > 0).alias("download_failed"), F.when(k == 1, "w").otherwise("").alias("website_url"),
        F.lit("pending").alias("crawl_status"), F.lit(1).cast("decimal(10,2)").alias("crawl_duration_seconds"), F.lit(None).cast("int").alias("llm_tokens_used"), F.col("n").cast("int").alias("pages_visited"),
    )
    none = lambda kind: F.lit(None).cast(kind)
    venues = c.select(F.col("c_custkey").alias("id"), F.lit("old").alias("list_url"), F.lit("pending").alias("crawl_status"), none("timestamp").alias("last_crawled_at"), none("timestamp").alias("last_updated_at"), none("decimal(10,2)").alias("crawl_duration_seconds"), F.lit(0).alias("llm_tokens_used"), F.lit(0).alias("pages_visited"))
    return lifecycle.save_results(venues, results, F.lit("2024-01-01").cast("timestamp")).select("id", "crawl_status", "list_url", "pages_visited")


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type || ' ' || event_id AS m, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events WHERE event_type = 'error'),
 j AS (SELECT user_id, min(ts) AS s, max(ts) AS t FROM events GROUP BY 1), x AS (SELECT user_id, string_agg(m, chr(10) ORDER BY k) AS msg FROM e WHERE k <= 20 GROUP BY 1)
 SELECT j.user_id AS id, CASE WHEN j.user_id % 2 = 0 THEN 'completed' WHEN j.user_id % 3 = 0 THEN 'failed' ELSE 'running' END AS status, CASE WHEN j.user_id % 2 = 0 THEN x.msg WHEN j.user_id % 3 = 0 THEN 'stopped' END AS error_message FROM j LEFT JOIN x ON j.user_id = x.user_id""")
def finished_jobs(spark: SparkSession, d: str) -> DataFrame:
    """Jobs that were completed, with their first errors, that failed, or go on."""
    e = table(spark, d, "events")
    none = lambda kind: F.lit(None).cast(kind)
    jobs = e.groupBy(F.col("user_id").alias("id")).agg(F.min("ts").cast("timestamp").alias("started_at")).withColumns({"status": F.lit("running"), "error_message": none("string"), "completed_at": none("timestamp"), "duration_seconds": none("decimal(10,2)")})
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    first = e.where("event_type = 'error'").withColumn("k", place).where(F.col("k") <= lifecycle.SHOWN_ERRORS)  # no longer list is ever gathered
    texts = F.transform(F.sort_array(F.collect_list(F.struct("k", F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("m")))), lambda x: x["m"])
    errors = first.groupBy(F.col("user_id").alias("id")).agg(texts.alias("errors"))
    ended = jobs.where("id % 2 = 0").select("id").join(errors, "id", "left").withColumn("errors", F.coalesce("errors", F.array().cast("array<string>")))
    at = F.lit("2030-01-01").cast("timestamp")
    done = lifecycle.complete_jobs(jobs, ended, at)
    failed = jobs.where("id % 3 = 0").select("id", F.lit("stopped").alias("message"))
    return lifecycle.fail_jobs(done, failed, at).select("id", "status", "error_message")


@query("""WITH RECURSIVE a AS (SELECT user_id AS job_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt, event_id % 5 AS urls, 3 + user_id % 30 AS pages, CASE WHEN event_type = 'error' OR event_id % 3 = 1 THEN CASE WHEN event_id % 2 = 0 THEN 'Page crashed' ELSE 'timeout' END END AS e FROM events),
 r AS (SELECT DISTINCT job_id, 0::BIGINT AS attempt, 0::BIGINT AS page, 0::BIGINT AS failures, NULL::VARCHAR AS error, FALSE AS restarts, 1::BIGINT AS current_page, 0::BIGINT AS total_pages, 0::BIGINT AS venues_found, 0::BIGINT AS urls, TRUE AS more FROM a
  UNION ALL SELECT job_id, attempt, page, failures, error, restarts, current_page, total_pages, venues_found, urls, CASE WHEN e IS NULL THEN current_page + 1 <= total_pages WHEN failures = 3 THEN total_pages > 0 AND current_page <= total_pages ELSE (total_pages > 0 AND current_page + 1 <= total_pages) OR total_pages = 0 END
  FROM (SELECT job_id, attempt, page, failures, CASE WHEN e IS NOT NULL THEN 'Page ' || page || ' attempt ' || failures || ': ' || e END AS error, coalesce(e = 'Page crashed', FALSE) AS restarts, e, CASE WHEN e IS NULL THEN page WHEN failures = 3 THEN page + 1 ELSE was END AS current_page, CASE WHEN e IS NULL AND page = 1 THEN pages ELSE total END AS total_pages,
   found + CASE WHEN e IS NULL THEN fetched ELSE 0 END AS venues_found, CASE WHEN e IS NULL THEN fetched WHEN failures = 3 THEN 0 ELSE had END AS urls
   FROM (SELECT r.job_id, a.attempt, CASE WHEN r.urls > 0 THEN r.current_page + 1 ELSE r.current_page END AS page, CASE WHEN e IS NULL THEN 0 WHEN r.failures >= 3 THEN 1 ELSE r.failures + 1 END AS failures, e, r.current_page AS was, r.total_pages AS total, a.pages, r.venues_found AS found, a.urls AS fetched, r.urls AS had
    FROM r JOIN a ON a.job_id = r.job_id AND a.attempt = r.attempt + 1 WHERE r.more) x) y)
 SELECT job_id, attempt, page::INTEGER AS page, failures::INTEGER AS failures, error, restarts, current_page::INTEGER AS current_page, total_pages::INTEGER AS total_pages, venues_found::INTEGER AS venues_found, CASE WHEN more THEN 'next_page' ELSE 'done' END AS route FROM r WHERE attempt > 0""")
def paging(spark: SparkSession, d: str) -> DataFrame:
    """The paging of jobs over all their attempts: fetched pages, empty ones, failures in a row, skipped pages and restarts."""
    e = table(spark, d, "events")
    k, n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")), F.col("event_id")
    error = F.when((F.col("event_type") == "error") | (n % 3 == 1), F.when(n % 2 == 0, "Page crashed").otherwise("timeout"))
    return lifecycle.fetch_listings(e.select(F.col("user_id").alias("job_id"), k.cast("long").alias("attempt"), (n % 5).alias("urls"), (3 + F.col("user_id") % 30).alias("pages"), error.alias("error")))


PLACE_SQL = "array_to_string(list_transform(string_split(lower({0}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@query(f"""SELECT c_custkey, {PLACE_SQL.format("c_mktsegment")} AS city, CASE WHEN n_name = 'CHINA' THEN 'DC' ELSE {PLACE_SQL.format("n_name")} END AS state FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def guide_places(spark: SparkSession, d: str) -> DataFrame:
    """City and state of venues, from the urls of their pages."""
    c, n = load(spark, d, "customer", "nation")
    slug = F.when(F.col("n_name") == "CHINA", "district-of-columbia").otherwise(X.slug(F.col("n_name")))
    url = F.concat(F.lit("https://g/us/en/"), slug, F.lit("/"), F.lower("c_mktsegment"), F.lit("_"), F.col("c_custkey").cast("string"), F.lit("/restaurant/"), X.slug(F.col("c_name")), F.lit("/"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", X.city_state(url).alias("p")).select("c_custkey", "p.*")


@query(r"""WITH f AS (SELECT p_partkey, CASE CAST(p_partkey % 4 AS INTEGER) WHEN 0 THEN ' .' || p_name || '?.pdf' WHEN 1 THEN repeat(p_name, 30) || '.html' WHEN 2 THEN '...' ELSE repeat(p_brand, 40) END AS n FROM part),
 c AS (SELECT p_partkey, regexp_replace(translate(n, '<>:"/\|?*', '_________'), '^[. ]+|[. ]+$', '', 'g') AS n FROM f)
 SELECT p_partkey, CASE WHEN n = '' THEN 'wine_list' WHEN length(n) <= 200 THEN n WHEN contains(n, '.') THEN left(regexp_replace(n, '\.[^.]*$', ''), 190) || regexp_extract(n, '(\.[^.]*)$', 1) ELSE left(n, 200) END AS name FROM c""")
def file_names(spark: SparkSession, d: str) -> DataFrame:
    """Names that a file system takes."""
    k, name = F.col("p_partkey") % 4, F.col("p_name")
    given = F.when(k == 0, F.concat(F.lit(" ."), name, F.lit("?.pdf"))).when(k == 1, F.concat(F.repeat(name, F.lit(30)), F.lit(".html"))).when(k == 2, "...").otherwise(F.repeat("p_brand", F.lit(40)))
    return table(spark, d, "part").select("p_partkey", X.safe_filename(given).alias("name"))


@query(r"""WITH p AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/]*)', 1) AS root, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages),
 a AS (SELECT page_id, root, hrefs[i] AS href, trim(texts[i]) AS text, i - 1 AS pos FROM (SELECT *, unnest(range(1, len(hrefs) + 1)) AS i FROM p) t),
 u AS (SELECT page_id, pos, text, root, CASE WHEN starts_with(href, '/') THEN root || href ELSE href END AS url FROM a), f AS (SELECT * FROM u WHERE starts_with(url, root) AND NOT regexp_matches(url, '""" + SKIPPED_SQL + """')),
 r AS (SELECT *, row_number() OVER (PARTITION BY page_id, regexp_replace(regexp_replace(url, '[;?#].*$', ''), '/$', '') ORDER BY pos) AS n FROM f)
 SELECT page_id, count(*) AS n, CAST(min(pos) AS INTEGER) AS first_pos, CAST(max(pos) AS INTEGER) AS last_pos FROM r WHERE n = 1 AND length(text) BETWEEN 1 AND 100 GROUP BY page_id""")
def navigation(spark: SparkSession, d: str) -> DataFrame:
    """The links that a page offers on its own host."""
    bounded_pages(spark)
    found = links.resolved(links.anchors(table(spark, d, "pages").select("page_id", "url", "html")))
    nav = links.nav_links(found, "page_id")
    return nav.select("page_id", F.size("links").cast("long").alias("n"), F.element_at("links", 1)["pos"].alias("first_pos"), F.element_at("links", -1)["pos"].alias("last_pos"))


@query(r"""SELECT o_orderkey, o_orderkey % 97 || '/' || o_orderkey % 89 AS progress, CASE WHEN o_orderkey % 5 > 0 THEN '$' || CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) ELSE '' END AS price, left(sha256(CAST(o_orderkey AS VARCHAR)), 8) || '...' AS hash,
 CASE WHEN o_orderkey % 8 > 0 THEN CAST(o_orderkey % 8 * 125 // 10 AS VARCHAR) || '.' || CAST(o_orderkey % 8 * 125 % 10 AS VARCHAR) || '% complete' END AS complete FROM orders""")
def shown_texts(spark: SparkSession, d: str) -> DataFrame:
    """Progress, prices, hashes and percentages as text."""
    k = F.col("o_orderkey")
    price = F.when(k % 5 > 0, F.col("o_totalprice").cast("decimal(10,2)")).otherwise(F.lit(0).cast("decimal(10,2)"))
    done = F.when(k % 8 > 0, X.percent_text(k % 8, F.lit(8)))
    return table(spark, d, "orders").select("o_orderkey", X.progress_text(k % 97, k % 89).alias("progress"), X.price_text(price).alias("price"), X.hash_text(F.sha2(k.cast("string"), 256)).alias("hash"), done.alias("complete"))


@query(r"""SELECT page_id, CASE WHEN html LIKE '%$$$$%' THEN '$$$$' WHEN html LIKE '%$$$%' THEN '$$$' WHEN html LIKE '%$$%' THEN '$$' WHEN html LIKE '%$%' THEN '$' END AS band FROM pages""")
def price_band(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", X.price_band(F.col("html")).alias("band"))


@query(r"""WITH a AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hrefs FROM pages)
 SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, hrefs[i] AS href FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM a) t""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    bounded_pages(spark)
    return links.anchors(table(spark, d, "pages").select("page_id", "html")).select("page_id", "pos", "href")


@query(r"""WITH a AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/]*)', 1) AS root, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hrefs FROM pages), f AS (SELECT page_id, root, hrefs[i] AS href, CAST(i - 1 AS INTEGER) AS pos FROM (SELECT page_id, root, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM a) t),
 u AS (SELECT page_id, pos, root, CASE WHEN starts_with(href, '/') THEN root || href ELSE href END AS url FROM f)
 SELECT page_id, pos, CASE WHEN length(url) > length(root) + 1 THEN regexp_replace(regexp_replace(url, '[;?#].*$', ''), '/$', '') ELSE regexp_replace(url, '[;?#].*$', '') END AS link, starts_with(url, root) AS internal FROM u WHERE NOT regexp_matches(url, '""" + SKIPPED_SQL + """')""")
def link_split(spark: SparkSession, d: str) -> DataFrame:
    """Absolute links, inside or outside the page's host, without skipped ones."""
    bounded_pages(spark)
    found = links.resolved(links.anchors(table(spark, d, "pages").select("page_id", "url", "html")))
    return found.select("page_id", "pos", "link", "internal")


WINE_SQL = "SELECT unnest([" + ",".join("'" + w.replace("'", "''") + "'" for w in links.KEYWORDS["wine"]["en"]) + "]) AS w, unnest(range(30, 0, -1)) AS weight"
#: Phrases by which the fixture's titles become link texts.
TEXTS = ("Wine List", "beverage program", "Our cellar", "menus", "drinks menu and more")


@query(f"""WITH k AS ({WINE_SQL}), t AS (SELECT page_id, lower(x) AS title, lower('/' || replace(x, ' ', '-') || '/' || page_id) AS href FROM (SELECT page_id, CASE CAST(page_id % 6 AS INTEGER) {" ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(TEXTS))} ELSE regexp_extract(html, '<title>([^<]*)</title>', 1) END AS x FROM pages) p)
 SELECT page_id, CAST(sum(weight * (CASE WHEN title = w THEN 10 WHEN contains(title, w) THEN 5 ELSE 0 END + CASE WHEN contains(href, replace(w, ' ', '-')) THEN 3 ELSE 0 END)) AS INTEGER) AS score FROM t CROSS JOIN k GROUP BY page_id""")
def link_scores(spark: SparkSession, d: str) -> DataFrame:
    """The ranked weights of all keywords."""
    text = F.coalesce(F.get(F.array(*map(F.lit, TEXTS)), (F.col("page_id") % 6).cast("int")), F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    href = F.lower(F.concat(F.lit("/"), F.replace(text, F.lit(" "), F.lit("-")), F.lit("/"), F.col("page_id").cast("string")))
    return table(spark, d, "pages").select("page_id", links.wine_score(F.lower(text), href).alias("score"))


@query()
def page_text(spark: SparkSession, d: str) -> DataFrame:
    bounded_pages(spark)
    texts = table(spark, d, "pages").withColumn("t", pagetext.page_texts("html"))
    return texts.select("page_id", pagetext.chosen(F.col("t")).alias("text"), X.is_spa_shell(F.col("html"), F.col("t.visible")).alias("is_spa"), "t.title")


@query("""SELECT user_id, count(*) AS attempts, count(*) FILTER (WHERE event_type = 'error') AS failures, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY user_id""")
def job_rollup(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.groupBy("user_id").agg(count("attempts"), F.count_if(F.col("event_type") == "error").alias("failures"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))


@query("""WITH a AS (SELECT user_id, event_id, ts, event_type = 'error' AS bad, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
 b AS (SELECT *, CASE WHEN bad THEN sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) ELSE 0 END AS r FROM a)
 SELECT event_id, CAST(CASE WHEN r > 0 THEN (r - 1) % 3 + 1 ELSE 0 END AS BIGINT) AS run, bad AND r % 3 = 0 AS trips FROM b""")
def circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    found = lifecycle.breaker(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")
    return found.select("event_id", F.col("run").cast("long").alias("run"), "trips")


def listings(spark: SparkSession, d: str) -> DataFrame:
    li, o, c = load(spark, d, "lineitem", "orders", "customer")
    rows = li.select("l_partkey", "l_orderkey", "l_extendedprice", "l_quantity").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.join(c.select("c_custkey", "c_mktsegment", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))


BASE_SQL = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"


@query(f"""SELECT l_partkey, CAST(sum({WEIGHT_SQL}) AS DOUBLE) AS score, count(*) AS n FROM {BASE_SQL} GROUP BY l_partkey""")
def rank_scores(spark: SparkSession, d: str) -> DataFrame:
    found = ranking.scores(listings(spark, d), "l_partkey", "c_custkey", "c_mktsegment", WEIGHTS)
    return found.select("l_partkey", F.col("score").cast("double").alias("score"), "n")


@query(f"""SELECT l_partkey, CAST(sum(w) AS DOUBLE) AS score, count(*) AS n FROM (SELECT DISTINCT l_partkey, c_custkey, {WEIGHT_SQL} AS w FROM {BASE_SQL}) t GROUP BY l_partkey""")
def rank_scores_venues(spark: SparkSession, d: str) -> DataFrame:
    found = ranking.scores(listings(spark, d), "l_partkey", "c_custkey", "c_mktsegment", WEIGHTS, "venues")
    return found.select("l_partkey", F.col("score").cast("double").alias("score"), "n")


@query(f"""WITH s AS (SELECT c_nationkey, l_partkey, sum({WEIGHT_SQL}) AS score FROM {BASE_SQL} GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY score DESC, l_partkey) AS place, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY score DESC) AS dense FROM s)
 SELECT c_nationkey, l_partkey, CAST(score AS DOUBLE) AS score, CAST(place AS INTEGER) AS place, CAST(dense AS INTEGER) AS dense FROM r WHERE place <= 10""")
def rank_top_region(spark: SparkSession, d: str) -> DataFrame:
    rows = listings(spark, d)
    weight = ranking.coefficient(F.col("c_mktsegment"), WEIGHTS)
    scored = rows.groupBy("c_nationkey", "l_partkey").agg(F.sum(weight).cast("decimal(28,1)").alias("score"))
    return ranking.top_per(scored, "c_nationkey", "l_partkey").withColumn("score", F.col("score").cast("double"))


@query(f"""WITH s AS (SELECT l_partkey, sum({WEIGHT_SQL}) AS score FROM {BASE_SQL} GROUP BY 1), p AS (SELECT p_partkey, first_value(p_partkey) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS other FROM part)
 SELECT p_partkey AS item, other, CASE WHEN a.score > b.score THEN 'better' WHEN a.score < b.score THEN 'worse' WHEN a.score = b.score THEN 'equal' END AS verdict FROM p LEFT JOIN s a ON a.l_partkey = p_partkey LEFT JOIN s b ON b.l_partkey = other""")
def rank_compare(spark: SparkSession, d: str) -> DataFrame:
    """D4r: every item against the first one of its brand."""
    s = ranking.scores(listings(spark, d), "l_partkey", "c_custkey", "c_mktsegment", WEIGHTS)
    p = table(spark, d, "part")
    first = p.groupBy("p_brand").agg(F.min("p_partkey").alias("other"))
    return ranking.versus(s, p.join(first, "p_brand").select(F.col("p_partkey").alias("item"), "other"), "l_partkey")


@query(f"""WITH s AS (SELECT l_partkey, sum({WEIGHT_SQL}) AS score FROM {BASE_SQL} GROUP BY 1)
 SELECT l_partkey, CAST(score AS DOUBLE) AS score, rank() OVER (ORDER BY score DESC) AS place, dense_rank() OVER (ORDER BY score DESC) AS dense, percent_rank() OVER (ORDER BY score) AS share_below, percent_rank() OVER (ORDER BY score DESC) AS percent_rank FROM s""")
def rank_of_items(spark: SparkSession, d: str) -> DataFrame:
    """D2r: the place of every item among all, and how popular it is."""
    s = ranking.scores(listings(spark, d), "l_partkey", "c_custkey", "c_mktsegment", WEIGHTS)
    return ranking.places(s, "l_partkey").withColumn("score", F.col("score").cast("double"))


@query(f"""WITH s AS (SELECT p_type, l_partkey, sum({WEIGHT_SQL}) AS score FROM {BASE_SQL} JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY score DESC, l_partkey) AS place FROM s)
 SELECT p_type, l_partkey, CAST(score AS DOUBLE) AS score FROM r WHERE place = 1""")
def rank_best_of_kind(spark: SparkSession, d: str) -> DataFrame:
    """D3r: the best item of each kind."""
    s = ranking.scores(listings(spark, d), "l_partkey", "c_custkey", "c_mktsegment", WEIGHTS).drop("n")
    typed = s.join(table(spark, d, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    return ranking.top_per(typed, "p_type", "l_partkey", 1).select("p_type", "l_partkey", F.col("score").cast("double").alias("score"))


@query("""WITH r AS (SELECT n_name, l_orderkey, l_linenumber, l_extendedprice / l_quantity AS price, row_number() OVER (PARTITION BY n_name ORDER BY l_extendedprice / l_quantity DESC, l_orderkey, l_linenumber) AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
 SELECT n_name, l_orderkey, l_linenumber, round(price, 4) AS price FROM r WHERE k = 1""")
def most_expensive_by_country(spark: SparkSession, d: str) -> DataFrame:
    """D5r: of each country; before the join with venues one listing an order is left."""
    li, o, c, n = load(spark, d, "lineitem", "orders", "customer", "nation")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    best = F.max_by(F.struct("l_orderkey", "l_linenumber", "price"), F.struct("price", -F.col("l_orderkey"), -F.col("l_linenumber"))).alias("x")
    per = li.withColumn("price", price).groupBy("l_orderkey").agg(best).select("x.*")
    rows = per.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    top = rows.groupBy("c_nationkey").agg(best)
    return top.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "x.l_orderkey", "x.l_linenumber", F.round("x.price", 4).alias("price"))


@query("""WITH r AS (SELECT p_brand, l_orderkey, l_linenumber, l_extendedprice / l_quantity AS price, row_number() OVER (PARTITION BY p_brand ORDER BY l_extendedprice / l_quantity DESC, l_orderkey, l_linenumber) AS k FROM lineitem JOIN part ON l_partkey = p_partkey)
 SELECT p_brand, l_orderkey, l_linenumber, round(price, 4) AS price FROM r WHERE k = 1""")
def most_expensive(spark: SparkSession, d: str) -> DataFrame:
    li, p = load(spark, d, "lineitem", "part")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    rows = li.join(p.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).withColumn("price", price)
    best = F.max_by(F.struct("l_orderkey", "l_linenumber", "price"), F.struct("price", -F.col("l_orderkey"), -F.col("l_linenumber"))).alias("x")
    return rows.groupBy("p_brand").agg(best).select("p_brand", "x.l_orderkey", "x.l_linenumber", F.round("x.price", 4).alias("price"))


@query(f"""WITH s AS (SELECT l_partkey, sum({WEIGHT_SQL}) AS score FROM {BASE_SQL} GROUP BY 1), c AS (SELECT o_custkey, l.l_partkey, score FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN s ON l.l_partkey = s.l_partkey WHERE l_extendedprice / l_quantity < 1200),
 r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, l_partkey) AS k FROM c) SELECT o_custkey, l_partkey, CAST(score AS DOUBLE) AS score FROM r WHERE k = 1""")
def best_under_price(spark: SparkSession, d: str) -> DataFrame:
    s = ranking.scores(listings(spark, d), "l_partkey", "c_custkey", "c_mktsegment", WEIGHTS).drop("n")
    li, o = load(spark, d, "lineitem", "orders")
    low = li.where(F.col("l_extendedprice") / F.col("l_quantity") < 1200).select("l_orderkey", "l_partkey")
    cheap = low.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey")
    best = F.max_by(F.struct("l_partkey", "score"), F.struct("score", -F.col("l_partkey"))).alias("x")
    return cheap.join(s, "l_partkey").groupBy("o_custkey").agg(best).select("o_custkey", "x.l_partkey", F.col("x.score").cast("double").alias("score"))


@query(r"""SELECT array_to_string(list_sort(list_filter(string_split(regexp_replace(regexp_replace(lower(p_name), '\b(19|20)\d\d\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')), ' ') AS entity, min(p_partkey) AS first_id, count(*) AS n FROM part GROUP BY 1""")
def entity_groups(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy(ranking.entity_key(F.col("p_name")).alias("entity")).agg(F.min("p_partkey").alias("first_id"), count("n"))
