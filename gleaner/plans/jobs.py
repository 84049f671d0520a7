"""Registered queries on the changes of jobs, venues, lists and sites, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import schema
from gleaner.functions import scalars as X
from gleaner.operators import lifecycle
from gleaner.plans.reports import load, query


def at() -> Column:
    return F.lit("2024-01-01").cast("timestamp")


def rows_of(df: DataFrame, table_name: str, /, **columns: Column) -> DataFrame:
    """``df`` in the schema of a table: the given columns, nulls and defaults for the others."""
    kinds = dict(x.split() for x in schema.SCHEMAS[table_name].split(", "))
    return schema.with_defaults(df.select([columns.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]), table_name)


JOB_SQL = "SELECT s_suppkey * 2 + 1 AS id, s_nationkey + 1 AS site_id, CASE WHEN s_suppkey % 3 = 0 THEN 'failed' ELSE 'completed' END AS status, CASE WHEN s_suppkey % 2 = 0 THEN '2' ELSE '3' END AS level FROM supplier"


@query(f"""WITH j AS ({JOB_SQL}), r AS (SELECT o_orderkey AS request, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey END AS job_id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 28 + 1 END AS site_id, CASE CAST(o_orderkey % 3 AS INTEGER) WHEN 0 THEN '' WHEN 1 THEN 'gourmand' END AS level FROM orders WHERE o_orderdate < '1996-01-01'),
 k AS (SELECT r.*, n_nationkey + 1 AS site FROM r LEFT JOIN nation ON site_id = n_nationkey + 1 WHERE job_id IS NULL OR job_id NOT IN (SELECT id FROM j)),
 n AS (SELECT (SELECT max(id) FROM j) + row_number() OVER (ORDER BY request) AS id, site_id, 'running' AS status, coalesce(nullif(level, ''), '3') AS level FROM k WHERE site IS NOT NULL)
 SELECT id, site_id, CASE WHEN id IN (SELECT job_id FROM r WHERE job_id IS NOT NULL) THEN 'running' ELSE status END AS status, level, NULL AS error FROM j UNION ALL SELECT id, site_id, status, level, NULL FROM n
 UNION ALL SELECT request, site_id, 'refused', NULL, CASE WHEN site_id IS NULL THEN 'site_id is required for new jobs' ELSE 'Site of record id=' || site_id || ' not found' END FROM k WHERE site IS NULL""")
def started_jobs(spark: SparkSession, d: str) -> DataFrame:
    """Jobs after requests to run known ones again or to start new ones, and the requests that were refused."""
    s, o, n = load(spark, d, "supplier", "orders", "nation")
    k = F.col("s_suppkey")
    jobs = rows_of(s, "jobs", id=k * 2 + 1, site_id=F.col("s_nationkey") + 1, status=F.when(k % 3 == 0, "failed").otherwise("completed"), level=F.when(k % 2 == 0, "2").otherwise("3"))
    sites = rows_of(n, "sites", id=F.col("n_nationkey") + 1, site_name=F.col("n_name"))
    r = F.col("o_orderkey")
    requests = o.where("o_orderdate < '1996-01-01'").select(r.alias("request"), F.when(r % 4 == 0, F.col("o_custkey")).cast("int").alias("job_id"), F.when(r % 7 != 0, F.col("o_custkey") % 28 + 1).cast("int").alias("site_id"), F.when(r % 3 == 0, "").when(r % 3 == 1, "gourmand").alias("level"))
    after, errors = lifecycle.start_jobs(jobs, requests, sites, at())
    refused = errors.join(requests.select("request", "site_id"), "request").select(F.col("request").alias("id"), "site_id", F.lit("refused").alias("status"), F.lit(None).cast("string").alias("level"), "error")
    return after.select(F.col("id").cast("long").alias("id"), "site_id", "status", "level", F.lit(None).cast("string").alias("error")).unionByName(refused)


@query("""WITH r AS (SELECT o_custkey AS job_id, CASE WHEN o_orderkey % 6 > 0 THEN o_orderkey END AS id, CASE CAST(o_orderkey % 3 AS INTEGER) WHEN 0 THEN '' WHEN 1 THEN '/p' END AS path, CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS failed FROM orders)
 SELECT c_custkey AS id, CAST(c_custkey % 4 + count(r.id) AS INTEGER) AS venues_processed, CAST(c_custkey % 3 + count(*) FILTER (WHERE r.id IS NOT NULL AND path <> '' AND NOT coalesce(failed, FALSE)) AS INTEGER) AS lists_downloaded FROM customer LEFT JOIN r ON job_id = c_custkey GROUP BY c_custkey""")
def job_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters of jobs after the results of their venues; pages without a venue do not count."""
    c, o = load(spark, d, "customer", "orders")
    k = F.col("o_orderkey")
    jobs = rows_of(c, "jobs", id=F.col("c_custkey"), venues_processed=F.col("c_custkey") % 4, lists_downloaded=F.col("c_custkey") % 3)
    results = o.select(F.col("o_custkey").cast("int").alias("job_id"), F.when(k % 6 > 0, k).alias("id"), F.when(k % 3 == 0, "").when(k % 3 == 1, "/p").alias("local_file_path"), F.when(k % 5 == 0, True).when(k % 5 == 1, False).alias("download_failed"))
    return lifecycle.job_progress(jobs, results).select(F.col("id").cast("long").alias("id"), "venues_processed", "lists_downloaded")


@query("""WITH v AS (SELECT c_custkey AS id, c_name AS name, CASE CAST(c_custkey % 3 AS INTEGER) WHEN 0 THEN '' WHEN 1 THEN 'http://l/' || c_custkey END AS url FROM customer WHERE c_custkey % 2 = 0), l AS (SELECT s_suppkey AS id, s_name AS list_name FROM supplier),
 f AS (SELECT o_orderkey, o_custkey, '/m/' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS path, sha256(CAST(o_orderkey AS VARCHAR)) AS h FROM orders WHERE o_orderkey % 5 = 0)
 SELECT id, list_name, NULL AS source_url, NULL AS file_hash FROM l UNION ALL SELECT (SELECT max(id) FROM l) + row_number() OVER (ORDER BY path), name || ' Wine List', coalesce(nullif(url, ''), 'manual'), h FROM f JOIN v ON o_custkey = id""")
def lists_by_hand(spark: SparkSession, d: str) -> DataFrame:
    """M5: lists after those that were found by hand, with new ids in the order of their files."""
    c, s, o = load(spark, d, "customer", "supplier", "orders")
    k = F.col("c_custkey")
    venues = rows_of(c.where("c_custkey % 2 = 0"), "venues", id=k, name=F.col("c_name"), list_url=F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("http://l/"), k.cast("string"))))
    lists = rows_of(s, "lists", id=F.col("s_suppkey"), list_name=F.col("s_name"))
    n = F.col("o_orderkey").cast("string")
    found = o.where("o_orderkey % 5 = 0").select(F.col("o_custkey").cast("int").alias("venue_id"), F.concat(F.lit("/m/"), F.lpad(n, 9, "0")).alias("local_file_path"), F.sha2(n, 256).alias("file_hash"), F.lit(None).cast("string").alias("text_file_path"))
    return lifecycle.register_lists(venues, lists, found, at())[1].select(F.col("id").cast("long").alias("id"), "list_name", "source_url", "file_hash")


@query("""WITH v AS (SELECT c_custkey AS id, c_nationkey FROM customer WHERE c_nationkey % 5 <> 1), l AS (SELECT o_orderkey AS id FROM orders JOIN v ON o_custkey = v.id), i AS (SELECT l_orderkey FROM lineitem JOIN l ON l_orderkey = l.id)
 SELECT 'sites' AS name, count(*) AS n, CAST(NULL AS BIGINT) AS loose FROM nation WHERE n_nationkey % 5 <> 1 UNION ALL SELECT 'venues', count(*), NULL FROM v UNION ALL SELECT 'lists', count(*), NULL FROM l UNION ALL SELECT 'items', count(*), NULL FROM i
 UNION ALL SELECT 'jobs', count(*), count(*) FILTER (WHERE s_nationkey % 5 = 1) FROM supplier""")
def cascaded_deletes(spark: SparkSession, d: str) -> DataFrame:
    """M6: what is left of every table after sites were deleted: venues, lists and items go along, jobs lose their site."""
    n, c, o, li, s = load(spark, d, "nation", "customer", "orders", "lineitem", "supplier")
    tables = {
        "sites": n.select(F.col("n_nationkey").alias("id")), "venues": c.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("site_id")), "lists": o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("venue_id")),
        "items": li.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("list_id")), "jobs": s.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("site_id")),
    }
    after = schema.delete_cascade(tables, "sites", n.where("n_nationkey % 5 = 1").select(F.col("n_nationkey").alias("id")))
    found = None
    for name, rows in after.items():
        loose = F.count_if(F.col("site_id").isNull()) if name == "jobs" else F.lit(None).cast("long")
        part = rows.agg(F.count(F.lit(1)).alias("n"), loose.alias("loose")).select(F.lit(name).alias("name"), "n", "loose")
        found = part if found is None else found.unionByName(part)
    return found


@query("""WITH v AS (SELECT c_custkey AS id, 'g/' || c_custkey // 2 AS guide, CASE WHEN c_custkey % 4 = 0 THEN 'old' END AS city FROM customer WHERE c_custkey % 3 <> 2), f AS (SELECT guide, min(id) AS first FROM v GROUP BY 1),
 p AS (SELECT 'g/' || o_custkey AS guide, CASE CAST(o_custkey % 3 AS INTEGER) WHEN 0 THEN '' WHEN 1 THEN 'c' || o_custkey END AS city, CASE WHEN o_custkey % 2 = 0 THEN 'w' END AS web FROM orders GROUP BY o_custkey),
 n AS (SELECT p.*, first FROM p LEFT JOIN f USING (guide))
 SELECT v.id, v.guide AS guide_url, coalesce(nullif(n.city, ''), v.city) AS city, 'pending' AS crawl_status FROM v LEFT JOIN n ON n.first = v.id UNION ALL SELECT (SELECT max(id) FROM v) + row_number() OVER (ORDER BY guide), guide, city, CASE WHEN web = 'w' THEN 'has_website' ELSE 'no_website' END FROM n WHERE first IS NULL""")
def upserted_venues(spark: SparkSession, d: str) -> DataFrame:
    """M2: venues after pages of the guide: of a known page the first venue's address is refreshed, others are new venues."""
    c, o = load(spark, d, "customer", "orders")
    k, n = F.col("c_custkey"), F.col("o_custkey")
    guide = lambda x: F.concat(F.lit("g/"), x.cast("string"))
    venues = rows_of(c.where("c_custkey % 3 <> 2"), "venues", id=k, guide_url=guide(F.floor(k / 2)), city=F.when(k % 4 == 0, "old"))
    pages = o.select("o_custkey").distinct().select(guide(n).alias("guide_url"), F.lit("name").alias("name"), F.when(n % 3 == 0, "").when(n % 3 == 1, F.concat(F.lit("c"), n.cast("string"))).alias("city"), F.when(n % 2 == 0, "w").alias("website_url"), F.lit(1).alias("site_id"))
    return lifecycle.upsert_venues(venues, pages, at()).select(F.col("id").cast("long").alias("id"), "guide_url", "city", "crawl_status")


@query("""WITH s AS (SELECT n_nationkey AS id, 'Michelin Guide ' || n_name[1] || lower(n_name[2:]) AS site_name FROM nation WHERE n_nationkey % 2 = 0), f AS (SELECT unnest(range(6)) AS k, 'Michelin Guide ' || unnest(['USA', 'Canada', 'Mexico', 'Denmark', 'France', 'Spain']) AS site_name)
 SELECT id, site_name, replace(site_name, 'Michelin Guide ', '') AS country FROM s UNION ALL SELECT (SELECT max(id) FROM s) + row_number() OVER (ORDER BY k), site_name, replace(site_name, 'Michelin Guide ', '') FROM f WHERE site_name NOT IN (SELECT site_name FROM s)""")
def seeded_sites(spark: SparkSession, d: str) -> DataFrame:
    """Sites after those of the fixed ones that were missing, with their countries."""
    (n,) = load(spark, d, "nation")
    sites = rows_of(n.where("n_nationkey % 2 = 0"), "sites", id=F.col("n_nationkey"), site_name=F.concat(F.lit(X.SITE_PREFIX), F.initcap("n_name")))
    return lifecycle.seed_sites(sites, at()).select(F.col("id").cast("long").alias("id"), "site_name", X.country_of(F.col("site_name")).alias("country"))


URL_FORM_SQL = "url_base || CASE CAST(page_id % 8 AS INTEGER) WHEN 0 THEN '/download/Wine.PDF' WHEN 1 THEN '/menu/list.html' WHEN 2 THEN '/a/download/12' WHEN 3 THEN '/cellar/download/x.pdf?y=1' WHEN 4 THEN '/.pdf' WHEN 5 THEN '/deep/dir/' WHEN 6 THEN '/ca%20rte.htm' ELSE '' END"


@query(rf"""WITH b AS (SELECT page_id, 'https://' || CASE WHEN page_id % 3 = 0 THEN 'wine' ELSE 'x' END || page_id % 9 || '.example.org' AS url_base FROM pages), u AS (SELECT page_id, {URL_FORM_SQL} AS url, CASE CAST(page_id % 5 AS INTEGER) WHEN 0 THEN 'text/html' WHEN 1 THEN 'application/pdf' WHEN 2 THEN 'Application/PDF+html' ELSE NULL END AS kind FROM b),
 p AS (SELECT *, lower(coalesce(kind, '')) AS k, regexp_replace(regexp_extract(url, '^https://[^/]*(.*)$', 1), '\?.*$', '') AS raw FROM u), q AS (SELECT *, trim(url_decode(raw)) AS path FROM p),
 f AS (SELECT *, regexp_matches(lower(path), '\.html?$') AS html, CASE WHEN regexp_matches(lower(path), '\.html?$') THEN '.html' ELSE '.pdf' END AS first, regexp_extract(path, '([^/]*)$', 1) AS base FROM q),
 n AS (SELECT *, CASE WHEN html OR ends_with(lower(path), '.pdf') THEN CASE WHEN base IN ('', first) THEN 'wine_list' || first ELSE base END ELSE 'wine_list.pdf' END AS name, CASE WHEN first = '.pdf' AND contains(k, 'html') AND NOT contains(k, 'pdf') THEN '.html' WHEN first = '.html' AND contains(k, 'pdf') THEN '.pdf' END AS last FROM f)
 SELECT page_id, contains(lower(path), '/download') AND regexp_matches(lower(url), 'wine|beverage|cellar|sommelier|list') AS is_download, coalesce(last, first) AS extension, CASE WHEN last IS NULL THEN name ELSE regexp_replace(name, '\.[^.]*$', '') || last END AS filename FROM n""")
def download_names(spark: SparkSession, d: str) -> DataFrame:
    """Which urls are downloads, and the names and extensions of their files by url and content type."""
    (p,) = load(spark, d, "pages")
    k = F.col("page_id")
    forms = ("/download/Wine.PDF", "/menu/list.html", "/a/download/12", "/cellar/download/x.pdf?y=1", "/.pdf", "/deep/dir/", "/ca%20rte.htm", "")
    base = F.concat(F.lit("https://"), F.when(k % 3 == 0, "wine").otherwise("x"), (k % 9).cast("string"), F.lit(".example.org"))
    url = F.concat(base, F.get(F.array(*map(F.lit, forms)), (k % 8).cast("int")))
    kind = F.when(k % 5 == 0, "text/html").when(k % 5 == 1, "application/pdf").when(k % 5 == 2, "Application/PDF+html")
    rows = p.select("page_id", url.alias("u"), kind.alias("kind"))
    return rows.select("page_id", X.is_download(F.col("u")).alias("is_download"), X.download_name(F.col("u"), F.col("kind")).alias("n")).select("page_id", "is_download", "n.extension", "n.filename")
