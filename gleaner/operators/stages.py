"""The crawl as stages of tables: from pages and files that were fetched to venues, lists and
jobs. Every stage is a table for all venues at once; what a venue skips, it is not in."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import scalars as X
from gleaner.operators import guide, lifecycle, links
from gleaner.sources.tables import cut


def site_graph(pages: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """What ``lifecycle.traverse`` walks, from ``pages(site, url, html, language)``, whose urls are in
    normal form: of each page its best document, its external links by falling score, each
    with where it leads (``others(link, html)`` are pages of other hosts), and its scored links."""
    spark = pages.sparkSession
    others = spark.createDataFrame([], "link string, html string") if others is None else others
    keyed = pages.withColumn("page", F.struct("site", "url"))
    found = cut(links.resolved(links.anchors(keyed.select("page", "url", "language", "html"))))
    language = F.col("language")
    every = links.anchors(keyed.select("page", "url", "language", "html")).withColumn("abs_url", X.join_url("url", "href"))
    best = links.best_document(every, "page", language).select("page", F.col("url").alias("found"))
    outside = links.external_links(found, language)
    leads = links.linked_page(outside, others, "page")
    scored = outside.join(leads, ["page", "pos"])
    itself = X.is_pdf(F.col("abs_url")) | X.is_platform(F.col("abs_url")) | X.is_download(F.col("abs_url"))
    one = F.struct((-F.col("score")).alias("order"), "pos", F.col("link").alias("url"), "result", (~itself).alias("loads"))
    external = scored.groupBy("page").agg(F.transform(F.sort_array(F.collect_list(one)), lambda x: F.struct(x["url"].alias("url"), x["result"].alias("result"), x["loads"].alias("loads"))).alias("external"))
    inner = links.internal_links(found, language)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("pos", "score", F.col("link").alias("url")))), lambda x: F.struct(x["score"].alias("score"), x["url"].alias("url")))
    below = inner.groupBy("page").agg(listed.alias("links"))
    return keyed.select("page").join(best, "page", "left").join(external, "page", "left").join(below, "page", "left").select("page.site", "page.url", "found", "external", "links")


def crawl(
    venues: DataFrame, jobs: DataFrame, lists: DataFrame, wanted: DataFrame, site_pages: DataFrame, searches: DataFrame, files: DataFrame,
    at: Column | datetime, force: bool = False, depth: int = 4, budget: int = 20, failure_stays: bool = False,
) -> dict[str, DataFrame]:
    """The stages after the guide's pages: ``wanted(job_id, id)`` are the venues of running jobs.
    ``site_pages(link, html)`` holds fetched pages by normal url, ``searches`` what searches for
    a venue's ``key`` (its id) gave, ``files(url, local_file_path, file_hash)`` what was
    downloaded from a url. Returns the next ``venues``, ``jobs`` and ``lists``, and ``routes``: the
    status, list and way of each venue. With ``failure_stays`` a venue whose first download
    failed counts as failed even if the search's one did not."""
    at = F.lit(at)
    rows = cut(wanted.join(venues, "id"))
    plan = rows.withColumn("route", lifecycle.route_after_process(F.lit(True), F.col("website_url"), F.col("crawl_status"), F.lit(force)))
    going = plan.where("route = 'crawl'")
    # crawl: the walk of each site, over its own host's pages
    home = going.select(F.col("id").cast("string").alias("site"), X.normalize_url(F.col("website_url")).alias("url"), X.domain(F.col("website_url")).alias("host"), X.language_of(F.col("country")).alias("language"))
    by_host = site_pages.withColumn("host", X.domain(F.col("link")))
    graph = site_graph(home.join(by_host, "host").select("site", F.col("link").alias("url"), "language", "html"), site_pages)
    steps = cut(lifecycle.traverse(graph, home.select("site", "url"), depth, budget))
    walked = steps.groupBy(F.col("site").cast("int").alias("id")).agg(F.max("result").alias("walked"), F.count(F.lit(1)).cast("int").alias("pages"))
    reachable = site_pages.select(F.col("link").alias("_link")).distinct()
    known = going.withColumn("_link", X.normalize_url(F.col("list_url"))).join(reachable.withColumn("_there", F.lit(True)), "_link", "left").select("id", "_there")
    crawled = plan.join(walked, "id", "left").join(known, "id", "left").withColumn("found", F.when(F.col("route") == "crawl", links.first_found(F.col("list_url"), F.col("_there"), F.col("walked"))))
    # search: for those without a list, and once for those whose download failed
    hub = links.two_passes(searches, "key", "name").select(F.col("key").cast("int").alias("id"), F.col("url").alias("searched_url"))
    got = files.select(F.col("url").alias("_url"), F.col("local_file_path").alias("_path"), F.col("file_hash").alias("_hash")).dropDuplicates(["_url"])
    taken = lambda df, url, path: df.join(got.select(F.col("_url").alias(url), F.col("_path").alias(path), F.col("_hash").alias(f"{path}_hash")), url, "left")
    state = taken(taken(crawled.join(hub, "id", "left"), "found", "first_path"), "searched_url", "second_path")
    skipped = F.col("route") == "save"
    again = F.col("first_path").isNull() & ~skipped
    url = F.when(again, F.col("searched_url")).otherwise(F.col("found"))
    path = F.when(again, F.col("second_path")).otherwise(F.col("first_path"))
    hashed = F.when(again, F.col("second_path_hash")).otherwise(F.col("first_path_hash"))
    first_failed = F.col("found").isNotNull() & F.col("first_path").isNull()
    failed = (path.isNull() & (first_failed | url.isNotNull())) | (first_failed & F.lit(failure_stays))
    cost = F.when(F.col("route") == "crawl", F.lit(0)).cast("decimal(10,2)")
    results = cut(state.select(
        "id", "job_id", "name", F.when(~skipped, url).alias("list_url"), F.when(~skipped, path).alias("local_file_path"), hashed.alias("file_hash"),
        failed.alias("download_failed"), "website_url", F.when(skipped, F.col("crawl_status")).alias("crawl_status"), cost.alias("crawl_duration_seconds"),
        F.lit(0).alias("llm_tokens_used"), F.coalesce("pages", F.lit(0)).alias("pages_visited"), F.when(skipped, "skipped").when(again & F.col("searched_url").isNotNull(), "search").when(F.col("found").isNotNull(), "site").otherwise("none").alias("way"),
    ))
    fresh = results.where("local_file_path IS NOT NULL").select(F.col("id").alias("venue_id"), F.concat("name", F.lit(" Wine List")).alias("list_name"), F.col("list_url").alias("source_url"), "local_file_path", "file_hash")
    status = F.when(F.col("way") == "skipped", F.col("crawl_status")).otherwise(lifecycle.outcome(F.col("list_url"), F.col("local_file_path"), F.col("download_failed"), F.col("website_url")))
    return {
        "venues": lifecycle.save_results(venues, results.drop("job_id", "name", "way", "file_hash"), at), "jobs": lifecycle.job_progress(jobs, results),
        "lists": lifecycle.insert(lists, fresh, "lists", "local_file_path", at), "routes": results.select("id", "job_id", status.alias("status"), "list_url", "way"),
    }


def guide_stage(venues: DataFrame, pages: DataFrame, site_id: int, site_name: str, at: Column | datetime) -> DataFrame:
    """Venue pages of a guide, ``pages(url, html)``, in the table of venues."""
    read = guide.venue_pages(pages, site_name=F.lit(site_name)).withColumnRenamed("url", "guide_url")
    return lifecycle.upsert_venues(venues, read.withColumn("site_id", F.lit(site_id)), at)
