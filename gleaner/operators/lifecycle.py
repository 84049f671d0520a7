"""The job lifecycle as columns and snapshots: routes, outcomes, inserts, upserts, paging.

Every change of a table is a new snapshot of it. '' and 0 count as missing, as null does."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import schema
from gleaner.functions import scalars as X
from gleaner.functions.scalars import nullif_blank

#: Statuses that the rules below name, and texts that mean a crash.
FOUND, FAILED, NO_LIST, NO_WEBSITE, HAS_WEBSITE = "wine_list_found", "download_list_failed", "no_wine_list", "no_website", "has_website"
CRASHES = ("Page crashed", "Page closed")
SHOWN_ERRORS, MESSAGE_CHARS, PER_PAGE = 20, 2000, 48


def has(c: Column) -> Column:
    return nullif_blank(c).isNotNull()


def yes(c: Column) -> Column:
    return F.coalesce(c.cast("boolean"), F.lit(False))


# columns: outcomes and routes


def outcome(list_url: Column, path: Column, failed: Column, website: Column) -> Column:
    """The status of a venue after a crawl; a list counts as found if it has both a
    url and a file."""
    return (
        F.when(yes(failed), FAILED)
        .when(has(list_url) & has(path), FOUND)
        .when(has(list_url), FAILED)
        .when(has(website), NO_LIST)
        .otherwise(NO_WEBSITE)
    )


def skipped(status: Column, force: Column) -> Column:
    """A venue whose list was found is not crawled again unless forced."""
    return F.coalesce(status == FOUND, F.lit(False)) & ~yes(force)


def untouched(status: Column, duration: Column) -> Column:
    """A venue that was skipped, so its result is not saved: found before, no new crawl."""
    return F.coalesce(status == FOUND, F.lit(False)) & duration.isNull()


def route_after_process(venue: Column, website: Column, status: Column, force: Column) -> Column:
    return F.when(~yes(venue) | skipped(status, force), "save").when(has(website), "crawl").otherwise("search")


def route_after_crawl(venue: Column, list_url: Column) -> Column:
    return F.when(~yes(venue), "save").when(has(list_url), "download").otherwise("search")


def route_after_download(venue: Column, path: Column, failed: Column, searched: Column) -> Column:
    """The search is tried once for a venue."""
    return F.when(yes(venue) & has(path) & ~yes(failed), "extract").when(yes(venue) & yes(failed) & ~yes(searched), "search").otherwise("save")


def route_after_search(venue: Column, list_url: Column) -> Column:
    return F.when(yes(venue) & has(list_url), "download").otherwise("save")


def route_after_save(index: Column, urls: Column, page: Column, pages: Column, failures: Column | None = None, most: Column | None = None) -> Column:
    """The next venue, the next page, or none. Where ``most`` failures in a row skipped a
    page, ``page`` is already the one after it."""
    failures = F.coalesce(F.lit(None).cast("int") if failures is None else failures, F.lit(0))
    most = F.coalesce(F.lit(None).cast("int") if most is None else most, F.lit(3))
    tripped = (failures >= most) & (urls == 0)
    return (
        F.when(tripped, F.when((pages > 0) & (page <= pages), "next_page").otherwise("done"))
        .when(index < urls, "next_venue")
        .when((pages > 0) & (page + 1 <= pages), "next_page")
        .otherwise("done")
    )


def searched_once(searched: Column, name: Column, enabled: Column, url: Column) -> Column:
    """struct(searched, list_url) after the search step: it counts as tried even if it is
    disabled or the name is blank, and then leaves the list's url as it is."""
    tried = ~yes(searched) & yes(enabled) & (F.coalesce(X.strip(name), F.lit("")) != "")
    return F.struct(F.lit(True).alias("searched"), tried.alias("replaces"), F.when(tried, nullif_blank(url)).alias("list_url"))


def crawl_metrics(seconds: Column, tokens: Column, pages: Column) -> Column:
    """What a crawl cost, also if it failed."""
    return F.struct(X.half_even(seconds).cast("decimal(10,2)").alias("crawl_duration_seconds"), F.coalesce(tokens, F.lit(0)).alias("llm_tokens_used"), F.coalesce(pages, F.lit(0)).alias("pages_visited"))


# snapshots


def insert(old: DataFrame, new: DataFrame, name: str, key: str, at: Column | datetime) -> DataFrame:
    """M1: ``old`` and ``new`` rows with new ids in the order of ``key``, the table's defaults,
    and ``at`` for its times of creation, start, download and update."""
    at, rows = F.lit(at), schema.next_ids(new, old, key)
    for c, kind in old.dtypes:
        if c not in rows.columns:
            now = c in ("created_at", "started_at", "downloaded_at", "last_updated_at")
            rows = rows.withColumn(c, at if now else F.lit(None).cast(kind))
    return old.unionByName(schema.with_defaults(rows.select([F.col(c).cast(kind).alias(c) for c, kind in old.dtypes]), name))


def upsert(old: DataFrame, new: DataFrame, key: str, refreshed: list[str]) -> DataFrame:
    """The next snapshot of ``old``: known keys get the ``refreshed`` columns where the
    new value is not missing, unknown keys are added whole. ``new`` has a key once."""
    n = new.select(*[F.col(c).alias(f"_{c}") for c in new.columns])
    joined = old.join(n, F.col(key) == F.col(f"_{key}"), "full_outer")
    known = F.col(key).isNotNull()
    out = []
    for c in old.columns:
        fresh = F.col(f"_{c}") if c in new.columns else F.lit(None)
        merged = F.coalesce(nullif_blank(fresh), F.col(c)) if c in refreshed else F.col(c)
        out.append(F.when(known, merged).otherwise(fresh).alias(c))
    return joined.select(out)


ADDRESS = ("address", "city", "state", "zip_code", "country")


def upsert_venues(venues: DataFrame, pages: DataFrame, at: Column | datetime) -> DataFrame:
    """M2: venue pages ``pages(guide_url, name, ..., site_id)`` in the table of venues: of a known
    guide url the first venue's address is refreshed and nothing else, others are inserted."""
    at = F.lit(at)
    given = [c for c in ADDRESS if c in pages.columns]
    first = venues.where(F.col("guide_url").isNotNull()).groupBy("guide_url").agg(F.min("id").alias("_known"))
    fresh = pages.dropDuplicates(["guide_url"]).join(first, "guide_url", "left")
    known = fresh.where(F.col("_known").isNotNull()).select("_known", *[F.col(c).alias(f"_{c}") for c in given])
    joined = venues.join(known, F.col("id") == F.col("_known"), "left")
    kept = joined.withColumns({c: F.coalesce(nullif_blank(F.col(f"_{c}")), F.col(c)) for c in given} | {"last_updated_at": F.when(F.col("_known").isNotNull(), at).otherwise(F.col("last_updated_at"))}).select(venues.columns)
    new = fresh.where(F.col("_known").isNull()).drop("_known").withColumn("crawl_status", F.when(has(F.col("website_url")), HAS_WEBSITE).otherwise(NO_WEBSITE))
    return insert(kept, new, "venues", "guide_url", at)


def update(old: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """M3: ``old`` with the columns of ``changes`` (a key once) where those are not null."""
    n = changes.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in changes.columns if c != key])
    joined = old.join(n, F.col(key) == F.col("_key"), "left")
    return joined.select([F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in changes.columns and c != key else F.col(c) for c in old.columns])


def save_results(venues: DataFrame, results: DataFrame, at: Column | datetime) -> DataFrame:
    """The venues after crawls, one of ``results(id, list_url, local_file_path, download_failed,
    website_url, crawl_status, crawl_duration_seconds, llm_tokens_used, pages_visited)`` a venue. The list's
    url is kept where none was found; skipped venues are not touched."""
    at = F.lit(at)
    done = results.where(~untouched(F.col("crawl_status"), F.col("crawl_duration_seconds")) & F.col("id").isNotNull())
    found = outcome(F.col("list_url"), F.col("local_file_path"), F.col("download_failed"), F.col("website_url"))
    changes = done.select(
        "id", F.when(found.isin(FOUND, FAILED), F.col("list_url")).alias("list_url"), found.alias("crawl_status"), at.alias("last_crawled_at"), at.alias("last_updated_at"),
        "crawl_duration_seconds", "llm_tokens_used", "pages_visited",
    )
    return update(venues, changes)


def job_progress(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Counters of ``jobs`` after ``results(job_id, id, local_file_path, download_failed)``: every
    result of a venue counts as processed, skipped ones too; a page without one does not."""
    got = F.count_if(has(F.col("local_file_path")) & ~yes(F.col("download_failed")))
    counts = results.where(F.col("id").isNotNull()).groupBy("job_id").agg(F.count(F.lit(1)).alias("_done"), got.alias("_got"))
    joined = jobs.join(counts, F.col("id") == F.col("job_id"), "left")
    more = lambda c, n: (F.col(c) + F.coalesce(F.col(n), F.lit(0))).cast("int")
    return joined.withColumns({"venues_processed": more("venues_processed", "_done"), "lists_downloaded": more("lists_downloaded", "_got")}).select(jobs.columns)


def start_jobs(jobs: DataFrame, requests: DataFrame, sites: DataFrame, at: Column | datetime, level: str = "3") -> tuple[DataFrame, DataFrame]:
    """(jobs, errors) after ``requests(request, job_id, site_id, level)``. A known job runs
    again as it is; else a new one of the site is inserted. errors(request, error): requests
    without a site, or with one that does not exist."""
    known = jobs.select(F.col("id").alias("job_id"))
    again = requests.join(known, "job_id", "left_semi").select(F.col("job_id").alias("id"), F.lit("running").alias("status")).distinct()
    fresh = requests.join(known, "job_id", "left_anti")
    named = fresh.join(sites.select(F.col("id").alias("_site")), F.col("site_id") == F.col("_site"), "left")
    error = F.when(~has(F.col("site_id")), "site_id is required for new jobs").when(F.col("_site").isNull(), F.concat(F.lit("Site of record id="), F.col("site_id").cast("string"), F.lit(" not found")))
    named = named.withColumn("error", error)
    new = named.where(F.col("error").isNull()).select("request", "site_id", X.or_default(F.col("level"), level).alias("level"), F.lit("running").alias("status"))
    return insert(update(jobs, again), new, "jobs", "request", at), named.where(F.col("error").isNotNull()).select("request", "error")


def finished(jobs: DataFrame, changes: DataFrame, at: Column | datetime) -> DataFrame:
    """``jobs`` with the status and message of ``changes(id, status, error_message)``, and their end; one join."""
    n = changes.select(F.col("id").alias("_key"), F.col("status").alias("_status"), F.col("error_message").alias("_message"))
    ended, at = F.col("_key").isNotNull(), F.lit(at)
    seconds = F.when(F.col("started_at").isNotNull(), X.seconds_between(F.col("started_at"), at))
    after = {
        "status": F.coalesce("_status", "status"), "error_message": F.coalesce("_message", "error_message"), "completed_at": F.when(ended, at).otherwise(F.col("completed_at")),
        "duration_seconds": F.coalesce(F.when(ended, seconds), F.col("duration_seconds")),
    }
    return jobs.join(n, F.col("id") == F.col("_key"), "left").withColumns(after).select(jobs.columns)


def error_text(errors: Column, most: int = SHOWN_ERRORS) -> Column:
    """The first errors, a line each; null for none."""
    return F.when(F.size(errors) > 0, F.array_join(F.slice(errors, 1, most), "\n"))


def complete_jobs(jobs: DataFrame, ended: DataFrame, at: Column | datetime) -> DataFrame:
    """The jobs of ``ended(id, errors)`` are completed."""
    return finished(jobs, ended.select("id", F.lit("completed").alias("status"), error_text(F.col("errors")).alias("error_message")), at)


def fail_jobs(jobs: DataFrame, failed: DataFrame, at: Column | datetime) -> DataFrame:
    """Those jobs of ``failed(id, message)`` that run have failed."""
    running = jobs.where("status = 'running'").select("id")
    changes = failed.join(running, "id", "left_semi").select("id", F.lit("failed").alias("status"), F.left("message", F.lit(MESSAGE_CHARS)).alias("error_message"))
    return finished(jobs, changes, at)


def summary(job: Column, processed: Column, downloaded: Column, names: Column) -> Column:
    """One line on a job, with the sorted names of the venues that had a list."""
    counts = F.format_string("Job %s complete – %s restaurants processed, %s wine lists downloaded", job.cast("string"), processed.cast("string"), downloaded.cast("string"))
    named = F.concat(F.lit(": "), F.array_join(F.sort_array(names), ", "))
    return F.concat(counts, F.when((downloaded > 0) & (F.size(names) > 0), named).otherwise(""))


def register_lists(venues: DataFrame, lists: DataFrame, found: DataFrame, at: Column | datetime) -> tuple[DataFrame, DataFrame]:
    """M5: (venues, lists) after lists found by hand, ``found(venue_id, local_file_path, file_hash,
    text_file_path)``: each becomes a list of its venue, whose status is found. A venue without
    a list's url gives the source 'manual'; unknown venues are left out."""
    at = F.lit(at)
    named = found.join(venues.select(F.col("id").alias("venue_id"), "name", "list_url"), "venue_id")
    new = named.select("venue_id", F.concat("name", F.lit(" Wine List")).alias("list_name"), X.or_default(F.col("list_url"), "manual").alias("source_url"), "local_file_path", "file_hash", "text_file_path")
    changes = named.select(F.col("venue_id").alias("id"), F.lit(FOUND).alias("crawl_status"), at.alias("last_updated_at")).distinct()
    return update(venues, changes), insert(lists, new, "lists", "local_file_path", at)


#: The guide's sites by country, the last part of their url, and how to move in them.
SITE_URL = "https://guide.michelin.com/us/en/selection/{}/restaurants"
SITES = {"USA": "united-states", "Canada": "canada", "Mexico": "mexico", "Denmark": "denmark", "France": "france", "Spain": "spain"}
NOTES = (
    "Base URL for restaurants. Use distinction filters:\n- 3-stars: /3-stars-michelin\n- 2-stars: /2-stars-michelin\n"
    "- 1-star: /1-star-michelin\n- Bib Gourmand: /bib-gourmand\n- Selected: /the-plate-michelin\nPagination: /page/N"
)


def seed_sites(sites: DataFrame, at: Column | datetime) -> DataFrame:
    """``sites`` and those of the fixed ones whose name is not there."""
    rows = [(k, X.SITE_PREFIX + country, SITE_URL.format(slug), NOTES) for k, (country, slug) in enumerate(SITES.items())]
    seeds = sites.sparkSession.createDataFrame(rows, "place int, site_name string, site_url string, navigational_notes string")
    return insert(sites, seeds.join(sites.select("site_name"), "site_name", "left_anti"), "sites", "place", at)


# ordered state


def breaker(attempts: DataFrame, key: str, order: list[str], failed: Column, most: int = 3) -> DataFrame:
    """Each attempt with ``run``, the failures in a row up to it, and ``trips``: the
    run reached a multiple of ``most``, after which counting starts again."""
    w = Window.partitionBy(key).orderBy(*order)
    island = F.sum(F.when(failed, 0).otherwise(1)).over(w)
    rows = attempts.withColumns({"_failed": failed, "_island": island})
    run = F.sum(F.col("_failed").cast("int")).over(Window.partitionBy(key, "_island").orderBy(*order))
    rows = rows.withColumn("_run", F.when(F.col("_failed"), run).otherwise(0))
    return rows.withColumns({
        "run": F.when(F.col("_run") > 0, (F.col("_run") - 1) % most + 1).otherwise(0),
        "trips": F.col("_failed") & (F.col("_run") % most == 0),
    }).drop("_failed", "_island", "_run")


def fetch_listings(attempts: DataFrame, most: int = 3, retry_first: bool = True) -> DataFrame:
    """The paging of jobs, from ``attempts(job_id, attempt, urls, pages, error)``: how many
    urls a fetched page had and of how many pages it was one, or the error. Every
    attempt up to the end of its job gives a row (job_id, attempt, page, failures, error, restarts, current_page, total_pages,
    venues_found, route): the page, the failures in a row, whether
    the browser restarts, the state after it and what comes next. After ``most`` failures
    a page is skipped. ``retry_first``: a first page that failed is tried again; without it
    the job ends there, since it has no number of pages yet.

    All is counted by windows over a job's attempts: a page that had urls and a skipped one each move on by one, so the
    page of an attempt is one more than those before it; a job ends with the first attempt after which nothing
    comes."""
    failed, urls = F.col("error").isNotNull(), F.coalesce("urls", F.lit(0)).cast("int")
    rows = breaker(attempts.select("job_id", "attempt", "urls", "pages", "error"), "job_id", ["attempt"], failed, most)
    so_far = Window.partitionBy("job_id").orderBy("attempt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("job_id").orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    moves = ((~failed & (urls > 0)) | F.col("trips")).cast("int")
    rows = rows.withColumn("page", (1 + F.coalesce(F.sum(moves).over(before), F.lit(0))).cast("int"))
    reached = F.when(~failed, F.col("page")).when(F.col("trips"), F.col("page") + 1)
    first = F.when(~failed & (F.col("page") == 1), F.coalesce("pages", F.lit(0)).cast("int"))
    rows = rows.withColumns({
        "current_page": F.coalesce(F.last(reached, ignorenulls=True).over(so_far), F.lit(1)), "total_pages": F.coalesce(F.last(first, ignorenulls=True).over(so_far), F.lit(0)),
        "venues_found": F.sum(F.when(~failed, urls).otherwise(0)).over(so_far).cast("int"),
    })
    total, at = F.col("total_pages"), F.col("current_page")
    more = F.when(~failed, at + 1 <= total).when(F.col("trips"), (total > 0) & (at <= total)).otherwise(((total > 0) & (at + 1 <= total)) | (F.lit(retry_first) & (total == 0)))
    rows = rows.withColumn("_more", more)
    told = F.concat(F.lit("Page "), F.col("page").cast("string"), F.lit(" attempt "), F.col("run").cast("string"), F.lit(": "), F.col("error"))
    crashed = F.coalesce(F.exists(F.array(*map(F.lit, CRASHES)), lambda x: F.contains(F.col("error"), x)), F.lit(False))
    ended = F.coalesce(F.sum((~F.col("_more")).cast("int")).over(before), F.lit(0))
    return rows.withColumn("_ended", ended).where("_ended = 0").select(
        "job_id", "attempt", "page", F.col("run").cast("int").alias("failures"), told.alias("error"), crashed.alias("restarts"), "current_page", "total_pages", "venues_found",
        F.when(F.col("_more"), "next_page").otherwise("done").alias("route"),
    )


def single_listings(requests: DataFrame, resolved: DataFrame) -> DataFrame:
    """Jobs for one venue, ``requests(job_id, wanted)`` with ``resolved(wanted, id)``: a page of one
    venue that is read from the table, or an error."""
    joined = requests.join(resolved.select("wanted", "id"), "wanted", "left")
    there = F.col("id").isNotNull()
    missing = F.concat(F.lit("Restaurant not found for filter: "), F.col("wanted"))
    return joined.select("job_id", "id", there.cast("int").alias("venues_found"), F.lit(1).alias("total_pages"), F.when(~there, missing).alias("error"))


def traverse(graph: DataFrame, starts: DataFrame, depth: int = 4, budget: int = 20) -> DataFrame:
    """Best-first walks of sites over ``graph(site, url, found, external, links)`` from
    ``starts(site, url)``. Returns (site, step, url, depth, result). A page's own result
    ``found`` ends its site's walk; then the first of its ``external(url, result)`` that has
    one, each of which counts as a page; then its ``links(score, url)`` are followed, depth
    first, by falling score in document order. No page twice, at most ``budget`` pages, levels
    below ``depth``. One site is one group, for the order depends on all before it."""

    def walk(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        pages = {r.url: r for r in left.itertuples(index=False)}
        out, seen, loaded, ended = [], set(), 0, False
        for site, start in right[["site", "url"]].itertuples(index=False):
            stack = [(start, 0)]
            while stack and not ended:
                url, at = stack.pop()
                if at >= depth or loaded >= budget or url in seen:
                    continue
                seen.add(url)
                if url not in pages:
                    continue
                loaded += 1
                page, result = pages[url], None
                if isinstance(page.found, str):
                    result = page.found
                for link in page.external if result is None and page.external is not None else []:
                    if link["loads"] and (link["url"] in seen or loaded >= budget):
                        continue
                    if link["loads"]:
                        seen.add(link["url"])
                        loaded += 1
                    if link["result"] is not None:
                        result = link["result"]
                        break
                out.append((site, len(out), url, at, result))
                ended = result is not None
                links = sorted(page.links if page.links is not None else [], key=lambda x: -x["score"])
                stack += [(x["url"], at + 1) for x in reversed(links)]
        return pd.DataFrame(out, columns=["site", "step", "url", "depth", "result"])

    return graph.groupBy("site").cogroup(starts.groupBy("site")).applyInPandas(walk, "site string, step int, url string, depth int, result string")
