"""What the dashboards show: rows of venues, items, lists, jobs and sites, ready to print."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import scalars as X


def text(name: str, missing: str = "") -> Column:
    """A column as it is shown: ``missing`` for null and ''."""
    return X.or_default(F.col(name).cast("string"), missing).alias(name)


def venues(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """A row a venue, with its site's name."""
    joined = rows.join(sites.select(F.col("id").alias("_site"), "site_name"), F.col("site_id") == F.col("_site"), "left")
    return joined.select(
        F.coalesce("site_name", F.lit("—")).alias("site"), "id", "name", *[text(c) for c in ("distinction", "address", "city", "state", "zip_code", "country", "cuisine", "price_range")],
        F.col("crawl_status").alias("status"), X.tick(F.col("list_url")).alias("has_list"), X.duration_of_crawl(F.col("crawl_duration_seconds")).alias("crawl_time"),
        X.or_default(F.col("llm_tokens_used"), 0).alias("llm_tokens"), X.or_default(F.col("pages_visited"), 0).alias("pages"), X.day_text(F.col("last_crawled_at")).alias("last_crawled"),
    )


def items(rows: DataFrame) -> DataFrame:
    """``rows`` of items, each with its venue's name ``venue``."""
    return rows.select("id", "name", *[text(c) for c in ("maker", "varietal", "item_type", "vintage", "country", "region")], X.price_text(F.col("price")).alias("price"), "venue")


def jobs(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """A row a job."""
    joined = rows.join(sites.select(F.col("id").alias("_site"), "site_name"), F.col("site_id") == F.col("_site"), "left")
    return joined.select(
        "id", F.coalesce("site_name", F.lit("N/A")).alias("site"), "job_type", text("level", "N/A"), "status", X.progress_text(F.col("venues_processed"), F.col("venues_found")).alias("progress"),
        F.col("lists_downloaded").alias("lists"), X.duration_in_table(F.col("duration_seconds")).alias("duration"), X.minute_text(F.col("started_at")).alias("started"),
    )


def job_details(rows: DataFrame) -> DataFrame:
    """The lines of a job's own box."""
    return rows.select(
        "id", X.second_text(F.col("started_at")).alias("started"), X.second_text(F.col("completed_at")).alias("completed"), X.duration_of_job(F.col("duration_seconds")).alias("duration"),
        X.percent_text(F.col("venues_processed"), F.col("venues_found")).alias("complete"),
    )


def lists(rows: DataFrame) -> DataFrame:
    """A row a list."""
    return rows.select("id", text("list_name", "Unnamed"), "source_url", "local_file_path", "text_file_path", F.col("item_count").alias("items"), X.day_text(F.col("downloaded_at")).alias("downloaded"), X.hash_text(F.col("file_hash")).alias("hash"))


def sites(rows: DataFrame) -> DataFrame:
    return rows.select("id", "site_name", "site_url", text("navigational_notes"), X.day_text(F.col("created_at")).alias("created"), X.minute_text(F.col("last_visited_at")).alias("last_visited"))
