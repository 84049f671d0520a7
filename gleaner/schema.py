"""Fixed schemas of the venue and list tables, their enums, defaults and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.sources.tables import cut

#: Fixed values.
CRAWL_STATUS = ("pending", "has_website", "no_website", "wine_list_found", "no_wine_list", "download_list_failed", "error")
JOB_STATUS = ("pending", "running", "completed", "failed", "cancelled")
DISTINCTIONS = ("3-stars", "2-stars", "1-star", "bib-gourmand", "selected")

SCHEMAS = {
    "sites": "id int, site_name string, site_url string, navigational_notes string, created_at timestamp, last_visited_at timestamp",
    "venues": "id int, name string, guide_url string, website_url string, list_url string, distinction string, address string, city string, state string, zip_code string, country string, cuisine string, price_range string, crawl_status string, last_crawled_at timestamp, last_updated_at timestamp, comment string, crawl_duration_seconds decimal(10,2), llm_tokens_used int, pages_visited int, site_id int",
    "lists": "id int, list_name string, source_url string, local_file_path string, text_file_path string, file_hash string, item_count int, downloaded_at timestamp, last_updated_at timestamp, comment string, venue_id int",
    "items": "id int, name string, maker string, varietal string, item_type string, country string, region string, plot string, vintage string, format string, price decimal(10,2), note string, list_id int",
    "jobs": "id int, job_type string, level string, status string, total_pages int, current_page int, venues_found int, venues_processed int, lists_downloaded int, started_at timestamp, completed_at timestamp, duration_seconds decimal(10,2), error_message string, site_id int",
}
DEFAULTS = {
    "venues": {"country": "USA", "crawl_status": "pending", "llm_tokens_used": 0, "pages_visited": 0},
    "lists": {"item_count": 0},
    "jobs": {"job_type": "crawler", "status": "pending", "total_pages": 0, "current_page": 0, "venues_found": 0, "venues_processed": 0, "lists_downloaded": 0},
}
ENUMS = {("venues", "crawl_status"): CRAWL_STATUS, ("venues", "distinction"): DISTINCTIONS, ("jobs", "status"): JOB_STATUS}
#: Child table, its key, parent table, and whether children go with the parent.
REFERENCES = (("venues", "site_id", "sites", True), ("lists", "venue_id", "venues", True), ("items", "list_id", "lists", True), ("jobs", "site_id", "sites", False))


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def with_defaults(df: DataFrame, name: str) -> DataFrame:
    return df.fillna({c: v for c, v in DEFAULTS.get(name, {}).items() if c in df.columns})


def violations(df: DataFrame, name: str) -> DataFrame:
    """(id, column, value) of enum values that are not allowed."""
    checks = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), (~F.col(c).isin(*allowed)).alias("bad")) for (t, c), allowed in ENUMS.items() if t == name]
    if not checks:
        return df.select("id", F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value")).limit(0)
    return df.select("id", F.explode(F.array(*checks)).alias("x")).where("x.bad").select("id", "x.column", "x.value")


def delete_cascade(tables: dict[str, DataFrame], name: str, ids: DataFrame) -> dict[str, DataFrame]:
    """All tables after the rows of ``name`` with these ``ids(id)`` were deleted:
    children go with their parents, optional references become null."""
    out = dict(tables)
    out[name] = out[name].join(ids, "id", "left_anti")
    for child, key, parent, goes in REFERENCES:
        if parent != name or child not in out:
            continue
        gone = ids.select(F.col("id").alias("_gone"))
        if goes:
            lost = out[child].join(gone, F.col(key) == F.col("_gone"), "left_semi").select("id")
            out = delete_cascade(out, child, lost)
        else:
            joined = out[child].join(gone, F.col(key) == F.col("_gone"), "left")
            out[child] = joined.withColumn(key, F.when(F.col("_gone").isNull(), F.col(key))).drop("_gone")
    return out


def next_ids(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """``new`` with ``id`` after the largest of ``old``, in the order of ``key``. The rows are
    sorted once, over ranges of the key, and written to the shared folder; only one
    count for each range is looked at to give each range its first id."""
    names = ("_part", "_place")
    rows = cut(new.drop("id").repartitionByRange(F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first()).withColumns({names[0]: F.spark_partition_id(), names[1]: F.monotonically_increasing_id()}))
    counts = rows.groupBy(names[0]).agg(F.count(F.lit(1)).alias("_n"), F.min(names[1]).alias("_low"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(names[0]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    top = old.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
    offsets = counts.select(names[0], (before - F.col("_low")).alias("_offset")).join(F.broadcast(top))
    numbered = rows.join(F.broadcast(offsets), names[0])
    kind = dict(old.dtypes)["id"]
    return numbered.select((F.col("_top") + F.col("_offset") + F.col("_place") + 1).cast(kind).alias("id"), *[c for c in new.columns if c != "id"])


def create(spark: SparkSession, name: str, database: str = "default") -> None:
    """An empty stored table, if there is none."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({SCHEMAS[name]}) USING parquet")


def drop(spark: SparkSession, name: str, database: str = "default") -> None:
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def reset(spark: SparkSession, database: str = "default") -> None:
    """All tables empty, children dropped before their parents."""
    for name in reversed(SCHEMAS):
        drop(spark, name, database)
    for name in SCHEMAS:
        create(spark, name, database)
