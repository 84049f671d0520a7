"""Which pages each site reaches by its own links, in a few steps.

Bulk-synchronous rounds over a table of links: each round joins the frontier, what the round before
was the first to reach, with the links, and anti-joins what is visited already. Every page is
parsed once, for all sites and rounds, and each round is written down before the next, so a
lost executor costs a task of one round, and the plan does not grow.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import scalars as X
from gleaner.operators import links as L
from gleaner.sources.tables import shared_folder


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst): the distinct links of ``pages(url, html)`` to their own hosts, both ends in normal form; a page without one has no row."""
    found = L.resolved(L.anchors(pages.select("url", "html"))).where(F.col("internal") & (F.col("link") != ""))
    return found.select(X.normalize_url(F.col("url")).alias("src"), F.col("link").alias("dst")).distinct()


def reachable(links: DataFrame, starts: DataFrame, steps: int = 4) -> DataFrame:
    """(site, page, step): every page that a site of ``starts(site, page)`` reaches over ``links(src, dst)``, and
    in how many steps at least; starts are reached in 0.

    Defined cases: a page with several starts of a site is reached by the nearest; sites do not hide pages from each
    other; loops and repeated links add nothing; rows with a null site, page, src or dst are left out;
    without starts there are no rows. Links to a page with many sites at it are joined in parts by AQE."""
    spark = links.sparkSession
    folder = f"{shared_folder(spark)}/reached-{uuid.uuid4().hex}"
    links.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct().write.parquet(f"{folder}/links")
    edges = spark.read.parquet(f"{folder}/links")

    def round_written(rows: DataFrame, step: int) -> DataFrame:
        rows.select("site", "page", F.lit(step).alias("step")).write.parquet(f"{folder}/step={step}")
        return spark.read.parquet(f"{folder}/step={step}")

    frontier = round_written(starts.select("site", "page").where("site IS NOT NULL AND page IS NOT NULL").distinct(), 0)
    visited = frontier
    for step in range(1, steps + 1):
        met = frontier.join(edges, F.col("page") == F.col("src")).select("site", F.col("dst").alias("page")).distinct()
        frontier = round_written(met.join(visited.select("site", "page"), ["site", "page"], "left_anti"), step)
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited
