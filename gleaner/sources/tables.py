"""Sources and sinks: Parquet tables, whole files, JDBC, text and table snapshots."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import pagetext
from gleaner.functions import scalars as X


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_table(spark: SparkSession, url: str, name: str, key: str | None = None, low: int = 0, high: int = 0, parts: int = 15) -> DataFrame:
    """A database table; with ``key`` and its range, read over ``parts`` connections."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).option("fetchsize", 10_000)
    if key:
        reader = reader.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    return reader.load()


#: Pages of an Arrow batch: each goes to Python with what is made of it, and comes back several times as long.
PAGE_ROWS = 500


def bounded_pages(spark: SparkSession, rows: int = PAGE_ROWS) -> None:
    """For queries, not operators: bound the Arrow batches of the session to ``rows`` rows, for each task holds
    a batch of whole pages with its results. A smaller bound of the user's stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return folder or own_folder(spark.sparkContext.master)


def own_folder(master: str) -> str:
    """A local folder, where all of Spark runs in this process; an error on a cluster, whose
    executors would not share it."""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "gleaner-checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, content, size, sha256, kind, error): whole files. Unknown kinds carry an error."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    low = F.lower("path")
    kind = F.when(low.endswith(".pdf"), "pdf").when(low.rlike(r"\.html?$"), "html")
    error = F.when(kind.isNull(), F.concat(F.lit("Unsupported file type: "), F.regexp_extract("path", r"(\.[^./]*)?$", 0)))
    return found.select("path", "content", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), kind.alias("kind"), error.alias("error"))


def wanted_files(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(path)`` with its file, or with the error that there is none."""
    missing = F.concat(F.lit("File not found: "), F.col("path"))
    joined = wanted.join(found.withColumn("_there", F.lit(True)), "path", "left")
    return joined.withColumn("error", F.when(F.col("_there").isNull(), missing).otherwise(F.col("error"))).drop("_there")


def as_text(content: F.Column) -> F.Column:
    """Bytes as UTF-8; what is not valid is replaced."""
    return F.make_valid_utf8(content.cast("string"))


def file_texts(found: DataFrame) -> DataFrame:
    """``files`` with ``text``: of a page the chosen text; of other kinds none, and
    an error, for documents need a reader that is not part of this library."""
    page = F.when(F.col("kind") == "html", as_text(F.col("content")))
    read = found.withColumn("_t", pagetext.page_texts(page))
    none = F.when(F.col("kind") == "pdf", "no reader for documents")
    return read.withColumns({"text": F.when(F.col("kind") == "html", pagetext.chosen(F.col("_t"))), "error": F.coalesce("error", none)}).drop("_t")


def preferred_file(found: DataFrame, folder: str = "folder", name: str = "wine_list.pdf") -> DataFrame:
    """Of each folder's documents the one with the preferred name, else the first."""
    rank = F.struct(F.when(F.element_at(F.split("path", "/"), -1) == name, 0).otherwise(1), F.col("path"))
    return found.where(F.endswith("path", F.lit(".pdf"))).groupBy(folder).agg(F.min_by("path", rank).alias("path"))


def text_path(path: F.Column) -> F.Column:
    """The text's place beside its source."""
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", ""), F.lit(".txt"))


def downloads(responses: DataFrame, folder: str) -> DataFrame:
    """``responses(slug, url, content, content_type)`` with the place, the
    hash of the raw bytes and the size of each download. A page is stored as UTF-8."""
    named = X.download_name(F.col("url"), F.col("content_type"))
    rows = responses.withColumn("_n", named)
    stored = F.when(F.col("_n.extension") == ".html", F.encode(as_text(F.col("content")), "UTF-8")).otherwise(F.col("content"))
    place = F.concat_ws("/", F.lit(folder), X.safe_filename(F.col("slug")), F.col("_n.filename"))
    return rows.select(*responses.columns, place.alias("local_file_path"), F.sha2("content", 256).alias("file_hash"), F.length(stored).cast("long").alias("file_size"))


def known_content(new: DataFrame, lists: DataFrame) -> DataFrame:
    """The rows of ``new(file_hash)`` whose content a list of ``lists`` has already."""
    return new.join(lists.select("file_hash").distinct(), "file_hash", "left_semi")


def write_texts(texts: DataFrame, folder: str) -> None:
    """``texts(path, text)`` as text files, in a folder for each source's name."""
    name = F.element_at(F.split(text_path(F.col("path")), "/"), -1)
    texts.where(F.col("text").isNotNull()).select(F.col("text").alias("value"), name.alias("name")).write.mode("overwrite").partitionBy("name").option("lineSep", "\n").text(folder)


def snapshot(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """A table's next state, written whole to a new folder below ``path`` and read back,
    so a state may be made from the one before."""
    place = f"{path}/state-{uuid.uuid4().hex}"
    df.write.parquet(place, compression=compression)
    return df.sparkSession.read.parquet(place)


@dataclass(frozen=True)
class Settings:
    """Limits and defaults, each overridden by an environment variable of its name."""

    level: str = "3"
    site_depth: int = 4
    site_pages: int = 20
    concurrency: int = 3
    download_dir: str = "data/downloads"
    use_search: bool = True

    @classmethod
    def from_environment(cls, prefix: str = "GLEANER_", environment: Mapping[str, str] | None = None) -> Settings:
        given = {k.upper(): v for k, v in (os.environ if environment is None else environment).items()}
        found = {}
        for f in fields(cls):
            text = given.get(f"{prefix}{f.name}".upper())
            if text is not None:
                kind = type(f.default)
                found[f.name] = text.strip().lower() in ("1", "true", "yes", "on") if kind is bool else kind(text)
        return cls(**found)
