"""The corpus pipeline: four stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``, and columns beyond those pass through them too.

Defined cases: in every stage an empty table gives no rows, texts of any length are
handled whole, and rows are told apart by their own, not by ids, so that rows without
an id or with a repeated one are documents of their own. A text that is null, or has no
letter, is in no language and goes in the first stage. Of rows that repeat both id and
text one stays in the second. What each operator does beyond that is in its module.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import chunks, language, packing, shingles
from gleaner.llm.common import bounded_batches, shared_folder, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, or that parse by their best language hardly
    better than its own letters in random order do."""
    bounded_batches(spark)
    return language.in_known_language(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the first by id stays; groups are linked by 0.8 or
    more of the five-word shingles."""
    bounded_batches(spark)
    return shingles.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; emptied documents go."""
    bounded_batches(spark)
    return chunks.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of what is left in a training sequence."""
    bounded_batches(spark)
    return packing.pack(docs, packing.vocabulary_path(), cached=150_000)  # the stages share the executors' memory


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack_sequences),
]
#: SQL cannot express these stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the ``documents`` of ``sf_dir``; the stages' tables stay in the
    shared folder, for the result is read from the last one."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
