"""M2, M3, M6: stored tables of which a change rewrites only what it touches, and S1: changes of several tables that
become visible together.

A keyed table is a folder of partitions by the hash of its key. A change finds the partitions of its keys (at
most ``parts`` numbers), reads those alone, and puts their next rows in place by a dynamic partition
overwrite: files of all other partitions stay as they are. The next rows are written to the shared folder first, since they
are made from the files that they replace. Each partition holds a marker row, so that one that has lost all its rows is
overwritten too.

Readers of a keyed table can see a change half done, as with any overwrite in place. Where several tables must change
as one, ``Published`` keeps whole states instead: each commit writes new folders, and then one row that names all of
them; without that row the old states hold.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import lifecycle
from gleaner.sources.tables import cut

PARTS = 64


class Keyed:
    """The table in ``path``, with a row for each ``key``; see the module. A row without a key is kept, but no change finds it."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id", parts: int = PARTS) -> None:
        self.spark, self.path, self.key, self.parts = spark, path, key, parts

    def part_of(self, key: str) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(key), F.lit(self.parts)), F.lit(0)).cast("int")

    def create(self, rows: DataFrame) -> Keyed:
        self.put(rows, list(range(self.parts)))
        return self

    def read(self) -> DataFrame:
        return self.stored().where("_live").drop("_part", "_live")

    def stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def put(self, rows: DataFrame, touched: list[int]) -> None:
        """``rows`` become all that the partitions ``touched`` hold."""
        marker = self.spark.createDataFrame([(x,) for x in touched], "_part int").select(*[F.lit(None).cast(kind).alias(c) for c, kind in rows.dtypes], "_part", F.lit(False).alias("_live"))
        marked = rows.withColumns({"_part": self.part_of(self.key), "_live": F.lit(True)}).unionByName(marker)
        marked.repartition("_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(self.path)

    def change(self, keys: DataFrame, make: Callable[[DataFrame], DataFrame]) -> list[int]:
        """The partitions of ``keys(key)`` get the rows that ``make`` makes of theirs; their numbers are returned."""
        touched = sorted(r[0] for r in keys.where(F.col(self.key).isNotNull()).select(self.part_of(self.key).alias("p")).distinct().collect())  # at most ``parts``
        if touched:
            old = self.stored().where(F.col("_part").isin(touched) & F.col("_live")).drop("_part", "_live")
            self.put(cut(make(old)), touched)
        return touched

    def upsert(self, new: DataFrame, refreshed: list[str]) -> list[int]:
        """M2: known keys get the ``refreshed`` columns where the new value is not missing, unknown keys are added; ``new`` has a key once."""
        given = cut(new.where(F.col(self.key).isNotNull()))
        return self.change(given, lambda old: lifecycle.upsert(old, given, self.key, refreshed))

    def update(self, changes: DataFrame) -> list[int]:
        """M3: the columns of ``changes`` (a key once) where those are not null."""
        given = cut(changes.where(F.col(self.key).isNotNull()))
        return self.change(given, lambda old: lifecycle.update(old, given, self.key))

    def delete(self, keys: DataFrame) -> list[int]:
        given = cut(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct())
        return self.change(given, lambda old: old.join(given, self.key, "left_anti"))


def delete_cascade(parent: Keyed, keys: DataFrame, children: list[tuple[Keyed, str]]) -> None:
    """M6: the rows of ``keys`` go from ``parent``, and from each child those whose reference names one of them. A child that is partitioned
    by that reference is rewritten in part as well; of another one the rows' own keys are looked up first."""
    given = cut(keys.select(F.col(parent.key).alias("_gone")).where(F.col("_gone").isNotNull()).distinct())
    for child, reference in children:
        if child.key == reference:
            child.delete(given.select(F.col("_gone").alias(reference)))
        else:
            child.delete(child.read().join(given, F.col(reference) == F.col("_gone"), "left_semi").select(child.key))
    parent.delete(given.select(F.col("_gone").alias(parent.key)))


class Published:
    """The states of several tables, as of the last commit; one writer at a time.

    A commit writes each changed table to a folder of its own. Then a single row, which says where every table's state is,
    is added to the folder of commits: Spark moves the finished file there in one step, and readers take the row with the
    highest number. Whatever fails before leaves the old states; its folders are never read."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def last(self) -> tuple[int, dict[str, str]]:
        try:
            row = self.spark.read.schema("number long, places string").json(f"{self.path}/commits").orderBy(F.desc("number")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            row = None
        return (row["number"], json.loads(row["places"])) if row else (0, {})

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.spark.read.parquet(f"{self.path}/{place}") for name, place in self.last()[1].items()}

    def commit(self, make: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        """The states that ``make`` makes of the present ones become the present ones, all or none. Tables that it does
        not return stay."""
        number, places = self.last()
        for name, rows in make(self.tables()).items():
            places[name] = f"{name}/{uuid.uuid4().hex}"
            rows.write.parquet(f"{self.path}/{places[name]}")
        self.spark.createDataFrame([(number + 1, json.dumps(places))], "number long, places string").coalesce(1).write.mode("append").json(f"{self.path}/commits")
        return self.tables()
