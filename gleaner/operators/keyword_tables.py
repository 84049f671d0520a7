"""Thousands of phrases looked for in all texts, each text being read once.

The phrases of a table become one Aho-Corasick automaton, which goes through a text in one pass and tells
every phrase that it holds, whatever their number. Tasks get the automaton's phrases by a broadcast of checked
size: a table of over ``CHARACTERS`` is dealt by hash into rounds of about that many, each with a pass of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHARACTERS = 20_000_000


def automaton(phrases: list[tuple[int, str]]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for number, phrase in phrases:
        found.add_word(phrase, number)
    found.make_automaton()
    return found


def scan(texts: DataFrame, phrases: Broadcast) -> DataFrame:
    """(id, number, times) of ``texts(id, text)``: which phrases of the broadcast list each text holds, and how often, overlaps included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(phrases.value)
        for batch in batches:
            rows, numbers, times = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist() if len(machine) else ()):
                held = Counter(number for _, number in machine.iter(text)) if text else {}
                rows += [row] * len(held)
                numbers += held.keys()
                times += held.values()
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int64()), pa.array(times, pa.int64())], ["id", "number", "times"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "text").mapInArrow(run, f"id {kind}, number long, times long")


def phrases_in(texts: DataFrame, table: DataFrame, characters: int = CHARACTERS) -> DataFrame:
    """(id, phrase, times): for ``texts(id, text)`` and ``table(phrase)`` each phrase that a text holds as it stands (fold both for other
    rules), and how often. Null and empty phrases and texts hold and are held by nothing; equal phrases are one;
    rows of equal ids are not told apart, but each is counted."""
    wanted = table.where(F.col("phrase") != "").select("phrase").distinct().withColumn("number", F.xxhash64("phrase"))
    twice = wanted.groupBy("number").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError("two phrases have one hash")
    size = wanted.agg(F.coalesce(F.sum(F.length("phrase") + 1), F.lit(0))).first()[0]
    rounds, found = max(1, math.ceil(size / characters)), None
    for r in range(rounds):
        rows = wanted.where(F.pmod("number", F.lit(rounds)) == r).select("number", "phrase").collect()  # about ``characters``
        part = scan(texts, texts.sparkSession.sparkContext.broadcast([tuple(x) for x in rows]))
        found = part if found is None else found.unionByName(part)
    return found.join(wanted, "number").select("id", "phrase", "times")


def phrase_counts(texts: DataFrame, table: DataFrame, characters: int = CHARACTERS) -> DataFrame:
    """(phrase, texts, times): in how many rows each distinct phrase of ``table`` stands, and how often; zeros where in none."""
    held = phrases_in(texts, table, characters).groupBy("phrase").agg(F.count(F.lit(1)).alias("texts"), F.sum("times").alias("times"))
    every = table.where(F.col("phrase") != "").select("phrase").distinct()
    return every.join(held, "phrase", "left").na.fill(0, ["texts", "times"])
