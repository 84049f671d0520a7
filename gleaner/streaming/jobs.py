"""Structured Streaming forms of the job roll-up and the failure breaker.

A sink that is written by batches must bear that Spark runs the last batch again after a failure. ``rollup_into`` writes
the totals of each batch to a folder named by the batch's number, over whatever is there, so that a batch counts
once however often it runs; ``rolled_up`` adds the folders up. ``trips_in_order`` waits with each event until the watermark has
passed it, so that failures in a row are counted in the order of event time whatever order rows arrive in, and drops a key's state
by a timer once it has been quiet for ``idle_ms``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_events(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def rollup(events: DataFrame, key: str, failed: str) -> DataFrame:
    """Running counters per job, for complete or update mode."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.sum(F.expr(f"int({failed})")).alias("failures"), F.max("ts").alias("last_ts"))


def trips(events: DataFrame, key: str, failed: str, most: int = 3) -> DataFrame:
    """(key, event_id) of the attempts at which ``most`` failures in a row were
    reached, counted on across batches in the state store."""
    name, kind = key, dict(events.dtypes)[key]

    def count(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        run = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values("event_id")
        out = []
        for event, bad in zip(rows["event_id"], rows["bad"], strict=True):
            run = run + 1 if bad else 0
            if run == most:
                out.append((k[0], event))
                run = 0
        state.update((run,))
        yield pd.DataFrame(out, columns=[name, "event_id"])

    rows = events.select(key, "event_id", F.expr(failed).alias("bad"))
    return rows.groupBy(key).applyInPandasWithState(count, f"{key} {kind}, event_id long", "run int", "append", "NoTimeout")


def batch_totals(events: DataFrame, key: str, failed: str, value: str) -> DataFrame:
    """(key, attempts, failures, total): sums, of which those of parts can be added."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.sum(F.expr(f"int({failed})")).alias("failures"), F.sum(F.col(value).cast("decimal(18,4)")).cast("decimal(28,4)").alias("total"))


def rollup_into(events: DataFrame, folder: str, checkpoint: str, key: str, failed: str, value: str) -> StreamingQuery:
    """The totals of each batch of a stream, in ``folder``/batch=number; runs until all that is there was read."""

    def put(batch: DataFrame, number: int) -> None:
        batch_totals(batch, key, failed, value).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return events.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rolled_up(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """The sums over all batches."""
    parts = spark.read.option("basePath", folder).parquet(f"{folder}/batch=*")
    return parts.groupBy(key).agg(*[F.sum(c).alias(c) for c in ("attempts", "failures", "total")])


STATE = "run int, ts array<long>, ids array<long>, bad array<boolean>"


def trips_in_order(events: DataFrame, key: str, failed: str, delay: str = "10 minutes", most: int = 3, idle_ms: int = 86_400_000) -> DataFrame:
    """(key, event_id) of the attempts of ``events(key, event_id, ts)`` at which ``most`` failures in a row were reached, by (ts, event_id).
    Rows that come over ``delay`` late are dropped, as Spark's watermark does; a key that is quiet for ``idle_ms`` starts anew."""
    kind = dict(events.dtypes)[key]

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, ts, ids, bad = state.get if state.exists else (0, [], [], [])
        waiting = list(zip(ts, ids, bad, strict=True))
        if not state.hasTimedOut:
            for rows in frames:
                waiting += zip(rows["ms"].tolist(), rows["event_id"].tolist(), rows["bad"].tolist(), strict=True)
        passed, out = state.getCurrentWatermarkMs(), []
        waiting.sort()
        ready = [x for x in waiting if x[0] <= passed]
        for _, event, failure in ready:
            run = run + 1 if failure else 0
            if run == most:
                out.append((k[0], event))
                run = 0
        waiting = waiting[len(ready) :]
        if state.hasTimedOut and not waiting and not ready:
            state.remove()
        else:
            state.update((run, *([x[i] for x in waiting] for i in range(3))))
            state.setTimeoutTimestamp(max(passed + 1, waiting[0][0]) if waiting else max(passed, 0) + idle_ms)
        yield pd.DataFrame(out, columns=[key, "event_id"])

    rows = events.select(key, "event_id", "ts", F.unix_millis("ts").alias("ms"), F.expr(failed).alias("bad")).withWatermark("ts", delay)
    return rows.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, event_id long", STATE, "append", GroupStateTimeout.EventTimeTimeout)
