"""The claim loop as a stream: micro-batches of fetched pages into a store, idempotently."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash
from ..sources.sinks import new_rows


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by type in windows of event time, with a bound on lateness."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


def store_stream(texts: DataFrame, path: str, checkpoint: str, digits: int = 3):
    """Append texts not stored yet; a batch that runs again adds nothing. Returns the started query.

    The store is partitioned by the first digits of the hash, and a batch reads the partitions that it may add to.
    """

    def upsert(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("content_hash", content_hash(F.col("text"))).withColumn("part", F.substring("content_hash", 1, digits))
        spark = batch.sparkSession
        try:
            stored = spark.read.parquet(path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            rows.dropDuplicates(["content_hash"]).write.mode("append").partitionBy("part").parquet(path)
            return
        parts = [r.part for r in rows.select("part").distinct().collect()]  # 16 ** digits at most
        known = stored.where(F.col("part").cast("string").isin(parts)).select("content_hash")
        new_rows(rows, known, "content_hash").write.mode("append").partitionBy("part").parquet(path)

    return texts.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(texts: DataFrame) -> DataFrame:
    """Texts whose hash no earlier batch had, by the state store; the horizon is unbounded, so it suits keys that are few."""
    return texts.withColumn("content_hash", content_hash(F.col("text"))).dropDuplicates(["content_hash"])


def due_retries(failures: DataFrame, late: str = "10 minutes") -> DataFrame:
    """url and due of failed fetches (url, at, delay in seconds), each once event time has passed its due time.

    A later failure of a URL replaces the earlier one's due time.
    """

    def wait(key, batches, state):
        import pandas as pd

        if state.hasTimedOut:
            (due,) = state.get
            state.remove()
            yield pd.DataFrame({"url": [key[0]], "due": [pd.Timestamp(due, unit="ms")]})
            return
        last = max((row for rows in batches for row in zip(rows["at"], rows["delay"], strict=True)), key=lambda r: r[0])
        due = int(last[0].timestamp() * 1000 + last[1] * 1000)
        state.update((due,))
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    return failures.withWatermark("at", late).groupBy("url").applyInPandasWithState(wait, "url string, due timestamp", "due long", "append", "EventTimeTimeout")


def fresh_values(updates: DataFrame, ttl_seconds: int = 86_400, late: str = "10 minutes") -> DataFrame:
    """key, value and live: a row when a key's value changes, and one with live false when it's older than the TTL."""

    def keep(key, batches, state):
        import pandas as pd

        if state.hasTimedOut:
            value, _ = state.get
            state.remove()
            yield pd.DataFrame({"key": [key[0]], "value": [value], "live": [False]})
            return
        at, value = max(((a, v) for rows in batches for a, v in zip(rows["at"], rows["value"], strict=True)), key=lambda r: r[0])
        old = state.get if state.exists else (None, -1)
        stamp = int(at.timestamp() * 1000)
        if stamp >= old[1]:
            state.update((value, stamp))
            state.setTimeoutTimestamp(max(stamp + ttl_seconds * 1000, state.getCurrentWatermarkMs() + 1))
            if value != old[0]:
                yield pd.DataFrame({"key": [key[0]], "value": [value], "live": [True]})

    return updates.withWatermark("at", late).groupBy("key").applyInPandasWithState(keep, "key string, value string, live boolean", "value string, at long", "append", "EventTimeTimeout")
