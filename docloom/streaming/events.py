"""Event-time windows and stateful queues. Each function takes a static or a streaming DataFrame and gives the same rows."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def source(spark: SparkSession, path: str, schema: str, files: int = 1) -> DataFrame:
    """A stream over the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _late(events: DataFrame, delay: str) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay) if events.isStreaming else events


def tumbling(events: DataFrame, size: str = "1 day", delay: str = "1 day") -> DataFrame:
    """(day, event_type, n, total) by windows that do not overlap."""
    out = _late(events, delay).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("day"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str = "1 day", step: str = "12 hours", delay: str = "1 day") -> DataFrame:
    """(start, event_type, n) by overlapping windows."""
    out = _late(events, delay).groupBy(F.window("ts", size, step).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "6 hours", delay: str = "1 day") -> DataFrame:
    """(user_id, start, n) by sessions that end after a gap."""
    out = _late(events, delay).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.concat(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss"), F.regexp_replace(F.date_format("w.start", ".SSSSSS"), r"\.?0+$", "")).alias("start"), "n")


def once(events: DataFrame, key: str = "event_id", delay: str = "1 day") -> DataFrame:
    """Events without repeats of a key; a stream forgets keys after the delay."""
    return _late(events, delay).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])


def open_items(events: DataFrame, key: str = "user_id", closing: str = "purchase") -> DataFrame:
    """A work queue as a stateful stream: after each batch, (key, seen, state) of the keys that it touched.

    An entry opens a closed item or adds to the open one; a closing entry closes it. State: one number for each open item; a
    closed one leaves nothing behind.
    """

    def fold(keys: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        closes = (rows["event_type"] == closing).to_numpy()
        seen = int(closes[::-1].argmax()) if closes.any() else seen + len(rows)
        if seen:
            state.update((seen,))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({key: [keys[0]], "seen": [seen], "state": ["open" if seen else "closed"]})

    return events.groupBy(key).applyInPandasWithState(fold, f"{key} long, seen long, state string", "seen long", "update", GroupStateTimeout.NoTimeout)
