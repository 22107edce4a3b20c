"""Work items with timers, and failures joined to the steps they fell into, on streams and on static tables alike."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: What a stream of work items needs its state kept in.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_timers(spark: SparkSession) -> SparkSession:
    """The session, its state kept by the provider that knows timers."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return spark


class _Items(StatefulProcessor):
    """Folds a key's events in the order of their time, as far as the watermark has passed.

    Events wait, sorted by nothing, until the watermark has passed them: then no earlier one can come, and they are folded
    in order, so the order in which files arrive makes no difference. An open item is one row of state; a timer closes it
    as expired when its time is over. Nothing is left of a key whose items are all closed.
    """

    def __init__(self, closing: str, expire_ms: int):
        self.closing, self.expire = closing, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ms long, id long, kind string")
        self.item = handle.getValueState("item", "opened long, last long, n long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for ms, id_, kind in zip(frame["ms"], frame["id"], frame["kind"]):
                self.waiting.appendValue((int(ms), int(id_), kind))
                self.handle.registerTimer(int(ms))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(self.waiting.get()) if self.waiting.exists() else []
        due, later = [w for w in waiting if w[0] < now], [w for w in waiting if w[0] >= now]
        item = tuple(self.item.get()) if self.item.exists() else None
        before, out = item, []
        for ms, _, kind in due:
            if item and ms - item[1] > self.expire:
                out.append((*item, item[1] + self.expire, "expired"))
                item = None
            item = (item[0], ms, item[2] + 1) if item else (ms, ms, 1)
            if kind == self.closing:
                out.append((*item, ms, "closed"))
                item = None
        if item and item[1] + self.expire < now:
            out.append((*item, item[1] + self.expire, "expired"))
            item = None
        if due:
            self.waiting.put(later) if later else self.waiting.clear()
        if item:
            self.item.update(item)
            if item != before:
                self.handle.registerTimer(item[1] + self.expire)
        elif before:
            self.item.clear()
        if out:
            yield pd.DataFrame({"key": [key[0]] * len(out), **{c: [o[i] for o in out] for i, c in ((0, "opened"), (2, "n"), (3, "ended"))}, "state": [o[4] for o in out]})

    def close(self) -> None:
        pass


def work_items(events: DataFrame, key: str = "user_id", ts: str = "ts", order: str = "event_id", kind: str = "event_type", closing: str = "purchase", expire: str = "12 hours", delay: str = "1 day") -> DataFrame:
    """(key, opened, n, ended, state): items that are over, as epoch milliseconds; state is closed or expired.

    A key's first event opens an item, the next ones belong to it; it is closed by a `closing` event, and expires when
    `expire` has gone by since its last event. Only what lies before the watermark (the latest time less `delay`) counts, on
    static tables as well. Events without a key or time are left out.
    """
    known = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    at = F.col(ts).cast("timestamp")
    span = F.lit(pd.Timedelta(expire).value // 10**6)
    if events.isStreaming:
        rows = known.withColumn("_at", at).withWatermark("_at", delay).select(F.col(key).cast("long").alias("key"), F.unix_millis("_at").alias("ms"), F.col(order).cast("long").alias("id"), F.col(kind).alias("kind"), "_at")
        processor = _Items(closing, pd.Timedelta(expire).value // 10**6)
        return rows.groupBy("key").transformWithStateInPandas(processor, "key long, opened long, n long, ended long, state string", "Append", "EventTime")
    rows = known.select(F.col(key).cast("long").alias("key"), F.unix_millis(at).alias("ms"), F.col(order).cast("long").alias("id"), F.col(kind).alias("kind"))
    mark = rows.agg((F.max("ms") - pd.Timedelta(delay).value // 10**6).alias("mark"))
    rows = rows.join(F.broadcast(mark)).where("ms < mark")
    each = Window.partitionBy("key").orderBy("ms", "id")
    fresh = F.coalesce((F.lag("kind").over(each) == closing) | (F.col("ms") - F.lag("ms").over(each) > span), F.lit(True))
    items = rows.withColumn("item", F.sum(fresh.cast("int")).over(each)).groupBy("key", "item", "mark").agg(F.min("ms").alias("opened"), F.max("ms").alias("last"), F.count(F.lit(1)).alias("n"), F.max_by("kind", F.struct("ms", "id")).alias("kind"))
    closed = F.coalesce(F.col("kind") == closing, F.lit(False))
    ended = F.when(closed, F.col("last")).otherwise(F.col("last") + span)
    over = items.where(closed | (F.col("last") + span < F.col("mark")))
    return over.select("key", "opened", "n", ended.alias("ended"), F.when(closed, "closed").otherwise("expired").alias("state"))


def attributed(failures: DataFrame, steps: DataFrame, on: str, failed_at: str, began_at: str, within: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Failures (f_..) with the steps (s_..) of the same `on` that began at most `within` before them: an interval join.

    Both sides keep what the watermark may still need, no more. Failures without such a step are left out.
    """

    def side(df: DataFrame, at: str, mark: str) -> DataFrame:
        named = df.select(*(F.col(c).alias(f"{mark}_{c}") for c in df.columns))
        timed = named.withColumn(f"{mark}_{at}", F.col(f"{mark}_{at}").cast("timestamp"))
        return timed.withWatermark(f"{mark}_{at}", delay) if df.isStreaming else timed

    f, s = side(failures, failed_at, "f"), side(steps, began_at, "s")
    began, failed = F.col(f"s_{began_at}"), F.col(f"f_{failed_at}")
    same: Column = (F.col(f"f_{on}") == F.col(f"s_{on}")) & (began <= failed) & (began >= failed - F.expr(f"interval {within}"))
    return f.join(s, same)
