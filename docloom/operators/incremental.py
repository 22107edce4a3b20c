"""Incremental runs: what is new, when to stop, what to retry, what to run again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def classify(items: DataFrame, known: DataFrame, key: str, order: list[str]) -> DataFrame:
    """items with state: known (seen in an earlier run), dup_in_run (not the first of its key) or new."""
    seen = known.select(F.col(key).alias("_k")).distinct()
    first = F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1
    met = items.withColumn("_first", first).join(seen, F.col(key) == F.col("_k"), "left")
    return met.withColumn("state", F.when(F.col("_k").isNotNull(), "known").when(F.col("_first"), "new").otherwise("dup_in_run")).drop("_k", "_first")


def stop_page(items: DataFrame, page: str, patience: int) -> DataFrame:
    """(page): the first page at which `patience` pages in a row have brought nothing new; none if there is none.

    items: classified rows with a page number. The pages are few (one aggregate row each), so one window orders them.
    """
    pages = items.groupBy(page).agg(F.max((F.col("state") == "new").cast("int")).alias("_new"))
    last = Window.orderBy(page).rowsBetween(-(patience - 1), 0)
    empty = pages.withColumn("_n", F.count(F.lit(1)).over(last)).withColumn("_any", F.max("_new").over(last)).where(f"_n = {patience} and _any = 0")
    return empty.agg(F.min(page).alias(page)).where(F.col(page).isNotNull())


def dead_letters(log: DataFrame, key: str, at: str, ok: Column, base_seconds: int = 60, most: int = 5) -> DataFrame:
    """(key, attempts, next_at, needs_review) of keys whose newest entry failed: failures since the last success, and when
    to try again, waiting twice as long each time; from `most` failures on a person has to look."""
    good = log.groupBy(F.col(key).alias("_k")).agg(F.max(F.when(ok, F.col(at))).alias("_ok"))
    failed = log.where(~ok).join(good, F.col(key) == F.col("_k")).where(F.col("_ok").isNull() | (F.col(at) > F.col("_ok")))
    out = failed.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.max(at).alias("_last"))
    wait = F.lit(base_seconds) * F.pow(F.lit(2.0), F.least(F.col("attempts"), F.lit(most)) - 1)
    next_at = F.timestamp_seconds(F.unix_micros(F.col("_last").cast("timestamp")) / 1e6 + wait)
    return out.select(key, "attempts", next_at.alias("next_at"), (F.col("attempts") >= most).alias("needs_review"))


def resume_plan(steps: DataFrame, runs: DataFrame, stale: DataFrame) -> DataFrame:
    """(step, action): skip a step whose newest run succeeded and that needs nothing stale, else run it."""
    last = runs.groupBy(F.col("step").alias("_s")).agg(F.max_by("rc", "finished_at").alias("_rc"))
    old = stale.select(F.col("step").alias("_t")).distinct()
    met = steps.select("step").join(last, F.col("step") == F.col("_s"), "left").join(old, F.col("step") == F.col("_t"), "left")
    return met.select("step", F.when((F.col("_rc") == 0) & F.col("_t").isNull(), "skip").otherwise("run").alias("action"))


def retention(files: DataFrame, group: str, at: str, keep: int, as_of: str, days: int) -> DataFrame:
    """files with action: the newest `keep` of a group stay, older ones go once they are over `days` old."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(at), F.desc("path")))
    age = F.datediff(F.lit(as_of).cast("date"), F.col(at).cast("date"))
    return files.withColumn("_n", rank).withColumn("action", F.when((F.col("_n") > keep) & (age > days), "remove").otherwise("keep")).drop("_n")


def citations(drafts: DataFrame, registry: DataFrame, key: str, status: str, withdrawn: list[str]) -> DataFrame:
    """drafts (each a cited key) with verdict: unknown, withdrawn or valid."""
    side = registry.groupBy(F.col(key).alias("_k")).agg(F.max(F.col(status).isin(withdrawn).cast("int")).alias("_gone"))
    met = drafts.join(side, F.col(key) == F.col("_k"), "left")
    return met.withColumn("verdict", F.when(F.col("_k").isNull(), "unknown").when(F.col("_gone") == 1, "withdrawn").otherwise("valid")).drop("_k", "_gone")
