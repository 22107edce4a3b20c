"""Run ledgers: steps, checkpoints, watermarks, queues, triggers, service levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_write(df: DataFrame, keys: list[str], at: list[str]) -> DataFrame:
    """The last written row of each key: what an upsert on the key leaves."""
    values = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*at)).alias("_v")).select(*keys, "_v.*")


def pending(wanted: DataFrame, done: DataFrame, key: str, state: str) -> DataFrame:
    """Items that still have to be done: not known yet, or failed and not done since. done: key, state ('done', 'failed')."""
    finished = done.where(F.col(state) == "done").select(F.col(key).alias("_k")).distinct()
    return wanted.join(finished, F.col(key) == F.col("_k"), "left_anti")


def since(df: DataFrame, sequence: str, watermark: DataFrame, mark: str) -> DataFrame:
    """Rows after the watermark (a table of one row at most; without one, all rows)."""
    high = watermark.agg(F.max(mark).alias("_mark"))
    return df.join(F.broadcast(high), F.col("_mark").isNull() | (F.col(sequence) > F.col("_mark"))).drop("_mark")


def watermarks(df: DataFrame, key: str, version: str, at: str, inputs: str) -> DataFrame:
    """(key, version, inputs, at, runs): the newest record of each artifact and how many there are."""
    return df.groupBy(key).agg(F.max_by(version, at).alias("version"), F.max_by(inputs, at).alias("inputs"), F.max(at).alias("at"), F.count(F.lit(1)).alias("runs"))


def merged_paths(old: DataFrame, new: DataFrame, key: str, path: str) -> DataFrame:
    """(key, paths): different paths of each artifact in both registers, sorted. Only different pairs are gathered."""
    pairs = old.select(key, path).union(new.select(key, path)).where(F.col(path).isNotNull()).distinct()
    return pairs.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(path)), ",").alias("paths"))


def queue_stats(df: DataFrame, keys: list[str], opened: Column, at: str, as_of: Column) -> DataFrame:
    """keys + (n, open, oldest_days): entries, open ones, and the age of the oldest open one."""
    age = F.datediff(as_of, F.col(at).cast("date"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(opened.cast("long")).alias("open"), F.max(F.when(opened, age)).alias("oldest_days"))


def alerts(df: DataFrame, rules: list[tuple[str, Column, str]]) -> DataFrame:
    """A row (all columns of df, alert, level) for each rule that holds; rules: (alert, condition, level)."""
    found = F.array_compact(F.array(*(F.when(holds, F.struct(F.lit(name).alias("alert"), F.lit(level).alias("level"))) for name, holds, level in rules)))
    return df.withColumn("_a", F.explode(found)).select(*df.columns, "_a.alert", "_a.level")


def decided(df: DataFrame, conditions: list[str], table: DataFrame, action: str, otherwise: str) -> DataFrame:
    """df with the action of the first row of a decision table that fits; a null cell of the table fits anything.

    table: ord, the conditions, action. It is a rule table, small by nature, and is broadcast.
    """
    rules = F.broadcast(table.select("ord", F.col(action).alias("_action"), *(F.col(c).alias(f"_c_{c}") for c in conditions)))
    fits = reduce(Column.__and__, (F.col(f"_c_{c}").isNull() | (F.col(c) == F.col(f"_c_{c}")) for c in conditions))
    kinds = df.select(*conditions).distinct()
    best = kinds.join(rules, fits, "left").groupBy(*conditions).agg(F.min_by("_action", "ord").alias("_action"))
    again = best.select(*(F.col(c).alias(f"_k_{c}") for c in conditions), "_action")
    met = df.join(again, reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in conditions)), "left")
    return met.select(*df.columns, F.coalesce("_action", F.lit(otherwise)).alias(action))


def attributed(failures: DataFrame, steps: DataFrame, by: list[str], at: str, step: str) -> DataFrame:
    """failures with the step of the same run that ended last before them (`cause`), null if none did.

    One merged and sorted pass: steps carry their name on to the failures after them.
    """
    fails = failures.select(*failures.columns, F.lit(1).alias("_kind"), F.lit(None).cast(dict(steps.dtypes)[step]).alias("_step"))
    marks = steps.select(*by, F.col(at), F.col(step).alias("_step")).withColumn("_kind", F.lit(0))
    order = Window.partitionBy(*by).orderBy(at, "_kind", "_step").rowsBetween(Window.unboundedPreceding, 0)
    both = fails.unionByName(marks, allowMissingColumns=True).withColumn("cause", F.last("_step", ignorenulls=True).over(order))
    return both.where("_kind = 1").drop("_kind", "_step")


def service_levels(df: DataFrame, chain: Column, fresh: Column, gate: Column) -> DataFrame:
    """(sli, percent): shares of rows with a good chain, fresh data and passed gates; null rows of a level do not count in it."""
    one = df.agg(*(F.round(100 * F.avg(c.cast("double")), 2).alias(n) for n, c in (("chain", chain), ("freshness", fresh), ("gates", gate))))
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("sli"), F.col(n).alias("percent")) for n in ("chain", "freshness", "gates")))))


def trend(df: DataFrame, by: list[str], order: list[str], value: str, drop: float = 0.1) -> DataFrame:
    """df with previous and trend: degraded if the value fell by over `drop` of the previous one, improved if it grew so, else flat, new."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    state = F.when(F.col("previous").isNull(), "new").when(F.col(value) < (1 - drop) * F.col("previous"), "degraded").when(F.col(value) > (1 + drop) * F.col("previous"), "improved").otherwise("flat")
    return df.withColumn("previous", before).withColumn("trend", state)


def last_run(df: DataFrame, run: str, at: str, dry: Column) -> DataFrame:
    """One row (run, steps, at): the latest run that has steps and no dry one."""
    runs = df.groupBy(F.col(run).alias("run")).agg(F.count(F.lit(1)).alias("steps"), F.max(at).alias("at"), F.max(dry.cast("int")).alias("_dry")).where("_dry = 0")
    return runs.orderBy(F.desc("at"), F.desc("run")).limit(1).drop("_dry")


def circuit(df: DataFrame, by: str, order: list[str], failed: Column, most: int = 3) -> DataFrame:
    """df with (streak, state): how many failures in a row each row ends, and open once there are `most`, half_open on the row
    after an open one, else closed."""
    at = Window.partitionBy(by).orderBy(*order)
    rows = df.withColumn("_f", failed.cast("int"))
    rows = rows.withColumn("_run", F.sum(1 - F.col("_f")).over(at.rowsBetween(Window.unboundedPreceding, 0)))
    streak = F.sum("_f").over(Window.partitionBy(by, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("streak", streak).withColumn("_open", F.col("streak") >= most)
    state = F.when(F.col("_open"), "open").when(F.lag("_open").over(at), "half_open").otherwise("closed")
    return rows.withColumn("state", state).drop("_f", "_run", "_open")


def dead_letter_plan(df: DataFrame, attempts: str, at: str, base_minutes: int = 5, most: int = 5) -> DataFrame:
    """df with retry_at (each attempt doubles the wait) and needs_review from `most` attempts on."""
    wait = F.lit(base_minutes * 60) * F.pow(F.lit(2), F.least(F.col(attempts), F.lit(most)) - 1).cast("long")
    return df.withColumn("retry_at", F.timestamp_seconds(F.unix_timestamp(at) + wait)).withColumn("needs_review", F.col(attempts) >= most)
