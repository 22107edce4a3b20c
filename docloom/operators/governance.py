"""Quality scores, run statistics, work queues and rule tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled

#: Fixed: days after which an artifact of each kind is stale.
FRESH_DAYS = {"raw": 7, "cleaned": 10, "clauses": 30, "published": 30}
#: Fixed: upper ends of the ageing buckets, in days.
AGE_ENDS = [3, 7, 14]


def null_rates(df: DataFrame, columns: list[str], alarm: float = 0.03) -> DataFrame:
    """(field, n_missing, rate, alarm): missing as `filled` has it; one pass for all columns."""
    missing = df.agg(F.count(F.lit(1)).alias("_n"), *(F.sum((filled(F.col(c).cast("string")) == "").cast("int")).alias(c) for c in columns))
    each = F.inline(F.array(*(F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c), F.lit(0)).alias("n_missing")) for c in columns)))
    out = missing.select("_n", each)
    return out.select("field", "n_missing", F.round(F.col("n_missing") / F.col("_n"), 4).alias("rate"), (F.col("n_missing") > alarm * F.col("_n")).alias("alarm"))


def validate(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """df with errors: the names of the broken rules, in order, joined by commas ('' for a valid row). A rule that is null is broken."""
    return df.withColumn("errors", F.concat_ws(",", *(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules)))


def quality_score(df: DataFrame, dimensions: list[tuple[str, Column]]) -> DataFrame:
    """(dimension, score) in percent, rounded to 2 places, and their mean as `overall`; dimensions without a value do not count."""
    one = df.agg(*(F.round(100 * c, 2).alias(n) for n, c in dimensions))
    known = sum((F.col(n).isNotNull().cast("int") for n, _ in dimensions), F.lit(0))
    overall = F.round(sum((F.coalesce(F.col(n), F.lit(0.0)) for n, _ in dimensions), F.lit(0.0)) / known, 2)
    names = [*(n for n, _ in dimensions), "overall"]
    return one.withColumn("overall", overall).select(F.inline(F.array(*(F.struct(F.lit(n).alias("dimension"), F.col(n).alias("score")) for n in names))))


def age_score(age: Column, limit: int) -> Column:
    """100 within the limit, 100 * limit / age beyond it."""
    return F.when(age <= limit, 100.0).otherwise(100.0 * limit / age)


def step_durations(runs: DataFrame, step: str, elapsed: str, at: str, skipped: Column, exact: bool = True) -> DataFrame:
    """Per step: runs, skip rate, and over runs that were not skipped p50, p90, max, mean and last duration.

    Exact percentiles keep every different duration of a step in one aggregate's buffer; for steps with many millions of
    runs take exact=False, which sketches them within one in ten thousand ranks.
    """
    ran = F.when(~skipped, F.col(elapsed))
    percentile = F.percentile if exact else (lambda c, q: F.percentile_approx(c, q, 10_000))
    return runs.groupBy(step).agg(
        F.count(F.lit(1)).alias("runs"), F.round(F.avg(skipped.cast("double")), 4).alias("skip_rate"), F.round(percentile(ran, 0.5), 6).alias("p50"), F.round(percentile(ran, 0.9), 6).alias("p90"),
        F.round(F.max(ran), 6).alias("longest"), F.round(F.avg(ran), 6).alias("mean"), F.round(F.max_by(ran, F.when(~skipped, F.col(at))), 6).alias("latest"),
    )


def age_bucket(days: Column) -> Column:
    """0-3, 4-7, 8-14 or 15+."""
    names, low, out = [], 0, None
    for end in AGE_ENDS:
        names.append((end, f"{low}-{end}"))
        low = end + 1
    for end, name in names:
        out = F.when(days <= end, name) if out is None else out.when(days <= end, name)
    return out.otherwise(f"{low}+")


def growth(items: DataFrame, created: str, resolved: Column) -> DataFrame:
    """(month, created, resolved, net): items by the month in which they came, and of those that were resolved by its month."""
    came = items.select(F.date_format(created, "yyyy-MM").alias("month"), F.lit(1).alias("c"), F.lit(0).alias("r"))
    went = items.select(F.date_format(resolved, "yyyy-MM").alias("month"), F.lit(0).alias("c"), F.lit(1).alias("r")).where("month is not null")
    return came.union(went).groupBy("month").agg(F.sum("c").alias("created"), F.sum("r").alias("resolved"), F.sum(F.col("c") - F.col("r")).alias("net"))


def upsert(log: DataFrame, keys: list[str], at: str, status: str, closing: list[str]) -> DataFrame:
    """A work queue from its log: per key the opening time of the open item, how often it was seen, and the status.

    A key is open if its newest entry closes nothing; an item opens with the first entry after the last closing one.
    """
    closes = F.col(status).isin(closing)
    ends = log.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.max(F.when(closes, F.col(at))).alias("_end"))
    met = log.join(ends, reduce(Column.__and__, (F.col(k) == F.col(f"_{k}") for k in keys)))
    live = ~closes & (F.col("_end").isNull() | (F.col(at) > F.col("_end")))
    out = met.groupBy(*keys).agg(F.min(F.when(live, F.col(at))).alias("opened"), F.sum(live.cast("int")).alias("seen"), F.count(F.lit(1)).alias("entries"))
    return out.withColumn("state", F.when(F.col("opened").isNull(), "closed").otherwise("open"))


def by_matrix(df: DataFrame, matrix: DataFrame, keys: list[str], value: str, otherwise: str) -> DataFrame:
    """df with the matrix's value for the row's keys (a rule table, so broadcast), else `otherwise`."""
    side = matrix.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col(value).alias("_value"))
    met = df.join(F.broadcast(side), reduce(Column.__and__, (F.col(k) == F.col(f"_{k}") for k in keys)), "left")
    return met.withColumn(value, F.coalesce("_value", F.lit(otherwise))).drop("_value", *(f"_{k}" for k in keys))


def gaps(requirements: DataFrame, records: DataFrame, evidence: DataFrame, keys: list[str]) -> DataFrame:
    """Requirements with the first gap rule that holds: no record, partial, executed without evidence, with one piece only."""
    r = records.groupBy(*(F.col(k).alias(f"_r{k}") for k in keys)).agg(F.count(F.lit(1)).alias("_n"), F.max((F.col("exec_status") == "partial").cast("int")).alias("_partial"), F.max((F.col("exec_status") == "executed").cast("int")).alias("_done"))
    e = evidence.groupBy(*(F.col(k).alias(f"_e{k}") for k in keys)).agg(F.count(F.lit(1)).alias("_ev"))
    on = lambda p: reduce(Column.__and__, (F.col(k) == F.col(f"_{p}{k}") for k in keys))
    met = requirements.join(r, on("r"), "left").join(e, on("e"), "left").withColumn("_ev", F.coalesce("_ev", F.lit(0)))
    rule = F.when(F.col("_n").isNull(), "not_executed").when(F.col("_partial") == 1, "partial").when((F.col("_done") == 1) & (F.col("_ev") == 0), "no_evidence").when((F.col("_done") == 1) & (F.col("_ev") < 2), "insufficient")
    severity = F.when(F.col("gap_class") == "not_executed", "high").when(F.col("gap_class").isin("partial", "no_evidence"), "medium").otherwise("low")
    return met.withColumn("gap_class", rule).where("gap_class is not null").select(*keys, "gap_class", severity.alias("severity"))
