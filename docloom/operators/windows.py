"""Running and neighbouring values in ordered groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import cut


def forward_fill(df: DataFrame, by: str, order: list[str], column: str, name: str) -> DataFrame:
    """The last value before or at each row that is not null."""
    return df.withColumn(name, F.last(column, ignorenulls=True).over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def ordinal_ids(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """key made unique: from the second row of a key on, -2, -3 and so on are appended."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn(name, F.when(n == 1, F.col(key).cast("string")).otherwise(F.concat(F.col(key).cast("string"), F.lit("-"), n.cast("string"))))


def running_count(df: DataFrame, by: str, order: list[str], when: Column, name: str) -> DataFrame:
    """How many rows up to each one fulfil `when`."""
    return df.withColumn(name, F.sum(when.cast("int")).over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def continuity(df: DataFrame, by: str, number: str, order: str = "_ord") -> DataFrame:
    """(by, n, restarts, continuity): steps of one between neighbouring different numbers, as a share; and numbers that do not rise.

    order: the column that tells which rows are neighbours.
    """
    before = F.lag(number).over(Window.partitionBy(by).orderBy(order))
    rows = df.withColumn("_before", before)
    step = F.when(F.col("_before").isNotNull(), (F.col(number) == F.col("_before") + 1).cast("double"))
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col(number) <= F.col("_before")).cast("int")).alias("restarts"), F.coalesce(F.avg(step), F.lit(1.0)).alias("continuity"))


def keep_latest(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The k newest rows of each group; Spark drops the others before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= k).drop("_rank")


def changes(df: DataFrame, by: str, order: list[str], column: str) -> DataFrame:
    """Rows whose value differs from the one before, with that value in column previous."""
    return df.withColumn("previous", F.lag(column).over(Window.partitionBy(by).orderBy(*order))).where(F.col("previous").isNotNull() & (F.col("previous") != F.col(column)))


def streak(df: DataFrame, by: str, order: list[str], bad: Column) -> DataFrame:
    """(by, streak): how many of the newest rows in a row are bad; two aggregates, no window."""
    at = F.struct(*order)
    last_good = df.groupBy(F.col(by).alias("_g")).agg(F.max(F.when(~bad, at)).alias("_at"))
    return df.join(last_good, F.col(by) == F.col("_g")).groupBy(by).agg(F.sum((F.col("_at").isNull() | (at > F.col("_at"))).cast("int")).cast("long").alias("streak"))


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with a long column `name`: gapless numbers from 1 in the given order of columns, which should tell rows apart.

    Rows are dealt to ranges of the order, numbered in their range, and moved up by the counts of the ranges before; only
    these counts, one a range, pass one task.
    """
    dealt = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = dealt.withColumn("_i", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    met = inside.join(F.broadcast(starts), F.col("_range") == F.col("_r"))
    return met.withColumn(name, (F.col("_i") + F.col("_start")).cast("long")).drop("_range", "_r", "_i", "_start")
