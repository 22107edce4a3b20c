"""What several operators share: reading tables, cutting lineage, gapless numbers, connected components."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..checkpoints import cut, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table of our own in the shared folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame) -> DataFrame:
    """df written once as Parquet in the shared folder, and read from there."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """At most `rows` rows of text in an Arrow batch from now on, so that a batch of long texts fits beside others in a task."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str, n_rows: int, block_rows: int = 50_000) -> DataFrame:
    """rows with a long column `name`: gapless numbers from 0 within each value of `by`.

    A value of `by` may hold any share of the rows: rows are dealt to blocks by a hash of `order`, numbered in their
    block, and moved up by the counts of the blocks before. Only the counts pass one task per value of `by`.
    """
    block = F.pmod(F.xxhash64(*order), F.lit(max(1, math.ceil(n_rows / block_rows))))
    dealt = rows.withColumn("_block", block)
    keys = [*by, "_block"]
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = dealt.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return inside.join(starts, same).withColumn(name, F.col("_i") + F.col("_start")).drop("_block", "_i", "_start", *(f"_k{i}" for i in range(len(keys))))


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case; all else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node of the undirected edges (longs).

    Every round links each node's neighbours to the smallest one around it (large star, then small star), and writes the
    edges to the checkpoint folder; it ends when a round changes nothing, after about log(longest chain) rounds. Stars are
    found with grouped minima and joins, so no component is ever gathered in one task.
    """
    ab = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    now = cut(ab.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        new = small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = cut(new)
        if mark == (mark := _mark(now)):
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """A number that tells two sets of edges apart."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
