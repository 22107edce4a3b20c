"""Readers and writers for record snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def resolved(spark: SparkSession, path: str) -> str:
    """path, or where there is no such .json file the .jsonl one of the same name."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    return path if there or not path.endswith(".json") else f"{path}l"


def read_records(spark: SparkSession, path: str, schema: str | None = None, array: bool = False) -> DataFrame:
    """Records of JSON lines (or of one JSON array a file); a leading _meta row is left out, broken rows go to _broken. A
    .json path that is not there stands for the .jsonl one."""
    path = resolved(spark, path)
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").option("multiLine", array)
    rows = (reader.schema(schema) if schema else reader).json(path)
    return rows.where("_meta is null").drop("_meta") if "_meta" in rows.columns else rows


def write_records(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Parquet by partition columns: the authoritative form of a snapshot. Rows are dealt by these columns and a salt first,
    so that a large partition is written by many tasks and a small one gives few files."""
    if by:
        df = df.hint("rebalance", *by)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_lines(df: DataFrame, path: str, meta: dict[str, str] | None = None) -> None:
    """JSON lines; with meta, a file of its own holds one row _meta, which `read_records` leaves out."""
    df.write.mode("overwrite").json(path)
    if meta is not None:
        one = df.sparkSession.createDataFrame([(meta,)], "_meta map<string, string>")
        one.coalesce(1).write.mode("append").json(path)


def oversize(df: DataFrame, key: str, limit: int, k: int = 3) -> DataFrame:
    """(key, size): the k largest records over `limit` characters as JSON."""
    return df.select(key, F.length(F.to_json(F.struct(*df.columns))).cast("long").alias("size")).where(F.col("size") > limit).orderBy(F.desc("size"), key).limit(k)


def main_files(paths: DataFrame, path: str = "path", at: str = "at") -> DataFrame:
    """(folder, path): the newest file of each folder that is no quarantine, backup or temporary file."""
    own = paths.where(~F.lower(F.col(path)).rlike(r"quarantine|\.bak|\.tmp|~$"))
    return own.groupBy(F.regexp_replace(F.col(path), "/[^/]*$", "").alias("folder")).agg(F.max_by(path, F.struct(at, path)).alias("path"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the number of rows, and of different values of each column (exact)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *(F.countDistinct(c).alias(f"n_{c}") for c in columns))


def write_table(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays and structs as JSON text."""
    shown = [F.to_json(c).alias(c) if kind.startswith(("array", "struct", "map")) else F.col(c) for c, kind in df.dtypes]
    df.select(*shown).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def latest(df: DataFrame, by: str, at: str) -> DataFrame:
    """Rows of each source's newest snapshot."""
    last = df.groupBy(F.col(by).alias("_by")).agg(F.max(at).alias("_at"))
    return df.join(last, (F.col(by) == F.col("_by")) & (F.col(at) == F.col("_at")), "left_semi")


def keep_newest(snapshots: DataFrame, by: list[str], at: str, k: int) -> DataFrame:
    """Snapshots to keep: the k newest of each group."""
    return snapshots.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(at)))).where(F.col("_n") <= k).drop("_n")


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, digest) of the files under a path, to compare snapshots by content. Files are read whole, so each must
    be smaller than 2 GB."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.sha2("content", 256).alias("digest"))


def unseen(found: DataFrame, known: DataFrame) -> DataFrame:
    """Files whose content is not known yet, one for each content."""
    new = found.join(known.select(F.col("digest").alias("_d")).distinct(), F.col("digest") == F.col("_d"), "left_anti")
    return new.groupBy("digest").agg(F.min(F.struct("path", "length")).alias("f")).select("f.path", "f.length", "digest")


def aliased(df: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """Columns under their present names: the first of each name's aliases that the table has and that is not null."""
    have = set(df.columns)

    def pick(name: str, others: list[str]) -> Column:
        found = [F.col(c).cast("string") for c in (name, *others) if c in have]
        return F.coalesce(*found, F.lit("")).alias(name)

    return df.select(*(pick(n, o) for n, o in names.items()))


def all_sources(frames: list[DataFrame]) -> DataFrame:
    """Rows of all sources, columns by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append_new(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose keys old does not have: what an append that ignores conflicts adds."""
    return new.dropDuplicates(keys).join(old.select(*keys).distinct(), keys, "left_anti")


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new put in place of those with the same keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
