"""Tables in versions: manifests of data files, one writer a version, readers that keep theirs, updates that rewrite little."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer has written the version that this one was to become."""


class Versions:
    """A table by key in a folder: `data` (a folder for each write, in buckets by a hash of the key), `versions` (manifests).

    A manifest lists the files of a version with their rows and a digest of the rows. A version exists once its manifest
    does; manifests are created, never overwritten, so of two writers that begin from one version the second gets Conflict,
    and what a lost writer left behind is in no manifest. A reader has the files of its version, whatever is written later.
    Creation without overwriting is the file system's promise: HDFS and its like keep it; where two machines can both
    create a file, writers need another lock.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def history(self) -> list[int]:
        """The numbers of all versions, in order."""
        fs, path = self._at("versions")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """What a version is made of: version, base, note, key, buckets, schema, files (path, bucket, rows, digest)."""
        version = self.history()[-1] if version is None else version
        return json.loads(self.spark.read.text("/".join([self.path, "versions", f"{version:08d}.json"]), wholetext=True).first()[0])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest by default."""
        told = self.manifest(version)
        return self._files(told, [f["path"] for f in told["files"]])

    def _files(self, told: dict, paths: list[str]) -> DataFrame:
        schema = self.spark.createDataFrame([], told["schema"]).schema
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{p}" for p in paths))

    def commit(self, df: DataFrame, key: str, buckets: int = 64, note: str = "", base: int | None = None) -> int:
        """Writes df as the version after `base` (the latest by default, null keys left out); returns its number."""
        base = (self.history() or [0])[-1] if base is None else base
        schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
        return self._publish({"base": base, "note": note, "key": key, "buckets": buckets, "schema": schema}, self._written(df, key, buckets))

    def update(self, changed: DataFrame, removed: DataFrame | None = None, note: str = "", base: int | None = None) -> int:
        """The version after `base` with the rows of `changed` in the place of those of their keys, and without the keys of
        `removed`. Only buckets that hold such keys are read and written anew; the files of all others are taken over."""
        told = self.manifest(base)
        key, buckets = told["key"], told["buckets"]
        gone = changed.select(F.col(key).alias("_gone"))
        gone = gone if removed is None else gone.union(removed.select(F.col(key).alias("_gone")))
        touched = {r[0] for r in gone.select(_bucket("_gone", buckets)).distinct().collect()}
        old = self._files(told, [f["path"] for f in told["files"] if f["bucket"] in touched])
        kept = old.join(gone.distinct(), F.col(key) == F.col("_gone"), "left_anti")
        files = self._written(kept.unionByName(changed.select(*kept.columns)), key, buckets)
        return self._publish({**told, "base": told["version"], "note": note}, [f for f in told["files"] if f["bucket"] not in touched] + files)

    def rebuild(self, source: DataFrame, key: str, digest: str, build: Callable[[DataFrame], DataFrame], note: str = "") -> int:
        """A derived table brought up to date: `build` runs on the source rows whose digest is new or changed only; rows of
        keys that the source has no more go. The derived rows hold the key and, as `_digest`, what they were made from."""
        told = self.history()
        if not told:
            made = build(source).join(source.select(F.col(key).alias("_k"), F.col(digest).alias("_digest")), F.col(key) == F.col("_k")).drop("_k")
            return self.commit(made, key, note=note)
        known = self.read().select(F.col(key).alias("_k"), "_digest").distinct()
        met = source.join(known, F.col(key) == F.col("_k"), "left")
        fresh = met.where(F.col("_digest").isNull() | (F.col("_digest") != F.col(digest))).select(*source.columns)
        gone = known.join(source.select(F.col(key).alias("_now")), F.col("_k") == F.col("_now"), "left_anti").select(F.col("_k").alias(key))
        emptied = fresh.select(key)  # a text may have no rows any more
        made = build(fresh).join(fresh.select(F.col(key).alias("_k"), F.col(digest).alias("_digest")), F.col(key) == F.col("_k")).drop("_k")
        return self.update(made, gone.union(emptied), note)

    def _written(self, df: DataFrame, key: str, buckets: int) -> list[dict]:
        """Writes df in buckets; (path, bucket, rows, digest) of each file. The digest does not depend on the order of rows."""
        folder = uuid.uuid4().hex
        rows = df.where(F.col(key).isNotNull()).withColumn("_bucket", _bucket(key, buckets))
        rows.repartition("_bucket").sortWithinPartitions("_bucket", key).write.partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
        return self._told(f"{self.path}/data/{folder}", df.columns, df.schema)

    def _told(self, paths, columns: list[str], schema) -> list[dict]:
        found = self.spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))
        names = found.select(F.regexp_extract(F.col("_metadata.file_path"), "/data/([^/]+/.*)$", 1).alias("path"), F.xxhash64(*(F.col(f"`{c}`") for c in columns)).cast("decimal(38,0)").alias("h"))
        told = names.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.sum("h").cast("string").alias("digest"))
        told = told.withColumn("bucket", F.regexp_extract("path", r"_bucket=(\d+)/", 1).cast("int"))
        return [r.asDict() for r in told.orderBy("path").collect()]

    def _publish(self, told: dict, files: list[dict]) -> int:
        told = {**told, "version": told["base"] + 1, "files": files}
        fs, path = self._at("versions", f"{told['version']:08d}.json")
        try:
            out = fs.create(path, False)
        except Exception as e:
            if "AlreadyExists" in str(e):
                raise Conflict(f"version {told['version']} has been written by another writer") from None
            raise
        out.write(bytearray(json.dumps(told, ensure_ascii=False).encode()))
        out.close()
        return told["version"]

    def broken(self, version: int | None = None) -> list[str]:
        """Files of a version that are not there or hold other rows than its manifest says."""
        told = self.manifest(version)
        there = [f["path"] for f in told["files"] if (at := self._at("data", f["path"]))[0].exists(at[1])]
        empty = self._files(told, [])
        now = {f["path"]: (f["rows"], f["digest"]) for f in (self._told([f"{self.path}/data/{p}" for p in there], empty.columns, empty.schema) if there else [])}
        return [f["path"] for f in told["files"] if now.get(f["path"]) != (f["rows"], f["digest"])]

    def lost(self, of: DataFrame, columns: list[str], version: int | None = None) -> DataFrame:
        """Rows of `of`, by `columns`, that a version does not hold: none where the table was only appended to."""
        held = self.read(version).select(*(F.col(c).alias(f"_{c}") for c in columns)).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]
        return of.join(held, same, "left_anti")


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
