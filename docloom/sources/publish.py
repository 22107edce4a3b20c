"""A base published from several tables at once: versions that belong together, a history, and checks against the sources."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import Versions

#: Columns that tell where a record came from and how it was made; a published base leaves them out.
PROVENANCE = ["raw_path", "captured_at", "clean_version", "pipeline_run", "content_hash", "source_file", "missing_fields", "errors"]


class Base:
    """A base in a folder: a table of Versions for each name, and `history`, whose entries tell which versions go together.

    An entry is written last and never overwritten, so a reader sees a whole base or the one before; of two publishers that
    begin from one entry the second gets Conflict.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._entries = Versions(spark, f"{path}/history")

    def tables(self, name: str) -> Versions:
        return Versions(self.spark, f"{self.path}/tables/{name}")

    def history(self) -> list[dict]:
        """All entries, in order: version, note, at, tables (name: version, rows)."""
        return [self._entries.manifest(v) for v in self._entries.history()]

    def publish(self, tables: dict[str, tuple[DataFrame, str]], note: str = "", provenance: list[str] | None = None) -> int:
        """Publishes tables (name: rows and their key) without the columns of provenance. A table whose rows, by key, are
        those of the last entry is taken over; of another one only what has changed is written. Returns the entry's number."""
        last = self._entries.history()
        told = self._entries.manifest(last[-1])["tables"] if last else {}
        out = {}
        for name, (rows, key) in tables.items():
            own = rows.drop(*[c for c in (PROVENANCE if provenance is None else provenance) if c != key])
            out[name] = self._brought_up(self.tables(name), own, key, told.get(name))
        for name in told.keys() - tables.keys():
            out[name] = told[name]
        entry = {"base": last[-1] if last else 0, "note": note, "at": time.strftime("%Y-%m-%d %H:%M:%S"), "tables": out}
        return self._entries._publish(entry, [])

    def _brought_up(self, table: Versions, rows: DataFrame, key: str, told: dict | None) -> dict:
        columns = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
        if told is None or table.manifest(told["version"])["schema"] != columns:
            version = table.commit(rows, key, base=(table.history() or [0])[-1])
        else:
            digest = lambda df: df.select(F.col(key).alias("_k"), F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns)).alias("_h"))
            old, new = digest(table.read(told["version"])), digest(rows.where(F.col(key).isNotNull()))
            changed = new.join(old.withColumnRenamed("_k", "_o").withColumnRenamed("_h", "_g"), (F.col("_k") == F.col("_o")) & (F.col("_h") == F.col("_g")), "left_anti").select("_k")
            gone = old.join(new.select(F.col("_k").alias("_n")), F.col("_k") == F.col("_n"), "left_anti").select(F.col("_k").alias(key))
            fresh = rows.join(changed, F.col(key) == F.col("_k"), "left_semi")
            if not changed.limit(1).count() and not gone.limit(1).count():
                return told
            version = table.update(fresh, gone, base=told["version"]) if table.history()[-1] == told["version"] else table.commit(rows, key)
        return {"version": version, "rows": sum(f["rows"] for f in table.manifest(version)["files"]), "key": key}

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as an entry (the last by default) has it."""
        entry = self._entries.manifest(version)
        return self.tables(name).read(entry["tables"][name]["version"])

    def dangling(self, name: str, column: str, other: str, version: int | None = None) -> DataFrame:
        """Rows of a table whose `column` is no key of another table of the same entry."""
        key = self._entries.manifest(version)["tables"][other]["key"]
        known = self.read(other, version).select(F.col(key).alias("_key")).distinct()
        return self.read(name, version).where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_key"), "left_anti")

    def not_projected(self, name: str, source: DataFrame, version: int | None = None) -> DataFrame:
        """Source rows that the published table lacks or has otherwise, in the columns that both have."""
        held = self.read(name, version)
        return self.tables(name).lost(source, [c for c in source.columns if c in held.columns], self._entries.manifest(version)["tables"][name]["version"])

