"""Assertions on tables: each gives a row (gate, violations); a report says which passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import filled


def _counted(df: DataFrame, gate: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(gate).alias("gate"), "violations")


def assert_rows(df: DataFrame, gate: str, holds: Column) -> DataFrame:
    """Rows for which a condition does not hold; null does not hold."""
    return _counted(df.where(~F.coalesce(holds, F.lit(False))), gate)


def assert_domain(df: DataFrame, gate: str, column: str, domain: list[str], empty: bool = True) -> DataFrame:
    """Rows whose value is not in the domain; missing ones pass if `empty`."""
    value = filled(F.col(column).cast("string"))
    return assert_rows(df, gate, value.isin(domain) | ((value == "") & F.lit(empty)))


def assert_unique(df: DataFrame, gate: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first of their key; counted by key, so no key is gathered."""
    return df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("more")).agg(F.coalesce(F.sum("more"), F.lit(0)).alias("violations")).select(F.lit(gate).alias("gate"), "violations")


def assert_refs(df: DataFrame, gate: str, column: str, side: DataFrame, key: str) -> DataFrame:
    """Rows whose filled reference stands for no row of the side."""
    known = side.select(F.col(key).alias("_key")).where("_key is not null").distinct()
    return _counted(df.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_key"), "left_anti"), gate)


def assert_provenance(df: DataFrame, gate: str, columns: list[str]) -> DataFrame:
    """Rows that lack any of the columns that tell where they come from."""
    return assert_rows(df, gate, reduce(Column.__and__, (filled(F.col(c).cast("string")) != "" for c in columns)))


def assert_same_keys(a: DataFrame, b: DataFrame, gate: str, keys: list[str]) -> DataFrame:
    """Keys that only one of two tables has (repeats count)."""
    x, y = a.select(*keys), b.select(*keys)
    return _counted(x.exceptAll(y).union(y.exceptAll(x)), gate)


def assert_propagated(rows: DataFrame, source: DataFrame, gate: str, key: str, column: str) -> DataFrame:
    """Rows whose value differs from what the single source has for their key; keys that the source lacks are not judged."""
    truth = source.groupBy(F.col(key).alias("_k")).agg(F.max(column).alias("_v"))
    return _counted(rows.join(truth, F.col(key) == F.col("_k")).where(~F.col(column).eqNullSafe(F.col("_v"))), gate)


def assert_not_consumed(failed: DataFrame, used: DataFrame, gate: str, key: str, at: str, used_at: str) -> DataFrame:
    """Uses of a product after its last run failed: rows of used (key, used_at) not before the failure (key, at)."""
    last = failed.groupBy(F.col(key).alias("_k")).agg(F.max(at).alias("_at"))
    return _counted(used.join(last, F.col(key) == F.col("_k")).where(F.col(used_at) >= F.col("_at")), gate)


def schema_contract(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """(column, state): each column of the contract or the table: ok, missing, extra, or another type."""
    have = dict(df.dtypes)
    rows = [(c, "missing" if c not in have else "ok" if have[c] == kind else f"is {have[c]}") for c, kind in wanted.items()]
    rows += [(c, "extra") for c in have if c not in wanted]
    return df.sparkSession.createDataFrame(rows, "column string, state string")


def uncovered_names(df: DataFrame, known: list[str], pattern: str = r"[^\x00-\x7F]") -> DataFrame:
    """(column): columns with characters of the pattern in their names that no registry of names knows."""
    import re

    return df.sparkSession.createDataFrame([(c,) for c in df.columns if re.search(pattern, c) and c not in known], "column string")


def report(gates: list[DataFrame]) -> DataFrame:
    """(gate, violations, passed) of all gates, each counted by its own job part of one plan."""
    every = reduce(DataFrame.union, gates)
    return every.select("gate", "violations", (F.col("violations") == 0).alias("passed"))


def overall(spark: SparkSession, gates: list[DataFrame]) -> DataFrame:
    """One row (gates, passed, failed): the names of failed gates in order, joined by commas."""
    rows = report(gates)
    return rows.agg(F.count(F.lit(1)).alias("gates"), F.sum(F.col("passed").cast("long")).alias("passed"), F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("gate")))), ",").alias("failed"))
