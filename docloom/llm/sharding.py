"""Stable assignment of rows to shards by jump consistent hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, table

N_SHARDS = 40


def jump(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key: it jumps ahead by ever larger steps, and the last stop before n_shards holds."""
    key = keys.astype(np.uint64)
    shard, ahead = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
    while (go := ahead < n_shards).any():
        shard = np.where(go, ahead, shard)
        key = key * np.uint64(2862933555777941757) + np.uint64(1)
        ahead = np.where(go, ((shard + 1) * (float(1 << 31) / ((key >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64), ahead)
    return shard


def shard_of(key: Column, n_shards: int) -> Column:
    """Shard from 0 to n_shards - 1 of any key column; null keys share one shard."""

    @F.pandas_udf("int")
    def stop(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy().view(np.uint64), n_shards).astype(np.int32))

    return stop(F.xxhash64(key))


def assign(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text", n_rows: int | None = None) -> DataFrame:
    """Each row's shard, place in the shard and shard after one more shard is appended.

    Returns doc_id, size (UTF-8 bytes + 16; null text: 16), text_crc32 (null text: 0), law ("key"), shard, slot (gapless
    from 0 in each shard), grown_shard. Only doc_id and the shard count decide the shard, so rows with one id stay
    together, null ids too; appending a shard moves rows only into it. Repeated rows are all kept, each with a slot of its
    own; an empty table gives no rows. Other columns are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("shard", shard_of(F.col("doc_id"), n_shards)).withColumn("grown_shard", shard_of(F.col("doc_id"), n_shards + 1))
    rows = numbered(rows, ["shard"], ["doc_id", "size", "text_crc32"], "slot", docs.count() if n_rows is None else n_rows)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))
