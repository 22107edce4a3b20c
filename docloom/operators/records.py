"""Filters, pages, facets, deduplication and survivorship over record tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_filter(df: DataFrame, limit: int | None = None, **wanted: object) -> DataFrame:
    """Rows whose columns equal the given values; empty or null values are no condition; limit None is unlimited."""
    for name, value in wanted.items():
        if value not in (None, ""):
            df = df.where(F.col(name) == F.lit(value))
    return df if limit is None else df.limit(limit)


def like_tokens(text: str, columns: list[str]) -> Column:
    """Every blank-separated token (without % and _) stands in some column, ASCII case aside."""
    tokens = [t.replace("%", "").replace("_", "").lower() for t in text.split()]
    hits = [reduce(Column.__or__, (F.contains(F.lower(F.col(c)), F.lit(t)) for c in columns)) for t in tokens if t]
    return reduce(Column.__and__, hits, F.lit(True))


def page(df: DataFrame, sort: str, tie: str, desc: bool = False, number: int = 1, size: int = 20) -> DataFrame:
    """One page of df by `sort`, ties by `tie`, with the number of all rows in column total.

    Only rows up to the page's end are sorted out of each partition (a bounded take), so a page of a large table is cheap.
    """
    total = df.agg(F.count(F.lit(1)).alias("total"))
    order = F.desc_nulls_last(sort) if desc else F.asc_nulls_last(sort)
    return df.orderBy(order, F.asc(tie)).offset((number - 1) * size).limit(size).join(F.broadcast(total))


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n): counts of each column's values, all columns in one pass."""
    shown = df.select(*(F.col(c).cast("string").alias(c) for c in columns))
    pairs = F.inline(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in columns)))
    return shown.select(pairs).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: list[str], row: str) -> DataFrame:
    """Keys that several rows share, with their count and the rows' ids, sorted; null keys are left out."""
    known = df.where(reduce(Column.__and__, (F.col(k).isNotNull() for k in keys)))
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(row)), ",").alias("rows")).where("n > 1")


def duplicate_rows(df: DataFrame, keys: list[str], row: str) -> DataFrame:
    """(keys.., n, row): `duplicate_keys` with a row for each id, so that a key's ids are never gathered in one."""
    known = df.where(reduce(Column.__and__, (F.col(k).isNotNull() for k in keys)))
    several = known.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return known.join(several, [F.col(k) == F.col(f"_{k}") for k in keys]).select(*keys, "n", row)


def content_duplicates(df: DataFrame, text: str, row: str) -> DataFrame:
    """(digest, n, first_row) of texts that several rows have."""
    return df.groupBy(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("first_row")).where("n > 1")


def latest_wins(df: DataFrame, keys: list[str], at: str, sequence: str, values: list[str]) -> DataFrame:
    """Each key's values at its latest time; of equal times the later row wins. No sort of whole groups: one aggregate."""
    last = F.max_by(F.struct(*values), F.struct(at, sequence))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def survivorship(df: DataFrame, keys: list[str], order: list[str], status: str, rank: str) -> DataFrame:
    """A status ledger folded in order: a row is confirmed, applied (its rank is at least the current one) or skipped.

    Returns the keys, the final status and rank, and how many rows were confirmed, applied, skipped and in conflict (applied
    with rank 2 or more over another verdict that had been applied). Rows are sorted by key and order, which may spill, and
    read on with the state of one key at a time, so the ledger of a key is never held whole. A null rank counts as 0.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(status).cast("string").alias("_s"), F.coalesce(F.col(rank), F.lit(0)).cast("int").alias("_r"), F.struct(*order).alias("_o"))
    sorted_ = rows.repartition(*names).sortWithinPartitions(*names, "_o", "_s", "_r")
    kinds = dict(rows.dtypes)
    fields = [*(f"{n} {kinds[n]}" for n in names), "status string", *(f"{c} int" for c in ("rank", "confirmed", "applied", "skipped", "conflicts"))]
    told = sorted_.select(*names, "_s", "_r").mapInArrow(_folded, ", ".join(fields))
    return told.select(*(F.col(n).alias(k) for k, n in zip(keys, names)), "status", "rank", "confirmed", "applied", "skipped", "conflicts")


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fold of `survivorship` over rows (keys.., status, rank) sorted by key and order."""
    key, state, schema = None, [], None

    def out(done: list) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k, _ in done], schema[i].type) for i in range(len(schema) - 2)]
        values = [pa.array([s[i] for _, s in done], pa.string() if i == 0 else pa.int32()) for i in range(6)]
        return pa.RecordBatch.from_arrays([*columns, *values], names=[*schema.names[:-2], "status", "rank", "confirmed", "applied", "skipped", "conflicts"])

    for batch in batches:
        schema, done = batch.schema, []
        *own, statuses, ranks = (c.to_pylist() for c in batch.columns)
        for now, status, rank in zip(zip(*own), statuses, ranks):
            if now != key or not state:
                if state:
                    done.append((key, state))
                key, state = now, [None, -1, 0, 0, 0, 0]
            if status == state[0]:
                state[2] += 1
            elif rank >= state[1]:
                state[5] += state[3] > 0 and rank >= 2
                state[0], state[1] = status, rank
                state[3] += 1
            else:
                state[4] += 1
        if done:
            yield out(done)
    if state:
        yield out([(key, state)])


def version_chain(df: DataFrame, keys: list[str], order: list[str], row: str) -> DataFrame:
    """df with version (from 1) and replaces (the row before) of each key's rows in order."""
    at = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("version", F.row_number().over(at).cast("long")).withColumn("replaces", F.lag(row).over(at))


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, change) of rows added, removed or changed between two snapshots."""
    a, b = before.select(F.col(key).alias("_a"), F.col(digest).alias("_x")), after.select(F.col(key).alias("_b"), F.col(digest).alias("_y"))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("_x").eqNullSafe(F.col("_y")), "changed")
    return a.join(b, F.col("_a") == F.col("_b"), "full").select(F.coalesce("_a", "_b").alias(key), change.alias("change")).where("change is not null")


def table_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row (n, digest) that tells whether two tables have the same rows in any order; sums of parts of MD5 digests, no sort."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(h).cast("string").alias("digest"))


def first_match(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """The name of the first rule that holds."""
    out = None
    for name, rule in rules:
        out = F.when(rule, name) if out is None else out.when(rule, name)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)
