"""Near-duplicate documents by SimHash fingerprints, linked through deletion variants."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, table

SEED = 42
SHINGLE = 4
MAX_BITS = 4
#: Fingerprints of one variant that a task compares at once; larger groups are compared tile by tile.
TILE = 8192
#: Groups up to this size are compared row by row together, larger ones one after another.
SMALL = 24


def bits_above_half(hashes: np.ndarray) -> np.ndarray:
    """Whether each of the 64 bits is set in over half of the unsigned 64-bit hashes."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        total += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return 2 * total > len(hashes)


def shingle_hashes(text: str | None, n_words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle of n_words words, repeats included; of the whole sequence if there are fewer words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(1, len(words) - n_words + 1)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[len(words) - n :])), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint as a signed 64-bit number; no hashes: 0."""
    return int(np.packbits(bits_above_half(hashes), bitorder="little").view(np.int64)[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, n_words: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; texts without words have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(shingle_hashes(t.as_py(), n_words)) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """Bit ranges so few that, of max_bits differing bits, at most one falls into some range."""
    n = max_bits // 2 + 1
    ends = [round(64 * i / n) for i in range(n + 1)]
    return list(zip(ends, ends[1:]))


def variants(fp: Column, max_bits: int) -> list[Column]:
    """64 keys: each segment with each one of its bits masked. Segments that differ by one bit at most share a key."""
    keys = []
    for low, high in segments(max_bits):
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        keys += [part.bitwiseAND(F.lit(((1 << (high - low)) - 1) & ~(1 << i))).bitwiseOR(F.lit((low + i) << 40)) for i in range(high - low)]
    return keys


def group_links(group: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the row that leads each one's component, in which rows of a group are linked at max_bits or fewer.

    fps: one column for each row, with as many fingerprints as are compared together. group: sorted. Within a group a search spreads from row to row over those not yet reached, so dense groups take
    little more than one comparison a row, and no group gives more links than it has rows.
    """
    n = len(group)
    lead = np.arange(n)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    at = np.repeat(size, size)
    a_all, b_all = [], []
    for d in range(1, min(SMALL, int(size.max(initial=1)))):
        i = np.flatnonzero((group[:-d] == group[d:]) & (at[:-d] <= SMALL))
        i = i[_apart(fps[:, i], fps[:, i + d]) <= max_bits]
        a_all.append(i)
        b_all.append(i + d)
    if a_all:
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        while len(a):
            low = np.minimum(lead[a], lead[b])
            before = lead.copy()
            np.minimum.at(lead, a, low)
            np.minimum.at(lead, b, low)
            if (before == lead).all():
                break
    for start, count in zip(first[size > SMALL], size[size > SMALL]):
        rest = np.arange(start, start + count)
        while len(rest):
            root, todo, rest = rest[0], [rest[0]], rest[1:]
            while todo and len(rest):
                near = _apart(fps[:, rest], fps[:, todo.pop()][:, None]) <= max_bits
                found = rest[near]
                lead[found] = root
                todo.extend(found.tolist())
                rest = rest[~near]
    rows = np.flatnonzero(lead != np.arange(n))
    return rows, lead[rows]


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which the fingerprints of each column differ, all together."""
    return np.bitwise_count(a ^ b).sum(axis=0, dtype=np.int64)


def tiled(rows: DataFrame, key: str, row: str, tile: int) -> DataFrame:
    """rows with a column `tile`, so that no (key, tile) has more than about two tiles of rows and any two rows of a key meet in one.

    How large a key is, is estimated from one row in 64 by a hash (every row where tiles are small): the estimate only
    decides into how many parts the key is dealt, never which rows meet.
    """
    rate = 64 if tile >= 4096 else 1
    some = rows.where(F.pmod(F.xxhash64(row, F.lit(3)), F.lit(rate)) == 0)
    hot = cut(some.groupBy(key).agg((F.count(F.lit(1)) * rate).alias("n")).where(F.col("n") > tile))
    if not hot.limit(1).count():
        return rows.withColumn("tile", F.lit(0))
    parts = hot.select(F.col(key).alias("_key"), F.ceil(F.col("n") / tile).cast("int").alias("_parts"))
    rows = rows.join(parts, F.col(key) == F.col("_key"), "left")
    mine = F.pmod(F.xxhash64(row), F.col("_parts")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda i: F.least(mine, i) * F.col("_parts") + F.greatest(mine, i))
    return rows.withColumn("tile", F.explode(F.when(F.col("_parts").isNull(), F.array(F.lit(0))).otherwise(tiles))).drop("_key", "_parts")


def whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int = 2) -> Iterator[pa.Table]:
    """Tables in which each value of the first n_keys columns (by which the rows are sorted) is whole."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for values in (batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)):
            new[1:] |= values[1:] != values[:-1]
        new[0] = not kept or any(batch.column(i)[0] != kept[-1].column(i)[-1] for i in range(n_keys))
        last = int(np.flatnonzero(new)[-1]) if new.any() else -1
        if last < 0:
            kept.append(batch)
            continue
        if last:
            kept.append(batch.slice(0, last))
        if kept:
            yield pa.Table.from_batches(kept)
        kept = [batch.slice(last)]
    if kept:
        yield pa.Table.from_batches(kept)


def group_of(rows: pa.Table, n_keys: int = 2) -> np.ndarray:
    """A number for each value of the first n_keys columns of sorted rows."""
    keys = [rows.column(i).to_numpy() for i in range(n_keys)]
    return np.cumsum(np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])


def links(rows: DataFrame, max_bits: int, tile: int = TILE) -> DataFrame:
    """(a, b) of ids, enough links to give all components of rows (id, fp) whose fingerprints differ in max_bits bits or fewer.

    rows: distinct ids, cheap to compute again. Equal variants meet in one group, and groups larger than `tile` meet part
    by part.
    """
    met = tiled(rows.select("id", "fp", F.explode(F.array(*variants(F.col("fp"), max_bits))).alias("key")), "key", "id", tile)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in whole_groups(batches):
            a, b = group_links(group_of(found), found.column(3).to_numpy().view(np.uint64)[None], max_bits)
            if len(a):
                ids = found.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])

    return met.select("key", "tile", "id", "fp").repartition("key", "tile").sortWithinPartitions("key", "tile").mapInArrow(run, "a long, b long").distinct()


def dedup(docs: DataFrame, n_words: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint and component of near-duplicates.

    Returns doc_id, fingerprint (16 lower-case hex digits), component_id (the smallest doc_id reachable through
    fingerprints that differ by max_bits bits at most; equal ones included). Texts without words, null ones too, have
    fingerprint zero and are linked like any other. Repeated rows are all returned; rows without an id take part and are
    passed over for component_id (null if a component has no id). An empty table gives no rows; other columns are left out.
    """
    rows = cut(fingerprints(docs, n_words, id_col, text_col))
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("doc"))
    led = components(links(fps.select(F.col("fp").alias("id"), "fp"), max_bits))
    group = fps.join(led, F.col("fp") == F.col("node"), "left").select("fp", "doc", F.coalesce("component", "fp").alias("root"))
    least = group.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = group.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
