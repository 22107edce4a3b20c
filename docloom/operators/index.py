"""A scored inverted index on files: terms with their postings in blocks of rows, best blocks first, changed by segments."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import shared_folder
from .search import K1, B, occurrences

#: Rows of one block, blocks that are scored first, and terms of a query that are written into the filter of a scan.
BLOCK_ROWS, FIRST, LISTED = 100_000, 4, 1000
#: Letters of the texts whose terms a task holds at once, and rows of a batch that it is sent.
PART_CHARS, BATCH_ROWS = 1 << 20, 500
#: Files of a block, by terms.
SLICES = 8
#: What the list of segments tells of each.
ENTRY = "number int, folder string, base boolean, n_rows long, total long, n_blocks long, columns array<string>, kind string"


class Found(NamedTuple):
    """rows: (row, score), best first; read and blocks: how many blocks of rows were scored, and how many there are."""

    rows: DataFrame
    read: int
    blocks: int


def tokens_of(text: str) -> list[str]:
    return [t.strip("\"'").lower() for t in text.split()]


def small_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch (row, block, length, texts..), by length of PART_CHARS at most or of one row."""
    start, held = 0, 0
    for n, length in enumerate(batch.column(2).to_pylist()):
        if held and held + length > PART_CHARS:
            yield batch.slice(start, n - start)
            start, held = n, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Meanwhile Arrow batches have BATCH_ROWS rows at most; what the session had is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _terms(df: DataFrame, columns: list[str]) -> DataFrame:
    """(term, row, block, f0.., length) of df (row, block, c0..): frequencies of the terms of each row, column by column.

    A term is a run without blanks, in lower case. Each row is counted where it stands, so no text is shuffled.
    """
    names = ["term", "row", "block", *(f"f{i}" for i in range(len(columns))), "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_parts(whole):
                at, terms, counts, lengths = [], [], [[] for _ in columns], batch.column(2)
                texts = batch.columns[3:]
                for n in range(batch.num_rows):
                    found = [Counter(t[n].as_py().encode().split()) for t in texts]
                    own = set().union(*found)
                    terms += own
                    at += [n] * len(own)
                    for i, f in enumerate(found):
                        counts[i] += [f[w] for w in own]
                places = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()).cast(pa.string()), batch.column(0).take(places), batch.column(1).take(places), *(pa.array(c, pa.int32()) for c in counts), lengths.take(places)], names=names)

    kind = dict(df.dtypes)["row"]
    fields = f"term string, row {kind}, block int, " + ", ".join(f"f{i} int" for i in range(len(columns))) + ", length long"
    return df.select("row", "block", "length", *(f"c{i}" for i in range(len(columns)))).mapInArrow(run, fields)


class TextIndex:
    """An index of text columns in a folder, for `bm25` queries: the same rows and scores as by a scan of the texts.

    A segment holds `rows` (row, block, length), `postings` (term, row, frequencies, length; a folder for each block, sorted
    by term), and `impacts` (term, block: rows, largest frequencies, least length). Rows are added as a further segment, and
    rows taken away or replaced are listed in `dead` with the number of the segment from which they count; `merge` writes
    one segment of what lives, from the postings alone. `segments` lists them, and a segment counts once it is listed.
    One writer at a time. Rows are told by a key column; of rows with one key in a table any may count, null keys none.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def build(cls, df: DataFrame, row: str, columns: list[str], path: str, block_rows: int = BLOCK_ROWS) -> TextIndex:
        """A new index of df at path."""
        index = cls(df.sparkSession, path)
        index._write(df, row, columns, 0, block_rows, True)
        return index

    def _segments(self) -> list:
        found = sorted(self.spark.read.schema(ENTRY).parquet(f"{self.path}/segments").collect(), key=lambda s: s["number"])
        base = max(i for i, s in enumerate(found) if s["base"])
        return found[base:]

    def _dead(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/dead")
        except AnalysisException:
            return None

    def _part(self, name: str, live: bool = True, segments: list | None = None) -> DataFrame:
        """A table of all segments, with their numbers; rows that are dead left out."""
        dead = self._dead() if live else None
        parts = []
        for s in segments or self._segments():
            counts = ", ".join(f"f{i} int" for i in range(len(s["columns"])))
            schema = {"rows": f"row {s['kind']}, block int, length long", "postings": f"term string, row {s['kind']}, {counts}, length long, block int", "impacts": f"term string, block int, n long, {counts}, length long"}[name]
            part = self.spark.read.schema(schema).parquet(f"{self.path}/{s['folder']}/{name}").withColumn("segment", F.lit(s["number"]))
            if dead is not None:
                gone = dead.where(F.col("number") > s["number"]).select(F.col("row").alias("_gone")).distinct()
                part = part.join(gone, F.col("row") == F.col("_gone"), "left_anti")
            parts.append(part)
        return reduce(DataFrame.unionByName, parts)

    def _write(self, df: DataFrame, row: str, columns: list[str], number: int, block_rows: int, base: bool) -> None:
        texts = [F.coalesce(F.col(c), F.lit("")) for c in columns]
        rows = df.where(F.col(row).isNotNull()).dropDuplicates([row]).select(F.col(row).alias("row"), sum((F.length(t) for t in texts), F.lit(0)).cast("long").alias("length"), *(F.lower(t).alias(f"c{i}") for i, t in enumerate(texts)))
        n = max(1, math.ceil(df.count() / block_rows))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
        with short_batches(self.spark):
            self._store(rows.select("row", "block", "length"), _terms(rows, columns), columns, number, base)

    def _store(self, rows: DataFrame, postings: DataFrame, columns: list[str], number: int, base: bool) -> None:
        folder = f"segment-{number}-{uuid.uuid4().hex[:8]}"
        at = f"{self.path}/{folder}"
        rows.write.parquet(f"{at}/rows")
        dealt = postings.repartition("block", F.pmod(F.xxhash64("term"), F.lit(SLICES))).sortWithinPartitions("block", "term")
        dealt.write.partitionBy("block").parquet(f"{at}/postings")
        kept = self.spark.read.schema(postings.schema).parquet(f"{at}/postings")
        most = [F.max(f"f{i}").alias(f"f{i}") for i in range(len(columns))]
        impacts = kept.groupBy("term", "block").agg(F.count(F.lit(1)).alias("n"), *most, F.min("length").alias("length"))
        impacts.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{at}/impacts")
        kind = dict(rows.dtypes)["row"]
        told = self.spark.read.schema(f"row {kind}, block int, length long").parquet(f"{at}/rows").agg(F.count(F.lit(1)), F.sum("length"), F.count_distinct("block")).first()
        entry = [(number, folder, base, told[0], told[1] or 0, told[2], columns, kind)]
        self.spark.createDataFrame(entry, ENTRY).coalesce(1).write.mode("append").parquet(f"{self.path}/segments")

    def _next(self) -> int:
        dead = self._dead()
        last = dead.agg(F.max("number")).first()[0] if dead is not None else None
        return max(self._segments()[-1]["number"], last or 0) + 1

    def remove(self, rows: DataFrame, row: str) -> None:
        """Takes rows away, by key."""
        self._bury(rows.select(F.col(row).alias("row")).distinct(), self._next())

    def _bury(self, keys: DataFrame, number: int) -> None:
        old = self._part("rows", live=False).select(F.col("row").alias("_old")).distinct()
        keys.join(old, F.col("row") == F.col("_old"), "left_semi").withColumn("number", F.lit(number)).write.mode("append").parquet(f"{self.path}/dead")

    def add(self, df: DataFrame, row: str, block_rows: int = BLOCK_ROWS) -> None:
        """Adds rows, or puts them in the place of those with the same key."""
        number, columns = self._next(), self._segments()[-1]["columns"]
        self._bury(df.select(F.col(row).alias("row")).distinct(), number)
        self._write(df, row, columns, number, block_rows, False)

    def merge(self, block_rows: int = BLOCK_ROWS) -> None:
        """One segment of the rows that live, in place of all; the old ones stay for readers that have begun."""
        number, columns = self._next(), self._segments()[-1]["columns"]
        rows, postings = self._part("rows"), self._part("postings")
        n = max(1, math.ceil(rows.count() / block_rows))
        block = F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
        fields = ["term", "row", "block", *(f"f{i}" for i in range(len(columns))), "length"]
        self._store(rows.withColumn("block", block).select("row", "block", "length"), postings.withColumn("block", block).select(*fields), columns, number, True)

    def top(self, weights: dict[str, float], text: str, k: int) -> Found:
        """The k best rows that hold every token of `text`, with their scores: see `bm25`.

        Tokens have no blanks, so each stands inside a term, and what it counts in a row is what it counts in the row's
        terms. Blocks get an upper bound of their scores from the impacts; the FIRST best are scored, and then all others
        whose bound is not below the k-th score so far. Their number passes the driver, no rows do.
        """
        segments, tokens = self._segments(), tokens_of(text)
        columns = segments[-1]["columns"]
        weight = [float(weights.get(c, 0.0)) for c in columns]
        if set(weights) != set(columns):
            raise ValueError(f"the lengths in the index are those of {columns}, so each needs a weight")
        impacts = self._part("impacts", False, segments)
        holds = reduce(Column.__or__, [F.contains("term", F.lit(t)) for t in tokens], F.lit(False))
        hits = impacts.where(holds)
        terms = hits.select("term").distinct()
        listed = [r["term"] for r in terms.limit(LISTED + 1).collect()]

        def matched(postings: DataFrame) -> DataFrame:
            found = postings.where(F.col("term").isin(listed)) if len(listed) <= LISTED else postings.join(terms, "term", "left_semi")
            return found.groupBy("segment", "block", "row").agg(F.first("length").alias("len"), *(F.sum(occurrences(F.col("term"), t) * tf).alias(f"tf{i}") for i, t in enumerate(tokens)))

        tf = reduce(Column.__add__, [F.lit(w) * F.col(f"f{i}") for i, w in enumerate(weight)])
        postings = self._part("postings", True, segments)
        n, total = self._totals(segments)
        counts = self._frequencies(hits, tokens, matched(postings), len(listed), weight)
        idf = [max(1e-6, math.log((n - c + 0.5) / (c + 0.5))) for c in counts]
        average = total / n if n else 0.0

        def score(f: list[Column], length: Column) -> Column:
            return reduce(Column.__add__, [F.lit(w) * (x * (K1 + 1)) / (x + K1 * (1 - B + B * length / F.lit(float(average or 1)))) for w, x in zip(idf, f)], F.lit(0.0))

        names = [F.col(f"tf{i}") for i in range(len(tokens))]
        every = reduce(Column.__and__, [c > 0 for c in names], F.lit(True))
        best = hits.groupBy("segment", "block").agg(F.min("length").alias("len"), *(F.sum(occurrences(F.col("term"), t) * tf).alias(f"tf{i}") for i, t in enumerate(tokens)))
        bounds = best.where(every).select("segment", "block", score(names, F.col("len")).alias("most")).orderBy(F.desc("most"), "segment", "block").collect()
        rows = matched(postings).where(every).select("segment", "block", "row", F.round(score(names, F.col("len")), 6).alias("score"))
        order = [F.desc("score"), "row"]
        first = bounds[:FIRST]
        least = rows.where(_in_blocks(first)).orderBy(*order).limit(k).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).first()
        rest = [b for b in bounds[FIRST:] if least["n"] < k or b["most"] >= least["least"] - 1e-6]
        return Found(rows.where(_in_blocks([*first, *rest])).select("row", "score").orderBy(*order).limit(k), len(first) + len(rest), sum(s["n_blocks"] for s in segments))

    def _totals(self, segments: list) -> tuple[int, int]:
        if self._dead() is None:
            return tuple(map(sum, zip(*((s["n_rows"], s["total"]) for s in segments))))
        told = self._part("rows", True, segments).agg(F.count(F.lit(1)), F.sum("length")).first()
        return told[0], told[1] or 0

    def _frequencies(self, hits: DataFrame, tokens: list[str], matched: DataFrame, n_terms: int, weight: list[float]) -> list[int]:
        """Rows that hold each token: from the impacts if it stands in one term only and no row is dead, else from the postings."""
        used = reduce(Column.__or__, [F.col(f"f{i}") > 0 for i, w in enumerate(weight) if w], F.lit(False))
        if n_terms <= len(tokens) and self._dead() is None and all(weight):
            told = hits.agg(*(F.sum(F.when(F.contains("term", F.lit(t)), F.col("n"))).alias(f"n{i}") for i, t in enumerate(tokens)), *(F.count_distinct(F.when(F.contains("term", F.lit(t)) & used, F.col("term"))).alias(f"t{i}") for i, t in enumerate(tokens))).first()
            if all(told[f"t{i}"] <= 1 for i in range(len(tokens))):
                return [told[f"n{i}"] or 0 for i in range(len(tokens))]
        told = matched.agg(*(F.sum((F.col(f"tf{i}") > 0).cast("int")).alias(f"n{i}") for i in range(len(tokens)))).first()
        return [told[f"n{i}"] or 0 for i in range(len(tokens))]


def _in_blocks(blocks: list) -> Column:
    by: dict[int, list[int]] = {}
    for b in blocks:
        by.setdefault(b["segment"], []).append(b["block"])
    return reduce(Column.__or__, [(F.col("segment") == s) & F.col("block").isin(bs) for s, bs in by.items()], F.lit(False))


def index_of(df: DataFrame, row: str, columns: list[str]) -> TextIndex:
    """The index of a table read from files, in the shared folder; built if there is none yet of these files as they are.

    Files are told by path, length and time of change.
    """
    spark = df.sparkSession
    conf, told = spark._jsc.hadoopConfiguration(), []
    for name in sorted(df.inputFiles()):
        at = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = at.getFileSystem(conf).getFileStatus(at)
        told.append(f"{name}\0{status.getLen()}\0{status.getModificationTime()}")
    digest = hashlib.sha256("\n".join([row, *columns, *told]).encode()).hexdigest()[:32]
    path = f"{shared_folder(spark)}/index-{digest}"
    ready = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/segments/_SUCCESS")
    if ready.getFileSystem(conf).exists(ready):
        return TextIndex(spark, path)
    return TextIndex.build(df, row, columns, path)
