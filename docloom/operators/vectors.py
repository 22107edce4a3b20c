"""An approximate vector index on files: cells of k-means, residuals in product codes, exact re-ranking."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import cosine, l2

#: Vectors that cells and codes are fitted on; cells at most; codes of one piece of a vector; dimensions of a piece.
SAMPLE, MOST_CELLS, CODES, PIECE = 50_000, 4096, 256, 4
#: Sample vectors that ask, and the share of their nearest ones whose cells are to be probed, for the number of probes.
ASKING, COVERED, NEAREST = 400, 0.97, 10
#: Rows of one cell, and queries to one cell, that meet in one task.
CELL_ROWS, CELL_QUERIES = 50_000, 2000


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; zero rows stay zero."""
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size == 0, 1, size)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column without nulls as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k means of the rows of x; a mean that loses its rows is put on the row farthest from its own mean."""
    rnd = np.random.default_rng(seed)
    means = x[rnd.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near, far = closest(x, means)
        count = np.bincount(near, minlength=len(means))
        total = np.zeros_like(means)
        np.add.at(total, near, x)
        full = count > 0
        means[full] = total[full] / count[full, None]
        empty = np.flatnonzero(~full)
        means[empty] = x[np.argsort(-far)[: len(empty)]]
    return means


def needed_probes(x: np.ndarray, means: np.ndarray) -> int:
    """In how many of the nearest cells of a vector COVERED of its NEAREST nearest ones lie, by ASKING rows of x."""
    if not len(x):
        return 1
    asked, cell = x[:ASKING], closest(x, means)[0]
    size, ranks = (x**2).sum(axis=1), []
    for q in asked:
        near = np.argpartition(size - 2 * x @ q, min(NEAREST, len(x) - 1))[: NEAREST + 1]
        order = np.empty(len(means), np.int64)
        order[np.argsort((means**2).sum(axis=1) - 2 * means @ q)] = np.arange(len(means))
        ranks.append(order[cell[near]])
    return int(np.quantile(np.concatenate(ranks), COVERED)) + 1


def closest(x: np.ndarray, means: np.ndarray, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest mean, squared distance) of each row."""
    near, far, size = [], [], (means**2).sum(axis=1)
    for at in range(0, max(1, len(x)), block):
        part = x[at : at + block]
        d = (part**2).sum(axis=1)[:, None] - 2 * part @ means.T + size
        near.append(d.argmin(axis=1))
        far.append(d.min(axis=1))
    return np.concatenate(near), np.concatenate(far)


class VectorIndex:
    """An index of vectors of one dimension in a folder: `cells` (means), `books` (means of the residuals' pieces), `codes`
    (cell, row, code) with every row, and `vectors` (row, vector) for exact distances.

    Cells and books are fitted on SAMPLE vectors at most, taken by a hash of the key; all rows are assigned and coded by
    tasks. Means and books are of bounded size (MOST_CELLS vectors, CODES codes of each piece). Rows with a null key, a null
    vector or one of another length are left out.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        told = spark.read.parquet(f"{path}/means").orderBy("kind", "number").collect()
        self.means = np.array([r["mean"] for r in told if r["kind"] == -1], np.float32)
        pieces = max((r["kind"] for r in told), default=-1) + 1
        self.books = [np.array([r["mean"] for r in told if r["kind"] == p], np.float32) for p in range(pieces)]
        self.metric = told[0]["metric"] if told else "cosine"
        self.probes = next((r["number"] for r in told if r["kind"] == -2), 1)

    @classmethod
    def build(cls, vectors: DataFrame, row: str, vector: str, path: str, metric: str = "cosine", cells: int | None = None) -> VectorIndex:
        """A new index of vectors at path; cells: by default about the square root of the number of rows."""
        spark = vectors.sparkSession
        rows = vectors.where(F.col(row).isNotNull() & F.col(vector).isNotNull()).select(F.col(row).alias("row"), F.col(vector).cast("array<float>").alias("vector"))
        rows = rows.where(~F.exists("vector", lambda x: x.isNull()))
        told = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
        n, dim = told["n"], told["dim"] or 0
        rows = rows.where(F.size("vector") == dim)
        some = rows.where(F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1.0, SAMPLE / max(1, n)))).limit(SAMPLE).select("vector").toArrow()
        x = matrix(some.column("vector").combine_chunks(), dim) if some.num_rows else np.zeros((0, dim), np.float32)
        x = unit(x) if metric == "cosine" else x
        means = k_means(x, cells or min(MOST_CELLS, math.ceil(math.sqrt(n)) or 1)) if len(x) else x
        rest = x - means[closest(x, means)[0]] if len(x) else x
        books = [k_means(rest[:, at : at + PIECE], min(CODES, len(x)), seed=at) for at in range(0, dim, PIECE)] if len(x) else []
        entries = [(-2, needed_probes(x, means), metric, None)] + [(-1, i, metric, m.tolist()) for i, m in enumerate(means)] + [(p, i, metric, m.tolist()) for p, book in enumerate(books) for i, m in enumerate(book)]
        spark.createDataFrame(entries, "kind int, number int, metric string, mean array<float>").coalesce(1).write.parquet(f"{path}/means")
        index = cls(spark, path)
        rows.write.parquet(f"{path}/vectors")
        coded = index._coded(spark.read.parquet(f"{path}/vectors"))
        coded.repartitionByRange("cell", "row").sortWithinPartitions("cell").write.parquet(f"{path}/codes")
        return index

    def _prepared(self, column: pa.Array) -> np.ndarray:
        x = matrix(column, self.means.shape[1])
        return unit(x) if self.metric == "cosine" else x

    def _coded(self, rows: DataFrame) -> DataFrame:
        """(cell, row, code) of rows (row, vector)."""
        sent = rows.sparkSession.sparkContext.broadcast((self.means, self.books, self.metric))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            means, books, metric = sent.value
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column(1), means.shape[1])
                    x = unit(x) if metric == "cosine" else x
                    cell, _ = closest(x, means)
                    rest = x - means[cell]
                    code = np.stack([closest(rest[:, PIECE * p : PIECE * (p + 1)], book)[0] for p, book in enumerate(books)], axis=1).astype(np.uint8)
                    yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column(0), pa.array([c.tobytes() for c in code], pa.binary())], names=["cell", "row", "code"])

        return rows.select("row", "vector").mapInArrow(run, f"cell int, row {dict(rows.dtypes)['row']}, code binary")

    def nearest(self, queries: DataFrame, query: str, vector: str, k: int, probes: int | None = None, rerank: int = 20) -> DataFrame:
        """(query, row, distance, rank): about the k nearest rows of each query, their distances exact.

        Each query goes to its `probes` nearest cells (by default as many as the index found that its sample needs, see
        `needed_probes`), where the codes give the distance to each row; the rerank * k best of a query are compared
        exactly. Queries and rows of a cell that has many are dealt to parts that meet pairwise. Queries without a vector
        have no rows.
        """
        spark, probes = self.spark, probes or self.probes
        asked = queries.where(F.col(query).isNotNull() & F.col(vector).isNotNull()).select(F.col(query).alias("query"), F.col(vector).cast("array<float>").alias("asked")).where((F.size("asked") == self.means.shape[1]) & ~F.exists("asked", lambda x: x.isNull()) if len(self.means) else F.lit(False))
        kinds = dict(asked.dtypes)["query"], dict(spark.read.parquet(f"{self.path}/vectors").dtypes)["row"]
        sent = spark.sparkContext.broadcast((self.means, self.books, self.metric))

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            means, _, metric = sent.value
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column(1), means.shape[1])
                    x = unit(x) if metric == "cosine" else x
                    d = (means**2).sum(axis=1) - 2 * x @ means.T
                    cells = np.argsort(d, axis=1)[:, :probes]
                    at = np.repeat(np.arange(len(x)), cells.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(cells.ravel().astype(np.int32)), *(c.take(pa.array(at)) for c in batch.columns)], names=["cell", "query", "asked"])

        codes = spark.read.parquet(f"{self.path}/codes")
        probed = asked.mapInArrow(probe, f"cell int, query {kinds[0]}, asked array<float>")
        sizes = codes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("_r")).join(probed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("_q")), "cell")
        part = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        held = codes.join(F.broadcast(sizes), "cell").withColumn("r", part("row", "_r")).select("cell", "r", every("_q").alias("q"), "row", "code")
        asking = probed.join(F.broadcast(sizes), "cell").withColumn("q", part("query", "_q")).select("cell", every("_r").alias("r"), "q", "query", "asked")
        most = rerank * k

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            means, books, metric = sent.value
            names = ["query", "row", "about"]
            if not left.num_rows or not right.num_rows:
                return pa.Table.from_arrays([right.column("query").slice(0, 0), left.column("row").slice(0, 0), pa.array([], pa.float32())], names=names)
            code = np.frombuffer(b"".join(left.column("code").to_pylist()), np.uint8).reshape(left.num_rows, -1)
            x = matrix(right.column("asked").combine_chunks(), means.shape[1])
            x = (unit(x) if metric == "cosine" else x) - means[left.column("cell")[0].as_py()]
            rows, queries, about = [], [], []
            for i in range(len(x)):
                d = np.zeros(len(code), np.float32)
                for p, book in enumerate(books):
                    d += ((book - x[i, PIECE * p : PIECE * (p + 1)]) ** 2).sum(axis=1)[code[:, p]]
                best = np.argpartition(d, most - 1)[:most] if len(d) > most else np.arange(len(d))
                rows.append(best)
                queries.append(np.full(len(best), i))
                about.append(d[best])
            columns = [right.column("query").combine_chunks().take(pa.array(np.concatenate(queries))), left.column("row").combine_chunks().take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(about))]
            return pa.Table.from_arrays(columns, names=names)

        met = held.groupBy("cell", "r", "q").cogroup(asking.groupBy("cell", "r", "q")).applyInArrow(meet, f"query {kinds[0]}, row {kinds[1]}, about float")
        found = met.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy("about", "row"))).where(F.col("_n") <= most).select("query", "row")
        vectors = spark.read.parquet(f"{self.path}/vectors")
        pairs = found.join(vectors, "row").join(asked, "query")
        distance = (1 - cosine(F.col("vector"), F.col("asked"))) if self.metric == "cosine" else l2(F.col("vector"), F.col("asked"))
        exact = pairs.select("query", "row", F.round(distance, 6).alias("distance"))
        rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "row")).cast("long")
        return exact.withColumn("rank", rank).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(recall): the share of the exact pairs (query, row) that were found."""
    both = exact.select("query", "row").join(found.select(F.col("query").alias("_q"), F.col("row").alias("_r")).distinct().withColumn("_h", F.lit(1)), (F.col("query") == F.col("_q")) & (F.col("row") == F.col("_r")), "left")
    return both.agg(F.round(F.count("_h") / F.count(F.lit(1)), 4).alias("recall"))
