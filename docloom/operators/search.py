"""Full-text and vector search."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import cosine, l2

K1, B = 1.2, 0.75


def occurrences(text: Column, term: str) -> Column:
    """How often the term stands in the text, ASCII case aside, without overlaps."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    return ((F.length(lower) - F.length(F.replace(lower, F.lit(term.lower()), F.lit("")))) / len(term)).cast("long")


def bm25(df: DataFrame, row: str, weights: dict[str, float], text: str, k: int) -> DataFrame:
    """(row, score): the k rows that hold every token of `text` (three characters or more each), best first.

    A token matches as a substring, case aside. The frequency of a token is the weighted sum over the columns, the length
    that of all columns in characters; idf is floored at a millionth. Frequencies and the corpus's counts come from one
    scan each; only k rows are collected from each task.
    """
    terms = [t.strip("\"'") for t in text.split()]
    length = sum((F.length(F.coalesce(F.col(c), F.lit(""))) for c in weights), F.lit(0))
    tf = lambda t: sum((F.lit(w) * occurrences(F.col(c), t) for c, w in weights.items()), F.lit(0.0))
    rows = df.select(row, length.alias("_len"), *(tf(t).alias(f"_tf{i}") for i, t in enumerate(terms)))
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("_len").alias("avg"), *(F.sum((F.col(f"_tf{i}") > 0).cast("int")).alias(f"df{i}") for i in range(len(terms)))).first()
    score, found = F.lit(0.0), F.lit(True)
    for i in range(len(terms)):
        df_i = stats[f"df{i}"] or 0
        idf = max(1e-6, math.log(((stats["n"] or 0) - df_i + 0.5) / (df_i + 0.5)))
        f = F.col(f"_tf{i}")
        score = score + F.lit(idf) * (f * (K1 + 1)) / (f + K1 * (1 - B + B * F.col("_len") / F.lit(float(stats["avg"] or 1))))
        found = found & (f > 0)
    return rows.where(found).select(row, F.round(score, 6).alias("score")).orderBy(F.desc("score"), row).limit(k)


def fts_capable(text: str) -> bool:
    """Whether every token of a query has three characters or more, so that trigrams can find it."""
    tokens = [t.strip("\"'") for t in text.split()]
    return bool(tokens) and all(len(t) >= 3 for t in tokens)


def trigrams(text: Column) -> Column:
    """Different runs of three characters, in lower case."""
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.length(t) >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(t) - 2), lambda i: F.substr(t, i, F.lit(3))))).otherwise(F.array().cast("array<string>"))


def postings(df: DataFrame, row: str, column: str) -> DataFrame:
    """(gram, row): an index of a text column by trigrams; write it once, partitioned by gram, to search it often."""
    return df.select(F.explode(trigrams(F.col(column))).alias("gram"), row)


def by_postings(index: DataFrame, df: DataFrame, row: str, column: str, text: str) -> DataFrame:
    """Rows of df that hold every token of `text`, found through the index and then compared."""
    tokens = [t.strip("\"'").lower() for t in text.split()]
    grams = sorted({t[i : i + 3] for t in tokens for i in range(len(t) - 2)})
    found = index.where(F.col("gram").isin(grams)).groupBy(row).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(grams)).select(F.col(row).alias("_r"))
    holds = F.lit(True)
    for t in tokens:
        holds = holds & F.contains(F.lower(F.col(column)), F.lit(t))
    return df.join(found, F.col(row) == F.col("_r"), "left_semi").where(holds)


def best_of_each(best: DataFrame, df: DataFrame, row: str, k: int, same: list[str]) -> DataFrame:
    """Of the rows `best` (row, score) with equal `same` in df the best, and of these the k best."""
    met = best.join(df.select(F.col(row).alias("_r"), *(F.col(c).alias(f"_{c}") for c in same)), F.col(row) == F.col("_r"))
    first = F.row_number().over(Window.partitionBy(*(f"_{c}" for c in same)).orderBy(F.desc("score"), row))
    return met.withColumn("_n", first).where("_n = 1").select(row, "score").orderBy(F.desc("score"), row).limit(k)


def bm25_once(df: DataFrame, row: str, weights: dict[str, float], text: str, k: int, same: list[str]) -> DataFrame:
    """bm25's best 2k rows, of rows with equal `same` the best, and of these the k best."""
    return best_of_each(bm25(df, row, weights, text, 2 * k), df, row, k, same)


def search(df: DataFrame, row: str, column: str, text: str, k: int) -> DataFrame:
    """(row, score): by bm25 if the query can be found by trigrams, else rows that hold every token, shortest first, score 0."""
    if fts_capable(text):
        return bm25(df, row, {column: 1.0}, text, k)
    from .records import like_tokens

    return df.where(like_tokens(text, [column])).orderBy(F.length(column), row).limit(k).select(row, F.lit(0.0).alias("score"))


#: Bytes of queries that are sent to the tasks at once, and queries of one block of them.
SENT_BYTES, QUERY_BLOCK = 64 << 20, 256
#: Bytes (as 4-byte numbers) of the vectors of one part, rows of the smallest part that is made for the sake of more tasks,
#: and distances that are held at once.
PART_BYTES, PART_ROWS, HELD = 64 << 20, 5_000, 4 << 20


def nearest(vectors: DataFrame, row: str, vector: str, queries: DataFrame, query: str, query_vector: str, k: int, metric: str = "cosine") -> DataFrame:
    """(query, row, distance, rank): the k nearest rows of each query, by exact comparison.

    A stated query set meets all rows. Rows are dealt to parts of PART_BYTES at most and queries to blocks of SENT_BYTES at
    most; each part meets each block in one task, as products of matrices (`_met`), which gives the k best of its rows. A
    product of single precision only tells which rows may be among them; their distances are the sums of doubles that
    `cosine` and `l2` give. Vectors that are no row of a matrix (another length, missing or not finite places) are compared
    one by one (`_one_by_one`). Queries without a vector have no rows. `VectorIndex` answers without comparing all.
    """
    asked = queries.where(F.col(query).isNotNull() & F.col(query_vector).isNotNull()).select(F.col(query).alias("q"), F.col(query_vector).cast("array<double>").alias("v"))
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(row).alias("row"), F.col(vector).cast("array<double>").alias("v"))
    dim = asked.agg(F.max(F.size("v")).alias("dim")).first()["dim"] or 0
    plain = (F.size("v") == dim) & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < 1e15)) & (F.lit(dim > 0))
    told = [df.agg(F.count(F.lit(1)).alias("n"), F.count_if(plain).alias("plain")).first() for df in (asked, rows)]
    out = _met(rows.where(plain), asked.where(plain), told[1]["plain"], told[0]["plain"], dim, k, metric)
    if told[0]["plain"] < told[0]["n"]:
        out = out.union(_one_by_one(rows, asked.where(~F.coalesce(plain, F.lit(False))), k, metric))
    if told[1]["plain"] < told[1]["n"]:
        out = out.union(_one_by_one(rows.where(~F.coalesce(plain, F.lit(False))), asked.where(plain), k, metric))
    best = Window.partitionBy("query").orderBy("distance", "row")
    return out.withColumn("distance", F.round("distance", 6)).withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k)


def _one_by_one(rows: DataFrame, asked: DataFrame, k: int, metric: str) -> DataFrame:
    """(query, row, distance) of the k nearest rows (row, v) of each query (q, v), by expressions.

    Queries are dealt to numbered blocks, and blocks to waves of SENT_BYTES at most; the blocks of a wave are a small table,
    sent to the tasks and joined by block.
    """
    told = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    blocks = max(1, math.ceil((told["n"] or 0) / QUERY_BLOCK))
    waves = max(1, math.ceil((told["n"] or 0) * (told["dim"] or 0) * 8 / SENT_BYTES))
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int"))
    out = None
    for wave in range(waves):
        own = [b for b in range(blocks) if b % waves == wave]
        sent = numbered.where(F.pmod("block", F.lit(waves)) == wave).groupBy("block").agg(F.collect_list(F.struct("q", "v")).alias("asked"))
        dealt = rows.withColumn("block", F.explode(F.sequence(F.lit(own[0]), F.lit(own[-1]), F.lit(waves))))
        each = dealt.join(F.broadcast(sent), "block").select("row", F.col("v").alias("_v"), F.explode("asked").alias("_q"))
        distance = (1 - cosine(F.col("_v"), F.col("_q.v"))) if metric == "cosine" else l2(F.col("_v"), F.col("_q.v"))
        each = each.select(F.col("_q.q").alias("query"), "row", distance.alias("distance"))
        best = Window.partitionBy("query").orderBy(F.round("distance", 6), "row")
        each = each.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).drop("_n")
        out = each if out is None else out.union(each)
    return out


def _met(rows: DataFrame, asked: DataFrame, n_rows: int, n_asked: int, dim: int, k: int, metric: str) -> DataFrame:
    """(query, row, distance), among them the k nearest rows (row, v) of each query (q, v); all vectors have dim finite places."""
    slots = 2 * rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, math.ceil(n_rows * dim * 4 / PART_BYTES), min(slots, math.ceil(n_rows / PART_ROWS)))
    blocks = max(1, math.ceil(n_asked * dim * 4 / SENT_BYTES))
    kinds = dict(rows.dtypes)["row"], dict(asked.dtypes)["q"]
    every = lambda first, n, step: F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: first + i * step)).alias("part")
    part, block = F.pmod(F.xxhash64("row", "v"), F.lit(parts)).cast("int"), F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int")
    dealt = rows.select(every(part * blocks, blocks, 1), F.lit(None).cast(kinds[1]).alias("q"), "row", "v")
    dealt = dealt.union(asked.select(every(block, parts, blocks), "q", F.lit(None).cast(kinds[0]), "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {True: ([], []), False: ([], [])}
        for batch in batches:
            is_row = pc.is_null(batch.column("q"))
            for kind in (True, False):
                own = batch.filter(is_row if kind else pc.invert(is_row))
                if own.num_rows:
                    found[kind][0].append(own.column("row" if kind else "q"))
                    found[kind][1].append(own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
        if not found[True][0] or not found[False][0]:
            return
        (ids, v), (names, q) = ((pa.chunked_array(c).combine_chunks(), np.concatenate(x)) for c, x in (found[True], found[False]))
        found.clear()
        for at, near, distance in nearest_in(ids, v, q, k, metric):
            yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), ids.take(pa.array(near)), pa.array(distance)], names=["query", "row", "distance"])

    return dealt.repartitionById(parts * blocks, F.col("part")).select("q", "row", "v").mapInArrow(run, f"query {kinds[1]}, row {kinds[0]}, distance double")


def _summed(terms: Iterable[np.ndarray]) -> np.ndarray:
    """Sum of arrays of doubles, one after another, as an aggregate over an array adds them."""
    total = 0.0
    for x in terms:
        total = total + x
    return total


def nearest_in(ids: pa.Array, v: np.ndarray, q: np.ndarray, k: int, metric: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of queries and of rows, and their distances: among them the k nearest rows of v of each row of q.

    Equal vectors are compared once, and the k with the least ids count of each. What may be among the k nearest is told by
    single precision with a bound on its error, and by how far two distances may lie apart that are rounded to one.
    """
    order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
    _, first, same = np.unique(np.ascontiguousarray(v[order] + 0.0).view(np.dtype((np.void, v.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
    v, members = v[order][first], np.argsort(same, kind="stable")
    start = np.searchsorted(same[members], np.arange(len(v) + 1))
    long_v, long_q = (np.sqrt(_summed(c * c for c in x.T)) for x in (v, q))
    error = 4 * (v.shape[1] + 8) * np.finfo(np.float32).eps
    if metric == "cosine":
        scaled = [(x / np.where(n > 0, n, 1)[:, None]).astype(np.float32) for x, n in ((v, long_v), (q, long_q))]
        slack = np.full(len(q), 2e-6 + error)
    else:
        middle = v.mean(axis=0)
        scaled = [(x - middle).astype(np.float32) for x in (v, q)]
        square_v, square_q = ((x * x).sum(axis=1) for x in scaled)
        most = np.abs(v).max(initial=0.0) + np.abs(q).max(initial=0.0)
        slack = error * (square_q.astype(float) + float(square_v.max(initial=0.0)) + 1e-30) + 1e-12 * most * most
    step = max(1, HELD // max(1, len(v)))
    for low in range(0, len(q), step):
        high = min(len(q), low + step)
        near = scaled[1][low:high] @ scaled[0].T
        if metric == "cosine":
            np.subtract(1, near, out=near)
        else:
            near *= -2
            near += square_v
            near += square_q[low:high, None]
        bound = np.partition(near, k - 1, axis=1)[:, k - 1].astype(float) if len(v) > k else np.full(high - low, np.inf)
        if metric == "cosine":
            bound += slack[low:high]
        else:
            bound = (np.sqrt(np.maximum(bound + slack[low:high], 0)) + 2e-6) ** 2 + slack[low:high]
        at, which = np.nonzero(near <= bound[:, None])
        for cut in range(0, len(at), HELD // 16):
            a, w = at[cut : cut + HELD // 16] + low, which[cut : cut + HELD // 16]
            if metric == "cosine":
                size = long_v[w] * long_q[a]
                dot = _summed(v[w, i] * q[a, i] for i in range(v.shape[1]))
                distance = 1 - np.where(size > 0, dot / np.where(size > 0, size, 1), 0.0)
            else:
                distance = np.sqrt(_summed((v[w, i] - q[a, i]) ** 2 for i in range(v.shape[1])))
            n = np.minimum(start[w + 1] - start[w], k)
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(a, n), order[members[np.repeat(start[w], n) + inner]], np.repeat(distance, n)


def prototypes(vectors: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, prototype): the mean vector of each label, summed place by place before the shuffle."""
    each = vectors.select(label, F.posexplode(vector).alias("i", "x")).groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return each.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("prototype"))


def jaccard(a: DataFrame, b: DataFrame, query: str, row: str) -> DataFrame:
    """(query, overlap): shared share of the rows that two searches found for each query."""
    x = a.groupBy(query).agg(F.collect_set(row).alias("_a"))
    y = b.groupBy(F.col(query).alias("_q")).agg(F.collect_set(row).alias("_b"))
    both = x.join(y, F.col(query) == F.col("_q"))
    return both.select(query, F.round(F.size(F.array_intersect("_a", "_b")) / F.size(F.array_union("_a", "_b")), 4).alias("overlap"))
