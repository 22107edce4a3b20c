"""Words of texts without blanks: found by how their letters hold together, and laid over sentences by the best path."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import cut

HAN_RUNS = "[一-鿿]+"
#: Log probability that a letter outside the dictionary costs beyond that of the rarest word.
UNKNOWN = 4.0


def grams(texts: DataFrame, text: str, most: int = 4, runs: str = HAN_RUNS) -> DataFrame:
    """(gram, n, left, right) of all runs of 1 to `most` letters inside the runs that `runs` matches.

    left, right: the entropy (in nats) of the letters before and after; each place at an end of a run counts as a letter of
    its own kind. Equal runs are taken apart once, and counts are found once for both sides.
    """
    each = texts.where(F.col(text).isNotNull()).select(F.explode(F.regexp_extract_all(F.col(text), F.lit(runs), 0)).alias("r")).groupBy("r").agg(F.count(F.lit(1)).alias("times"))

    def of(size: int) -> Column:
        places = F.when(F.length("r") >= size, F.sequence(F.lit(1), F.length("r") - size + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(F.substr("r", i, F.lit(size)).alias("gram"), F.when(i > 1, F.substr("r", i - 1, F.lit(1))).otherwise("").alias("before"), F.when(i + size <= F.length("r"), F.substr("r", i + size, F.lit(1))).otherwise("").alias("after")))

    rows = each.select("times", F.explode(F.concat(*(of(size) for size in range(1, most + 1)))).alias("g")).select("g.*", "times")
    counted = cut(rows.groupBy("gram", "before", "after").agg(F.sum("times").alias("n")))

    def entropy(side: str) -> DataFrame:
        sums = counted.groupBy("gram", side).agg(F.sum("n").alias("n"))
        return sums.groupBy("gram").agg(F.sum("n").alias("n"), (F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")).alias(side))

    left, right = entropy("before"), entropy("after").select(F.col("gram").alias("_g"), "after")
    return left.join(right, F.col("gram") == F.col("_g")).select("gram", "n", F.round("before", 6).alias("left"), F.round("after", 6).alias("right"))


def words(found: DataFrame, least: int = 5, cohesion: float = 2.0, freedom: float = 0.8) -> DataFrame:
    """(word, n, cohesion, freedom): grams that are words.

    A gram of two letters or more with `least` occurrences is one if at each cut its parts stand together exp(cohesion)
    times as often as by chance (the least logarithm counts), and if what stands before and after it varies: the lesser of
    both entropies is at least `freedom`.
    """
    total = found.where(F.length("gram") == 1).agg(F.sum("n").alias("_total"))
    long_ = found.where((F.length("gram") > 1) & (F.col("n") >= least) & (F.least("left", "right") >= freedom))
    cuts = long_.select("gram", "n", F.explode(F.sequence(F.lit(1), F.length("gram") - 1)).alias("k"), F.least("left", "right").alias("freedom"))
    cuts = cuts.select("gram", "n", "freedom", F.substr("gram", F.lit(1), F.col("k")).alias("a"), F.substr("gram", F.col("k") + 1).alias("b"))
    part = lambda name: found.select(F.col("gram").alias(name), F.col("n").alias(f"_n{name}"))
    met = cuts.join(part("a"), "a").join(part("b"), "b").join(F.broadcast(total))
    tie = F.log(F.col("n") * F.col("_total") / (F.col("_na") * F.col("_nb").cast("double")))
    held = met.groupBy(F.col("gram").alias("word"), "n").agg(F.round(F.min(tie), 6).alias("cohesion"), F.min("freedom").alias("freedom"))
    return held.where(F.col("cohesion") >= cohesion)


def best_path(run: str, logs: dict[str, float], most: int, other: float) -> list[str]:
    """The split of a run into words (and single letters) with the largest sum of logarithms; of equals the longer last word."""
    best, back = [0.0] + [-math.inf] * len(run), [0] * (len(run) + 1)
    for end in range(1, len(run) + 1):
        for start in range(max(0, end - most), end):
            value = logs.get(run[start:end], other if end - start == 1 else None)
            if value is not None and best[start] + value > best[end]:
                best[end], back[end] = best[start] + value, start
    out, end = [], len(run)
    while end:
        out.append(run[back[end] : end])
        end = back[end]
    return out[::-1]


def segmented(texts: DataFrame, row: str, text: str, dictionary: DataFrame, size: int = 200_000, runs: str = HAN_RUNS) -> DataFrame:
    """(row, at, word): the words of each run of letters in texts, in order from 0, by the best path over a dictionary.

    dictionary: (word, n); its `size` most frequent words are sent to the tasks, which bounds it. Letters that no word of it
    covers stand alone. Null texts have none.
    """
    held = dictionary.select("word", F.col("n").cast("double").alias("n")).orderBy(F.desc("n"), "word").limit(size).toArrow()
    total = sum(held.column("n").to_pylist()) or 1.0
    logs = {w: math.log(n / total) for w, n in zip(held.column("word").to_pylist(), held.column("n").to_pylist())}
    sent = texts.sparkSession.sparkContext.broadcast((logs, max(map(len, logs), default=1), min(logs.values(), default=0.0) - UNKNOWN))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, most, other = sent.value
        for batch in batches:
            rows, at, found = [], [], []
            for i, parts in enumerate(batch.column(1).to_pylist()):
                own = [w for part in parts for w in best_path(part, known, most, other)]
                rows += [i] * len(own)
                at += range(len(own))
                found += own
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(at, pa.int64()), pa.array(found)], names=["row", "at", "word"])

    parts = texts.where(F.col(text).isNotNull()).select(F.col(row).alias("row"), F.regexp_extract_all(F.col(text), F.lit(runs), 0).alias("parts"))
    return parts.mapInArrow(run, f"row {dict(parts.dtypes)['row']}, at long, word string")
