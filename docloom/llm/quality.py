"""Quality rules that vote or abstain, combined by the accuracies that they turn out to have."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
CLEAN = r"(?<!\S)[\p{L}\p{M}\p{N}'’-]++[.,;:!?]?+(?!\S)"
ENDED = r"[.!?][\x20\x09-\x0D]*$"
WINDOW = 5
#: A row is kept from this posterior probability of good quality on.
KEEP_FROM = 0.5


def _per(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rules() -> dict[str, Column]:
    """name: vote, 1 for good, -1 for bad, 0 to abstain, over the columns of `measures`.

    The rules look at the same faults from several sides (decoration is seen by symbols, letters, clean_words and marks,
    repetition by lines, repeats, variety and top_word), so that expectation-maximisation can tell from their agreement how
    far each one is to be trusted. None decides alone.
    """

    def vote(value: Column, bad: float, good: float) -> Column:
        """Above `bad` objects, below `good` approves; the other way round if bad < good."""
        objects, approves = (value > bad, value < good) if bad > good else (value < bad, value > good)
        return F.when(objects, -1).when(approves, 1).otherwise(0)

    size = _per("word_chars", "n_words")
    return {
        "word_size": F.when((size < 3.2) | (size > 9), -1).when(size.between(3.8, 8), 1).otherwise(0),
        "symbols": vote(_per("n_symbols", "n_words"), 0.1, 0.03),
        "letters": vote(_per("n_alphanumeric", "word_chars"), 0.72, 0.9),
        "clean_words": vote(_per("n_clean_words", "n_words"), 0.7, 0.9),
        "marks": vote(_per("n_marks", "n_words"), 0.15, 0.05),
        "capitals": vote(_per("n_capitals", "n_letters"), 0.3, 0.12),
        "lines": vote(_per("n_dup_lines", "n_lines"), 0.3, 0.05),
        "repeats": vote(_per("n_repeat_words", "n_words"), 0.08, 0.03),
        "variety": vote(F.col("n_different") / F.sqrt(F.greatest("n_words", F.lit(1))), 2.5, 4.0),
        "ends": vote(_per("n_ended_lines", "n_lines"), 0.25, 0.75),
        "length": F.when(F.col("n_words") < 30, -1).when(F.col("n_words") >= 60, 1).otherwise(0),
    }


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_marks, n_letters, n_capitals,
    n_alphanumeric, n_clean_words (letters and digits, then at most one mark), n_different (words) and n_ended_lines of every whole text.

    n_repeat_words: windows of five words are compared by a 64-bit hash of their words' hashes. Texts in which all windows
    differ, most of them, are told by a distinct count; in the others the hashes are sorted with their places, equal
    neighbours give the repeated starts, and each start adds the words up to the next one, five at most.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    rows = rows.withColumn("_words", F.filter(F.split("_text", f"{BLANK}+"), lambda w: w != ""))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)))
    n = F.size("_words")
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"), F.regexp_count("_text", F.lit("[!?]")).cast("long").alias("n_marks"),
        F.length(F.regexp_replace("_text", r"\P{L}+", "")).alias("n_letters"), F.length(F.regexp_replace("_text", r"[^\p{L}\p{N}]+", "")).alias("n_alphanumeric"), F.length(F.regexp_replace("_text", r"\P{Lu}+", "")).alias("n_capitals"),
        F.regexp_count("_text", F.lit(CLEAN)).alias("n_clean_words"), F.size(F.array_distinct("_words")).alias("n_different"),
        F.size(F.filter("_lines", lambda x: x.rlike(ENDED))).alias("n_ended_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    window = F.transform(F.sequence(F.lit(1), F.size("_h") - WINDOW + 1), lambda i: F.xxhash64(F.slice("_h", i, WINDOW)))
    rows = rows.withColumn("_w", F.when(F.size("_h") >= WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    pairs = F.array_sort(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_s", F.when(F.size(F.array_distinct("_w")) < F.size("_w"), pairs))
    at = lambda a, i: F.try_element_at(a, i + 1)
    s = F.col("_s")
    twice = F.filter(s, lambda x, k: (at(s, k + 1)["h"] == x["h"]) | F.when(k > 0, at(s, k - 1)["h"] == x["h"]).otherwise(F.lit(False)))
    rows = rows.withColumn("_starts", F.array_sort(F.transform(twice, lambda x: x["i"])))
    starts = F.col("_starts")
    covered = F.aggregate(F.transform(starts, lambda x, k: F.least(F.coalesce(at(starts, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_h", "_w", "_s", "_starts")


def fit(votes: DataFrame, names: list[str], rounds: int = 200) -> tuple[float, dict[str, dict[int, float]]]:
    """(share of good rows, {rule: {vote: log odds}}) by expectation-maximisation over the counts of vote patterns.

    The counts cover all rows; there are at most 3 ** rules patterns, whatever the number of rows. Every rule has two rates,
    how often its vote is an objection on good rows and on bad ones; both are estimated from the rows alone, with one
    row added to either side, and nothing holds them to a range. The start is each row's own balance of votes, so the class
    with fewer objections is the good one. To abstain tells nothing. Without rows all votes count alike.
    """
    found = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).collect()
    seen = np.array([r[:-1] for r in found], float).reshape(-1, len(names))
    return estimate(seen, np.array([r[-1] for r in found], float), names, rounds)


def estimate(seen: np.ndarray, count: np.ndarray, names: list[str], rounds: int) -> tuple[float, dict[str, dict[int, float]]]:
    """What `fit` returns, from the patterns of votes and how many rows have each."""
    against, for_ = (seen < 0).astype(float), (seen > 0).astype(float)
    good = (1 + for_.sum(axis=1)) / (2 + (seen != 0).sum(axis=1))
    for _ in range(rounds):
        mass = np.stack([count * good, count * (1 - good)])
        objected, approved = mass @ against + 1, mass @ for_ + 1
        rate = objected / (objected + approved)
        prior = (mass[0].sum() + 1) / (count.sum() + 2)
        said = np.log(rate[0] / rate[1]), np.log((1 - rate[0]) / (1 - rate[1]))
        new = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + against @ said[0] + for_ @ said[1], -700, 700)))
        done = np.abs(new - good).max(initial=0.0) < 1e-9
        good = new
        if done:
            break
    return float(prior), {n: {-1: float(said[0][i]), 0: 0.0, 1: float(said[1][i])} for i, n in enumerate(names)}


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_from: float = KEEP_FROM, with_votes: bool = False) -> DataFrame:
    """Measures, votes and the posterior probability of good quality of every row.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality. base_failed:
    under 10 words, or over a fifth of the words repeated. kept: not base_failed, and quality >= keep_from. Null and empty
    texts count as no words and fail. With with_votes each rule's vote follows as a column of its name. Repeated rows are judged alike and all returned; an empty table gives no rows; other
    columns are left out.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    seen = measures(docs, id_col, text_col).withColumn("base_failed", failed)
    votes = cut(seen.select("*", *(v.alias(f"_v_{n}") for n, v in rules().items())))
    names = [f"_v_{n}" for n in rules()]
    share, odds = fit(votes.where(~F.col("base_failed")), names)
    total = F.lit(math.log(share / (1 - share)))
    for n in names:
        total = total + F.when(F.col(n) > 0, odds[n][1]).when(F.col(n) < 0, odds[n][-1]).otherwise(odds[n][0])
    out = votes.withColumn("quality", 1 / (1 + F.exp(-total)))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("quality") >= keep_from)).alias("kept"), "quality", *(F.col(f"_v_{n}").alias(n) for n in rules() if with_votes))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
