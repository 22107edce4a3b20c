"""Phrases whose words stand together more often than chance has it, counted with suffix automata of shards."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table

#: Bytes of text of one shard.
SHARD = 8 << 20
#: 64-bit words of the filter of frequent pairs that is sent to all tasks: 32 MB, whatever the corpus.
FILTER = 1 << 22
UNKNOWN = "und"

#: Bytes that end a piece (fixed: . , ; : ! ? and 0A to 0D), and those that end a word only (20 and 09).
_KIND = np.zeros(256, np.uint8)
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
_KIND[list(b" \t")] = 1


class Tokens(NamedTuple):
    """Words of a shard: a number for each place (from 0), whether a piece begins there, the words by number."""

    word: np.ndarray
    begins: np.ndarray
    words: pa.Array


def tokens(texts: list[bytes]) -> Tokens:
    """The words of texts, A-Z in lower case; pieces never run on into the next text."""
    data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    kind = _KIND[data]
    inside = kind == 0
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.r_[0, np.cumsum(end - start)].astype(np.int64)
    held = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())])
    encoded = held.dictionary_encode()
    piece = np.cumsum(kind == 2)[start]
    return Tokens(encoded.indices.to_numpy().astype(np.int64), np.r_[True, piece[1:] != piece[:-1]][: len(start)], encoded.dictionary)


class Automaton(NamedTuple):
    """States of the generalised suffix automaton of some pieces, of phrases up to a bounded depth.

    A state stands for the phrases that end at the same places; they are suffixes of its longest one. end: a place where
    they end; longest, shortest: lengths of its phrases; count: at how many places they end; link: the state of the longest
    suffix that ends elsewhere too (-1: none).
    """

    end: np.ndarray
    longest: np.ndarray
    shortest: np.ndarray
    count: np.ndarray
    link: np.ndarray


def automaton(word: np.ndarray, begins: np.ndarray, depth: int) -> Automaton:
    """The states are the nodes of the suffix tree of the reversed pieces, their suffix links the parents in it.

    So places are numbered by the last word, by the last two, and so on; a node whose places all go on to the left in one
    way is one state with the node below it.
    """
    n = len(word)
    room = np.arange(n) - np.maximum.accumulate(np.where(begins, np.arange(n), 0)) + 1  # words of the piece up to each place
    levels, number, at = [], np.zeros(n, np.int64), np.arange(n)
    for d in range(depth):
        at = at[room[at] > d]
        if not len(at):
            break
        _, first, inverse, count = np.unique(number[at] * (int(word.max()) + 1) + word[at - d], return_index=True, return_inverse=True, return_counts=True)
        levels.append((at[first], count, number[at[first]]))
        number[at] = inverse
    ends, longest, shortest, counts, links, base = [], [], [], [], [], 0
    above_state, above_length = np.zeros(1, np.int64) - 1, np.zeros(1, np.int64)  # of each node one level up
    for d, (end, count, parent) in enumerate(levels):
        most = np.zeros(len(count), np.int64)
        if d + 1 < len(levels):
            np.maximum.at(most, levels[d + 1][2], levels[d + 1][1])
        own = most < count  # the others are one state with the node below
        state = np.where(own, base + np.cumsum(own) - 1, above_state[parent])
        length = np.where(own, d + 1, above_length[parent])
        ends.append(end[own])
        longest.append(np.full(int(own.sum()), d + 1))
        shortest.append(above_length[parent][own] + 1)
        counts.append(count[own])
        links.append(above_state[parent][own])
        base += int(own.sum())
        above_state, above_length = state, length
    if not levels:
        return Automaton(*(np.zeros(0, np.int64) for _ in range(5)))
    return Automaton(*(np.concatenate(x) for x in (ends, longest, shortest, counts, links)))


def substrings(states: Automaton, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(end, count) of each distinct phrase of `length` words: every state gives those between its shortest and longest."""
    has = (states.shortest <= length) & (length <= states.longest)
    return states.end[has], states.count[has]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs of hashes, in order."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x165667B19E3779F9)
    return h ^ (h >> np.uint64(32))


def _hashes(words: pa.Array, lang: str) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Tokens]]:
    """(lang, tokens) of shards of about SHARD bytes of lang, text."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang, text in zip(langs, batch.column(1)):
            data = text.as_buffer()
            if data is None:
                continue
            held.setdefault(lang, []).append(data.to_pybytes())
            size += len(held[lang][-1])
            if size >= SHARD:
                for name, texts in held.items():
                    yield name, tokens(texts)
                held, size = {}, 0
    for name, texts in held.items():
        yield name, tokens(texts)


def _phrases(found: Tokens, end: np.ndarray, length: int) -> pa.Array:
    """The phrases of `length` words that end at the places `end`, joined by blanks."""
    import pyarrow.compute as pc

    parts = [found.words.take(pa.array(found.word[end - k])) for k in range(length - 1, -1, -1)]
    joined = parts[0] if length == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
    return joined.cast(pa.binary()).cast(pa.string())


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n): counts of the pairs of adjoining words in texts (lang, text), told by 64-bit hashes of lang and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in _shards(batches):
            if not len(found.word):
                continue
            end, count = substrings(automaton(found.word, found.begins, 2), 2)
            h = _hashes(found.words, lang)
            pair = _mixed(h[found.word[end - 1]], h[found.word[end]]).view(np.int64)
            if len(pair):
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(count)], names=["pair", "n"])

    return texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def pair_filter(pairs: DataFrame) -> np.ndarray:
    """FILTER words with a bit set for each pair; their number is bounded, so they may pass the driver."""
    at = F.shiftright("pair", 6).bitwiseAND(F.lit(FILTER - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pair").bitwiseAND(F.lit(63)).cast("int"))
    rows = pairs.groupBy(at.alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(FILTER, np.int64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out


def phrase_counts(texts: DataFrame, depth: int = 3, frequent: np.ndarray | None = None) -> DataFrame:
    """(lang, length, phrase, n) of all phrases of 1 to `depth` words in texts (lang, text).

    frequent: a `pair_filter`; phrases with a pair inside that it does not hold are left out (they are rarer than the pair).
    """
    sent = texts.sparkSession.sparkContext.broadcast(frequent) if frequent is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in _shards(batches):
            if not len(found.word):
                continue
            states = automaton(found.word, found.begins, depth)
            ok = np.ones(len(found.word), bool)  # whether the pair that ends at a place is frequent
            if sent is not None:
                h = _hashes(found.words, lang)[found.word]
                pair = np.r_[np.zeros(1, np.int64), _mixed(h[:-1], h[1:]).view(np.int64)]
                ok = (sent.value[(pair >> 6) & (FILTER - 1)] >> (pair & 63)) & 1 == 1
            for length in range(1, depth + 1):
                end, count = substrings(states, length)
                for k in range(length - 1):
                    keep = ok[end - k]
                    end, count = end[keep], count[keep]
                for at in range(0, len(end), 100_000):
                    e, c = end[at : at + 100_000], count[at : at + 100_000]
                    columns = [pa.array([lang] * len(e), pa.string()), pa.array(np.full(len(e), length, np.int32)), _phrases(found, e, length), pa.array(c)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "length", "phrase", "n"])

    counted = texts.mapInArrow(run, "lang string, length int, phrase string, n long")
    return counted.groupBy("lang", "length", "phrase").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, min_count: int = 10, cover: int = 50, top: int | None = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Phrases of 2 or 3 words by how much more often they stand together than their parts would by chance.

    Words are what blanks and tabs leave of pieces, pieces what . , ; : ! ? and line ends leave of texts, A-Z in lower
    case; everything is counted within each lang. Of a phrase with a >= min_count occurrences, cut after its first k words
    into parts with l and r occurrences, the score is floor(1000000 * a * a / (l * r)) at the cut where that is lowest (the
    first of equals). Phrases inside a longer one with at least `cover` hundredths of their count are dropped. Returns
    lang, rank (from 1, by score, then a, descending, then phrase), phrase, a, l, r, n (words of the lang), score of the
    first `top` of each lang (None: all).

    Every shard's automaton is walked twice: for the counts of pairs, by hash, and then for the counts of words, of
    frequent pairs, and of what has no other pairs inside, in full. Between, a filter of FILTER words tells the tasks which
    pairs are frequent; it never misses one, and the more of them there are the more others pass it and are only counted.
    Null texts have no words; a null lang is `und`. Repeated rows count each time; texts without words and empty tables
    give nothing; other columns are left out.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    frequent = pair_filter(pair_counts(texts).where(F.col("n") >= min_count))
    counted = cut(phrase_counts(texts, 3, frequent).where((F.col("n") >= min_count) | (F.col("length") == 1)))
    return scored(counted, min_count, cover, top)


def scored(counted: DataFrame, min_count: int, cover: int, top: int | None) -> DataFrame:
    """The rows of `collocations` from (lang, length, phrase, n): all words, and phrases of up to three with min_count or more."""
    word = lambda i: F.element_at(F.split("phrase", " "), i)
    frequent = counted.where(F.col("n") >= min_count)
    totals = counted.where("length = 1").groupBy("lang").agg(F.sum("n").alias("n_words"))
    two = frequent.where("length = 2").select("lang", "phrase", F.col("n").alias("a"), word(1).alias("w1"), word(2).alias("w2"))
    # Of three words, the suffix link is the last two; the first two are what the link of the reversed phrase is.
    three = frequent.where("length = 3").select("lang", "phrase", F.col("n").alias("a"), word(1).alias("w1"), F.concat_ws(" ", word(1), word(2)).alias("front"), F.concat_ws(" ", word(2), word(3)).alias("link"), word(3).alias("w3"))
    covering = three.select("lang", F.explode(F.array("front", "link")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    two = two.join(covering, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    ones = frequent.where("length = 1").select("lang", F.col("phrase").alias("_p"), F.col("n").alias("_n"))
    pairs = frequent.where("length = 2").select("lang", F.col("phrase").alias("_p"), F.col("n").alias("_n"))

    def with_count(rows: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
        return rows.join(counts.withColumnRenamed("_p", part).withColumnRenamed("_n", name), ["lang", part])

    def cuts(*at: tuple[int, str, str]) -> list:
        score = lambda l, r: F.expr(f"(cast(1000000 as decimal(38,0)) * cast(a as decimal(19,0)) * cast(a as decimal(19,0))) div (cast({l} as decimal(19,0)) * cast({r} as decimal(19,0)))")  # noqa: E731, E741
        return [F.struct(score(l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r")) for k, l, r in at]  # noqa: E741

    two = with_count(with_count(two, ones, "w1", "l1"), ones, "w2", "r1")
    two = two.select("lang", "phrase", "a", *(c.alias("cut") for c in cuts((1, "l1", "r1"))))
    three = with_count(with_count(with_count(with_count(three, ones, "w1", "l1"), pairs, "link", "r1"), pairs, "front", "l2"), ones, "w3", "r2")
    three = three.select("lang", "phrase", "a", F.least(*cuts((1, "l1", "r1"), (2, "l2", "r2"))).alias("cut"))
    rows = two.unionByName(three).select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = rows.withColumn("rank", rank)
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n_words").alias("n"), "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
told AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
each AS (SELECT lang, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM told),
run AS (SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM each WINDOW o AS (PARTITION BY p ORDER BY i)),
f AS (
  SELECT lang, 1 AS k, w AS phrase, count(*) AS n FROM run GROUP BY ALL
  UNION ALL SELECT lang, 2, w || ' ' || w2, count(*) FROM run WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3, count(*) FROM run WHERE w3 IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND n >= 10),
longer AS (SELECT lang, ws[1] || ' ' || ws[2] AS phrase, a FROM cand WHERE k = 3 UNION ALL SELECT lang, ws[2] || ' ' || ws[3], a FROM cand WHERE k = 3),
most AS (SELECT lang, phrase, max(a) AS a FROM longer GROUP BY ALL),
stay AS (SELECT c.* FROM cand c LEFT JOIN most m ON c.k = 2 AND c.lang = m.lang AND c.phrase = m.phrase WHERE m.a IS NULL OR 100 * m.a < 50 * c.a),
cuts AS (
  SELECT lang, phrase, a, 1 AS cut, ws[1] AS x, array_to_string(ws[2:], ' ') AS y FROM stay
  UNION ALL SELECT lang, phrase, a, 2, ws[1] || ' ' || ws[2], ws[3] FROM stay WHERE k = 3),
scores AS (SELECT c.lang, c.phrase, c.a, cut, x.n AS l, y.n AS r, (1000000::HUGEINT * c.a * c.a // (x.n::HUGEINT * y.n))::BIGINT AS score FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y),
least AS (SELECT lang, phrase, a, arg_min(l, [score, cut]) AS l, arg_min(r, [score, cut]) AS r, min(score) AS score FROM scores GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT s.lang, rank, phrase, a, l, r, t.n, score FROM ranked s JOIN totals t ON s.lang = t.lang WHERE rank <= 2000
"""
