"""Joins of texts by the share of their matching blocks, through few candidates."""

from __future__ import annotations

import math
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import cut

#: Length up to which words are looked up by what is left of them without some letters.
SHORT_WORD = 20
#: Keys of remainders, and pairs of words that met, that a task has at once.
KEYS, PAIRS = 1 << 18, 1 << 18
#: Letters of asked words that a task holds before it sends them on.
HELD = 1 << 21


def block_ratio(a: str, b: str) -> float:
    """2 * M / (length of a + length of b), M the letters in matching blocks: the longest one, then those left and right of it."""
    return SequenceMatcher(None, a, b).ratio()


def least_common(length: Column, least: float) -> Column:
    """Letters that a text of `length` shares at least with any text that it reaches `least` with."""
    return F.ceil(F.lit(least / (2 - least)) * length - 1e-9).cast("int")


def least_pairs(length: Column, least: float) -> Column:
    """Pairs of adjoining letters that it shares at least; not above 0: none need be.

    Of la and lb letters M match, in blocks between which some letter is left over, so at most la + lb - 2M + 1 blocks with
    M less their number pairs, that is 3M - (la + lb) - 1, where M is at least `least` halves of la + lb.
    """
    return F.ceil(F.lit((1.5 * least - 1) * (1 + least / (2 - least))) * length - 1 - 1e-9).cast("int")


def numbered_grams(text: Column, n: int) -> Column:
    """Runs of n letters, each with its number among equal ones, so that sets of them count repeats."""
    grams = F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(0), F.length(text) - n), lambda i: F.substr(text, i + 1, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    sorted_ = F.array_sort(grams)
    return F.transform(sorted_, lambda g, i: F.concat(g, F.lit("\0"), (i - F.array_position(sorted_, g)).cast("string")))


def _prefixes(texts: DataFrame, least: float, within: list[str]) -> DataFrame:
    """(side, text, token, within): of each distinct text the rarest tokens, so many that texts that reach `least` share one.

    Tokens are pairs of letters where a text must share some; single letters for short texts, and for those that may be
    like a short one.
    """
    size = F.length("text")
    by_pairs = least_pairs(size, least) >= 1
    short = least_pairs(F.floor(size * F.lit(least / (2 - least)) + 1e-9).cast("int"), least) < 1
    kinds = F.array(
        F.when(by_pairs, F.struct(F.lit(2).alias("kind"), numbered_grams(F.col("text"), 2).alias("grams"), (size - 1 - least_pairs(size, least) + 1).alias("take"))),
        F.when(~by_pairs | short, F.struct(F.lit(1).alias("kind"), numbered_grams(F.col("text"), 1).alias("grams"), (size - least_common(size, least) + 1).alias("take"))),
    )
    each = texts.where(size > 0).select("side", "text", *within, F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("k")).select("side", "text", *within, "k.kind", "k.take", F.explode("k.grams").alias("gram"))
    tokens = each.select("side", "text", *within, "kind", "take", F.concat(F.col("kind").cast("string"), F.col("gram")).alias("token"))
    counts = tokens.groupBy(F.col("token").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    # Spark knows how large the texts are, not their tokens, which it would gather in the driver.
    ranked = tokens.join(counts.hint("merge"), F.col("token") == F.col("_t")).groupBy("side", "text", *within, "kind", "take").agg(F.array_sort(F.collect_list(F.struct("_n", "token"))).alias("all"))
    return ranked.select("side", "text", *within, F.explode(F.slice("all", 1, F.greatest(F.col("take"), F.lit(1)))["token"]).alias("token"))


def verified(pairs: DataFrame, least: float) -> DataFrame:
    """(a, b, .., ratio) of pairs (a, b, ..) whose block ratio is at least `least`; quick upper bounds are tried first."""
    names = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = SequenceMatcher()
        for batch in batches:
            keep, ratios = [], []
            for i, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                matcher.set_seqs(a, b)
                if matcher.real_quick_ratio() >= least and matcher.quick_ratio() >= least and (ratio := matcher.ratio()) >= least:
                    keep.append(i)
                    ratios.append(ratio)
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(keep, pa.int64())) for c in batch.columns), pa.array(ratios, pa.float64())], names=[*names, "ratio"])

    return pairs.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in pairs.dtypes) + ", ratio double")


def like_texts(left: DataFrame, right: DataFrame, text: str, other: str, least: float, within: list[str] | None = None) -> DataFrame:
    """(a, b, within.., ratio): different texts of left.text and right.other whose block ratio (of a with b) is at least `least`.

    within: columns that both sides share and that must agree. Distinct texts meet by their rarest tokens (see `_prefixes`),
    lengths that rule the ratio out are passed over, each pair that has met is verified once. No pair that reaches the
    ratio is lost. Null texts count as none, empty ones are like nothing.
    """
    within = within or []
    side = lambda df, c, n: df.where(F.col(c).isNotNull()).select(F.lit(n).alias("side"), F.col(c).alias("text"), *within).distinct()
    tokens = _prefixes(side(left, text, 0).union(side(right, other, 1)), least, within)
    a = tokens.where("side = 0").select(F.col("text").alias("a"), "token", *within)
    b = tokens.where("side = 1").select(F.col("text").alias("b"), "token", *within)
    la, lb = F.length("a"), F.length("b")
    fits = (F.least(la, lb) * 2 >= F.lit(least) * (la + lb) - 1e-9) & (F.col("a") != F.col("b"))
    pairs = a.join(b, ["token", *within]).where(fits).select("a", "b", *within).distinct()
    return verified(pairs, least)


def held_in(left: DataFrame, right: DataFrame, text: str, other: str, inner: int, within: list[str] | None = None) -> DataFrame:
    """(a, b, within..): different texts, a of left.text with `inner` letters at least, that stands in b of right.other.

    a is looked up by the rarest of its runs of `inner` letters among those of the other side.
    """
    within = within or []
    runs = lambda t: F.array_distinct(F.transform(F.sequence(F.lit(0), F.length(t) - inner), lambda i: F.substr(t, i + 1, F.lit(inner))))
    long_ = right.where(F.length(other) > inner).select(F.col(other).alias("b"), *within).distinct().select("b", *within, F.explode(runs(F.col("b"))).alias("run"))
    counts = long_.groupBy(F.col("run").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    short = left.where(F.length(text) >= inner).select(F.col(text).alias("a"), *within).distinct().select("a", *within, F.explode(runs(F.col("a"))).alias("run"))
    rarest = short.join(counts, F.col("run") == F.col("_r"), "left").groupBy("a", *within).agg(F.min(F.struct(F.coalesce("_n", F.lit(0)), "run"))["run"].alias("run"))
    met = rarest.join(long_, ["run", *within]).where(F.contains("b", F.col("a")) & (F.col("a") != F.col("b")))
    return met.select("a", "b", *within)


def same_titles(rows: DataFrame, row: str, title: str, least: float = 0.82, inner: int = 6, within: list[str] | None = None) -> DataFrame:
    """(a, b): rows (a < b) whose titles stand for one document: equal, one in the other (`inner` letters or more), or with a
    block ratio of `least`. Null and empty titles are never alike. Of two rows the one with the lesser key asks."""
    within = within or []
    named = rows.where(F.length(title) > 0).select(F.col(row).alias("_row"), F.col(title).alias("_title"), *within)
    inside = held_in(named, named, "_title", "_title", inner, within)
    linked = like_texts(named, named, "_title", "_title", least, within).drop("ratio").withColumn("way", F.lit(True))
    both = linked.union(inside.withColumn("way", F.lit(True))).union(inside.select(F.col("b").alias("a"), F.col("a").alias("b"), *within, F.lit(True).alias("way"))).drop("way").distinct()
    x = named.select(F.col("_row").alias("ra"), F.col("_title").alias("a"), *within)
    y = named.select(F.col("_row").alias("rb"), F.col("_title").alias("b"), *within)
    equal = x.join(y.withColumnRenamed("b", "a"), ["a", *within]).where("ra < rb").select("ra", "rb")
    other = x.join(both, ["a", *within]).join(y, ["b", *within]).where("ra < rb").select("ra", "rb")
    return equal.union(other).select(F.col("ra").alias("a"), F.col("rb").alias("b"))


def spare_letters(length: int, least: float) -> int:
    """How many letters of a word of `length` at most stand in no matching block of a word with which it reaches `least`."""
    other = next(n for n in range(1, length + 1) if math.ceil(least * (length + n) / 2 - 1e-9) <= n)
    return length - math.ceil(least * (length + other) / 2 - 1e-9)


def remains(word: str, spare: int) -> set[str]:
    """What is left of a word without up to `spare` of its letters."""
    return {"".join(kept) for n in range(max(1, len(word) - spare), len(word) + 1) for kept in combinations(word, n)}


def called(size: int, other: int, least: float) -> int:
    """Letters that two words of these lengths have in matching blocks at least where they reach `least`."""
    return math.ceil(least * (size + other) / 2 - 1e-9)


def coded(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _keys(codes: np.ndarray, left: int) -> np.ndarray:
    """Keys of what is left of words of one length without all but `left` letters: a row for each choice of letters.

    A key is a sum of letters times powers by their places. Prefix sums of it, with the letters moved by as many places as
    have gone before, give each choice by one sum for each letter that goes.
    """
    count, size = codes.shape
    spare = size - left
    letters = codes.T.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    letters ^= letters >> np.uint64(29)
    letters *= np.uint64(0xBF58476D1CE4E5B9)
    letters ^= letters >> np.uint64(32)
    powers = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(size)], np.uint64)
    sums = np.zeros((spare + 1, size + 1, count), np.uint64)  # of letters before a place where so many have gone
    for gone in range(spare + 1):
        np.cumsum(letters[gone:] * powers[: size - gone, None], axis=0, out=sums[gone, gone + 1 :])
    out = np.array(list(combinations(range(size), spare)), np.intp).reshape(math.comb(size, spare), spare)
    keys = np.broadcast_to(sums[spare, size], (len(out), count)).copy()
    for gone in range(spare):
        keys += (sums[gone, :size] - sums[gone + 1, 1:])[out[:, gone]]
    keys += np.uint64(left)
    keys ^= keys >> np.uint64(32)
    keys *= np.uint64(0xC2B2AE3D27D4EB4F)
    return keys


def remainder_keys(words: list[str], spare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of `remains` of each word, all of one length: the word's number, a 64-bit key of the letters left, and how many they are.

    Repeats may stay. Equal remainders have equal keys; different ones may, too.
    """
    codes = coded(words)
    found = [(n, _keys(codes, n)) for n in range(max(1, codes.shape[1] - spare), codes.shape[1] + 1)]
    return np.concatenate([np.tile(np.arange(len(words)), len(k)) for _, k in found]), np.concatenate([k.ravel().view(np.int64) for _, k in found]), np.concatenate([np.full(k.size, n, np.int32) for n, k in found])


def first_at(codes: np.ndarray, place: int) -> np.ndarray:
    """Which words have a letter at a place that they do not have before."""
    return (codes[:, :place] != codes[:, place : place + 1]).all(axis=1)


def keys_from(codes: np.ndarray, left: int, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of words, keys): the remainders of `left` letters that begin with `first`, KEYS or so at a time."""
    size = codes.shape[1]
    for place in range(size - left + 1):
        own = np.flatnonzero((codes[:, place] == first) & first_at(codes, place))  # a later one leaves nothing else
        step = max(1, KEYS // math.comb(size - place - 1, left - 1))
        for start in range(0, len(own), step):
            part = own[start : start + step]
            keys = _keys(codes[part, place + 1 :], left - 1)
            yield np.tile(part, len(keys)), keys.ravel()


def matching_letters(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Letters in matching blocks, as `block_ratio` finds them, of each row of code points a with the same row of b."""
    total, (count, la), lb = np.zeros(len(a), np.int64), a.shape, b.shape[1]
    row = np.arange(count)
    from_a, to_a, from_b, to_b = (np.full(count, n, np.int8) for n in (0, la, 0, lb))
    at_a, at_b = np.arange(la, dtype=np.int8)[:, None], np.arange(lb, dtype=np.int8)[:, None]
    while len(row):
        # Letters outside the stretches that are compared are like none.
        x = np.where((at_a >= from_a) & (at_a < to_a), a[row].T, np.uint32(0xFFFFFFFF))
        y = np.where((at_b >= from_b) & (at_b < to_b), b[row].T, np.uint32(0xFFFFFFFE))
        size, end_a, end_b = (np.zeros(len(row), np.int8) for _ in range(3))
        run, before = (np.zeros((lb + 1, len(row)), np.int8) for _ in range(2))
        for i in range(la):
            run, before = before, run
            for j in range(lb):
                np.multiply(before[j] + np.int8(1), x[i] == y[j], out=run[j + 1])
                longer = run[j + 1] > size
                if longer.any():
                    np.copyto(size, run[j + 1], where=longer)
                    np.copyto(end_a, np.int8(i + 1), where=longer)
                    np.copyto(end_b, np.int8(j + 1), where=longer)
        total += np.bincount(row, size, count).astype(np.int64)
        parts = [(row, from_a, end_a - size, from_b, end_b - size), (row, end_a, to_a, end_b, to_b)]
        keep = [(size > 0) & (p[1] < p[2]) & (p[3] < p[4]) for p in parts]
        row, from_a, to_a, from_b, to_b = (np.concatenate([p[k][w] for p, w in zip(parts, keep)]) for k in range(5))
    return total


def met_words(asked: dict[int, np.ndarray], entries: dict[int, np.ndarray], left: int, first: int, least: float) -> Iterator[tuple[int, np.ndarray, int, np.ndarray, np.ndarray]]:
    """(length, rows of asked, length, rows of entries, ratios): different words, by their lengths, that reach `least`, have just
    `left` letters in matching blocks where they just reach it, and a remainder of `left` letters in common that begins with `first`.

    A pair may come repeatedly.
    """
    index = {}
    for lb, codes in entries.items():
        if found := list(keys_from(codes, left, first)):
            rows, keys = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(keys)
            shift = np.uint64(64 - max(10, (8 * len(keys)).bit_length()))
            seen = np.zeros(1 << int(64 - shift), bool)
            seen[keys >> shift] = True
            index[lb] = rows[order], keys[order], shift, seen
    for la, codes in asked.items():
        others = [lb for lb in index if called(la, lb, least) == left]
        for rows, keys in keys_from(codes, left, first) if others else ():
            for lb in others:
                known, sorted_, shift, seen = index[lb]
                may = np.flatnonzero(seen[keys >> shift])
                low, high = (np.searchsorted(sorted_, keys[may], side) for side in ("left", "right"))
                ends = np.cumsum(high - low)
                done = 0
                while done < len(ends):
                    upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS, "right")))
                    n = (high - low)[done:upto]
                    a = np.repeat(rows[may[done:upto]], n)
                    b = known[np.repeat(low[done:upto] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                    done = upto
                    a, b = np.divmod(np.unique(a * np.int64(len(entries[lb])) + b), len(entries[lb]))
                    ratios = 2.0 * matching_letters(codes[a], entries[lb][b]) / (la + lb)
                    like = np.flatnonzero((ratios >= least) & (ratios < 1))
                    if len(like):
                        yield la, a[like], lb, b[like], ratios[like]


def _parts(codes: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of words, parts): where words of one length are to meet others, by how many of their letters are left and by
    the first of these."""
    size = codes.shape[1]
    for left in range(max(1, size - spare_letters(size, least)), size + 1):
        for place in range(size - left + 1):
            own = np.flatnonzero(first_at(codes, place))
            yield own, codes[own, place].astype(np.int64) | left << 32


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    """Numbers of words by their length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes)}


def _asked_parts(words: DataFrame, word: str, least: float) -> DataFrame:
    """(part, size, words): words, which are different, of up to SHORT_WORD letters at each of their `_parts`, those of one length in one string."""

    def packed(words: list[str]) -> Iterator[pa.RecordBatch]:
        for size, own in _by_length(words).items():
            of_size = [words[i] for i in own]
            for_part = [np.concatenate(x) for x in zip(*_parts(coded(of_size), least))]
            order = np.argsort(for_part[1], kind="stable")
            rows, parts = for_part[0][order], for_part[1][order]
            starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]])
            joined = ["".join(map(of_size.__getitem__, x)) for x in np.split(rows, starts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(parts[starts]), pa.array(np.full(len(joined), size, np.int32)), pa.array(joined, pa.string())], names=["part", "size", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = [], 0
        for batch in batches:
            held += (own := batch.column(0).to_pylist())
            letters += sum(map(len, own))
            if letters >= HELD:
                yield from packed(sorted(held))
                held, letters = [], 0
        if held:
            yield from packed(sorted(held))

    return words.where(F.length(word).between(1, SHORT_WORD)).select(word).mapInArrow(run, "part long, size int, words string")


def _entry_parts(entries: DataFrame, entry: str, rank: str, least: float) -> DataFrame:
    """(part, b, rank): entries of up to SHORT_WORD letters at each of their `_parts`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for own in _by_length(words).values():
                for rows, parts in _parts(coded([words[i] for i in own]), least):
                    sent = batch.take(pa.array(own[rows]))
                    yield pa.RecordBatch.from_arrays([pa.array(parts), *sent.columns], names=["part", "b", "rank"])

    held = entries.where(F.length(entry).between(1, SHORT_WORD)).select(entry, rank)
    return held.mapInArrow(run, f"part long, b string, rank {held.schema[1].dataType.simpleString()}")


def _dealt(left: DataFrame, right: DataFrame, word: str, other: str, rank: str, least: float, best: bool) -> DataFrame:
    """(a, b, ratio, rank): words of up to SHORT_WORD letters that are like each other; with `best` for each left word the
    first by ratio and rank of each part in which it meets others, else all, some repeatedly. Left words must be distinct.

    The letters of matching blocks stand in both words in one order, so two words that reach the ratio have a remainder in
    common: what is left of each without as many letters as it can spare (`spare_letters`), with just the letters that
    their lengths call for. Words go to a part for each number and first letter of what may be left of them, few times
    as against their remainders, which are made, looked up and compared inside a part only. Nothing passes the driver.
    """
    kind = right.schema[rank].dataType.simpleString()

    def run(asked: pa.Table, entries: pa.Table) -> pa.Table:
        nothing = pa.table({"a": pa.array([], pa.string()), "b": pa.array([], pa.string()), "ratio": pa.array([], pa.float64()), "rank": entries.column("rank").slice(0, 0)})
        if not asked.num_rows or not entries.num_rows:
            return nothing
        part = entries.column("part")[0].as_py()
        packed: dict[int, list[str]] = {}
        for size, own in zip(asked.column("size").to_pylist(), asked.column("words").to_pylist()):
            packed.setdefault(size, []).append(own)
        asked_codes = {size: coded(own).reshape(-1, size) for size, own in ((n, ["".join(x)]) for n, x in packed.items())}
        names = entries.column("b").to_pylist()
        numbers = _by_length(names)
        place = np.empty(len(names), np.int64)
        place[pc.sort_indices(entries.column("rank"), null_placement="at_start").to_numpy()] = np.arange(len(names))
        entry_codes = {n: coded([names[i] for i in own]) for n, own in numbers.items()}

        def kept(a: np.ndarray, b: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, ...]:
            if not best:
                return a, b, ratios
            order = np.lexsort((place[b], -ratios, a))
            firsts = order[np.r_[True, a[order][1:] != a[order][:-1]]]
            return a[firsts], b[firsts], ratios[firsts]

        rows: dict[int, list] = {}
        for la, a, lb, b, ratios in met_words(asked_codes, entry_codes, part >> 32, part & 0xFFFFFFFF, least):
            rows.setdefault(la, []).append(kept(a, numbers[lb][b], ratios))
        out = [nothing]
        for la, found in rows.items():
            a, b, ratios = kept(*(np.concatenate(x) for x in zip(*found)))
            text = asked_codes[la][a].tobytes().decode("utf-32-le")
            sent = entries.take(pa.array(b))
            out.append(pa.table({"a": pa.array([text[i : i + la] for i in range(0, len(text), la)], pa.string()), "b": sent.column("b"), "ratio": pa.array(ratios), "rank": sent.column("rank")}))
        return pa.concat_tables(out)

    asked, entries = _asked_parts(left, word, least), _entry_parts(right, other, rank, least)
    return asked.groupBy("part").cogroup(entries.groupBy("part")).applyInArrow(run, f"a string, b string, ratio double, rank {kind}")


def by_deletions(left: DataFrame, right: DataFrame, word: str, other: str, least: float) -> DataFrame:
    """(a, b, ratio) as `like_texts` gives, for words of up to SHORT_WORD letters on both sides (see `_dealt`)."""
    a, b = left.select(F.col(word).alias("a")).distinct(), right.select(F.col(other).alias("b")).distinct().withColumn("rank", F.lit(0))
    return _dealt(a, b, "a", "b", "rank", least, best=False).select("a", "b", "ratio").distinct()


def nearest_words(words: DataFrame, word: str, dictionary: DataFrame, entry: str, rank: str, least: float = 0.85) -> DataFrame:
    """(word, right, ratio): for each distinct word that is not in the dictionary the entry with the largest block ratio, of
    `least` at least; of equals the first by `rank`. Words of one letter are left as they are. Short words are met by their
    remainders (`_dealt`), longer ones by their rarest letters (`like_texts`). The dictionary is not broadcast."""
    entries = cut(dictionary.select(F.col(entry).alias("b"), F.col(rank).alias("_rank")))
    asked = cut(words.where(F.length(word) > 1).select(F.col(word).alias("word")).distinct().join(entries.select(F.col("b").alias("_e")).hint("merge"), F.col("word") == F.col("_e"), "left_anti"))
    placed = _dealt(asked, entries, "word", "b", "_rank", least, best=True)
    # A long word may also be like shorter ones, as far as the ratio lets them be.
    least_size = math.ceil(least / (2 - least) * (SHORT_WORD + 1) - 1e-9)
    sized = lambda df, c, low, high=None: df.where((F.length(c) >= low) & (F.length(c) <= high if high else F.lit(True)))
    for a, b in ((sized(asked, "word", SHORT_WORD + 1), sized(entries, "b", least_size)), (sized(asked, "word", least_size, SHORT_WORD), sized(entries, "b", SHORT_WORD + 1))):
        placed = placed.union(like_texts(a, b, "word", "b", least).where("ratio < 1").join(entries.hint("merge"), "b").select("a", "b", "ratio", "_rank"))
    best = placed.groupBy(F.col("a").alias("word")).agg(F.min_by(F.struct("b", "ratio"), F.struct(-F.col("ratio"), "rank")).alias("best"))
    return best.select("word", F.col("best.b").alias("right"), F.round("best.ratio", 6).alias("ratio"))
