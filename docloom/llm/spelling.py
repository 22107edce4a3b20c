"""Spelling variants: words one letter apart, found with forward and backward automata of the words that share a half."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .simhash import whole_groups

RUN = re.compile("[a-zÀ-ÿ]+")
#: One run of a document in TYPO loses a letter (a fixed value of the corpus's own noise).
TYPO = 97
#: Distinct words that a task holds before it sends their counts.
HELD = 300_000
#: Words that share a half, beyond which they are dealt by smaller parts.
HOT = 20_000


def noised(run: str, mark: int) -> str:
    """The run, without its code point `mark % length` if TYPO divides mark."""
    if mark % TYPO:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, noise: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the runs of letters in whole texts, A-Z in lower case; with `noise`, as `noised` by id and run.

    Null texts have no words; a null id counts as an empty one. Words left empty are not returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Counter(RUN.findall((text.as_py() or "").encode().lower().decode()))
                if noise:
                    before = zlib.crc32(f"{doc or ''}:".encode())
                    for word, n in own.items():
                        mark = zlib.crc32(word.encode(), before)
                        held[word if mark % TYPO else noised(word, mark)] += n
                else:
                    held.update(own)
                if len(held) > HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "word string, n long")
    return rows.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


class Dawg:
    """A minimal acyclic automaton of sorted words; a path's numbers add up to the place of its word (a perfect hash)."""

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, tuple[int, int]]] = []  # of each state: letter -> (next state, words before it)
        self.final: list[bool] = []
        self.size: list[int] = []  # words from a state on
        known: dict[tuple, int] = {}
        path: list[tuple[str, list]] = []  # letters of the last word with the edges after each, not yet merged
        root: list = [False, {}]
        last = ""

        def state(node: list) -> int:
            final, edges = node
            key = (final, *edges.items())
            found = known.get(key)
            if found is None:
                found = known[key] = len(self.edges)
                before, numbered = int(final), {}
                for letter, to in edges.items():
                    numbered[letter] = (to, before)
                    before += self.size[to]
                self.edges.append(numbered)
                self.final.append(final)
                self.size.append(before)
            return found

        def close(length: int) -> None:
            while len(path) > length:
                letter, node = path.pop()
                (path[-1][1] if path else root)[1][letter] = state(node)

        for word in words:
            same = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                same += 1
            close(same)
            for letter in word[same:]:
                path.append((letter, [False, {}]))
            (path[-1][1] if path else root)[0] = True
            last = word
        close(0)
        self.root = state(root)

    def walk(self, at: int, number: int, letters: str) -> tuple[int, int]:
        """The state and the number after letters; state -1 if there is no such path."""
        for letter in letters:
            step = self.edges[at].get(letter)
            if step is None:
                return -1, 0
            at, number = step[0], number + step[1]
        return at, number

    def one_off(self, word: str, low: int, high: int) -> Iterator[tuple[int, bool]]:
        """(number, longer) of the words of word's length with one other letter, and of those with one letter more, where
        the first place at which they part from word is from `low` to below `high`."""
        at, number = self.walk(self.root, 0, word[:low])
        for i in range(low, high):
            if at < 0:
                return
            own = word[i] if i < len(word) else ""
            for letter, (to, before) in self.edges[at].items():
                if letter == own:
                    continue
                if own:
                    end, found = self.walk(to, number + before, word[i + 1 :])
                    if end >= 0 and self.final[end]:
                        yield found, False
                end, found = self.walk(to, number + before, word[i:])
                if end >= 0 and self.final[end]:
                    yield found, True
            if i < len(word):
                at, number = self.walk(at, number, own)


def part_bounds(length: int, parts: int) -> list[int]:
    """Where the parts of a word of `length` letters begin; the last one takes in what follows the word."""
    return [i * length // parts for i in range(parts)] + [length + 1]


def part_key(word: str, length: int, parts: int, part: int) -> int | None:
    """What a word has in common with all that part from it in one of `parts` parts, `length` being the shorter one's length.

    None if nothing can part there. The upper parts are looked up from the front, the lower ones from the back.
    """
    bounds = part_bounds(length, parts)
    low, high = bounds[part], bounds[part + 1]
    if low == high:
        return None
    front, back = word[:low], word[len(word) - max(0, length - high) :]
    return xxhash.xxh64_intdigest(f"{2 * part >= parts}\0{front}\0{back}") - (1 << 63)


def lookups(rows: DataFrame, parts: int) -> DataFrame:
    """(key, word, n, part, asks, longer): a row for each part of each word in which it asks, or is asked for by words that
    are one letter shorter (longer).

    rows: words (word, n), all parts of which are taken; or rows of this function at half as many parts, which are cut in two.
    """
    outer = "part" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            before = zip(*(c.to_pylist() for c in batch.columns[2:])) if outer else ((None, True, True) for _ in range(batch.num_rows))
            for word, n, (half, asks, longer) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), before):
                for part in range(parts) if half is None else (2 * half, 2 * half + 1):
                    own = part_key(word, len(word), parts, part) if asks else None
                    other = part_key(word, len(word) - 1, parts, part) if longer and len(word) > 1 else None
                    if own is not None:
                        out.append((own, word, n, part, True, other == own))
                    if other is not None and other != own:
                        out.append((other, word, n, part, False, True))
            if out:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["key", "word", "n", "part", "asks", "longer"])

    return rows.select("word", "n", *(["part", "asks", "longer"] if outer else [])).mapInArrow(run, "key long, word string, n long, part int, asks boolean, longer boolean")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, n): for each of words (word, n; distinct) those that differ by one inserted, deleted or replaced letter.

    Words that differ so agree wholly in one half, by the shorter one's length. So words meet by their first half and by
    their second one; a task builds a forward automaton of those that meet by the first, and a backward automaton of those
    that meet by the second. Each word walks the half exactly and ends with one error. A pair counts in the half in which
    the words first part, so it is found once. Where more than HOT words share a half, they meet by quarters instead, and
    so on: then all but a quarter agrees.
    """
    parts, found = 2, None
    open_ = cut(lookups(words, parts))
    while True:
        hot = cut(open_.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT).select("_key"))
        if parts >= 64 or not hot.limit(1).count():
            return _met(open_, parts) if found is None else found.union(_met(open_, parts))
        met = _met(open_.join(hot, F.col("key") == F.col("_key"), "left_anti"), parts)
        found = met if found is None else found.union(met)
        parts *= 2
        open_ = cut(lookups(open_.join(hot, F.col("key") == F.col("_key"), "left_semi"), parts))


def _met(rows: DataFrame, parts: int) -> DataFrame:
    """The pairs of `near_words` from rows of `lookups`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in whole_groups(batches, 1):
            words, ns, part, asks = (block.column(i).to_pylist() for i in range(1, 5))
            out: list[tuple[str, str, int]] = []
            for forward in (True, False):
                mine = [i for i, p in enumerate(part) if (2 * p >= parts) == forward]
                if not mine:
                    continue
                count = {words[i] if forward else words[i][::-1]: ns[i] for i in mine}
                held = sorted(count)
                dawg = Dawg(held)
                for i in mine:
                    if asks[i]:
                        word, size = words[i], len(words[i])
                        low, high = (bounds := part_bounds(size, parts))[part[i]], bounds[part[i] + 1]
                        hits = dawg.one_off(word, low, high) if forward else dawg.one_off(word[::-1], size - high, size + 1)
                        for number, longer in hits:
                            near, n = held[number], count[held[number]]
                            if not forward:
                                near = near[::-1]
                                if not low <= next((k for k in range(size) if word[k] != near[k]), size) < high:
                                    continue
                            out.append((word, near, n))
                            if longer:
                                out.append((near, word, ns[i]))
            for at in range(0, len(out), 20_000):
                word, near, n = zip(*out[at : at + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(near), pa.array(n, pa.int64())], names=["word", "near", "n"])

    dealt = rows.select("key", "word", "n", "part", "asks").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "word string, near string, n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms (word, form or null): the last word that is reached from each one; itself if it has no form.

    Every round doubles the steps taken; as a form has at least twice the count, some six rounds reach all.
    """
    now = cut(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        ahead = now.where("word <> root").select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        now = cut(now.join(ahead, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")))
        if not now.where("moved").limit(1).count():
            return now.drop("moved")


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """Each of words (word, n; distinct) with the spelling that it is a variant of.

    Returns word, form (of the words one letter apart the one with the largest n, the smallest in code-point order of
    equals, if its n is at least `ratio` times the word's own; else null), root (from word, forms followed to the last),
    n, n_near (words one letter apart), form_n. A table without words gives none.
    """
    near = near_words(words).groupBy(F.col("word").alias("_word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best"))
    all_ = words.join(near, F.col("word") == F.col("_word"), "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    formed = cut(all_.select("word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, -F.col("best.less")).alias("form_n")))
    return formed.join(roots(formed), "word").select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_length: int = 5, min_count: int = 3, noise: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`variants` of the words of docs that have min_length letters and min_count occurrences at least.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. Null and empty texts have none; repeated rows count
    each time; an empty table gives no rows; other columns are left out. noise: see `word_counts`.
    """
    counted = word_counts(docs, noise, id_col, text_col)
    return variants(cut(counted.where((F.char_length("word") >= min_length) & (F.col("n") >= min_count))))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), noise=True)
