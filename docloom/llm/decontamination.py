"""Benchmark passages in documents, up to a share of edited words, by a random-walk embedding and bit-sampling LSH."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: A passage counts if it differs from the item by at most so large a share of the item's words.
EDIT_SHARE = 0.2
#: Repetitions of the embedding, and symbols sampled in each. A window whose embedding differs in half of the symbols is
#: found with probability 1 - (1 - 0.5 ** 3) ** 64 > 0.999, in 60 % with 1 - (1 - 0.4 ** 3) ** 64 > 0.98.
REPEATS, SAMPLED = 64, 3
#: Steps of a walk for each word of the item; each second one moves on, so the walk ends before the item does.
STRETCH = 1.6
#: Words of benchmark items that are sent to the tasks at once; a larger benchmark is searched for in several passes.
BLOCK_WORDS = 2_000_000
CHUNK = 4096
_NOT_WORD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
#: Fixed: marks and spaces beyond ASCII, and letters of scripts that are written without spaces.
_MARKS = "\u00a0-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7\u2000-\u206f\u3000-\u303f\uff00-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65"
_ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_BEYOND, _MARK, _SINGLE = re.compile(f"[{_MARKS}{_ALONE}]"), re.compile(f"[{_MARKS}]"), re.compile(f"[{_ALONE}]")


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case: runs of letters, digits and other characters that are neither spaces nor punctuation.

    Characters of scripts that are written without spaces (Chinese, Japanese, Thai and the like) are words by themselves.
    """
    text = (text or "").lower()
    if not text.isascii() and _BEYOND.search(text):
        text = _SINGLE.sub(r" \g<0> ", _MARK.sub(" ", text))
    return text.encode(errors="surrogatepass").translate(_NOT_WORD).split()


def edits_of(n_words: int) -> int:
    return math.floor(EDIT_SHARE * n_words + 1e-9)


def gram_of(n_words: int) -> int:
    """Words of a run that stays whole in every passage within the edits allowed: an edit breaks at most that many runs."""
    return next((q for q in (3, 2) if n_words - q + 1 > q * edits_of(n_words)), min(n_words, 1))


def sampled_walks(rows: np.ndarray, seed: int = 7) -> np.ndarray:
    """Bucket keys of the CGK embeddings of rows of one length (symbols > 0; 0 past the end of a text): rows x REPEATS.

    A walk repeats the symbol under it and steps on when a random bit of (step, symbol) says so; two rows that differ by few
    edits fall into step again after each. A key is made of the symbols at SAMPLED random steps; it is 0, which no item
    has, if one of them is past the end of the text.
    """
    n = rows.shape[1]
    steps = max(1, round(STRETCH * n))
    places = np.random.default_rng((seed, n)).integers(0, steps, (REPEATS, SAMPLED))
    out = np.zeros((len(rows), REPEATS, SAMPLED), np.uint64)
    padded = np.concatenate([rows, np.zeros((len(rows), 1), rows.dtype)], axis=1).astype(np.uint64)
    at, here = np.zeros((len(rows), REPEATS), np.int64), np.arange(len(rows))[:, None]
    for step in range(int(places.max()) + 1):
        turn = np.random.default_rng((seed, n, step)).integers(1, 2**63, REPEATS, np.uint64) | np.uint64(1)
        symbol = padded[here, at]
        which, place = np.nonzero(places == step)
        out[:, which, place] = symbol[:, which]
        at = np.minimum(at + ((symbol * turn[None] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)).astype(np.int64), n)
    key = np.broadcast_to(np.arange(1, REPEATS + 1, dtype=np.uint64)[None] * np.uint64(0xFF51AFD7ED558CCD), out.shape[:2]).copy()
    for i in range(SAMPLED):
        key = (key ^ out[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return np.where((out == 0).any(axis=2), 0, key)


def edit_distances(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the least word edits between the item and any part of it, and where the first such part ends."""
    before = np.zeros((len(windows), windows.shape[1] + 1), np.int64)
    steps = np.arange(windows.shape[1] + 1)
    for i, word in enumerate(item):
        now = before + 1
        now[:, 1:] = np.minimum(now[:, 1:], before[:, :-1] + (windows != word))
        now[:, 0] = i + 1
        before = np.minimum.accumulate(now - steps, axis=1) + steps
    return before.min(axis=1), before.argmin(axis=1)


class Items:
    """Benchmark items made ready for search: buckets of sampled walks for each length, runs of words that tell where to look."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.number, self.words = [], {}, []
        for item_id, text in items:
            if words := words_of(text):
                self.ids.append(item_id)
                self.words.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], np.int64))
        #: What the walks see: a word's hash, so that they do not depend on the other items.
        self.symbols = np.array([0, *map(_symbol, self.number)], np.uint64)
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        v = len(self.number) + 1
        self.has = np.unique(np.concatenate([k * v + w for k, w in enumerate(self.words)])) if self.words else np.zeros(0, np.int64)
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.buckets: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for q in {gram_of(len(w)) for w in self.words}:
            found = [(_keys(w, q), len(w)) for w in self.words if gram_of(len(w)) == q]
            keys = np.concatenate([x for x, _ in found])
            places = np.concatenate([np.full(len(x), n) for x, n in found]), np.concatenate([np.arange(len(x)) for x, _ in found])
            self.grams[q] = tuple(np.unique(np.stack([keys.view(np.int64), *places]), axis=1))
        for n in np.unique(self.lengths).tolist():
            owners = np.flatnonzero(self.lengths == n)
            keys = np.concatenate([sampled_walks(self.symbols[np.stack([self.words[k] for k in owners[a : a + CHUNK]])]) for a in range(0, len(owners), CHUNK)])
            owner, key = np.repeat(owners, REPEATS), keys.ravel()
            order = np.argsort(key, kind="stable")
            self.buckets[n] = key[order], owner[order]

    def windows(self, ids: np.ndarray, ends: np.ndarray, skip: bool) -> np.ndarray:
        """(text, length, start) of the windows to embed; start counts in the words of all texts.

        With skip, only where some item of that length shares a run of words at that place of the run which no allowed edits
        could break everywhere; without, all windows of all lengths. What is skipped holds no passage.
        """
        hits = [np.zeros((3, 0), np.int64)]
        if not skip:
            at = np.arange(len(ids))
            hits += [np.stack([np.searchsorted(ends, at, "right"), np.full(len(at), n), at]) for n in self.buckets]
        for q, (keys, length, offset) in self.grams.items() if skip else ():
            n = len(ids) - q + 1
            if n <= 0:
                continue
            known = np.flatnonzero(np.logical_and.reduce([ids[i : i + n] > 0 for i in range(q)]))
            key = _keys_at(ids, known, q)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            # Hits are expanded a bounded number at a time, and only different windows are kept.
            cuts = np.flatnonzero(np.diff(np.cumsum(high - low) // (64 * CHUNK), prepend=-1)) if len(known) else []
            for a, b in zip(cuts, [*cuts[1:], len(known)]):
                count = (high - low)[a:b]
                at = np.repeat(known[a:b], count)
                post = np.repeat(low[a:b] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
                hits.append(np.unique(np.stack([np.searchsorted(ends, at, "right"), length[post], at - offset[post]]), axis=1))
        return np.unique(np.concatenate(hits, axis=1), axis=1)

    def search(self, texts: list[str | None], skip: bool = True) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, first word of the passage, about) of the best passage of each item found in each text."""
        get, parts, every = self.number.get, [], []
        for text in texts:
            words = words_of(text)
            parts.append(np.fromiter((get(w, 0) for w in words), np.int64, len(words)))
            every.append(words)
        ends = np.cumsum([len(w) for w in every])
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        hits = self.windows(ids, ends, skip)
        symbols = self.symbols[ids]
        self._name_unknown(symbols, ids, ends, every, hits)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for n in np.unique(hits[1]).tolist():
            own = hits[:, hits[1] == n]
            keys, owner = self.buckets[n]
            for a in range(0, own.shape[1], CHUNK):
                text, _, start = own[:, a : a + CHUNK]
                low, high = np.r_[0, ends][text], ends[text]
                walks = sampled_walks(_cut(symbols, start, n, low, high))
                first, last = np.searchsorted(keys, walks.ravel(), "left"), np.searchsorted(keys, walks.ravel(), "right")
                count = np.where(walks.ravel() == 0, 0, last - first)
                of = np.repeat(np.arange(len(count)), count)
                item = owner[np.repeat(first - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())]
                row, item = np.divmod(np.unique(of // REPEATS * len(self.words) + item), len(self.words))
                self._verify(best, ids, n, row, item, text, start, low, high)
        return [(t, self.ids[k], d, s) for (t, k), (d, s) in sorted(best.items())]

    def _name_unknown(self, symbols: np.ndarray, ids: np.ndarray, ends: np.ndarray, every: list[list[bytes]], hits: np.ndarray) -> None:
        """Gives words of no item, where a window covers them, symbols of their own."""
        cover = np.zeros(len(ids) + 1, np.int64)
        np.add.at(cover, np.clip(hits[2], 0, len(ids)), 1)
        np.add.at(cover, np.clip(hits[2] + hits[1], 0, len(ids)), -1)
        unknown = np.flatnonzero((np.cumsum(cover[:-1]) > 0) & (ids == 0))
        text = np.searchsorted(ends, unknown, "right")
        for i, t, k in zip(unknown.tolist(), text.tolist(), (unknown - np.r_[0, ends][text]).tolist()):
            symbols[i] = _symbol(every[t][k])

    def _verify(self, best: dict, ids: np.ndarray, n: int, row: np.ndarray, item: np.ndarray, text: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Candidates (row of a window, item) by their edit distance, for those that have enough of the item's words at all."""
        slack, v = edits_of(n), len(self.number) + 1
        for a in range(0, len(row), CHUNK):
            r, k = row[a : a + CHUNK], item[a : a + CHUNK]
            region = _cut(ids, start[r] - slack, n + 2 * slack, low[r], high[r])
            name = k[:, None] * v + region
            at = np.minimum(np.searchsorted(self.has, name), len(self.has) - 1)
            near = np.flatnonzero((self.has[at] == name).sum(axis=1) >= n - slack)
            for one in np.unique(k[near]):
                mine = near[k[near] == one]
                edits, end = edit_distances(self.words[one], region[mine])
                rows = r[mine]
                for t, d, s in zip(text[rows], edits, start[rows] - slack + end - n - low[rows]):
                    if d <= slack:
                        best[int(t), int(one)] = min(best.get((int(t), int(one)), (1 << 60, 0)), (int(d), max(0, int(s))))


def _symbol(word: bytes) -> int:
    return (xxhash.xxh64_intdigest(word) >> 1) | 1


def _keys(words: np.ndarray, q: int) -> np.ndarray:
    return _keys_at(words, np.arange(max(0, len(words) - q + 1)), q)


def _keys_at(ids: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q words from each place on, as long."""
    key = np.zeros(len(at), np.uint64)
    for i in range(q):
        key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ (ids[at + i].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return key.view(np.int64)


def _cut(ids: np.ndarray, start: np.ndarray, n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """n words from each start on; 0 outside low..high - 1."""
    at = start[:, None] + np.arange(n)
    inside = (at >= low[:, None]) & (at < high[:, None])
    return np.where(inside, ids[np.clip(at, 0, len(ids) - 1)], ids.dtype.type(0))


#: The items that a worker has made ready last.
_ready: dict[str, Items] = {}


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", skip: bool = True) -> DataFrame:
    """Benchmark items that occur in documents: doc_id, item_id, edits, start_word, item_words, one row per document row and item.

    An item occurs if some run of the document's words differs from the item's words by at most EDIT_SHARE of them
    (insertions, deletions, replacements; punctuation, case and white space don't count). Item-sized windows of the
    document are embedded by REPEATS random walks, and SAMPLED symbols of each are looked up in the buckets of the items of
    that length; every item met is verified by its edit distance. With `skip`, windows are embedded only where a run of
    words that no allowed edits could break everywhere stands as it does in some item of the length, so no passage is
    skipped. edits: the fewest over the windows found. start_word: about where that passage begins, from 0.
    Null or empty texts and items have no words and match nothing; items of under three words are searched as they stand.
    Repeated rows are all searched; rows without an id give rows without one. Items go to the tasks in blocks of at most
    BLOCK_WORDS words. One block makes a plan that is not run here; of several, each is searched and its finds written
    before the next is read, so neither the tasks nor the driver ever hold more than one. An empty table gives no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(item_text, F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / (4 * BLOCK_WORDS)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for block in range(blocks):
        sent = spark.sparkContext.broadcast([tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()])

        def run(batches: Iterator[pa.RecordBatch], sent=sent, name=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            if name not in _ready:
                _ready.clear()
                _ready[name] = Items(sent.value)
            ready = _ready[name]
            size = dict(zip(ready.ids, ready.lengths.tolist()))
            for batch in batches:
                ids, out = batch.column(0), []
                for a, b in _portions(batch.column(1)):
                    for t, item, d, s in ready.search(batch.column(1).slice(a, b - a).to_pylist(), skip):
                        out.append((ids[a + t].as_py(), item, d, s, size[item]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "item_id", "edits", "start_word", "item_words"])

        part = rows.mapInArrow(run, "doc_id long, item_id long, edits long, start_word long, item_words long")
        if blocks > 1:
            part = stored(part)
            sent.destroy()
        found = part if found is None else found.union(part)
    return found


def _portions(texts: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of texts, of about `most` bytes together (or one text)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t.as_py() or "")
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text holds no benchmark item (see `leaks`), all columns kept, whatever their names.

    Decided by the text alone, so rows without an id and rows that share one are judged each by its own text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = leaks(docs.select(F.xxhash64(text).alias("doc_id"), text.alias("text")), benchmark).select("doc_id").distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64(text).alias("doc_id"))
    return rows.join(found, "doc_id", "left_anti").select("row.*")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
