"""Long substrings that occur earlier in the corpus, found with run-length Burrows-Wheeler indexes of the repetitive part."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, stored, table
from .simhash import whole_groups

WINDOW = 100
#: Bytes of the grams that place anchors; each window of WINDOW bytes holds SPREAD of them.
GRAM = 32
SPREAD = WINDOW - GRAM + 1
#: Bytes of text hashed at once.
CHUNK = 1 << 21
#: Variants around one anchor that one task indexes; windows of larger groups are met by their digest.
WIDE = 8_000
#: Regions that a task remembers while it reads on, in a table of so many slots.
SLOTS = 1 << 20
#: One text in so many is looked at for anchors that many regions share.
SAMPLED = 64
#: What a row of `anchors` is: dealt by its anchor, known to be a repeat, or dealt by its region as its anchor is hot.
PLAIN, KNOWN, HOT = 0, 1, 2

_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 32 bytes from each place on, by doubling."""
    h = _BYTE[data]
    for width in (1, 2, 4, 8, 16):
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:] * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
    return h


def anchored(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, last window) of runs of windows of `data` that share an anchor.

    ends: where each text ends. A window's anchor is its gram with the least hash, the leftmost of equals, so it depends on
    the window's bytes alone: equal windows have equal anchors at equal distances. Windows across texts are left out.
    """
    if len(data) < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = gram_hashes(data)
    low = np.uint64(0xFFFFFF)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    for width in (1, 2, 4, 8, 16, 32):
        least = np.minimum(least[:-width], least[width:])
    least = np.minimum(least[: -(SPREAD - 64)], least[SPREAD - 64 :])
    at = (least & low).astype(np.int64)
    lengths = np.diff(np.r_[0, ends])
    inside = np.repeat(ends, lengths)[: len(at)] - np.arange(len(at)) >= WINDOW
    starts = np.flatnonzero(inside)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.r_[True, (at[starts[1:]] != at[starts[:-1]]) | (np.diff(starts) > 1)]
    first = np.flatnonzero(new)
    return h[at[starts[first]]], starts[first], starts[np.r_[first[1:], len(starts)] - 1]


class _Seen:
    """The least place seen of some regions, one to a slot; a region may lose its slot to another one.

    Regions are told by two 64-bit hashes, of their bytes and of their anchor.
    """

    def __init__(self):
        self.region, self.anchor, self.doc, self.start = (np.zeros(SLOTS, np.int64) for _ in range(4))
        self.used = np.zeros(SLOTS, bool)

    def later(self, region: np.ndarray, anchor: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether a lesser place of each region has been seen; the other places are remembered."""
        at = region & (SLOTS - 1)
        later = self.used[at] & (self.region[at] == region) & (self.anchor[at] == anchor) & ((self.doc[at] < doc) | ((self.doc[at] == doc) & (self.start[at] < start)))
        own = np.flatnonzero(~later)
        self.used[at[own]] = True
        self.region[at[own]], self.anchor[at[own]], self.doc[at[own]], self.start[at[own]] = region[own], anchor[own], doc[own], start[own]
        return later


def anchors(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """part, region, doc, key, start, last, kind: a row for each anchor of doc, key, text.

    region: digest of all bytes of the anchor's windows. Rows of one task with the same region mostly meet here already: all
    but the earliest are KNOWN to be repeats, and are dealt by another key. So of a passage that many texts share, a task
    sends few rows to the part of its anchor, whatever the number of copies. Anchors in `hot` (sorted) are dealt by region.
    """
    seen = _Seen()
    for doc, key, texts in _chunks(batches):
        data = b"".join(t for _, t in texts)
        size = np.array([len(t) for _, t in texts], np.int64)
        ends = np.cumsum(size)
        anchor, first, last = anchored(np.frombuffer(data, np.uint8), ends)
        if not len(anchor):
            continue
        anchor = anchor.view(np.int64)
        text = np.searchsorted(ends, first, "right")
        begin = np.array([b for b, _ in texts], np.int64)[text] - (ends - size)[text]
        digest = xxhash.xxh3_64_intdigest
        region = np.fromiter((digest(data[a : b + WINDOW]) for a, b in zip(first.tolist(), last.tolist())), np.uint64, len(first)).view(np.int64)
        docs, keys, starts = np.array(doc, np.int64)[text], np.array(key, np.int64)[text], first + begin
        order = np.lexsort((starts, docs, anchor, region))
        known = np.zeros(len(first), bool)
        r, a, d, s = region[order], anchor[order], docs[order], starts[order]
        again = np.r_[False, (r[1:] == r[:-1]) & (a[1:] == a[:-1])]
        head = np.maximum.accumulate(np.where(again, 0, np.arange(len(r))))
        inside = again & ((d != d[head]) | (s != s[head]))
        before = np.zeros(len(r), bool)
        before[~again] = seen.later(r[~again], a[~again], d[~again], s[~again])
        known[order] = inside | before[head]
        # Known rows of a text stay together, as such rows take less room in the shuffle; each chunk deals them anew.
        is_hot = ~known & np.isin(anchor, hot)
        part = np.where(known, keys ^ np.array([digest(data)], np.uint64).view(np.int64)[0], np.where(is_hot, anchor ^ region, anchor))
        columns = [part, np.where(known, 0, region), docs, keys, starts, last + begin, np.where(known, KNOWN, np.where(is_hot, HOT, PLAIN)).astype(np.int8)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "region", "doc", "key", "start", "last", "kind"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], list[tuple[int, bytes]]]]:
    """Texts as (where the piece begins, bytes), about CHUNK bytes together; longer texts come in pieces whose windows adjoin."""
    doc, key, texts, size = [], [], [], 0
    for batch in batches:
        ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, k, t in zip(ids, keys, batch.column(2)):
            data = (t.as_py() or "").encode()
            for at in range(0, max(1, len(data) - WINDOW + 1), CHUNK):
                piece = data[at : at + CHUNK + WINDOW - 1]
                doc.append(i)
                key.append(k)
                texts.append((at, piece))
                size += len(piece)
                if size >= CHUNK:
                    yield doc, key, texts
                    doc, key, texts, size = [], [], [], 0
    if texts:
        yield doc, key, texts


def sort_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From anchors sorted by part, region, doc, start, key: repeats of a whole region (variant: -1), and, where an anchor
    has several regions, the earliest place of each (variant: PLAIN, or HOT for regions of hot anchors).

    Rows are read on batch by batch. Between batches the first row of the region is kept, and, as long as an anchor has
    one region, its earliest place; so no anchor is held as a whole.
    """
    names = ["part", "doc", "key", "start", "last", "variant"]
    head: list[np.ndarray] | None = None
    regions, waiting, tail = 0, [], None

    def out(rows: list[np.ndarray], mask: np.ndarray, variant: np.ndarray) -> pa.RecordBatch:
        part, _, doc, key, start, last, _ = rows
        return pa.RecordBatch.from_arrays([pa.array(c[mask]) for c in (part, doc, key, start, last, variant.astype(np.int8))], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        old = 0 if head is None else 1  # the rows of the region's head come first, and have been told already
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if head is not None:
            rows = [np.r_[h, c] for h, c in zip(head, rows)]
        part, region, doc, key, start, last, kind = rows
        n, known = len(part), kind == KNOWN
        new_part = np.r_[True, part[1:] != part[:-1]]
        fresh = new_part | np.r_[True, (region[1:] != region[:-1]) | known[1:] | known[:-1]]
        first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        told = np.arange(n) < old
        repeated = ~fresh & np.r_[False, (doc[1:] == doc[:-1]) & (start[1:] == start[:-1]) & (key[1:] == key[:-1])]
        if tail is not None and len(part) > 1:
            repeated[1] = not known[1] and tail == (part[1], region[1], doc[1], start[1], key[1])
        tied = (doc == doc[first]) & (start == start[first])
        group = np.cumsum(new_part) - 1
        counts = np.bincount(group, weights=fresh & ~known & ~told).astype(int)
        if old:
            counts[0] += regions
        else:
            waiting = []
        last_group = group[-1]
        mine = tied & ~known & ~repeated & ~told
        variant = mine & ((counts[group] > 1) | (kind == HOT))
        if waiting and counts[0] > 1:
            yield from waiting
            waiting = []
        if last_group > 0:
            waiting = []
        removed = ~told & ~repeated & (known | ~tied)
        if removed.any():
            yield out(rows, removed, np.full(n, -1))
        if variant.any():
            yield out(rows, variant, kind)
        if counts[last_group] <= 1:
            undecided = mine & ~variant & (group == last_group)
            if undecided.any():
                waiting.append(out(rows, undecided, kind))
        regions = int(counts[last_group])
        head = [c[first[-1] : first[-1] + 1] for c in rows]
        tail = None if known[-1] else (part[-1], region[-1], doc[-1], start[-1], key[-1])


def run_length_index(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order of all suffixes, length that each shares with the one before it in that order) of texts, none across texts.

    Suffixes are sorted by doubling. Of the Burrows-Wheeler transform only the ends of its runs are looked at: where a run
    goes on, the match is one byte shorter than that of the suffix one byte before; where a run begins, the match is
    compared byte for byte. In repetitive texts runs are few, and their matches stream down from the run ends.
    """
    size = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(size) - 1
    text = np.zeros(int(size.sum()), np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = np.frombuffer(b"".join(texts), np.uint8)
    text[ends] = 256 + np.arange(len(texts))  # each end is a letter of its own
    n, width, rank = len(text), 1, text
    while width < size.max():
        ahead = np.zeros(n, np.int64)
        ahead[:-width] = rank[width:] + 1
        _, rank = np.unique(rank * (int(ahead.max()) + 1) + ahead, return_inverse=True)
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    left = text[order - 1]
    run_start = np.r_[True, left[1:] != left[:-1]] | (order == 0) | (left >= 256)
    before = np.r_[0, order[:-1]]
    heads = np.flatnonzero(run_start)
    shared = np.zeros(n, np.int64)
    shared[order[heads]] = _matches(text, order[heads], before[heads], int(size.max()))
    shared[order[0]] = 0
    is_head = np.zeros(n, bool)
    is_head[order[heads]] = True
    source = np.maximum.accumulate(np.where(is_head, np.arange(n), 0))
    return order, (shared[source] - (np.arange(n) - source))[order]


def _matches(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the match of text from a and from b on."""
    out, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
    for step in range(most):
        i, j = a[open_] + step, b[open_] + step
        ok = (i < len(text)) & (j < len(text)) & (i != j)
        ok[ok] = text[i[ok]] == text[j[ok]]
        open_ = open_[ok]
        if not len(open_):
            break
        out[open_] += 1
    return out


def repeated_windows(doc: np.ndarray, start: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, offset) of the windows of texts that an earlier place, by doc and start, has as well."""
    order, shared = run_length_index(texts)
    size = np.array([len(t) + 1 for t in texts])
    begin = np.cumsum(size) - size
    text = np.repeat(np.arange(len(texts)), size)
    offset = np.arange(len(text)) - begin[text]
    window = offset + WINDOW <= size[text] - 1
    match = np.cumsum(shared < WINDOW) - 1
    own = np.empty(len(order), np.int64)
    own[order] = match
    text, offset, own = text[window], offset[window], own[window]
    rank = np.lexsort((start[text] + offset, doc[text]))
    t, o, m = text[rank], offset[rank], own[rank]
    _, first = np.unique(m, return_index=True)
    least = np.empty(int(own.max(initial=-1)) + 1, np.int64)
    least[m[first]] = first
    same = (doc[t] == doc[t[least[m]]]) & (start[t] + o == start[t[least[m]]] + o[least[m]])
    late = ~same
    return t[late], o[late]


def runs_of(text: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (text, first, last) of adjoining offsets."""
    order = np.lexsort((offset, text))
    t, o = text[order], offset[order]
    first = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (np.diff(o) > 1)]) if len(t) else np.zeros(0, np.int64)
    return t[first], o[first], o[np.r_[first[1:], len(t)] - 1] if len(t) else o


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows (doc, key, start, last) of variants: part, part, doc, key, start, bytes, sorted by part."""
    for rows in whole_groups(batches):
        doc, key, start = (rows.column(i).to_numpy() for i in (2, 3, 4))
        texts = rows.column(5).to_pylist()
        t, o = repeated_windows(doc, start, texts)
        t, a, b = runs_of(t, o)
        if len(t):
            columns = [doc[t], key[t], start[t] + a, start[t] + b]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "key", "start", "last"])


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of the variants of wide groups: digest, doc, key, start."""
    for batch in batches:
        out = []
        for _, _, doc, key, start, text in zip(*(c.to_pylist() for c in batch.columns)):
            out += [(xxhash.xxh3_128_digest(text[i : i + WINDOW]), doc, key, start + i) for i in range(len(text) - WINDOW + 1)]
        if out:
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["digest", "doc", "key", "start"])


ANCHORS = "part long, region long, doc long, key long, start long, last long, kind byte"


def hot_anchors(docs: DataFrame) -> np.ndarray:
    """Anchors that hold more than a quarter of an average partition, by one text in SAMPLED; so there are few.

    They are only dealt in another way; what meets in the end is the same, whichever anchors the sample shows.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = docs.where(F.pmod(F.xxhash64("key", F.lit(9)), F.lit(SAMPLED)) == 0)
    nothing = np.zeros(0, np.int64)
    counts = cut(some.mapInArrow(lambda batches: anchors(batches, nothing), ANCHORS).where(F.col("kind") == PLAIN).groupBy("part").count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    return np.sort(np.array([r[0] for r in counts.where((F.col("count") > total / (4 * n)) & (F.col("count") * SAMPLED > WIDE)).select("part").collect()], np.int64))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, key, start, last): runs of windows of docs (doc, key, text) that start earlier as well.

    The corpus is dealt to blocks so that equal windows always meet: by their anchors. Where all windows of an anchor agree
    with an earlier place (its region), the region is a repeat, whatever the number of copies; what is left to compare is
    one place of each region of those anchors that have several, the edges of the repeated passages. A task indexes a
    block of these and marks the windows that match an earlier one. Anchors with many different regions are dealt by
    region, and their windows then meet one by one, by digests. Rows with equal doc and key are cut once.
    """
    hot = hot_anchors(docs)
    sorted_rows = docs.mapInArrow(lambda batches: anchors(batches, hot), ANCHORS).repartition("part").sortWithinPartitions("part", "region", "doc", "start", "key")
    found = stored(sorted_rows.mapInArrow(sort_regions, "part long, doc long, key long, start long, last long, variant byte"))
    removed = found.where("variant < 0").select("doc", "key", "start", "last")
    cuts = cut_outs(docs, found.where("variant >= 0"))
    sizes = found.where(F.col("variant") == PLAIN).groupBy(F.col("part").alias("_part")).count()
    wide = sizes.where(F.col("count") > WIDE).select("_part")
    if wide.limit(1).count() or found.where(F.col("variant") == HOT).limit(1).count():
        cuts = stored(cuts)
        many = cuts.where(F.col("variant") == HOT).union(cuts.join(wide, F.col("part") == F.col("_part"), "left_semi").where(F.col("variant") == PLAIN))
        each = many.select("part", "same", "doc", "key", "start", "bytes").mapInArrow(digests, "digest binary, doc long, key long, start long")
        first = each.groupBy(F.col("digest").alias("_g")).agg(F.min(F.struct("doc", "start")).alias("_first"))
        late = each.join(first, F.col("digest") == F.col("_g")).where(F.struct("doc", "start") > F.col("_first"))
        removed = removed.union(late.select("doc", "key", "start", F.col("start").alias("last")))
        cuts = cuts.where(F.col("variant") == PLAIN).join(wide, F.col("part") == F.col("_part"), "left_anti")
    compared = cuts.select("part", "same", "doc", "key", "start", "bytes").repartition("part").sortWithinPartitions("part", "doc", "start").mapInArrow(compare, "doc long, key long, start long, last long")
    return removed.union(compared)


def cut_outs(docs: DataFrame, variants: DataFrame) -> DataFrame:
    """(part, same, variant, doc, key, start, bytes) of the variants' places, cut once from one row of each doc and key."""
    asked = variants.groupBy("doc", "key").agg(F.collect_set(F.struct("part", "variant", "start", "last")).alias("places"))
    met = docs.join(asked.select(F.col("doc").alias("_d"), F.col("key").alias("_k"), "places"), (F.col("doc") == F.col("_d")) & (F.col("key") == F.col("_k")))
    texts = met.groupBy("doc", "key").agg(F.first("text").alias("text"), F.first("places").alias("places"))
    return texts.mapInArrow(_cut_out, "part long, same long, variant byte, doc long, key long, start long, bytes binary")


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, key, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
            data = (text.as_py() or "").encode()
            out += [(p["part"], p["part"], p["variant"], doc, key, p["start"], data[p["start"] : p["last"] + WINDOW]) for p in places.as_py()]
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["part", "same", "variant", "doc", "key", "start", "bytes"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, runs in zip(batch.column(0), batch.column(1), batch.column(2)):
            data = (text.as_py() or "").encode()
            end, spans, kept = 0, [], []
            for run in sorted(((r["start"], r["last"] + WINDOW) for r in runs.as_py() or ())):
                if spans and run[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], run[1])
                else:
                    spans.append([*run])
            for a, b in spans:
                kept.append(data[end:a])
                end = b
            kept.append(data[end:])
            rest = b"".join(kept)
            out.append((doc_id.as_py(), len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest))
        if out:
            kinds = (pa.int64(),) * 4 + (pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What is left of each text without the bytes covered by a WINDOW-byte string that also starts earlier.

    Earlier: in a row with a smaller doc_id (null first), or at an earlier start in the same row or one of the same id; at
    equal starts of rows with one id neither is earlier. Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept
    (bytes, which may cut a character). Null and empty texts have no bytes. Repeated rows are all returned; an empty table
    gives no rows; other columns are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    found = repeats(rows.select("doc", "key", "text")).groupBy("doc", "key").agg(F.collect_set(F.struct("start", "last")).alias("runs"))
    met = rows.join(found.select(F.col("doc").alias("_d"), F.col("key").alias("_k"), "runs"), (F.col("doc") == F.col("_d")) & (F.col("key") == F.col("_k")), "left")
    return met.select("doc_id", "text", "runs").mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).drop("kept")
