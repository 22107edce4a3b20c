"""Packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import base64
import json
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, numbered, table

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.tiktoken"
END_ID = 0

_encoders: dict[str, object] = {}


def encoder(path: str):
    """A worker's encoder for the byte-level vocabulary at `path`.

    Its `encode` with all special tokens allowed gives the ids that byte_bpe_50k.json gives at its defaults without those
    added around a text (the same vocabulary, written as ranks; the tests hold the two against each other). The added
    tokens, such as <|endoftext|>, are those of the json file beside `path`, if there is one.
    """
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        added, beside = {}, f"{os.path.splitext(path)[0]}.json"
        if os.path.exists(beside):
            with open(beside, encoding="utf-8") as file:
                added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return _encoders[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, if kept) of each document's pieces of at most `capacity` ids.

    A document's ids are those of its whole text (null: empty) and the end id. Longer ones are cut so that all pieces
    but the first have `capacity` ids.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] if keep_ids else []
    schema = pa.schema(fields)
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    end = np.array([END_ID], "<u4").tobytes()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array(enc.encode(text.as_py() or "", allowed_special="all"), "<u4").tobytes() + end
                n = len(ids) // 4
                starts = [0, *range(n % capacity or capacity, n, capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                    piece = ids[4 * a : 4 * b]
                    out.append((doc_id, k, a, b - a, zlib.crc32(piece), piece)[: len(fields)])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut_up, ddl)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, sequence, each, offset): pieces of one length numbered first..last - 1 go `each` to a
    sequence, from `sequence` on, at `offset`.

    Pieces over a third of the capacity are matched first: the longest one takes the longest other that fits beside it,
    so at most two stand in a sequence. Smaller ones then go, longest first, into the tightest gap that holds them, and
    open new sequences when none does. Equal lengths are handled together, so the work depends on how many different
    lengths there are (capacity at most), not on how many pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    placed: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[list[int]]] = {}  # gap: ranges of sequences that have it
    order: list[int] = []  # gaps, ascending
    n_sequences = 0

    def free(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append([first, n])

    def put(length: int, first: int, n: int, each: int, offset: int) -> None:
        placed.append((length, used[length], used[length] + n * each, first, each, offset))
        used[length] += n * each
        left[length] -= n * each

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        k = bisect_left(large, capacity - a + 1) - 1
        while k >= 0 and (not left[large[k]] or large[k] == a and left[a] < 2):
            k -= 1
        b = large[k] if k >= 0 else 0
        n = left[a] if not b else left[a] // 2 if a == b else min(left[a], left[b])
        if a == b:
            put(a, n_sequences, n, 2, 0)
        else:
            put(a, n_sequences, n, 1, 0)
            if b:
                put(b, n_sequences, n, 1, a)
        free(capacity - a - b, n_sequences, n)
        n_sequences += n
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            k = bisect_left(order, length)
            if k == len(order):
                each = min(capacity // length, left[length])
                n = left[length] // each
                put(length, n_sequences, n, each, 0)
                free(capacity - each * length, n_sequences, n)
                n_sequences += n
                continue
            gap = order[k]
            each = min(gap // length, left[length])
            first, have = gaps[gap][-1]
            n = min(have, left[length] // each)
            if n == have:
                gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(k)
            else:
                gaps[gap][-1] = [first + n, have - n]
            put(length, first, n, each, capacity - gap)
            free(gap - each * length, first, n)
    return placed


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset.

    Only the count of pieces of each length (capacity rows at most) reaches the driver, which plans whole ranges of
    equal pieces; each piece then finds its range by its number among the pieces of its length.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    ranges = plan(counts, capacity)
    plan_df = spark.createDataFrame(ranges or [], "l long, first long, last long, seq long, each long, off long")
    rows = numbered(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "_rank", sum(counts.values()))
    found = rows.join(F.broadcast(plan_df), (F.col("length") == F.col("l")) & (F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("last")))
    k = F.col("_rank") - F.col("first")
    sequence = F.col("seq") + F.floor(k / F.col("each")).cast("long")
    return found.withColumn("sequence_id", sequence).withColumn("offset", F.col("off") + k % F.col("each") * F.col("length")).drop("_rank", *plan_df.columns)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents packed into sequences of at most `capacity` ids.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, one row per piece. Null and empty texts are one
    end id. Repeated rows and rows without an id are packed each on its own. An empty table gives no rows; other columns
    are left out.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path(TOKENIZER)
    return pack(cut(token_pieces(docs, tokenizer_path, capacity, id_col, text_col)), capacity)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
