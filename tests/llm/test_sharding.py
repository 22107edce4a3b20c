from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np

from docloom.llm.sharding import assign, jump


def one_jump(key: int, n: int) -> int:
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_by_hand():
    keys = np.random.default_rng(1).integers(0, 2**63, 500, np.uint64) * np.uint64(2)
    for n in (1, 2, 40, 41, 1000):
        assert jump(keys, n).tolist() == [one_jump(int(k), n) for k in keys]


def test_shards(documents):
    rows, texts = assign(documents).collect(), {r.doc_id: r.text for r in documents.collect()}
    slots = defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows(odd_docs, no_docs):
    rows = assign(odd_docs, 4).collect()
    assert len(rows) == odd_docs.count() and assign(no_docs).count() == 0
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in Counter(r.shard for r in rows).items())
    assert len({r.shard for r in rows if r.doc_id is None}) == 1 and len({r.shard for r in rows if r.doc_id == 5}) == 1
    assert {r["size"] for r in rows if r.doc_id == 2} == {16}
