from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from docloom.llm.packing import encoder, pack_documents, plan


def check(rows, ids_of, capacity=2048):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, own in pieces.items():
        ids, at = ids_of[doc_id], 0
        for k, r in enumerate(sorted(own, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_documents(documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0] for r in documents.collect()}
    n = check(pack_documents(documents).collect(), ids)
    assert n <= -(-sum(map(len, ids.values())) // 2048) + 2


def test_same_ids_as_the_tokenizer():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ranks = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = ["", " ", "a  b\n\n c\t", "don't I'll", "ÄÖ ñ 漢字 🙂 ‍", "x" * 3000, "<|endoftext|> end", "\x00\x01 ﻿", "12345 1,000.50", " 　 wide"]
    assert [ranks.encode_ordinary(t) for t in texts] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_added_tokens_as_the_tokenizer(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, f"{mark}{mark} \n {mark}x", f"  {mark}  end  ", f"don't{mark}'ll", "<|endoftext|", f"ÄÖ 漢字 {mark * 3} 🙂"]
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    check(pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect(), ids)


def test_plan_places_every_piece_once():
    rnd = random.Random(1)
    for _ in range(60):
        capacity = rnd.choice([10, 30, 100])
        counts = {n: rnd.randint(1, 40) for n in rnd.sample(range(1, capacity + 1), rnd.randint(1, min(9, capacity)))}
        taken, ranks = defaultdict(set), defaultdict(list)
        for length, first, last, sequence, each, offset in plan(counts, capacity):
            for rank in range(first, last):
                ranks[length].append(rank)
                at = offset + (rank - first) % each * length
                cells = set(range(at, at + length))
                assert max(cells) < capacity and not cells & taken[sequence + (rank - first) // each]
                taken[sequence + (rank - first) // each] |= cells
        assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
        assert all(cells == set(range(len(cells))) for cells in taken.values())


def test_odd_rows(odd_docs, no_docs):
    rows = pack_documents(odd_docs).collect()
    assert sum(r.piece == 0 for r in rows) == odd_docs.count() and pack_documents(no_docs).count() == 0
    assert {r.length for r in rows if r.doc_id in (1, 2)} == {1}
