from __future__ import annotations

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import substrings as S


def plain(docs):
    """(doc_id, text) in order -> (n_bytes, n_removed, n_spans, sha256) of each."""
    seen, out = set(), []
    for _, text in docs:
        b = (text or "").encode()
        covered = bytearray(len(b))
        for i in range(len(b) - S.WINDOW + 1):
            window = b[i : i + S.WINDOW]
            if window in seen:
                covered[i : i + S.WINDOW] = b"\1" * S.WINDOW
            seen.add(window)
        spans = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        out.append((len(b), sum(covered), spans, hashlib.sha256(bytes(x for x, c in zip(b, covered) if not c)).hexdigest()))
    return out


def check(spark, docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == dict(zip((d for d, _ in docs), plain(docs)))


def repetitive():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(20, 400)))
    shared = [word() for _ in range(6)]
    docs = [(i, "".join(rnd.choice(shared) if rnd.random() < 0.6 else word() for _ in range(rnd.randint(0, 6)))) for i in range(60)]
    return [*docs, (60, None), (61, "x" * 500), (62, "ab" * 400), (63, "x" * 300), (64, docs[3][1]), (65, "short")]


def test_against_brute_force(spark):
    check(spark, repetitive())


def test_pieces_of_long_texts_and_wide_groups(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 700)
    check(spark, repetitive())
    monkeypatch.setattr(S, "WIDE", 2)
    check(spark, repetitive())


def test_documents(spark, documents):
    check(spark, [(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=12).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6))
def test_run_length_index(texts):
    order, shared = S.run_length_index(texts)
    suffixes = sorted(((list(t[i:]) + [256 + k], k, i) for k, t in enumerate(texts) for i in range(len(t) + 1)))
    begin = [sum(len(t) + 1 for t in texts[:k]) for k in range(len(texts))]
    assert order.tolist() == [begin[k] + i for _, k, i in suffixes]
    for n, (a, b) in enumerate(zip(suffixes, suffixes[1:]), 1):
        same = next((j for j, (x, y) in enumerate(zip(a[0], b[0])) if x != y), min(len(a[0]), len(b[0])))
        assert shared[n] == same


def test_odd_rows(odd_docs, no_docs):
    rows = S.dedup(odd_docs).collect()
    assert len(rows) == odd_docs.count() and S.dedup(no_docs).count() == 0
    assert [(r.n_bytes > 0, r.n_removed == r.n_bytes) for r in rows if r.doc_id == 4] == [(True, True)]
    assert all(r.n_removed == 0 for r in rows if r.doc_id in (1, 2, 5, 6, 7))


def test_hot_anchors_are_dealt_by_region(spark, monkeypatch):
    monkeypatch.setattr(S, "SAMPLED", 1)
    monkeypatch.setattr(S, "WIDE", 4)
    rnd = random.Random(8)
    docs = [(i, "".join(rnd.choice("xyz ") for _ in range(rnd.randint(30, 90))) + "-" * rnd.randint(33, 150) + f"{i}" * 40) for i in range(80)]
    rows = spark.createDataFrame([(d, d, t) for d, t in docs], "doc long, key long, text string")
    assert len(S.hot_anchors(rows))
    check(spark, docs)


def test_repeated_rows_are_cut_once(spark, monkeypatch):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abc ") for _ in range(400))
    docs = [(1, text)] * 2000 + [(2, text[:200] + "#" + text[200:])]
    asked, cut_outs = [], S.cut_outs
    monkeypatch.setattr(S, "cut_outs", lambda docs, variants: asked.append(cut_outs(docs, variants)) or asked[-1])
    rows = S.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert asked[0].count() < 100
    assert [(r.n_removed, r.n_bytes) for r in rows if r.doc_id == 1] == [(0, 400)] * 2000
    assert [(r.n_removed, r.n_spans) for r in rows if r.doc_id == 2] == [(400, 2)]


def test_regions_across_batches():
    """Whatever the size of batches, sort_regions tells the same rows."""
    import pyarrow as pa

    rnd = random.Random(10)
    rows = sorted((rnd.randint(0, 12), rnd.randint(0, 2), rnd.randint(0, 2), rnd.randint(0, 1), k) for k in (rnd.randint(0, 1) for _ in range(300)))
    columns = [[p for p, *_ in rows], [r for _, r, *_ in rows], [d for _, _, d, *_ in rows], [k for *_, k in rows], [s for *_, s, _ in rows], [s + 1 for *_, s, _ in rows], [S.HOT if p == 3 else S.PLAIN for p, *_ in rows]]
    kinds = [pa.int64()] * 6 + [pa.int8()]
    table = pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "region", "doc", "key", "start", "last", "kind"])
    told = [sorted(tuple(r.values()) for b in S.sort_regions(iter(table.to_batches(n))) for r in b.to_pylist()) for n in (1, 2, 3, 7, 50, 1000)]
    assert all(x == told[0] for x in told)
    for p in {r[0] for r in rows}:
        heads = {}
        for part, region, doc, start, key in (r for r in rows if r[0] == p):
            heads.setdefault(region, (doc, start))
        want = {(p, d, k, s, s + 1, -1) for _, r, d, s, k in (x for x in rows if x[0] == p) if (d, s) != heads[r]}
        if len(heads) > 1 or p == 3:
            want |= {(p, d, k, s, s + 1, S.HOT if p == 3 else S.PLAIN) for _, r, d, s, k in (x for x in rows if x[0] == p) if (d, s) == heads[r]}
        assert {t for t in told[0] if t[0] == p} == want
