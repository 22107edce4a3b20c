from __future__ import annotations

import random

import numpy as np
import pytest

from docloom.llm.decontamination import Items, edits_of, leaks, sampled_walks, without_leaks, words_of


def distance(item, words):
    """Least word edits between item and any part of words."""
    row = [0] * (len(words) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(words, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != v)))
        row = new
    return min(row)


def check(spark, docs, items):
    got = {(r.doc_id, r.item_id): r.edits for r in leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for d, text in docs:
        for i, item in items:
            words = words_of(item)
            if words and (n := distance(words, words_of(text))) <= edits_of(len(words)):
                want[d, i] = n
    return got, want


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rnd.randint(1, 50)))) for i in range(40)] + [(90, ""), (91, None), (92, "one"), (93, "two words")]
    docs = []
    for d in range(160):
        words = items[d % 40][1].split()
        for _ in range(rnd.randint(0, len(words) // 4)):
            at = rnd.randrange(len(words) + 1)
            kind = rnd.choice("rid")
            words[at : at + (kind != "i")] = [] if kind == "d" else [word()]
        filler = lambda: " ".join(word() for _ in range(rnd.randint(0, 60)))
        docs.append((d, f"{filler()} {', '.join(words).upper()}! {filler()}"))
    return [*docs, (500, ""), (501, None), (502, "One. Two\nwords"), (503, items[9][1]), (503, items[9][1])], items


def test_against_edit_distances(spark, planted):
    got, want = check(spark, *planted)
    assert set(got) <= set(want) and len(got) >= 0.98 * len(want)
    assert sum(got[k] == want[k] for k in got) >= 0.98 * len(got)
    assert {k for k, n in want.items() if n == 0} <= set(got)


def test_blocks_of_items(spark, planted, monkeypatch):
    from docloom.llm import decontamination as D

    whole, _ = check(spark, *planted)
    monkeypatch.setattr(D, "BLOCK_WORDS", 300)
    assert check(spark, *planted)[0] == whole


def test_documents(spark, sf_dir, documents):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in leaks(documents, items).collect()}
    texts = items.collect()
    assert got >= {(d.doc_id, i.item_id) for d in documents.collect() for i in texts if i.text in (d.text or "")}


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two three four five six"), (2, None)], "item_id long, text string")
    rows = leaks(odd_docs, items).collect()
    assert [(r.doc_id, r.item_id, r.edits) for r in rows] == [(5, 1, 0)] * 2
    assert leaks(no_docs, items).count() == 0 and leaks(odd_docs, items.limit(0)).count() == 0


def test_skip_loses_nothing(planted):
    docs, items = planted
    ready = Items([(i, t) for i, t in items])
    texts = [t for _, t in docs[:60]]
    own = ready.search(texts)
    every = ready.search(texts, skip=False)
    assert {x[:2] for x in own} == {x[:2] for x in every}
    best = {x[:2]: x[2] for x in every}
    assert all(d >= best[t, i] for t, i, d, _ in own)


@pytest.mark.parametrize("share, least", [(0.05, 0.99), (0.1, 0.97), (0.15, 0.95), (0.2, 0.9)])
def test_recall_of_walks_alone(share, least):
    """One window, laid where the edited passage begins, with no help from others."""
    rnd = random.Random(11)
    word = lambda: rnd.getrandbits(62) | 1
    n, found, unrelated, total = 40, 0, 0, 300
    for _ in range(total):
        item = [word() for _ in range(n)]
        other = list(item)
        for _ in range(int(share * n)):
            at = rnd.randrange(1, len(other))
            kind = rnd.choice("rid")
            other[at : at + (kind != "i")] = [] if kind == "d" else [word()]
        other = (other + [word() for _ in range(n)])[:n]
        rows = np.array([item, other, [word() for _ in range(n)]], np.uint64)
        keys = sampled_walks(rows)
        found += (keys[0] == keys[1]).any()
        unrelated += (keys[0] == keys[2]).any()
    assert found >= least * total and unrelated == 0


def test_other_scripts(spark):
    docs = spark.createDataFrame([(1, "前面的话。今天天气很好我们去公园散步吧，后面的话"), (2, "别的内容完全不同的一句话"), (3, "so — “the quick brown fox…jumps” over")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "今天天气很好，我们去公园散步吧"), (8, "the quick brown fox jumps over")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()} == {(1, 7), (3, 8)}


def test_decided_by_the_text(spark):
    leaked = "one two three four five six seven"
    docs = spark.createDataFrame([(None, f"x {leaked} y", 1), (5, f"z {leaked}", 2), (5, "clean text of the same id", 3), (None, None, 4), (6, "", 5)], "doc_id long, text string, row int")
    items = spark.createDataFrame([(1, leaked)], "item_id long, text string")
    kept = without_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(r.row for r in kept.collect()) == [3, 4, 5]
