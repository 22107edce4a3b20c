from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [[w for w in re.split(r"[ \t]+", p) if w] for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER))]


def plain(docs, min_count=10, cover=50, top=2000):
    """(lang, text) rows -> the rows of collocations."""
    f = defaultdict(Counter)
    for lang, text in docs:
        for words in pieces(text):
            for k in (1, 2, 3):
                f[lang if lang is not None else "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        cand = {p: c for p, c in counts.items() if len(p) > 1 and c >= min_count}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * c >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in cand.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]  # noqa: E741
    return sorted(out)


def corpus():
    rnd = random.Random(2)
    words = ["new", "York", "times", "old", "the", "é", "a-b", "#x"]
    fixed = ["new york times", "in spite of", "ad hoc", "x y"]
    text = lambda: "".join((rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choice(words)) + rnd.choice([" ", " ", "\t", ", ", ". ", "  ", "\n", "\x0b", "\x1c"]) for _ in range(rnd.randint(0, 60)))
    return [(rnd.choice(["en", "de", None, "und"]), text()) for _ in range(150)] + [("en", None), ("en", ""), ("fr", " .,; "), ("es", "one")]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_against_brute_force(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    assert rows(C.collocations(df)) == plain(docs)
    assert rows(C.collocations(df, min_count=3, cover=90, top=5)) == plain(docs, 3, 90, 5)


def test_small_shards_and_a_full_filter_change_nothing(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame(docs, "lang string, text string").repartition(2)
    monkeypatch.setattr(C, "SHARD", 200)
    assert rows(C.collocations(df)) == plain(docs)
    monkeypatch.setattr(C, "pair_filter", lambda pairs: np.full(C.FILTER, -1, np.int64))
    assert rows(C.collocations(df)) == plain(docs)


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    counted = [("en", 1, "a", big + 7), ("en", 1, "b", big), ("en", 2, "a b", big - 11)]
    got = C.scored(spark.createDataFrame(counted, "lang string, length int, phrase string, n long"), 10, 50, 5).collect()
    assert [r.score for r in got] == [10**6 * (big - 11) ** 2 // ((big + 7) * big)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=9), min_size=1, max_size=6), st.integers(1, 5))
def test_states_of_the_automaton(texts, depth):
    word = np.array([w for t in texts for w in t], np.int64)
    begins = np.array([i == 0 for t in texts for i in range(len(t))])
    states = C.automaton(word, begins, depth)
    ends, at = defaultdict(set), 0
    for t in texts:
        for j in range(len(t)):
            for k in range(1, min(depth, j + 1) + 1):
                ends[tuple(t[j - k + 1 : j + 1])].add(at + j)
        at += len(t)
    classes = defaultdict(list)
    for phrase, places in ends.items():
        classes[frozenset(places)].append(phrase)
    told = {}
    for end, longest, shortest, count, link in zip(*states):
        phrase = tuple(word[end - longest + 1 : end + 1].tolist())
        own = classes[frozenset(ends[phrase])]
        assert count == len(ends[phrase]) and sorted(map(len, own)) == list(range(shortest, longest + 1)) and len(own[0]) in range(shortest, longest + 1)
        if link < 0:
            assert shortest == 1
        else:
            assert states.longest[link] == shortest - 1 and tuple(word[states.end[link] - shortest + 2 : states.end[link] + 1].tolist()) == phrase[len(phrase) - shortest + 1 :]
        told[phrase] = True
    assert len(told) == len(classes)
    for k in range(1, depth + 1):
        end, count = C.substrings(states, k)
        assert {tuple(word[e - k + 1 : e + 1].tolist()): c for e, c in zip(end, count)} == {p: len(x) for p, x in ends.items() if len(p) == k}


def test_documents(spark, documents):
    assert rows(C.collocations(documents)) == plain([(r.lang, r.text) for r in documents.collect()])


def test_odd_rows(odd_docs, no_docs):
    assert rows(C.collocations(odd_docs)) == plain([(r.lang, r.text) for r in odd_docs.collect()])
    assert C.collocations(no_docs).count() == 0
