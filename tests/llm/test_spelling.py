from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import spelling as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_off(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_words(docs, noise=True):
    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def plain(words):
    """{word: n} -> the rows of variants."""
    by_key = {}
    for w in words:
        for form in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_key.setdefault(form, []).append(w)
    near = {w: {v for form in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} for v in by_key[form] if one_off(w, v)} for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def made(n=400):
    rnd = random.Random(6)
    return {"".join(rnd.choice("abcé") for _ in range(rnd.choice([1, 2, 4, 5, 5, 6, 6, 7, 12]))): rnd.randint(1, 60) for _ in range(n)}


def test_against_all_pairs(spark):
    words = made()
    assert rows(S.variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(3))) == plain(words)


def test_words_that_share_a_half_are_cut_further(spark, monkeypatch):
    words = made() | {"same" * 3 + x + y: i + 3 for i, (x, y) in enumerate((x, y) for x in "abcdefgh" for y in "abcdefgh")} | {"aaaaaaaa" + "b" * i: 3 * i + 3 for i in range(9)}
    for hot in (3, 12):
        monkeypatch.setattr(S, "HOT", hot)
        assert rows(S.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == plain(words)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=6), min_size=1, max_size=40))
def test_automaton(words):
    held = sorted(words)
    dawg = S.Dawg(held)
    assert all(dawg.walk(dawg.root, 0, w)[1] == i and dawg.final[dawg.walk(dawg.root, 0, w)[0]] for i, w in enumerate(held))
    rights = lambda at: frozenset({""} if dawg.final[at] else set()) | {c + r for c, (to, _) in dawg.edges[at].items() for r in rights(to)}
    assert len({rights(i) for i in range(len(dawg.edges))}) == len(dawg.edges)
    for w in held:
        found = [held[i] for i, _ in dawg.one_off(w, 0, len(w) + 1)]
        assert sorted(found) == sorted(v for v in words if len(v) in (len(w), len(w) + 1) and one_off(w, v))


def test_documents(spark, documents, sf_dir):
    words = {w: n for w, n in plain_words([(r.doc_id, r.text) for r in documents.collect()]).items() if len(w) >= 5 and n >= 3}
    assert rows(S.op13_spelling(spark, sf_dir)) == plain(words)


def test_noise(spark):
    docs = [(i, "Überraſchung NAÏVE naïve × ÷ x İ straße\n" * 3) for i in range(300)] + [(None, "word"), (5, None), (6, "")]
    got = {r.word: r.n for r in S.word_counts(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = plain_words(docs)
    del want[""]
    assert got == want and len(got) > 10


def test_odd_rows(odd_docs, no_docs):
    words = {w: n for w, n in plain_words([(r.doc_id, r.text) for r in odd_docs.collect()]).items() if len(w) >= 5 and n >= 3}
    assert rows(S.spelling_variants(odd_docs, noise=True)) == plain(words)
    assert S.spelling_variants(no_docs).count() == 0
