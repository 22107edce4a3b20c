from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docloom.llm.quality import fit, judge, measures, rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)), set()
    for i in range(len(words) - 4):
        if seen[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def found(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_measures(spark, documents):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60))) for _ in range(80)] + ["\n \nx\nx\n\x0by", "  a b", "a\x1cb", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in measures(docs).collect():
        assert found(r) == plain(texts[r.doc_id])
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        assert r.n_clean_words == sum(bool(re.fullmatch(r"[\w'’-]+[.,;:!?]?", w)) and "_" not in w for w in words)
    whole = {r.doc_id: r.text for r in documents.collect()}
    for r in judge(documents).collect():
        assert found(r) == plain(whole[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)


def plain_em(rows, rounds=200):
    """(prior, rates of objecting on good and on bad rows) by expectation-maximisation over single rows."""
    rules_ = range(len(rows[0]))
    good = [(1 + sum(v > 0 for v in r)) / (2 + sum(v != 0 for v in r)) for r in rows]
    for _ in range(rounds):
        rate = []
        for share in (good, [1 - g for g in good]):
            against = [1 + sum(s for s, r in zip(share, rows) if r[k] < 0) for k in rules_]
            for_ = [1 + sum(s for s, r in zip(share, rows) if r[k] > 0) for k in rules_]
            rate.append([a / (a + b) for a, b in zip(against, for_)])
        prior, last = (sum(good) + 1) / (len(rows) + 2), good
        good = []
        for r in rows:
            yes, no = math.log(prior), math.log(1 - prior)
            for k in rules_:
                if r[k]:
                    yes += math.log(rate[0][k] if r[k] < 0 else 1 - rate[0][k])
                    no += math.log(rate[1][k] if r[k] < 0 else 1 - rate[1][k])
            good.append(1 / (1 + math.exp(no - yes)))
        if max(abs(a - b) for a, b in zip(good, last)) < 1e-9:
            break
    return prior, rate


def test_against_plain_em(spark):
    rnd = random.Random(9)
    rows = []
    for _ in range(600):
        bad = rnd.random() < 0.2
        rows.append(tuple(rnd.choices([-1, 0, 1], [w, 0.2, 1 - w])[0] for w in ([0.7, 0.6, 0.5, 0.8] if bad else [0.05, 0.1, 0.02, 0.3])))
    names = list("abcd")
    share, odds = fit(spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names)), names)
    prior, rate = plain_em(rows)
    assert share == pytest.approx(prior, abs=1e-6)
    for i, n in enumerate(names):
        assert odds[n][-1] == pytest.approx(math.log(rate[0][i] / rate[1][i]), abs=1e-5) and odds[n][0] == 0
        assert odds[n][1] == pytest.approx(math.log((1 - rate[0][i]) / (1 - rate[1][i])), abs=1e-5)


def test_agrees_with_labels_and_is_no_veto(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = judge(docs, with_votes=True).where("not base_failed").join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id", "left").collect()
    good, bad = [r for r in rows if r.label == 1], [r for r in rows if r.label == 0]
    assert sum(r.kept for r in good) >= 0.999 * len(good) and sum(r.kept for r in bad) <= 0.03 * len(bad)
    names = list(rules())
    objections = [sum(r[n] < 0 for n in names) for r in rows]
    assert any(k and r.kept for k, r in zip(objections, rows)), "an objection is no veto"


def test_odd_rows(odd_docs, no_docs):
    rows = judge(odd_docs).collect()
    assert len(rows) == odd_docs.count() and judge(no_docs).count() == 0
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 6))
