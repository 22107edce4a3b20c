from __future__ import annotations

import math
import re

import pytest

from docloom.llm.licenses import BASE, N_SCORED, SLACK, scan, templates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for phrase, label in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in scan(documents).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1


CASES = [
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0", 1.0),
    ("licensed under the GNU General Public License, version 3; MIT license; cc-by", "cc-by,gpl,gpl-3.0,mit", 1.0),
    ("mit mit license license cc cc by by", "cc-by,mit", None),
    ("GNU Lesser General Public License", "lgpl", None),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or later.", "gpl,gpl-3.0", None),
    ("the GNU General Public License as published once; there is either version of the license", "gpl", None),
    ("Permission is hereby granted, free of charge, to any one person who is obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction", "mit", None),
    ("Permission is hereby granted, free of charge", "", 0.0),
    ("mitK license, apache licenſe, gnu general public", "", 0.0),
    ("redistribution and use in source and binary forms", "bsd", None),
    ("MIT License " * 3000, "mit", None),
    ("", "", 0.0),
    (None, "", 0.0),
]


def test_labels(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CASES)], "doc_id long, text string")
    for r in scan(docs).collect():
        text, labels, score = CASES[r.doc_id]
        assert r.labels == labels and (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(text)
        assert score is None or r.score == pytest.approx(score)


def plain_labels(text, templates, idf):
    """Labels and score by looking at every place for every notice."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    there = lambda p, at: at >= 0 and words[at : at + len(p)] == p
    near = range(-SLACK, SLACK + 1)
    labels, score = set(), 0.0
    for x in templates:
        for at in range(len(words)):
            if there(x.phrase, at) and all(any(there(p, at + d + e) for e in near) for d, p in x.others):
                own = list(enumerate(x.phrase)) + sorted(((d, w) for d, w in x.words if not 0 <= d < len(x.phrase)), key=lambda w: (-idf[w[1]], w[0]))[:N_SCORED]
                here = sum(idf[w] for d, w in own if any(0 <= at + d + e < len(words) and words[at + d + e] == w for e in near))
                labels.add(x.label)
                score = max(score, min(1.0, here / sum(idf[w] for _, w in own)))
    return ",".join(sorted(labels)), score


@pytest.mark.parametrize("given", [False, True])
def test_against_every_place(spark, documents, given):
    notices = spark.createDataFrame([("own", "Copy FREELY, with love and the cc-by!", ["with love", "cc by"]), ("short", "und", ["und"])], "label string, text string, phrases array<string>") if given else None
    every = templates(notices)
    docs = documents.select("doc_id", "text").union(spark.createDataFrame([(10**6 + i, t) for i, (t, _, _) in enumerate(CASES) if len(t or "") < 5000] + [(10**7, "copy freely with love and above all the very cc by")], "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    vocabulary = sorted({w for x in every for _, w in x.words})
    sets = [set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for t in texts.values()]
    idf = {w: math.log((len(sets) + 1) / (sum(w in s for s in sets) + 0.5)) for w in vocabulary}
    for r in scan(docs, notices=notices).collect():
        labels, score = plain_labels(texts[r.doc_id], every, idf)
        assert r.labels == labels and r.score == pytest.approx(score)
        assert not given or r.doc_id != 10**7 or "own" in labels


def test_phrase_outside_its_notice(spark):
    with pytest.raises(ValueError):
        templates(spark.createDataFrame([("own", "some text", ["other"])], "label string, text string, phrases array<string>"))


def test_odd_rows(odd_docs, no_docs):
    rows = scan(odd_docs).collect()
    assert len(rows) == odd_docs.count() and scan(no_docs).count() == 0
    assert {r.n_words for r in rows if r.doc_id in (1, 2, 6)} == {0}
