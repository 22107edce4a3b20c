from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from docloom.llm import lines as L

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, min_docs=2):
    """(doc_id, text) -> (n_lines, n_dropped, kept) of each row."""
    own = lambda line: line.strip(BLANKS).translate(LOWER)
    holders = defaultdict(set)
    order = lambda d: L.NO_ID if d is None else d
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(own(line)) >= 10:
                holders[own(line)].add(order(doc))
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[own(x)]) < min_docs or order(doc) == min(holders[own(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df, min_docs=2):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in L.dedup(df, min_docs=min_docs).collect()), key=str)


@pytest.mark.parametrize("min_docs", [1, 2, 4])
def test_against_brute_force(spark, min_docs):
    rnd = random.Random(3)
    pool = ["a line of ten", " A Line Of Ten\t", "short", "ÄÖÜ äöü ßé ok", "äöü äöü ßé ok", "\x0bİstanbul is not lower\r", "", "123456789", "1234567890", "\U0001f600" * 9, "\U0001f600" * 10, "own"]
    docs = [(i, "\n".join(rnd.choice(pool) + (str(i) if rnd.random() < 0.2 else "") for _ in range(rnd.randint(0, 9)))) for i in range(120)]
    docs += [(7, "a line of ten\n a line of ten "), (7, "another of the same id"), (None, "a line of ten"), (None, None), (130, ""), (131, "\n\n"), (132, "only here, twice\nonly here, twice")]
    docs += [docs[3], docs[3], (133, "\n".join(["a line of ten"] * 3000 + [f"line number {i} of a long text" for i in range(20_000)]))]
    assert got(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), min_docs) == plain(docs, min_docs)


def test_documents(spark, documents, sf_dir):
    rows = {r.doc_id: tuple(r) for r in L.op11_line_dedup(spark, sf_dir).collect()}
    want = {d: (d, n, m, hashlib.sha256(k.encode()).hexdigest()) for d, n, m, k in plain([(r.doc_id, r.text) for r in documents.collect()])}
    assert rows == want and any(m for _, _, m, _ in want.values())


def test_odd_rows(odd_docs, no_docs):
    assert got(odd_docs) == plain([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert L.dedup(no_docs).count() == 0
