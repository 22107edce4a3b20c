from __future__ import annotations

import random

import pytest

from docloom.operators import graph as G
from docloom.operators import mapping as P
from docloom.operators import matching as M


@pytest.mark.parametrize("seed", range(3))
def test_only_holders_by_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "éclair", "x", "ab ab ab ab ab ab ab ab", "中文", "a😀b"]
    texts = [(" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))), str(rnd.randint(1, 40))) for _ in range(60)] + [("", "1"), (None, "2"), ("short", "3")]
    texts += [(texts[0][0], "50"), (texts[1][0], texts[1][1])]
    names = []
    for t, _ in texts:
        for _ in range(4):
            if t and len(t) >= 24:
                at = rnd.randint(0, len(t) - 20)
                names.append((t[at : at + rnd.randint(20, 45)].upper(),))
    names += [("nothing of this kind stands in any text",), ("alpha",), (None,)]
    held = {}
    for (name,) in names:
        if name and len(name) >= 20:
            found = {v for t, v in texts if t and name.lower() in t.lower()}
            if len(found) == 1:
                held[name.lower()] = found.pop()
    df, q = spark.createDataFrame(texts, "t string, v string"), spark.createDataFrame(names, "n string")
    assert held and {r["name"]: r["value"] for r in M.only_holders(df, "t", "v", q, "n", 20).collect()} == held


def test_anchors_are_few_and_hold_those_of_each_stretch():
    rnd = random.Random(4)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(5000))
    at, runs = M.anchors(text, 30)
    assert len(at) < 700
    assert all(M._runs(text[i : i + 30]).min() in set(runs[(at >= i) & (at <= i + 18)]) for i in range(0, 4970, 7))


def test_names_and_titles_meet_once(spark, monkeypatch):
    """Before, each row of a name met each row of a title."""
    met = []
    monkeypatch.setattr(M, "contained", lambda texts, *rest, f=M.contained: met.append((texts.count(), rest[2].count())) or f(texts, *rest))
    registry = spark.createDataFrame([(i, ["Large Ring", "hot bolt", None][i % 3]) for i in range(60)] + [(99, "only one plate")], "e long, t string")
    refs = spark.createDataFrame([(i, ["RGE RI", "One pl", "no such", None, "ot"][i % 5]) for i in range(100)], "r long, n string")
    found = {(r["r"] % 5, r["target"], r["method"]) for r in M.aliases(refs, "r", "n", registry, "e", "t", lambda c: c).collect()}
    assert found == {(0, None, "unresolved"), (1, 99, "contains"), (2, None, "unresolved"), (3, None, "unresolved"), (4, None, "unresolved")}
    assert met == [(4, 3)]


def test_titles_are_compared_once(spark, monkeypatch):
    """Before, each pair of rows was compared."""
    rows = [(i, ["large ring", "large rings", "hot bolt", "", None][i % 5], i % 2) for i in range(80)]
    compared = spark.sparkContext.accumulator(0)

    def alike(a, b, f=P.T.alike):
        from pyspark.sql import functions as F

        count = F.udf(lambda x, y: compared.add(1) or True, "boolean")
        return count(a, b) & f(a, b)

    monkeypatch.setattr(P.T, "alike", alike)
    out = sorted(tuple(r) for r in P.alike_rows(spark.createDataFrame(rows, "k long, t string, w int"), "k", "t", ["w"]).collect())
    same = lambda x, y: x and y and (x == y or {x, y} == {"large ring", "large rings"})
    assert out == sorted((a, b) for a, t, w in rows for b, u, x in rows if a < b and w == x and same(t, u))
    assert compared.value <= 2 * 9


def test_edges_of_levels_are_found_once(spark):
    """Before, each round found the edges again."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([(i, i + 1) for i in range(5)], "s long, d long").mapInArrow(seen, "s long, d long")
    assert {tuple(r) for r in G.levels(edges, "s", "d").collect()} == {(i, i) for i in range(6)}
    assert read.value == 5
