from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from docloom.operators import search as S


def brute(rows, asked, k, metric):
    """(query, row, distance, rank) of all pairs, one by one."""
    out = []
    for q, a in asked:
        each = []
        for r, b in rows:
            if metric == "cosine":
                size = sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5
                d = 1 - (sum(x * y for x, y in zip(a, b)) / size if size else 0.0)
            else:
                d = sum((x - y) ** 2 for x, y in zip(a, b)) ** 0.5
            each.append((round(d, 6), r))
        out += [(q, r, d, n + 1) for n, (d, r) in enumerate(sorted(each)[:k])]
    return sorted(out)


def made(n, seed, dim=6):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, dim)).round(3)
    x[n // 3 : n // 2] = x[0]  # many copies of one vector
    x[n // 2] = 0
    return [(i, v) for i, v in enumerate(x.tolist())]


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("far", [0.0, 5000.0])
def test_all_pairs(spark, metric, far, monkeypatch):
    monkeypatch.setattr(S, "PART_BYTES", 6 * 4 * 40)
    monkeypatch.setattr(S, "SENT_BYTES", 6 * 4 * 10)
    rows = [(i, [x + far for x in v]) for i, v in made(240, 1)]
    asked = [(i, [x + far for x in v]) for i, v in made(30, 2)] + [(99, rows[0][1])]
    df, q = (spark.createDataFrame(x, "id long, v array<double>") for x in (rows, asked))
    found = sorted((r["query"], r["row"], round(r["distance"], 6), r["rank"]) for r in S.nearest(df, "id", "v", q, "id", "v", 7, metric).collect())
    want = brute(rows, asked, 7, metric)
    assert [(f[0], f[3]) for f in found] == [(w[0], w[3]) for w in want]
    assert all(abs(f[2] - w[2]) < 2e-6 for f, w in zip(sorted(found, key=lambda x: (x[0], x[3])), sorted(want, key=lambda x: (x[0], x[3]))))
    assert [f[1] for f in found if f[0] == 99] == (list(range(7)) if far and metric == "cosine" else sorted([0, *range(80, 120)])[:7])


def test_vectors_that_are_no_row_of_a_matrix(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [float("nan"), 1.0]), (4, None), (5, [1.0, 1.0]), (6, [float("inf"), 1.0])], "id long, v array<double>")
    q = spark.createDataFrame([(7, [1.0, 0.1]), (8, None), (None, [1.0, 1.0]), (9, [float("nan"), 0.0])], "id long, v array<double>")
    found = {(r["query"], r["row"]): r["distance"] for r in S.nearest(df, "id", "v", q, "id", "v", 3, "l2").collect()}
    assert {r for a, r in found if a == 7} == {1, 2, 5} and {r for a, r in found if a == 9} == {1, 2, 3}
    assert found[7, 1] == 0.1


def test_a_part_gives_few_rows():
    """Before, each pair of a row and a query was a row of its own."""
    rnd = np.random.default_rng(3)
    v = rnd.normal(size=(20_000, 16))
    v[5_000:] = v[0]
    q = np.concatenate([rnd.normal(size=(19, 16)), v[:1]])
    given = 0
    for metric in ("cosine", "l2"):
        for at, near, distance in S.nearest_in(pa.array(np.arange(len(v))), v, q, 5, metric):
            given += len(at)
            assert len(at) == len(near) == len(distance)
            if 19 in at:
                assert [0, 5000, 5001, 5002, 5003] == sorted(near[(at == 19) & (distance < 1e-7)].tolist())
    assert 2 * 20 * 5 <= given <= 2 * 20 * 5 * 2
