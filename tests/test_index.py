from __future__ import annotations

import random

import pytest

from docloom.operators import search as S
from docloom.operators import vectors as V
from docloom.operators.index import TextIndex, index_of


def made(n=300, seed=1):
    rnd = random.Random(seed)
    words = ["Alpha", "alphabet", "beta", "betabeta", "gamma-ray", "delta", "the", "other", "É té", "<b>beta</b>", "x"]
    return [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))), rnd.choice(["alpha beta", "", None, "the delta"])) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, body string, title string")


def rows(df):
    return [tuple(r) for r in df.collect()]


QUERIES = ["beta", "alpha the", "gamma-ray", "eta \"delta\"", "nothing beta"]
WEIGHTS = {"title": 4.0, "body": 1.0}


@pytest.mark.parametrize("text", QUERIES)
def test_same_as_a_scan(spark, tmp_path, text):
    df = frame(spark, made())
    index = TextIndex.build(df, "id", ["title", "body"], str(tmp_path / "i"), block_rows=20)
    assert rows(index.top(WEIGHTS, text, 7).rows) == rows(S.bm25(df, "id", WEIGHTS, text, 7))


def test_blocks_that_cannot_enter_are_not_scored(spark, tmp_path):
    df = frame(spark, [(i, "beta " * (40 if i in (11, 12, 13) else i % 5 == 0) + "word " * 20, None) for i in range(400)])
    index = TextIndex.build(df, "id", ["title", "body"], str(tmp_path / "i"), block_rows=10)
    found = index.top({"title": 1.0, "body": 1.0}, "beta", 3)
    assert found.blocks >= 30 and found.read < 10
    assert rows(found.rows) == rows(S.bm25(df, "id", {"title": 1.0, "body": 1.0}, "beta", 3))


def test_changes_equal_a_rebuild(spark, tmp_path):
    old, new = made(120), [(i, body + " beta", "alpha") for i, body, _ in made(60, 2)][40:] + [(i + 500, b, t) for i, b, t in made(30, 3)]
    index = TextIndex.build(frame(spark, old), "id", ["title", "body"], str(tmp_path / "i"), block_rows=25)
    index.add(frame(spark, new), "id", block_rows=25)
    index.remove(frame(spark, [(i, "", "") for i in (1, 2, 3, 505, 99999)]), "id")
    now = {r[0]: r for r in old} | {r[0]: r for r in new}
    live = frame(spark, [r for i, r in now.items() if i not in (1, 2, 3, 505)])
    for text in QUERIES:
        assert rows(index.top(WEIGHTS, text, 9).rows) == rows(S.bm25(live, "id", WEIGHTS, text, 9))
    index.merge(block_rows=25)
    assert len(index._segments()) == 1
    for text in QUERIES:
        assert rows(index.top(WEIGHTS, text, 9).rows) == rows(S.bm25(live, "id", WEIGHTS, text, 9))
    index.add(frame(spark, [(1, "beta beta beta", "beta")]), "id")
    assert rows(index.top(WEIGHTS, "beta", 1).rows)[0][0] == 1


def test_nothing_to_find(spark, tmp_path):
    index = TextIndex.build(frame(spark, []), "id", ["title", "body"], str(tmp_path / "i"))
    assert rows(index.top(WEIGHTS, "beta", 3).rows) == []
    index = TextIndex.build(frame(spark, [(None, "beta", "x"), (1, None, None), (2, "beta", None), (2, "beta", None)]), "id", ["title", "body"], str(tmp_path / "j"))
    assert [r[0] for r in rows(index.top(WEIGHTS, "beta", 3).rows)] == [2]


def test_an_index_of_unchanged_files_is_used_again(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    frame(spark, made(20)).write.parquet(path)
    first = index_of(spark.read.parquet(path), "id", ["body"])
    assert index_of(spark.read.parquet(path), "id", ["body"]).path == first.path
    frame(spark, made(21)).write.mode("append").parquet(path)
    assert index_of(spark.read.parquet(path), "id", ["body"]).path != first.path


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_recall_of_the_vector_index(spark, sf_dir, tmp_path, metric, monkeypatch):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    asked = vectors.where("vec_id % 10 = 0")
    index = V.VectorIndex.build(vectors, "vec_id", "embedding", str(tmp_path / "v"), metric)
    exact = S.nearest(vectors, "vec_id", "embedding", asked, "vec_id", "embedding", 10, metric)
    found = index.nearest(asked, "vec_id", "embedding", 10)
    assert V.recall(found, exact).first()["recall"] >= 0.9
    monkeypatch.setattr(V, "CELL_ROWS", 7)
    monkeypatch.setattr(V, "CELL_QUERIES", 3)
    assert sorted(rows(index.nearest(asked, "vec_id", "embedding", 10))) == sorted(rows(found))
    every = index.nearest(asked, "vec_id", "embedding", 10, probes=len(index.means), rerank=60)
    assert V.recall(every, exact).first()["recall"] == 1.0
    assert spark.read.parquet(f"{index.path}/codes").select("row").distinct().count() == vectors.count()


def test_odd_vectors(spark, tmp_path):
    odd = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (None, [1.0, 1.0]), (4, [1.0]), (5, [1.0, None]), (6, [0.9, 0.1])], "id long, v array<double>")
    index = V.VectorIndex.build(odd, "id", "v", str(tmp_path / "v"))
    found = rows(index.nearest(odd, "id", "v", 2))
    assert {(q, r) for q, r, _, _ in found if q == 2} == {(2, 2), (2, 6)} and {q for q, *_ in found} == {1, 2, 6}
    nothing = V.VectorIndex.build(odd.limit(0), "id", "v", str(tmp_path / "w"))
    assert nothing.nearest(odd, "id", "v", 2).count() == 0
