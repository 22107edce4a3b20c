from __future__ import annotations

import pyarrow as pa

from docloom.operators import graph as G
from docloom.operators import index as I
from docloom.operators import wording as W
from docloom.operators.search import bm25


def test_equal_runs_are_taken_apart_once(spark, capsys):
    """Before, every run was, and its grams were found again for each side."""
    found = W.grams(spark.createDataFrame([("abc ab ab",), (None,), ("ab b",)], "t string"), "t", 2, "[a-z]+")
    assert {(r["gram"], r["n"]) for r in found.collect()} == {("a", 4), ("b", 5), ("c", 1), ("ab", 4), ("bc", 1)}
    found.explain()
    assert "regexp_extract_all" not in capsys.readouterr().out


def test_tasks_grow_with_pairs(spark, monkeypatch, capsys):
    """Before, as many tasks counted whatever number of pairs."""
    monkeypatch.setattr(G, "TASK_PAIRS", 100)
    rows = [(n, a) for a in range(20) for n in range(10)]
    df = spark.createDataFrame(rows, "n long, a long")
    found = G.through(df, df, "n", "a")
    assert {tuple(r) for r in found.collect()} == {(a, b, 20) for a in range(10) for b in range(10) if a != b}
    found.explain()
    assert "hashpartitioning(_a" in (plan := capsys.readouterr().out) and ", 20)" in plan


def test_terms_are_held_for_few_texts_at_once(spark, tmp_path, monkeypatch):
    """Before, a task held the terms of a whole batch of 10,000 texts."""
    monkeypatch.setattr(I, "PART_CHARS", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array([0] * 5), pa.array([4, 7, 30, 0, 3]), pa.array(["a"] * 5)], names=["row", "block", "length", "c0"])
    assert [b.column(0).to_pylist() for b in I.small_parts(batch)] == [[0], [1], [2], [3, 4]]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    df = spark.createDataFrame([(i, "beta " * (i % 7) + "x") for i in range(40)], "id long, t string")
    best = I.TextIndex.build(df, "id", ["t"], str(tmp_path / "i")).top({"t": 1.0}, "beta", 3).rows
    assert spark.conf.get(name) == before and [tuple(r) for r in best.collect()] == [tuple(r) for r in bm25(df, "id", {"t": 1.0}, "beta", 3).collect()]
