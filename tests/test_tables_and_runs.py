from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from docloom.operators import incremental as I
from docloom.operators import tables as T


def test_sheet(spark):
    rows = [("s", 0, ["地区", "", "金额"]), ("s", 1, ["省", "市"]), ("s", 2, ["甲", "子", "10"]), ("s", 3, ["", "丑", "1,200.5"]), ("s", 4, ["合计", "", "30%"])]
    found = T.cells(spark.createDataFrame(rows, "sheet string, row int, cells array<string>"))
    assert found.count() == 15
    assert {r.col: r.header for r in T.fill_headers(found, 2).collect()} == {0: "地区/省", 1: "地区/市", 2: "金额/市"}
    body = T.fill_down(found.where("row >= 2"), [0])
    assert [r.value for r in body.where("col = 0").orderBy("row").collect()] == ["甲", "甲", "合计"]
    assert [r.col for r in T.dimensions(body).orderBy("col").collect()] == [0, 1]
    assert [r.t for r in body.where("col = 0").orderBy("row").select(T.is_total(F.col("value")).alias("t")).collect()] == [False, False, True]


def test_new_items_and_stop(spark):
    items = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("b", 2, 3), ("c", 3, 4), ("a", 4, 5)], "k string, page int, n int")
    known = spark.createDataFrame([("a",), ("c",)], "k string")
    out = I.classify(items, known, "k", ["n"])
    assert [r.state for r in out.orderBy("n").collect()] == ["known", "new", "dup_in_run", "known", "known"]
    assert [r.page for r in I.stop_page(out, "page", 3).collect()] == [4]
    assert I.stop_page(out, "page", 4).count() == 0


def test_dead_letters(spark):
    at = lambda m: datetime(2024, 1, 1, 0, m)
    log = spark.createDataFrame([("a", at(0), "bad"), ("a", at(1), "ok"), ("a", at(2), "bad"), ("a", at(3), "bad"), ("b", at(0), "bad"), ("b", at(5), "ok")], "k string, t timestamp, s string")
    assert [tuple(r) for r in I.dead_letters(log, "k", "t", F.col("s") == "ok").collect()] == [("a", 2, at(5), False)]


def test_plans(spark):
    steps = spark.createDataFrame([("x",), ("y",), ("z",)], "step string")
    runs = spark.createDataFrame([("x", 0, 2), ("x", 1, 1), ("y", 0, 1), ("z", 1, 1)], "step string, rc int, finished_at int")
    stale = spark.createDataFrame([("y",)], "step string")
    assert {tuple(r) for r in I.resume_plan(steps, runs, stale).collect()} == {("x", "skip"), ("y", "run"), ("z", "run")}
    files = spark.createDataFrame([("a", "g", "2024-01-01"), ("b", "g", "2024-03-01"), ("c", "g", "2024-03-02")], "path string, g string, at string")
    assert {r.path: r.action for r in I.retention(files, "g", "at", 1, "2024-03-10", 30).collect()} == {"a": "remove", "b": "keep", "c": "keep"}
    registry = spark.createDataFrame([("k1", "valid"), ("k2", "void")], "key string, status string")
    drafts = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "key string")
    assert {r.key: r.verdict for r in I.citations(drafts, registry, "key", "status", ["void"]).collect()} == {"k1": "valid", "k2": "withdrawn", "k3": "unknown"}
