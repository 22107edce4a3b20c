from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from docloom.operators import clauses as C
from docloom.sources.versions import Conflict, Versions


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, text string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_readers_keep_their_version(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"))
    one = [(i, f"text {i}") for i in range(50)]
    assert table.commit(frame(spark, [*one, (None, "no key")]), "id", buckets=8) == 1
    first = table.read()
    assert table.update(frame(spark, [(3, "new"), (99, "more")]), frame(spark, [(4, "")])) == 2
    assert rows(first) == rows(table.read(1)) == one
    assert rows(table.read()) == sorted({**dict(one), 3: "new", 99: "more"}.items() - {(4, "text 4")})
    assert table.history() == [1, 2] and table.broken() == table.broken(1) == []


def test_an_update_rewrites_only_what_it_touches(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"))
    table.commit(frame(spark, [(i, "x") for i in range(200)]), "id", buckets=16)
    table.update(frame(spark, [(7, "y")]))
    old, new = ({f["path"] for f in table.manifest(v)["files"]} for v in (1, 2))
    assert len(old - new) == len(new - old) == 1 and len(old & new) == len(old) - 1


def test_the_second_writer_fails_and_nothing_of_it_shows(spark, tmp_path):
    table, other = Versions(spark, str(tmp_path / "t")), Versions(spark, str(tmp_path / "t"))
    table.commit(frame(spark, [(1, "a")]), "id")
    base = other.history()[-1]
    table.update(frame(spark, [(2, "b")]))
    with pytest.raises(Conflict):
        other.update(frame(spark, [(3, "c")]), base=base)
    assert rows(other.read()) == [(1, "a"), (2, "b")]
    other.update(frame(spark, [(3, "c")]))
    assert rows(table.read()) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_writer_lost_half_way_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    table = Versions(spark, str(tmp_path / "t"))
    table.commit(frame(spark, [(1, "a")]), "id")
    monkeypatch.setattr(Versions, "_publish", lambda self, told, files: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.update(frame(spark, [(1, "b")]))
    assert rows(table.read()) == [(1, "a")] and table.history() == [1]


def test_broken_files_and_lost_rows_are_told(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"))
    table.commit(frame(spark, [(i, "a") for i in range(30)]), "id", buckets=4)
    assert rows(table.lost(frame(spark, [(1, "a"), (2, "b"), (50, None)]), ["id", "text"])) == [(2, "b"), (50, None)] or rows(table.lost(frame(spark, [(1, "a"), (2, "b")]), ["id", "text"])) == [(2, "b")]
    os.remove(glob.glob(f"{tmp_path}/t/data/*/_bucket=0/*.parquet")[0])
    assert [f["bucket"] for f in table.manifest()["files"] if f["path"] in table.broken()] == [0]


def test_a_derived_table_is_brought_up_to_date(spark, tmp_path):
    """Clauses of texts: the incremental result equals the full one, and unchanged texts are not parsed again."""
    parsed = []

    def build(docs):
        parsed.append(docs.count())
        return C.articles(docs, "id", "text").withColumnRenamed("doc", "id")

    source = lambda texts: frame(spark, texts).withColumn("sha", F.sha2("text", 256))
    body = lambda i, n: "\n".join(f"第{k}条 文本{i}" for k in range(1, n + 1))
    texts = {i: body(i, i % 4 + 1) for i in range(30)}
    index = Versions(spark, str(tmp_path / "i"))
    index.rebuild(source(list(texts.items())), "id", "sha", build)
    texts |= {3: body(3, 7), 40: body(40, 2), 5: "没有条文"}
    del texts[8]
    index.rebuild(source(list(texts.items())), "id", "sha", build)
    full = Versions(spark, str(tmp_path / "f"))
    full.rebuild(source(list(texts.items())), "id", "sha", build)
    assert rows(index.read()) == rows(full.read()) and parsed[1] == 3


def test_a_base_is_published_whole(spark, tmp_path):
    from docloom.sources.publish import Base

    base = Base(spark, str(tmp_path / "b"))
    records = spark.createDataFrame([(1, "a", "r1"), (2, "b", "r2")], "id long, title string, raw_path string")
    clauses = spark.createDataFrame([("1:1", 1), ("2:1", 2), ("9:1", 9)], "clause string, id long")
    assert base.publish({"records": (records, "id"), "clauses": (clauses, "clause")}, "first") == 1
    assert base.read("records").columns == ["id", "title"] and rows(base.dangling("clauses", "id", "records")) == [("9:1", 9)]
    more = records.where("id = 1").union(spark.createDataFrame([(3, "c", "r3")], records.schema))
    assert base.publish({"records": (more, "id"), "clauses": (clauses, "clause")}, "second") == 2
    first, second = base.history()
    assert first["tables"]["clauses"] == second["tables"]["clauses"] and second["tables"]["records"] == {"version": 2, "rows": 2, "key": "id"}
    assert rows(base.read("records", 1)) == [(1, "a"), (2, "b")] and rows(base.read("records")) == [(1, "a"), (3, "c")]
    assert rows(base.not_projected("records", records)) == [(2, "b", "r2")] and base.not_projected("records", more).count() == 0
