"""Streams give what the static tables give."""

from __future__ import annotations

import shutil

from docloom.streaming import events as E


def run(stream, name, mode):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return stream.sparkSession.table(name)


def arriving(spark, sf_dir, tmp_path):
    static = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = str(tmp_path / "events")
    static.orderBy("ts").repartitionByRange(3, "ts").write.parquet(folder)
    for junk in tmp_path.glob("events/_*"):
        shutil.rmtree(junk) if junk.is_dir() else junk.unlink()
    return static, E.source(spark, folder, static.schema.simpleString()[7:-1].replace(":", " "), files=3)


def test_tumbling(spark, sf_dir, tmp_path):
    static, stream = arriving(spark, sf_dir, tmp_path)
    got = {(r.day, r.event_type): r.n for r in run(E.tumbling(stream), "tumbling", "complete").collect()}
    assert got == {(r.day, r.event_type): r.n for r in E.tumbling(static).collect()}


def test_once(spark, sf_dir, tmp_path):
    static, stream = arriving(spark, sf_dir, tmp_path)
    assert run(E.once(stream), "once", "append").count() == static.count()


def test_open_items(spark, sf_dir, tmp_path):
    static, stream = arriving(spark, sf_dir, tmp_path)
    last = {}
    for r in run(E.open_items(stream), "items", "update").collect():
        last[r.user_id] = r.state
    assert set(last) == {r.user_id for r in static.select("user_id").distinct().collect()} and set(last.values()) <= {"open", "closed"}
