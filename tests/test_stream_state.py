"""Streams with state and timers give what the static tables give, whatever order files come in, and after a restart."""

from __future__ import annotations

import random
import shutil

import pytest

from docloom.streaming import events as E
from docloom.streaming import state as S

KEY = "spark.sql.streaming.stateStore.providerClass"
SCHEMA = "event_id long, user_id long, ts timestamp, event_type string"


@pytest.fixture(autouse=True)
def own_state_store(spark):
    """The provider that knows timers, for these tests only."""
    S.with_timers(spark)
    yield
    spark.conf.unset(KEY)


def made(spark):
    import datetime as dt

    rnd, start = random.Random(3), dt.datetime(2024, 1, 1)
    rows = [(i, rnd.randint(1, 6), start + dt.timedelta(minutes=rnd.randint(0, 14 * 24 * 60), seconds=i % 60), rnd.choice(["view", "cart", "purchase"])) for i in range(400)]
    return spark.createDataFrame(rows, SCHEMA)


def batches(static, folder, shuffled):
    """Files whose events lie at most half a day apart from the order of time."""
    rows = sorted(static.collect(), key=lambda r: r.ts)
    parts = [rows[i : i + 40] for i in range(0, len(rows), 40)]
    if shuffled:
        for i in range(0, len(parts) - 1, 2):
            both = parts[i] + parts[i + 1]
            random.Random(i).shuffle(both)
            parts[i], parts[i + 1] = both[: len(both) // 2], both[len(both) // 2 :]
    for i, part in enumerate(parts):
        static.sparkSession.createDataFrame(part, static.schema).coalesce(1).write.parquet(f"{folder}/tmp{i}")
    return [f"{folder}/tmp{i}" for i in range(len(parts))]


def arrive(paths, folder):
    import glob
    import os

    os.makedirs(folder, exist_ok=True)
    for p in paths:
        for f in glob.glob(f"{p}/*.parquet"):
            shutil.copy(f, f"{folder}/{os.path.basename(p)}-{os.path.basename(f)}")


def run(stream, out, checkpoint):
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(200)
    if query.exception():
        raise query.exception()


@pytest.mark.parametrize("shuffled", [False, True])
def test_items_with_timers_and_a_restart(spark, tmp_path, shuffled):
    static = made(spark)
    paths = batches(static, str(tmp_path), shuffled)
    inbox, out, at = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for part in (paths[:5], paths[5:]):  # the second stream goes on from the first one's checkpoint
        arrive(part, inbox)
        run(S.work_items(E.source(spark, inbox, SCHEMA, files=2), expire="12 hours", delay="4 days"), out, at)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    want = sorted(map(tuple, S.work_items(static, expire="12 hours", delay="4 days").collect()))
    assert got == want and {r[-1] for r in want} == {"closed", "expired"} and len(want) > 50


def test_failures_meet_their_steps(spark, tmp_path):
    static = made(spark)
    paths = batches(static, str(tmp_path), True)
    inbox = str(tmp_path / "in")
    arrive(paths, inbox)
    pick = lambda df, kind: df.where(df.event_type == kind).select("event_id", "user_id", "ts")
    want = S.attributed(pick(static, "purchase"), pick(static, "view"), "user_id", "ts", "ts", "6 hours", "4 days")
    stream = lambda: E.source(spark, inbox, SCHEMA, files=3)
    run(S.attributed(pick(stream(), "purchase"), pick(stream(), "view"), "user_id", "ts", "ts", "6 hours", "4 days"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    key = lambda df: sorted((r.f_event_id, r.s_event_id) for r in df.collect())
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(want) and len(key(want)) > 20
