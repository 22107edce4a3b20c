"""The pipeline, stage by stage, on the smallest tables, each against a brute-force version of its decisions."""

from __future__ import annotations

import re
from collections import defaultdict

import corpus_pipeline
import xxhash
from docloom.llm import toxicity as T
from docloom.llm.decontamination import edits_of, words_of
from docloom.llm.packing import CAPACITY
from docloom.llm.secrets import MASK

from test_decontamination import distance
from test_simhash import groups
from test_toxicity import plain_ftrl, plain_slots


def civil(docs, labels):
    """Ids of documents that plain FTRL, learnt from the labels of these documents that are not held out, does not reject."""
    import math
    import zlib

    texts = {d.doc_id: d.text for d in docs}
    y = {r.doc_id: float(r.toxic) for r in labels if r.doc_id in texts and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    weights = plain_ftrl([(texts[i], y[i]) for i in sorted(y, key=lambda i: xxhash.xxh64_intdigest(str(i)))], T.EPOCHS)
    score = lambda t: 1 / (1 + math.exp(-sum(weights.get(i, 0.0) for i in plain_slots(t))))
    return {i for i, t in texts.items() if score(t) < T.THRESHOLD}


def one_of_each(docs):
    docs = sorted(docs, key=lambda d: d.doc_id)
    sets = []
    for d in docs:
        w = (d.text or "").encode().lower().split()
        sets.append({b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    near = lambda i, j: docs[i].text == docs[j].text or (sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    lead = groups(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if near(i, j)])
    return {docs[k].doc_id for k in lead}


def clean(docs, items):
    asked = [words_of(i.text) for i in items]
    kept = set()
    for d in docs:
        words = words_of(d.text)
        have = set(words)
        if not any(item and sum(w in have for w in item) >= len(item) - edits_of(len(item)) and distance(item, words) <= edits_of(len(item)) for item in asked):
            kept.add(d.doc_id)
    return kept


def test_stages(spark, sf_dir, documents):
    labels, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet").collect() for t in ("labels", "benchmark"))
    docs, want = documents, {"toxicity": lambda d: civil(d, labels), "near_dedup": one_of_each, "decontamination": lambda d: clean(d, items)}
    for name, stage in corpus_pipeline.STAGES:
        before, out = docs.collect(), stage(spark, docs, sf_dir)
        rows = out.collect()
        if name == "packing":
            assert {r.doc_id for r in rows} == {d.doc_id for d in before}
            filled = defaultdict(list)
            for r in rows:
                filled[r.sequence_id].append((r.offset, r.length))
            for pieces in filled.values():
                ends = [0]
                for offset, length in sorted(pieces):
                    assert offset == ends[-1]
                    ends.append(offset + length)
                assert ends[-1] <= CAPACITY
            continue
        assert out.schema.simpleString() == documents.schema.simpleString()
        if name in want:
            assert {r.doc_id for r in rows} == want[name](before), name
        else:
            texts = {d.doc_id: d.text for d in before}
            assert len(rows) == len(before)
            for r in rows:
                assert not re.search('token = "[0-9a-f]{40}"', r.text or "") and r.n_chars == len(r.text or "")
                assert re.fullmatch(r"\S+".join(map(re.escape, (r.text or "").split(MASK))), texts[r.doc_id] or "")
        docs = spark.createDataFrame(rows, out.schema)
    assert docs.count() > 0.7 * documents.count()


def test_run_keeps_what_the_stages_keep(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_odd_rows(spark, sf_dir):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (None, "a text without id", "en", "s", 3), (3, "word " * 40_000, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame, least in ((docs, 3), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, sf_dir)
            if name == "near_dedup":
                assert {r.text for r in frame.select("text").collect()} >= ({"a text without id", rows[4][1]} if least else set())
        assert frame.count() >= least and (least or not frame.count())
