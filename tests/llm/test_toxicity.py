from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docloom.llm import toxicity as T
from docloom.llm.toxicity import filtered, fit, held_out, rate


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = rate(docs, labels).join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "toxic").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in rows)
    own = [r for r in rows if r.held_out]
    toxic, fine = [r for r in own if r.toxic], [r for r in own if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic) and sum(r.predicted for r in fine) <= 0.02 * len(fine)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, 0), (5, 1, 1), (5, 1, 0), (7, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = rate(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows) and rate(no_docs, labels).count() == 0
    assert {r.score for r in rate(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1


def test_filter_keeps_columns_and_civil_rows(spark):
    docs = spark.createDataFrame([(i, f"fine words {i}" + (" vile slur" if i % 3 == 0 else ""), "en", "s", i) for i in range(240)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    kept = filtered(docs, fit(docs, labels.where(~held_out())))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in range(240) if i % 3}


def plain_slots(text):
    words = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (text or "").lower()).encode().split()
    hashes = [xxhash.xxh64_intdigest(w) for w in words]
    found = set(hashes) | {xxhash.xxh64_intdigest(w[:k], k) for w in words for k in T.PREFIXES}
    for skip, mix in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        found |= {((a * mix + b) * 0xFF51AFD7ED558CCD) % 2**64 for a, b in zip(hashes, hashes[skip:])}
    return {h >> 44 for h in found} | {T.N_WEIGHTS}


def plain_ftrl(rows, epochs):
    """FTRL-proximal coordinate by coordinate, in dictionaries."""
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= T.L1 else -(zi - math.copysign(T.L1, zi)) / ((T.BETA + math.sqrt(n.get(i, 0.0))) / T.ALPHA + T.L2)

    for _ in range(epochs):
        for text, y in rows:
            own = plain_slots(text)
            w = {i: weight(i) for i in own}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - y
            for i in own:
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / T.ALPHA * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_against_plain_ftrl(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    y = {r.doc_id: float(r.toxic) for r in labels.where(~held_out()).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    ids = sorted((i for i in y if i in texts), key=lambda i: xxhash.xxh64_intdigest(str(i)))
    want = plain_ftrl([(texts[i], y[i]) for i in ids], T.EPOCHS)
    got = fit(documents.union(documents), labels.where(~held_out()))  # rows given twice teach once
    assert want and set(np.flatnonzero(got).tolist()) == set(want)
    assert all(got[i] == pytest.approx(w) for i, w in want.items())
    for r in T.scored(documents, got).collect():
        total = sum(want.get(i, 0.0) for i in plain_slots(texts[r.doc_id]))
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)))
