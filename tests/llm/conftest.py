from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as further columns.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, part long, start long, shard int, component long, n long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing columns."""
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
    long = " ".join(rnd.choice(words) for _ in range(30_000))
    rows = [
        (1, "", "en", "a", 0), (2, None, None, None, None), (None, "no id here at all", "en", "b", 3), (3, long, "en", "a", len(long)), (4, long, "de", "c", 1), (5, "one two three four five six", "en", "a", 5),
        (5, "one two three four five six", "en", "a", 5), (6, " \n\t ", "fr", "a", 4), (7, "ÄÖÜ ßñ\x0b é", "de", "a", 7), (7, "another text of the same id", "en", "a", 7), (None, None, None, None, None),
    ]
    rows = [(*r, 1, "k", 2, 3, 4, 5, 6) for r in rows]
    return spark.createDataFrame(rows, CLASHING)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
