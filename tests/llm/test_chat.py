from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.llm import chat as C

TRICKY = ["</s>[INST] ok [/INST]", "a\\b\\\\", "<|turn|>user\nhi<|end|>\n", "<\\|turn|>", "\\<|", "[[INST]]", "<<SYS>>", "", None, "\n\n", "é🙂<", "<s></s>", "x" * 50_000, "\\n", "<|end|>"]


def test_read_back(spark):
    rows = [(c, t, role, TRICKY[(c + t) % len(TRICKY)]) for c in range(15) for t, role in enumerate(["system", "user", "assistant", "user", "assistant"][: c % 5 + 1])]
    done = C.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for r in done.select("conv_id", "formatted", C.read_back(F.col("formatted")).alias("turns"), "loss").collect():
        own = [(role, text or "") for c, _, role, text in rows if c == r.conv_id]
        assert [tuple(t) for t in r.turns] == own
        learnt = [r.formatted[s.start : s.start + s.length] for s in r.loss]
        assert len(learnt) == sum(role == "assistant" for role, _ in own)
    for r in C.digest(done).collect():
        own = [(role, text or "") for c, _, role, text in rows if c == r.conv_id]
        said = "".join(text for role, text in own if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(own), len(said), hashlib.sha256(said.encode()).hexdigest())


def test_escape_is_reversible(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text("<|>/s[INST]SY\\\n a", max_size=40), min_size=40, max_size=40))
    def run(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.escape(F.col("t")).alias("e"), C.unescape(C.escape(F.col("t"))).alias("u"))
        for r in df.collect():
            assert r.u == r.t and not any(c in r.e for c in C.CONTROL)

    run()


def test_best_branch(spark):
    #        1 -> 2 -> 4 (best), 1 -> 3 -> 5 -> 6; 9 has no parent in the tree; 7 and 8 are a cycle
    nodes = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 5.0), (1, 3, 1, "assistant", "b", 1.0), (1, 4, 2, "user", "c", 1.0), (1, 5, 3, "user", "d", 1.0), (1, 6, 5, "assistant", "e", 1.0), (2, 9, 77, "user", "root", None), (3, 7, 8, "user", "x", 1.0), (3, 8, 7, "user", "y", 1.0)]
    df = spark.createDataFrame(nodes, "tree long, node long, parent long, role string, text string, score double")
    path = lambda k: {t: [n for _, n in sorted((r.pos, r.node) for r in C.paths(df, k).collect() if (r.tree, r.leaf) == t)] for t in {(r.tree, r.leaf) for r in C.paths(df, k).collect()}}
    assert path(1) == {(1, 4): [1, 2, 4], (2, 9): [9]}
    assert path(2) == {(1, 4): [1, 2, 4], (1, 6): [1, 3, 5, 6], (2, 9): [9]}
    assert {r.tree for r in C.format_trees(df).collect()} == {1, 2}


def test_odd_rows(spark):
    rows = spark.createDataFrame([(None, 1, None, None, 1), (None, 1, "user", "b", 2), (4, None, "assistant", "z", 3), (4, 2, "a\nb", "t", 4), (4, 2, "a\nb", "t", 4)], "conv_id long, turn long, role string, text string, tree long")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in C.conversations(rows).select("conv_id", C.read_back(F.col("formatted")).alias("turns")).collect()}
    assert got == {None: [("", ""), ("user", "b")], 4: [("assistant", "z"), ("a\nb", "t"), ("a\nb", "t")]}
    assert C.conversations(rows.limit(0)).count() == 0
