from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from docloom.operators import rules as U
from docloom.operators import sketches as K
from docloom.operators import wording as W


def test_months_from_daily_sketches(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), f"2024-{m:02d}-{d:02d}", rnd.lognormvariate(1, 1), rnd.randint(0, 3000)) for m in (1, 2) for d in range(1, 29) for _ in range(300)] + [("a", "2024-01-01", None, None), ("c", "2024-01-01", None, 1)]
    runs = spark.createDataFrame(rows, "step string, at string, s double, who long")
    day, path = F.to_date("at"), str(tmp_path / "d")
    K.daily(runs.where("at < '2024-02-10'"), ["step"], day, "s", "who").write.parquet(path)
    stored = spark.read.parquet(path)
    fresh = K.missing_days(runs, stored, day)
    assert fresh.agg(F.min("at")).first()[0] == "2024-02-10"
    K.daily(fresh, ["step"], day, "s", "who").write.mode("append").parquet(path)
    got = {r.step: r for r in K.merged(spark.read.parquet(path), ["step"], [0.5, 0.9], F.col("day") >= "2024-02-01").collect()}
    for step in "ab":
        own = np.sort([s for st, at, s, _ in rows if st == step and at >= "2024-02" and s is not None])
        for name, rank in (("p50", 0.5), ("p90", 0.9)):
            assert abs(np.searchsorted(own, got[step][name]) / len(own) - rank) <= 1.5 * K.RANK_ERROR
        different = len({w for st, at, _, w in rows if st == step and at >= "2024-02"})
        assert got[step].n == len(own) and got[step].longest == own[-1] and abs(got[step].different / different - 1) < 0.06 and abs(got[step]["mean"] - own.mean()) < 1e-9
    whole = {r.step: r for r in K.merged(spark.read.parquet(path), ["step"], [0.5]).collect()}
    assert (whole["c"].n, whole["c"].p50, whole["c"].different) == (0, None, 1)


def made_chinese():
    rnd = random.Random(7)
    letters = [chr(0x4E00 + 7 * i) for i in range(260)]
    vocabulary = list(dict.fromkeys("".join(rnd.sample(letters, rnd.choice([2, 2, 3]))) for _ in range(120)))
    weights = [1 / (i + 3) for i in range(len(vocabulary))]
    texts = [[rnd.choices(vocabulary, weights)[0] for _ in range(rnd.randint(5, 14))] for _ in range(1500)]
    return vocabulary, texts


def test_words_of_a_known_vocabulary(spark):
    vocabulary, texts = made_chinese()
    df = spark.createDataFrame([(i, "".join(t) + "。abc") for i, t in enumerate(texts)] + [(-1, None)], "i long, t string")
    found = W.words(W.grams(df, "t"))
    got = {r.word for r in found.collect()}
    used = {w for w, n in Counter(w for t in texts for w in t).items() if n >= 5}
    assert len(got & used) / len(got) >= 0.9 and len(got & used) / len(used) >= 0.9
    split = {}
    for r in W.segmented(df, "i", "t", found).orderBy("row", "at").collect():
        split.setdefault(r.row, []).append(r.word)
    spans = lambda ws: {(sum(map(len, ws[:k])), sum(map(len, ws[: k + 1]))) for k in range(len(ws))}
    both = sum(len(spans(t) & spans(split[i])) for i, t in enumerate(texts))
    assert both / sum(map(len, texts)) >= 0.9 and both / sum(len(split[i]) for i in range(len(texts))) >= 0.9


def test_gram_counts(spark):
    texts = ["abcab", "ab", "", None, "xab a"]
    got = {r.gram: (r.n, round(r.left, 4), round(r.right, 4)) for r in W.grams(spark.createDataFrame([(t,) for t in texts], "t string"), "t", 2, "[a-z]+").collect()}
    entropy = lambda xs: round(-sum(c / len(xs) * np.log(c / len(xs)) for c in Counter(xs).values()) + 0.0, 4)
    want = {}
    for run in ("abcab", "ab", "xab", "a"):
        for size in (1, 2):
            for i in range(len(run) - size + 1):
                n, before, after = want.setdefault(run[i : i + size], [0, [], []])
                want[run[i : i + size]] = [n + 1, before + [run[i - 1] if i else ""], after + [run[i + size : i + size + 1]]]
    assert got == {g: (n, entropy(b), entropy(a)) for g, (n, b, a) in want.items()}
    assert W.best_path("abcd", {"ab": -1.0, "bcd": -1.5, "cd": -1.0, "abc": -1.0}, 3, -9.0) == ["ab", "cd"] and W.best_path("xyz", {}, 1, -9.0) == ["x", "y", "z"]


def test_rules(spark):
    rules = [
        ("1", "", "", "【保单表】中的“机构代码”，须在【机构表】中存在"), ("2", "保单表", "保额", "不得为空"), ("3", "保单表", "起期", "若保单有效，【保单表】中的“止期”须不早于【保单表】中“起期”"), ("4", "保单表", "保费", "应大于0。"),
        ("5", "保单表", "状态", "应为“有效”"), ("6", "机构表", "代码", "无说明"), ("7", "机构表", "代码", None), ("8", "", "", "【无表】中的“x”，须在【机构表】中存在"), ("9", "", "", "【保单表】中的“机构代码”须在【机构表】中"), ("10", "", "", "【机构表】中的“a”须在【机构表】中"),
    ]
    parsed = U.parsed(spark.createDataFrame(rules, "no string, table string, item string, rule string"))
    got = {r.no: tuple(r)[1:] for r in parsed.collect()}
    assert got["1"] == ("保单表", "机构代码", "in", None, "机构表", None, None) and got["2"] == ("保单表", "保额", "not_null", None, None, None, None)
    assert got["3"][:2] == ("保单表", "止期") and got["3"][4:] == ("保单表", "起期", "保单有效") and got["4"] == ("保单表", "保费", "gt", "0", None, None, None)
    assert got["5"] == ("保单表", "状态", "eq", "有效", None, None, None) and got["6"][2] is None and got["7"][2] is None
    items = spark.createDataFrame([("赔案表", "保单号", "赔案的保单。关联数据项：保单表-保单号、机构表－代码，无表-x；其他"), ("赔案表", "x", "无"), ("赔案表", "y", None)], "table string, item string, description string")
    tables = spark.createDataFrame([("T1", "保单表"), ("T2", "机构表"), ("T3", "赔案表"), ("T9", "机构表"), ("T0", "")], "table_no string, table_name string")
    edges = {tuple(r) for r in U.er_edges(parsed, U.related(items), tables).collect()}
    assert edges == {("T1", "T2", "机构代码", "", "rule", "1"), ("T3", "T1", "保单号", "保单号", "item", ""), ("T3", "T2", "保单号", "代码", "item", "")}
