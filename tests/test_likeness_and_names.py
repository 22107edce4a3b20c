from __future__ import annotations

import random
import re
from collections import Counter
from difflib import SequenceMatcher

import pytest

from docloom.operators import likeness as L
from docloom.operators import names as N


def made(seed, n=120, letters="abcde", sizes=(1, 30)):
    rnd = random.Random(seed)
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randint(*sizes))) for _ in range(n // 2)]
    for _ in range(n // 2):
        t = list(rnd.choice(out))
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randint(0, len(t))
            t[at : at + rnd.randint(0, 2)] = [rnd.choice(letters)] * rnd.randint(0, 2)
        out.append("".join(t))
    return [t for t in out if t]


@pytest.mark.parametrize("least,sizes,letters", [(0.82, (1, 30), "abcde"), (0.85, (1, 12), "abc"), (0.6, (1, 14), "abcdefg"), (0.82, (5, 60), "保险监管办法通知意见人民银行")])
def test_like_texts_against_all_pairs(spark, least, sizes, letters):
    a, b = made(1, letters=letters, sizes=sizes), made(2, letters=letters, sizes=sizes) + made(1, letters=letters, sizes=sizes)[::3]
    left, right = spark.createDataFrame([(x,) for x in [*a, None, ""]], "x string"), spark.createDataFrame([(x,) for x in b], "y string")
    want = {(x, y) for x in a for y in b if x != y and SequenceMatcher(None, x, y).ratio() >= least}
    got = [(r.a, r.b) for r in L.like_texts(left, right, "x", "y", least).collect()]
    assert set(got) == want and len(got) == len(want) and want


def test_titles(spark):
    rows = [(i, t, i % 2) for i, t in enumerate(made(3, 80, "abcd", (4, 16)))] + [(900, "保险营销行为管理办法", 0), (902, "保险营销行为管理办法的通知", 0), (904, "保险营销行为管理方法", 0), (906, None, 0), (908, "", 0), (910, "abcdab", 0), (912, "xxabcdabyyyyyyyyyyyyyyyyyyyyyyyyyyyyy", 0)]

    def like(a, b):
        short, long_ = sorted((a, b), key=len)
        return a == b or (len(short) >= 6 and short in long_) or SequenceMatcher(None, a, b).ratio() >= 0.82

    want = {(i, j) for i, a, g in rows for j, b, h in rows if i < j and g == h and a and b and like(a, b)}
    found = [tuple(r) for r in L.same_titles(spark.createDataFrame(rows, "id long, title string, g int"), "id", "title", within=["g"]).collect()]
    assert set(found) == want and len(found) == len(want) and {(900, 902), (900, 904), (910, 912)} <= want


def test_long_words_meet_by_what_is_left_of_them(spark, monkeypatch):
    """Words of up to twenty letters are compared only with such as have enough letters in one order in common."""

    def in_common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    words, entries = made(6, 160, "abcdefgh", (9, 20)), made(6, 160, "abcdefgh", (9, 20))[::2] + made(7, 120, "abcdefgh", (9, 20))
    words, entries = ([w for w in dict.fromkeys(x) if len(w) <= 20] for x in (words, entries))
    frames = [spark.createDataFrame([(w,) for w in x], "w string") for x in (words, entries)]
    compared, verify = [], L.verified
    monkeypatch.setattr(L, "verified", lambda pairs, least: compared.extend(tuple(r) for r in pairs.collect()) or verify(pairs, least))
    got = {(r.a, r.b): r.ratio for r in L.by_deletions(*frames, "w", "w", 0.85).collect()}
    want = {(a, b): SequenceMatcher(None, a, b).ratio() for a in words for b in entries if a != b}
    assert got == {k: v for k, v in want.items() if v >= 0.85} and any(len(a) > 15 for a, _ in got)
    assert len(compared) == len(set(compared)) and all(2 * in_common(a, b) >= 0.85 * (len(a) + len(b)) - 1e-9 for a, b in compared)


def test_keys_of_remainders():
    for words in (["abca", "abab", "险保险监"], ["a"], ["abcdefghij", "jihgfedcba"]):
        for spare in (1, 2):
            number, key, left = L.remainder_keys(words, spare)
            rests = [L.remains(w, spare) for w in words]
            held = [{(int(k), int(n)) for i, k, n in zip(number, key, left) if i == at} for at in range(len(words))]
            assert [sorted(n for _, n in h) for h in held] == [sorted(map(len, r)) for r in rests]
            for i, x in enumerate(rests):
                for j, y in enumerate(rests):
                    assert len(held[i] & held[j]) == len(x & y)


@pytest.mark.parametrize("letters,size", [("abc", 9), ("abcd", 19)])
def test_dictionary(spark, letters, size):
    entries = [(w, i) for i, w in enumerate(dict.fromkeys(made(4, 100, letters, (2, size))))]
    words = made(5, 100, letters, (1, size)) + [w[:4] + w[5:] for w in made(4, 100, letters, (2, size))] + ["保险监督管理委员会"]
    entries.append(("保险监督管理委员令", 500))
    known = dict(entries)
    want = {}
    for w in set(words) - set(known):
        best = max(((SequenceMatcher(None, w, e).ratio(), -r, e) for e, r in entries if len(w) > 1), default=(0, 0, ""))
        if 0.85 <= best[0] < 1:
            want[w] = best[2]
    got = L.nearest_words(spark.createDataFrame([(w,) for w in words], "w string"), "w", spark.createDataFrame(entries, "e string, r int"), "e", "r").collect()
    assert {r.word: r.right for r in got} == want and want["保险监督管理委员会"] == "保险监督管理委员令"


def test_spare_letters():
    for least in (0.7, 0.85, 0.9):
        for n in range(1, 20):
            want = max(n - m for k in range(1, 60) for m in range(1, min(n, k) + 1) if 2 * m / (n + k) >= least - 1e-9)
            assert L.spare_letters(n, least) == want
    assert L.remains("abca", 1) == {"abca", "bca", "aca", "aba", "abc"}


@pytest.mark.parametrize("part", [10**6, 3])
def test_names_in_texts(spark, monkeypatch, part):
    monkeypatch.setattr(N, "PART", part)
    rnd = random.Random(6)
    names = ["保险法", "中华人民共和国保险法", "保险", "ab", "abc", "bcd", "cdab", "a b", "法"]
    texts = [(i, "".join(rnd.choice([*names, "x", "国", "d", "共和"]) for _ in range(rnd.randint(0, 12)))) for i in range(80)] + [(100, None), (101, "")]
    every = sorted((i, n, s) for i, t in texts if t for n in names for s in range(len(t)) if t.startswith(n, s))
    best = []
    for i, t in texts:
        s = 0
        while t and s < len(t):
            hit = max((n for n in names if t.startswith(n, s)), key=len, default=None)
            if hit:
                best.append((i, hit, s))
            s += len(hit or "x")
    df, known = spark.createDataFrame(texts, "i long, t string").repartition(3), spark.createDataFrame([(n,) for n in [*names, names[0], "", None]], "n string")
    assert sorted(map(tuple, N.names_in(df, "i", "t", known, "n", longest=False).collect())) == every
    assert sorted(map(tuple, N.names_in(df, "i", "t", known, "n").collect())) == sorted(best)


TITLES = [(1, "中华人民共和国保险法"), (2, "保险公司管理规定"), (3, "保险公司管理规定实施细则"), (4, "关于印发《健康保险管理办法》的通知"), (5, "健康保险管理办法（修订）"), (6, "保险公司管理规定")]


def test_resolution_of_cited_names(spark):
    titles, aliases = spark.createDataFrame(TITLES, "id long, title string"), spark.createDataFrame([("保险法", "中华人民共和国保险法"), ("消保法", "无此法")], "alias string, full string")
    names = ["保险法", "《保险公司管理规定》", "健康保险管理办法", "公司管理规定实施", "公司管理规定", "保险公司管理规", "消保法", "中华人民共和国保险法（修订）", "", "险公司管理规定实施细"]
    got = {r.name: (r.row, r.method) for r in N.resolved_names(spark.createDataFrame([(n,) for n in names], "n string"), "n", titles, "id", "title", aliases).collect()}
    assert got == {"保险法": (1, "alias"), "《保险公司管理规定》": (2, "exact"), "健康保险管理办法": (5, "exact"), "公司管理规定实施": (3, "inside"), "中华人民共和国保险法（修订）": (1, "exact"), "险公司管理规定实施细": (3, "inside")}


def test_clause_graph(spark):
    docs = [(1, "中华人民共和国保险法", "第一条 总则"), (2, "保险公司管理规定", "根据《保险法》第一百三十三条第二款第三项和第5条，以及《保险法》制定。参见《保险公司管理规定》。"), (3, "保险公司管理规定实施细则", "按《保险公司管理规定》中的第二条、第三条第一款执行，《某某办法》第一条除外"), (4, None, None)]
    clauses = spark.createDataFrame([(1, 5), (1, 1), (2, 2)], "doc long, number int")
    aliases = spark.createDataFrame([("保险法", "中华人民共和国保险法")], "alias string, full string")
    got = Counter(tuple(r) for r in N.clause_graph(spark.createDataFrame(docs, "id long, title string, body string"), "id", "title", "body", clauses, aliases).collect())
    assert got == Counter([
        (2, 1, "article", 133, 2, 3, 1, "out_of_range"), (2, 1, "article", 5, None, None, 1, "verified"), (2, 1, "title", None, None, None, 2, None),
        (3, 2, "article", 2, None, None, 1, "verified"), (3, 2, "article", 3, 1, None, 1, "out_of_range"), (3, 2, "title", None, None, None, 1, None),
    ])


def test_words_meet_without_the_driver(spark, monkeypatch):
    """Neither the dictionary nor anything that grows with it is collected or sent from the driver."""

    def refused(*_, **__):
        raise AssertionError("passes the driver")

    entries, words = made(8, 60, "abcdef", (3, 14)), made(8, 120, "abcdef", (3, 14))
    frames = spark.createDataFrame([(w,) for w in words], "w string"), spark.createDataFrame([(w, -i) for i, w in enumerate(dict.fromkeys(entries))], "e string, r int")
    cuts, cut = [], L.cut
    with monkeypatch.context() as m:
        m.setattr(L, "cut", lambda df: cuts.append(df) or cut(df))
        for name in ("toArrow", "toPandas", "collect"):
            m.setattr(type(frames[0]), name, refused)
        m.setattr(type(spark.sparkContext), "broadcast", refused)
        found = L.nearest_words(frames[0], "w", frames[1], "e", "r")
    assert len(cuts) == 2 and not any("BroadcastExchange" in df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0] for df in cuts)
    best = {w: max((SequenceMatcher(None, w, e).ratio(), i, e) for i, e in enumerate(dict.fromkeys(entries))) for w in set(words) - set(entries)}
    assert {r.word: r.right for r in found.collect()} == {w: e for w, (x, _, e) in best.items() if x >= 0.85} != {}


def test_tokens_are_not_broadcast(spark):
    texts = spark.createDataFrame([(w,) for w in made(11, 40)], "x string")
    found = L.like_texts(texts, texts.withColumnRenamed("x", "y"), "x", "y", 0.85)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert re.search(r"SortMergeJoin.* \[_t#\d+\]", plan) and not re.search(r"BroadcastHashJoin.* \[_t#\d+\]", plan)


def test_matching_letters_and_compared_pairs(monkeypatch):
    a, b = made(9, 160, "abcd", (6, 20)), made(10, 160, "abcd", (6, 20)) + made(9, 160, "abcd", (6, 20))[::2]
    by_size = [{n: [w for w in dict.fromkeys(x) if len(w) == n] for n in range(6, 21)} for x in (a, b)]
    codes = [{n: L.coded(w) for n, w in x.items() if w} for x in by_size]
    compared, matching, found = Counter(), L.matching_letters, {}
    monkeypatch.setattr(L, "matching_letters", lambda x, y: compared.update([(x.shape[1], y.shape[1])] * len(x)) or matching(x, y))
    monkeypatch.setattr(L, "PAIRS", 2000)
    for left in range(4, 21):
        for first in map(ord, "abcd"):
            for la, i, lb, j, ratios in L.met_words(*codes, left, first, 0.85):
                found |= {(by_size[0][la][x], by_size[1][lb][y]): r for x, y, r in zip(i, j, ratios)}
    want = {(x, y): SequenceMatcher(None, x, y).ratio() for x in set(a) for y in set(b) if x != y and 5 < len(x) < 21 and 5 < len(y) < 21}
    assert found == {k: v for k, v in want.items() if v >= 0.85} and len(found) > 9
    assert sum(compared.values()) < len(want) / 20
    for (n, x), (m, y) in zip(codes[0].items(), list(codes[1].items())[::-1]):
        k = min(len(x), len(y))
        assert matching(x[:k], y[:k]).tolist() == [round(SequenceMatcher(None, p, q).ratio() * (n + m) / 2) for p, q in zip(by_size[0][n][:k], by_size[1][m][:k])]


def test_dictionary_check_asks_all_words(spark):
    """Words of a single document, short ones and such with accents are asked, and are in the dictionary."""
    from docloom.plans import likeness as P

    common, rare = "Información, más Straße that; informal.", ["informacion que informatión", "thaat straßen inforMacion a", "Straße thatx Mass masx", "thaat e\u0301té informatiön ab"]
    texts = [*[common] * 20, *rare, None, ""]
    counts = Counter(w for t in texts if t for w in set(re.findall("[^\\W\\d_]+(?:\u0301[^\\W\\d_]*)*", t.lower())))
    entries = sorted((w for w, n in counts.items() if n >= 20), key=lambda w: (-counts[w], w))
    want = {}
    for w in counts.keys() - set(entries):
        ratio, at = max(((SequenceMatcher(None, w, e).ratio(), -i) for i, e in enumerate(entries)), default=(0, 0))
        if ratio >= 0.85 and len(w) > 1:
            want[w] = entries[-at]
    got = P.dictionary_check(lambda name: {"documents": spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")}[name])
    assert {r.word: r.right for r in got.collect()} == want and {("informacion", "información"), ("thaat", "that"), ("thatx", "that"), ("straßen", "straße")} <= want.items()
