from __future__ import annotations

import random

from pyspark.sql import functions as F

from docloom.functions import keys as K
from docloom.functions import text as T
from docloom.operators import registry as R


def normal(spark, values, build):
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", build(F.coalesce("v", F.lit(""))).alias("n")).collect()
    return {r.v: r.n for r in got}


def made(rnd, n, refs):
    titles = ["保险公司管理办法", "保险公司管理办法实施细则", "公司管理", "健康险通知", "健康险通知的补充", "甲", "", None]
    numbers = ["保监发〔2014〕19号", "保监发〔2015〕7号", "", None, "银发〔2020〕100号"]
    return [(refs + str(i) if refs else i, rnd.choice(["T1", "T2", ""]), rnd.choice(titles), rnd.choice(numbers), rnd.choice(["2020-01-01", "2021-02-02", ""])) for i in range(n)]


def test_registered_against_brute_force(spark):
    rnd = random.Random(1)
    asked, register = made(rnd, 40, ""), made(rnd, 25, "R")
    titles, numbers = {r[2] for r in asked + register}, {r[3] for r in asked + register}
    nt, nd = normal(spark, titles, K.title_strict), normal(spark, numbers, K.docno)
    want = {}
    for row, theme, title, number, date in asked:
        t, d, best = nt[title], nd[number], []
        for ref, theme2, title2, number2, date2 in register:
            t2, d2 = nt[title2], nd[number2]
            if len(d) >= 5 and d == d2:
                best.append((1, 0 if theme and theme == theme2 else 1, ref))
            if theme and t and theme == theme2 and t == t2:
                best.append((2, 0, ref))
            if t and (t == t2 or min(len(t), len(t2)) >= 2 and (t in t2 or t2 in t)) and ((d and d == d2) or (not d and not d2 and date and date == date2)):
                best.append((3, 0, ref))
        if best:
            level, _, ref = min(best)
            want[row] = (ref, level)
    schema = "{} {}, theme string, title string, number string, published string"
    got = {r.row: (r.ref, r.level) for r in R.registered(spark.createDataFrame(asked, schema.format("row", "long")), spark.createDataFrame(register, schema.format("ref", "string"))).collect()}
    assert got == want and {level for _, level in want.values()} == {1, 2, 3}


def test_theme_texts(spark):
    library = [("a", "a1", "健康保险管理办法", "", 50), ("a", "a2", "健康保险管理办法", "", 90), ("b", "b1", "关于印发健康保险管理办法的通知", "保监发〔2014〕19号", 200), ("b", "b2", "另一份文件", "保监发〔2015〕7号", 70), ("c", "c1", "短名", "", 999)]
    asked = [(1, "健康保险管理办法", ""), (2, "健康保险管理办法", "银发〔2020〕100号"), (3, "无此文件", "保监发〔2015〕7号"), (4, "短", ""), (5, None, None)]
    got = {r.row: (r.lib, r.item, r.tier) for r in R.theme_texts(spark.createDataFrame(asked, "row long, title string, number string"), spark.createDataFrame(library, "lib string, item string, title string, number string, body_len long")).collect()}
    assert got == {1: ("b", "b1", 3), 2: ("a", "a2", 1), 3: ("b", "b2", 2)}


def test_drift(spark):
    state = [("甲办法", "保监发〔2014〕19号", "失效", "2024-05-20 00:00:00", "官网"), ("乙办法", "", "有效", "2024-01-01 00:00:00", "官网"), ("丙办法", "", "待核", "2024-05-20 00:00:00", "官网"), ("丁办法", "", "有效", "2024-05-20 00:00:00", "规则推断"), ("戊办法", "", "有效", "2024-05-20 00:00:00", None), ("戊办法", "", "失效", "2024-05-01 00:00:00", None), ("己办法", "", "有效", "no date", None)]
    rows = [("1", "无名", "保监发〔2014〕19号", "有效"), ("2", "乙办法", "", "失效"), ("3", "丙办法", "", "有效"), ("4", "丁办法", "", "失效"), ("5", "戊办法", "", "有效"), ("6", "戊办法", None, " "), ("7", "无", None, "有效"), ("8", "己办法", "", "失效"), ("9", "戊办法", "", "失效")]
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    got = {r.ref: r.outcome for r in R.timeliness_drift(spark.createDataFrame(rows, "ref string, title string, number string, status string"), spark.createDataFrame(state, "title string, number string, status string, checked_at string, source string"), now).collect()}
    assert got == {"1": "drift", "2": "stale", "3": "placeholder", "4": "non_authoritative_source", "5": "ok", "6": "empty_attr", "7": "no_state", "8": "stale", "9": "drift"}


def test_originals_and_attachments(spark):
    files = spark.createDataFrame([("a/x.doc", "h1"), ("b/y.doc", "h2"), ("c/z.doc", "h2"), ("d/e.doc", "")], "path string, sha256 string")
    records = spark.createDataFrame([("1", "a/x.doc", "h1", "x.doc"), ("2", "old/z.doc", "h2", "z.doc"), ("3", "old/q.doc", "h2", None), ("4", None, "h9", "s.xlsx"), ("5", "gone", "", "g.doc")], "ref string, path string, sha256 string, name string")
    got = {r.ref: (r.outcome, r.target, r.candidates) for r in R.relocated(records, files, F.coalesce(F.col("name").rlike("xlsx$"), F.lit(False))).collect()}
    assert got == {"1": ("resolvable", None, 0), "2": ("relocate", "c/z.doc", 2), "3": ("relocate", "b/y.doc", 2), "4": ("non_policy", None, 0), "5": ("missing", None, 0)}
    items = spark.createDataFrame([([("a", "u"), ("a", "u"), ("a", None), ("a", None), ("b", "u")],), ([],), (None,)], "x array<struct<name:string,url:string>>")
    assert [[tuple(a) for a in r[0]] if r[0] is not None else None for r in items.select(R.once_each(F.col("x"), ["name", "url"])).collect()] == [[("a", "u"), ("a", None), ("b", "u")], [], None]


def test_signatures_and_dates(spark):
    texts = ["见〔2014〕19号、保监发[2015] 7 号和（2014）19号，(2020)100号", None, "〔201〕9号"]
    assert [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(K.docno_signatures(F.col("t"))).collect()] == [["201419", "2020100"], [], []]
    dates = {"2024年3月5日": "2024-03-05", " 2024/12/31 10:00": "2024-12-31", "2024-7": "2024-07", "2024年11月": "2024-11", "3月5日": "", None: "", "2024": ""}
    got = {r.v: r.d for r in spark.createDataFrame([(v,) for v in dates], "v string").select("v", T.date_strict(F.col("v")).alias("d")).collect()}
    assert got == dates
