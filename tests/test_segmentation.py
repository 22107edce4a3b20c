from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import clauses as C


def applied(spark, build, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(build(F.col("t"))).collect()
    return [r[0] for r in rows]


def test_chapters_and_articles_in_running_text(spark):
    texts = [
        "第一章 总 则第一条 为了加强管理，制定本条例。\n第二条 本条例适用。", "根据2026年8月8日《某某的决定》修订)第一章 总 则第一条 为了。", "第一条 依照第五十三条、第五十四条规定的行为，应当处罚。",
        "第一条 依照第五十三条，第五十四条规定的行为，应当处罚。", "第二条 本办法所称贷款人。第三条 本办法所称个人贷款。", "第一条 本法第五十三条的（以下简称贷款人）第三条 引用。（注。）第四条 另起。",
        "第二章 要求 第一节 产品募集信息披露", "第五条 按第二章 第三条执行", None, " ",
    ]
    got = [t.split("\n") for t in applied(spark, C.segmented, *texts)]
    assert got[0] == ["第一章 总 则", "第一条 为了加强管理，制定本条例。", "第二条 本条例适用。"]
    assert got[1] == ["根据2026年8月8日《某某的决定》修订)", "第一章 总 则", "第一条 为了。"]
    assert len(got[2]) == len(got[3]) == 1 and len(got[4]) == 2
    assert got[5] == ["第一条 本法第五十三条的（以下简称贷款人）第三条 引用。（注。）", "第四条 另起。"]
    assert got[6] == ["第二章 要求", "第一节 产品募集信息披露"] and got[7] == ["第五条 按第二章", "第三条执行"] and got[8:] == [[""], [""]]


def test_articles_of_running_text(spark):
    docs = spark.createDataFrame([(1, "第一章 总 则第一条 甲。第二条 乙，见第一条。第三条 丙。")], "doc_id long, text string").withColumn("text", C.segmented(F.col("text")))
    assert [(r.number, r.body) for r in C.articles(docs).orderBy("article").collect()] == [(1, "甲。"), (2, "乙，见第一条。"), (3, "丙。")]


def test_outlines_in_running_text(spark):
    got = applied(spark, C.outlined, "通知如下： 一、 第一项。 1、 具体措施。 二、 第二项。", "二、基本原则（一）服务国家战略，坚持以人民为中心的发展思想，稳中求进。", "一、负责一、二类口岸开放或关闭的审查工作并且上报有关的部门备案。", "三、见（二）项规定的内容并按照有关的规定和要求办理相关的手续。", "版本 1.5 和 —— 说明。", None)
    assert got[0].split("\n") == ["通知如下：", "一、 第一项。", "1、 具体措施。", "二、 第二项。"]
    assert got[1].split("\n")[1].startswith("（一）") and len(got[2].split("\n")) == len(got[3].split("\n")) == 1
    assert got[4].split("\n") == ["版本 1.5 和", "—— 说明。"] and got[5] == ""


def test_tails(spark):
    body = "正文。" * 300
    texts = [body + "附：银保监会发布《某办法》", body + "中国银保监会 2020 年1月2日（此件公开发布）", body + "本条例自2010年6月1日起施行。", "答记者问" + body, body + "银保监会、财政部联合发布《某办法》 http://x", body + "银保监会2020年1月2日起施行本办法。", None]
    got = [(r.text == body, r.removed > 0) for r in applied(spark, C.tail_cut, *texts)]
    assert got == [(True, True), (True, True), (False, False), (False, False), (True, True), (False, False), (False, False)]


def test_parse_text_and_chapters(spark):
    assert applied(spark, C.parse_text, "保险 公司， 甲 A 级 3 年", None) == ["保险公司，甲A级3年", ""]
    chapters = spark.createDataFrame([(1, 1, 0), (1, 2, 9), (1, 3, 2), (2, 1, 5)], "doc long, number int, article int")
    clauses = spark.createDataFrame([(1, i) for i in (1, 2, 3)], "doc long, number int")
    assert sorted(map(tuple, C.clamped(chapters, clauses).collect())) == [(1, 1, 1, True, False), (1, 2, 3, True, False), (1, 3, 2, False, True), (2, 1, 5, False, False)]
