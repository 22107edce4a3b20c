"""Clauses, outlines and relations on literal texts."""

from __future__ import annotations

from docloom.operators import clauses as C
from docloom.operators import relations as R


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")


def test_outline(spark):
    text = "标题\n一、总则\n说明\n（一）目的\n（二）范围\n1.甲\n二、附则\n1.乙"
    rows = sorted(tuple(r) for r in C.outline(docs_of(spark, text, None, "没有")).collect())
    assert rows == [(1, 1, 1, 1, 0, "总则\n说明"), (1, 2, 2, 1, 1, "目的"), (1, 3, 2, 2, 1, "范围"), (1, 4, 3, 1, 3, "甲"), (1, 5, 1, 2, 0, "附则"), (1, 6, 3, 1, 5, "乙")]


def test_tail(spark):
    rows = C.without_tail(docs_of(spark, "第一条 甲。\n中间\n2020年1月2日\n附件：表", "附件：表")).collect()
    assert [(r.doc, r.text) for r in sorted(rows)] == [(1, "第一条 甲。"), (1, "中间")]


def test_repair(spark):
    text = "第一条 为了规范，按照\n第二条 的规定，制定本办法。\n第三条 本办法所称甲，是指乙以及其他各种各样的东西。\n第三条 本办法所称甲，是指乙以及其他各种各样的东西。"
    fixed = C.repair(C.articles(docs_of(spark, text))).orderBy("article").collect()
    assert [(r.article, r.number) for r in fixed] == [(1, 1), (2, 3)]
    assert fixed[0].body == "为了规范，按照第二条的规定，制定本办法。" and fixed[1].body.startswith("本办法所称")


def test_validation(spark):
    good = "第一章 总则\n第一条 甲是乙。\n第二条 丙是丁。"
    bad = "第二条 甲  乙。\n第二条 丙。\n第一条\n2020年1月2日"
    clauses = C.articles(docs_of(spark, good, bad, ""))
    meta = spark.createDataFrame([(1, "k", "t", "http://a", "RFN-001", 2), (2, "", "t", None, "x", 9), (3, "k", "t", "u", "R1", None)], "doc long, dedup_key string, title string, source_url string, rfn string, article_count int")
    rows = {r.doc: (r.status, r.errors, r.warnings) for r in C.validate(meta, clauses).collect()}
    assert rows[1] == ("PASSED", "", "") and rows[3] == ("PASSED", "", "")
    assert rows[2] == ("FAILED", "V001,V002,V003", "V001,V004,V007,V009,V010")


def test_semantics_and_markdown(spark):
    clauses = C.articles(docs_of(spark, "第一章 总则\n第一条 应当依照《甲法》。\n（一）不得乙\n第二章 附则\n第二条 丙。"))
    assert tuple(C.semantics(clauses).first())[:5] == (1, 2, 1, 1, 2)
    titles = spark.createDataFrame([(1, "题")], "doc long, title string")
    assert C.markdown(clauses, titles).first().text == "# 题\n\n## 一\n\n**一** 应当依照《甲法》。\n（一）不得乙\n\n## 二\n\n**二** 丙。"


def test_relations_and_guards(spark):
    rows = R.relations(docs_of(
        spark, "根据《甲办法》制定。《乙规定》同时废止。《丙规定》第三条废止。", "《丁办法》废止后，另行规定。《戊办法》由财政部负责解释，予以废止。", "依照《条例》和《国务院》以及根据《会议精神》制定。",
        "下列文件予以废止：\n一、关于甲的《己办法》\n2.《庚规定》\n其他事项\n三、《辛规定》", "本草案拟废止《壬办法》。", None,
    )).collect()
    assert sorted((r.doc, r.kind, r.title, r.article, r.action) for r in rows) == [
        (1, "basis", "甲办法", None, ""), (1, "repeal", "丙规定", 3, "废止_partial"), (1, "repeal", "乙规定", None, "同时废止"), (4, "repeal", "己办法", None, "listed"), (4, "repeal", "庚规定", None, "listed"),
    ]


def test_resolution(spark):
    index = spark.createDataFrame([("R1", "银发〔1999〕407号", "中华人民共和国商业银行法（2015年修正）"), ("R2", "国务院令第二百六十二号", "公积金条例"), ("R3", "", "双名办法"), ("R4", "", "双名办法"), ("R5", "财会〔2017〕22号", "收入准则")], "ref string, number string, title string")
    refs = spark.createDataFrame([(1, "", "银发[1999]407号"), (2, "", "国务院令第262号"), (3, "商业银行法", ""), (4, "双名办法", ""), (5, "《收入 准则》", ""), (6, "x", "某部财会〔2017〕22号"), (7, "没有", "")], "id int, title string, number string")
    rows = {r.id: (r.target, r.method, r.confidence) for r in R.resolve(refs, index).collect()}
    assert rows == {1: ("R1", "docno_strong", 1.0), 2: ("R2", "docno_strong", 1.0), 3: ("R1", "title_country", 0.9), 4: (None, "unresolved", 0.0), 5: ("R5", "title", 0.9), 6: ("R5", "docno_sig", 0.95), 7: (None, "unresolved", 0.0)}


def test_edges(spark):
    index = spark.createDataFrame([("R1", "", "甲办法")], "ref string, number string, title string")
    found = R.relations(docs_of(spark, "根据《甲办法》《乙规定》制定。"))
    rows = {r.title: (r.target, r.target_class, r.confidence) for r in R.edges(found, index).collect()}
    assert rows == {"甲办法": ("R1", "entity", 0.9), "乙规定": (None, "external", 0.0)}


def test_targets_by_tiers_containment_and_the_weak_index(spark):
    from docloom.operators import relations as R

    index = spark.createDataFrame([("A", "", "中华人民共和国公司法"), ("B", "", "某某公司应急预案"), ("C", "", "某某公司应急预案管理规定"), ("D", "保监发〔2014〕19号", "另一文件")], "ref string, number string, title string")
    weak = spark.createDataFrame([("w1", "", "中华人民共和国民法典"), ("w2", "", "某某公司应急预案")], "ref string, number string, title string")
    names = [("公司法", ""), ("某某公司应急预案（2024版）", ""), ("公司应急预案管理", ""), ("关于适用公司法的若干规定", ""), ("民法典", ""), ("《无此文件》", ""), ("", ""), ("x", "保监发〔2014〕19号"), ("应急", "")]
    refs = spark.createDataFrame(names, "title string, number string")
    got = {r.title: (r.target, r.weak_key, r.method) for r in R.resolve_target(refs, index, weak).collect()}
    assert got["公司法"][0] == "A" and got["公司应急预案管理"] == ("C", None, "title_contains")
    assert got["某某公司应急预案（2024版）"][0] == "B" and got["民法典"][:2] == (None, "w1")
    assert got["《无此文件》"] == got[""] == got["应急"] == (None, None, "unresolved") and got["x"][0] == "D"
    assert got["关于适用公司法的若干规定"] == (None, None, "unresolved")
    strict = {r.title: r.method for r in R.resolve_target(refs, index, weak, strict=True).collect()}
    assert "title_contains" not in strict.values() and len(strict) == len(names)


def test_located_relations_and_their_gate(spark):
    from docloom.operators import relations as R

    text = "总述，根据《甲办法》制定。\n第一条 依据《乙规定》第二条办理。\n第二条 《丙通知》第九条同时废止。再按《甲办法》。"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "无")], "doc_id long, text string")
    index = spark.createDataFrame([("A", "", "甲办法"), ("B", "", "乙规定")], "ref string, number string, title string")
    clauses = spark.createDataFrame([("B", 1), ("B", 2)], "doc string, number int")
    edges = R.located(docs, index, clauses)
    got = {(r.title, r.kind): (r.src_article, r.target, r.article, r.state) for r in edges.collect()}
    assert got == {("甲办法", "basis"): (None, "A", None, None), ("乙规定", "basis"): (1, "B", 2, "verified"), ("丙通知", "repeal"): (2, None, 9, None)}
    at = {(r.found, r.at) for r in R.offsets(docs, "doc_id", "text", "《[^《》]+》").collect()}
    assert at == {(f"《{t}》", i) for t in ("甲办法", "乙规定", "丙通知") for i in range(len(text)) if text.startswith(f"《{t}》", i)}
    assert R.gate(edges, index, {"basis": 2, "repeal": 1}).count() == 0
    from pyspark.sql import functions as F

    bad = edges.union(edges.where("title = '甲办法'")).withColumn("snippet", F.when(F.col("title") == "丙通知", "").otherwise(F.col("snippet")))
    assert {r.rule: r.n for r in R.gate(bad, index.where("ref <> 'B'"), {"basis": 2, "repeal": 1}).collect()} == {"ids": 1, "trace": 1, "refs": 1, "stat": 1}


def test_last_lines_are_found_in_one_pass(spark):
    import time

    from pyspark.sql import functions as F

    texts = ["", "a", "a\nb", "a\n", "a\r\n", "a\n\n", "\n", "\r\n", "a\r", "a\nb\r\n", "a\r\n\r\n", "a\nb ", "a\n\rb", None]
    rows = docs_of(spark, *texts).select(F.regexp_extract("text", r"([^\n]*)$", 1).alias("want"), C.last_line(F.col("text")).alias("got")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    clauses = spark.range(1).select(F.col("id").alias("doc"), F.lit(1).alias("article"), F.lit(1).alias("number"), F.lit(0).alias("chapter"), F.concat(F.repeat(F.lit("word "), 100_000), F.lit("\n"), F.repeat(F.lit("word "), 100_000), F.lit("§")).alias("body"))
    meta = spark.range(1).select(F.col("id").alias("doc"), F.lit("k").alias("dedup_key"), F.lit("t").alias("title"), F.lit("u").alias("source_url"), F.lit("RFN-1").alias("rfn"), F.lit(None).cast("int").alias("article_count"))
    began = time.time()
    assert [tuple(r) for r in C.validate(meta, clauses, "§$").collect()] == [(0, "PASSED_WITH_WARNINGS", "", "V009")]
    assert time.time() - began < 30
