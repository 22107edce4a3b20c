"""Document numbers, titles, cleaning, decisions and mapping on literal cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docloom.functions import decisions as D
from docloom.functions import keys as K
from docloom.functions import text as T
from docloom.operators import mapping as M


def values(spark, function, texts):
    rows = [(i, *(t if isinstance(t, tuple) else (t,))) for i, t in enumerate(texts)]
    n = len(rows[0]) - 1
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"c{k} string" for k in range(n)))
    out = df.select("i", function(*(F.col(f"c{k}") for k in range(n))).alias("v")).collect()
    return [r.v for r in sorted(out, key=lambda r: r.i)]


CASES = [
    (K.docno, [("银保监办发〔2019〕 19号", "银保监办发201919"), ("财会[2017]22号号", "财会201722"), ("2020号号", "2020"), ("n.a.", ""), ("NULL", ""), ("未注明", ""), (None, ""), ("  无 ", "")]),
    (K.docno_strong, [("财教〔２０２１〕６４号", "财教202164"), ("国务院令第二百六十二号", "国务院令第262"), ("令第十号、第一百零五号", "令第10号、第105"), ("a&amp;b〔2020〕1号", "a&b20201"), ("N/A", "")]),
    (K.signature, [("财会〔2017〕22号", "2017-22"), ("abc", None), (None, None)]),
    (K.title, [("《管理办法》（试行）", "管理办法"), ("A_b-C，d", "abcd"), ("无", ""), ("x＋y", "x＋y"), (None, "")]),
    (K.title_strict, [("《管理 办法，二》(修订)", "管理办法，二"), ("“甲”(草案)", "甲(草案)"), ("", "")]),
    (K.title_quoted, [("&lt;公司法&gt;‘修正’", "公司法修正"), ("〈证券 法〉", "证券法")]),
    (K.without_version, [("办法（2022年修订版）（试行）", "办法"), ("规则 V2.1", "规则"), ("办法（草案）(征求意见稿)（暂行）（版）（试行）", "办法"), ("公司法", "公司法")]),
    (K.without_country, [("中华人民共和国公司法", "公司法"), ("中国法", "中国法"), ("中国银行", "银行"), ("保险法", "保险法")]),
    (K.ordinal, [("三十八", "38"), ("十", "10"), ("三百二十四", "324"), ("一百零五", "105"), ("二千零一十", "2010"), ("12", "12"), ("甲", "甲")]),
    (K.docno_shape, [("国务院令第300号", True), ("银保监会令2018年第5号", True), ("财会〔2017〕22号", True), ("[2017] 第 3 号", True), ("第3号", False), ("N/A", False), (None, False)]),
    (K.docno_normal, [
        ("金规[2026]4号", "金规〔2026〕4号"), ("保险机构参与中国金融期货证监会公告〔2020〕12号", "证监会公告〔2020〕12号"), ("中华人民共和国主席令（第三十八号）", "中华人民共和国主席令第38号"), ("国办发〔２０１３〕８７号", "国办发〔2013〕87号"),
        ("保监会令2013年第2号", "保监会令〔2013〕2号"), ("国务院令第324号", "中华人民共和国国务院令第324号"), ("财会〔2012〕 3 号的通知", "财会〔2012〕3号"), ("…abc", "abc"), (None, ""),
    ]),
    (K.docno_in_title, [("关于印发《办法》的通知（银发〔1999〕407号）", "银发〔1999〕407号"), ("规定（财政部令第116号）", "财政部令第116号"), ("国务院令第300号", "中华人民共和国国务院令第300号"), ("没有文号", ""), (None, "")]),
    (K.docno_in_body, [("条例（2001年11月23日国务院令第324号发布）第一条", "中华人民共和国国务院令第324号"), ("根据国务院令第324号", ""), (None, "")]),
    (K.in_abolishing, [(("甲。《旧办法》（财建〔2015〕19号）同时废止。", "财建〔2015〕19号"), True), (("本办法（财建〔2015〕19号）自公布之日起施行", "财建〔2015〕19号"), False), (("《关于贯彻国办发〔1998〕145号文件》", "国办发〔1998〕145号"), True), (("关于废止部分规章的决定，财建[2015]19号", "财建〔2015〕19号"), False), ((None, "x"), False), (("x", None), False)]),
    (K.bodies, [("国务院办公厅、银保监会和财政部，财政部", ["国务院办公厅", "中国银行保险监督管理委员会", "财政部"]), (None, [])]),
    (K.with_all_bodies, [(("银行中国证券监督管理委员会公告2017年第14号", "国家税务总局 财政部 证监会关于发布《办法》的公告"), "国家税务总局财政部中国证券监督管理委员会公告2017年第14号"), (("财会〔2017〕22号", "财政部 证监会关于"), "财会〔2017〕22号")]),
    (K.docno_resolved, [(("财会[2012]3号", "题", "文"), "财会〔2012〕3号"), (("123", "办法（银发〔1999〕407号）", ""), "银发〔1999〕407号"), (("财建〔2015〕19号", "新办法", "《旧办法》（财建〔2015〕19号）同时废止"), ""), ((None, None, "条例（2001年国务院令第324号公布）"), "中华人民共和国国务院令第324号")]),
    (T.date_normal, [
        ("2021年3月5日", "2021-03-05"), ("2021/3/15 10:00", "2021-03-15 10:00:00"), ("2021-03-15 00:00:00", "2021-03-15"), ("20210315", "2021-03-15"), ("2021/13/45", "2021/13/45"), ("发布于2020.1.2。", "2020-01-02"), ("soon", "soon"), (None, ""), ("2021-02-30", "2021-02-30"),
    ]),
    (T.plain_space, [("a\r\nb\tc　d\x00 e", "a\nb c d e"), ("甲 乙  x", "甲乙 x"), ("a​b", "ab"), ("\r\x00\n", "")]),
    (lambda c: T.plain_space(c, False), [("a\r\nb\tc　d\x00 e", "a b c d e")]),
    (T.denoised, [("正文内容 主办单位：某某部 打印本页", "正文内容"), ("x var a = 1; y function f(z) { b } w", "x y w"), (None, "")]),
    (T.clean_body, [("正文□内容　网站标识码：12345678901", "正文内容")]),
    (T.single_lead, [("各金融监管局，各银行公司：各金融监管局，各银行公司：为贯彻", "各金融监管局，各银行公司：为贯彻"), ("甲：甲：乙", "甲：甲：乙")]),
    (T.is_table, [("序号 名称", True), ("a|b\nc|d|e|f", True), ("12 ab\n34 cd\n56 ef", True), ("正文", False), ("", False), (None, False)]),
    (T.broken_up, [("甲。乙，丙", "甲。\n乙， 丙")]),
    (T.spaced, [("中文ABC中", "中文 ABC 中")]),
    (T.cut_long, [("甲" * 30 + "，因此" + "乙" * 30, ["甲" * 30 + "，", "因此", "乙" * 30]), ("甲" * 60, ["甲" * 60]), ("甲" * 60 + "。", []), ("短", []), (None, [])]),
    (T.unbroken, [("字" * 31 + "，" + "b" * 30, ["字" * 31])]),
    (T.year_of, [("发布于2020年", "2020"), ("x", "未知"), (None, "未知")]),
    (T.redacted, [("https://a.b/c?token=1#x", "https://a.b/c"), ("a?b", "a?b"), (None, None)]),
    (T.safe_name, [('a/b:c*?.', "a_b_c_"), ("", "unnamed"), (None, "unnamed")]),
    (T.alike, [(("管理办法的通知", "管理办法的通知"), True), (("保险销售管理办法", "关于保险销售管理办法的通知"), True), (("保险销售管理办法甲", "保险销售管理办法乙"), True), (("甲", "乙"), False), (("", ""), False), ((None, "a"), False)]),
    (lambda c: T.confusions_replaced(c, {"己": "已", "己经": "已经", "日": "目"}), [("己经日己", "已经目已"), ("x", "x"), (None, None)]),
    (lambda c: T.controlled(c, {"已执行": "executed", "部分": "partial"}, "not_executed")["value"], [("已 执行", "executed"), ("部分完成", "partial"), ("?", "not_executed"), (None, "not_executed")]),
    (T.without_repeat, [("某某保险公司招聘管理办法某某保险公司招聘管理", "某某保险公司招聘管理办法"), ("管理办法", "管理办法"), ("甲乙丙丁戊己庚辛", "甲乙丙丁戊己庚辛")]),
    (D.canonical_source, [("XZFGK", "gov"), ("mof.gov.cn", "mof"), ("other", ""), (None, "")]),
    (D.canonical_timeliness, [("现行有效", "valid"), ("N/A", "uncertain"), ("Valid", "valid"), ("?", "")]),
    (D.canonical_body_source, [("网页+文档", "both"), ("本地PDF", "downloaded_doc"), ("页面", "webpage"), (None, "webpage")]),
    (D.level, [(("中华人民共和国公司法", ""), "法律"), (("保险条例", ""), "行政法规"), (("保险规定", "银保监令"), "部门规章"), (("管理办法（试行）", ""), "规范性文件(试行/暂行)"), (("关于通知", ""), "规范性文件(通知/意见)"), ((None, None), "其他")]),
    (lambda t, n: D.guise(t, n, "本社"), [(("本社办法", ""), "internal_history"), (("民法典", ""), "law"), (("某条例", ""), "admin_regulation"), (("某通知", "财会〔2017〕2号"), "department_rule"), (("某物", ""), "unknown")]),
    (D.is_generic, [("《办法》", True), ("管理办法", False), (None, False)]),
    (D.is_body, [("国务院", True), ("自然资源标准化工作管理委员会", True), ("管理办法", False), ("部", False)]),
    (D.is_no_document, [("全国会议精神", True), ("统计资料", True), ("会议精神管理办法与其他的一切规定", False)]),
    (D.is_nominal, [("后三日", True), ("。", False), (None, False)]),
    (D.target_class, [(("R1", "", ""), "entity"), (("", "k", ""), "corpus"), (("", "", "财政部"), "organ"), (("", "", "《条例》"), "generic"), (("", "", "甲办法"), "external")]),
]


@pytest.mark.parametrize("function, cases", CASES, ids=[getattr(f, "__name__", "f") + str(i) for i, (f, _) in enumerate(CASES)])
def test_cases(spark, function, cases):
    assert values(spark, function, [c for c, _ in cases]) == [v for _, v in cases]


def test_authority(spark):
    rows = [("部门规章", "", "", ""), ("部门规范性文件（内部便函）", "", "", ""), ("", "宪法修正案", "", ""), ("x", "中", "财政部", "办法"), ("x", "中", "广东省人民政府", "办法"), ("x", "中", "财政部", "通知"), ("x", "中", "教育部令", ""), ("", "", "", ""), ("x", "中", "", "")]
    got = values(spark, D.authority, rows)
    assert [(v.category, v.rank, v.status) for v in got] == [
        ("dept_rule", 6.0, "success"), ("dept_normative", 9.0, "success"), ("constitution", 1.0, "success"), ("dept_rule", 6.0, "success"), ("local_government_rule", 7.0, "success"), ("dept_normative", 9.0, "estimated"), ("dept_rule", 6.0, "success"), ("other", 12.0, "insufficient_info"), ("other", 12.0, "unknown"),
    ]
    assert got[1].modifier == "内部便函"


def test_relevance(spark):
    body = "某" * 200
    rows = [("人身保险公司管理办法", "", ""), ("通知", "各人寿保险公司", body), ("通知", "", body + "人寿保险" + body), ("非寿险业务", "", ""), ("养老保险办法", "", ""), ("基本养老保险办法", "", ""), ("通知", "", "养老保险"), ("保险代理人规定", "", body), ("通知", "", "保险代理人和保险经纪公司"), ("通知", "", "保险公司"), ("通知", "", "保险公司与商业银行"), ("财产保险公司与人寿保险", "", ""), ("天气", "", ""), ("通知", "各人寿保险公司", "")]
    got = [(v.decision, v.confidence) for v in values(spark, D.relevance, rows)]
    assert got == [("INCLUDE", "high"), ("INCLUDE", "middle"), ("BOUNDARY", "low"), ("EXCLUDE", "none"), ("INCLUDE", "high"), ("EXCLUDE", "middle"), ("BOUNDARY", "low"), ("INCLUDE", "middle"), ("EXCLUDE", "middle"), ("BOUNDARY", "low"), ("EXCLUDE", "middle"), ("EXCLUDE", "middle"), ("EXCLUDE", "none"), ("BOUNDARY", "low")]


def test_mapped_sources(spark):
    number = K.docno_resolved
    gov = spark.createDataFrame([("b1", "办法（银发〔1999〕407号）", "http://a", "flk", "正文", None), ("b2", None, None, None, None, "摘要")], "bbbs string, title string, detail_url string, source string, full_text string, summary string")
    rows = {r.index_no: r for r in M.mapped(gov, "gov", number).collect()}
    assert rows["银发〔1999〕407号"].source == "gov" and rows["银发〔1999〕407号"].body_text == "正文" and rows["b2"].body_text == "摘要" and rows["b2"].title == ""
    nfra = spark.createDataFrame([("N1", "题", "http://b", "财会[2012]3号", "文")], "doc_id string, title string, detail_url string, doc_no string, content string")
    r = M.mapped(nfra, "nfra", number).first()
    assert (r.index_no, r.document_number, r.source, r.body_source) == ("N1", "财会〔2012〕3号", "nfra", "webpage")
    for source in M.FIELDS:
        assert M.mapped(spark.createDataFrame([("t",)], "title string"), source, number).first().title == "t"


def test_cleaned_and_quarantine(spark):
    rows = spark.createDataFrame([("1", "k1", "题", "一句。二句。", "2020年1月2日"), ("2", "k1", "题", "后来", ""), ("3", "k2", "N/A", "x", ""), ("4", "k3", "题", None, "")], "index_no string, dedup_key string, title string, body_text string, publish_date string")
    good, bad = M.cleaned(rows, ["title", "body_text"])
    assert [(r.index_no, r.publish_date, r.n_sentences) for r in good.collect()] == [("1", "2020-01-02", 2)]
    assert {(r.index_no, r.errors) for r in bad.collect()} == {("3", "title"), ("4", "body_text")}


def test_attachments(spark):
    rows = spark.createDataFrame([(1, [("a", None, "pdf", "甲" * 60), ("", "b", "doc", "乙")], None, None, "甲" * 80), (2, None, "attachment", "名", "c")], "id int, attachments array<struct<file_name: string, name: string, mime: string, text: string>>, link_type string, title string, content string")
    got = sorted((r.id, r.file_name, r.kind, r.text_len) for r in M.attachments(rows, "id").collect())
    assert got == [(1, "a", "pdf", ""), (1, "b", "doc", ""), (2, "名", "", "1")]
    s = rows.where("id = 1").select(M.split_bodies(F.col("attachments"), F.col("content")).alias("s")).first().s
    assert [a.name for a in s.real] == ["b"] and [a.file_name for a in s.carriers] == ["a"]
    f = values(spark, lambda b, t, a: M.filled_from_attachment(b, t, a), [("", "甲办法", "关于甲办法" + "文" * 60), ("有", "甲办法", "关于甲办法" + "文" * 60), ("", "乙", "文" * 60)])
    assert [x.body_source for x in f] == ["downloaded_doc", "webpage", "webpage"]


def test_scrubbed_payload(spark):
    df = spark.sql("select map('api_key', 'x', 'name', 'y', 'Authorization', 'z') m")
    assert df.select(M.without_secrets(F.col("m")).alias("m")).first().m == {"name": "y"}
