from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import documents as D


def applied(spark, build, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(build(F.col("t"))).collect()
    return [r[0] for r in rows]


def test_kinds_of_documents(spark):
    titles = ["关于某事的通知", "中国人民银行令〔2025〕第4号(业务领域网络安全事件报告管理办法)", "某某行政处罚决定书", "保险法", "办法的解读材料", "无", "", None, "某某白皮书"]
    got = [tuple(r) for r in applied(spark, D.document_type, titles)]
    assert got == [("通知", "公文", "end"), ("办法", "法规类型", "end_bracket"), ("决定书", "其他_答复处理", "end"), ("法", "法规类型", "end"), ("办法", "法规类型", "middle"), (None, "其他未分类", "not_found"), (None, None, "empty_title"), (None, None, "empty_title"), ("白皮书", "其他_信息数据", "end")]
    values = spark.createDataFrame([("令", "x"), ("便函", "某某通知"), (None, "保险法"), ("N/A", "无")], "v string, t string")
    assert [r[0] for r in values.select(D.type_normal(F.col("v"), F.col("t"))).collect()] == ["命令", "通知", "法律", ""]


def test_titles_of_scans(spark):
    texts = ["附件1：阳光人寿营销员管理办法 第3页（共9页）", "I阳光人寿招聘管理办法", "IT管理办法", "阳光保险招聘管理办法序号 责任分类", "某某公司招聘管理办法2024年1月2日印发", "阳光保险集团股份公司招聘管理办法阳光保险集团股份公司", "附件", None, "  某某 - 3 - 管理办法。"]
    assert applied(spark, D.policy_title, texts) == ["阳光人寿营销员管理办法", "阳光人寿招聘管理办法", "IT管理办法", "阳光保险招聘管理办法", "某某公司招聘管理办法", "阳光保险集团股份公司招聘管理办法", "附件", "", "某某 管理办法"]


def test_numerals(spark):
    from docloom.operators.clauses import numeral

    want = {1: "一", 10: "十", 12: "十二", 20: "二十", 35: "三十五", 100: "一百", 105: "一百零五", 110: "一百一十", 133: "一百三十三", 1001: "一千零一", 2020: "二千零二十", 9999: "九千九百九十九", 0: "", 10000: "", -3: ""}
    got = {r.n: r.t for r in spark.createDataFrame([(n,) for n in want], "n int").select("n", D.chinese_number(F.col("n")).alias("t")).collect()}
    assert got == want
    both = spark.range(1, 10000).select(F.col("id").cast("int").alias("n")).select("n", numeral(D.chinese_number(F.col("n"))).alias("m"))
    assert both.where("n <> m or m is null").count() == 0


def test_bytes_of_unknown_encoding(spark):
    text = "中国银保监会关于印发办法的通知"
    rows = [("a", text.encode(), None), ("b", text.encode("gb18030"), None), ("c", text.encode("gb18030"), "GBK"), ("d", text.encode(), "gb18030x"), ("e", b"\xef\xbb\xbf" + text.encode(), None), ("f", None, None), ("g", b"", None), ("h", "臺灣金融監督管理".encode("big5"), "big5"), ("i", b"\xff\xfe\x80abc", None)]
    got = {r.path: (r.text, r.encoding, r.garbled) for r in D.decoded(spark.createDataFrame(rows, "path string, content binary, hint string"), "content", "hint").collect()}
    assert got["a"] == got["e"] == (text, "utf-8", 0.0) and got["b"] == (text, "gb18030", 0.0) and got["c"] == (text, "gbk", 0.0) and got["d"][0] == text
    assert got["f"] == (None, None, None) and got["g"] == ("", "utf-8", 0.0) and got["h"] == ("臺灣金融監督管理", "big5", 0.0) and got["i"][2] > 0


def test_triage(spark):
    rows = [("relevance_boundary", "summary:5", None), ("relevance_boundary", "x", None), ("trigger_manual_breakpoint", "N-1 已修复", "{}"), ("trigger_manual_breakpoint", None, "处置：已落地"), ("other", "summary:1", "已修复"), (None, None, None)]
    got = [r[0] for r in spark.createDataFrame(rows, "k string, s string, p string").select(D.triage(F.col("k"), F.col("s"), F.col("p"))).collect()]
    assert got == ["auto", "human", "auto", "auto", "human", "human"]
