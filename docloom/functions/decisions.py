"""Decision tables over titles, numbers, bodies and fields: classes, ranks, relevance.

Every function takes columns and returns one; null counts as empty; rules are tried in order and the first that holds counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import docno

#: Fixed: classes of authority with their rank, and raw categories that name one.
RANKS = {"constitution": 1.0, "law": 2.0, "judicial_interpretation": 2.5, "admin_regulation": 3.0, "local_regulation": 4.0, "autonomous_regulation": 5.0, "dept_rule": 6.0, "local_government_rule": 7.0, "state_council_normative": 8.0, "dept_normative": 9.0, "local_government_normative": 10.0, "industry_rule": 11.0, "other": 12.0}
CATEGORIES = {
    "法律": "law", "国家法律": "law", "法律法规": "law", "宪法": "constitution", "修正案": "law", "法律解释": "judicial_interpretation", "司法解释": "judicial_interpretation", "行政法规": "admin_regulation", "部门规章": "dept_rule", "财政法律法规（财政部规章）": "dept_rule", "政策规章规范性文件": "dept_normative",
    "规范性文件": "dept_normative", "财政部规范性文件": "dept_normative", "部门规范性文件": "dept_normative", "地方法规": "local_regulation", "监察法规": "local_regulation", "行业自律文本": "industry_rule",
}
MODIFIER = "（[^（）]*(?:内部便函|内部文件|内部备案)[^（）]*）"
LEGAL_TYPES = ["决议", "决定", "命令", "令", "公报", "公告", "通告", "意见", "通知", "通报", "报告", "请示", "批复", "议案", "函", "纪要", "法律"]
#: Fixed: values of source, timeliness and body source, and what is read as one of them.
SOURCES = {"gov": "gov", "mof": "mof", "nfra": "nfra", "pbc": "pbc", "supp": "supp", "xzfgk": "gov", "flk": "gov", "gov.cn": "gov", "gov.cn补充": "gov", "zhengceku": "gov", "bmwj": "gov", "fgk.mof.gov.cn": "mof", "mof.gov.cn": "mof"}
TIMELINESS = {
    "valid": "valid", "amended": "amended", "repealed": "repealed", "partially_repealed": "partially_repealed", "expired": "expired", "pending": "pending", "uncertain": "uncertain", "n/a": "uncertain", "na": "uncertain", "none": "uncertain", "null": "uncertain", "未知": "uncertain", "未核验": "uncertain", "不确定": "uncertain",
    "现行有效": "valid", "有效": "valid", "已废止": "repealed", "废止": "repealed", "已失效": "expired", "失效": "expired", "修订": "amended", "部分废止": "partially_repealed", "待定": "pending", "尚未施行": "pending",
}
BOTH_BODIES = ["网页与文档", "网页+文档", "both", "双版本", "网页正文与文档版并存"]
DOCUMENT_BODY = ["downloaded_doc", "本地", "docx", "pdf", "扫描", "ocr", "文本层"]
#: Fixed: names that are only a kind of document; endings of bodies and of documents; names of what is no document.
GENERIC = ["条例", "办法", "规定", "细则", "通知", "决定", "意见", "指引", "制度", "方案", "规程", "准则", "标准", "法", "公告", "通告", "规则", "规范", "批复", "函", "命令"]
BODY_END = "(?:国务院|人民政府|政府|委员会|管理委员会|理事会|管委会|纪委监委|银行业监督管理机构|保险监督管理机构|监督管理机构|管理机构|主管机构|派出机构|分支机构|经办机构|监管机构|金融监管局|银保监局|总公司|分公司|公司|银行|总行|法院|检察院|院|署|部|厅|局|中心|协会|联合会|交易所|办公室|事业部)$"
DOCUMENT_END = "(?:办法|规定|通知|条例|细则|指引|制度|方案|规程|准则|标准|意见|决定|公告|通告|规则|规范|批复|解释|协议|清单|手册|备忘录|要点|规划|计划|报告|文书|凭证|承诺书|确认书|目录|纲要|法)$"
NO_DOCUMENT = ["会议精神", "会议决定", "会议纪要", "实际情况", "统计资料", "调研结果", "调研资料", "有关要求", "有关精神", "上级要求", "领导批示", "领导讲话", "讲话精神", "批示精神"]
NOMINAL = ["后", "前", "时", "之日", "程序", "工作", "条件", "公告", "决定"]
#: Fixed: words of life insurance that are strong or weak signs, words of agents, general words, and what excludes.
HARD = ["人身保险公司", "人寿保险公司", "寿险公司", "健康险公司", "养老险公司", "养老保险公司", "人身险公司", "人寿保险", "人身保险", "寿险(?!再保险)", "健康险", "养老险"]
SOFT = ["养老保险", "健康保险"]
AGENTS = ["保险销售从业人员", "保险营销员", "保险代理人", "保险兼业代理", "个人保险代理人", "独立个人保险代理人"]
GENERAL = ["保险公司", "保险机构", "保险理赔", "保险资金", "保险资产管理", "分红保险", "万能保险", "投资连结保险", "投连险", "保险产品", "保险消费者", "保单", "偿付能力", "保险公司分支机构", "分支机构", "保险条款", "保险销售", "保险营销"]
OTHER_COMPANIES = ["保险经纪公司", "保险经纪机构", "保险公估", "保险中介机构", "公估机构", "保险经纪"]
STRONG_EXCLUSIONS = ["财产保险公司", "财产险", "再保险公司", "保险经纪公司", "保险公估", "保险中介机构", "商业银行", "证券公司", "信托公司"]
OTHER_SECTORS = ["财产保险公司", "财产险", "再保险公司", "商业银行", "银行业金融机构", "证券公司", "基金管理公司", "信托公司", "金融资产", "银行业"]
SOCIAL = ["社会养老保险", "基本养老保险", "社会保险费", "社会保障基金", "城乡居民基本养老保险", "城镇企业职工基本养老保险", "职工基本养老保险", "企业职工基本养老保险", "社会医疗保险", "基本医疗保险", "补充养老保险", "企业职工养老保险", "城乡居民养老保险", "养老保险条例", "社会养老"]
ADDRESSING = ["各", "适用", "主送", "抄送", "发给", "发往", "对象", "范围", "通知如下", "现将", "监管", "发送"]


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def _looked_up(values: dict[str, str], key: Column, otherwise: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), key), otherwise)


def _has(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(words))


def canonical_source(raw: Column) -> Column:
    """The source that a name or host stands for; empty if it is not known."""
    return _looked_up(SOURCES, F.lower(_text(raw)), F.lit(""))


def canonical_timeliness(raw: Column) -> Column:
    """One of the seven states of timeliness; empty if the text stands for none."""
    return _looked_up(TIMELINESS, F.lower(_text(raw)), F.lit(""))


def canonical_body_source(raw: Column) -> Column:
    """webpage, downloaded_doc or both, by words in the text; both is tried first."""
    t = F.lower(_text(raw))
    any_of = lambda words: F.lit(False) if not words else _has(t, [w.replace("+", r"\+") for w in words])
    return F.when(any_of(BOTH_BODIES), "both").when(any_of(DOCUMENT_BODY), "downloaded_doc").otherwise("webpage")


def authority(category: Column, title: Column, agency: Column, doc_type: Column) -> Column:
    """Struct (category, rank, status, modifier): the class of authority of a document.

    A raw category that names one counts first, then title, body and kind of document. status: success, estimated (a
    normative document by its body), unknown, insufficient_info.
    """
    modifier = F.regexp_extract(_text(category), f"（({MODIFIER[1:-1]})）", 1)
    raw, t, a, kind = F.trim(F.regexp_replace(_text(category), MODIFIER, "")), _text(title), _text(agency), _text(doc_type)
    mapped = _looked_up(CATEGORIES, raw, F.lit(None).cast("string"))
    place, local = a.rlike("省|市|县|区|乡|镇"), "(省|市|自治区|自治州|自治县)"
    council, department = F.contains(a, F.lit("国务院")), a.rlike("部|委员会|总局|总署|署|局|中国人民银行|审计署")
    normative = kind.isin(LEGAL_TYPES)
    rules = [
        (mapped.isNotNull(), mapped, "success"), (F.contains(t, F.lit("宪法修正案")) | (raw == "宪法"), "constitution", "success"), ((kind == "法律") | t.rlike("《中华人民共和国.*法》"), "law", "success"), (t.startswith("国务院令"), "admin_regulation", "success"),
        (council & kind.isin("条例", "规定", "办法", "细则", "规则"), "admin_regulation", "success"), (a.rlike("最高人民法院|最高人民检察院"), "judicial_interpretation", "success"), (a.rlike(f"{local}.*人大") & (kind == "条例"), "local_regulation", "success"),
        (F.contains(a, F.lit("自治")) & (kind == "条例"), "autonomous_regulation", "success"), (a.rlike("(部|局|署|中国人民银行)令"), "dept_rule", "success"), (department & ~place & kind.isin("规定", "办法", "细则", "规则"), "dept_rule", "success"),
        (a.rlike("(省|市|自治区).*政府令"), "local_government_rule", "success"), (a.rlike(f"{local}.*政府") & kind.isin("规定", "办法"), "local_government_rule", "success"), (normative & council, "state_council_normative", "estimated"),
        (normative & department & ~place, "dept_normative", "estimated"), (normative & (a.rlike(f"{local}.*政府") | place), "local_government_normative", "estimated"), (normative, "other", "estimated"), ((t == "") & (a == ""), "other", "insufficient_info"),
    ]
    name, status = F.lit("other"), F.lit("unknown")
    for holds, value, state in reversed(rules):
        name, status = F.when(holds, value).otherwise(name), F.when(holds, state).otherwise(status)
    rank = F.element_at(F.create_map(*(F.lit(x) for pair in RANKS.items() for x in pair)), name)
    return F.struct(name.alias("category"), rank.alias("rank"), status.alias("status"), modifier.alias("modifier"))


def level(title: Column, number: Column) -> Column:
    """The level of effect of a document, by its title and number."""
    t, d = _text(title), F.upper(_text(number))
    return (
        F.when(t.rlike("^中华人民共和国.+法$") | (t.endswith("法") & ~F.contains(t, F.lit("条例")) & (F.length(t) <= 12)), "法律").when(F.contains(t, F.lit("司法解释")) | d.rlike(r"法释\[") | F.contains(t, F.lit("最高人民法院关于适用")), "司法解释")
        .when(t.endswith("条例"), "行政法规").when(d.rlike(r"银保监令|保监会令|中国保险监督管理委员会令|部令|第\d+号令"), "部门规章").when(F.concat(t, d).rlike("JR/T|行业标准|中国保险行业协会|保险业协会"), "行业标准")
        .when(t.rlike("指引|规程|标准|规范|自律公约|示范"), "操作指引/行业标准").when(t.rlike("办法|规定") & t.rlike("试行|暂行"), "规范性文件(试行/暂行)").when(t.rlike("办法|规定"), "规范性文件(办法/规定)").when(t.rlike("通知|意见|通报|公告|批复|函"), "规范性文件(通知/意见)").otherwise("其他")
    )


def guise(title: Column, number: Column, own: str) -> Column:
    """How an external authority looks, for display: `own` is the word that marks the house's own documents."""
    t, d = _text(title), _text(number)
    named = (docno(d) != "") & d.rlike(r"〔|\[|第") & t.rlike("公告|令|通知|办法")
    return (
        F.when(F.contains(t, F.lit(own)) | F.contains(d, F.lit(own)), "internal_history").when(F.contains(t, F.lit("法典")) | t.endswith("法"), "law").when(F.contains(t, F.lit("国务院令")) | t.endswith("条例"), "admin_regulation")
        .when(named, "department_rule").when(t.rlike("(办法|规定|细则|规则|指引|通知)$"), "department_rule").otherwise("unknown")
    )


def is_generic(name: Column) -> Column:
    """Whether a quoted name is only a kind of document."""
    return F.regexp_replace(_text(name), r"(?U)[《》〈〉\s]", "").isin(GENERIC)


def is_body(name: Column) -> Column:
    """Whether a name is that of a body, not of a document."""
    n = F.regexp_replace(_text(name), r"(?U)[《》〈〉\s]", "")
    return F.length(n).between(2, 24) & n.rlike(BODY_END) & ~n.rlike(DOCUMENT_END)


def is_no_document(name: Column) -> Column:
    """Whether a name stands for a meeting, a speech, circumstances or data."""
    n = F.regexp_replace(_text(name), r"""(?U)[《》〈〉"'“”‘’\s]""", "")
    return F.length(n).between(1, 12) & (n.isin(NO_DOCUMENT) | (n.rlike("(会议精神|统计资料|实际情况|调研结果|领导批示|讲话精神)$") & ~n.rlike(DOCUMENT_END)))


def is_nominal(after: Column) -> Column:
    """Whether what follows a repealing word makes a noun of it."""
    return _text(after).rlike("^(?:" + "|".join(NOMINAL) + ")")


def target_class(ref: Column, key: Column, name: Column) -> Column:
    """entity (has a reference), corpus (has a key), organ, generic, else external."""
    return F.when(_text(ref) != "", "entity").when(_text(key) != "", "corpus").when(is_body(name), "organ").when(is_generic(name), "generic").otherwise("external")


#: Fixed: word lists of `relevance`, by role.
LIFE = {
    "hard": HARD, "soft": SOFT, "agents": AGENTS, "general": GENERAL, "companies": OTHER_COMPANIES, "strong": STRONG_EXCLUSIONS, "sectors": OTHER_SECTORS, "social": SOCIAL, "addressing": ADDRESSING,
    "other_lines": ["财产保险公司", "财险", "财产险", "再保险", "机动车辆保险", "车险", "机动车"], "own_lines": ["人身保险公司", "寿险公司"],
}


def relevance(title: Column, meta: Column, body: Column, words: dict[str, list[str]] | None = None, not_after: str = "非", least: int = 200) -> Column:
    """Struct (decision, confidence): whether a document concerns a subject, INCLUDE, BOUNDARY or EXCLUDE.

    words: lists by role as in LIFE (life insurance). A hard word in the title includes, elsewhere only near an addressing
    word; a soft word includes in the title alone; agents include unless other companies are named; general words are
    boundary cases unless strong exclusions stand by; then titles of other lines are vetoed, and documents of under `least`
    characters are not included for words outside the title.
    """
    w = words or LIFE
    t, m, b = (F.coalesce(c, F.lit("")) for c in (title, meta, body))
    whole = F.concat_ws("\n", t, m, b)
    hard = f"(?<!{not_after})(?:" + "|".join(sorted(w["hard"], key=len, reverse=True)) + ")"
    soft = f"(?<!{not_after})(?:" + "|".join(w["soft"]) + ")"
    near = "(?:" + "|".join(w["addressing"]) + ")"
    addressed = whole.rlike(f"(?s){near}.{{0,25}}?{hard}|{hard}.{{0,25}}?{near}")
    pick = lambda d, c: F.struct(F.lit(d).alias("decision"), F.lit(c).alias("confidence"))
    first = (
        F.when(whole.rlike(hard), F.when(t.rlike(hard), pick("INCLUDE", "high")).when(addressed, pick("INCLUDE", "middle")).otherwise(pick("BOUNDARY", "low")))
        .when(whole.rlike(soft), F.when(t.rlike(soft), pick("INCLUDE", "high")).otherwise(pick("BOUNDARY", "low")))
        .when(_has(whole, w["agents"]), F.when(_has(whole, w["companies"]), pick("EXCLUDE", "middle")).otherwise(pick("INCLUDE", "middle")))
        .when(_has(whole, w["general"]), F.when(_has(whole, w["strong"]), pick("EXCLUDE", "middle")).otherwise(pick("BOUNDARY", "low")))
        .when(_has(whole, w["companies"] + w["sectors"]), pick("EXCLUDE", "middle")).otherwise(pick("EXCLUDE", "none"))
    )
    vetoed = (_has(t, w["other_lines"]) & ~_has(t, w["own_lines"])) | _has(t, w["social"])
    short = (first["decision"] == "INCLUDE") & (first["confidence"] == "middle") & (F.length(t) + F.length(m) + F.length(b) < least)
    return F.when((first["decision"] != "EXCLUDE") & vetoed, pick("EXCLUDE", "middle")).when(short, pick("BOUNDARY", "low")).otherwise(first)
