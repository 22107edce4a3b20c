"""Document numbers, titles and issuing bodies as keys.

All functions take and return columns; null counts as empty. Word lists, marks and number formats are fixed values.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: words that stand for a missing value; the last ones in any case of letters.
NULLS = ["", "n/a", "na", "无", "-", "none", "null", "未注明", "不详"]
ASCII_NULLS = ["n/a", "na", "none", "null", "n.a."]
#: Fixed: what a document number drops, version marks at a title's end, what the loose and the strict title key drop.
DOCNO_DROPS = r"(?U)[〔\[\]（）()〕\s]"
TITLE_SUFFIX = r"(?U)[（(](已废止|已失效|试行|修订)[）)]\s*$"
TITLE_DROPS = r"""(?U)[\s（）()、《》"'，。：:；;,.!！?？_/-]"""
STRICT_DROPS = r'(?U)[《》"“”\s]'
#: Fixed: what titles quoted in running text drop besides, and the marks of versions, editions and drafts.
QUOTE_DROPS = "[<>〈〉“”‘’′`]"
VERSION = r"(?U)[（(]\s*(?:(?:19|20)\d{2}\s*年?\s*)?(?:修订版?|修正版?|版|年修订|年修正|试行|暂行|征求意见稿|草案|送审稿)\s*[)）]|[-_\s]?[Vv]\d+(?:\.\d+)*$"
COUNTRY = ["中华人民共和国", "中国"]
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}
#: Fixed: Chinese digits and units.
DIGITS = {"零": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
UNITS = {"十": 10, "百": 100, "千": 1000}
#: Fixed: bodies that may stand before a code, the codes that number documents, and bodies that number orders.
ISSUERS = ["中国银行业监督管理委员会", "中国证券监督管理委员会", "中国保险监督管理委员会", "中国人民银行", "财政部", "国家税务总局", "住房和城乡建设部", "金融监管总局", "国家金融监督管理总局", "中国银行保险监督管理委员会"]
CODES = [
    "国家金融监督管理总局公告", "中国银行保险监督管理委员会公告", "中国证券监督管理委员会公告", "中国保险监督管理委员会公告", "中国人民银行公告", "财政部公告", "国家税务总局公告", "金融监管总局公告", "银保监会公告", "证监会公告", "公告",
    "金监规", "金监总局令", "金规", "金发", "金办发", "金办便函", "银保监发", "银保监办发", "银保监办便函", "银保监规", "银监发", "银监办发", "银监办便函", "银监规", "保监发", "保监厅发", "保监厅函", "保监办发", "保监办函", "保监中介", "保监财会", "保监统信", "保监稽查", "保监国际", "保监消保", "人身险部函",
    "银发", "银办发", "银函", "财发", "财税", "财库", "财会", "财金", "财监", "财综", "财办", "财建", "国发", "国办发", "建房", "发改", "工信部",
    "中国人民银行令", "国家金融监督管理总局令", "中国银行保险监督管理委员会令", "中国保险监督管理委员会令", "国务院令", "主席令", "银监会令", "保监会令", "证监会令", "财政部令",
]
ORDERING = ["国务院", "主席", "中国人民银行", "财政部", "国家金融监督管理总局", "中国银行保险监督管理委员会", "中国保险监督管理委员会", "中国证券监督管理委员会", "中国银行业监督管理委员会", "金融监管总局", "银监会", "保监会", "证监会", "银保监会"]
#: Fixed: forms of a document number, the first that stands in a text counts. N stands for an ordinal, Y for a year in brackets.
_N, _Y, _HAN = r"[一二三四五六七八九十百\d]+", r"[〔\[]\s*\d{4}\s*[〕\]]", r"一-龥"
FORMS = [
    rf"中华人民共和国国务院令\s*第\s*{_N}\s*号", rf"(?<![{_HAN}])国务院令\s*第\s*{_N}\s*号", rf"中华人民共和国主席令\s*[（(]?\s*第?\s*{_N}\s*号[）)]?", rf"国(?:办)?发\s*{_Y}\s*\d+\s*号", rf"国家金融监督管理总局令\s*{_Y}\s*第?\s*{_N}\s*号",
    rf"(?:金规|金发|金办发|金办便函|金监规|金监总局令|银保监发|银保监办发|银保监办便函|银保监规|保监发|保监厅发|保监厅函|保监办发|保监办函|保监中介|保监财会|保监统信|保监稽查|保监国际|保监消保|人身险部函|银发|银办发|银函|人民银行令)\s*{_Y}\s*\d+\s*号",
    rf"[{_HAN}]{{2,}}?令\s*\d{{4}}\s*年\s*第\s*{_N}\s*号", rf"中国人民银行令\s*{_Y}\s*第?\s*{_N}\s*号", rf"公开市场业务公告\s*{_Y}\s*第?\s*{_N}\s*号", rf"[{_HAN}\s]{{2,40}}?公告\s*\d{{4}}\s*年\s*第?\s*{_N}\s*号",
    rf"财政部(?:、[{_HAN}]{{2,20}}?)*?令\s*[（(]?第?\s*{_N}\s*号[）)]?", rf"财(?:发|税|库|会|金|监|综|办)\s*{_Y}\s*\d+\s*号", rf"[{_HAN}]{{2,14}}?(?:部|委|局|署|总局|委员会)令\s*{_Y}\s*第?\s*{_N}\s*号", rf"[{_HAN}]{{2,10}}?(?:发|函|规|令|便函)\s*{_Y}\s*\d+\s*号",
]
_ORDINAL = r"[一二三四五六七八九十百千两零\d]+"
CODED = rf"(?:{'|'.join(ISSUERS)})*(?:{'|'.join(CODES)})\s*[（(]?\s*(?:{_Y}|\d{{4}}\s*年)\s*第?\s*\d+\s*号"
ORDERED = rf"(?:{'|'.join(ORDERING)})\s*令\s*[（(]?\s*第?\s*{_ORDINAL}\s*号"
ANY_ORDER = rf"[{_HAN}]{{1,18}}?令\s*[（(]?\s*第?\s*{_ORDINAL}\s*号"
SHAPE = rf"令\s*第?\s*{_N}\s*号|令\s*\d{{4}}\s*年\s*第?\s*{_N}\s*号|〔\d{{4}}〕\s*第?\s*\d+\s*号|\[\d{{4}}\]\s*第?\s*\d+\s*号|公告\s*\d{{4}}\s*年\s*第?\s*{_N}\s*号"
ISSUED_IN_BODY = r"[（(][^（）()]{0,30}?(?:国务院令|主席令|公告|令)\s*第?\s*\d+\s*号[^（）()]{0,8}?(?:发布|公布|施行)[）)]"
ABOLISHING = ["废止", "不再执行", "停止执行", "同时作废", "自行失效"]
#: Fixed: names of bodies and the full names that they stand for.
BODIES = {
    "国家税务总局": "国家税务总局", "财政部": "财政部", "中国人民银行": "中国人民银行", "国家外汇管理局": "国家外汇管理局", "中国银行业监督管理委员会": "中国银行业监督管理委员会", "中国证券监督管理委员会": "中国证券监督管理委员会", "中国保险监督管理委员会": "中国保险监督管理委员会",
    "中国银行保险监督管理委员会": "中国银行保险监督管理委员会", "国家金融监督管理总局": "国家金融监督管理总局", "国家发展和改革委员会": "国家发展和改革委员会", "工业和信息化部": "工业和信息化部", "住房和城乡建设部": "住房和城乡建设部", "应急管理部": "应急管理部", "商务部": "商务部", "公安部": "公安部",
    "司法部": "司法部", "交通运输部": "交通运输部", "农业农村部": "农业农村部", "国家市场监督管理总局": "国家市场监督管理总局", "海关总署": "海关总署", "国务院办公厅": "国务院办公厅", "国务院": "国务院", "银保监会": "中国银行保险监督管理委员会", "银监会": "中国银行业监督管理委员会",
    "证监会": "中国证券监督管理委员会", "保监会": "中国保险监督管理委员会", "人民银行": "中国人民银行", "外汇局": "国家外汇管理局", "金融监管总局": "国家金融监督管理总局", "发改委": "国家发展和改革委员会", "工信部": "工业和信息化部", "住建部": "住房和城乡建设部",
}


def bound(build: Callable[..., Column]) -> Callable[..., Column]:
    """build with each column that it gets evaluated once, however often the result uses it.

    Columns are expressions: written out, a chain of steps that each use their input several times grows with the product of
    these numbers. Here each input is the variable of a lambda over an array of one.
    """

    @functools.wraps(build)
    def run(*args: object) -> Column:
        def nest(i: int, got: list) -> Column:
            if i == len(args):
                return build(*got)
            if not isinstance(args[i], Column):
                return nest(i + 1, [*got, args[i]])
            return F.get(F.transform(F.array(args[i]), lambda value: nest(i + 1, [*got, value])), 0)

        return nest(0, [])

    return run


def _stripped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")


@bound
def _replaced(text: Column, pattern: str, of: object) -> Column:
    """text with each match of pattern replaced by of(its first group)."""
    gaps, found = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), 1)
    return F.array_join(F.zip_with(gaps, F.transform(found, of), lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))), "")


def _entities(text: Column) -> Column:
    return reduce(lambda t, e: F.regexp_replace(t, f"(?i){e[0]}", e[1]), ENTITIES.items(), text)


@bound
def ordinal(text: Column) -> Column:
    """Digits of a Chinese ordinal below ten thousand; other texts as they are."""
    value = lambda c, of: F.coalesce(*(F.when(c == k, v) for k, v in of.items()))
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("digit"))

    def step(a: Column, c: Column) -> Column:
        digit, unit = value(c, DIGITS), value(c, UNITS)
        grown = a["sum"] + F.when(a["digit"] == 0, unit).otherwise(a["digit"] * unit)
        return F.struct(F.when(unit.isNotNull(), grown).otherwise(a["sum"]).alias("sum"), F.when(unit.isNotNull(), 0).otherwise(F.coalesce(digit, F.lit(0))).alias("digit"))

    number = F.aggregate(F.split(text, ""), start, step, lambda a: a["sum"] + a["digit"])
    return F.when(text.rlike("^[零一二两三四五六七八九十百千]+$") & (number > 0), number.cast("string")).otherwise(text)


@bound
def is_null_word(text: Column) -> Column:
    """Whether a stripped text stands for a missing value."""
    return text.isin(NULLS) | F.lower(text).isin(ASCII_NULLS)


@bound
def docno(text: Column) -> Column:
    """A document number as a key: brackets and white space removed, final ordinal marks dropped; null words are empty."""
    return _docno(_stripped(text))


@bound
def _docno(t: Column) -> Column:
    return F.when(is_null_word(t), "").otherwise(F.regexp_replace(F.regexp_replace(t, DOCNO_DROPS, ""), "号+$", ""))


@bound
def docno_strong(text: Column) -> Column:
    """docno after entities are decoded, full-width letters and digits made plain, and Chinese ordinals made digits."""
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
    t = F.translate(_entities(_stripped(text)), wide, "".join(chr(c) for c in range(0x21, 0x7F)) + " ")
    return docno(_replaced(F.regexp_replace(t, r"(?U)\s+", ""), "第([零一二三四五六七八九十百]+)号", lambda x: F.concat(F.lit("第"), ordinal(x), F.lit("号"))))


@bound
def signature(text: Column) -> Column:
    """Year and number at the end of a document number, joined; null if there are none."""
    return _signature(docno(text))


@bound
def _signature(key: Column) -> Column:
    year, number = (F.regexp_extract(key, r"(\d{4})\D*?(\d{1,4})$", i) for i in (1, 2))
    return F.when(year != "", F.concat(year, F.lit("-"), number))


@bound
def title(text: Column) -> Column:
    """A title as a loose key: a final version mark, white space and punctuation removed, lower case."""
    t = _stripped(text)
    return F.when(t.isin(NULLS), "").otherwise(F.lower(F.regexp_replace(F.regexp_replace(t, TITLE_SUFFIX, ""), TITLE_DROPS, "")))


@bound
def title_strict(text: Column) -> Column:
    """A title as an exact key: only the final version mark, book-title and quotation marks and white space are removed."""
    t = _stripped(text)
    return F.when(t.isin(NULLS), "").otherwise(F.regexp_replace(F.regexp_replace(t, TITLE_SUFFIX, ""), STRICT_DROPS, ""))


def title_quoted(text: Column) -> Column:
    """title_strict of a title quoted in running text: entities decoded, angle brackets, quotes and white space removed first."""
    return title_strict(F.regexp_replace(F.regexp_replace(_stripped(_entities(F.coalesce(text, F.lit("")))), QUOTE_DROPS, ""), r"(?U)\s+", ""))


def without_version(text: Column) -> Column:
    """A title without marks of versions, editions and drafts, up to four on top of each other."""
    return reduce(lambda t, _: _stripped(F.regexp_replace(t, VERSION, "")), range(4), _stripped(text))


@bound
def without_country(text: Column) -> Column:
    """A title without the country's name before it, if more than one character is left."""
    t = _stripped(text)
    cut = lambda p: F.when(t.startswith(p) & (F.length(t) > len(p) + 1), F.substr(t, F.lit(len(p) + 1)))
    return F.coalesce(*map(cut, COUNTRY), t)


@bound
def docno_shape(text: Column) -> Column:
    """Whether a text has the shape of a document number."""
    t = _stripped(text)
    return ~F.upper(t).isin("", "N/A", "NA", "NULL") & t.rlike(f"(?U){SHAPE}")


@bound
def _located(text: Column) -> Column:
    """The part of a text that is a document number: a known code, a known order, any order, else the form that begins last."""
    first = lambda p: F.nullif(F.regexp_extract(text, f"(?U)({p})", 1), F.lit(""))
    places = F.array(*(F.struct(F.regexp_instr(text, F.lit(f"(?U){p}")).alias("at"), F.lit(-i).alias("i"), F.regexp_extract(text, f"(?U)({p})", 1).alias("found")) for i, p in enumerate(FORMS)))
    return F.coalesce(first(CODED), first(ORDERED), first(ANY_ORDER), F.nullif(F.array_max(places)["found"], F.lit("")), text)


def docno_normal(text: Column) -> Column:
    """A document number in its normal form: what stands around it cut off, brackets, digits and ordinals made alike."""
    t = F.translate(_stripped(text), "０１２３４５６７８９（）", "0123456789()")
    t = F.translate(F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", " "), r"(?U)\[(\d{4})\]\s*(\d+)", "〔$1〕$2"), "[]", "〔〕")
    t = _located(F.regexp_replace(t, rf"^[^{_HAN}A-Za-z0-9]+", ""))
    order = rf"(?U)令\s*[（(]?\s*(第?\s*{_ORDINAL})\s*号[）)]?"
    t = _replaced(t, order, _order)
    for name in ("国务院令", "主席令"):
        t = F.regexp_replace(t, f"(?<!中华人民共和国){name}", f"中华人民共和国{name}")
    t = F.regexp_replace(F.regexp_replace(t, r"(?U)(\d{4})\s*年\s*第?\s*(\d+)号", "〔$1〕$2号"), r"(?U)〔(\d{4})〕\s*第?\s*(\d+)号", "〔$1〕$2号")
    return F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", ""), r"(?Us)^([^号]+号)[^\d）)\]].*$", "$1")


def _order(x: Column) -> Column:
    return F.concat(F.lit("令"), F.when(x.startswith("第"), "第").otherwise(""), ordinal(F.regexp_replace(x, r"(?U)^第|\s", "")), F.lit("号"))


@bound
def docno_in(text: Column) -> Column:
    """The first document number of a text, by the order of FORMS, in its normal form; empty if there is none."""
    t = F.coalesce(text, F.lit(""))
    return docno_normal(F.coalesce(*(F.when(t.rlike(f"(?U){p}"), F.regexp_extract(t, f"(?U)({p})", 1)) for p in FORMS), F.lit("")))


@bound
def docno_in_title(text: Column) -> Column:
    """A title's document number: one in brackets before any other."""
    inner = F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?U)[（(]\s*([{_HAN}A-Za-z0-9〔〕\[\]第号、，,和与及\s]{{4,60}}?号)\s*[）)]", 1)
    return F.coalesce(F.nullif(docno_in(inner), F.lit("")), docno_in(text))


@bound
def docno_in_body(text: Column) -> Column:
    """The number under which a text says that it was issued itself: (… No. N issued); others that it cites do not count."""
    return docno_normal(F.regexp_extract(F.coalesce(text, F.lit("")), f"(?U)({ISSUED_IN_BODY})", 1))


@bound
def in_abolishing(text: Column, number: Column) -> Column:
    """Whether a number stands in a text as that of another document: inside a quoted title, or after one within 60
    characters in a sentence that abolishes."""
    t, n = F.coalesce(text, F.lit("")), F.coalesce(number, F.lit(""))
    at = F.when(n == "", 0).when(F.instr(t, n) > 0, F.instr(t, n)).otherwise(F.instr(t, F.translate(n, "〔〕", "[]")))
    return _abolished(t, at)


@bound
def _abolished(text: Column, at: Column) -> Column:
    return (at > 0) & _abolished_between(F.substr(text, F.lit(1), at - 1), F.substr(text, at))


@bound
def _abolished_between(head: Column, rest: Column) -> Column:
    sentence = F.concat(F.regexp_extract(head, r"([^。；\n]*)$", 1), F.regexp_extract(rest, r"^([^。；\n]*)", 1))
    return head.rlike("(?s)《[^》]*$") | (sentence.rlike("|".join(ABOLISHING)) & F.contains(F.right(head, F.lit(60)), F.lit("》")))


@bound
def bodies(text: Column) -> Column:
    """Full names of the bodies named in a text, each once, in the order of the text; of two names at a place the longer counts."""
    names = "|".join(sorted(BODIES, key=len, reverse=True))
    full = F.create_map(*(F.lit(x) for pair in BODIES.items() for x in pair))
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({names})"), 1), lambda x: F.element_at(full, x)))


@bound
def with_all_bodies(number: Column, title_: Column) -> Column:
    """The number of a joint notice with all bodies that its title names before 关于, if these are more than it has itself."""
    tail = F.regexp_extract(number, r"(?U)(公告\s*\d{4}\s*年\s*第?\s*\d+\s*号)\s*$", 1)
    named = bodies(F.split(F.coalesce(title_, F.lit("")), "关于")[0])
    more = F.size(named) > F.size(bodies(F.regexp_replace(number, r"(?U)公告\s*\d{4}\s*年\s*第?\s*\d+\s*号\s*$", "")))
    return F.when((tail != "") & more, F.concat(F.array_join(named, ""), tail)).otherwise(number)


@bound
def docno_resolved(raw: Column, title_: Column, body: Column) -> Column:
    """A record's document number: its own field if it has the shape and is not one that the body abolishes, else the
    title's, else the one under which the body was issued."""
    return _resolved(docno_normal(raw), docno_in_title(title_), title_, body)


@bound
def _resolved(own: Column, titled: Column, title_: Column, body: Column) -> Column:
    return F.when(docno_shape(own) & ~in_abolishing(body, own), with_all_bodies(own, title_)).when(titled != "", with_all_bodies(titled, title_)).otherwise(docno_in_body(body))


def docno_signatures(text: Column, least: int = 6) -> Column:
    """The different signatures (year and number) of bracketed document numbers in a text, with or without an issuer, in order."""
    mark = r"[〔\[(（]\s*(\d{4})\s*[〕\])）]\s*(\d{1,4})\s*号"
    t = F.coalesce(text, F.lit(""))
    pairs = F.zip_with(F.regexp_extract_all(t, F.lit(mark), 1), F.regexp_extract_all(t, F.lit(mark), 2), lambda y, n: F.concat(y, n))
    return F.array_distinct(F.filter(pairs, lambda s: F.length(s) >= least))
