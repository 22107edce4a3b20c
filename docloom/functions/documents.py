"""What a document is by its title; titles of scanned policies; numerals; bytes of unknown encoding; who settles an entry."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import bound

#: Fixed: kinds of documents, official ones, normative ones and others with their groups; other names of two of them.
OFFICIAL = ["命令", "决定", "决议", "公报", "公告", "通告", "意见", "通知", "通报", "报告", "请示", "批复", "议案", "纪要", "令", "函"]
NORMATIVE = ["条例", "办法", "细则", "规则", "规定", "法"]
OTHERS = {
    "规划部署": ["规划", "纲要", "计划", "方案", "要点", "安排", "预案"], "制度治理": ["章程", "制度", "准则", "规范", "守则", "公约", "规程"], "说明解释": ["说明", "解读", "指南", "指引", "问答", "释义"],
    "答复处理": ["答复", "复函", "意见书", "告知书", "决定书"], "信息数据": ["白皮书", "蓝皮书", "年报", "专报", "信息", "动态", "统计"], "文书凭证": ["公示", "证明", "凭证"], "合同协议": ["合同", "协议", "备忘录"],
}
SAME_TYPE = {"令": "命令", "法": "法律"}
GROUPS = {**{t: "公文" for t in OFFICIAL}, **{t: "法规类型" for t in NORMATIVE}, **{t: f"其他_{g}" for g, ts in OTHERS.items() for t in ts}}
#: Fixed: page numbers, openings of attachments, heads of tables and dates in titles of scanned policies.
PAGE = r"第\s*\d+\s*页\s*(?:[（(]\s*共\s*\d+\s*页\s*[）)])?|[（(]\s*共\s*\d+\s*页\s*[）)]|(?<!\d)-\s*\d+\s*-(?!\d)"
ATTACHED = r"^\s*附\s*件\s*[0-9一二三四五六七八九十]*\s*[：:、.．]?\s*"
TABLE_HEAD = "序号|责任分类|法律法规相关内容|行政责任|处罚依据|违规行为|条款内容"
SIGNED = r"\d{4}\s*年\s*\d{1,2}\s*月\s*\d{1,2}\s*日"
DIGITS, UNITS = "零一二三四五六七八九", ["千", "百", "十", ""]


def _by_length() -> list[str]:
    """All kinds, longer ones first, so that the longest one that fits counts; equally long ones in their order."""
    return sorted([*OFFICIAL, *NORMATIVE, *(t for ts in OTHERS.values() for t in ts)], key=lambda t: -len(t))


@bound
def document_type(title: Column) -> Column:
    """Struct (doc_type, group, match_pos) of a title: the longest kind that it ends with, in brackets at its end first; else
    the longest that it holds. match_pos: end_bracket, end, middle, not_found, empty_title."""
    t = F.trim(F.coalesce(title, F.lit("")))
    return _kind_of(t, F.trim(F.regexp_extract(t, r"^.*?[（(]([^（）()]+)[）)]\s*$", 1)))


@bound
def _kind_of(t: Column, inner: Column) -> Column:
    first = lambda test: F.coalesce(*(F.when(test(F.lit(k)), F.lit(k)) for k in _by_length()))
    return _placed(F.struct(F.when(inner != "", first(lambda k: F.endswith(inner, k))).alias("bracket"), first(lambda k: F.endswith(t, k)).alias("end"), first(lambda k: F.contains(t, k)).alias("middle"), (t == "").alias("empty")))


@bound
def _placed(found: Column) -> Column:
    kind = F.coalesce(found["bracket"], found["end"], found["middle"])
    place = F.when(found["empty"], "empty_title").when(found["bracket"].isNotNull(), "end_bracket").when(found["end"].isNotNull(), "end").when(found["middle"].isNotNull(), "middle").otherwise("not_found")
    groups = F.create_map(*(F.lit(x) for pair in GROUPS.items() for x in pair))
    group = F.coalesce(F.try_element_at(groups, kind), F.when(~found["empty"], "其他未分类"))
    return F.struct(kind.alias("doc_type"), group.alias("group"), place.alias("match_pos"))


def type_normal(value: Column, title: Column) -> Column:
    """A kind as the controlled list has it: the given one, or that of the title where it is missing or unknown; '' without any."""
    given = F.trim(F.coalesce(value, F.lit("")))
    same = lambda c: F.coalesce(*(F.when(c == k, v) for k, v in SAME_TYPE.items()), c)
    known = same(given).isin([*GROUPS, *SAME_TYPE.values()])
    return F.when(known, same(given)).otherwise(F.coalesce(same(document_type(title)["doc_type"]), F.lit("")))


@bound
def policy_title(raw: Column) -> Column:
    """The title in a file name or a scan: without attachment openings, a lone letter before Han characters, page numbers, and
    what follows a head of a table, a date, or a second beginning of the title. Under four letters the raw text stays."""
    blank = r"[\s　]+"
    plain = F.trim(F.regexp_replace(F.coalesce(raw, F.lit("")), blank, " "))
    t = F.trim(F.regexp_replace(F.regexp_replace(plain, ATTACHED, ""), r"^[A-Za-zⅠⅡⅢⅣⅤ](?=[一-龥])", ""))
    t = F.regexp_replace(F.regexp_replace(t, PAGE, " "), f"(?s)(?<=..)(?:{TABLE_HEAD}).*$", "")
    t = F.regexp_replace(t, f"(?s)(?<=.{{6}})(?:{SIGNED}).*$", "")
    t = F.regexp_replace(t, r"(?s)^((.{8,40}).*?)\2.*$", "$1")
    t = F.regexp_replace(F.regexp_replace(t, blank, " "), r"^[ ：:、，,。.·\-—_]+|[ ：:、，,。.·\-—_]+$", "")
    return F.when(F.length(t) >= 4, t).otherwise(plain)


@bound
def chinese_number(number: Column) -> Column:
    """A number from 1 to 9999 in Chinese numerals; '' for others."""
    digits = F.lpad(number.cast("string"), 4, "0")
    digit = lambda i: F.substr(digits, F.lit(i + 1), F.lit(1)).cast("int")
    parts = [F.when(digit(i) > 0, F.concat(F.substr(F.lit(DIGITS), digit(i) + 1, F.lit(1)), F.lit(u))).otherwise("零") for i, u in enumerate(UNITS)]
    joined = F.regexp_replace(F.regexp_replace(F.concat(*parts), "零+", "零"), "^零|零$", "")
    return F.when(number.between(1, 9999), F.regexp_replace(joined, "^一十", "十")).otherwise("")


#: Characters that wrong decoding leaves: replacements, controls, private use.
GARBLED = "[\\ufffd\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x80-\\x9f\\ue000-\\uf8ff]"


def decoded(files: DataFrame, content: str, hint: str | None = None, row: str = "path") -> DataFrame:
    """(row, text, encoding, garbled) of bytes: decoded by the hint, if they are that; else as UTF-8, if they are; else as
    GB18030 or Big5, whichever leaves fewer garbled characters, wrong bytes replaced. garbled: their share of the text.

    Null content has null text; byte order marks are no text.
    """

    def one(data: bytes, told: str | None) -> tuple[str, str]:
        for name in (told, "utf-8-sig"):
            try:
                if name:
                    return data.decode(name), "utf-8" if name == "utf-8-sig" else name.lower()
            except (UnicodeDecodeError, LookupError):
                continue
        tried = [(data.decode(name, "replace"), name) for name in ("gb18030", "big5")]
        return min(tried, key=lambda t: sum(c == "\ufffd" or "\ue000" <= c <= "\uf8ff" for c in t[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = batch.column(2).to_pylist()
            got = [(None, None) if b is None else one(b, t and t.strip()) for b, t in zip(batch.column(1).to_pylist(), told)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in got], pa.string()), pa.array([e for _, e in got], pa.string())], names=["row", "text", "encoding"])

    rows = files.select(F.col(row).alias("row"), F.col(content).cast("binary").alias("content"), (F.col(hint) if hint else F.lit(None)).cast("string").alias("hint"))
    found = rows.mapInArrow(run, f"row {dict(rows.dtypes)['row']}, text string, encoding string")
    return found.select(F.col("row").alias(row), "text", "encoding", F.round(F.regexp_count("text", F.lit(GARBLED)) / F.greatest(F.length("text"), F.lit(1)), 4).alias("garbled"))


#: Fixed: words that tell that an entry of a queue has settled itself.
SETTLED = ["已修复", "已处置", "已闭环", "已落地", "（已修）", "已修："]


def triage(kind: Column, subject: Column, payload: Column, settled: list[str] | None = None) -> Column:
    """auto or human: sums of boundary cases and manual breaks that say that they are settled need no one."""
    said = F.concat(F.coalesce(subject, F.lit("")), F.coalesce(payload, F.lit(""))).rlike("|".join(settled or SETTLED))
    auto = ((kind == "relevance_boundary") & F.coalesce(subject.startswith("summary:"), F.lit(False))) | ((kind == "trigger_manual_breakpoint") & said)
    return F.when(F.coalesce(auto, F.lit(False)), "auto").otherwise("human")
