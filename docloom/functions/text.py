"""Text expressions: white space, markup, sentences, references, keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import bound

#: Fixed: the range of Han characters; blanks other than the plain one; replacement and box characters.
HAN, UNUSUAL_BLANKS, GARBLE = "一-鿿", "\\u00a0\\u2002\\u2003\\u2007\\u2009\\u200a\\u202f\\u205f", "[�▇□■◇◆●○◎※→←↑↓＊①-⑩]"
#: Fixed: left-overs of web pages.
NOISE = [
    r"版权所有\s*[©]?.*?(?:京ICP备\d+号|保留所有权利|技术支持).{0,60}", r"网站标识码[:：]?\d{10,}", r"主办单位[:：].{0,80}", r"地址[:：].{0,60}", r"邮编[:：]\d{6}", r"联系电话[:：][0-9\-（）()]{5,20}", r"无障碍浏览.{0,40}",
    r"分享到[:：]?[微信微博QQ空间]*", r"扫一扫.{0,40}", r"打印本页|关闭窗口|返回顶部", r"document\.write\(.*?\)", r"var\s+\w+\s*=.*?;", r"function\s+\w+\s*\(.*?\)\s*\{.*?\}",
]
#: How the left-overs begin: in Han characters, and as a script.
NOISE_HEADS = ["版权所有", "网站标识码", "主办单位", "地址", "邮编", "联系电话", "无障碍浏览", "分享到", "扫一扫", "打印本页", "关闭窗口", "返回顶部"]
SCRIPT_HEADS = r"(?isU)document\.write\(|function\s+\w+\s*\(|var\s+\w+\s*="
#: Fixed: words in the heads of tables; conjunctions that long sentences are cut before; shapes and formats of dates.
TABLE_WORDS = ["序号", "项目", "金额", "单位", "名称", "数量", "备注", "指标", "合计", "总计", "科目", "收入", "支出", "同比", "环比"]
CONJUNCTIONS = ["因为", "所以", "但是", "然而", "于是", "此外", "同时", "因此", "鉴于"]
DATE_FORMATS = [
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d H:m:s"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy/M/d H:m:s"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}年\d{1,2}月\d{1,2}日 \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy年M月d日 H:m:s"), (r"^\d{4}年\d{1,2}月\d{1,2}日$", "yyyy年M月d日"), (r"^\d{8}$", "yyyyMMdd"), (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$", "yyyy-M-d H:m"), (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}$", "yyyy/M/d H:m"),
]


def filled(text: Column) -> Column:
    """Missing values (null, '', N/A, NA, NULL, NONE in any case) as the empty string, others trimmed."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(F.upper(t).isin("", "N/A", "NA", "NULL", "NONE"), "").otherwise(t)


@bound
def _edged(text: Column) -> Column:
    """text without white space at its ends."""
    at_an_end = F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1))).rlike(r"(?U)\s")
    return F.when(at_an_end, F.regexp_replace(text, r"(?U)^\s+|\s+$", "")).otherwise(text)


@bound
def _spaced_plainly(text: Column, keep_lines: bool) -> Column:
    t = F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F\\u200b-\\u200d\\u2060\\ufeff]", "")
    t = F.regexp_replace(t, r"\r\n?", "\n")
    t = F.regexp_replace(t, f"(?<=[{HAN}])[{UNUSUAL_BLANKS}]+(?=[{HAN}])", "")
    t = F.regexp_replace(t, f"[{UNUSUAL_BLANKS}]", " ")
    if keep_lines:
        t = F.regexp_replace(F.regexp_replace(t, "[ \t\\u3000]+", " "), "\n{3,}", "\n\n")
    else:
        t = F.regexp_replace(F.replace(t, F.lit("\n"), F.lit(" ")), "[ \t\\u3000]+", " ")
    touched = f"[\\x00-\\x09\\x0B-\\x1F\\x7F\\u200b-\\u200d\\u2060\\ufeff\\u3000{UNUSUAL_BLANKS}]|  " + ("|\n\n\n" if keep_lines else "|\n")
    return F.when(text.rlike(touched), t).otherwise(text)


def plain_space(text: Column, keep_lines: bool = True) -> Column:
    """Control and zero-width characters removed, line ends unified, unusual blanks deleted between Han characters and made
    plain elsewhere, blanks collapsed. With keep_lines three or more line ends are cut to two, without they become blanks.
    Texts in which there is nothing to change are read once."""
    return _edged(_spaced_plainly(text, keep_lines))


@bound
def _without_noise(text: Column) -> Column:
    han = reduce(Column.__or__, [F.contains(text, F.lit(h)) for h in NOISE_HEADS])
    script = (F.contains(text, F.lit("(")) | F.contains(text, F.lit("="))) & text.rlike(SCRIPT_HEADS)
    t = text
    for pattern in NOISE:
        t = F.regexp_replace(t, f"(?isU){pattern}", " ")
    return F.when(han | script, t).otherwise(text)


def denoised(text: Column, keep_lines: bool = False) -> Column:
    """Text without footers, navigation and script left-overs of web pages (NOISE); texts without any of their heads pass."""
    return plain_space(_without_noise(F.coalesce(text, F.lit(""))), keep_lines)


def clean_body(text: Column, keep_lines: bool = False) -> Column:
    """A body denoised, with plain white space and without replacement and box characters."""
    t = F.regexp_replace(denoised(text, keep_lines), GARBLE, "")
    return _edged(F.regexp_replace(t, "\n{3,}", "\n\n") if keep_lines else t)


def single_lead(text: Column) -> Column:
    """Text whose first paragraph up to a colon stands twice in a row, with one of the two."""
    return F.when(text.rlike(r"(?s)^(.{10,300}?[：:])\1"), F.regexp_replace(F.regexp_replace(text, r"(?s)^(.{10,300}?[：:])\1", "$1"), r"(?U)^\s+", "")).otherwise(text)


def is_table(text: Column) -> Column:
    """Whether a block of text is a table: header words in its first five lines, many bars, or lines with digits of like length."""
    rows = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")
    n, sizes = F.size(rows), F.transform(rows, lambda x: F.length(x))
    total = F.aggregate(sizes, F.lit(0), lambda a, x: a + x)
    headed = F.exists(F.slice(rows, 1, 5), lambda x: x.rlike("|".join(TABLE_WORDS)))
    barred = (F.regexp_count(text, F.lit(r"\|")) >= 2 * n) & (n >= 2)
    even = (F.size(F.filter(rows, lambda x: x.rlike(r"\d"))) >= 0.6 * n) & (n >= 3) & ((F.array_max(sizes) - F.array_min(sizes)) / F.greatest(total / n, F.lit(1.0)) < 0.35)
    return F.when(n > 0, headed | barred | even).otherwise(F.lit(False))


def broken_up(text: Column) -> Column:
    """A line end after each sentence end and a blank after commas, semicolons and colons."""
    return F.regexp_replace(F.regexp_replace(text, "([。！？])", "$1\n"), "([，；、,:])", "$1 ")


def spaced(text: Column) -> Column:
    """A blank between Han characters and Latin letters or digits."""
    return F.regexp_replace(F.regexp_replace(text, f"([{HAN}])([A-Za-z0-9])", "$1 $2"), f"([A-Za-z0-9])([{HAN}])", "$1 $2")


def cut_long(text: Column) -> Column:
    """Pieces of a text over 50 characters without any sentence end, cut on both sides of conjunctions after a comma or
    semicolon (the whole text if there are none); empty for other texts."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    marked = F.split(F.regexp_replace(t, f"(?<=[，,;；])({'|'.join(CONJUNCTIONS)})", "\x01$1\x01"), "\x01")
    parts = F.filter(F.transform(marked, lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")
    return F.when((t != "") & ~t.rlike("[。！？]") & (F.length(t) > 50), parts).otherwise(F.array().cast("array<string>"))


def repaired(text: Column) -> Column:
    """Text with sentences on lines of their own, spaced; tables are left as they are."""
    t = plain_space(F.coalesce(text, F.lit("")), keep_lines=False)
    t = F.when(F.contains(t, F.lit("<")) & F.contains(t, F.lit(">")), unmarked(t)).otherwise(t)
    return F.when(is_table(text), text).otherwise(plain_space(spaced(broken_up(t))))


def unbroken(text: Column) -> Column:
    """Runs of over 30 letters, digits and Han characters without any mark or blank."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[{HAN}A-Za-z0-9]{{31,}}"), 0)


def unmarked(html: Column) -> Column:
    """Text of HTML: comments, scripts and styles dropped, block ends as line ends, tags dropped, five entities decoded."""
    t = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(p|div|li|tr|h[1-6])>", "\n")
    t = F.regexp_replace(t, r"<[^>]+>", "")
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(plain))
    return t


def paragraphs(html: Column) -> Column:
    """Trimmed lines of the text of HTML that are not empty."""
    return F.filter(F.transform(F.split(unmarked(html), "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\r]+", " "))), lambda x: x != "")


def sentences(text: Column) -> Column:
    """Pieces that end with . ! ? or a line end, trimmed, none empty."""
    return F.filter(F.transform(F.split(F.regexp_replace(text, r"([.!?。！？])[ \t\r\n\f]*", "$1\n"), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def date_normal(text: Column) -> Column:
    """A date in one of DATE_FORMATS as yyyy-MM-dd, with HH:mm:ss unless that is midnight; else the first date that stands in
    the text; else, and for dates that do not exist, the text as it is. Null counts as empty."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    at = F.coalesce(*(F.when(t.rlike(shape), F.try_to_timestamp(t, F.lit(form))) for shape, form in DATE_FORMATS))
    found = [F.regexp_extract(t, r"(\d{4})[-/年.](\d{1,2})[-/月.](\d{1,2})", i) for i in (1, 2, 3)]
    day = F.try_to_timestamp(F.concat_ws("-", *found), F.lit("yyyy-M-d"))
    midnight = F.date_format(at, "HH:mm:ss") == "00:00:00"
    return F.when(at.isNotNull() & midnight, F.date_format(at, "yyyy-MM-dd")).when(at.isNotNull(), F.date_format(at, "yyyy-MM-dd HH:mm:ss")).otherwise(F.coalesce(F.date_format(F.when(found[0] != "", day), "yyyy-MM-dd"), t))


def quoted(text: Column, least: int = 2, most: int = 80) -> Column:
    """Different titles in book-title marks, first seen first, of `least` to `most` characters."""
    found = F.regexp_extract_all(text, F.lit("《([^《》]+)》"), 1)
    return F.array_distinct(F.filter(found, lambda x: F.length(x).between(least, most)))


def year_of(text: Column) -> Column:
    """The first four digits in a row; 未知 if there are none."""
    found = F.regexp_extract(F.coalesce(text, F.lit("")), r"(\d{4})", 1)
    return F.when(found == "", "未知").otherwise(found)


def redacted(url: Column) -> Column:
    """A URL without its query and fragment; other texts as they are."""
    return F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]"), F.regexp_replace(url, r"[?#].*$", "")).otherwise(url)


def safe_name(name: Column, fallback: str = "unnamed") -> Column:
    """A name without characters that paths cannot have, outer blanks and final dots; `fallback` if nothing is left."""
    t = F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"""[\\/:*?"<>|]+""", "_")), r"\.+$", "")
    return F.when(t == "", fallback).otherwise(t)


def alike(a: Column, b: Column, least: float = 0.82, inner: int = 6) -> Column:
    """Whether two keys of titles stand for one document: equal, one in the other (`inner` characters or more), or alike.

    Likeness is 1 - edits / length of the longer one, by Levenshtein's distance; empty keys are never alike.
    """
    filled_ = (F.length(a) > 0) & (F.length(b) > 0)
    short, long_ = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    held = (F.length(short) >= inner) & F.contains(long_, short)
    near = 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1)) >= least
    return F.coalesce(filled_ & ((a == b) | held | near), F.lit(False))


def confusions_replaced(text: Column, confusions: dict[str, str]) -> Column:
    """Text with wrongly read strings replaced in one pass; of two that begin at a place the longer counts."""
    import re

    keys = sorted(confusions, key=len, reverse=True)
    pattern = "(" + "|".join(map(re.escape, keys)) + ")"
    right = F.create_map(*(F.lit(x) for pair in confusions.items() for x in pair))
    gaps, found = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), 1)
    return F.array_join(F.zip_with(gaps, F.transform(found, lambda k: F.element_at(right, k)), lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))), "")


def controlled(raw: Column, values: dict[str, str], otherwise: str) -> Column:
    """Struct (value, known): a controlled value by the text without white space, or the first key that it holds; else `otherwise`."""
    t = F.regexp_replace(F.coalesce(raw, F.lit("")), r"(?U)\s+", "")
    exact = F.coalesce(*(F.when(t == k, F.lit(v)) for k, v in values.items()))
    held = F.coalesce(*(F.when(F.contains(t, F.lit(k)), F.lit(v)) for k, v in values.items() if k))
    value = F.coalesce(exact, held)
    return F.struct(F.coalesce(value, F.lit(otherwise)).alias("value"), value.isNotNull().alias("known"))


def without_repeat(text: Column, least: int = 8, most: int = 40) -> Column:
    """A title cut where its own beginning (`least` to `most` characters, the longest that is found) stands again."""
    at = F.get(F.filter(F.transform(F.sequence(F.lit(most), F.lit(least), F.lit(-1)), lambda n: F.when((n <= F.length(text) - least) & (F.instr(F.substr(text, n + 1), F.substr(text, F.lit(1), n)) > 0), F.instr(F.substr(text, n + 1), F.substr(text, F.lit(1), n)) + n)), lambda x: x.isNotNull()), 0)
    return F.when(at.isNotNull(), F.substr(text, F.lit(1), at - 1)).otherwise(text)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays of numbers; 0 if one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def l2(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays of numbers."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: (p.cast("double") - q.cast("double")) * (p.cast("double") - q.cast("double"))), F.lit(0.0), lambda s, v: s + v))


def date_strict(text: Column) -> Column:
    """A date at the start of a text as yyyy-MM-dd, or yyyy-MM where no day follows; '' for all other texts. Days are not
    checked against the calendar."""
    t = F.trim(F.coalesce(text, F.lit("")))
    day, month = r"^(\d{4})[-年/](\d{1,2})[-月/](\d{1,2})", r"^(\d{4})[-年/](\d{1,2})"
    part = lambda p, i: F.lpad(F.regexp_extract(t, p, i), 2, "0")
    whole = F.concat_ws("-", F.regexp_extract(t, day, 1), part(day, 2), part(day, 3))
    return F.when(t.rlike(day), whole).when(t.rlike(month), F.concat_ws("-", F.regexp_extract(t, month, 1), part(month, 2))).otherwise("")
