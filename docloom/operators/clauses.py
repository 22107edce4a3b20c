"""Clauses of legal-style texts: lines, chapters, articles, items, checks, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed: numerals that number chapters and articles, and the marks themselves.
NUMERAL = "[0-9]+|[零〇一二两三四五六七八九十百千]+"
CHAPTER, ARTICLE = rf"^第\s*({NUMERAL})\s*章", rf"^第\s*({NUMERAL})\s*条"
DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
UNITS = {"十": 10, "百": 100, "千": 1000}


def numeral(text: Column) -> Column:
    """An Arabic or Chinese numeral below ten thousand as an int; null for other texts."""
    value = lambda c, of: F.coalesce(*(F.when(c == k, v) for k, v in of.items()))
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("digit"))

    def step(a: Column, c: Column) -> Column:
        digit, unit = value(c, DIGITS), value(c, UNITS)
        grown = a["sum"] + F.when((a["digit"] == 0) & (unit == 10), 10).otherwise(a["digit"] * unit)
        return F.struct(F.when(unit.isNotNull(), grown).otherwise(a["sum"]).alias("sum"), F.when(unit.isNotNull(), 0).otherwise(F.coalesce(digit, F.lit(0))).alias("digit"))

    chinese = F.aggregate(F.split(text, ""), start, step, lambda a: a["sum"] + a["digit"])
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int")).when(text.rlike("^[零〇一二两三四五六七八九十百千]+$"), chinese)


def lines(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, line, text): trimmed lines that are not empty, with their place in the text."""
    rows = docs.select(F.col(doc).alias("doc"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line", "text"))
    return rows.select("doc", "line", F.trim("text").alias("text")).where("text <> ''")


def articles(docs: DataFrame, doc: str = "doc_id", text: str = "text", article: str = ARTICLE, chapter: str = CHAPTER) -> DataFrame:
    """(doc, article, mark, number, chapter, chapter_mark, body) of each article, numbered from 1 in the text's order.

    A line with an article mark opens an article, one with a chapter mark ends it and opens a chapter; other lines go on
    with what is open. Lines before the first article belong to article 0, which is left out.
    """
    at = Window.partitionBy("doc").orderBy("line")
    rows = lines(docs, doc, text)
    is_article, is_chapter = F.col("text").rlike(article), F.col("text").rlike(chapter)
    rows = rows.withColumn("_a", is_article.cast("int")).withColumn("_c", is_chapter.cast("int"))
    rows = rows.withColumn("article", F.sum("_a").over(at)).withColumn("chapter", F.sum("_c").over(at))
    rows = rows.withColumn("chapter_mark", F.last(F.when(is_chapter, F.regexp_extract("text", chapter, 1)), ignorenulls=True).over(at))
    rows = rows.where("article > 0 and _c = 0").withColumn("mark", F.when(is_article, F.regexp_extract("text", article, 1)))
    rows = rows.withColumn("_text", F.when(is_article, F.trim(F.regexp_replace("text", article, ""))).otherwise(F.col("text")))
    body = F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("line", "_text"))), lambda x: x["_text"]), lambda x: x != ""), "\n")
    out = rows.groupBy("doc", "article").agg(F.max("mark").alias("mark"), F.min("chapter").alias("chapter"), F.min_by("chapter_mark", "line").alias("chapter_mark"), body.alias("body"))
    return out.withColumn("number", numeral(F.col("mark"))).select("doc", "article", "mark", "number", "chapter", "chapter_mark", "body")


def items(clauses: DataFrame, mark: str = rf"^[（(]({NUMERAL})[)）]") -> DataFrame:
    """(doc, article, item, number, text): numbered items inside articles."""
    each = clauses.select("doc", "article", F.posexplode(F.split("body", "\n")).alias("item", "text")).where(F.col("text").rlike(mark))
    return each.select("doc", "article", "item", numeral(F.regexp_extract("text", mark, 1)).alias("number"), F.trim(F.regexp_replace("text", mark, "")).alias("text"))


def structure(docs: DataFrame, clauses: DataFrame, doc: str = "doc_id", text: str = "text", outline: str = rf"^({NUMERAL})[、.．]") -> DataFrame:
    """(doc, mode, n_articles): law if there is any article, else outline if numbered lines cover the text well, else plain; empty.

    An outline scores half the share of lines from its first mark on, 0.3 if there are two marks or more, and 0.2 times the
    share of marks that follow the one before; it takes 0.75.
    """
    n = clauses.groupBy("doc").agg(F.count(F.lit(1)).alias("n_articles"))
    at = Window.partitionBy("doc").orderBy("line")
    rows = lines(docs, doc, text).withColumn("_n", numeral(F.regexp_extract("text", outline, 1)))
    marks = rows.where("_n is not null").withColumn("_ok", (F.col("_n") == F.lag("_n").over(at) + 1).cast("double"))
    found = marks.groupBy("doc").agg(F.count(F.lit(1)).alias("_marks"), F.coalesce(F.avg("_ok"), F.lit(1.0)).alias("_runs"), F.min("line").alias("_first"))
    total = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("_lines"))
    after = rows.join(found.select(F.col("doc").alias("_d"), "_first"), (F.col("doc") == F.col("_d")) & (F.col("line") >= F.col("_first"))).groupBy("doc").agg(F.count(F.lit(1)).alias("_after"))
    everyone = docs.select(F.col(doc).alias("doc")).join(total, "doc", "left").join(found, "doc", "left").join(after, "doc", "left").join(n, "doc", "left")
    score = 0.5 * F.col("_after") / F.col("_lines") + F.when(F.col("_marks") >= 2, 0.3).otherwise(0.0) + 0.2 * F.col("_runs")
    mode = F.when(F.col("n_articles") > 0, "law").when(score >= 0.75, "outline").when(F.col("_lines") > 0, "plain").otherwise("empty")
    return everyone.select("doc", mode.alias("mode"), F.coalesce("n_articles", F.lit(0)).alias("n_articles"))


def check(clauses: DataFrame) -> DataFrame:
    """(doc, n, status, issues): duplicate numbers are errors; gaps, empty bodies and inner blanks are warnings, in this order."""
    before = F.lag("number").over(Window.partitionBy("doc").orderBy("article"))
    rows = clauses.withColumn("_gap", (F.col("number") > before + 1).cast("int"))
    rows = rows.groupBy("doc").agg(
        F.count(F.lit(1)).alias("n"), (F.count("number") - F.countDistinct("number")).alias("_dup"), F.coalesce(F.sum("_gap"), F.lit(0)).alias("_gaps"),
        F.sum((F.col("body") == "").cast("int")).alias("_empty"), F.sum(F.col("body").rlike(r"[ \t]{2,}").cast("int")).alias("_blank"),
    )
    issues = F.concat_ws(",", *(F.when(F.col(c) > 0, F.lit(name)) for c, name in (("_dup", "duplicate"), ("_gaps", "gap"), ("_empty", "empty"), ("_blank", "blank"))))
    status = F.when(F.col("_dup") > 0, "FAILED").when(F.col("issues") != "", "PASSED_WITH_WARNINGS").otherwise("PASSED")
    return rows.withColumn("issues", issues).select("doc", "n", status.alias("status"), "issues")


#: Fixed: marks of three outline levels.
OUTLINE = [rf"^({NUMERAL})、", rf"^[（(]({NUMERAL})[)）]", r"^([0-9]+)[.．](?![0-9])"]
#: Fixed: lines that end a document: dates, bodies, attachments, notes of printing; starts and ends of articles that were cut by mistake.
TAIL = r"^(\d{4}年\d{1,2}月\d{1,2}日|[一二三四五六七八九〇零十]{4}年.*日|附件[:：]?.*|抄送[:：].*|主题词[:：].*|.{0,30}(印发|公章))$"
CUT_START, CUT_END = r"^([、，；：,;:]|的|规定)", r"(和|与|或|及|以及|、|按照|根据|依照)$"


#: Fixed: what cannot stand before a mark that opens a line: connectives, closing quotes, letters and digits; closing
#: brackets, which can before a chapter; ends of sentences; marks that a reference goes on with.
NO_HEAD, CLOSERS, ENDS, GOES_ON = "、，,;；:：”」』》一-鿿A-Za-z0-9０-９Ａ-Ｚａ-ｚ", "）)】\\]", "。！？…", "[项款目条章节个是、，]"
#: Fixed: marks of an outline's levels; what ends a document: appendices, interviews, distribution; signing bodies.
CHINESE = "[零〇一二两三四五六七八九十百千]"
LEVELS = [rf"{CHINESE}{{1,6}}[、．.](?!\d)", rf"[（(【\[]\s*{CHINESE}{{1,6}}\s*[）)】\]]", r"\d{1,3}\s*[、．.](?!\d)", r"[—\-–]{1,2}(?!\d)"]
TAIL_MARKS = [r"附\s*[：:]", "答记者问", "此件发至"]
SIGNERS = [
    "中国银保监会", "中国银监会", "中国保监会", "中国银行保险监督管理委员会", "银保监会", "银监会", "中国人民银行", "人民银行", "金融监管总局",
    "国家金融监督管理总局", "国务院", "财政部", "证监会", "民政部", "发展改革委", "税务总局", "国家外汇管理局", "审计署",
]


def parse_text(text: Column) -> Column:
    """Text as it is parsed: unusual blanks out between Han characters and plain elsewhere, and no blanks after Chinese marks
    or between Han characters and Latin ones. Only white space changes."""
    odd = "\\u00a0\\u2002\\u2003\\u2007\\u2009\\u200a\\u202f\\u205f\\u200b\\u200c\\u200d\\ufeff"
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"(?<=[一-鿿])[{odd}]+(?=[一-鿿])", "")
    t = F.regexp_replace(F.regexp_replace(t, f"[{odd}]", " "), r"(?<=[，；、：,;])[ \t]+(?=[一-鿿0-9A-Za-z（(])", "")
    return F.regexp_replace(t, r"(?<=[一-鿿])[ \t]+(?=[0-9A-Za-z])|(?<=[0-9A-Za-z])[ \t]+(?=[一-鿿])", "")


def segmented(text: Column) -> Column:
    """Running text with a line for each chapter and article, so that `articles` finds them.

    A mark opens a line unless what stands before it makes it a reference (NO_HEAD; closing brackets do before an article,
    if no sentence ends before them). The first article after a chapter's heading always does, and so does a chapter or
    section that is glued to a heading.
    """
    mark = rf"第\s*(?:{NUMERAL})\s*"
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"(?<![{NO_HEAD}{CLOSERS}])(?={mark}[章条])", "\n")
    t = F.regexp_replace(t, f"(?<=[{CLOSERS}])(?={mark}章)|(?<=[{ENDS}][{CLOSERS}])(?={mark}条)", "\n")
    short = r"[^\n。！？，；、：:]"
    t = F.regexp_replace(t, rf"(?m)^(\s*{mark}章{short}{{0,40}}?)(?={mark}[章节](?!\s*[的之和与及等所中内前后、，。；:：]){short}{{1,60}}$)", "$1\n")
    t = F.regexp_replace(t, rf"(?m)^(\s*{mark}章[^\n]*?)(?={mark}条)", "$1\n")
    return F.regexp_replace(F.regexp_replace(t, r"[ \t]*\n\s*", "\n"), r"^\s+|\s+$", "")


def outlined(text: Column) -> Column:
    """Running text with a line for each mark of an outline after the end of a sentence or a blank, and for marks of a lower
    level that are glued to a short heading, if they are no reference and twenty characters with a full stop follow."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"(?<=[{ENDS}；:：\\s])(?={'|'.join(LEVELS)})", "\n")
    deeper = {LEVELS[0]: [LEVELS[1], LEVELS[2]], LEVELS[1]: [LEVELS[2]]}
    for lead, inner in deeper.items():
        t = F.regexp_replace(t, rf"(?m)^(\s*(?:{lead})[^\n。！？]{{0,40}}?)(?=(?:{'|'.join(inner)})(?!\s*{GOES_ON})(?=[^\n]{{20,}})[^\n]*[。；])", "$1\n")
    return F.regexp_replace(F.regexp_replace(t, r"[ \t]*\n\s*", "\n"), r"^\s+|\s+$", "")


def tail_cut(text: Column, share: float = 0.15, least: int = 400) -> Column:
    """Struct (text, removed): text up to its tail, and how many characters the tail has.

    A tail begins, in the last `least` characters or `share` of the text, at a TAIL_MARK, at a notice of a joint release, or
    at a signature (bodies and a date) that only a note follows. Without one nothing is removed.
    """
    signers = "|".join(SIGNERS)
    signed = rf"(?:{signers})(?:\s*(?:{signers}))*\s*\d{{4}}\s*年\s*\d{{1,2}}\s*月\s*\d{{1,2}}\s*日(?=[\s　（(【\[].{{0,80}}?[）)】\]]?$)"
    released = rf"(?:{signers})[^。！？]{{0,16}}?联合发布《[^》]{{0,80}}》"
    marks = "|".join([*TAIL_MARKS, released, signed])
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+$", "")
    zone = F.greatest(F.lit(least), F.floor(F.length(t) * share).cast("int"))
    head = F.substr(t, F.lit(1), F.greatest(F.length(t) - zone, F.lit(0)))
    rest = F.regexp_replace(F.right(t, zone), f"(?s)(?:{marks}).*$", "")
    kept = F.regexp_replace(F.concat(head, rest), r"(?U)^\s+|\s+$", "")
    cut = F.length(head) + F.length(rest) < F.length(t)
    return F.struct(F.when(cut, kept).otherwise(t).alias("text"), (F.length(t) - F.length(head) - F.length(rest)).alias("removed"))


def clamped(chapters: DataFrame, clauses: DataFrame) -> DataFrame:
    """chapters (doc, number, article) with `article` put inside its text's articles (1 to their number), whether it was not
    (clamped), and whether it lies before that of the chapter above it (steps_back). Texts without articles keep theirs."""
    size = clauses.groupBy(F.col("doc").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    met = chapters.join(size, F.col("doc") == F.col("_d"), "left")
    inside = F.when(F.col("_n").isNull(), F.col("article")).otherwise(F.greatest(F.lit(1), F.least(F.coalesce("article", F.lit(1)), F.col("_n"))))
    rows = met.withColumn("_a", inside).withColumn("clamped", ~F.col("_a").eqNullSafe(F.col("article")))
    before = F.max("_a").over(Window.partitionBy("doc").orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("steps_back", F.coalesce(F.col("_a") < before, F.lit(False))).select("doc", "number", F.col("_a").alias("article"), "clamped", "steps_back")


def without_tail(docs: DataFrame, doc: str = "doc_id", text: str = "text", tail: str = TAIL) -> DataFrame:
    """(doc, line, text): lines up to the last one that is no part of a document's tail."""
    rows = lines(docs, doc, text)
    last = rows.where(~F.col("text").rlike(tail)).groupBy(F.col("doc").alias("_d")).agg(F.max("line").alias("_last"))
    return rows.join(last, (F.col("doc") == F.col("_d")) & (F.col("line") <= F.col("_last")), "left_semi")


def outline(docs: DataFrame, doc: str = "doc_id", text: str = "text", marks: list[str] | None = None) -> DataFrame:
    """(doc, unit, level, number, parent, body): units of an outline in the text's order, from 1; parent is the unit above (0: none).

    A line with a mark opens a unit of the mark's level, other lines go on with the open unit; lines before the first mark
    are left out. A unit's parent is the last unit before it of a smaller level.
    """
    marks = marks or OUTLINE
    at = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    level, mark = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, m in reversed(list(enumerate(marks))):
        level, mark = F.when(F.col("text").rlike(m), i + 1).otherwise(level), F.when(F.col("text").rlike(m), F.regexp_extract("text", m, 1)).otherwise(mark)
    rows = lines(docs, doc, text).withColumn("_level", level).withColumn("_mark", mark)
    stripped = F.coalesce(*(F.when(F.col("_level") == i + 1, F.trim(F.regexp_replace("text", m, ""))) for i, m in enumerate(marks)), F.col("text"))
    rows = rows.withColumn("_text", stripped).withColumn("unit", F.count("_level").over(at))
    for i in range(1, len(marks)):
        rows = rows.withColumn(f"_p{i}", F.last(F.when(F.col("_level") == i, F.col("unit")), ignorenulls=True).over(at))
    above = F.lit(0).cast("long")
    for i in range(1, len(marks)):
        above = F.when(F.col("level") > i, F.greatest(above, F.coalesce(F.col(f"_p{i}"), F.lit(0)))).otherwise(above)
    joined = F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("line", "_text"))), lambda x: x["_text"]), lambda x: x != ""), "\n")
    heads = [F.min_by(f"_p{i}", "line").alias(f"_p{i}") for i in range(1, len(marks))]
    units = rows.where("unit > 0").groupBy("doc", "unit").agg(F.max("_level").alias("level"), F.max("_mark").alias("_mark"), joined.alias("body"), *heads)
    return units.select("doc", "unit", "level", numeral(F.col("_mark")).alias("number"), above.alias("parent"), "body")


def repair(clauses: DataFrame, start: str = CUT_START, end: str = CUT_END, least: int = 20, stop: str = "。") -> DataFrame:
    """clauses with articles that are none put back to the one before, repeats of number and body dropped, numbered anew.

    An article is none if its body is empty or has at most `least` characters without a full stop, begins as a sentence goes
    on, or follows a body that ends in a connective. Returns doc, article, mark, number, chapter, chapter_mark, body.
    """
    at = Window.partitionBy("doc").orderBy("article")
    short = (F.length("body") <= least) & ~F.contains(F.col("body"), F.lit(stop))
    wrong = short | F.col("body").rlike(start) | F.coalesce(F.lag("body").over(at).rlike(end), F.lit(False))
    rows = clauses.withColumn("_own", (~wrong | (F.row_number().over(at) == 1)).cast("int"))
    rows = rows.withColumn("_unit", F.sum("_own").over(at.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("article", "_own", "mark", "body"))), lambda x: F.when(x["_own"] == 1, x["body"]).otherwise(F.concat(F.lit("第"), F.coalesce(x["mark"], F.lit("")), F.lit("条"), x["body"])))
    first = lambda c: F.min_by(c, "article").alias(c)
    units = rows.groupBy("doc", "_unit").agg(first("mark"), first("number"), first("chapter"), first("chapter_mark"), F.min("article").alias("_at"), F.array_join(parts, "").alias("body"))
    once = units.withColumn("_n", F.row_number().over(Window.partitionBy("doc", "number", "body").orderBy("_at"))).where("_n = 1")
    return once.withColumn("article", F.row_number().over(Window.partitionBy("doc").orderBy("_at")).cast("long")).select("doc", "article", "mark", "number", "chapter", "chapter_mark", "body")


def last_line(text: Column) -> Column:
    """What stands after the last line break but one at the very end, in one pass from the end, however long the line."""
    return F.substring_index(F.regexp_replace(text, r"\r?\n\z", ""), "\n", -1)


def validate(meta: DataFrame, clauses: DataFrame, tail: str = TAIL) -> DataFrame:
    """(doc, status, errors, warnings): rules V001 to V010 on parsed documents, names of broken ones joined by commas.

    meta: doc, dedup_key, title, source_url, rfn, article_count (declared; null is not checked). V001 key and title (error),
    V002 numbers that fall back (error) or skip or do not begin at 1 (warning), V003 repeated numbers, V004 declared count,
    V005 chapters that fall back, V006 empty bodies, V007 form of the reference, V008 a title swallowed at a body's end, V009 a
    tail in the last body, V010 runs of blanks. FAILED with an error, PASSED_WITH_WARNINGS, else PASSED.
    """
    at = Window.partitionBy("doc").orderBy("article")
    last = F.lead("article").over(at).isNull()
    rows = clauses.withColumn("_before", F.lag("number").over(at)).withColumn("_chapter", F.lag("chapter").over(at)).withColumn("_last", last)
    some = lambda c: F.coalesce(F.max(c.cast("int")), F.lit(0))
    n, body = F.col("number"), F.col("body")
    found = rows.groupBy(F.col("doc").alias("_d")).agg(
        F.count(F.lit(1)).alias("_n"), some(n.isNull() | (n <= F.col("_before"))).alias("_back"), some((n > F.col("_before") + 1) | (F.col("_before").isNull() & (F.col("article") == 1) & (n != 1))).alias("_skip"), (F.count("number") - F.countDistinct("number")).alias("_dup"),
        some(F.col("chapter") < F.col("_chapter")).alias("_chap"), some(F.trim("body") == "").alias("_empty"), some(body.rlike(rf"\n第\s*({NUMERAL})\s*[章节][^\n]{{0,30}}$")).alias("_swallowed"),
        some(F.col("_last") & last_line(body).rlike(tail)).alias("_tail"), some(body.rlike(r"[ \t　]{2,}")).alias("_blank"),
    )
    met = meta.join(found, F.col("doc") == F.col("_d"), "left")
    on = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    said = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    errors = [("V001", ~said("dedup_key") | ~said("title")), ("V002", on("_back")), ("V003", on("_dup")), ("V005", on("_chap"))]
    warnings = [("V001", ~said("source_url")), ("V002", ~on("_back") & on("_skip")), ("V004", F.coalesce(F.col("article_count") != F.coalesce("_n", F.lit(0)), F.lit(False))), ("V006", on("_empty")), ("V007", ~F.coalesce(F.col("rfn"), F.lit("")).rlike("^[A-Z]+[A-Za-z0-9-]*[0-9]$")), ("V008", on("_swallowed")), ("V009", on("_tail")), ("V010", on("_blank"))]
    names = lambda rules: F.concat_ws(",", *(F.when(holds, F.lit(name)) for name, holds in rules))
    out = met.select("doc", names(errors).alias("errors"), names(warnings).alias("warnings"))
    return out.select("doc", F.when(F.col("errors") != "", "FAILED").when(F.col("warnings") != "", "PASSED_WITH_WARNINGS").otherwise("PASSED").alias("status"), "errors", "warnings")


def semantics(clauses: DataFrame, mark: str = rf"^[（(]({NUMERAL})[)）]", quote: str = "《[^《》]+》", must: str = "应当|不得|必须") -> DataFrame:
    """(doc, articles, items, references, duties, characters): what a document's clauses hold."""
    each = clauses.select("doc", "article", "body", F.size(F.filter(F.split("body", "\n"), lambda x: x.rlike(mark))).alias("_i"))
    return each.groupBy("doc").agg(F.count(F.lit(1)).alias("articles"), F.sum("_i").alias("items"), F.sum(F.regexp_count("body", F.lit(quote))).alias("references"), F.sum(F.regexp_count("body", F.lit(must))).alias("duties"), F.sum(F.length("body")).alias("characters"))


def markdown(clauses: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """(doc, text): a document's clauses as Markdown: title, chapters as headings where they begin, articles in bold.

    titles: doc, title. One document's clauses are gathered in one task, and no more.
    """
    before = F.lag("chapter").over(Window.partitionBy("doc").orderBy("article"))
    opens = (F.col("chapter") > 0) & (F.col("_before").isNull() | (F.col("chapter") != F.col("_before")))
    head = F.when(opens, F.concat(F.lit("## "), F.coalesce("chapter_mark", F.lit("")), F.lit("\n\n"))).otherwise("")
    rows = clauses.withColumn("_before", before).select("doc", "article", F.concat(head, F.lit("**"), F.coalesce("mark", F.lit("")), F.lit("** "), "body").alias("_t"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("article", "_t"))), lambda x: x["_t"]), "\n\n")
    out = rows.groupBy("doc").agg(text.alias("text"))
    if titles is None:
        return out
    met = out.join(titles.select(F.col("doc").alias("_d"), "title"), F.col("doc") == F.col("_d"), "left")
    return met.select("doc", F.concat(F.coalesce(F.concat(F.lit("# "), "title", F.lit("\n\n")), F.lit("")), "text").alias("text"))


def chunks(clauses: DataFrame) -> DataFrame:
    """(chunk_id, doc, article, body): clauses for retrieval, with ids that change with the text."""
    digest = F.substring(F.sha2("body", 256), 1, 12)
    return clauses.select(F.concat_ws(":", F.lit("clause"), F.col("doc").cast("string"), F.col("article").cast("string"), digest).alias("chunk_id"), "doc", "article", "body")


def target_check(refs: DataFrame, clauses: DataFrame) -> DataFrame:
    """refs (doc, number) with state: verified, out_of_range, in_range_unmatched, or no_table for texts without articles."""
    known = clauses.select(F.col("doc").alias("_d"), F.col("number").alias("_n")).distinct()
    size = clauses.groupBy(F.col("doc").alias("_e")).agg(F.count(F.lit(1)).alias("_size"))
    met = refs.join(size, F.col("doc") == F.col("_e"), "left").join(known, (F.col("doc") == F.col("_d")) & (F.col("number") == F.col("_n")), "left")
    state = F.when(F.col("_size").isNull(), "no_table").when(F.col("_n").isNotNull(), "verified").when(F.col("number") > F.col("_size"), "out_of_range").otherwise("in_range_unmatched")
    return met.select(*refs.columns, state.alias("state"))
