"""Mapping, cleaning and decisions on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import keys as K
from ..functions import text as T
from ..operators import mapping as M
from .base import query


def _raw(t):
    """Documents as raw records of the source gov."""
    return t("documents").select(F.col("doc_id").cast("string").alias("bbbs"), F.concat_ws("-", "lang", "source").alias("title"), F.col("source").alias("category"), F.concat(F.lit("http://host/"), F.col("doc_id").cast("string")).alias("detail_url"), F.lit("2024-01-05").alias("publish_date"), F.col("text").alias("full_text"), "lang")


@query("select doc_id::varchar index_no, concat_ws('-', lang, source) title, coalesce(source, '') category, 'http://host/' || doc_id::varchar source_url, 'gov' as source, length(coalesce(text, '')) body_chars, sha256(doc_id::varchar || '|http://host/' || doc_id::varchar || '|2024-01-05') dedup_key from documents")
def map_records(t):
    rows = M.mapped(_raw(t), "gov", lambda raw, title, body: K.docno_in_title(title))
    return rows.select("index_no", "title", "category", "source_url", "source", F.length("body_text").cast("long").alias("body_chars"), "dedup_key")


def _plain(column: str, lines: bool) -> str:
    """SQL of text.denoised (Latin texts): left-overs out, controls out, blanks plain."""
    x = f"coalesce({column}, '')"
    for p in T.NOISE:
        x = f"regexp_replace({x}, '{p}', ' ', 'gis')"
    x = rf"regexp_replace(regexp_replace(regexp_replace({x}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '[\x{{200b}}-\x{{200d}}\x{{2060}}\x{{feff}}]', '', 'g'), '\r\n?', chr(10), 'g')"
    x = rf"regexp_replace({x}, '[\x{{a0}}\x{{2002}}\x{{2003}}\x{{2007}}\x{{2009}}\x{{200a}}\x{{202f}}\x{{205f}}]', ' ', 'g')"
    blanks = r"[ \t\x{3000}]+"
    if lines:
        return rf"trim(regexp_replace(regexp_replace({x}, '{blanks}', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10))"
    return rf"trim(regexp_replace(replace({x}, chr(10), ' '), '{blanks}', ' ', 'g'), ' ')"


@query(f"select page_id, length(x) chars, sha256(x) digest from (select page_id, {_plain('html', False)} x from pages)")
def denoise(t):
    """Pages without left-overs of scripts and footers."""
    x = T.denoised(F.col("html"))
    return t("pages").select("page_id", F.length(x).cast("long").alias("chars"), F.sha2(x, 256).alias("digest"))


#: Left-overs of web pages in Han characters, one for each pattern, and something that must stay.
LEFT_OVERS = [
    "版权所有 © 某某局 京ICP备12345号 技术部", "网站标识码：1234567890", "主办单位：某某局办公室", "地址：某某路一号", "邮编：100000", "联系电话：010-12345678", "无障碍浏览 进入", "分享到：微信QQ空间",
    "扫一扫 关注", "打印本页 关闭窗口", "document.write('x')", "var a = 1;", "function f (x) { return x }", "第一条 本办法",
]
_LEFT = "case page_id % 14 " + " ".join(f"when {i} then '{x.replace(chr(39), chr(39) * 2)}'" for i, x in enumerate(LEFT_OVERS)) + " end"


@query(f"select page_id, length(x) chars, sha256(x) digest from (select page_id, {_plain('body', True)} x from (select page_id, url || chr(10) || {_LEFT} || chr(10) || left(html, 200) || chr(10) || chr(10) || chr(10) || '　 完' body from pages))")
def denoise_left_overs(t):
    """Bodies made of a page's URL and head with a left-over between them, one of each pattern in turn."""
    left = F.element_at(F.array(*map(F.lit, LEFT_OVERS)), (F.col("page_id") % 14 + 1).cast("int"))
    x = T.denoised(F.concat("url", F.lit("\n"), left, F.lit("\n"), F.left("html", F.lit(200)), F.lit("\n\n\n\u3000 完")), keep_lines=True)
    return t("pages").select("page_id", F.length(x).cast("long").alias("chars"), F.sha2(x, 256).alias("digest"))


@query(f"with c as (select doc_id, lang, source, {_plain('text', True)} body from documents), k as (select *, trim(regexp_replace(body, '[{T.GARBLE[1:-1]}]', '', 'g'), ' ' || chr(10)) b from c) select case when b = '' then 'quarantine' else 'cleaned' end as state, source, count(*) n, sum(length(b))::bigint chars from k group by all")
def clean_chain(t):
    """Mapped documents cleaned, filled, deduplicated by key and split into cleaned rows and quarantine."""
    rows = M.mapped(_raw(t), "gov", lambda raw, title, body: F.lit("")).withColumn("source", F.col("category"))
    both = M.cleaned_rows(rows, ["title", "body_text"]).select(F.when(F.col("errors").isNull(), "cleaned").otherwise("quarantine").alias("state"), "source", "body_text")
    return both.groupBy("state", "source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("body_text")).cast("long").alias("chars"))


@query("select doc_id, concat_ws(',', case when upper(trim(coalesce(lang, ''))) in ('', 'N/A', 'NA', 'NULL', 'NONE') then 'lang' end, case when upper(trim(coalesce(source, ''))) in ('', 'N/A', 'NA', 'NULL', 'NONE') then 'source' end) missing, case when upper(trim(coalesce(lang, ''))) in ('', 'N/A', 'NA', 'NULL', 'NONE') then 'und' else lang end lang from documents")
def fill_missing(t):
    rows = M.fill_missing(t("documents"), ["lang", "source"], {"lang": "und"})
    return rows.select("doc_id", F.array_join("missing_fields", ",").alias("missing"), "lang")


@query("select l_orderkey, l_linenumber::varchar file_name, case when l_returnflag = 'N' then '' else l_returnflag end as kind, l_quantity::varchar as bytes from lineitem union all select o_orderkey, o_orderstatus, o_orderpriority, '' from orders where o_orderkey not in (select l_orderkey from lineitem)")
def attachment_rows(t):
    """An order's lines as its attachments; orders without lines are attachments themselves."""
    lines = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").cast("string").alias("name"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("file_type"), F.col("l_quantity").cast("string").alias("size_bytes"))).alias("attachments"))
    o = t("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    rows = o.select(F.col("o_orderkey").alias("l_orderkey"), "attachments", F.when(F.col("attachments").isNull(), "attachment").alias("link_type"), F.col("o_orderstatus").alias("title"), F.col("o_orderpriority").alias("file_type"))
    return M.attachments(rows, "l_orderkey").select("l_orderkey", "file_name", "kind", "bytes")


@query("select o_orderkey, coalesce(c.c_mktsegment, o_orderstatus) o_orderstatus from orders left join (select o_custkey k, arg_max(o_orderpriority, o_orderkey) c_mktsegment from orders where o_orderstatus = 'P' group by 1) c on c.k = o_custkey")
def status_writeback(t):
    """A ledger (a customer's last pending order) written back to all of the customer's orders."""
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    ledger = t("orders").where("o_orderstatus = 'P'").select("o_custkey", F.col("o_orderpriority").alias("o_orderstatus"), "o_orderkey")
    return M.written_back(o, ledger, "o_custkey", ["o_orderstatus"], "o_orderkey").select("o_orderkey", "o_orderstatus")


@query("select doc_id, coalesce(nullif(d.lang, ''), p.l, '') lang from (select doc_id, source, case when doc_id % 4 = 0 then '' else lang end lang from documents) d left join (select source s, max(nullif(lang, '')) l from documents group by 1) p on p.s = d.source")
def carry_forward(t):
    now = t("documents").select("doc_id", "source", F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("lang")).alias("lang"))
    return M.carried_forward(now, t("documents").select("source", "lang"), "source", ["lang"]).select("doc_id", "lang")


@query("select p_partkey, p_partkey::varchar || '_' || regexp_replace(p_name, '[\\\\/:*?\"<>|\\s]+', '_', 'g') || '.pdf' as name from part")
def file_names(t):
    name = M.file_name(F.col("p_partkey").cast("string"), F.col("p_name"), F.lit(""), F.lit(".PDF"))
    return t("part").select("p_partkey", name.alias("name"))


_AUTHORITY = """with r as (select p_partkey, case p_size % 5 when 0 then '部门规章' when 1 then '法律解释' when 2 then '部门规范性文件（内部便函）' else '' end c, case p_size % 4 when 0 then '国务院' when 1 then '财政部' when 2 then '上海市人民政府' else '行业协会' end a, case p_size % 3 when 0 then '条例' when 1 then '办法' else '通知' end k from part),
m as (select *, trim(regexp_replace(c, '（[^（）]*(?:内部便函|内部文件|内部备案)[^（）]*）', '')) raw from r)"""


@query(_AUTHORITY + """ select p_partkey, case raw when '部门规章' then 'dept_rule' when '法律解释' then 'judicial_interpretation' when '部门规范性文件' then 'dept_normative' else case when a = '国务院' and k in ('条例', '办法') then 'admin_regulation' when a = '财政部' and k = '办法' then 'dept_rule' when a = '上海市人民政府' and k = '办法' then 'local_government_rule' when k = '通知' and a = '国务院' then 'state_council_normative' when k = '通知' and a = '财政部' then 'dept_normative' when k = '通知' and a = '上海市人民政府' then 'local_government_normative' else 'other' end end category, case when c like '%便函%' then '内部便函' else '' end modifier from m""")
def authority_tier(t):
    """Classes of authority of records made by rule from parts."""
    n = F.col("p_size")
    category = F.when(n % 5 == 0, "部门规章").when(n % 5 == 1, "法律解释").when(n % 5 == 2, "部门规范性文件（内部便函）").otherwise("")
    agency = F.when(n % 4 == 0, "国务院").when(n % 4 == 1, "财政部").when(n % 4 == 2, "上海市人民政府").otherwise("行业协会")
    kind = F.when(n % 3 == 0, "条例").when(n % 3 == 1, "办法").otherwise("通知")
    rows = t("part").select("p_partkey", D.authority(category, F.col("p_name"), agency, kind).alias("a"))
    return rows.select("p_partkey", "a.category", "a.modifier")


_WORDS = {"hard": ["licensed"], "soft": ["license"], "agents": ["token"], "general": ["secret"], "companies": ["tible"], "strong": ["password"], "sectors": ["loser"], "social": ["xyzzy"], "addressing": ["under", "the"], "other_lines": ["src3"], "own_lines": ["src30"]}


@query("""with d as (select doc_id, coalesce(source, '') t, concat_ws(chr(10), coalesce(source, ''), coalesce(lang, ''), coalesce(text, '')) w, length(coalesce(source, '')) + length(coalesce(lang, '')) + length(coalesce(text, '')) n from documents),
f as (select *, case when contains(w, 'licensed') then case when contains(t, 'licensed') then 'INCLUDE/high' when regexp_matches(w, '(?s)(under|the).{0,25}?licensed|licensed.{0,25}?(under|the)') then 'INCLUDE/middle' else 'BOUNDARY/low' end when contains(w, 'license') then 'BOUNDARY/low' when contains(w, 'token') then case when contains(w, 'tible') then 'EXCLUDE/middle' else 'INCLUDE/middle' end when contains(w, 'secret') then case when contains(w, 'password') then 'EXCLUDE/middle' else 'BOUNDARY/low' end when contains(w, 'tible') or contains(w, 'loser') then 'EXCLUDE/middle' else 'EXCLUDE/none' end v from d)
select doc_id, case when v not like 'EXCLUDE%' and contains(t, 'src3') and not contains(t, 'src30') then 'EXCLUDE/middle' when v = 'INCLUDE/middle' and n < 200 then 'BOUNDARY/low' else v end verdict from f""")
def relevance_decision(t):
    v = D.relevance(F.col("source"), F.col("lang"), F.col("text"), _WORDS, "§")
    return t("documents").select("doc_id", F.concat_ws("/", v["decision"], v["confidence"]).alias("verdict"))


@query("select o_orderkey, case when p in (3, 4) then '' else case p when 0 then '财会' || y || n when 1 then '财会' || y || n else '国务院令第' || n end end as key, case when p in (0, 1) then y || '-' || n end signature from (select o_orderkey, o_orderkey % 5 p, year(o_orderdate)::varchar y, (o_orderkey % 97 + 1)::varchar n from orders)")
def docno_keys(t):
    """Keys and signatures of document numbers written in several ways, made by rule from orders."""
    p, y, n = F.col("o_orderkey") % 5, F.year("o_orderdate").cast("string"), (F.col("o_orderkey") % 97 + 1).cast("string")
    raw = F.when(p == 0, F.concat(F.lit(" 财会〔"), y, F.lit("〕"), n, F.lit("号"))).when(p == 1, F.concat(F.lit("财会["), y, F.lit("] "), n, F.lit(" 号"))).when(p == 2, F.concat(F.lit("国务院令（第"), n, F.lit("号）"))).when(p == 3, "N/A").otherwise("未注明")
    return t("orders").select("o_orderkey", K.docno(raw).alias("key"), K.signature(raw).alias("signature"))


@query("select doc_id, case when length(trim(coalesce(text, ''), ' ' || chr(10))) > 50 then 1 else 0 end pieces from documents")
def long_uncut(t):
    """Pieces of texts without any (Chinese) sentence end."""
    return t("documents").select("doc_id", F.size(T.cut_long(F.col("text"))).alias("pieces"))


@query("with d as (select doc_id, text, regexp_extract(text, '(?s)^(.{10,300}?[：:])', 1) lead from documents) select doc_id, case when lead <> '' and starts_with(substr(text, length(lead) + 1), lead) then length(text) - length(lead) else length(text) end chars from d")
def dup_lead(t):
    return t("documents").select("doc_id", F.length(T.single_lead(F.col("text"))).cast("long").alias("chars"))


@query("with w as (select doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+ [a-z]+ [a-z]+')) w from documents), c as (select doc_id, w, count(*) n from w group by all), r as (select *, row_number() over (partition by doc_id order by n desc, w) r from c) select doc_id, string_agg(w, '; ' order by r) titles from r where r <= 8 group by 1")
def top_titles(t):
    """The eight titles (a capitalised word and two more) that a text names most often."""
    from pyspark.sql import Window

    found = t("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+ [a-z]+ [a-z]+"), 0)).alias("w")).groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("n"))
    top = found.withColumn("r", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "w"))).where("r <= 8")
    return top.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "w"))), lambda x: x["w"]), "; ").alias("titles"))


@query("select doc_id, len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9一-鿿]{31,}')) issues from documents")
def acceptance_check(t):
    return t("documents").select("doc_id", F.size(T.unbroken(F.col("text"))).cast("long").alias("issues"))


@query("select page_id, (len(string_split(html, '|')) - 1 >= 2 * 1 and false) or regexp_matches(html, '序号|项目|金额|单位|名称|数量|备注|指标|合计|总计|科目|收入|支出|同比|环比') or (n >= 2 and bars >= 2 * n) or (n >= 3 and digits >= 0.6 * n and (most - least)::double / greatest(total / n, 1.0) < 0.35) is_table from (select page_id, html, len(l) n, len(regexp_extract_all(html, '\\|')) bars, len(list_filter(l, lambda x: regexp_matches(x, '[0-9]'))) digits, list_max(list_transform(l, lambda x: length(x))) most, list_min(list_transform(l, lambda x: length(x))) least, list_sum(list_transform(l, lambda x: length(x)))::double total from (select page_id, html, list_filter(list_transform(string_split(html, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') l from pages)) where n > 0")
def table_blocks(t):
    rows = t("pages").where(F.trim(F.regexp_replace("html", r"\s", "")) != "")
    return rows.select("page_id", T.is_table(F.col("html")).alias("is_table"))


@query("with g as (select case when p_size % 5 = 0 then 'internal_history' when p_size % 5 in (1, 4) then 'law' when p_size % 5 = 2 then 'admin_regulation' when p_size % 5 = 3 then 'department_rule' end g from part) select g guise, count(*) n from g group by 1")
def guise_summary(t):
    """External authorities by how they look; titles made by rule from parts."""
    n = F.col("p_size") % 5
    title = F.when(n == 0, "本社办法").when(n == 1, "民法典").when(n == 2, "保险条例").when(n == 3, "统计规定").otherwise("公司法")
    return t("part").groupBy(D.guise(title, F.lit(""), "本社").alias("guise")).agg(F.count(F.lit(1)).alias("n"))


@query("select a.p_partkey a, b.p_partkey b from part a join part b on a.p_type = b.p_type and a.p_size = b.p_size and a.p_partkey < b.p_partkey where a.p_name = b.p_name or (length(a.p_name) <= length(b.p_name) and length(a.p_name) >= 6 and contains(b.p_name, a.p_name)) or (length(b.p_name) < length(a.p_name) and length(b.p_name) >= 6 and contains(a.p_name, b.p_name)) or 1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name), 1) >= 0.82")
def title_pairs(t):
    """Parts of one type and size whose names stand for one document."""
    return M.alike_rows(t("part"), "p_partkey", "p_name", ["p_type", "p_size"])


@query("select page_id, regexp_replace(url, '[?#].*$', '') url, case when regexp_extract(url, '(\\d{4})', 1) = '' then '未知' else regexp_extract(url, '(\\d{4})', 1) end as year from pages")
def redacted_urls(t):
    return t("pages").select("page_id", T.redacted(F.col("url")).alias("url"), T.year_of(F.col("url")).alias("year"))


@query("select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'done' else 'not_executed' end as status, o_orderstatus in ('O', 'F') known from orders")
def controlled_status(t):
    v = T.controlled(F.concat(F.lit(" "), F.col("o_orderstatus")), {"O": "open", "F": "done"}, "not_executed")
    return t("orders").select("o_orderkey", v["value"].alias("status"), v["known"].alias("known"))
