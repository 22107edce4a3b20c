"""Paragraphs, sheets, running clauses, words, versions and work items on the supplied tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..checkpoints import shared_folder
from ..operators import clauses as C
from ..operators import layout as L
from ..operators import rules as U
from ..operators import sketches as K
from ..operators import tables as T
from ..operators import wording as W
from ..sources.versions import Versions
from ..streaming import state as S
from .base import query

_TRIMMED = r"regexp_replace({}, '^[\s\x0b\x85\x{{a0}}]+|[\s\x0b\x85\x{{a0}}]+$', '', 'g')"
_STANDING = "|".join(f"(?:{p})" for p in L.STANDING).replace("'", "''")


@query(f"""with l as (select doc_id, list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {_TRIMMED.format("x")}) ls from documents),
p as (select doc_id, ls, list_transform(ls, lambda x, i: case when x = '' then '' when i = 1 or ls[i - 1] = '' or regexp_matches(ls[i - 1], '[{L.STOPS}]$|[{L.STOPS}]\\s*[{L.CLOSES}]$') or regexp_matches(x, '{_STANDING}') then chr(10) || chr(10) || x
  when regexp_matches(ls[i - 1], '[A-Za-z0-9]$') and regexp_matches(x, '^[A-Za-z0-9]') then ' ' || x else x end) ps from l)
select doc_id, length(t) chars, sha256(t) digest from (select doc_id, {_TRIMMED.format("array_to_string(ps, '')")} t from p)""")
def reflow_texts(t):
    """Documents with the lines of a paragraph joined."""
    x = L.reflowed(F.col("text"))
    return t("documents").select("doc_id", x.alias("x")).select("doc_id", F.length("x").cast("long").alias("chars"), F.sha2("x", 256).alias("digest"))


_RUNS = "select unnest(regexp_extract_all(lower(text), '[a-z]+')) r from documents"


@query(f"""with g as (select substr(r, i, s) gram, case when i > 1 then substr(r, i - 1, 1) else '' end b, substr(r, i + s, 1) a from (select r, s, unnest(range(1, length(r) - s + 2)) i from ({_RUNS}), (select unnest([1, 2]) s) where length(r) >= s)),
b as (select gram, b, count(*) n from g group by all), a as (select gram, a, count(*) n from g group by all),
l as (select gram, sum(n)::bigint n, ln(sum(n)) - sum(n * ln(n)) / sum(n) e from b group by 1), r as (select gram, ln(sum(n)) - sum(n * ln(n)) / sum(n) e from a group by 1)
select l.gram, n, round(l.e, 6) as "left", round(r.e, 6) as "right" from l join r using (gram)""")
def letter_grams(t):
    """Single letters and pairs in the words of documents, with the entropy of what stands beside them."""
    return W.grams(t("documents").select(F.lower("text").alias("text")), "text", 2, "[a-z]+")


_CELLS = "select l_suppkey % 40 sheet, (l_orderkey * 31 + l_linenumber * 17) % 97 as row, (l_partkey * 13) % 23 as col from lineitem where l_orderkey % 16 = 0"


@query(f"""with c as (select distinct sheet, row, col from ({_CELLS})), d as (select sheet, row, sum(f) over (partition by sheet order by row) down from (select sheet, row, coalesce(row - lag(row) over (partition by sheet order by row) - 1 > 1, false)::int f from (select distinct sheet, row from c))),
x as (select c.*, down from c join d using (sheet, row)), a as (select sheet, down, col, sum(f) over (partition by sheet, down order by col) across from (select sheet, down, col, coalesce(col - lag(col) over (partition by sheet, down order by col) - 1 > 1, false)::int f from (select distinct sheet, down, col from x))),
b as (select sheet, down, across, min(row) top, max(row) bottom, min(col) l, max(col) r, count(*) n from x join a using (sheet, down, col) group by all)
select sheet, (row_number() over (partition by sheet order by down, across) - 1)::int block, top, bottom, l as "left", r as "right", n from b""")
def sheet_blocks(t):
    """Blocks of filled cells in sheets made of lines."""
    cells = t("lineitem").where("l_orderkey % 16 = 0").select((F.col("l_suppkey") % 40).alias("sheet"), ((F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17) % 97).alias("row"), ((F.col("l_partkey") * 13) % 23).alias("col"), F.lit("x").alias("value")).distinct()
    return T.blocks(cells)


@query("with p as (select p_partkey doc, p_partkey % 5 + 1 n from part) select doc, unnest(range(1, n + 1))::bigint article, unnest(range(1, n + 1))::int number from p")
def running_articles(t):
    """Articles of texts without line ends, each of which cites another article of its own."""
    n = F.col("p_partkey") % 5 + 1
    piece = F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: F.concat(F.lit("第"), i.cast("string"), F.lit("条 依照第"), (i + 1).cast("string"), F.lit("条、第"), (i + 2).cast("string"), F.lit("条的规定执行。")))
    docs = t("part").select("p_partkey", F.concat(F.lit("某某办法第一章 总 则"), F.array_join(piece, "")).alias("text"))
    docs = docs.withColumn("text", C.segmented(F.concat(F.lit("（公布）"), F.regexp_replace("text", "^某某办法", ""))))
    return C.articles(docs, "p_partkey", "text").select("doc", F.col("article").cast("long").alias("article"), "number")


@query("""with e as (select p_partkey k, 'T' || lpad((p_partkey % 20)::varchar, 2, '0') s, 'T' || lpad((p_partkey % 17)::varchar, 2, '0') d, 'F' || (p_size % 5)::varchar f from part), m as (select s, d, f, min('R' || lpad(k::varchar, 8, '0')) r from e where s <> d group by all)
select s as src, d as dst, '表' || f as field, '' as target_field, 'rule' as source, r as rule_no from m""")
def er_relations(t):
    """Relations between twenty tables, told by rules made of parts."""
    number = lambda n: F.concat(F.lit("T"), F.lpad((F.col("p_partkey") % n).cast("string"), 2, "0"))
    name = lambda n: F.concat(F.lit("某"), number(n), F.lit("表"))
    field = F.concat(F.lit("表F"), (F.col("p_size") % 5).cast("string"))
    rule = F.concat(F.lit("【"), name(20), F.lit("】中的“"), field, F.lit("”，须在【"), name(17), F.lit("】中存在"))
    rules = t("part").select(F.concat(F.lit("R"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("no"), F.lit("").alias("table"), F.lit("").alias("item"), rule.alias("rule"))
    tables = t("part").select(number(20).alias("table_no"), name(20).alias("table_name")).distinct()
    items = t("part").select(F.lit("x").alias("table"), F.lit("y").alias("item"), F.lit("无").alias("description")).limit(0)
    return U.er_edges(U.parsed(rules), U.related(items), tables)


@query("select o_orderkey, case when o_orderkey % 7 = 0 then 'changed' else o_orderstatus end state from orders where o_orderkey % 11 <> 0")
def versioned_orders(t):
    """The third version of a table of orders: four fifths of them, then the rest and changes, then some taken away."""
    o = t("orders").select("o_orderkey", F.col("o_orderstatus").alias("state"))
    table = Versions(o.sparkSession, f"{shared_folder(o.sparkSession)}/versions-{uuid.uuid4().hex}")
    table.commit(o.where("o_orderkey % 5 > 0"), "o_orderkey", buckets=8)
    table.update(o.where("o_orderkey % 5 = 0 or o_orderkey % 7 = 0").withColumn("state", F.when(F.col("o_orderkey") % 7 == 0, "changed").otherwise(F.col("state"))))
    table.update(o.limit(0), o.where("o_orderkey % 11 = 0"))
    return table.read()


@query("""with e as (select user_id k, epoch_us(ts::timestamp) // 1000 ms, event_id id, event_type kind from events where user_id is not null and ts is not null), m as (select max(ms) - 86400000 mark from e), r as (select e.*, mark from e, m where ms < mark),
f as (select *, coalesce(lag(kind) over w = 'purchase' or ms - lag(ms) over w > 43200000, true)::int fresh from r window w as (partition by k order by ms, id)), i as (select *, sum(fresh) over (partition by k order by ms, id) item from f),
g as (select k, item, any_value(mark) mark, min(ms) opened, max(ms) last, count(*) n, arg_max(kind, [ms, id]) kind from i group by k, item)
select k as key, opened, n, case when kind = 'purchase' then last else last + 43200000 end as ended, case when kind = 'purchase' then 'closed' else 'expired' end as state from g where kind = 'purchase' or last + 43200000 < mark""")
def work_items(t):
    """Work items of users that are over by the watermark, closed or expired: what the stream with timers gives."""
    return S.work_items(t("events"))


@query()
def sketched_months(t):
    """Median, ninth decile and users of each type of event in each month, from daily sketches alone."""
    events = t("events").withColumn("month", F.date_format("ts", "yyyy-MM"))
    return K.merged(K.daily(events, ["event_type", "month"], F.to_date("ts"), "value", "user_id"), ["event_type", "month"], [0.5, 0.9])


_MADE = "coalesce(text, '') body, coalesce(lang, '') title, coalesce(source, '') category"
_INDEX = "case doc_id % 5 when 0 then 'G' || doc_id::varchar when 1 then 'M' || doc_id::varchar when 2 then 'N' || doc_id::varchar when 3 then '' else 'S' || doc_id::varchar end"


@query(f"""with m as (select doc_id, {_INDEX} i, 'u' || doc_id::varchar u, case doc_id % 5 when 0 then 'gov' when 1 then 'mof' when 2 then 'nfra' when 3 then 'pbc' else 'supp' end s, {_MADE} from documents)
select s as source, i as index_no, title, category, u as source_url, length(body) as chars, sha256((case when i = '' and s in ('gov', 'pbc') then u else i end) || '|' || u || '|') as dedup_key from m""")
def map_sources(t):
    """Raw records of all five sources, each with its own field names, in the common columns."""
    from ..operators import mapping as M

    d = t("documents").withColumn("id_", F.col("doc_id").cast("string"))
    url, text, title, kind = F.concat(F.lit("u"), "id_"), F.col("text"), F.col("lang").alias("title"), F.col("source")
    raw = {
        "gov": [F.concat(F.lit("G"), "id_").alias("bbbs"), title, kind.alias("category"), url.alias("detail_url"), text.alias("full_text")],
        "mof": [F.concat(F.lit("M"), "id_").alias("id"), title, kind.alias("category_name"), F.lit("").alias("detail_link"), url.alias("api_link"), text.alias("content_text")],
        "nfra": [F.lit("").alias("index_no"), F.concat(F.lit("N"), "id_").alias("doc_id"), title, kind.alias("category_type"), url.alias("detail_url"), text.alias("content")],
        "pbc": [title, kind.alias("category"), url.alias("detail_url"), text.alias("content")],
        "supp": [F.concat(F.lit("S"), "id_").alias("task_index"), title, kind.alias("category"), url.alias("source_url"), text.alias("body_text")],
    }
    found = [M.mapped(d.where(F.col("doc_id") % 5 == i).select(*columns), name, lambda raw, title, body: F.lit("")) for i, (name, columns) in enumerate(raw.items())]
    every = found[0]
    for other in found[1:]:
        every = every.unionByName(other)
    return every.select("source", "index_no", "title", "category", "source_url", F.length("body_text").alias("chars"), "dedup_key")


@query("select p_partkey, case p_partkey % 5 when 0 then '通知' when 1 then '办法' when 2 then '决定书' when 3 then '法' end as doc_type, case p_partkey % 5 when 0 then '公文' when 1 then '法规类型' when 2 then '其他_答复处理' when 3 then '法规类型' else '其他未分类' end as kind_group, case p_partkey % 5 when 0 then 'end' when 1 then 'end_bracket' when 2 then 'end' when 3 then 'middle' else 'not_found' end as place from part")
def document_types(t):
    """Kinds of documents by titles made of the names of parts."""
    from ..functions import documents as D

    n, name = F.col("p_partkey") % 5, F.col("p_name")
    title = F.when(n == 0, F.concat(name, F.lit("的通知"))).when(n == 1, F.concat(F.lit("令(某某"), name, F.lit("管理办法)"))).when(n == 2, F.concat(name, F.lit("处罚决定书"))).when(n == 3, F.concat(F.lit("保险法"), name)).otherwise(name)
    found = D.document_type(title)
    return t("part").select("p_partkey", found.alias("d")).select("p_partkey", "d.doc_type", F.col("d.group").alias("kind_group"), F.col("d.match_pos").alias("place"))


@query("select p_partkey, case when p_partkey % 2 = 0 then '2024-0' || (p_partkey % 9 + 1)::varchar || '-05' when p_partkey % 3 = 0 then '2023-11' else '' end as day from part")
def strict_dates(t):
    """Dates of several forms, made of the keys of parts, strictly."""
    from ..functions import text as X

    n = F.col("p_partkey")
    month = (n % 9 + 1).cast("string")
    raw = F.when(n % 2 == 0, F.concat(F.lit("2024年"), month, F.lit("月5日印发"))).when(n % 3 == 0, "2023/11").otherwise(F.concat(F.lit("约"), month, F.lit("月")))
    return t("part").select("p_partkey", X.date_strict(raw).alias("day"))
