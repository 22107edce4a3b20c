"""Likeness joins, names in running text and cited clauses on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..checkpoints import cut
from ..operators import likeness as L
from ..operators import names as N
from .base import query


@query()
def title_ratio_pairs(t):
    """Parts of one type and size whose names stand for one document, by the share of matching blocks."""
    return L.same_titles(t("part"), "p_partkey", "p_name", within=["p_type", "p_size"])


@query()
def dictionary_check(t):
    """Words of documents that the dictionary does not have, with the entry that they are likely to stand for.

    Words are runs of letters of any script. The dictionary is made of those that twenty or more documents hold, the most
    frequent first; all others are asked, whatever their length, those of a single document too.
    """
    words = t("documents").select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}[\p{L}\p{M}]*"), F.lit(0)))).alias("w"))
    counted = cut(words.groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    entries = counted.where("n >= 20").select(F.col("w").alias("entry"), F.concat(F.lpad((10**12 - F.col("n")).cast("string"), 13, "0"), F.col("w")).alias("place"))
    return L.nearest_words(counted.where("n < 20"), "w", entries, "entry", "place")


@query("select d.doc_id, b.item_id from documents d, (select item_id, left(text, 40) as lead from benchmark where length(text) >= 40) b where contains(d.text, b.lead) group by all")
def names_mentioned(t):
    """Documents that hold the first forty letters of a benchmark item, all items found in one pass."""
    leads = t("benchmark").where(F.length("text") >= 40).select("item_id", F.left("text", F.lit(40)).alias("lead"))
    found = N.names_in(t("documents"), "doc_id", "text", leads, "lead", longest=False).select(F.col("row").alias("doc_id"), "name").distinct()
    return found.join(leads, F.col("name") == F.col("lead")).select("doc_id", "item_id").distinct()


_TITLE = "'某' || (p_partkey % 50)::varchar || '号管理办法'"


@query(f"""with p as (select p_partkey, {_TITLE} title, p_partkey % 50 k, p_size from part), first as (select title, min(p_partkey) dst from p group by 1),
c as (select p_partkey src, '某' || ((k * 7 + 3) % 50)::varchar || '号管理办法' title, p_size art, p_size % 4 para from p),
e as (select src, dst, art, para from c join first using (title)), n as (select count(*) over () as z, p_partkey doc, p_size number from p), s as (select doc, max(number) number, 1 as size from n group by doc)
select src, dst, 'article' as kind, art as article, case when para > 0 then para end as para, null::int as item, 1::bigint as n, case when s.number = art then 'verified' when art > s.size then 'out_of_range' else 'in_range_unmatched' end as state from e join s on s.doc = e.dst
union all select src, dst, 'title', null, null, null, 1, null from e where src <> dst""")
def clause_edges(t):
    """Edges of rules made of parts: each cites one article of another rule by its title."""
    p = t("part").select("p_partkey", "p_size", (F.col("p_partkey") % 50).cast("int").alias("k"))
    title = lambda k: F.concat(F.lit("某"), k.cast("string"), F.lit("号管理办法"))
    para = F.when(F.col("p_size") % 4 > 0, F.concat(F.lit("第"), (F.col("p_size") % 4).cast("string"), F.lit("款"))).otherwise("")
    body = F.concat(F.lit("根据《"), title((F.col("k") * 7 + 3) % 50), F.lit("》第"), F.col("p_size").cast("string"), F.lit("条"), para, F.lit("制定。"))
    docs = p.select("p_partkey", title(F.col("k")).alias("title"), body.alias("body"))
    clauses = p.select(F.col("p_partkey").alias("doc"), F.col("p_size").alias("number"))
    return N.clause_graph(docs, "p_partkey", "title", "body", clauses)


@query("select p_partkey, case when p_partkey % 4 < 3 and p_partkey % 50 < 30 then 'R' || (p_partkey % 50)::varchar end as target, case when p_partkey % 4 < 3 and p_partkey % 50 between 30 and 39 then 'W' || (p_partkey % 50)::varchar end as weak_key, case when p_partkey % 4 = 3 or p_partkey % 50 >= 40 then 'unresolved' when p_partkey % 4 = 0 then 'title' else 'title_contains' end as method from part")
def resolve_target(t):
    """Titles made of parts, quoted whole, inside a longer title, or cut short, resolved to a strong and a weak index."""
    from ..operators import relations as R

    k = (F.col("p_partkey") % 50).cast("string")
    whole = F.concat(F.lit("某"), k, F.lit("号管理办法"))
    form = F.col("p_partkey") % 4
    title = F.when(form == 0, F.concat(F.lit("《"), whole, F.lit("》"))).when(form == 1, F.concat(F.lit("关于印发《"), whole, F.lit("》实施细则"))).when(form == 2, F.concat(F.lit("某"), k, F.lit("号管"))).otherwise("并无此文件可查")
    refs = t("part").select("p_partkey", title.alias("title"), F.lit("").alias("number"))
    made = t("part").select((F.col("p_partkey") % 50).alias("k")).distinct().select("k", F.concat(F.lit("某"), F.col("k").cast("string"), F.lit("号管理办法")).alias("title"), F.lit("").alias("number"))
    strong = made.where("k < 30").select(F.concat(F.lit("R"), F.col("k").cast("string")).alias("ref"), "title", "number")
    weak = made.where("k between 30 and 39").select(F.concat(F.lit("W"), F.col("k").cast("string")).alias("ref"), "title", "number")
    return R.resolve_target(refs, strong, weak).select("p_partkey", "target", "weak_key", "method")


@query("""with p as (select p_partkey doc, p_partkey % 30 k, 30 + p_partkey * 3 % 30 j, (p_size % 6 + 1)::int a from part)
select doc, '某' || k::varchar || '号办法' title, null::int src_article, 'basis' as kind, 'R' || k::varchar as target, null::int as article, null::varchar as state from p
union all select doc, '某' || j::varchar || '号办法', 1, 'basis', case when j < 45 then 'R' || j::varchar end, a, case when j < 45 then case when a <= j % 4 + 1 then 'verified' else 'out_of_range' end end from p""")
def relation_edges(t):
    """Located relations of texts made of parts: each cites one rule in its head, and an article of another in its first article."""
    from ..operators import relations as R

    k, j = F.col("p_partkey") % 30, F.lit(30) + F.col("p_partkey") * 3 % 30
    title = lambda n: F.concat(F.lit("某"), n.cast("string"), F.lit("号办法"))
    body = F.concat(F.lit("根据《"), title(k), F.lit("》制定。\n第一条 依据《"), title(j), F.lit("》第"), (F.col("p_size") % 6 + 1).cast("string"), F.lit("条办理。"))
    docs = t("part").select(F.col("p_partkey").alias("doc_id"), body.alias("text"))
    rules = t("part").select((F.col("p_partkey") % 45).alias("i")).distinct().select("i", F.concat(F.lit("R"), F.col("i").cast("string")).alias("ref"), F.lit("").alias("number"), title(F.col("i")).alias("title"))
    clauses = rules.select(F.col("ref").alias("doc"), F.explode(F.sequence(F.lit(1), (F.col("i") % 4 + 1).cast("int"))).alias("number"))
    return R.located(docs, rules.drop("i"), clauses).select("doc", "title", "src_article", "kind", "target", "article", "state")


@query("""with p as (select p_partkey, p_partkey % 40 k, p_size % 3 s from part), i as (select p_partkey as row, case s when 0 then k else -1 end no, case s when 1 then k else -2 end ti, case s when 2 then k else -3 end co, k from p)
select row, 'G' || lpad(case when no >= 0 then no when ti >= 0 then ti else co end::varchar, 2, '0') as ref, case when no >= 0 then 1 when ti >= 0 then 2 else 3 end as level from i""")
def registry_levels(t):
    """Records made of parts, registered by number, by theme and title, or by a title that is part of another on the same day."""
    from ..operators import registry as G

    k, s = F.lpad((F.col("p_partkey") % 40).cast("string"), 2, "0"), F.col("p_size") % 3
    whole = lambda n: F.concat(F.lit("某类"), n, F.lit("号业务管理办法"))
    number, day = lambda n: F.concat(F.lit("保监发〔2014〕1"), n, F.lit("号")), lambda n: F.concat(F.lit("2020-01-"), n)
    asked = t("part").select(F.col("p_partkey").alias("row"), F.when(s == 1, "T").otherwise("").alias("theme"), F.when(s == 0, "无名").when(s == 1, whole(k)).otherwise(F.concat(F.lit("关于"), whole(k), F.lit("的通知"))).alias("title"), F.when(s == 0, number(k)).otherwise("").alias("number"), F.when(s == 2, day(k)).otherwise("").alias("published"))
    made = t("part").select(F.lpad((F.col("p_partkey") % 40).cast("string"), 2, "0").alias("n")).distinct()
    by_number = made.select(F.concat(F.lit("G"), "n").alias("ref"), F.lit("U").alias("theme"), F.lit("别名").alias("title"), number(F.col("n")).alias("number"), F.lit("").alias("published"))
    by_title = made.select(F.concat(F.lit("G"), "n").alias("ref"), F.lit("T").alias("theme"), whole(F.col("n")).alias("title"), F.lit("").alias("number"), day(F.col("n")).alias("published"))
    return G.registered(asked, by_number.union(by_title))
