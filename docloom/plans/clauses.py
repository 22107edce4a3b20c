"""Clause operators on the supplied tables, with Latin marks in place of the Chinese ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clauses as C
from .base import query

ARTICLE, CHAPTER = r"^(The|Of|In|On)(?:[ .,]|$)", r"^(And|To)(?:[ .,]|$)"
_LINES = "select doc_id as doc, u.pos - 1 as line, trim(u.l, ' ') as text from (select doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)), lambda l, i: {'l': l, 'pos': i})) u from documents) where trim(u.l, ' ') <> ''"
_CLAUSES = f"""with l as ({_LINES}), m as (select *, regexp_matches(text, '^(The|Of|In|On)(?:[ .,]|$)') a, regexp_matches(text, '^(And|To)(?:[ .,]|$)') c from l),
w as (select *, sum(a::int) over (partition by doc order by line) article, sum(c::int) over (partition by doc order by line) chapter from m)"""


@query(_CLAUSES + " select doc, article::bigint as article, min(chapter)::bigint as chapter, max(case when a then regexp_extract(text, '^(The|Of|In|On)(?:[ .,]|$)', 1) end) mark, count(*) filter (where not a or trim(regexp_replace(text, '^(The|Of|In|On)(?:[ .,]|$)', ''), ' ') <> '') n_lines from w where article > 0 and not c group by doc, article")
def clause_articles(t):
    """Articles of each document with the number of their lines."""
    d = t("documents")
    rows = C.articles(d, "doc_id", "text", ARTICLE, CHAPTER)
    n = F.when(F.col("body") == "", 0).otherwise(F.size(F.split("body", "\n")))
    return rows.select("doc", "article", "chapter", "mark", n.cast("long").alias("n_lines"))


@query(_CLAUSES + ", n as (select doc, max(article) n from w where not c group by 1) select doc_id as doc, coalesce(n.n, 0)::bigint n_articles from documents left join n on n.doc = doc_id")
def clause_counts(t):
    d = t("documents")
    clauses = C.articles(d, "doc_id", "text", ARTICLE, CHAPTER)
    return C.structure(d, clauses).select("doc", "n_articles")


_BODIES = _CLAUSES + ", b as (select doc, article, string_agg(x, chr(10) order by line) body from (select doc, article, line, case when a then trim(regexp_replace(text, '^(The|Of|In|On)(?:[ .,]|$)', ''), ' ') else text end x from w where article > 0 and not c) where x <> '' group by all), k as (select distinct doc, article from w where article > 0 and not c)"


@query(_BODIES + " select concat_ws(':', 'clause', k.doc::varchar, k.article::varchar, substr(sha256(coalesce(b.body, '')), 1, 12)) chunk_id, k.doc, k.article::bigint as article, coalesce(b.body, '') body from k left join b using (doc, article)")
def clause_chunks(t):
    return C.chunks(C.articles(t("documents"), "doc_id", "text", ARTICLE, CHAPTER))


_MARKS = [r"^(The)(?:[ .,]|$)", r"^(Of|In|On)(?:[ .,]|$)", r"^(And|To)(?:[ .,]|$)"]


@query(f"""with l as ({_LINES}), m as (select *, case when regexp_matches(text, '^(The)(?:[ .,]|$)') then 1 when regexp_matches(text, '^(Of|In|On)(?:[ .,]|$)') then 2 when regexp_matches(text, '^(And|To)(?:[ .,]|$)') then 3 end v from l),
u as (select *, count(v) over (partition by doc order by line) unit from m), p as (select *, last_value(case when v = 1 then unit end ignore nulls) over w p1, last_value(case when v = 2 then unit end ignore nulls) over w p2 from u window w as (partition by doc order by line))
select doc, unit, v as level, case when v = 1 then 0 when v = 2 then coalesce(p1, 0) else greatest(coalesce(p1, 0), coalesce(p2, 0)) end parent from p where v is not null""")
def outline_units(t):
    """Outline units of three levels with the unit above each."""
    return C.outline(t("documents"), "doc_id", "text", _MARKS).select("doc", "unit", "level", "parent")


@query(_BODIES + """ select k.doc, count(*) articles, sum(len(list_filter(string_split(coalesce(b.body, ''), chr(10)), lambda x: regexp_matches(x, '^Th'))))::bigint items, sum(len(regexp_extract_all(coalesce(b.body, ''), '[A-Z][a-z]+')))::bigint as "references", sum(len(regexp_extract_all(coalesce(b.body, ''), 'the|and')))::bigint duties, sum(length(coalesce(b.body, '')))::bigint as characters from k left join b using (doc, article) group by 1""")
def clause_semantics(t):
    return C.semantics(C.articles(t("documents"), "doc_id", "text", ARTICLE, CHAPTER), "^Th", "[A-Z][a-z]+", "the|and")


@query(_BODIES + """, f as (select k.doc, max((coalesce(b.body, '') = '')::int) e, max(regexp_matches(coalesce(b.body, ''), '[ \\t\\x{3000}]{2,}')::int) w from k left join b using (doc, article) group by 1)
select doc_id as doc, case when f.doc is not null then 'V002' else '' end errors, concat_ws(',', case when e = 1 then 'V006' end, case when doc_id % 7 = 0 then 'V007' end, case when w = 1 then 'V010' end) warnings, case when f.doc is not null then 'FAILED' when doc_id % 7 = 0 then 'PASSED_WITH_WARNINGS' else 'PASSED' end status from documents left join f on f.doc = doc_id""")
def clause_checks(t):
    """The ten clause rules on documents; Latin marks are no numbers, so V002 fails wherever there are articles."""
    d = t("documents")
    meta = d.select(F.col("doc_id").alias("doc"), F.col("doc_id").cast("string").alias("dedup_key"), F.lit("t").alias("title"), F.lit("u").alias("source_url"), F.when(F.col("doc_id") % 7 == 0, "none").otherwise("RFN-1").alias("rfn"), F.lit(None).cast("int").alias("article_count"))
    return C.validate(meta, C.articles(d, "doc_id", "text", ARTICLE, CHAPTER), "^§$").select("doc", "errors", "warnings", "status")
