"""Text expressions on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from .base import query


@query("select doc_id, length(x) chars, sha256(x) digest from (select doc_id, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), ' ') x from documents)")
def normalize_ws(t):
    x = T.plain_space(F.coalesce(F.col("text"), F.lit("")))
    return t("documents").select("doc_id", F.length(x).cast("long").alias("chars"), F.sha2(x, 256).alias("digest"))


_PLAIN = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?i)<br\\s*/?>|</(p|div|li|tr|h[1-6])>', chr(10), 'g'), '<[^>]+>', '', 'g')"


@query(f"select page_id, unnest(range(len(p)))::int as position, unnest(p) as paragraph from (select page_id, list_filter(list_transform(string_split(replace(replace(replace(replace(replace({_PLAIN}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), chr(10)), lambda x: trim(regexp_replace(x, '[ \\t\\r]+', ' ', 'g'), ' ')), lambda x: x <> '') p from pages)")
def html_paragraphs(t):
    """(page_id, n, position, paragraph) of each page."""
    return t("pages").select("page_id", F.posexplode(T.paragraphs(F.col("html"))).alias("position", "paragraph"))


@query("select doc_id, unnest(range(len(s)))::int as position, unnest(s) as sentence from (select doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[ \\t\\r\\n\\f]*', '\\1' || chr(10), 'g'), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') s from documents)")
def sentence_split(t):
    return t("documents").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("position", "sentence"))


@query("select doc_id, sum(sentence_chars)::bigint chars, count(*) n from (select doc_id, length(s) sentence_chars from (select doc_id, trim(unnest(string_split(regexp_replace(text, '([.!?])[ \\t\\r\\n\\f]*', '\\1' || chr(10), 'g'), chr(10))), ' ') s from documents) where s <> '') group by 1")
def sentence_stats(t):
    each = t("documents").select("doc_id", T.sentences(F.col("text")).alias("s"))
    return each.where(F.size("s") > 0).select("doc_id", F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"), F.size("s").cast("long").alias("n"))


@query("select doc_id, len(regexp_extract_all(text, '[A-Z][a-z]+')) n_names, len(list_distinct(regexp_extract_all(text, '[A-Z][a-z]+'))) n_different, regexp_extract(text, '\\b(\\d{4,})\\b', 1) first_number from documents")
def ref_extract(t):
    names = F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), 0)
    return t("documents").select("doc_id", F.size(names).cast("long").alias("n_names"), F.size(F.array_distinct(names)).cast("long").alias("n_different"), F.regexp_extract("text", r"\b(\d{4,})\b", 1).alias("first_number"))


@query("with w as (select doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{2,}')) w from documents), c as (select doc_id, w, count(*) n from w group by all), r as (select *, row_number() over (partition by doc_id order by n desc, w) r from c) select doc_id, string_agg(w || '×' || n::varchar, ',' order by r) refs from r where r <= 8 group by 1")
def ref_counts(t):
    """The eight most frequent capitalised words of each text as label×count."""
    from pyspark.sql import Window

    words = t("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{2,}"), 0)).alias("w")).groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("n"))
    top = words.withColumn("r", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "w"))).where("r <= 8")
    shown = F.transform(F.array_sort(F.collect_list(F.struct("r", "w", "n"))), lambda x: F.concat(x["w"], F.lit("×"), x["n"].cast("string")))
    return top.groupBy("doc_id").agg(F.array_join(shown, ",").alias("refs"))


@query("""select doc_id, "at", substr(text, greatest("at" - 100, 1), 200) as context from (select doc_id, text, instr(lower(text), 'licensed') as "at" from documents) where "at" > 0""")
def context_window(t):
    at = F.instr(F.lower("text"), "licensed")
    return t("documents").select("doc_id", "text", at.cast("long").alias("at")).where("at > 0").select("doc_id", "at", F.substring(F.col("text"), F.greatest(F.col("at") - 100, F.lit(1)).cast("int"), F.lit(200)).alias("context"))


@query("with c as (select doc_id, " + ", ".join(f"(length(lower(text)) - length(replace(lower(text), '{w}', ''))) // {len(w)} as {w}" for w in ("the", "der", "que")) + " from documents) select doc_id, case when greatest(the, der, que) = 0 then 'UNALIGNED' when the = greatest(the, der, que) then 'the' when der = greatest(the, der, que) then 'der' else 'que' end theme from c")
def theme_align(t):
    """The keyword that a text holds most often, ties to the first."""
    from ..operators.search import occurrences

    n = {w: occurrences(F.col("text"), w) for w in ("the", "der", "que")}
    rows = t("documents").select("doc_id", *(c.alias(w) for w, c in n.items()))
    most = F.greatest(*n)
    return rows.select("doc_id", F.when(most == 0, "UNALIGNED").when(F.col("the") == most, "the").when(F.col("der") == most, "der").otherwise("que").alias("theme"))


@query("select word, n from (select w as word, count(*) n from (select unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) w from documents) group by 1) where n >= 10 order by n desc, word limit 2000")
def frequent_words(t):
    words = t("documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), 0)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 10").orderBy(F.desc("n"), "word").limit(2000)


@query("select event_id, (props->>'k')::bigint k from events")
def json_props(t):
    return t("events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("select o_orderkey, 'DOC-' || substr(md5(o_orderkey::varchar || '|' || o_orderpriority || '|' || o_orderdate::date::varchar), 1, 16) as id from orders")
def stable_ids(t):
    """A key from the content of each order, the same in every run."""
    parts = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t("orders").select("o_orderkey", F.concat(F.lit("DOC-"), F.substring(F.md5(parts), 1, 16)).alias("id"))
