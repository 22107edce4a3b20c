"""Reference resolution on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matching as M
from .base import query


@query("select l_orderkey, l_linenumber, coalesce((case when l_suppkey % 3 = 0 then s.s_name end), p.p_name, n.n_name) as title from lineitem left join supplier s on s.s_suppkey = l_suppkey and l_suppkey % 3 = 0 left join part p on p.p_partkey = l_partkey and l_partkey % 2 = 0 left join nation n on n.n_nationkey = l_orderkey % 25")
def bridge_cascade(t):
    """Every line's name by supplier, else by part, else by a nation key."""
    return _titled(t, t("lineitem"))


def _titled(t, lines):
    lines = lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    sides = [
        (F.col("l_suppkey"), t("supplier").where("s_suppkey % 3 = 0"), "s_suppkey", "s_suppkey", "s_name"),
        (F.col("l_partkey"), t("part").where("p_partkey % 2 = 0"), "p_partkey", "p_partkey", "p_name"),
        (F.col("l_orderkey") % 25, t("nation"), "n_nationkey", "n_nationkey", "n_name"),
    ]
    return M.cascade(lines, sides, "title").select("l_orderkey", "l_linenumber", "title")


@query("select o_orderkey, coalesce(c_name, 'customer ' || o_custkey::varchar) title from orders left join customer on c_custkey = o_custkey")
def title_lookup(t):
    met = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return met.select("o_orderkey", F.coalesce("c_name", F.concat(F.lit("customer "), F.col("o_custkey").cast("string"))).alias("title"))


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def anti_missing(t):
    return t("customer").join(t("orders"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("select s_suppkey, s_name from supplier where exists (select 1 from lineitem where l_suppkey = s_suppkey and l_quantity > 45)")
def semi_known(t):
    return t("supplier").join(t("lineitem").where("l_quantity > 45"), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").select("s_suppkey", "s_name")


@query("select p_type as key, min(p_partkey) as value from (select p_type || '/' || p_size::varchar p_type, p_partkey from part) group by 1 having count(distinct p_partkey) = 1")
def unique_key_match(t):
    return M.unique_keys(t("part"), F.concat_ws("/", "p_type", F.col("p_size").cast("string")), "p_partkey")


@query("""with refs as (select p_partkey, p_name, p_type || '/' || p_size::varchar k2, p_brand from part where p_partkey % 2 = 0),
idx as (select p_partkey v, p_name, p_type || '/' || p_size::varchar k2, p_brand from part where p_partkey % 2 = 1),
a as (select p_name k, min(v) v from idx group by 1 having min(v) = max(v)), b as (select k2 k, min(v) v from idx group by 1 having min(v) = max(v)), c as (select p_brand k, min(v) v from idx group by 1 having min(v) = max(v))
select r.p_partkey, coalesce(a.v, b.v, c.v) target, case when a.v is not null then 'name' when b.v is not null then 'type' when c.v is not null then 'brand' else 'unresolved' end as method, case when a.v is not null then 1.0 when b.v is not null then 0.9 when c.v is not null then 0.7 else 0.0 end::double confidence from refs r left join a on a.k = r.p_name left join b on b.k = r.k2 left join c on c.k = r.p_brand""")
def tiered_resolution(t):
    """Even parts resolved to odd ones: by name, else by type and size, else by brand; ambiguous keys resolve nothing."""
    part = t("part")
    kind = F.concat_ws("/", "p_type", F.col("p_size").cast("string"))
    keys = [("name", F.col("p_name"), F.col("p_name"), 1.0), ("type", kind, kind, 0.9), ("brand", F.col("p_brand"), F.col("p_brand"), 0.7)]
    out = M.tiers(part.where("p_partkey % 2 = 0"), "p_partkey", part.where("p_partkey % 2 = 1"), "p_partkey", keys)
    return out.select("p_partkey", "target", "method", "confidence")


@query("select doc_id, item_id from documents d, benchmark b where contains(lower(d.text), lower(b.text))")
def containment_match(t):
    return M.contained(t("documents"), "doc_id", "text", t("benchmark"), "item_id", "text")


@query("select a.o_orderkey, case when b.o_orderkey is null then 'absent' when a.o_orderpriority = b.p then 'ok' when left(a.o_orderpriority, 1) = left(b.p, 1) then 'C1' else 'C2' end drift from orders a left join (select o_orderkey, case o_orderkey % 4 when 0 then o_orderpriority when 1 then left(o_orderpriority, 1) || '?' when 2 then '9' end p from orders where o_orderkey % 4 < 3) b using (o_orderkey)")
def drift_classes(t):
    """Orders against a copy made by rule, with rows dropped and names changed in part or wholly."""
    o = t("orders").select("o_orderkey", "o_orderpriority")
    name = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority")).when(F.col("o_orderkey") % 4 == 1, F.concat(F.left("o_orderpriority", F.lit(1)), F.lit("?"))).otherwise("9")
    return M.drift(o, o.where("o_orderkey % 4 < 3").withColumn("o_orderpriority", name), "o_orderkey", "o_orderpriority", F.left("o_orderpriority", F.lit(1)))


@query('''with m as (select event_id, user_id, epoch_us(ts)::bigint as "at" from events where event_type = 'signup'), p as (select event_id, user_id, epoch_us(ts)::bigint as "at" from events where event_type = 'error') select p.user_id, p."at", (select max(m.event_id) from m where m.user_id = p.user_id and m."at" = (select max(m2."at") from m m2 where m2.user_id = p.user_id and m2."at" <= p."at")) as event_id from p''')
def clause_span_interval(t):
    """Each error with the sign-up of its user that came last before it."""
    e = t("events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_type")
    marks = e.where("event_type = 'signup'").groupBy("user_id", "at").agg(F.max("event_id").alias("event_id"))
    return M.locate(e.where("event_type = 'error'").select("user_id", "at"), "at", marks, "user_id", "at", "event_id")


@query('''select event_id, user_id, epoch_us(ts)::bigint as "at", coalesce(lead(epoch_us(ts)) over (partition by user_id order by ts), 9999999999999999)::bigint until from events where event_type = 'purchase' ''')
def mark_spans(t):
    marks = t("events").where("event_type = 'purchase'").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at")).withColumn("end", F.lit(9999999999999999))
    return M.spans(marks, "user_id", "at", "end").drop("end")


@query("select o_orderkey, coalesce(a.v, b.v) status, case when a.k is not null then 'number' when b.k is not null then 'title' else 'none' end as method from (select o_orderkey, o_custkey::varchar k1, left(o_orderpriority, 3) k2 from orders) left join (select c_custkey::varchar k, arg_max(c_mktsegment, c_custkey) v from customer where c_custkey % 3 = 0 group by 1) a on a.k = k1 left join (select left(c_mktsegment, 3) k, arg_max(c_mktsegment, c_custkey) v from customer where c_custkey % 3 = 0 group by 1) b on b.k = k2")
def status_match(t):
    """Orders matched with a ledger by number, else by the head of a title."""
    ledger = t("customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("no"), F.left("c_mktsegment", F.lit(3)).alias("head"), F.col("c_mktsegment").alias("status"), "c_custkey")
    keys = [("number", F.col("o_custkey").cast("string")), ("title", F.left("o_orderpriority", F.lit(3)))]
    return M.by_first_key(t("orders"), keys, ledger, [F.col("no"), F.col("head")], "status", "c_custkey").select("o_orderkey", "status", "method")


@query("""with w as (select distinct doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) w from documents), i as (select item, n, unnest(k) w from (values (1, 3, ['the', 'of', 'token']), (2, 2, ['licensed', 'apache']), (3, 4, ['der', 'die', 'und', 'mit'])) v(item, n, k)), h as (select doc_id, item, n, count(*) c from w join i using (w) group by all), e as (select doc_id, x.item from w join (values (1, 'secret'), (2, 'license'), (3, 'wort')) x(item, w) using (w)),
a as (select doc_id, item, 'keyword' m, least(0.9, 0.5 + 0.4 * c / n) s from h union all select doc_id, item, 'explicit', 1.0 from e)
select doc_id, item, arg_max(m, s) as method, round(max(s), 4)::double confidence, case when max(s) >= 0.75 then 'confirmed' else 'review' end as status from a group by all""")
def clause_items(t):
    """Documents and items of a framework, by an explicit word or by keywords."""
    d = t("documents")
    items = d.sparkSession.createDataFrame([(1, "secret", ["the", "of", "token"]), (2, "license", ["licensed", "apache"]), (3, "wort", ["der", "die", "und", "mit"])], "item int, word string, keywords array<string>")
    return M.by_keywords(d, "doc_id", "text", items, "item", "keywords", "word")


@query("select p, keep from (select doc_id::varchar p, min(doc_id::varchar) over (partition by coalesce(text, '')) keep from documents) where p <> keep")
def storage_duplicates(t):
    files = t("documents").select(F.col("doc_id").cast("string").alias("p"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    return M.storage_plan(files, "sha", "p")


@query("with s as (select doc_id, regexp_replace(trim(coalesce(text, ''), ' '), '\\s+', ' ', 'g') x from documents), a as (select doc_id q, lower(regexp_replace(left(x, 60), ' \\S*$', '')) s from s where doc_id % 2 = 1 and length(regexp_replace(left(x, 60), ' \\S*$', '')) >= 30), k as (select doc_id::varchar v, lower(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) x from documents where doc_id % 2 <> 1) select q doc_id, min(v) as number from a join k on contains(k.x, a.s) group by 1 having count(distinct v) = 1")
def number_inheritance(t):
    """Documents without a number (made by rule) take that of the only document that holds their first words."""
    d = t("documents").select("doc_id", "text", F.when(F.col("doc_id") % 2 != 1, F.col("doc_id").cast("string")).otherwise("").alias("number"))
    return M.inherited(d, "doc_id", "text", "number")


@query("""with r as (select p_partkey e, p_name t from part where p_partkey % 2 = 1), q as (select p_partkey ref, case p_partkey % 3 when 0 then p_name when 1 then upper(p_name) || ' ' else substr(p_name, 1, 12) end n from part where p_partkey % 4 = 0),
a as (select t k, min(e) v from r group by 1 having min(e) = max(e)), b as (select lower(regexp_replace(t, '\\s', '', 'g')) k, min(e) v from r group by 1 having min(e) = max(e)), c as (select q.ref, min(r.e) v from q join r on contains(lower(r.t), lower(q.n)) where length(q.n) >= 4 group by 1 having min(r.e) = max(r.e))
select q.ref p_partkey, coalesce(a.v, b.v, c.v) target, case when a.v is not null then 'exact' when b.v is not null then 'key' when c.v is not null then 'contains' else 'unresolved' end as method from q left join a on a.k = q.n left join b on b.k = lower(regexp_replace(q.n, '\\s', '', 'g')) left join c on c.ref = q.ref""")
def alias_resolution(t):
    """Names of parts written in three ways against a registry of other parts."""
    n = F.col("p_partkey") % 3
    name = F.when(n == 0, F.col("p_name")).when(n == 1, F.concat(F.upper("p_name"), F.lit(" "))).otherwise(F.substring("p_name", 1, 12))
    refs = t("part").where("p_partkey % 4 = 0").select("p_partkey", name.alias("name"))
    registry = t("part").where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("entity"), "p_name")
    return M.aliases(refs, "p_partkey", "name", registry, "entity", "p_name", lambda c: F.lower(F.regexp_replace(c, r"\s", "")))


@query("select p_brand, p_type, (select max(p_partkey) from part where p_size < 25) + row_number() over (order by p_brand, p_type) as number from (select distinct p_brand, p_type from part where p_size >= 25 and (p_brand, p_type) not in (select (p_brand, p_type) from part where p_size < 25))")
def registration(t):
    """Kinds of large parts that small ones do not have, registered with new numbers."""
    old = t("part").where("p_size < 25").select("p_brand", "p_type", F.col("p_partkey").alias("number"))
    return M.registered(old, t("part").where("p_size >= 25").select("p_brand", "p_type"), ["p_brand", "p_type"], "number")


@query("select o_orderkey, case when trim(s) = '' then coalesce(m, '') else s end o_orderstatus from (select o_orderkey, o_custkey c, case when o_orderkey % 3 = 0 then ' ' else o_orderstatus end s from orders) left join (select c_custkey k, c_mktsegment m from customer where c_custkey % 2 = 0) on k = c")
def fill_blank(t):
    """Orders without a state take their customer's segment."""
    rows = t("orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    meta = t("customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("o_orderstatus"))
    return M.filled_from(rows, "o_custkey", meta, ["o_orderstatus"]).select("o_orderkey", "o_orderstatus")


@query("select l_suppkey, string_agg(distinct l_returnflag, ',' order by l_returnflag) cited_by, arg_max(l_partkey, (l_extendedprice, l_partkey)) as best from (select l_suppkey, l_returnflag, l_extendedprice, l_partkey from lineitem) group by 1")
def upper_anchors(t):
    """Anchors with the set of kinds that cite them and their best candidate."""
    cited = F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",")
    return t("lineitem").groupBy("l_suppkey").agg(cited.alias("cited_by"), F.max_by("l_partkey", F.struct("l_extendedprice", "l_partkey")).alias("best"))


@query("select l_orderkey, l_linenumber from lineitem where l_partkey = 7 or l_suppkey = 3")
def clause_lookup(t):
    """Lines of a part or of a supplier, each once."""
    return t("lineitem").where("l_partkey = 7 or l_suppkey = 3").select("l_orderkey", "l_linenumber")
