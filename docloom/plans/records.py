"""Filters, pages, facets and deduplication on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import records as R
from ..operators import windows as W
from .base import query


@query("select lang, source, count(*) n from (select *, row_number() over (partition by sha256(regexp_replace(trim(coalesce(text, '')), '\\s+', ' ', 'g')) order by doc_id) r from documents) where r = 1 group by all")
def facets_dedup(t):
    """Texts with white space normalised, hashed, first of each kept, counted by language and source."""
    key = F.sha2(F.regexp_replace(F.trim(F.coalesce("text", F.lit(""))), r"\s+", " "), 256)
    firsts = t("documents").groupBy(key.alias("digest")).agg(F.min_by(F.struct("lang", "source"), "doc_id").alias("d"))
    return firsts.groupBy("d.lang", "d.source").agg(F.count(F.lit(1)).alias("n"))


@query("select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
def exact_filter(t):
    return R.exact_filter(t("orders"), o_orderstatus="F", o_orderpriority="1-URGENT", o_custkey=None).select("o_orderkey", "o_custkey", "o_totalprice")


@query("select p_partkey, p_name from part where (contains(lower(p_name), 'a') or contains(lower(p_type), 'a')) and (contains(lower(p_name), 'widget') or contains(lower(p_type), 'widget'))")
def like_tokens(t):
    return t("part").where(R.like_tokens("A widget%", ["p_name", "p_type"])).select("p_partkey", "p_name")


@query("select c_custkey, c_name, c_acctbal, (select count(*) from customer where c_mktsegment = 'BUILDING') total from customer where c_mktsegment = 'BUILDING' order by c_acctbal desc nulls last, c_custkey limit 20 offset 20")
def paged_list(t):
    rows = R.exact_filter(t("customer"), c_mktsegment="BUILDING").select("c_custkey", "c_name", "c_acctbal")
    return R.page(rows, "c_acctbal", "c_custkey", desc=True, number=2, size=20)


@query("select 'lang' facet, lang value, count(*) n from documents group by all union all select 'source', source, count(*) from documents group by all")
def facets(t):
    return R.facets(t("documents"), ["lang", "source"])


@query("select lang, source, count(*) n, sum(n_chars)::bigint chars from documents group by rollup (lang, source)")
def facets_rollup(t):
    return t("documents").rollup("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("select doc_id from documents where trim(coalesce(text, '')) = '' or n_chars < 20")
def empty_filter(t):
    return t("documents").where((F.trim(F.coalesce("text", F.lit(""))) == "") | (F.col("n_chars") < 20)).select("doc_id")


@query("select doc_id, lang, source from (select *, row_number() over (partition by text order by doc_id) r from documents) where r = 1")
def keep_first_dedupe(t):
    d = t("documents").select("doc_id", "lang", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("k"))
    return R.keep_first(d, ["k"], ["doc_id"]).drop("k")


@query("select o_custkey, o_orderpriority, count(*) n, string_agg(o_orderkey::varchar, ',' order by o_orderkey) as rows from orders group by all having count(*) > 1")
def dup_key_report(t):
    return R.duplicate_keys(t("orders"), ["o_custkey", "o_orderpriority"], "o_orderkey")


@query("select sha256(text) digest, count(*) n, min(doc_id) first_row from documents group by 1 having count(*) > 1")
def content_hash_dups(t):
    return R.content_duplicates(t("documents"), "text", "doc_id")


@query("select o_custkey, o_orderkey, o_orderstatus from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) r from orders) where r = 1")
def latest_wins(t):
    return R.latest_wins(t("orders"), ["o_custkey"], "o_orderdate", "o_orderkey", ["o_orderkey", "o_orderstatus"])


@query("select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as version, lag(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as replaces from orders")
def version_chain(t):
    """The orders of every customer as versions of one document."""
    return R.version_chain(t("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey").select("o_orderkey", "o_custkey", "version", "replaces")


@query("""with s as (select o_custkey, o_orderdate, o_orderkey, o_orderstatus st, case left(o_orderpriority, 1) when '1' then 3 when '2' then 2 when '3' then 1 else 0 end rk from orders),
n as (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) i from s),
f as (with recursive r as (select o_custkey, i, st s, rk r, 0 c, 1 a, 0 k, 0 x from n where i = 1 union all
select n.o_custkey, n.i, case when n.st <> r.s and n.rk >= r.r then n.st else r.s end, case when n.st <> r.s and n.rk >= r.r then n.rk else r.r end, r.c + (n.st = r.s)::int, r.a + (n.st <> r.s and n.rk >= r.r)::int, r.k + (n.st <> r.s and n.rk < r.r)::int, r.x + (n.st <> r.s and n.rk >= r.r and r.a > 0 and n.rk >= 2)::int from r join n on n.o_custkey = r.o_custkey and n.i = r.i + 1) select * from r)
select o_custkey, s status, r as rank, c confirmed, a applied, k skipped, x conflicts from f qualify row_number() over (partition by o_custkey order by i desc) = 1""")
def survivorship_fold(t):
    """Order states as a ledger: priority stands for the rank of the source that reports them."""
    rank = F.when(F.col("o_orderpriority").startswith("1"), 3).when(F.col("o_orderpriority").startswith("2"), 2).when(F.col("o_orderpriority").startswith("3"), 1).otherwise(0)
    return R.survivorship(t("orders").withColumn("rk", rank), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus", "rk")


@query("select o_orderkey, case when b is null then 'added' when a is null then 'removed' else 'changed' end change from (select coalesce(x.o_orderkey, y.o_orderkey) o_orderkey, x.o_orderkey b, y.o_orderkey a, x.o_orderstatus bs, y.o_orderstatus ys from (select * from orders where o_orderkey % 7 <> 0) x full join (select o_orderkey, case when o_totalprice > 200000 then 'X' else o_orderstatus end o_orderstatus from orders where o_orderkey % 5 <> 0) y on x.o_orderkey = y.o_orderkey) where a is null or b is null or bs <> ys")
def snapshot_diff(t):
    """Two snapshots of orders made by rule: rows missing on either side, states changed on one."""
    o = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    after = o.where("o_orderkey % 5 <> 0").withColumn("o_orderstatus", F.when(F.col("o_totalprice") > 200000, "X").otherwise(F.col("o_orderstatus")))
    return R.snapshot_diff(o.where("o_orderkey % 7 <> 0"), after, "o_orderkey", "o_orderstatus")


@query("select count(*) n, sum(('0x' || substr(d, 1, 15))::hugeint)::varchar digest from (select md5(concat_ws('|', o_orderkey::varchar, o_custkey::varchar, o_orderstatus)) d from orders)")
def table_digest(t):
    return R.table_digest(t("orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("select event_id, user_id, event_type, last_value(case when event_type <> 'view' then event_type end ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as filled from events")
def forward_fill(t):
    e = t("events").withColumn("known", F.when(F.col("event_type") != "view", F.col("event_type")))
    return W.forward_fill(e, "user_id", ["ts", "event_id"], "known", "filled").select("event_id", "user_id", "event_type", "filled")


@query("select l_orderkey, l_linenumber, case when r = 1 then l_orderkey::varchar else l_orderkey::varchar || '-' || r::varchar end as id from (select *, row_number() over (partition by l_orderkey order by l_linenumber) r from lineitem)")
def ordinal_ids(t):
    return W.ordinal_ids(t("lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", ["l_linenumber"], "id")


@query("select event_id, user_id, (sum((event_type = 'purchase')::int) over (partition by user_id order by ts, event_id rows unbounded preceding))::bigint as chapter from events")
def running_index(t):
    return W.running_count(t("events"), "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", "chapter").select("event_id", "user_id", "chapter")


@query("select o_custkey as l_orderkey, count(*) n, sum((num <= b)::int)::bigint restarts, coalesce(avg(case when b is not null then (num = b + 1)::int::double end), 1.0) continuity from (select l_orderkey o_custkey, l_linenumber num, lag(l_linenumber) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) b from lineitem) group by 1")
def continuity(t):
    lines = t("lineitem").withColumn("_ord", F.struct("l_linenumber", "l_partkey", "l_suppkey"))
    return W.continuity(lines, "l_orderkey", "l_linenumber")


@query("select o_custkey, o_orderkey, o_orderdate::date::varchar o_date from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) r from orders) where r <= 3")
def keep_latest_k(t):
    return W.keep_latest(t("orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 3).select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_date"))


@query("select conv_id, turn, role, previous from (select *, lag(role) over (partition by conv_id order by turn) previous from conversations) where previous = role")
def turn_sequence(t):
    """Turns that do not alternate with the one before."""
    from pyspark.sql import Window

    rows = t("conversations").withColumn("previous", F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn")))
    return rows.where("previous = role").select("conv_id", "turn", "role", "previous")
