"""Quality, run statistics and work queues on the supplied tables: error events stand for failures, users for steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import governance as G
from ..operators import records as R
from ..operators import windows as W
from .base import query

AS_OF = "2024-01-31"


@query("with m as (select count(*) n, " + ", ".join(f"sum((upper(trim(coalesce({c}, ''))) in ('', 'N/A', 'NA', 'NULL', 'NONE'))::int) {c}" for c in ("text", "lang", "source")) + " from documents) " + " union all ".join(f"select '{c}' field, {c}::bigint n_missing, round({c} / n, 4) rate, {c} > 0.03 * n alarm from m" for c in ("text", "lang", "source")))
def null_rates(t):
    return G.null_rates(t("documents"), ["text", "lang", "source"])


@query("select errors, count(*) n from (select concat_ws(',', case when not (trim(coalesce(text, '')) <> '') then 'text' end, case when not (lang in ('en', 'fr', 'de')) then 'lang' end, case when not (n_chars <= 5000) then 'n_chars' end) errors from documents) group by 1")
def validate_quarantine(t):
    """Documents by the rules that they break."""
    rules = [("text", F.trim(F.coalesce("text", F.lit(""))) != ""), ("lang", F.col("lang").isin("en", "fr", "de")), ("n_chars", F.col("n_chars") <= 5000)]
    return G.validate(t("documents"), rules).groupBy("errors").agg(F.count(F.lit(1)).alias("n"))


@query("with d as (select round(100.0 * avg((trim(coalesce(text, '')) <> '')::int), 2) completeness, round(100.0 * count(distinct doc_id) / count(*), 2) uniqueness, round(100.0 * avg((lang in ('en', 'fr', 'de', 'es'))::int), 2) validity, round(100.0 * avg((n_chars >= 20)::int), 2) accuracy from documents) select 'completeness' as dimension, completeness score from d union all select 'uniqueness', uniqueness from d union all select 'validity', validity from d union all select 'accuracy', accuracy from d union all select 'timeliness', null from d union all select 'overall', round((completeness + uniqueness + validity + accuracy) / 4, 2) from d")
def quality_score(t):
    share = lambda c: F.avg(c.cast("double"))
    dimensions = [
        ("completeness", share(F.trim(F.coalesce("text", F.lit(""))) != "")), ("uniqueness", F.countDistinct("doc_id") / F.count(F.lit(1))), ("validity", share(F.col("lang").isin("en", "fr", "de", "es"))),
        ("accuracy", share(F.col("n_chars") >= 20)), ("timeliness", F.avg(F.lit(None).cast("double"))),
    ]
    return G.quality_score(t("documents"), dimensions)


@query(f"select event_type, round(avg(case when a <= 7 then 100.0 else 700.0 / a end), 6) score from (select event_type, datediff('day', ts::date, date '{AS_OF}') a from events) group by 1")
def age_score(t):
    age = F.datediff(F.lit(AS_OF).cast("date"), F.col("ts").cast("date"))
    return t("events").groupBy("event_type").agg(F.round(F.avg(G.age_score(age, 7)), 6).alias("score"))


@query("with e as (select user_id, ts, event_id, event_type = 'view' skipped, case when event_type <> 'view' then value end ran from events) select user_id, count(*) runs, round(avg(skipped::int), 4) skip_rate, round(quantile_cont(ran, 0.5), 6) p50, round(quantile_cont(ran, 0.9), 6) p90, round(max(ran), 6) longest, round(avg(ran), 6) as mean, round(arg_max(ran, event_id), 6) latest from e group by 1")
def step_percentiles(t):
    return G.step_durations(t("events"), "user_id", "value", "event_id", F.col("event_type") == "view")


@query("with e as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) r, event_type = 'error' bad from events) select user_id, (coalesce(min(case when not bad then r end), count(*) + 1) - 1)::bigint streak from e group by 1")
def breach_streak(t):
    return W.streak(t("events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@query("select event_id, user_id, event_type, previous from (select *, lag(event_type) over (partition by user_id order by ts, event_id) previous from events) where previous <> event_type")
def status_change(t):
    return W.changes(t("events").select("event_id", "user_id", "event_type", "ts"), "user_id", ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type", "previous")


@query("with i as (select strftime(o_orderdate, '%Y-%m') m, case when o_orderstatus = 'F' then strftime(o_orderdate::date + 30, '%Y-%m') end e from orders) select m as month, sum(c)::bigint created, sum(r)::bigint resolved, sum(c - r)::bigint net from (select m, 1 c, 0 r from i union all select e, 0, 1 from i where e is not null) group by 1")
def month_growth(t):
    return G.growth(t("orders"), "o_orderdate", F.when(F.col("o_orderstatus") == "F", F.date_add(F.col("o_orderdate").cast("date"), 30)))


@query(f"select event_type, case when a <= 3 then '0-3' when a <= 7 then '4-7' when a <= 14 then '8-14' else '15+' end bucket, count(*) n from (select event_type, datediff('day', ts::date, date '{AS_OF}') a from events) group by all")
def aging_buckets(t):
    age = F.datediff(F.lit(AS_OF).cast("date"), F.col("ts").cast("date"))
    return t("events").groupBy("event_type", G.age_bucket(age).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("select ts::date::varchar as day, count(*) runs, round(1 - avg((event_type = 'error')::int), 4) pass_rate from events group by 1")
def pass_rate(t):
    ok = (F.col("event_type") != "error").cast("double")
    return t("events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("runs"), F.round(F.avg(ok), 4).alias("pass_rate"))


@query("with e as (select user_id, event_id, event_type in ('purchase') closing, max(case when event_type = 'purchase' then event_id end) over (partition by user_id) ended from events) select user_id, min(case when not closing and (ended is null or event_id > ended) then event_id end) opened, sum((not closing and (ended is null or event_id > ended))::int)::bigint seen, count(*) entries, case when min(case when not closing and (ended is null or event_id > ended) then event_id end) is null then 'closed' else 'open' end state from e group by 1")
def worklist_upsert(t):
    return G.upsert(t("events"), ["user_id"], "event_id", "event_type", ["purchase"])


@query("select event_id, event_type, case event_type when 'error' then 'stop_chain' when 'purchase' then 'continue' when 'view' then 'skip' else 'stop_chain' end as action from events")
def failure_matrix(t):
    e = t("events").select("event_id", "event_type")
    matrix = e.sparkSession.createDataFrame([("error", "stop_chain"), ("purchase", "continue"), ("view", "skip")], "event_type string, action string")
    return G.by_matrix(e, matrix, ["event_type"], "action", "stop_chain")


@query("with q as (select distinct l_orderkey, l_partkey from lineitem where l_linenumber <= 3), r as (select l_orderkey, l_partkey, count(*) n, max((l_linestatus = 'O')::int) p, max((l_linestatus = 'F')::int) d from lineitem where l_quantity > 10 group by all), e as (select l_orderkey, l_partkey, count(*) n from lineitem where l_returnflag = 'R' group by all), g as (select l_orderkey, l_partkey, case when r.n is null then 'not_executed' when r.p = 1 then 'partial' when r.d = 1 and coalesce(e.n, 0) = 0 then 'no_evidence' when r.d = 1 and coalesce(e.n, 0) < 2 then 'insufficient' end gap_class from q left join r using (l_orderkey, l_partkey) left join e using (l_orderkey, l_partkey)) select l_orderkey, l_partkey, gap_class, case gap_class when 'not_executed' then 'high' when 'insufficient' then 'low' else 'medium' end severity from g where gap_class is not null")
def gap_rules(t):
    """Lines as requirements, shipped lines as records, returns as evidence."""
    lines, keys = t("lineitem"), ["l_orderkey", "l_partkey"]
    status = F.when(F.col("l_linestatus") == "O", "partial").otherwise("executed")
    records = lines.where("l_quantity > 10").select(*keys, status.alias("exec_status"))
    return G.gaps(lines.where("l_linenumber <= 3").select(*keys).distinct(), records, lines.where("l_returnflag = 'R'").select(*keys), keys)


@query("select o_orderkey, case when o_totalprice > 300000 then 'large' when o_orderstatus = 'F' and o_orderpriority = '1-URGENT' then 'urgent_done' when o_orderpriority = '1-URGENT' then 'urgent' else 'other' end as decision from orders")
def first_match_rules(t):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    rules = [("large", F.col("o_totalprice") > 300000), ("urgent_done", (F.col("o_orderstatus") == "F") & urgent), ("urgent", urgent)]
    return t("orders").select("o_orderkey", R.first_match(rules, "other").alias("decision"))


@query("select 'status_domain' as gate, count(*) violations from orders where o_orderstatus not in ('O', 'F', 'P') union all select 'customer_reference', count(*) from orders where not exists (select 1 from customer where c_custkey = o_custkey) union all select 'price_positive', count(*) from orders where not (o_totalprice > 0) union all select 'key_unique', count(*) - count(distinct o_orderkey) from orders")
def gates(t):
    """Assertions on orders: how many rows break each."""
    o = t("orders")
    count = lambda df, name: df.agg(F.lit(name).alias("gate"), F.count(F.lit(1)).alias("violations"))
    refs = o.join(t("customer"), F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    unique = o.agg(F.lit("key_unique").alias("gate"), (F.count(F.lit(1)) - F.countDistinct("o_orderkey")).alias("violations"))
    return count(o.where(~F.col("o_orderstatus").isin("O", "F", "P")), "status_domain").union(count(refs, "customer_reference")).union(count(o.where("not (o_totalprice > 0)"), "price_positive")).union(unique)


@query("select user_id, max(n)::bigint most from (select user_id, count(*) over (partition by user_id order by ts range between interval 1 hour preceding and current row) n from events) group by 1")
def rate_limit(t):
    """The most events of each user within an hour."""
    from pyspark.sql import Window

    hour = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-3_600_000_000, 0)
    return t("events").withColumn("n", F.count(F.lit(1)).over(hour)).groupBy("user_id").agg(F.max("n").alias("most"))


@query("select time_bucket(interval 1 day, ts)::varchar as day, event_type, count(*) n, round(sum(value), 4) as total from events group by all")
def event_tumbling(t):
    from ..streaming.events import tumbling

    return tumbling(t("events")).withColumn("total", F.round("total", 4))


@query("with h as (select generate_series from generate_series(0, 1)) select (time_bucket(interval 12 hour, ts) - generate_series * interval 12 hour)::varchar as start, event_type, count(*) n from events, h group by all")
def event_sliding(t):
    from ..streaming.events import sliding

    return sliding(t("events"))


@query("with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 6 hour then 0 else 1 end brk from events), s as (select *, sum(brk) over (partition by user_id order by ts rows unbounded preceding) sid from e) select user_id, min(ts)::varchar as start, count(*) n from s group by user_id, sid")
def event_session(t):
    from ..streaming.events import sessions

    return sessions(t("events"))


@query("select distinct user_id from events")
def stream_dedupe(t):
    """Each user once: the batch form of the stream's deduplication."""
    from ..streaming.events import once

    return once(t("events"), "user_id").select("user_id")
