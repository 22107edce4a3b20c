"""Run ledgers and queues on the supplied tables: events as steps, orders as queue entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger as L
from .base import query

AS_OF = "2024-01-31"


@query("select user_id, event_type, event_id, value from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1")
def step_upsert(t):
    """The last written record of each step."""
    e = t("events").select("user_id", "event_type", "event_id", "value", "ts")
    return L.last_write(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_linestatus = 'F')")
def checkpoint_pending(t):
    done = t("lineitem").select("l_orderkey", F.when(F.col("l_linestatus") == "F", "done").otherwise("failed").alias("state"))
    return L.pending(t("orders").select("o_orderkey"), done.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "state")


@query("select event_id, user_id from events where event_id > (select max(event_id) from events where event_type = 'signup')")
def ingest_since(t):
    """Events after the last one that an earlier run took in (the last sign-up)."""
    e = t("events")
    return L.since(e, "event_id", e.where("event_type = 'signup'"), "event_id").select("event_id", "user_id")


@query("select user_id, arg_max(event_type, event_id) as version, arg_max(value, event_id) as inputs, max(event_id) as \"at\", count(*) runs from events group by 1")
def watermark_record(t):
    return L.watermarks(t("events"), "user_id", "event_type", "event_id", "value")


@query("select l_orderkey, string_agg(distinct l_shipmode, ',' order by l_shipmode) paths from (select l_orderkey, l_returnflag as l_shipmode from lineitem union all select l_orderkey, l_linestatus from lineitem) group by 1")
def artifact_paths(t):
    """Two registers of paths (flags and states of an order's lines) merged into one list for each order."""
    lines = t("lineitem")
    flags, states = (lines.select("l_orderkey", F.col(c).alias("path")) for c in ("l_returnflag", "l_linestatus"))
    return L.merged_paths(flags, states, "l_orderkey", "path")


@query(f"select event_type, count(*) n, sum((user_id % 2 = 0)::int)::bigint as open, max(case when user_id % 2 = 0 then datediff('day', ts::date, date '{AS_OF}') end) oldest_days from events group by 1")
def queue_stats(t):
    return L.queue_stats(t("events"), ["event_type"], F.col("user_id") % 2 == 0, "ts", F.lit(AS_OF).cast("date"))


@query("with s as (select o_orderpriority, count(*) n, sum((o_orderstatus = 'O')::int)::bigint as open from orders group by 1) select o_orderpriority, n, open, 'backlog' alert, 'warn' as level from s where open * 2 > n union all select o_orderpriority, n, open, 'large', 'error' from s where open > 100")
def backlog_alerts(t):
    stats = t("orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("o_orderstatus") == "O").cast("long")).alias("open"))
    return L.alerts(stats, [("backlog", F.col("open") * 2 > F.col("n"), "warn"), ("large", F.col("open") > 100, "error")])


@query("select o_orderkey, case when o_orderstatus = 'F' then 'archive' when o_orderpriority = '1-URGENT' and o_orderstatus = 'O' then 'run_now' when o_orderpriority = '1-URGENT' then 'watch' when o_orderstatus = 'O' then 'queue' else 'skip' end as action from orders")
def trigger_decisions(t):
    """A decision table over state and priority; empty cells fit anything."""
    o = t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    rules = [(1, "F", None, "archive"), (2, "O", "1-URGENT", "run_now"), (3, None, "1-URGENT", "watch"), (4, "O", None, "queue")]
    table = o.sparkSession.createDataFrame(rules, "ord int, o_orderstatus string, o_orderpriority string, action string")
    return L.decided(o, ["o_orderstatus", "o_orderpriority"], table, "action", "skip").select("o_orderkey", "action")


@query("with s as (select user_id, epoch_us(ts) us, event_type t, event_id from events where event_type <> 'error') select e.event_id, e.user_id, (select arg_max(s.t, (s.us, s.t)) from s where s.user_id = e.user_id and s.us <= epoch_us(e.ts)) as cause from events e where e.event_type = 'error'")
def failure_attribution(t):
    """Each error with what its user did last before it."""
    e = t("events").select("event_id", "user_id", "ts", "event_type")
    return L.attributed(e.where("event_type = 'error'"), e.where("event_type <> 'error'"), ["user_id"], "ts", "event_type").select("event_id", "user_id", "cause")


@query(f"select unnest(['chain', 'freshness', 'gates']) sli, unnest([round(100 * avg((event_type <> 'error')::int::double), 2), round(100 * avg((datediff('day', ts::date, date '{AS_OF}') <= 10)::int::double), 2), round(100 * avg(case when event_type in ('purchase', 'error') then (event_type = 'purchase')::int::double end), 2)]) percent from events")
def service_levels(t):
    kind = F.col("event_type")
    fresh = F.datediff(F.lit(AS_OF).cast("date"), F.col("ts").cast("date")) <= 10
    return L.service_levels(t("events"), kind != "error", fresh, F.when(kind.isin("purchase", "error"), kind == "purchase"))


@query("with d as (select event_type, ts::date::varchar as day, count(*) n from events group by all), p as (select *, lag(n) over (partition by event_type order by day) previous from d) select event_type, day, n, previous, case when previous is null then 'new' when n < 0.9 * previous then 'degraded' when n > 1.1 * previous then 'improved' else 'flat' end trend from p")
def degradation_trend(t):
    days = t("events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return L.trend(days, ["event_type"], ["day"], "n")


@query('select user_id run, count(*) steps, max(event_id) "at" from events group by 1 having max((event_type = \'error\' and event_id % 7 = 0)::int) = 0 order by "at" desc, run desc limit 1')
def last_full_run(t):
    """The user with the newest event among those without a dry run (some errors, by rule)."""
    return L.last_run(t("events"), "user_id", "event_id", (F.col("event_type") == "error") & (F.col("event_id") % 7 == 0))


@query("with o as (select *, event_type = 'error' f, sum((event_type <> 'error')::int) over (partition by user_id order by ts, event_id rows unbounded preceding) g from events), s as (select *, sum(f::int) over (partition by user_id, g order by ts, event_id rows unbounded preceding) streak from o), q as (select *, lag(streak >= 2) over (partition by user_id order by ts, event_id) b from s) select event_id, streak::bigint streak, case when streak >= 2 then 'open' when b then 'half_open' else 'closed' end state from q")
def circuit_states(t):
    """A breaker for each user that opens at the second error in a row."""
    return L.circuit(t("events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error", 2).select("event_id", F.col("streak").cast("long").alias("streak"), "state")


@query("select user_id, row_number() over (order by last nulls first, total desc, user_id) as place from (select user_id, max(case when event_type = 'view' then event_id end) as last, count(*) total from events group by 1) qualify place <= 50")
def check_priority(t):
    """Whom to check next: never checked first, then longest ago, then with most events."""
    from pyspark.sql import Window

    users = t("events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "view", F.col("event_id"))).alias("last"), F.count(F.lit(1)).alias("total"))
    order = [F.asc_nulls_first("last"), F.desc("total"), F.asc("user_id")]
    first = users.orderBy(*order).limit(50)
    return first.select("user_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long").alias("place"))


@query("select event_id, user_id, event_type from events order by event_id desc limit 30")
def audit_tail(t):
    return t("events").select("event_id", "user_id", "event_type").orderBy(F.desc("event_id")).limit(30)


@query("select coalesce(event_type, 'all') kind, coalesce(state, 'all') state, count(*) n from (select event_type, case when user_id % 3 = 0 then 'open' else 'closed' end state from events) group by cube (event_type, state)")
def feedback_stats(t):
    """Feedback by kind, by state, by both and in all, in one pass."""
    rows = t("events").select(F.col("event_type").alias("kind"), F.when(F.col("user_id") % 3 == 0, "open").otherwise("closed").alias("state"))
    return rows.cube("kind", "state").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("kind", F.lit("all")).alias("kind"), F.coalesce("state", F.lit("all")).alias("state"), "n")


@query("with g as (select l_returnflag c, case when l_quantity > 40 then 'high' when l_quantity > 20 then 'medium' else 'low' end s from lineitem) select coalesce(c, 'all') gap_class, coalesce(s, 'all') severity, count(*) n from g group by rollup (c, s)")
def gap_summary(t):
    """Gaps by class and severity, with subtotals."""
    severity = F.when(F.col("l_quantity") > 40, "high").when(F.col("l_quantity") > 20, "medium").otherwise("low")
    rows = t("lineitem").select(F.col("l_returnflag").alias("c"), severity.alias("s"))
    return rows.rollup("c", "s").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("c", F.lit("all")).alias("gap_class"), F.coalesce("s", F.lit("all")).alias("severity"), "n")


@query("select event_id, attempts, attempts >= 3 as needs_review, epoch_us(ts) // 1000000 + 300 * (1 << (least(attempts, 3) - 1)) as retry_s from (select event_id, ts, row_number() over (partition by user_id order by ts, event_id) attempts from events where event_type = 'error')")
def retry_plan(t):
    from pyspark.sql import Window

    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    fails = t("events").where("event_type = 'error'").withColumn("attempts", F.row_number().over(order))
    plan = L.dead_letter_plan(fails, "attempts", "ts", 5, 3)
    return plan.select("event_id", F.col("attempts").cast("long").alias("attempts"), "needs_review", F.unix_timestamp("retry_at").alias("retry_s"))
