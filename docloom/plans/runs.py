"""Incremental runs on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import incremental as I
from .base import query


@query("select event_id, case when user_id % 3 = 0 then 'known' when row_number() over (partition by user_id order by ts, event_id) = 1 then 'new' else 'dup_in_run' end state from events")
def incremental_items(t):
    """Events as items of their users; users divisible by three are known from earlier runs."""
    e = t("events")
    return I.classify(e, e.where("user_id % 3 = 0"), "user_id", ["ts", "event_id"]).select("event_id", "state")


@query("with g as (select user_id, max(case when event_type <> 'error' then event_id end) ok from events group by 1), f as (select e.user_id, count(*) attempts, max(event_id) last from events e join g using (user_id) where event_type = 'error' and (ok is null or event_id > ok) group by 1) select user_id, attempts, attempts >= 3 as needs_review from f")
def dead_letters(t):
    """Users whose newest events are errors."""
    e = t("events").withColumn("at", F.timestamp_seconds(F.col("event_id")))
    return I.dead_letters(e, "user_id", "at", F.col("event_type") != "error", most=3).select("user_id", "attempts", "needs_review")


@query("select o_orderkey, case when s.s_suppkey is null then 'unknown' when s.s_acctbal < 0 then 'withdrawn' else 'valid' end verdict from orders left join supplier s on s.s_suppkey = o_orderkey % 150")
def citation_check(t):
    """Orders that cite a supplier by rule; one with a negative balance counts as withdrawn."""
    drafts = t("orders").select("o_orderkey", (F.col("o_orderkey") % 150).cast("long").alias("s_suppkey"))
    side = t("supplier").select(F.col("s_suppkey").cast("long").alias("s_suppkey"), F.when(F.col("s_acctbal") < 0, "void").otherwise("valid").alias("state"))
    return I.citations(drafts, side, "s_suppkey", "state", ["void"]).select("o_orderkey", "verdict")


@query("select count(*) as rows, count(distinct lang) n_lang, count(distinct source) n_source from documents")
def value_counts(t):
    from ..sources.files import value_counts

    return value_counts(t("documents"), ["lang", "source"])


@query("select folder, arg_max(path, (newest, path)) as path from (select 'store/' || source folder, 'store/' || source || '/' || doc_id::varchar || case doc_id % 4 when 0 then '.json' when 1 then '.json.bak' when 2 then '.tmp' else '-quarantine.json' end path, doc_id % 100 as newest from documents) where path not like '%.bak%' and path not like '%.tmp%' and path not like '%quarantine%' group by 1")
def main_files(t):
    """The newest proper file of each source's folder; names and times made by rule from documents."""
    from ..sources.files import main_files

    end = F.when(F.col("doc_id") % 4 == 0, ".json").when(F.col("doc_id") % 4 == 1, ".json.bak").when(F.col("doc_id") % 4 == 2, ".tmp").otherwise("-quarantine.json")
    return main_files(t("documents").select(F.concat(F.lit("store/"), "source", F.lit("/"), F.col("doc_id").cast("string"), end).alias("path"), (F.col("doc_id") % 100).alias("at")))
