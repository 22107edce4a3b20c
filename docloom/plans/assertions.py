"""Assertions on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assertions as A
from .base import query


@query("select 'priority' as gate, count(*) violations from orders where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') union all select 'flag', count(*) from lineitem where l_returnflag not in ('A', 'N')")
def assert_domain(t):
    urgent = A.assert_domain(t("orders"), "priority", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])
    return urgent.union(A.assert_domain(t("lineitem"), "flag", "l_returnflag", ["A", "N"]))


@query("select 'customers' as gate, count(*) violations from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0) union all select 'parts', count(*) from lineitem where l_partkey not in (select p_partkey from part where p_size < 40)")
def assert_refs(t):
    """Orders of customers with money, lines of small parts."""
    rich, small = t("customer").where("c_acctbal > 0"), t("part").where("p_size < 40")
    return A.assert_refs(t("orders"), "customers", "o_custkey", rich, "c_custkey").union(A.assert_refs(t("lineitem"), "parts", "l_partkey", small, "p_partkey"))


@query("select 'documents' as gate, count(*) violations from documents where trim(coalesce(source, '')) = '' or trim(coalesce(lang, '')) = '' or trim(coalesce(text, '')) = '' union all select 'pages', count(*) from pages where trim(coalesce(url, '')) = ''")
def assert_provenance(t):
    return A.assert_provenance(t("documents"), "documents", ["source", "lang", "text"]).union(A.assert_provenance(t("pages"), "pages", ["url"]))


@query("select 'orders' as gate, count(*) - count(distinct o_orderkey) violations from orders union all select 'lines', count(*) - count(distinct (l_orderkey, l_partkey)) from lineitem")
def assert_unique(t):
    return A.assert_unique(t("orders"), "orders", ["o_orderkey"]).union(A.assert_unique(t("lineitem"), "lines", ["l_orderkey", "l_partkey"]))


@query("select 'keys' as gate, (select count(*) from (select o_orderkey from orders where o_orderkey % 7 <> 0 except all select l_orderkey from lineitem where l_linenumber = 1)) + (select count(*) from (select l_orderkey from lineitem where l_linenumber = 1 except all select o_orderkey from orders where o_orderkey % 7 <> 0)) as violations")
def assert_same_keys(t):
    """Orders, some left out by rule, against the orders of first lines."""
    firsts = t("lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"))
    return A.assert_same_keys(t("orders").where("o_orderkey % 7 <> 0"), firsts, "keys", ["o_orderkey"])


@query("select 'status' as gate, count(*) violations from lineitem join orders on o_orderkey = l_orderkey where l_linestatus <> o_orderstatus")
def assert_propagated(t):
    """A line's state against its order's, the single source."""
    source = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("l_linestatus"))
    return A.assert_propagated(t("lineitem"), source, "status", "l_orderkey", "l_linestatus")


@query("select 'consumed' as gate, count(*) violations from events e join (select user_id, max(ts) f from events where event_type = 'error' group by 1) x using (user_id) where e.event_type = 'purchase' and e.ts >= x.f")
def assert_not_consumed(t):
    """Purchases after a user's last error."""
    e = t("events")
    failed = e.where("event_type = 'error'").select("user_id", "ts")
    return A.assert_not_consumed(failed, e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("used")), "consumed", "user_id", "ts", "used")


@query("""select * from (values ('o_orderkey', 'ok'), ('o_custkey', 'ok'), ('o_orderstatus', 'ok'), ('o_note', 'missing')) v("column", state) union all select column_name, 'extra' from (describe orders) where column_name not in ('o_orderkey', 'o_custkey', 'o_orderstatus')""")
def schema_contract(t):
    orders = t("orders")
    have = dict(orders.dtypes)
    return A.schema_contract(orders, {"o_orderkey": have["o_orderkey"], "o_custkey": have["o_custkey"], "o_orderstatus": "string", "o_note": "string"})


@query("""with g as (select 'status' as gate, count(*) violations from orders where o_orderstatus not in ('O', 'F', 'P') union all select 'price', count(*) from orders where not (o_totalprice > 100000) union all select 'refs', count(*) from orders where o_custkey not in (select c_custkey from customer) union all select 'unique', count(*) - count(distinct o_orderkey) from orders)
select count(*) gates, sum((violations = 0)::int)::bigint passed, coalesce(string_agg(case when violations > 0 then gate end, ',' order by gate), '') failed from g""")
def gate_runner(t):
    """All gates on orders in one run: how many there are, how many passed, which failed."""
    o = t("orders")
    gates = [A.assert_domain(o, "status", "o_orderstatus", ["O", "F", "P"]), A.assert_rows(o, "price", F.col("o_totalprice") > 100000), A.assert_refs(o, "refs", "o_custkey", t("customer"), "c_custkey"), A.assert_unique(o, "unique", ["o_orderkey"])]
    return A.overall(o.sparkSession, gates)


@query("select count(*) unresolved from (select o_orderkey from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'O' and not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_linestatus = 'F'))")
def drift_block(t):
    """Urgent open orders without a finished line: drift that no one has resolved, which blocks a release."""
    done = t("lineitem").where("l_linestatus = 'F'").select("l_orderkey")
    drifted = t("orders").where("o_orderpriority = '1-URGENT' and o_orderstatus = 'O'")
    return drifted.join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").agg(F.count(F.lit(1)).alias("unresolved"))
