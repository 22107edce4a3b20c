"""Edges between suppliers, parts and nations on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from .base import query

EDGES = "select l_suppkey src, l_partkey dst, l_orderkey * 10 + l_linenumber ord, l_returnflag kind from lineitem"


def _edges(t):
    return t("lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.col("l_returnflag").alias("kind"))


@query(f"select src, dst, ord, kind from ({EDGES}) qualify row_number() over (partition by src, dst order by ord) = 1")
def unique_edges(t):
    return G.unique_edges(_edges(t), ["src", "dst"], "ord", ["ord", "kind"])


@query(f"select src as node, count(*) as degree, count(distinct dst) as others from ({EDGES}) group by 1 order by degree desc, node limit 20")
def hub_topk(t):
    return G.hubs(_edges(t), "src", "dst", 20)


@query(f"with e as ({EDGES}) select dst neighbour, 'out' direction, count(*) n from e where src = 7 group by 1 union all select src, 'in', count(*) from e where dst = 7 group by 1")
def ego_graph(t):
    return G.ego(_edges(t), "src", "dst", 7)


@query()
def upstream_bfs(t):
    """What can be reached from part 3 in six steps over edges made by rule from all lines; recursive SQL would walk every
    path, so a test walks them by brute force."""
    return _reached(t("lineitem"))


def _reached(lines):
    e = lines.select(F.col("l_partkey").cast("long").alias("s"), ((F.col("l_partkey") * 7 + F.col("l_suppkey")) % 2000).cast("long").alias("d"))
    return G.reach(e, "s", "d", [3], 6)


@query("with c as (select s_suppkey::varchar n, (s_suppkey % 4)::varchar v, case when s_suppkey % 3 = 0 then '' else 'r1' end r from supplier where s_suppkey % 10 <> 0), e as (select distinct l_suppkey::varchar needs, (l_partkey % 4)::varchar seen_version, case when l_partkey % 2 = 0 then 'r1' else 'r0' end seen_round from lineitem) select status, count(*) n from (select case when c.v is null then 'unregistered' when c.v = seen_version then 'ok' when c.r <> '' and c.r = seen_round then 'ok_within_round' else 'stale' end as status from e left join c on c.n = e.needs) group by 1")
def edge_status(t):
    now = t("supplier").where("s_suppkey % 10 <> 0").select(F.col("s_suppkey").cast("string").alias("name"), (F.col("s_suppkey") % 4).cast("string").alias("version"), F.when(F.col("s_suppkey") % 3 == 0, "").otherwise("r1").alias("round"))
    edges = t("lineitem").select(F.col("l_suppkey").cast("string").alias("needs"), (F.col("l_partkey") % 4).cast("string").alias("seen_version"), F.when(F.col("l_partkey") % 2 == 0, "r1").otherwise("r0").alias("seen_round")).distinct()
    return G.edge_status(edges, now, "name", "version", "round").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


_PAIRS = "select c.c_nationkey a, s.s_nationkey b from lineitem join orders on o_orderkey = l_orderkey join customer c on c.c_custkey = o_custkey join supplier s on s.s_suppkey = l_suppkey"


def _nation_pairs(t):
    lines = t("lineitem").select("l_orderkey", "l_suppkey").join(t("orders").select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    lines = lines.join(t("customer").select("c_custkey", F.col("c_nationkey").alias("a")), F.col("c_custkey") == F.col("o_custkey"))
    return lines.join(t("supplier").select("s_suppkey", F.col("s_nationkey").alias("b")), F.col("s_suppkey") == F.col("l_suppkey")).select("a", "b")


@query(f"select low, high, n, case when n >= 10 then 'strong' when n >= 3 then 'medium' else 'weak' end strength from (select least(a, b) low, greatest(a, b) high, count(*) n from ({_PAIRS}) where a <> b group by all)")
def pair_strength(t):
    return G.pair_strength(_nation_pairs(t), "a", "b")


@query(f"select a, sum((b = 0)::int)::bigint b0, sum((b = 1)::int)::bigint b1, sum((b = 2)::int)::bigint b2, sum((b = 3)::int)::bigint b3, sum((b = 4)::int)::bigint b4 from (select r1.n_regionkey a, r2.n_regionkey b from ({_PAIRS}) p join nation r1 on r1.n_nationkey = p.a join nation r2 on r2.n_nationkey = p.b) group by 1")
def edge_matrix_pivot(t):
    """Lines by the regions of customer and supplier."""
    n = t("nation").select("n_nationkey", "n_regionkey")
    p = _nation_pairs(t).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    rows = p.join(n.select(F.col("n_nationkey").alias("_a"), F.col("n_regionkey").alias("ra")), F.col("a") == F.col("_a")).join(n.select(F.col("n_nationkey").alias("_b"), F.col("n_regionkey").alias("rb")), F.col("b") == F.col("_b"))
    out = rows.groupBy(F.col("ra").alias("a")).pivot("rb", [0, 1, 2, 3, 4]).agg(F.sum("n"))
    return out.select("a", *(F.coalesce(F.col(str(i)), F.lit(0)).alias(f"b{i}") for i in range(5)))


@query("with v as (select l_suppkey, l_shipdate, l_returnflag from lineitem), n as (select l_suppkey, l_returnflag, count(*) n from v group by all), m as (select l_suppkey, max(n) most, sum(n)::bigint votes from n group by 1), w as (select n.l_suppkey, count(*) c, min(l_returnflag) f from n join m on m.l_suppkey = n.l_suppkey and n.n = m.most group by 1) select m.l_suppkey, case when c > 1 then 'uncertain' else f end choice, case when c > 1 then 0.0 else round(most / votes, 3) end confidence, votes from m join w using (l_suppkey)")
def theme_votes(t):
    return G.majority(t("lineitem").select("l_suppkey", "l_returnflag"), "l_suppkey", "l_returnflag")


@query("select l_suppkey, l_returnflag kind, count(*) n, (list(l_orderkey order by l_orderkey, l_linenumber))[1:3]::varchar samples from lineitem group by all")
def external_grouping(t):
    """Evidence of each supplier by kind, with the first three orders as samples."""
    rows = t("lineitem").select("l_suppkey", F.col("l_returnflag").alias("kind"), "l_orderkey", "l_linenumber")
    first = G.samples(rows, ["l_suppkey", "kind"], ["l_orderkey", "l_linenumber"], "l_orderkey", 3)
    shown = F.concat(F.lit("["), F.array_join(F.transform("samples", lambda x: x.cast("string")), ", "), F.lit("]"))
    return first.select("l_suppkey", "kind", "n", shown.alias("samples"))


@query(f"with e as ({EDGES}), m as (select case when src = 7 then dst else src end neighbour, (src = 7)::int o, (kind = 'R')::int w from e where src = 7 or dst = 7), n as (select neighbour, sum(o)::bigint n_out, sum(1 - o)::bigint n_in, sum(w)::bigint weak from m group by 1) select neighbour, n_out, n_in, weak, (select count(*) > 15 from n) truncated from n order by n_out + n_in desc, neighbour limit 15")
def ego_limited(t):
    """Fifteen neighbours of node 7 with their edges by direction."""
    return G.ego_page(_edges(t), "src", "dst", 7, F.col("kind") == "R", 15)


@query(f"with e as ({EDGES}), h as (select src from e group by 1 order by count(*) desc, src limit 5) select 'star' kind, src::varchar src, dst::varchar dst, count(*) n from e where src in (select src from h) group by src, dst union all select 'group', kind, src::varchar, count(*) from e group by kind, src")
def global_graph(t):
    return G.overview(_edges(t), "src", "dst", "kind", 5)


@query("with p as (select distinct l_suppkey node, l_partkey a from lineitem where l_linestatus = 'F'), u as (select distinct l_suppkey node, l_partkey a from lineitem where l_linestatus = 'O') select p.node, u.node neighbour, count(*) artifacts from p join u using (a) where p.node <> u.node group by all")
def artifact_neighbours(t):
    """Suppliers whose finished parts other suppliers still have open."""
    lines = t("lineitem").select(F.col("l_suppkey").alias("node"), "l_partkey", "l_linestatus")
    return G.through(lines.where("l_linestatus = 'F'"), lines.where("l_linestatus = 'O'"), "node", "l_partkey")


@query("with recursive e as (select distinct c_nationkey s, s_nationkey d from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join supplier on s_suppkey = l_suppkey where c_nationkey < s_nationkey and s_nationkey - c_nationkey > 5), r as (select n as node, 0 as level from (select s n from e union select d from e) union select d, level + 1 from r join e on s = node) select node, max(level)::int as level from r group by 1")
def dag_levels(t):
    """Levels of nations over trade to nations with keys larger by more than five."""
    e = _nation_pairs(t).where("a < b and b - a > 5").distinct()
    return G.levels(e, "a", "b")


@query(f"select src, dst, n, kinds from (select src, dst, sum(n)::bigint n, string_agg(kind || ':' || n::varchar, ',' order by kind) kinds from (select a as src, b as dst, l_returnflag kind, count(*) n from (select c.c_nationkey a, s.s_nationkey b, l_returnflag from lineitem join orders on o_orderkey = l_orderkey join customer c on c.c_custkey = o_custkey join supplier s on s.s_suppkey = l_suppkey) where a = b group by all) group by all)")
def inner_edges(t):
    """Edges inside a nation with a histogram of their kinds."""
    lines = t("lineitem").select("l_orderkey", "l_suppkey", F.col("l_returnflag").alias("kind")).join(t("orders").select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    lines = lines.join(t("customer").select("c_custkey", F.col("c_nationkey").alias("src")), F.col("c_custkey") == F.col("o_custkey")).join(t("supplier").select("s_suppkey", F.col("s_nationkey").alias("dst")), F.col("s_suppkey") == F.col("l_suppkey"))
    n = lines.where("src = dst").groupBy("src", "dst", "kind").agg(F.count(F.lit(1)).alias("n"))
    shown = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("kind", "n"))), lambda x: F.concat(x["kind"], F.lit(":"), x["n"].cast("string"))), ",")
    return n.groupBy("src", "dst").agg(F.sum("n").alias("n"), shown.alias("kinds"))
