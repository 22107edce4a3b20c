"""Analytical reports: brands and nations stand for themes, orders for documents, order years for publication years."""

from __future__ import annotations

from pyspark.sql import functions as F

from .base import query

_O = "select n_name theme, year(o_orderdate)::int y, o_orderstatus st, o_orderkey, o_totalprice, o_orderpriority from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey"


def _orders(t):
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderpriority")
    met = o.join(t("customer").select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(t("nation").select("n_nationkey", "n_name")), F.col("n_nationkey") == F.col("c_nationkey"))
    return met.select(F.col("n_name").alias("theme"), F.year("o_orderdate").alias("y"), F.col("o_orderstatus").alias("st"), "o_orderkey", "o_totalprice", "o_orderpriority")


@query("select p_brand, p_type, count(*) n, min(p_name) sample from part group by rollup (p_brand, p_type)")
def hierarchy_rollup(t):
    return t("part").rollup("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"), F.min("p_name").alias("sample"))


@query(f"select theme, case when y <= 1995 then 'to 1995' when y <= 1997 then '1996-1997' else 'from 1998' end stage, count(*) n, min(y) first_year, max(y) last_year from ({_O}) group by all")
def year_stages(t):
    stage = F.when(F.col("y") <= 1995, "to 1995").when(F.col("y") <= 1997, "1996-1997").otherwise("from 1998")
    return _orders(t).groupBy("theme", stage.alias("stage")).agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("first_year"), F.max("y").alias("last_year"))


@query(f"select theme, count(*) n, min(y) first_year, max(y) last_year, sum((st = 'O')::int)::bigint n_open, string_agg(distinct st, ',' order by st) states from ({_O}) group by 1")
def theme_overview(t):
    states = F.array_join(F.array_sort(F.collect_set("st")), ",")
    return _orders(t).groupBy("theme").agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("first_year"), F.max("y").alias("last_year"), F.sum((F.col("st") == "O").cast("int")).alias("n_open"), states.alias("states"))


@query(f"select theme, y, count(*) n, (list(o_orderkey order by o_orderkey))[1] first_doc, (list(o_orderkey order by o_orderkey))[2] second_doc from ({_O}) group by all")
def theme_timeline(t):
    from ..operators.graph import samples

    first = samples(_orders(t), ["theme", "y"], ["o_orderkey"], "o_orderkey", 2)
    return first.select("theme", "y", "n", F.get("samples", 0).alias("first_doc"), F.get("samples", 1).alias("second_doc"))


@query(f"with o as ({_O}), g as (select theme, o_orderpriority, count(*) n, sum((st = 'O')::int) a from o group by all) select theme, o_orderpriority as cluster, 'no_active' gap, 'high' severity from g where a = 0 union all select theme, o_orderpriority, 'small', 'medium' from g where n <= 2 and a > 0 union all select theme, '', 'few_open', case when s > 0.6 then 'high' else 'medium' end from (select theme, avg((st <> 'O')::int) s from o group by 1) where s > 0.5")
def gap_union(t):
    o = _orders(t)
    g = o.groupBy("theme", F.col("o_orderpriority").alias("cluster")).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("st") == "O").cast("int")).alias("a"))
    share = o.groupBy("theme").agg(F.avg((F.col("st") != "O").cast("double")).alias("s")).where("s > 0.5")
    none = g.where("a = 0").select("theme", "cluster", F.lit("no_active").alias("gap"), F.lit("high").alias("severity"))
    small = g.where("n <= 2 and a > 0").select("theme", "cluster", F.lit("small"), F.lit("medium"))
    return none.union(small).union(share.select("theme", F.lit(""), F.lit("few_open"), F.when(F.col("s") > 0.6, "high").otherwise("medium")))


@query(f"select theme, count(*) n, round(100.0 * avg((o_orderpriority in ('1-URGENT', '2-HIGH'))::int), 1) special_share from ({_O}) group by 1")
def share_by_theme(t):
    special = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("double")
    return _orders(t).groupBy("theme").agg(F.count(F.lit(1)).alias("n"), F.round(100 * F.avg(special), 1).alias("special_share"))


@query(f"select theme, sum((y > 1995)::int)::bigint recent, sum((y between 1994 and 1995)::int)::bigint middle, sum((y < 1994)::int)::bigint earlier, case when sum((y > 1995)::int) > sum((y <= 1995)::int) then 'up' when sum((y > 1995)::int) < sum((y <= 1995)::int) then 'down' else 'flat' end trend from ({_O}) group by 1")
def trend_windows(t):
    count = lambda c: F.sum(c.cast("int"))
    y = F.col("y")
    out = _orders(t).groupBy("theme").agg(count(y > 1995).alias("recent"), count(y.between(1994, 1995)).alias("middle"), count(y < 1994).alias("earlier"))
    old = F.col("middle") + F.col("earlier")
    return out.withColumn("trend", F.when(F.col("recent") > old, "up").when(F.col("recent") < old, "down").otherwise("flat"))


@query(f"select theme, count(*) n, round(sum(o_totalprice), 2) volume from ({_O}) group by 1 order by n desc, theme limit 5")
def top_themes(t):
    return _orders(t).groupBy("theme").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("volume")).orderBy(F.desc("n"), "theme").limit(5)


@query("select o_custkey, first_key, last_key, n from (select o_custkey, min(o_orderkey) first_key, max(o_orderkey) last_key, count(*) n from orders group by 1)")
def key_ranges(t):
    return t("orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"), F.count(F.lit(1)).alias("n"))


@query("select (select count(*) from documents) documents, (select count(*) from pages) pages, (select count(*) from orders) orders, (select count(*) from lineitem) edges")
def baseline_counts(t):
    out = None
    for name, title in (("documents", "documents"), ("pages", "pages"), ("orders", "orders"), ("lineitem", "edges")):
        one = t(name).agg(F.count(F.lit(1)).alias(title))
        out = one if out is None else out.join(F.broadcast(one))
    return out


@query(f"select theme, count(*) n, round(100.0 * avg((st <> 'O')::int), 1) coverage from ({_O}) group by 1")
def citation_coverage(t):
    """How many of a theme's documents have been checked, in percent."""
    return _orders(t).groupBy("theme").agg(F.count(F.lit(1)).alias("n"), F.round(100 * F.avg((F.col("st") != "O").cast("double")), 1).alias("coverage"))


@query(f"select round(100.0 * avg((st = 'F')::int), 2) finished_share, count(distinct theme) themes, count(*) documents, round(sum(o_totalprice), 2) volume, min(y) first_year, max(y) last_year from ({_O})")
def global_totals(t):
    return _orders(t).agg(F.round(100 * F.avg((F.col("st") == "F").cast("double")), 2).alias("finished_share"), F.countDistinct("theme").alias("themes"), F.count(F.lit(1)).alias("documents"), F.round(F.sum("o_totalprice"), 2).alias("volume"), F.min("y").alias("first_year"), F.max("y").alias("last_year"))


@query("with c as (select p_brand, count(distinct l_suppkey) cited, max(length(p_name)) body from part left join lineitem on l_partkey = p_partkey and l_quantity > 48 group by 1) select p_brand, cited, body, case when cited = 0 then 'pending' when body < 20 then 'short' else 'covered' end state from c")
def upper_coverage(t):
    """Brands as upper laws: who cites them, and whether their text is there."""
    lines = t("lineitem").where("l_quantity > 48").select("l_partkey", "l_suppkey")
    met = t("part").join(lines, F.col("l_partkey") == F.col("p_partkey"), "left")
    out = met.groupBy("p_brand").agg(F.countDistinct("l_suppkey").alias("cited"), F.max(F.length("p_name")).cast("long").alias("body"))
    return out.withColumn("state", F.when(F.col("cited") == 0, "pending").when(F.col("body") < 20, "short").otherwise("covered"))


@query(f"with g as (select theme, count(*) n, avg((st = 'O')::int) o, min(y) f from ({_O}) group by 1), a as (select 'P1' priority, theme, 'reduce_open' as action from g where o > 0.5 union all select 'P2', theme, 'extend' from g where n < (select avg(n) from g) union all select 'P2', theme, 'review_old' from g where f < 1993) select priority, theme, action, row_number() over (order by priority, theme, action) as place from a")
def action_list(t):
    """Actions P1 and P2 from three gap rules, numbered in order (as many rows as themes and rules, whatever the data)."""
    from pyspark.sql import Window

    g = _orders(t).groupBy("theme").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("st") == "O").cast("double")).alias("o"), F.min("y").alias("f"))
    g = g.crossJoin(F.broadcast(g.agg(F.avg("n").alias("mean"))))
    rows = lambda when, priority, action: g.where(when).select(F.lit(priority).alias("priority"), "theme", F.lit(action).alias("action"))
    every = rows("o > 0.5", "P1", "reduce_open").union(rows("n < mean", "P2", "extend")).union(rows("f < 1993", "P2", "review_old"))
    return every.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("priority", "theme", "action")).cast("long"))


@query("with h as (select p_partkey, concat_ws('+', case when contains(lower(p_name), 'a') then 'a' end, case when contains(lower(p_name), 'widget') then 'widget' end, case when contains(lower(p_type), 'steel') then 'steel' end) pattern, p_name from part) select pattern, count(*) n, min(p_name) sample from h group by 1")
def hit_patterns(t):
    """Parts by the pattern of keywords that they hit, with a sample."""
    hit = lambda column, word: F.when(F.contains(F.lower(column), F.lit(word)), F.lit(word))
    pattern = F.concat_ws("+", hit("p_name", "a"), hit("p_name", "widget"), hit("p_type", "steel"))
    return t("part").groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n"), F.min("p_name").alias("sample"))


@query(f"select theme, basis, n, round(100.0 * n / sum(n) over (partition by theme), 2) share from (select theme, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'direct' when o_orderpriority = '3-MEDIUM' then 'indirect' else 'none' end basis, count(*) n from ({_O}) group by all)")
def gold_distribution(t):
    """Documents of each theme by the class of their basis, with the share of the theme."""
    basis = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "direct").when(F.col("o_orderpriority") == "3-MEDIUM", "indirect").otherwise("none")
    n = _orders(t).groupBy("theme", basis.alias("basis")).agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy(F.col("theme").alias("_t")).agg(F.sum("n").alias("_all"))
    return n.join(F.broadcast(total), F.col("theme") == F.col("_t")).select("theme", "basis", "n", F.round(100.0 * F.col("n") / F.col("_all"), 2).alias("share"))


@query("with a as (select l_orderkey, max(case when l_linenumber = 1 then l_suppkey end) w, max(case when l_linenumber = 2 then l_suppkey end) s from lineitem group by 1) select case when w is null and s is null then 'none' when s is null then 'window_only' when w is null then 'span_only' when w = s then 'agree' else 'disagree' end verdict, count(*) n from a group by 1")
def locate_audit(t):
    """Two ways to locate a target (first and second line's supplier) held against each other."""
    lines = t("lineitem").groupBy("l_orderkey").agg(F.max(F.when(F.col("l_linenumber") == 1, F.col("l_suppkey"))).alias("w"), F.max(F.when(F.col("l_linenumber") == 2, F.col("l_suppkey"))).alias("s"))
    verdict = F.when(F.col("w").isNull() & F.col("s").isNull(), "none").when(F.col("s").isNull(), "window_only").when(F.col("w").isNull(), "span_only").when(F.col("w") == F.col("s"), "agree").otherwise("disagree")
    return lines.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@query("select kind, n, documents, targets, round(n / sum(n) over (), 4) share from (select l_returnflag kind, count(*) n, count(distinct l_orderkey) documents, count(distinct l_partkey) targets from lineitem group by 1)")
def relation_report(t):
    """Relations by kind: rows, citing documents, targets, share of all."""
    n = t("lineitem").groupBy(F.col("l_returnflag").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey").alias("documents"), F.countDistinct("l_partkey").alias("targets"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_all")))).select("kind", "n", "documents", "targets", F.round(F.col("n") / F.col("_all"), 4).alias("share"))


@query("select 'documents' product, count(*) n, round(avg((trim(coalesce(text, '')) <> '')::int), 4) filled, round(avg(n_chars), 2) mean_size from documents union all select 'pages', count(*), round(avg((trim(coalesce(html, '')) <> '')::int), 4), round(avg(length(html)), 2) from pages union all select 'vectors', count(*), round(avg((embedding is not null)::int), 4), round(avg(len(embedding)), 2) from embeddings")
def product_summaries(t):
    """Cleaning and vector products at a glance."""
    part = lambda df, name, there, size: df.agg(F.lit(name).alias("product"), F.count(F.lit(1)).alias("n"), F.round(F.avg(there.cast("double")), 4).alias("filled"), F.round(F.avg(size), 2).alias("mean_size"))
    said = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    return part(t("documents"), "documents", said("text"), F.col("n_chars")).union(part(t("pages"), "pages", said("html"), F.length("html"))).union(part(t("embeddings"), "vectors", F.col("embedding").isNotNull(), F.size("embedding")))
