"""Edges and what can be reached over them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import cut

#: Pairs of a producer and a user that one task counts.
TASK_PAIRS = 2_000_000


def unique_edges(edges: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """The first edge of each key."""
    return edges.groupBy(*keys).agg(F.min_by(F.struct(*values), order).alias("_e")).select(*keys, "_e.*")


def hubs(edges: DataFrame, node: str, other: str, k: int) -> DataFrame:
    """(node, degree, others): the k nodes with most edges, ties to the smaller node."""
    return edges.groupBy(F.col(node).alias("node")).agg(F.count(F.lit(1)).alias("degree"), F.countDistinct(other).alias("others")).orderBy(F.desc("degree"), "node").limit(k)


def ego(edges: DataFrame, src: str, dst: str, centre: int) -> DataFrame:
    """(neighbour, direction, n) of a node's edges, both ways."""
    out = edges.where(F.col(src) == centre).select(F.col(dst).alias("neighbour"), F.lit("out").alias("direction"))
    into = edges.where(F.col(dst) == centre).select(F.col(src).alias("neighbour"), F.lit("in").alias("direction"))
    return out.union(into).groupBy("neighbour", "direction").agg(F.count(F.lit(1)).alias("n"))


def reach(edges: DataFrame, src: str, dst: str, start: list, depth: int = 6) -> DataFrame:
    """(node, level): nodes reached from `start` in at most `depth` steps, by the fewest steps; safe on cycles.

    Each step joins the frontier alone with the edges, drops what was seen by an anti-join, and is checkpointed, so the plan
    does not grow with the depth.
    """
    spark = edges.sparkSession
    kind = dict(edges.dtypes)[src]
    e = cut(edges.select(F.col(src).alias("_s"), F.col(dst).alias("_d")).distinct())
    front = spark.createDataFrame([(x,) for x in start], f"node {kind}").withColumn("level", F.lit(0))
    seen = front
    for level in range(1, depth + 1):
        step = front.join(e, F.col("node") == F.col("_s")).select(F.col("_d").alias("node")).distinct()
        front = step.join(seen.select(F.col("node").alias("_n")), F.col("node") == F.col("_n"), "left_anti").withColumn("level", F.lit(level))
        front = cut(front)
        seen = seen.union(front)
    return seen


def edge_status(edges: DataFrame, current: DataFrame, name: str, version: str, round_: str) -> DataFrame:
    """edges (needs, seen_version, seen_round) with ok, ok_within_round, stale or unregistered against the current versions."""
    now = current.select(F.col(name).alias("_n"), F.col(version).alias("_v"), F.col(round_).alias("_r"))
    status = F.when(F.col("_v").isNull(), "unregistered").when(F.col("_v") == F.col("seen_version"), "ok").when((F.col("_r") != "") & (F.col("_r") == F.col("seen_round")), "ok_within_round").otherwise("stale")
    return edges.join(now, F.col("needs") == F.col("_n"), "left").withColumn("status", status).drop("_n", "_v", "_r")


def pair_strength(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(low, high, n, strength) of unordered pairs: strong from 10 on, medium from 3 on, else weak."""
    pairs = edges.where(F.col(a) != F.col(b)).groupBy(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")).agg(F.count(F.lit(1)).alias("n"))
    return pairs.withColumn("strength", F.when(F.col("n") >= 10, "strong").when(F.col("n") >= 3, "medium").otherwise("weak"))


def majority(votes: DataFrame, item: str, choice: str) -> DataFrame:
    """(item, choice, confidence, votes): the only most frequent choice, else uncertain with confidence 0."""
    n = votes.groupBy(item, choice).agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy(item).agg(F.max("n").alias("most"), F.sum("n").alias("votes"), F.max_by(choice, F.struct("n", choice)).alias("_c"), F.min_by(choice, F.struct(-F.col("n"), choice)).alias("_d"))
    tie = F.col("_c") != F.col("_d")  # the last and the first choice with the largest count
    return best.select(item, F.when(tie, "uncertain").otherwise(F.col("_c").cast("string")).alias("choice"), F.when(tie, 0.0).otherwise(F.round(F.col("most") / F.col("votes"), 3)).alias("confidence"), "votes")


def samples(df: DataFrame, by: list[str], order: list[Column | str], value: str, k: int) -> DataFrame:
    """(by, n, samples): how many rows each group has, and the values of its first k as an array; only k rows of a group are
    gathered, and Spark drops the others before the shuffle."""
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    first = df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_k") <= k)
    shown = first.groupBy(*(F.col(c).alias(f"_{c}") for c in by)).agg(F.array_sort(F.collect_list(F.struct("_k", F.col(value).alias("v")))).alias("_s"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return n.join(shown, on).select(*by, "n", F.transform("_s", lambda x: x["v"]).alias("samples"))


def ego_page(edges: DataFrame, src: str, dst: str, centre: int, weak: Column, limit: int) -> DataFrame:
    """(neighbour, n_out, n_in, weak, truncated): a node's neighbours, most edges first, `limit` at most; each once, with its
    edges by direction and how many are weak."""
    mine = edges.where((F.col(src) == centre) | (F.col(dst) == centre)).withColumn("_out", (F.col(src) == centre).cast("long"))
    other = F.when(F.col("_out") == 1, F.col(dst)).otherwise(F.col(src))
    nodes = mine.groupBy(other.alias("neighbour")).agg(F.sum("_out").alias("n_out"), F.sum(1 - F.col("_out")).alias("n_in"), F.sum(weak.cast("long")).alias("weak"))
    total = nodes.agg((F.count(F.lit(1)) > limit).alias("truncated"))
    return nodes.orderBy(F.desc(F.col("n_out") + F.col("n_in")), "neighbour").limit(limit).join(F.broadcast(total))


def overview(edges: DataFrame, src: str, dst: str, group: str, k: int) -> DataFrame:
    """(kind, src, dst, n): a graph to look at: edges of the k largest hubs by target (star), and all edges by group of the
    source and target (bipartite)."""
    top = edges.groupBy(F.col(src).alias("_h")).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "_h").limit(k)
    star = edges.join(F.broadcast(top.select("_h")), F.col(src) == F.col("_h"), "left_semi").groupBy(F.col(src).cast("string").alias("src"), F.col(dst).cast("string").alias("dst")).agg(F.count(F.lit(1)).alias("n"))
    both = edges.groupBy(F.col(group).cast("string").alias("src"), F.col(src).cast("string").alias("dst")).agg(F.count(F.lit(1)).alias("n"))
    return star.select(F.lit("star").alias("kind"), "src", "dst", "n").union(both.select(F.lit("group"), "src", "dst", "n"))


def through(produced: DataFrame, used: DataFrame, node: str, artifact: str) -> DataFrame:
    """(node, neighbour, artifacts): nodes that use what a node produces, and over how many artifacts.

    Artifacts are dealt to so many tasks that each counts about TASK_PAIRS pairs, however many there are in all.
    """
    both = produced.select(F.col(node).alias("node"), F.col(artifact).alias("_a"), F.lit(1).alias("_p"), F.lit(0).alias("_u")).union(used.select(F.col(node), F.col(artifact), F.lit(0), F.lit(1)))
    sizes = both.groupBy("_a").agg(F.sum("_p").alias("_p"), F.sum("_u").alias("_u"))
    n_pairs = sizes.agg(F.sum(F.col("_p") * F.col("_u"))).first()[0] or 0
    parts = max(int(produced.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_pairs / TASK_PAIRS))
    a = produced.select(F.col(node).alias("node"), F.col(artifact).alias("_a")).repartition(parts, "_a").distinct()
    b = used.select(F.col(node).alias("neighbour"), F.col(artifact).alias("_b")).repartition(parts, "_b").distinct()
    met = a.join(b.hint("merge"), F.col("_a") == F.col("_b")).where("node <> neighbour").select("node", "neighbour")
    return met.groupBy("node", "neighbour").agg(F.count(F.lit(1)).alias("artifacts"))


def through_hubs(produced: DataFrame, used: DataFrame, node: str, artifact: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, steps): `through` over the artifacts that give `most` pairs at most, and the two steps over all others.

    steps: (artifact, node, role), role being producer or user: every producer of an artifact is followed by each of its
    users, so nothing is lost, and an artifact that everyone uses gives as many rows as it has nodes instead of their product.
    """
    a, b = produced.select(F.col(node).alias("node"), F.col(artifact).alias("artifact")).distinct(), used.select(F.col(node).alias("node"), F.col(artifact).alias("artifact")).distinct()
    both = a.withColumn("role", F.lit("producer")).union(b.withColumn("role", F.lit("user")))
    sizes = both.groupBy(F.col("artifact").alias("_a")).agg(F.count_if(F.col("role") == "producer").alias("_p"), F.count_if(F.col("role") == "user").alias("_u")).where("_p > 0 and _u > 0")
    told = both.join(sizes, F.col("artifact") == F.col("_a")).withColumn("_hub", F.col("_p") * F.col("_u") > most)
    few = told.where("not _hub")
    pairs = through(few.where("role = 'producer'").select("node", "artifact"), few.where("role = 'user'").select("node", "artifact"), "node", "artifact")
    return pairs, told.where("_hub").select("artifact", "node", "role")


def levels(edges: DataFrame, src: str, dst: str, most: int = 64) -> DataFrame:
    """(node, level): for each node of an acyclic graph the length of the longest path that ends in it.

    Each round lifts the nodes after those lifted last; it ends when none is lifted, after as many rounds as the longest
    path has steps. Raises ValueError after `most` rounds, as a cycle would never end.
    """
    e = cut(edges.select(F.col(src).alias("_s"), F.col(dst).alias("_d")).distinct())  # every round reads them
    now = cut(e.select(F.col("_s").alias("node")).union(e.select("_d")).distinct().withColumn("level", F.lit(0)))
    front = now
    for level in range(1, most + 1):
        front = cut(front.select("node").join(e, F.col("node") == F.col("_s")).select(F.col("_d").alias("node")).distinct().withColumn("lifted", F.lit(level)))
        if not front.limit(1).count():
            return now
        now = cut(now.join(front.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select("node", F.coalesce("lifted", "level").alias("level")))
    raise ValueError(f"a path has over {most} steps, or there is a cycle")
