"""Conversations from reply trees, in a chat template that can be read back."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

TURN, END = "<|turn|>", "<|end|>"
#: Strings that steer chat models; inside texts they are broken up by a backslash after their first character.
CONTROL = ["<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]
LEARNT = "assistant"
EXTRA = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def escape(text: Column) -> Column:
    """Backslashes doubled and control strings broken up; `unescape` undoes it."""
    rests = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROL)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rests, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, node, pos): the root-to-leaf paths of each tree, best sum of scores first, `branches` at most.

    nodes: tree, node, parent, score. A parent that is null or missing makes a root. Self-joins double the ancestor that
    each node knows, so they number as the logarithm of the longest path; the joins by powers of two then list the
    members of chosen paths alone. Ties go to the smallest leaf. Nodes on a cycle reach no root and are left out.
    """
    n = nodes.select("tree", "node", F.coalesce("score", F.lit(0.0)).alias("score"), "parent")
    ids = n.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    known = n.join(ids, (F.col("tree") == F.col("_t")) & (F.col("parent") == F.col("_n")), "left")
    jump = cut(known.select("tree", "node", F.col("_n").alias("up"), F.col("score").alias("sum"), F.lit(1).cast("long").alias("depth")))
    jumps = []
    left, limit = jump.where("up is not null").count(), jump.count()
    while left and 2 ** len(jumps) <= limit:
        jumps.append(jump.where("up is not null").select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_up")))
        far = jump.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_up"), F.col("sum").alias("_sum"), F.col("depth").alias("_depth"))
        met = jump.where("up is not null").join(far, (F.col("tree") == F.col("_t")) & (F.col("up") == F.col("_n")))
        further = met.select("tree", "node", F.col("_up").alias("up"), (F.col("sum") + F.col("_sum")).alias("sum"), (F.col("depth") + F.col("_depth")).alias("depth"))
        jump = cut(jump.where("up is null").union(further))
        left = jump.where("up is not null").count()
    parents = known.where("_n is not null").select(F.col("tree").alias("_t"), F.col("_n").alias("_p")).distinct()
    leaves = jump.where("up is null").join(parents, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_p")), "left_anti")
    best = leaves.withColumn("_k", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("sum"), "node"))).where(F.col("_k") <= branches)
    on = best.select("tree", F.col("node").alias("leaf"), "node", F.col("depth"), F.lit(0).cast("long").alias("back"))
    for i in reversed(range(len(jumps))):
        met = on.join(jumps[i], (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")), "left")
        both = F.array(F.struct("node", "back"), F.struct(F.col("_up").alias("node"), (F.col("back") + 2**i).alias("back")))
        on = met.select("tree", "leaf", "depth", F.inline(both)).where("node is not null")
    return on.select("tree", "leaf", "node", (F.col("depth") - 1 - F.col("back")).alias("pos"))


def format_trees(nodes: DataFrame, branches: int = 1, learnt: str = LEARNT) -> DataFrame:
    """(tree, leaf, formatted, loss): each chosen path as one text, and the spans (start, length, in characters) to learn.

    nodes: tree, node, parent, role, text, score; node is unique in its tree. Null roles and texts count as empty. A path
    becomes one text, so it is gathered in one task; nothing larger is.
    """
    told = nodes.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), F.coalesce("role", F.lit("")).alias("role"), escape(F.coalesce("text", F.lit(""))).alias("body"))
    rows = paths(nodes, branches).join(told, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node")))
    head = F.concat(F.lit(TURN), F.regexp_replace(escape(F.col("role")), "\n", "\\\\\n"), F.lit("\n"))
    rows = rows.withColumn("head", head).withColumn("turn", F.concat("head", "body", F.lit(f"{END}\n")))
    before = Window.partitionBy("tree", "leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn").cast("long")).over(before), F.lit(0)) + F.length("head")
    span = F.when(F.col("role") == learnt, F.struct(start.alias("start"), F.length("body").alias("length")))
    turns = F.array_sort(F.collect_list(F.struct("pos", "turn", "span")))
    done = rows.withColumn("span", span).groupBy("tree", "leaf").agg(turns.alias("_turns"))
    spans = F.filter(F.transform("_turns", lambda t: t["span"]), lambda s: s.isNotNull())
    return done.select("tree", "leaf", F.array_join(F.transform("_turns", lambda t: t["turn"]), "").alias("formatted"), spans.alias("loss"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text) of a formatted text."""
    turns = F.filter(F.split(formatted, re.escape(TURN)), lambda _, i: i > 0)
    role = r"(?s)^((?:[^\\\n]++|\\.)*+)\n.*$"

    def parts(turn: Column) -> Column:
        head = F.regexp_extract(turn, role, 1)
        body = F.substring(turn, F.length(head) + 2, F.length(turn) - F.length(head) - 1 - len(END) - 1)
        return F.struct(unescape(head).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, parts)


def conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations, rows by turn, as reply trees of one branch: (conv_id, formatted, loss).

    Rows with the same turn are ordered by role and text; rows without a conversation id form one conversation. Null turns
    come first, null roles and texts are empty. Other columns are left out; an empty table gives no rows.
    """
    own = rows.select(F.struct(F.col(id_col).alias("id")).alias("tree"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    nodes = cut(own.withColumn("node", F.row_number().over(order).cast("long")))
    nodes = nodes.withColumn("parent", F.col("node") - 1).withColumn("score", F.lit(0.0))
    return format_trees(nodes).select(F.col("tree.id").alias("conv_id"), "formatted", "loss")


def digest(done: DataFrame) -> DataFrame:
    """What op9 returns, read back from the formatted texts."""
    learnt = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"]))), "")
    rows = done.select("conv_id", read_back(F.col("formatted")).alias("turns"), learnt.alias("learnt"), F.length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars",
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest(conversations(rows.union(spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string"))))


def _escaped(column: str) -> str:
    """SQL of `escape`."""
    sql = f"replace({column}, '\\', '\\\\')"
    for c in CONTROL:
        sql = f"replace({sql}, '{c}', '{c[0]}\\{c[1:]}')"
    return sql


ORACLE_SQL = f"""with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
sum(case when role = '{LEARNT}' then length(text) else 0 end)::bigint as loss_chars, sha256(coalesce(string_agg(case when role = '{LEARNT}' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
sum({len(TURN) + len(END) + 2} + length(replace({_escaped("role")}, chr(10), '\\' || chr(10))) + length({_escaped("text")}))::bigint as formatted_chars from c group by conv_id"""
