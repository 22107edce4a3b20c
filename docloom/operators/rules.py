"""Checking rules in sentences: their table, field, operator and value, and the relations between tables that they tell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed: how a rule names a field of a table, and a table in which something must be; how a description lists related items.
FIELD, INSIDE, RELATED = r"【([^】]+)】\s*中的?\s*[“\"]([^”\"]+)[”\"]", r"须在\s*【([^】]+)】", "关联数据项"
#: Operators by what says them, the first that stands in a rule counts; value: what follows.
OPERATORS = [
    ("in", INSIDE), ("not_null", r"(?:不得|不能|不可|不应)为空"), ("unique", r"(?:不得|不能|不可)重复|须?唯一"), ("ge", r"(?:不小于|不低于|不早于|大于等于|大于或等于)"), ("le", r"(?:不大于|不高于|不超过|不晚于|小于等于|小于或等于)"),
    ("ne", r"(?:不等于|不得为|不应为)"), ("gt", r"(?:大于|晚于|高于)"), ("lt", r"(?:小于|早于|低于)"), ("eq", r"(?:等于|必须为|须为|应为)"),
]


def parsed(rules: DataFrame, no: str = "no", table: str = "table", item: str = "item", rule: str = "rule") -> DataFrame:
    """(no, table, field, operator, value, target, target_field, condition) of rules in sentences.

    table, field: as the rule names them, else the rule's own columns; operator: the first of OPERATORS in the rule; value:
    what follows it, up to a mark; target: the table in which the value must be, or the field that the value names;
    condition: what stands before a comma after 若, 如 or 当. Rules without an operator have none.
    """
    text = F.coalesce(F.col(rule), F.lit(""))
    condition = F.nullif(F.regexp_extract(text, r"^(?:若|如果?|当)(.+?)(?:时)?[，,]", 1), F.lit(""))
    main = F.regexp_replace(text, r"^(?:若|如果?|当).+?[，,]", "")
    operator, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, said in reversed(OPERATORS):
        operator = F.when(main.rlike(said), name).otherwise(operator)
        value = F.when(main.rlike(said), F.regexp_extract(main, f"(?:{said})\\s*(?:【[^】]+】中的?)?[“\"‘']?([^，。；”\"’'【】]*)", 2 if name == "in" else 1)).otherwise(value)
    named = lambda i: F.nullif(F.regexp_extract(main, FIELD, i), F.lit(""))
    second = F.regexp_extract_all(main, F.lit(FIELD), 1), F.regexp_extract_all(main, F.lit(FIELD), 2)
    target = F.coalesce(F.nullif(F.regexp_extract(main, INSIDE, 1), F.lit("")), F.get(second[0], 1))
    bare = operator.isin("in", "not_null", "unique")
    return rules.select(
        F.col(no).alias("no"), F.coalesce(named(1), F.col(table)).alias("table"), F.coalesce(named(2), F.col(item)).alias("field"), operator.alias("operator"),
        F.when(~bare, F.nullif(F.trim(value), F.lit(""))).alias("value"), target.alias("target"), F.get(second[1], 1).alias("target_field"), condition.alias("condition"),
    )


def related(items: DataFrame, table: str = "table", item: str = "item", description: str = "description") -> DataFrame:
    """(table, field, target, target_field, at) of the related items (table-item) that descriptions of items list."""
    tail = F.regexp_replace(F.substring_index(F.regexp_extract(F.col(description), f"(?s){RELATED}(.*)$", 1), "。", 1), "^[：: ]+|[；;].*$", "")
    each = items.where(F.contains(F.col(description), F.lit(RELATED))).select(F.col(table).alias("table"), F.col(item).alias("field"), F.posexplode(F.split(tail, "[、，,]")).alias("at", "part"))
    return each.where(F.col("part").rlike("[-－]")).select("table", "field", F.trim(F.regexp_extract("part", r"^(.*?)[-－]", 1)).alias("target"), F.trim(F.regexp_extract("part", r"^.*?[-－](.*)$", 1)).alias("target_field"), "at")


def er_edges(rules: DataFrame, items: DataFrame, tables: DataFrame) -> DataFrame:
    """(src, dst, field, target_field, source, rule_no): relations between tables (table_no, table_name).

    From parsed rules (`parsed`) whose value must be in another table, and from related items (`related`). Names that stand
    for no table make no edge, nor does a table with itself; of equal edges the rule with the least number counts, rules
    before items. Of tables of one name the least number counts.
    """
    known = tables.where(F.trim("table_name") != "").groupBy(F.trim("table_name").alias("_name")).agg(F.min("table_no").alias("_no"))
    told = rules.where("operator = 'in'").select("table", "field", "target", F.lit("").alias("target_field"), F.lit("rule").alias("source"), F.col("no").cast("string").alias("rule_no"))
    listed = items.select("table", "field", "target", "target_field", F.lit("item").alias("source"), F.lit("").alias("rule_no"))

    def numbered(df: DataFrame, name: str, out: str) -> DataFrame:
        return df.join(known, F.col(name) == F.col("_name")).withColumn(out, F.col("_no")).drop("_name", "_no")

    both = numbered(numbered(told.union(listed), "table", "src"), "target", "dst").where("src <> dst")
    first = F.min(F.struct(F.when(F.col("source") == "rule", 0).otherwise(1).alias("o"), "rule_no", "source")).alias("_f")
    return both.groupBy("src", "dst", "field", "target_field").agg(first).select("src", "dst", "field", "target_field", "_f.source", "_f.rule_no")
