"""A register of documents: who stands for a record, which text belongs to a title, where its status has drifted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from .likeness import held_in

#: Least length of a number that tells a document; least length of a title that may stand in another one; letters by which
#: titles are looked up in each other where a number or a date speaks for them as well.
NUMBER, TITLE, INNER = 5, 6, 2
#: Fixed: a status that tells nothing; sources of a status that bind nobody.
PLACEHOLDERS, NOT_BINDING = ["", "待核", "待核验", "未知", "未标注"], ["推断", "默认", "规则"]


def _either_way(a: DataFrame, b: DataFrame, inner: int, within: list[str]) -> DataFrame:
    """(title_a, title_b, within..): titles of a and b, one of which stands in the other, equal ones too."""
    within_cols = [F.col(c) for c in within]
    one = held_in(a, b, "title_a", "title_b", inner, within).select(F.col("a").alias("title_a"), F.col("b").alias("title_b"), *within_cols)
    two = held_in(b, a, "title_b", "title_a", inner, within).select(F.col("b").alias("title_a"), F.col("a").alias("title_b"), *within_cols)
    same = a.join(b.withColumn("title_a", F.col("title_b")), ["title_a", *within]).select("title_a", "title_b", *within)
    return one.union(two).union(same).distinct()


def registered(asked: DataFrame, register: DataFrame) -> DataFrame:
    """(row, ref, level) of asked (row, theme, title, number, published) in register (ref, theme, title, number, published).

    L1: equal numbers of NUMBER characters or more, those of the same theme first. L2: the same theme and title. L3: one
    title in the other, INNER letters or more, or equal to it, if both have the same number, or neither has one and both the same date. The
    best level counts, then the least ref; rows without any are left out. Numbers and titles are compared as normal keys.
    """

    def normal(df: DataFrame, row: str, mark: str) -> DataFrame:
        return df.select(F.col(row).alias(row), F.coalesce("theme", F.lit("")).alias(f"theme_{mark}"), K.title_strict(F.col("title")).alias(f"title_{mark}"), K.docno(F.coalesce("number", F.lit(""))).alias(f"number_{mark}"), F.coalesce("published", F.lit("")).alias(f"date_{mark}"))

    a, b = normal(asked, "row", "a"), normal(register, "ref", "b")
    by_number = a.where(F.length("number_a") >= NUMBER).join(b, F.col("number_a") == F.col("number_b"))
    other = F.when((F.col("theme_a") != "") & (F.col("theme_a") == F.col("theme_b")), 0).otherwise(1)
    one = by_number.select("row", "ref", F.lit(1).alias("level"), other.alias("order"))
    by_title = a.where("theme_a <> '' and title_a <> ''").join(b, (F.col("theme_a") == F.col("theme_b")) & (F.col("title_a") == F.col("title_b")))
    two = by_title.select("row", "ref", F.lit(2).alias("level"), F.lit(0).alias("order"))
    speaks = lambda mark: F.when(F.col(f"number_{mark}") != "", F.concat(F.lit("n"), F.col(f"number_{mark}"))).when(F.col(f"date_{mark}") != "", F.concat(F.lit("d"), F.col(f"date_{mark}")))
    x, y = a.withColumn("speaks", speaks("a")).where("title_a <> '' and speaks is not null"), b.withColumn("speaks", speaks("b")).where("title_b <> '' and speaks is not null")
    pairs = _either_way(x.select("title_a", "speaks").distinct(), y.select("title_b", "speaks").distinct(), INNER, ["speaks"])
    three = x.join(pairs, ["title_a", "speaks"]).join(y, ["title_b", "speaks"]).select("row", "ref", F.lit(3).alias("level"), F.lit(0).alias("order"))
    best = F.min(F.struct("level", "order", "ref")).alias("m")
    return one.union(two).union(three).groupBy("row").agg(best).select("row", "m.ref", "m.level")


def theme_texts(asked: DataFrame, library: DataFrame) -> DataFrame:
    """(row, lib, item, tier, body_len): the text of a library that stands for each of asked (row, title, number).

    library: (lib, item, title, number, body_len). In each lib the best tier counts: the same title (1), the same number of
    NUMBER characters or more (2), one title in the other, both of TITLE letters or more, unless both have numbers that are
    not part of each other (3); in it the longest body, then the least item. Of the libs the longest body counts.
    """
    a = asked.select("row", K.title_strict(F.col("title")).alias("title_a"), K.docno(F.coalesce("number", F.lit(""))).alias("number_a"))
    b = library.select("lib", "item", "body_len", K.title_strict(F.col("title")).alias("title_b"), K.docno(F.coalesce("number", F.lit(""))).alias("number_b"))
    out = ["row", "lib", "item", "body_len"]
    one = a.where("title_a <> ''").join(b, F.col("title_a") == F.col("title_b")).select(*out, F.lit(1).alias("tier"))
    two = a.where(F.length("number_a") >= NUMBER).join(b, F.col("number_a") == F.col("number_b")).select(*out, F.lit(2).alias("tier"))
    pairs = _either_way(a.where(F.length("title_a") >= TITLE).select("title_a").distinct(), b.where(F.length("title_b") >= TITLE).select("title_b").distinct(), TITLE, [])
    met = a.join(pairs, "title_a").join(b, "title_b")
    speaks = (F.length("number_a") < NUMBER) | ((F.col("number_b") != "") & (F.contains(F.col("number_a"), F.col("number_b")) | F.contains(F.col("number_b"), F.col("number_a"))))
    three = met.where(speaks).select(*out, F.lit(3).alias("tier"))
    in_lib = one.union(two).union(three).groupBy("row", "lib").agg(F.min(F.struct("tier", (-F.col("body_len")).alias("less"), "item")).alias("m"))
    best = in_lib.groupBy("row").agg(F.min(F.struct("m.less", "lib", "m.item", "m.tier")).alias("b"))
    return best.select("row", "b.lib", "b.item", "b.tier", (-F.col("b.less")).alias("body_len"))


def authority(status: Column, checked_at: Column, source: Column, now: Column, fresh_days: int = 30) -> Column:
    """Whether a status may overrule others: ok, placeholder, stale (not checked within fresh_days), non_authoritative_source."""
    known = F.trim(F.coalesce(status, F.lit("")))
    at = F.try_to_timestamp(checked_at, F.lit("yyyy-MM-dd HH:mm:ss"))
    fresh = F.coalesce(at >= now - F.expr(f"interval {fresh_days} days"), F.lit(False))
    bound = F.coalesce(source, F.lit("")).rlike("|".join(NOT_BINDING))
    return F.when(known.isin(PLACEHOLDERS), "placeholder").when(~fresh, "stale").when(bound, "non_authoritative_source").otherwise("ok")


def timeliness_drift(rows: DataFrame, state: DataFrame, now: Column, fresh_days: int = 30) -> DataFrame:
    """rows (ref, title, number, status) with outcome, state and checked_at: what the state (title, number, status,
    checked_at, source) of the same document says.

    A row's number is looked up first (NUMBER characters or more), then the first forty letters of its title; of several
    states the last checked counts. outcome: no_state; the reason for which the state does not count (`authority`);
    empty_attr, if the row has no status; ok; drift, if both have one and differ.
    """
    key = F.left(K.title_strict(F.col("title")), F.lit(40))
    no = F.when(F.length(K.docno(F.coalesce("number", F.lit("")))) >= NUMBER, K.docno(F.coalesce("number", F.lit(""))))
    last = lambda by, name: state.where(by.isNotNull() & (by != "")).groupBy(by.alias(f"_{name}")).agg(F.max_by(F.struct("status", "checked_at", "source"), F.struct("checked_at", "status")).alias(name))
    by_no, by_title = last(no, "n"), last(key, "t")
    met = rows.withColumn("_k", no).withColumn("_l", key).join(by_no, F.col("_k") == F.col("_n"), "left").join(by_title, F.col("_l") == F.col("_t"), "left")
    met = met.withColumn("_s", F.coalesce("n", "t"))
    why, own, theirs = authority(F.col("_s.status"), F.col("_s.checked_at"), F.col("_s.source"), now, fresh_days), F.trim(F.coalesce("status", F.lit(""))), F.trim("_s.status")
    outcome = F.when(F.col("_s").isNull(), "no_state").when(why != "ok", why).when(own == "", "empty_attr").when(own == theirs, "ok").otherwise("drift")
    return met.select(*rows.columns, outcome.alias("outcome"), theirs.alias("state"), F.col("_s.checked_at").alias("checked_at"))


def relocated(records: DataFrame, files: DataFrame, sheet: Column) -> DataFrame:
    """records (ref, path, sha256, name) with outcome, target and candidates, by files (path, sha256) that are there.

    resolvable: the path is there; relocate: files with the same digest are, target being the one with the record's file
    name, else the least path; non_policy: none is, and `sheet` holds; missing: none is. candidates: files of that digest.
    """
    there = files.select(F.col("path").alias("_p")).distinct()
    base = lambda c: F.regexp_extract(c, r"([^/\\]+)$", 1)
    met = records.join(there, F.col("path") == F.col("_p"), "left")
    same = files.where("sha256 <> ''").select(F.col("sha256").alias("_h"), F.col("path").alias("_f")).distinct()
    tried = met.join(same, F.col("_p").isNull() & (F.col("sha256") == F.col("_h")), "left").groupBy(*(F.col(c) for c in records.columns)).agg(
        F.first("_p").alias("_p"), F.count("_f").alias("candidates"), F.min(F.when(F.col("_f").isNotNull(), F.struct((base(F.col("_f")) != F.coalesce("name", F.lit(""))).alias("o"), "_f"))).alias("_t"), F.first(sheet).alias("_sheet"),
    )
    outcome = F.when(F.col("_p").isNotNull(), "resolvable").when(F.col("candidates") > 0, "relocate").when(F.col("_sheet"), "non_policy").otherwise("missing")
    return tried.select(*records.columns, outcome.alias("outcome"), F.when(F.col("_p").isNull(), F.col("_t._f")).alias("target"), "candidates")


def once_each(items: Column, names: list[str]) -> Column:
    """Attachments of a record without exact repeats: the first of those that agree in all of `names`."""
    key = lambda a: F.to_json(F.array(*(F.coalesce(a[n].cast("string"), F.lit("")) for n in names)))
    keys = F.transform(items, key)
    return F.filter(items, lambda a, i: F.array_position(keys, key(a)) == i + 1)
