"""Known names in running text, found with automata; what a cited name stands for; the graph of cited clauses."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clauses import NUMERAL, numeral, target_check
from .likeness import held_in

#: Names of one automaton.
PART = 200_000
#: Fixed: marks of validity after a cited title, openings before it.
VALIDITY = "[（(](?:已废止|已失效|废止|失效|修订)[)）]"
OPENINGS = "^(?:关于印发|关于发布|关于印发修订后的|修订后的|关于下发)+"
#: Fixed: article, paragraph and item after a cited title, at most twelve characters later; what joins several of them.
ARTICLE = f"第\\s*({NUMERAL})\\s*条(?:第\\s*({NUMERAL})\\s*款)?(?:第\\s*({NUMERAL})\\s*项)?"
JOINED = "[、,和及与或者]{1,4}"
#: Least length of a cited name that may be part of a title.
INNER = 6

_built: dict[int, ahocorasick.Automaton] = {}


def _automaton(sent) -> ahocorasick.Automaton:
    """The automaton of a broadcast list of names, built once in each worker."""
    if sent.id not in _built:
        _built.clear()
        made = ahocorasick.Automaton()
        for name in sent.value:
            made.add_word(name, name)
        made.make_automaton()
        _built[sent.id] = made
    return _built[sent.id]


class _Sent:
    """A broadcast list with a number that tells it from others in a worker."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    @property
    def value(self) -> list[str]:
        return self.broadcast.value

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}


def names_in(texts: DataFrame, row: str, text: str, names: DataFrame, name: str, longest: bool = True) -> DataFrame:
    """(row, name, start): where names stand in texts; start counts characters from 0.

    Each text is read once by the automaton of all names; more than PART names are dealt to several automata by hash, each
    of which reads all texts. With `longest`, of places that overlap the leftmost counts, and of those that begin together
    the longest; else every place of every name counts. Null and empty names and texts give nothing.
    """
    spark = texts.sparkSession
    known = names.where(F.length(name) > 0).select(F.col(name).alias("name")).distinct()
    parts = max(1, math.ceil(known.count() / PART))
    rows = texts.where(F.length(text) > 0).select(F.col(row).alias("row"), F.col(text).alias("text"))
    kind = f"row {dict(rows.dtypes)['row']}, name string, start long, size long"
    found = []
    for part in range(parts):
        own = known.where(F.pmod(F.xxhash64("name"), F.lit(parts)) == part)
        sent = _Sent(spark.sparkContext.broadcast(own.toArrow().column("name").to_pylist()))

        def run(batches: Iterator[pa.RecordBatch], sent: _Sent = sent) -> Iterator[pa.RecordBatch]:
            if not sent.value:
                return
            automaton = _automaton(sent)
            search = automaton.iter_long if longest and parts == 1 else automaton.iter
            for batch in batches:
                at, hits, starts = [], [], []
                for i, t in enumerate(batch.column(1).to_pylist()):
                    for end, hit in search(t):
                        at.append(i)
                        hits.append(hit)
                        starts.append(end - len(hit) + 1)
                if at:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(hits), pa.array(starts, pa.int64()), pa.array([len(h) for h in hits], pa.int64())], names=["row", "name", "start", "size"])

        found.append(rows.mapInArrow(run, kind))
    every = reduce(DataFrame.union, found)
    if longest and parts > 1:
        every = every.repartition("row").sortWithinPartitions("row", "start", F.desc("size")).mapInArrow(_leftmost, kind)
    return every.select("row", "name", "start")


def _leftmost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of places sorted by row, start and falling size those that begin where the one before in the row has ended."""
    last, end = None, 0
    for batch in batches:
        keep = []
        for i, (row, start, size) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)))):
            if row != last or start >= end:
                keep.append(i)
                last, end = row, start + size
        yield batch.take(pa.array(keep, pa.int64()))


def cited_key(title: Column) -> Column:
    """A cited title as a key: without book-title marks, marks of validity, openings and blanks."""
    t = F.regexp_replace(F.trim(F.coalesce(title, F.lit(""))), "^《+|》+$|^[《》]+|[《》]+$", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, VALIDITY, ""), OPENINGS, ""), r"(?U)\s+", "")


def resolved_names(names: DataFrame, name: str, titles: DataFrame, row: str, title: str, aliases: DataFrame | None = None) -> DataFrame:
    """(name, row, method): the titled row that each distinct cited name stands for, if any.

    exact: the same key; alias: the key of the alias's full name (aliases: alias, full); inside: a name of INNER letters or
    more that stands in exactly one title's key; prefix: in several, but exactly one begins with it. Of rows with the same
    key the smallest counts.
    """
    asked = names.select(F.col(name).alias("name")).distinct().withColumn("key", cited_key(F.col("name"))).where("key <> ''")
    known = titles.select(F.col(row).alias("row"), cited_key(F.col(title)).alias("title")).where("title <> ''").groupBy("title").agg(F.min("row").alias("row"))
    exact = asked.join(known, F.col("key") == F.col("title")).select("name", "row", F.lit(0).alias("tier"), F.lit("exact").alias("method"))
    if aliases is not None:
        full = aliases.select(cited_key(F.col("alias")).alias("_a"), cited_key(F.col("full")).alias("_f"))
        exact = exact.union(asked.join(full, F.col("key") == F.col("_a")).join(known, F.col("_f") == F.col("title")).select("name", "row", F.lit(1), F.lit("alias")))
    met = held_in(asked.select("key").distinct(), known, "key", "title", INNER)
    counted = met.groupBy(F.col("a").alias("_a")).agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("only"), F.sum(F.startswith("b", F.col("a")).cast("int")).alias("n_begin"), F.min(F.when(F.startswith("b", F.col("a")), F.col("b"))).alias("begins"))
    one = counted.select("_a", F.when(F.col("n") == 1, F.col("only")).when(F.col("n_begin") == 1, F.col("begins")).alias("_t"), F.when(F.col("n") == 1, "inside").otherwise("prefix").alias("method")).where("_t is not null")
    inside = asked.join(one, F.col("key") == F.col("_a")).join(known, F.col("_t") == F.col("title")).select("name", "row", F.lit(2).alias("tier"), "method")
    return exact.union(inside).groupBy("name").agg(F.min_by(F.struct("row", "method"), "tier").alias("best")).select("name", "best.row", "best.method")


def cited_clauses(docs: DataFrame, row: str, text: str) -> DataFrame:
    """(row, name, article, para, item): clauses that texts cite by title, joined ones each; missing parts are null."""
    chain = ARTICLE.replace("(", "(?:").replace("(?:?:", "(?:")
    cited = f"《[^《》]+》[^。；\\n《》]{{0,12}}?(?:{chain}(?:{JOINED}{chain})*)"
    found = docs.where(F.contains(F.col(text), F.lit("《"))).select(F.col(row).alias("row"), F.explode(F.regexp_extract_all(F.col(text), F.lit(cited), 0)).alias("m"))
    after = F.substring_index("m", "》", -1)
    parts = F.arrays_zip(*(F.regexp_extract_all(after, F.lit(ARTICLE), i).alias(n) for i, n in ((1, "article"), (2, "para"), (3, "item"))))
    each = found.select("row", F.regexp_extract("m", "《([^《》]+)》", 1).alias("name"), F.explode(parts).alias("p"))
    number = lambda n: F.when(F.col(f"p.{n}") != "", numeral(F.col(f"p.{n}")))
    return each.select("row", "name", number("article").alias("article"), number("para").alias("para"), number("item").alias("item"))


def clause_graph(docs: DataFrame, row: str, title: str, text: str, clauses: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(src, dst, kind, article, para, item, n, state): edges between texts by the titles that they cite.

    article: a cited clause, with the state that `target_check` gives it among clauses (doc, number); title: a quoted title
    of more than one letter, n times, not the text's own. Names are resolved by `resolved_names` among the docs' titles.
    """
    by_clause = cited_clauses(docs, row, text)
    quoted = docs.where(F.contains(F.col(text), F.lit("《"))).select(F.col(row).alias("row"), F.explode(F.regexp_extract_all(F.col(text), F.lit("《([^《》]+)》"), 1)).alias("name")).where(F.length(F.trim("name")) > 1)
    by_title = quoted.groupBy("row", "name").agg(F.count(F.lit(1)).alias("n"))
    known = resolved_names(by_title.select("name").union(by_clause.select("name")), "name", docs, row, title, aliases).select(F.col("name").alias("_name"), F.col("row").alias("dst"))
    articles = target_check(by_clause.join(known, F.col("name") == F.col("_name")).select(F.col("row").alias("src"), F.col("dst").alias("doc"), F.col("article").alias("number"), "para", "item"), clauses)
    titled = by_title.join(known, F.col("name") == F.col("_name")).where(~F.col("row").eqNullSafe(F.col("dst")))
    first = articles.select("src", F.col("doc").alias("dst"), F.lit("article").alias("kind"), F.col("number").alias("article"), "para", "item", F.lit(1).cast("long").alias("n"), "state")
    none = F.lit(None)
    return first.unionByName(titled.select(F.col("row").alias("src"), "dst", F.lit("title").alias("kind"), none.cast("int").alias("article"), none.cast("int").alias("para"), none.cast("int").alias("item"), "n", none.cast("string").alias("state")))
