"""Lines that many documents share, kept in one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

#: What is stripped from both ends of a line before lines are compared.
BLANKS = " \t\n\x0b\x0c\r"
#: Rows without an id count as one document that comes after all others.
NO_ID = (1 << 63) - 1


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    bare = F.trim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(ascii_lower(bare))


def shared_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """(doc, text_key, lost): the numbers of the lines to be dropped, sorted, of each text of docs (doc, text_key, text).

    A line's key is told by two 64-bit hashes. Of each key the documents are counted and the smallest is taken, combined
    before the shuffle; the lines of other documents are then met with the keys over the threshold, a join of narrow rows
    in which a very frequent line is split by adaptive execution.
    """
    each = docs.select("doc", "text_key", F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("line", line_key(F.col("line")))
    keys = each.where(F.char_length("line") >= min_chars).select("doc", "text_key", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    if min_docs <= 2:
        owners = keys.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where(F.col("first") < F.col("last") if min_docs == 2 else F.lit(True))
    else:
        owners = keys.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.count("one").alias("n")).where(F.col("n") >= min_docs)
    lost = keys.join(owners.select("h1", "h2", "first"), ["h1", "h2"]).where(F.col("doc") > F.col("first"))
    return lost.groupBy("doc", "text_key").agg(F.array_sort(F.collect_set("at")).alias("lost"))


def without(lines: Column, lost: Column) -> Column:
    """The array `lines` without the places in `lost` (sorted, from 0): the slices between them, laid end to end."""
    n = F.size(lost)
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(lost, i - 1) + 1)
    end = lambda i: F.when(i == n, F.size(lines)).otherwise(F.get(lost, i))
    return F.flatten(F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(lines, begin(i) + 1, end(i) - begin(i))))


def dedup(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text without the lines that a document before it has as well.

    Lines end at line feeds; they are equal if they agree without blanks at the ends and with A-Z in lower case. A line of
    at least min_chars code points found in at least min_docs documents stays only in the document with the smallest id
    (everywhere in it). Returns doc_id, n_lines (before), n_dropped, kept (the other lines, in order).
    Null and empty texts are one empty line. Rows of one id are one document; rows without an id count as one document
    after all others. Repeated rows are all returned; an empty table gives no rows; other columns are left out.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    id_ = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(id_.alias("doc_id"), F.coalesce(id_, F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    lost = shared_lines(rows.select("doc", "text_key", "text"), min_chars, min_docs)
    met = rows.join(lost, ["doc", "text_key"], "left").select("doc_id", "text", "lost", F.split("text", "\n").alias("lines"))
    kept = F.when(F.col("lost").isNull(), F.col("text")).otherwise(F.array_join(without(F.col("lines"), F.col("lost")), "\n"))
    return met.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost")).cast("long").alias("n_dropped"), kept.alias("kept"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM each),
shared AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
told AS (SELECT k.*, s.first IS NOT NULL AND k.doc_id > s.first AS lost FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM told GROUP BY doc_id
"""
