"""Typed relations between documents, from the words around quoted titles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import cut
from ..functions import keys as K
from ..functions.decisions import NOMINAL, is_body, is_generic, is_no_document, target_class
from .clauses import NUMERAL, lines, numeral, target_check
from .likeness import held_in
from .matching import locate, tiers

#: Fixed: words before a quoted title that make it a basis; words after or before it that repeal it, longer ones first;
#: contexts in which a title is neither, and in which nothing is repealed; heads of lists of repealed documents.
BASIS = ["根据", "依据", "依照", "按照", "遵照", "基于", "循", "参照"]
REPEAL = ["同时废止", "予以废止", "宣布废止", "宣布失效", "停止执行", "不再适用", "予以取消", "废止", "失效", "取消"]
EXCLUDED = ["负责解释", "解释权", "授权解释", "委托解释", "行政复议", "行政诉讼", "申请复议", "提起诉讼", "法律适用", "参考资料"]
NEGATION = ["拟废止", "建议废止", "征求意见", "草案", "待废止", "是否废止", "不得废止", "未废止", "尚未失效", "不予废止"]
LIST_HEAD = "(下列|以下|附件所列|如下).{0,30}(" + "|".join(REPEAL) + ")"
LIST_LINE = rf"^[（(]?({NUMERAL})[)）、.．]\s*.{{0,40}}《([^《》]+)》"
REACH = 100


def quotes(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, pos, title, article, before, after): each quoted title with up to 100 characters on either side.

    The text is split once at its titles; what lies between two of them is the context of both.
    """
    mark = rf"《([^《》]+)》(?:第\s*({NUMERAL})\s*条)?"
    gaps = F.transform(F.split(F.col(text), mark), lambda g: F.struct(F.right(g, F.lit(REACH)).alias("tail"), F.left(g, F.lit(REACH)).alias("head")))
    zipped = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(mark), 1).alias("title"), F.regexp_extract_all(text, F.lit(mark), 2).alias("article"))
    found = docs.where(F.contains(F.col(text), F.lit("《"))).select(F.col(doc).alias("doc"), zipped.alias("_z"))
    heads = F.transform("_z", lambda x, i: F.struct(x["title"].alias("title"), x["article"].alias("article"), x["gap"]["tail"].alias("before"), F.get(F.col("_z"), i + 1)["gap"]["head"].alias("after")))
    rows = found.select("doc", F.posexplode(F.filter(heads, lambda x: x["title"].isNotNull())).alias("pos", "x"))
    return rows.select("doc", "pos", "x.title", numeral(F.col("x.article")).alias("article"), "x.before", "x.after")


def _any(text: Column, words: list[str], end: str = "") -> Column:
    return text.rlike("(" + "|".join(words) + ")" + end)


def listed(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, pos, title): titles in numbered lines after a line that says that what is listed is repealed; the first line
    without a number ends the list."""
    at = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines(docs.where(F.col(text).rlike(LIST_HEAD)), doc, text)
    item = F.col("text").rlike(LIST_LINE)
    state = F.when(F.col("text").rlike(LIST_HEAD), F.lit(True)).when(~item, F.lit(False))
    rows = rows.withColumn("_open", F.last(state, ignorenulls=True).over(at))
    return rows.where(item & F.col("_open")).select("doc", F.col("line").alias("pos"), F.regexp_extract("text", LIST_LINE, 2).alias("title"))


def relations(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(relation_id, doc, kind, title, article, action): basis and repeal edges, one for each document, kind and title.

    A title is a basis if a trigger stands right before it, or before the title that it is listed with. It is repealed if a
    repealing word that is no part of a noun follows it or stands right before it, unless a negation stands near, or if it
    stands in a list of repealed documents; with an article the repeal is partial (action ends in _partial). Titles in
    contexts of interpretation and procedure are neither. Names of bodies, of kinds of documents and of what is no document
    make no edge. The first place counts; a later place may add its article. Ids are digests of what makes an edge, so they
    are the same in every run.
    """
    q = quotes(docs, doc, text).withColumn("_own", _any(F.col("before"), BASIS, r"[^，。；;]{0,12}$"))
    # A title behind another one, with nothing but a conjunction between them, is listed with it.
    q = q.withColumn("_list", F.sum((~F.col("before").rlike(r"^[、，和及与以或\s]*$") | (F.col("pos") == 0)).cast("int")).over(Window.partitionBy("doc").orderBy("pos")))
    q = q.withColumn("_basis", F.max("_own").over(Window.partitionBy("doc", "_list")))
    q = q.where(~is_generic(F.col("title")) & ~is_body(F.col("title")) & ~is_no_document(F.col("title")))
    near = F.concat(F.col("before"), F.lit(" "), F.col("after"))
    q = q.where(~_any(near, EXCLUDED))
    is_basis = F.col("_basis")
    negated = _any(near, NEGATION)
    verb = "(" + "|".join(REPEAL) + ")(?!" + "|".join(NOMINAL) + ")"
    action = F.regexp_extract(F.regexp_extract("after", r"^[^。；;]*", 0), verb, 1)
    action = F.when(action != "", action).otherwise(F.regexp_extract("before", "(" + "|".join(REPEAL) + ")[^。；;，]{0,6}$", 1))
    basis = q.where(is_basis).select("doc", "pos", F.lit("basis").alias("kind"), "title", "article", F.lit("").alias("action"))
    repeal = q.where(~is_basis & ~negated).withColumn("action", action).where("action <> ''")
    repeal = repeal.select("doc", "pos", F.lit("repeal").alias("kind"), "title", "article", F.concat("action", F.when(F.col("article").isNotNull(), "_partial").otherwise("")).alias("action"))
    in_list = listed(docs, doc, text).select("doc", (F.col("pos") + 1_000_000).alias("pos"), F.lit("repeal").alias("kind"), "title", F.lit(None).cast("int").alias("article"), F.lit("listed").alias("action"))
    edges = basis.union(repeal).union(in_list).groupBy("doc", "kind", "title").agg(F.min_by("action", "pos").alias("action"), F.min_by("article", F.when(F.col("article").isNotNull(), F.col("pos"))).alias("article"))
    key = F.concat_ws("|", F.col("doc").cast("string"), "kind", "title", "action")
    return edges.select(F.substring(F.sha1(key), 1, 16).alias("relation_id"), "doc", "kind", "title", "article", "action")


def resolve(refs: DataFrame, index: DataFrame, ref: str = "ref", number: str = "number", title: str = "title") -> DataFrame:
    """refs (title, number) with target, method and confidence: the one entity of index (ref, number, title) that they stand for.

    Tiers, best first: strong number, number, signature of the number (0.95), quoted title, title without version, without
    the country's name, exact title (0.9). A key that stands for several entities resolves nothing. Else unresolved.
    """
    no, name = F.col(number), F.col(title)
    plain = lambda c: K.title_quoted(c)
    tiers_ = [("docno_strong", K.docno_strong(no), 1.0), ("docno", K.docno(no), 1.0), ("docno_sig", F.coalesce(K.signature(no), F.lit("")), 0.95), ("title", plain(name), 0.9), ("title_version", plain(K.without_version(name)), 0.9), ("title_country", plain(K.without_country(K.without_version(name))), 0.9), ("title_strict", K.title_strict(name), 0.9)]
    return tiers(refs, ref, index, ref, [(method, key, key, confidence) for method, key, confidence in tiers_])


#: Least length of a title that may hold another or stand in one, and of the short names that a title may end with.
HELD, SHORT = 4, 3


def held_titles(asked: DataFrame, index: DataFrame, ref: str) -> DataFrame:
    """(probe, target): for each of asked (probe) the entity of index (key, ref) whose key holds it or stands in it.

    Keys and probes of HELD letters or more count, the longest key first, then the least one. A probe of SHORT letters is
    only met by keys that end with it. Both ways are looked up by rare runs of letters, see `held_in`.
    """
    keys = index.where("key <> ''").groupBy("key").agg(F.min(ref).alias("_ref"))
    probes = asked.where(F.length("probe") >= HELD).select("probe").distinct()
    within = held_in(probes, keys, "probe", "key", HELD).select(F.col("a").alias("probe"), F.col("b").alias("key"))
    around = held_in(keys, probes, "key", "probe", HELD).select(F.col("b").alias("probe"), F.col("a").alias("key"))
    ends = asked.where(F.length("probe") == SHORT).select("probe").distinct().join(keys.withColumn("_end", F.right("key", F.lit(SHORT))), F.col("probe") == F.col("_end")).select("probe", "key")
    best = within.union(around).union(ends).groupBy("probe").agg(F.min(F.struct((-F.length("key")).alias("l"), "key"))["key"].alias("_key"))
    return best.join(keys, F.col("_key") == F.col("key")).select("probe", F.col("_ref").alias("target"))


def resolve_target(refs: DataFrame, index: DataFrame, weak: DataFrame | None = None, strict: bool = False, ref: str = "ref", number: str = "number", title: str = "title") -> DataFrame:
    """refs (title, number) with target, weak_key, method and confidence.

    target: by the tiers of `resolve`, then by a title that holds the quoted one or stands in it (title_contains, 0.7; not
    if strict, as across domains a law would be taken for a policy that quotes it). What stays unresolved is looked up in
    the weak index (ref, number, title) in the same way, and gets its weak_key only. Nothing is made up: the rest is
    unresolved, without either.
    """
    probe = F.coalesce(F.nullif(K.title_quoted(F.col(title)), F.lit("")), K.title_strict(F.col(title)))
    asked = refs.select(number, title).distinct().withColumn("_p", probe)
    none = F.lit(None)

    def found(rows: DataFrame, entities: DataFrame) -> DataFrame:
        met = cut(resolve(rows, entities, ref, number, title))
        if strict:
            return met
        keyed = cut(entities.select(K.title_quoted(F.col(title)).alias("key"), ref))
        lost = met.where(F.col("target").isNull()).select(F.col("_p").alias("probe")).distinct()
        held = held_titles(lost, keyed, ref).select(F.col("probe").alias("_probe"), F.col("target").alias("_held"))
        joined = met.join(held, F.col("target").isNull() & (F.col("_p") == F.col("_probe")), "left")
        by_title = F.col("target").isNull() & F.col("_held").isNotNull()
        method, confidence = F.when(by_title, "title_contains").otherwise(F.col("method")), F.when(by_title, 0.7).otherwise(F.col("confidence"))
        return cut(joined.withColumn("method", method).withColumn("confidence", confidence).withColumn("target", F.coalesce("target", "_held")).drop("_probe", "_held"))

    solved = found(asked, index)
    if weak is None:
        solved = solved.withColumn("weak_key", none.cast(dict(index.dtypes)[ref]))
    else:
        rest = found(solved.where(F.col("target").isNull()).select(*asked.columns), weak).withColumnRenamed("target", "weak_key").withColumn("target", none.cast(dict(index.dtypes)[ref]))
        solved = solved.where(F.col("target").isNotNull()).withColumn("weak_key", none.cast(dict(weak.dtypes)[ref])).unionByName(rest)
    named = solved.select(F.col(number).alias("_n"), F.col(title).alias("_t"), "target", "weak_key", "method", "confidence")
    return refs.join(named, F.col(number).eqNullSafe(F.col("_n")) & F.col(title).eqNullSafe(F.col("_t"))).drop("_n", "_t")


def edges(found: DataFrame, index: DataFrame) -> DataFrame:
    """Relations with their target (see `resolve`), its class, and confidence; edges to bodies and kinds of documents are left out."""
    met = resolve(found.withColumn("number", F.lit("")), index).withColumn("target_class", target_class(F.col("target"), F.lit(""), F.col("title")))
    return met.where(~F.col("target_class").isin("organ", "generic")).drop("number")


def offsets(docs: DataFrame, doc: str, text: str, pattern: str) -> DataFrame:
    """(doc, i, at, found): what `pattern` matches in each text, in order from 0, and where it begins, in characters from 0.

    A text is split once; only the lengths of what lies between matches are summed up, in rows of their own.
    """
    gaps, found = F.split(F.col(text), pattern), F.regexp_extract_all(F.col(text), F.lit(pattern), 0)
    zipped = F.arrays_zip(F.transform(gaps, lambda g: F.length(g)).alias("gap"), found.alias("found"))
    rows = docs.where(F.col(text).rlike(pattern)).select(F.col(doc).alias("doc"), F.posexplode(zipped).alias("i", "x")).where("x.found is not null")
    ends = F.sum(F.col("x.gap") + F.length("x.found")).over(Window.partitionBy("doc").orderBy("i"))
    return rows.select("doc", "i", (ends - F.length("x.found")).cast("long").alias("at"), F.col("x.found").alias("found"))


def located(docs: DataFrame, index: DataFrame, clauses: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Relations with both ends located: relation_id, doc, src_article, kind, title, action, target, method, confidence,
    article, state, snippet.

    src_article: the article of the text in which the title first stands (null before the first one); target: what it
    resolves to in index (ref, number, title), see `resolve`; article: the cited article of the target, with its state
    among clauses (doc: a ref, number), see `target_check`; null without one. snippet: the title with up to 100 characters
    on either side.
    """
    first = lambda c: F.min_by(c, "pos").alias(c)
    places = quotes(docs, doc, text).join(offsets(docs, doc, text, "《[^《》]+》").select(F.col("doc").alias("_d"), F.col("i").alias("_i"), "at"), (F.col("doc") == F.col("_d")) & (F.col("pos") == F.col("_i")))
    places = places.withColumn("snippet", F.concat("before", F.lit("《"), "title", F.lit("》"), F.coalesce("after", F.lit("")))).groupBy(F.col("doc").alias("_doc"), F.col("title").alias("_title")).agg(first("at"), first("snippet"))
    found = relations(docs, doc, text).join(places, (F.col("doc") == F.col("_doc")) & (F.col("title") == F.col("_title")), "left").drop("_doc", "_title")
    mark = rf"(?m)^[ \t　]*第\s*(?:{NUMERAL})\s*条"
    marks = offsets(docs, doc, text, mark).select("doc", "at", numeral(F.regexp_extract("found", rf"第\s*({NUMERAL})\s*条", 1)).alias("number"))
    inside = locate(found.where("at is not null").select("doc", "at").distinct(), "at", marks, "doc", "at", "number").select(F.col("doc").alias("_doc"), F.col("at").alias("_at"), F.col("number").alias("src_article"))
    met = found.join(inside, (F.col("doc") == F.col("_doc")) & (F.col("at") == F.col("_at")), "left").drop("_doc", "_at", "at")
    solved = cut(resolve(cut(met.withColumn("number", F.lit(""))), index).drop("number"))
    cited = solved.where("target is not null and article is not null").select(F.col("target").alias("doc"), F.col("article").alias("number")).distinct()
    states = target_check(cited, clauses).select(F.col("doc").alias("_t"), F.col("number").alias("_n"), "state")
    out = solved.join(states, (F.col("target") == F.col("_t")) & (F.col("article") == F.col("_n")), "left")
    return out.select("relation_id", "doc", "src_article", "kind", "title", "action", "target", "method", "confidence", "article", "state", "snippet")


def gate(edges: DataFrame, index: DataFrame, stated: dict[str, int] | None = None) -> DataFrame:
    """(rule, n, example): what is wrong with edges of `located`; no rows if nothing is.

    keys: a relation without id, document, kind or title; ids: one id twice; enums: a kind, action or method outside its
    list; trace: no snippet; refs: a target that index (ref) does not hold; stat: another number of edges of a kind than
    `stated`.
    """
    actions = [*REPEAL, *(f"{a}_partial" for a in REPEAL), "listed", ""]
    empty = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    wrong = {
        "keys": empty("relation_id") | empty("doc") | empty("kind") | empty("title"), "trace": empty("snippet"),
        "enums": ~F.coalesce(F.col("kind").isin("basis", "repeal"), F.lit(False)) | ~F.coalesce("action", F.lit("")).isin(actions) | empty("method"),
    }
    told = [edges.where(w).agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("n"), F.min(F.col("relation_id")).alias("example")) for name, w in wrong.items()]
    twice = edges.groupBy("relation_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    told.append(twice.agg(F.lit("ids").alias("rule"), F.count(F.lit(1)).alias("n"), F.min("relation_id").alias("example")))
    known = index.select(F.col("ref").alias("_r")).distinct()
    lost = edges.where("target is not null").join(known, F.col("target") == F.col("_r"), "left_anti")
    told.append(lost.agg(F.lit("refs").alias("rule"), F.count(F.lit(1)).alias("n"), F.min(F.col("target").cast("string")).alias("example")))
    out = reduce(DataFrame.union, told)
    if stated is not None:
        counts = edges.groupBy("kind").agg(F.count(F.lit(1)).alias("_n"))
        said = edges.sparkSession.createDataFrame(list(stated.items()), "kind string, said long")
        other = counts.join(said, "kind", "full").where(~F.coalesce("_n", F.lit(0)).eqNullSafe(F.coalesce("said", F.lit(0))))
        out = out.union(other.agg(F.lit("stat").alias("rule"), F.count(F.lit(1)).alias("n"), F.min("kind").alias("example")))
    return out.where("n > 0")


def statistics(edges: DataFrame) -> DataFrame:
    """(kind, n, documents, targets, with_article)."""
    return edges.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc").alias("documents"), F.countDistinct("title").alias("targets"), F.round(F.avg(F.col("article").isNotNull().cast("double")), 4).alias("with_article"))
