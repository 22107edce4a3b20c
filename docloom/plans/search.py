"""Full-text and vector search on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as S
from ..operators.index import index_of
from .base import query

_COUNT = lambda c, w: f"((length(lower({c})) - length(replace(lower({c}), '{w}', ''))) / {len(w)})"


@query(f"""with r as (select doc_id, length(text) len, 1.0 * {_COUNT("text", "the")} f0, 1.0 * {_COUNT("text", "loser")} f1 from documents), s as (select count(*) n, avg(len) av, sum((f0 > 0)::int) d0, sum((f1 > 0)::int) d1 from r)
select doc_id, round(greatest(1e-6, ln((n - d0 + 0.5) / (d0 + 0.5))) * (f0 * 2.2) / (f0 + 1.2 * (0.25 + 0.75 * len / av)) + greatest(1e-6, ln((n - d1 + 0.5) / (d1 + 0.5))) * (f1 * 2.2) / (f1 + 1.2 * (0.25 + 0.75 * len / av)), 6) score from r, s where f0 > 0 and f1 > 0 order by score desc, doc_id limit 20""")
def bm25_search(t):
    """Answered from the index of these documents, which is built if there is none yet."""
    return index_of(t("documents"), "doc_id", ["text"]).top({"text": 1.0}, "the loser", 20).rows.withColumnRenamed("row", "doc_id")


@query("select page_id, length(url) as url_chars from pages where contains(lower(html), 'script') and contains(lower(url), 'http') order by url_chars, page_id limit 25")
def like_fallback(t):
    from ..operators.records import like_tokens

    found = t("pages").where(like_tokens("SCRIPT", ["html"]) & like_tokens("http", ["url"]))
    return found.select("page_id", F.length("url").cast("long").alias("url_chars")).orderBy("url_chars", "page_id").limit(25)




@query("with d as (select q.vec_id as query, v.vec_id as row, round(1 - list_cosine_similarity(v.embedding::double[], q.embedding::double[]), 6) distance from embeddings v, (select * from embeddings where vec_id % 100 = 0) q) select query, row, distance, rank from (select *, row_number() over (partition by query order by distance, row) as rank from d) where rank <= 10")
def cosine_topk(t):
    v = t("embeddings")
    return S.nearest(v, "vec_id", "embedding", v.where("vec_id % 100 = 0"), "vec_id", "embedding", 10)


@query("with d as (select q.vec_id as query, v.vec_id as row, round(list_distance(v.embedding::double[], q.embedding::double[]), 6) distance from embeddings v, (select * from embeddings where vec_id % 100 = 0) q) select query, row, distance, rank from (select *, row_number() over (partition by query order by distance, row) as rank from d) where rank <= 5")
def l2_topk(t):
    v = t("embeddings")
    return S.nearest(v, "vec_id", "embedding", v.where("vec_id % 100 = 0"), "vec_id", "embedding", 5, "l2")


@query()
def ann_topk(t):
    """The ten nearest rows by the approximate index; tests measure its recall against `cosine_topk`."""
    import uuid

    from ..checkpoints import shared_folder
    from ..operators.vectors import VectorIndex

    v = t("embeddings")
    index = VectorIndex.build(v, "vec_id", "embedding", f"{shared_folder(v.sparkSession)}/vectors-{uuid.uuid4().hex}")
    return index.nearest(v.where("vec_id % 100 = 0"), "vec_id", "embedding", 10)


@query("with x as (select label, unnest(embedding)::double x, generate_subscripts(embedding, 1) i from embeddings), m as (select label, i, avg(x) x from x group by all), p as (select label as l, list(x order by i) p from m group by 1), d as (select vec_id, label, l, list_cosine_similarity(embedding::double[], p) s from embeddings, p) select vec_id, label, l as nearest from d qualify row_number() over (partition by vec_id order by s desc, l) = 1")
def prototype_argmax(t):
    """The label whose mean vector is nearest to each vector (labels are few, so their means are broadcast)."""
    from ..functions.text import cosine

    v = t("embeddings")
    means = S.prototypes(v, "label", "embedding").agg(F.collect_list(F.struct(F.col("label").alias("l"), "prototype")).alias("m"))
    rows = v.join(F.broadcast(means)).select("vec_id", "label", F.explode("m").alias("m"), "embedding")
    score = F.struct(cosine(F.col("embedding"), F.col("m.prototype")).alias("s"), (-F.col("m.l")).alias("o"))
    return rows.groupBy("vec_id", "label").agg(F.max_by(F.col("m.l"), score).alias("nearest"))


_RANKED = "select q.vec_id as query, v.vec_id as row, row_number() over (partition by q.vec_id order by {d}, v.vec_id) as rank from embeddings v, (select * from embeddings where vec_id % 100 = 0) q"
_COSINE = _RANKED.format(d="round(1 - list_cosine_similarity(v.embedding::double[], q.embedding::double[]), 6)")
_L2 = _RANKED.format(d="round(list_distance(v.embedding::double[], q.embedding::double[]), 6)")


@query(f"with a as (select query, row from ({_COSINE}) where rank <= 10), b as (select query, row from ({_L2}) where rank <= 10), n as (select query, count(*) n from (select query, row from a union select query, row from b) group by 1) select n.query, round((select count(*) from a join b on a.query = b.query and a.row = b.row where a.query = n.query) / n.n, 4) overlap from n")
def ab_jaccard(t):
    v = t("embeddings")
    asked = v.where("vec_id % 100 = 0")
    return S.jaccard(S.nearest(v, "vec_id", "embedding", asked, "vec_id", "embedding", 10), S.nearest(v, "vec_id", "embedding", asked, "vec_id", "embedding", 10, "l2"), "query", "row")


@query("select page_id from pages where contains(lower(url), 'http') and contains(lower(url), 'page')")
def trigram_candidates(t):
    """Pages by two tokens of their URL, through an index of trigrams."""
    p = t("pages")
    return S.by_postings(S.postings(p, "page_id", "url"), p, "page_id", "url", "HTTP page").select("page_id")


@query(f"""with r as (select page_id, length(url) + length(html) len, 10.0 * {_COUNT("url", "http")} + 1.0 * {_COUNT("html", "http")} f0, 10.0 * {_COUNT("url", "script")} + 1.0 * {_COUNT("html", "script")} f1, html from pages), s as (select count(*) n, avg(len) av, sum((f0 > 0)::int) d0, sum((f1 > 0)::int) d1 from r),
c as (select page_id, html, round(greatest(1e-6, ln((n - d0 + 0.5) / (d0 + 0.5))) * (f0 * 2.2) / (f0 + 1.2 * (0.25 + 0.75 * len / av)) + greatest(1e-6, ln((n - d1 + 0.5) / (d1 + 0.5))) * (f1 * 2.2) / (f1 + 1.2 * (0.25 + 0.75 * len / av)), 6) score from r, s where f0 > 0 and f1 > 0 order by score desc, page_id limit 20)
select page_id, score from c qualify row_number() over (partition by html order by score desc, page_id) = 1 order by score desc, page_id limit 10""")
def bm25_weighted(t):
    """URL ten times as heavy as the page; of the best twenty, one of each text, ten at most; from the index of pages."""
    p = t("pages")
    best = index_of(p, "page_id", ["url", "html"]).top({"url": 10.0, "html": 1.0}, "http script", 20).rows.withColumnRenamed("row", "page_id")
    return S.best_of_each(best, p, "page_id", 10, ["html"])


@query("select doc_id, 0.0::double score from documents where contains(lower(text), 'of') and contains(lower(text), 'le') order by length(text), doc_id limit 15")
def search_facade(t):
    """A query with tokens too short for trigrams falls back to LIKE, shortest first."""
    return S.search(t("documents"), "doc_id", "text", "of le", 15)


@query("with d as (select q.vec_id as query, v.vec_id as row, case when v.label < 5 then 'a' else 'b' end origin, round(1 - list_cosine_similarity(v.embedding::double[], q.embedding::double[]), 6) distance from embeddings v, (select * from embeddings where vec_id % 100 = 0) q) select query, row, origin, distance from d qualify row_number() over (partition by query order by distance, row) <= 8")
def semantic_tables(t):
    """The eight nearest rows of two tables together, with the table that each comes from."""
    from pyspark.sql import Window

    v = t("embeddings")
    asked = v.where("vec_id % 100 = 0")
    found = [S.nearest(v.where(part), "vec_id", "embedding", asked, "vec_id", "embedding", 8).withColumn("origin", F.lit(name)) for name, part in (("a", "label < 5"), ("b", "label >= 5"))]
    both = found[0].union(found[1]).withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("distance", "row")))
    return both.where("n <= 8").select("query", "row", "origin", "distance")
