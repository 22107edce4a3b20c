"""Records of several sources in one set of columns: mapping, attachments, filling, cleaning, write-back."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import text as T
from .records import keep_first

#: Fixed: target columns and, by source, the raw fields that they are taken from, the first that is filled.
FIELDS: dict[str, dict[str, list[str]]] = {
    "gov": {"fallback_no": ["bbbs"], "title": ["title"], "category": ["category"], "publish_date": ["publish_date"], "effective_date": ["effective_date"], "issue_organ": ["issue_organ"], "source_url": ["detail_url"], "body_text": ["full_text", "summary"], "summary": ["summary"]},
    "mof": {"fallback_no": ["id"], "title": ["title"], "category": ["category_name"], "publish_date": ["publish_date"], "effective_date": ["effective_date"], "issue_organ": ["issue_org"], "source_url": ["detail_link", "api_link"], "body_text": ["content_text"], "summary": ["summary"]},
    "nfra": {"fallback_no": ["index_no", "doc_id"], "title": ["title"], "category": ["category", "category_type"], "publish_date": ["publish_date"], "effective_date": ["effective_date"], "issue_organ": ["issuing_authority"], "source_url": ["detail_url"], "body_text": ["content"], "summary": ["summary"]},
    "pbc": {"fallback_no": [], "title": ["title"], "category": ["category"], "publish_date": ["publish_date"], "effective_date": ["effective_date"], "issue_organ": ["issuing_authority"], "source_url": ["detail_url"], "body_text": ["content"], "summary": ["summary"]},
    "supp": {"fallback_no": ["document_number", "task_index"], "title": ["title"], "category": ["category"], "publish_date": ["publish_date"], "effective_date": ["effective_date"], "issue_organ": ["issue_organ"], "source_url": ["source_url"], "body_text": ["body_text", "content"], "summary": ["summary"]},
}
NUMBER = ["document_number", "doc_no", "document_no"]
#: Fixed: sources whose index number is their own field rather than the document number.
OWN_INDEX = ["nfra", "supp"]
#: Fixed: names under which an attachment's fields are found.
ATTACHMENT = {
    "file_name": ["file_name", "name", "attachment_name", "title"], "kind": ["kind", "mime", "file_type", "attachment_kind"], "local_path": ["local_path", "content_ref", "path"], "sha256": ["sha256"], "bytes": ["bytes", "size_bytes", "content_length"],
    "text_len": ["text_len", "char_count", "text_length"], "url": ["url", "file_url", "download_url"],
}


def field(df: DataFrame, names: list[str]) -> Column:
    """The first of df's columns among names that is filled, as text; empty if none is."""
    have = set(df.columns)
    found = [F.nullif(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names if n in have]
    return F.coalesce(*found, F.lit(""))


def key_of(*parts: Column) -> Column:
    """A business key: digest of parts joined by |, null as empty."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def mapped(df: DataFrame, source: str, number: object, fields: dict[str, list[str]] | None = None) -> DataFrame:
    """Raw records of a source in the common columns.

    number: a function of (raw number, title, body) that gives the document number. Returns index_no, title, category,
    publish_date, effective_date, issue_organ, document_number, source_url, source, body_text, summary, timeliness_status,
    body_source, attachment_count, dedup_key; missing fields are empty. index_no is the document number, else the source's
    own field (sources of OWN_INDEX the other way round).
    """
    take = {c: field(df, names) for c, names in (fields or FIELDS[source]).items()}
    no = number(field(df, NUMBER), take["title"], take["body_text"])
    first, second = (take["fallback_no"], no) if source in OWN_INDEX else (no, take["fallback_no"])
    index = F.when(first != "", first).otherwise(second if source != "nfra" else F.lit(""))
    given = F.col("source").cast("string") if "source" in df.columns else F.lit("")
    own = D.canonical_source(given) if source in ("gov", "mof") else F.lit("")
    count = F.coalesce(F.size("attachments"), F.lit(0)) if "attachments" in df.columns else F.lit(0)
    rows = df.select(
        index.alias("index_no"), take["title"].alias("title"), take["category"].alias("category"), take["publish_date"].alias("publish_date"), take["effective_date"].alias("effective_date"), take["issue_organ"].alias("issue_organ"), no.alias("document_number"), take["source_url"].alias("source_url"),
        F.when(own != "", own).otherwise(source).alias("source"), take["body_text"].alias("body_text"), take["summary"].alias("summary"), D.canonical_timeliness(field(df, ["timeliness_status"])).alias("timeliness_status"), D.canonical_body_source(field(df, ["body_source"])).alias("body_source"), count.alias("attachment_count"),
    )
    keyed = F.when(F.col("index_no") != "", F.col("index_no")).otherwise(F.col("source_url")) if source in ("gov", "pbc") else F.col("index_no")
    return rows.withColumn("dedup_key", key_of(keyed, F.col("source_url"), F.col("publish_date")))


def attachment_view(item: Column, names: set[str]) -> Column:
    """An attachment (a struct with some of `names`) under the common names; missing fields are empty."""
    some = lambda own: F.coalesce(*(F.nullif(item[n].cast("string"), F.lit("")) for n in own if n in names), F.lit(""))
    return F.struct(*(some(own).alias(c) for c, own in ATTACHMENT.items()))


def attachments(df: DataFrame, row: str, nested: str = "attachments") -> DataFrame:
    """(row, file_name, kind, local_path, sha256, bytes, text_len, url): a row for each attachment.

    Records with a list give its items; records that are attachments themselves (link_type) give one; others give none.
    """
    have = set(df.columns)
    flat_names = {"title": "file_name", "file_type": "kind", "local_path": "local_path", "detail_url": "url"}
    own = {target: field(df, [name]) for name, target in flat_names.items()}
    flat = F.struct(*((F.length(field(df, ["content"])).cast("string") if c == "text_len" else own.get(c, F.lit(""))).alias(c) for c in ATTACHMENT))
    parts = []
    if nested in have:
        names = set(df.schema[nested].dataType.elementType.names)
        parts.append(df.where(F.size(nested) > 0).select(row, F.explode(F.transform(nested, lambda a: attachment_view(a, names))).alias("a")))
    if "link_type" in have:
        alone = F.col("link_type") == "attachment"
        parts.append(df.where(alone & ~F.coalesce(F.size(nested) > 0, F.lit(False)) if nested in have else alone).select(row, flat.alias("a")))
    if not parts:
        return df.limit(0).select(row, flat.alias("a")).select(row, "a.*")
    found = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    return found.select(row, "a.*")


def split_bodies(items: Column, body: Column, least: int = 40) -> Column:
    """Struct (real, carriers) of attachments: carriers are those whose first `least` characters stand in the body."""
    squeeze = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", "")
    carries = lambda a: (F.length(squeeze(a["text"])) >= least) & F.contains(squeeze(body), F.left(squeeze(a["text"]), F.lit(least)))
    return F.struct(F.filter(items, lambda a: ~carries(a)).alias("real"), F.filter(items, carries).alias("carriers"))


def filled_from_attachment(body: Column, title: Column, attachment: Column, least: int = 50) -> Column:
    """Struct (body, body_source): an empty body takes the attachment's text if that is long enough and holds the title."""
    key = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s《》（）()]", "")
    fits = (F.trim(F.coalesce(body, F.lit(""))) == "") & (F.length(attachment) >= least) & (key(title) != "") & F.contains(key(attachment), key(title))
    return F.struct(F.when(fits, attachment).otherwise(body).alias("body"), F.when(fits, "downloaded_doc").otherwise("webpage").alias("body_source"))


def fill_missing(df: DataFrame, columns: list[str], defaults: dict[str, str] | None = None) -> DataFrame:
    """df with missing values of columns (as `filled` has it) replaced by their default or '', and their names, in order, in missing_fields."""
    lost = {c: T.filled(F.col(c)) == "" for c in columns}
    traced = df.withColumn("missing_fields", F.array_compact(F.array(*(F.when(x, F.lit(c)) for c, x in lost.items()))))
    return traced.withColumns({c: F.when(x, (defaults or {}).get(c, "")).otherwise(F.col(c)) for c, x in lost.items()})


def cleaned_rows(records: DataFrame, required: list[str], text: str = "body_text", key: str = "dedup_key", order: str = "index_no") -> DataFrame:
    """Mapped records, cleaned, with `errors`: the names of required values that they lack, or null.

    Bodies are cleaned and sentences counted, dates and timeliness made normal, missing values filled and traced; the first
    row of each key stays.
    """
    body = T.clean_body(F.col(text), keep_lines=True)
    rows = records.withColumn(text, body).withColumn("n_sentences", F.size(T.sentences(F.col(text))))
    for c in ("publish_date", "effective_date"):
        if c in rows.columns:
            rows = rows.withColumn(c, T.date_normal(F.col(c)))
    rows = fill_missing(rows, [c for c, kind in rows.dtypes if kind == "string" and c != key])
    rows = keep_first(rows, [key], [order]).withColumn("content_hash", F.sha2(text, 256))
    lacking = F.array_intersect(F.array(*map(F.lit, required)), F.col("missing_fields"))
    return rows.withColumn("errors", F.when(F.size(lacking) > 0, F.array_join(lacking, ",")))


def cleaned(records: DataFrame, required: list[str], text: str = "body_text", key: str = "dedup_key", order: str = "index_no") -> tuple[DataFrame, DataFrame]:
    """(cleaned, quarantined) of mapped records: see `cleaned_rows`; rows without a required value go to quarantine."""
    rows = cleaned_rows(records, required, text, key, order)
    return rows.where("errors is null").drop("errors"), rows.where("errors is not null")


def written_back(rows: DataFrame, ledger: DataFrame, key: str, columns: list[str], at: str) -> DataFrame:
    """rows with the columns of the ledger's newest row of their key, where it has one; others stay."""
    last = ledger.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*(F.col(c).alias(f"_{c}") for c in columns)), at).alias("_l"))
    met = rows.join(last, F.col(key) == F.col("_k"), "left")
    return met.select(*(F.coalesce(F.col(f"_l._{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns))


def carried_forward(rows: DataFrame, previous: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """rows whose empty columns take the values of the same key in the previous snapshot."""
    old = previous.groupBy(F.col(key).alias("_k")).agg(*(F.max(F.nullif(F.col(c), F.lit(""))).alias(f"_{c}") for c in columns))
    met = rows.join(old, F.col(key) == F.col("_k"), "left")
    return met.select(*(F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}"), F.lit("")).alias(c) if c in columns else F.col(c) for c in rows.columns))


def file_name(index: Column, title: Column, date: Column, extension: Column, most: int = 120) -> Column:
    """A standard file name: number, title and date without characters that paths cannot have, cut to `most` characters."""
    safe = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"""[\\/:*?"<>|\s]+""", "_")
    stem = F.concat_ws("_", *(F.nullif(safe(c), F.lit("")) for c in (index, title, date)))
    return F.concat(F.left(stem, F.lit(most)), F.lit("."), F.lower(F.regexp_replace(extension, r"^\.", "")))


#: Fixed: what the name of a secret's field holds, in any case.
SECRET_NAMES = ["token", "secret", "password", "passwd", "api_key", "apikey", "dsn", "cookie", "authorization", "webhook", "credential"]
REDACTED = "***redacted***"


def scrubbed_json(payload: Column) -> Column:
    """JSON text with the values of fields whose names tell a secret replaced, however deep they stand, also inside lists.

    Text that is no JSON becomes null, as nobody can tell what it holds; null stays null.
    """

    def scrub(value: object) -> object:
        if isinstance(value, dict):
            return {k: REDACTED if any(n in k.lower() for n in SECRET_NAMES) else scrub(v) for k, v in value.items()}
        return [scrub(v) for v in value] if isinstance(value, list) else value

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(scrub(json.loads(text)), ensure_ascii=False)
        except (ValueError, RecursionError):
            return None

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return run(payload)


def without_secrets(payload: Column, names: str = "(?i)(token|secret|passw|api_?key|authorization|cookie)") -> Column:
    """A map without the entries whose names tell a secret."""
    return F.map_filter(payload, lambda k, _: ~k.rlike(names))


def alike_rows(rows: DataFrame, row: str, title: str, within: list[str]) -> DataFrame:
    """(a, b): rows (a < b) that agree in `within` and whose titles stand for one document: see `alike`.

    Different titles are compared once for each value of `within`, however many rows have them; rows are put in for titles
    that are alike.
    """
    named = rows.where(F.length(title) > 0).select(F.col(row).alias("_row"), F.col(title).alias("_title"), *within)
    once = named.select("_title", *within).distinct()
    met = once.withColumnRenamed("_title", "_a").join(once.withColumnRenamed("_title", "_b"), within).where(T.alike(F.col("_a"), F.col("_b")))
    a = named.select(F.col("_row").alias("a"), F.col("_title").alias("_a"), *within)
    b = named.select(F.col("_row").alias("b"), F.col("_title").alias("_b"), *within)
    return a.join(met, [*within, "_a"]).join(b, [*within, "_b"]).where("a < b").select("a", "b")
