"""Secrets in texts: candidate strings, judged by a random forest trained from labelled findings."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

_KEY = "A-Za-z0-9+/_\\-"
#: A candidate is a run of at least 16 such characters, with what belongs to it: further runs of 16 after dots (JSON web
#: tokens) and filling at the end; or a run of 8 to 15 with letters and digits in it. All else is a border: = : . , quotes, @.
CANDIDATE = f"(?<![{_KEY}])(?:[{_KEY}]{{16,}}+(?:\\.[{_KEY}]{{16,}}+)*+={{0,2}}+|(?=[{_KEY}]*[0-9])(?=[{_KEY}]*[A-Za-z])[{_KEY}]{{8,15}}+(?![{_KEY}]))"
#: Characters of context on either side, and neighbouring words that are looked at.
CONTEXT, NEIGHBOURS = 48, 5
#: A word is in the dictionary if so many different texts have it.
MIN_TEXTS = 5
#: Words from which labelled findings of ordinary words are made; findings that are made; words and path parts whose
#: weight is learnt; trees of the forest.
N_WORDS, N_LABELLED, N_LEARNT, N_TREES, DEPTH = 500, 12_000, 300, 30, 9
SECRET_FROM = 0.5
FEATURES = ["length", "runs", "digits", "capitals", "marks", "different", "vowels", "transitions", "hex", "coverage", "assigned", "quoted", "login", "neighbours", "path_parts"]
MASK = "<secret>"
#: Kinds of characters that transitions are counted between: the letters in lower case, digits, all else.
_KINDS = 28


def candidates(docs: DataFrame, keep: list[str], text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """keep + (start, token, before, after, path): each candidate of every whole text, with its context; start in characters, from 0."""
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = docs.where(F.col(text_col).rlike(CANDIDATE)).select(*keep, path.alias("path"), F.col(text_col).alias("_text"))
    # Each text is split once, in the expression that is exploded; only the ends of what lies between candidates go on.
    gaps = F.transform(F.split("_text", CANDIDATE), lambda g: F.struct(F.length(g).alias("n"), F.left(g, F.lit(CONTEXT)).alias("head"), F.right(g, F.lit(CONTEXT)).alias("tail")))
    zipped = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all("_text", F.lit(CANDIDATE), 0).alias("token"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id()).select(*keep, "path", "_row", F.posexplode(zipped).alias("_pos", "_x"))
    order = Window.partitionBy("_row").orderBy("_pos")
    end = F.sum(F.col("_x.gap.n") + F.coalesce(F.length("_x.token"), F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    before = F.right(F.concat(F.coalesce(F.right(F.lag("_x.token").over(order), F.lit(CONTEXT)), F.lit("")), F.col("_x.gap.tail")), F.lit(CONTEXT))
    rows = rows.select(*keep, (end - F.length("_x.token")).alias("start"), F.col("_x.token").alias("token"), before.alias("before"), F.lead("_x.gap.head").over(order).alias("after"), "path")
    return rows.where("token is not null")


def dictionary(docs: DataFrame, text_col: str = "text", min_texts: int = MIN_TEXTS) -> DataFrame:
    """(word, n): runs of 3 to 24 letters that at least min_texts rows have, in lower case; counted over all rows."""
    words = F.array_distinct(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+"))
    rows = docs.select(F.explode(words).alias("word")).where(F.length("word").between(3, 24))
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_texts)


def transitions(words: DataFrame) -> list[float]:
    """Log probability of each kind of character after each other one, over all words of the dictionary as often as texts have them."""
    letters = F.split("word", "")
    kinds = F.transform(letters, _kind)
    pairs = F.transform(F.sequence(F.lit(0), F.size(kinds) - 2), lambda i: F.get(kinds, i) * _KINDS + F.get(kinds, i + 1))
    seen = words.where(F.length("word") > 1).select(F.explode(pairs).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = [1.0] * _KINDS**2
    for r in seen:
        counts[r["pair"]] += r["n"]
    return [math.log(c / sum(counts[i // _KINDS * _KINDS :][:_KINDS])) for i, c in enumerate(counts)]


def _kind(c: Column) -> Column:
    code = F.ascii(F.lower(c))
    return F.when(code.between(97, 122), code - 97).when(code.between(48, 57), 26).otherwise(27)


def neighbours(before: Column) -> Column:
    """The last words before a candidate, in lower case."""
    return F.slice(F.reverse(F.filter(F.split(F.lower(before), "[^a-z0-9]+"), lambda w: w != "")), 1, NEIGHBOURS)


def path_parts(path: Column) -> Column:
    return F.filter(F.split(F.lower(path), "[^a-z]+"), lambda w: w != "")


def weights(findings: DataFrame, parts: Column, most: int = N_LEARNT) -> Column:
    """A map from each word of `parts` to the logarithm of how much more often findings that are secrets have it than others."""
    n = findings.agg(F.coalesce(F.sum("label"), F.lit(0.0)).alias("yes"), F.count(F.lit(1)).alias("all")).first()
    words = findings.select("label", F.explode(F.array_distinct(parts)).alias("w")).groupBy("w").agg(F.sum("label").alias("yes"), F.count(F.lit(1)).alias("n"))
    odds = F.log((F.col("yes") + 1) / (n["yes"] + 2)) - F.log((F.col("n") - F.col("yes") + 1) / (n["all"] - n["yes"] + 2))
    found = words.withColumn("odds", odds).orderBy(F.desc(F.abs("odds") * F.col("n")), "w").limit(most).collect()
    return F.create_map(*(F.lit(x) for r in found for x in (r["w"], r["odds"]))) if found else F.create_map(F.lit(""), F.lit(0.0))


def with_features(found: DataFrame, words: DataFrame, logs: list[float], near: Column, paths: Column) -> DataFrame:
    """found with FEATURES. Letter runs of the tokens are looked up in the dictionary once each."""
    share = lambda pattern: F.regexp_count("token", F.lit(pattern)) / F.length("token")
    parts = F.filter(F.split(F.lower("token"), r"[^\p{L}]+"), lambda p: F.length(p) >= 3)
    tokens = found.select("token").distinct()
    pieces = tokens.select(F.col("token").alias("_token"), F.explode(parts).alias("_part"))
    known = pieces.join(words.select("word"), F.col("_part") == F.col("word"), "left_semi").groupBy("_token").agg(F.sum(F.length("_part")).alias("_known"))
    rows = found.join(known, F.col("token") == F.col("_token"), "left").withColumn("_kinds", F.transform(F.split("token", ""), _kind))
    before, after, kinds, table_ = F.col("before"), F.col("after"), F.col("_kinds"), F.array(*map(F.lit, logs))
    pairs = F.transform(F.sequence(F.lit(0), F.size(kinds) - 2), lambda i: F.get(table_, F.get(kinds, i) * _KINDS + F.get(kinds, i + 1)))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    weigh = lambda values, by: total(F.transform(values, lambda w: F.coalesce(F.try_element_at(by, w), F.lit(0.0))))
    columns = {
        "length": F.length("token"), "runs": share("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+"), "digits": share("[0-9]"), "capitals": share("[A-Z]"), "marks": share("[^A-Za-z0-9]"),
        "different": F.size(F.array_distinct(F.split("token", ""))) / F.length("token"), "vowels": share("[aeiouAEIOU]"), "transitions": total(pairs) / (F.length("token") - 1),
        "hex": F.col("token").rlike("^([0-9a-f]+|[0-9A-F]+)$"), "coverage": F.coalesce("_known", F.lit(0)) / F.length("token"),
        "login": before.rlike(r"://[^\s/@:]*:$") & after.rlike("^@"), "assigned": before.rlike(r"[=:@]\s*[\"']?$"), "quoted": before.rlike("[\"']$") & after.rlike("^[\"']"),
        "neighbours": weigh(neighbours(before), near), "path_parts": weigh(path_parts(F.col("path")), paths),
    }
    return rows.select(*found.columns, *(c.cast("double").alias(n) for n, c in columns.items()))


def labelled_findings(spark: SparkSession, words: list[str], n: int = N_LABELLED) -> DataFrame:
    """n findings (id, token, before, after, path, label), where no table of real ones is given; from hashes of their number.

    A finding has a form, a context and a path, drawn apart from each other; label tells what a reviewer would say.
    Forms: keys of known makes (AKIA, ghp_, sk_live_, xoxb-, JSON web tokens, PEM lines), random ones (hex, base 64, mixed,
    short), identifiers (uuid, digests, numbers, versions), words (joined by case, _, -, /), placeholders.
    Contexts: telling (secret = "..., Authorization: Bearer, the password of a URL of any scheme), naming (commit, checksum,
    uuid, the host, port and path of a URL), plain words. Known makes are secrets wherever they stand; random forms where something tells, and mixed or base-64 ones
    also among plain words; nothing else is. In paths of tests, examples and documentation fifteen of sixteen are not.
    """
    words = words or ["placeholder", "identifier", "configuration", "description"]
    sha = lambda salt: F.sha2(F.concat(F.col("id").cast("string"), F.lit(salt)).cast("binary"), 512)
    b64 = F.regexp_replace(F.base64(F.unhex(sha("b"))), "[\n\r=]", "")
    plain64 = F.regexp_replace(b64, "[^A-Za-z0-9]", "7")
    pick = lambda salt, options: F.element_at(F.array(*(o if isinstance(o, Column) else F.lit(o) for o in options)), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(options))) + 1).cast("int"))
    word = lambda salt: pick(salt, words)
    title = lambda salt: F.initcap(word(salt))
    cut_to = lambda text, low, high: F.substring(text, F.lit(1), (F.pmod(F.xxhash64("id", F.lit("n")), F.lit(high - low + 1)) + low).cast("int"))
    number = F.conv(F.substring(sha("d"), 1, 12), 16, 10)
    forms = {
        "make": [F.concat(F.lit("AKIA"), F.upper(F.substring(plain64, 1, 16))), F.concat(F.lit("ghp_"), F.substring(plain64, 1, 36)), F.concat(F.lit("sk_live_"), F.substring(plain64, 1, 24)), F.concat(F.lit("xoxb-"), F.substring(number, 1, 11), F.lit("-"), F.substring(plain64, 1, 24)),
                 F.concat(F.lit("eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9.eyJ"), F.substring(plain64, 1, 40), F.lit("."), F.substring(F.translate(b64, "+/", "-_"), 20, 43)), F.concat(F.lit("MIIE"), F.substring(b64, 1, 60))],
        "random": [F.substring(sha("h"), 1, 40), F.substring(sha("h"), 1, 32), F.substring(sha("h"), 1, 64), F.upper(F.substring(sha("h"), 1, 32)), cut_to(sha("h"), 20, 48)],
        "mixed": [F.substring(b64, 1, 40), F.concat(F.substring(b64, 1, 43), F.lit("=")), cut_to(F.translate(b64, "+/", "-_"), 16, 40), cut_to(plain64, 16, 24), F.substring(b64, 1, 64)],
        "short": [cut_to(plain64, 8, 15), cut_to(F.translate(b64, "+/", "-_"), 10, 15), F.concat(title("s"), F.substring(number, 1, 3), F.substring(plain64, 1, 3)), F.concat(word("s"), F.substring(number, 1, 1), F.substring(F.lower(plain64), 1, 3))],
        "identifier": [F.concat_ws("-", F.substring(sha("u"), 1, 8), F.substring(sha("u"), 9, 4), F.substring(sha("u"), 13, 4), F.substring(sha("u"), 17, 4), F.substring(sha("u"), 21, 12)), F.rpad(number, 16, "0"), F.concat(F.lit("2024"), F.substring(number, 1, 4), F.lit("T"), F.substring(number, 3, 6), F.lit("Z")), F.concat(F.lit("v1-2-"), F.substring(number, 1, 4), F.lit("-beta")), F.concat(word("x"), F.substring(number, 1, 4))],
        "words": [F.concat(word("a"), word("b"), word("c"), word("d"), word("e")), F.concat(word("a"), title("b"), title("c"), title("d")), F.concat_ws("_", word("a"), word("b"), word("c"), word("d"), word("e")), F.concat_ws("/", word("a"), word("b"), word("c"), word("d"), word("e")), F.concat_ws("-", word("a"), word("b"), word("c"), word("d"), F.lit("2024")), F.concat(word("a"), F.substring(number, 1, 2), word("b"), F.substring(number, 3, 1))],
        "placeholder": [F.rpad(F.lit("x"), 24, "x"), F.rpad(F.lit("-"), 30, "-"), F.concat(F.lit("YOUR_"), F.upper(word("a")), F.lit("_KEY_HERE")), F.concat(F.lit("EXAMPLE-"), F.upper(word("a")), F.upper(word("b")), F.upper(word("c"))), F.lit("changeme12345678"), F.lit("00000000000000000000000000000000"), F.lit("abcdefghijklmnopqrstuvwxyz")],
    }
    telling = F.concat(word("g"), F.lit(" "), pick("t", ["token", "api_key", "apikey", "secret", "client_secret", "password", "passwd", "auth_token", "Authorization: Bearer", "access key", "AWS key", "private_key", "credential", "pwd", "db_password"]), pick("s", [" = \"", "=", ": ", ": '", " = ", "\": \"", " "]))
    scheme = pick("q", ["postgres://", "https://", "http://", "mysql://", "redis://", "amqp://", "mongodb://", "ftp://", "ssh://", "smtp://"])
    url = F.concat(scheme, word("g"), F.lit(":"))
    link = F.concat(scheme, word("g"), pick("dot", [".com/", ".org/", ".net/v1/", ":8080/", ".com:443/"]))
    pem = F.lit("-----BEGIN PRIVATE KEY-----\n")
    naming = F.concat(word("g"), pick("m", [" commit ", " sha1: ", " sha256=", " checksum=", " revision ", " digest: ", " md5=", " uuid ", " etag: \"", " id: ", " build ", " integrity=", " image "]))
    naming = F.when(F.pmod(F.xxhash64("id", F.lit("link")), F.lit(6)) == 0, link).otherwise(naming)
    among = F.concat(word("g"), F.lit(" "), word("i"), F.lit(" "))
    rows = spark.range(n).withColumn("form", pick("form", ["make", "random", "random", "mixed", "short", "identifier", "words", "placeholder"])).withColumn("where", pick("where", ["telling", "telling", "telling", "naming", "naming", "among"]))
    # Each form on its own, so that no row's plan holds them all.
    rows = reduce(DataFrame.union, (rows.where(F.col("form") == name).withColumn("token", pick("f", options)) for name, options in forms.items()))
    token = F.col("token")
    before = F.when(F.col("where") == "telling", F.when(token.rlike("^MII"), pem).otherwise(F.when(F.pmod(F.xxhash64("id", F.lit("url")), F.lit(8)) == 0, url).otherwise(telling))).when(F.col("where") == "naming", naming).otherwise(among)
    rows = rows.select("id", "form", "where", token.alias("token"), before.alias("before"), pick("p", ["src/main", "config", "deploy/prod", "tests/data", "docs", "examples", "", "", "", ""]).alias("path"))
    secret = (F.col("form") == "make") | (F.col("form").isin("random", "mixed", "short") & (F.col("where") == "telling")) | ((F.col("form") == "mixed") & (F.col("where") == "among"))
    tame = F.col("path").rlike("test|doc|example") & (F.pmod(F.xxhash64("id", F.lit("tame")), F.lit(16)) > 0)
    after = F.when(F.col("before").rlike("\"$"), "\" ").when(F.col("before").rlike("'$"), "' ").when(F.col("before").rlike("://[a-z]*:$"), F.concat(F.lit("@"), word("h"), pick("host", [" ", ".com/", ":5432/", ".org ", "/"]))).otherwise(" ")
    return rows.select("id", "token", "before", after.alias("after"), "path", (secret & ~tame).cast("double").alias("label")).where(F.col("token").rlike(f"^(?:{CANDIDATE})$"))


def train(findings: DataFrame) -> PipelineModel:
    """A random forest over FEATURES of labelled findings (bounded: N_LABELLED)."""
    forest = RandomForestClassifier(numTrees=N_TREES, maxDepth=DEPTH, seed=7, featuresCol="_v", labelCol="label")
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="_v"), forest]).fit(findings)


class Judge:
    """A forest with what its features need: dictionary, transitions, weights of neighbouring words and path parts."""

    def __init__(self, docs: DataFrame, labelled: DataFrame | None = None, text_col: str = "text"):
        self.words = cut(dictionary(docs, text_col))
        if labelled is None:
            most = [r["word"] for r in self.words.where(F.col("word").rlike("^[a-z]+$")).orderBy(F.desc("n"), "word").limit(N_WORDS).collect()]
            labelled = labelled_findings(docs.sparkSession, most)
        labelled = cut(labelled)
        self.logs = transitions(self.words)
        self.near, self.paths = weights(labelled, neighbours(F.col("before"))), weights(labelled, path_parts(F.col("path")))
        self.model = train(cut(self.features(labelled)))

    def features(self, found: DataFrame) -> DataFrame:
        return with_features(found, self.words, self.logs, self.near, self.paths)

    def scores(self, found: DataFrame) -> DataFrame:
        """found with the forest's probability `score` that it is a secret."""
        return self.model.transform(self.features(found)).select(*found.columns, vector_to_array("probability")[1].alias("score"))


def judged(docs: DataFrame, keep: list[str], text_col: str = "text", path_col: str | None = "source", labelled: DataFrame | None = None) -> DataFrame:
    """keep + (start, token, score): every candidate in docs and the forest's probability that it is a secret."""
    judge = Judge(docs, labelled, text_col)
    return judge.scores(cut(candidates(docs, keep, text_col, path_col))).select(*keep, "start", "token", "score")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate in every whole text: doc_id, start, length, sha256, score, is_secret.

    labelled: findings with token, before, after, path and label (1: a secret); by default made by rule (see
    `labelled_findings`). The forest sees length, runs of character classes, shares of digits, capitals, marks, vowels and
    different characters, how usual the transitions between characters are in the corpus's own words, dictionary coverage,
    and the weights that the findings give to path parts and neighbouring words. Runs under 8 characters, runs under 16
    without digits, and what / joins in a path are not told apart. Null and empty texts have no candidates; null paths count as empty;
    repeated rows give repeated findings; an empty table gives no rows. Secrets themselves are not returned, only digests.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (F.col(path_col) if path_col else F.lit("")).alias("source"))
    out = judged(named, ["doc_id"], labelled=labelled)
    return out.select("doc_id", F.col("start").cast("long").alias("start"), F.length("token").cast("long").alias("length"), F.sha2("token", 256).alias("sha256"), "score", (F.col("score") >= SECRET_FROM).alias("is_secret"))


def masked(docs: DataFrame, text_col: str = "text", path_col: str | None = "source", labelled: DataFrame | None = None) -> DataFrame:
    """docs with each secret in its text replaced by MASK; other texts, null ones too, and all columns, whatever their names, stay.

    A string is masked wherever it stands as a candidate in a text in which it was judged a secret at one place.
    """
    path = F.col(f"`{path_col}`").cast("string") if path_col else F.lit("")
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text.alias("text"), path.alias("path"), F.xxhash64(text).alias("i"), F.xxhash64(F.lit(1), text).alias("j"))
    found = judged(rows.select("text", "path", "i", "j"), ["i", "j"], "text", "path", labelled).where(F.col("score") >= SECRET_FROM)
    secret = cut(found.groupBy("i", "j").agg(F.collect_set("token").alias("secrets")))
    gaps, tokens = F.split("text", CANDIDATE), F.regexp_extract_all("text", F.lit(CANDIDATE), 0)
    parts = F.zip_with(gaps, tokens, lambda g, t: F.concat(g, F.when(t.isNull(), "").when(F.array_contains("secrets", t), MASK).otherwise(t)))
    new: Column = F.when(F.col("secrets").isNull(), F.col("text")).otherwise(F.array_join(parts, ""))
    return rows.join(secret, ["i", "j"], "left").select(*((new if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
