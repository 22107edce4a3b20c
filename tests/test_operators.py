"""Operators on small literal tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import clauses as C
from docloom.operators import governance as G
from docloom.operators import graph as GR
from docloom.operators import matching as M
from docloom.operators import records as R
from docloom.operators import relations as RE
from docloom.operators import windows as W
from docloom.sources import files as S


def value(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


def test_html(spark):
    html = "<script>x</script><p>One &amp; two</p><!-- no --><div> three<br>four</div>"
    assert value(spark, T.paragraphs, html) == ["One & two", "three", "four"]


def test_sentences(spark):
    assert value(spark, T.sentences, "One. 15 two! 好。\nthree") == ["One.", "15 two!", "好。", "three"]


def test_numerals(spark):
    cases = {"12": 12, "十": 10, "十二": 12, "二十": 20, "一百零三": 103, "二千三百四十五": 2345, "x": None}
    for text, number in cases.items():
        assert value(spark, C.numeral, text) == number


LAW = "总则说明\n第一章 总则\n第一条 为了规范。\n（一）甲\n（二）乙\n第二条 适用。\n第二章 附则\n第四条 施行。"


def test_articles(spark):
    docs = spark.createDataFrame([(1, LAW), (2, "一、甲\n二、乙\n三、丙"), (3, "plain words"), (4, ""), (5, None)], "doc_id long, text string")
    rows = C.articles(docs)
    got = [(r.number, r.chapter_mark, r.body) for r in rows.orderBy("article").collect()]
    assert got == [(1, "一", "为了规范。\n（一）甲\n（二）乙"), (2, "一", "适用。"), (4, "二", "施行。")]
    assert {(r.doc, r["mode"]) for r in C.structure(docs, rows).collect()} == {(1, "law"), (2, "outline"), (3, "plain"), (4, "empty"), (5, "empty")}
    assert C.check(rows).first()[1:] == (3, "PASSED_WITH_WARNINGS", "gap")
    assert [(r.number, r.text) for r in C.items(rows).orderBy("item").collect()] == [(1, "甲"), (2, "乙")]
    refs = spark.createDataFrame([(1, 2), (1, 3), (1, 9), (3, 1)], "doc long, number int")
    assert {(r.doc, r.number): r.state for r in C.target_check(refs, rows).collect()} == {(1, 2): "verified", (1, 3): "in_range_unmatched", (1, 9): "out_of_range", (3, 1): "no_table"}
    assert C.chunks(rows).select("chunk_id").distinct().count() == 3


def test_relations(spark):
    text = "根据《甲法》第三条、《乙法》，制定本办法。《丙办法》同时废止。《丁规定》不得废止。参见《戊》。"
    rows = RE.relations(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string"))
    got = {(r.kind, r.title, r.article, r.action) for r in rows.collect()}
    assert ("basis", "甲法", 3, "") in got and ("repeal", "丙办法", None, "同时废止") in got
    assert not {t for _, t, _, _ in got} & {"丁规定", "戊"}
    assert RE.statistics(rows).count() == 2


def test_tiers_leave_ambiguous_keys(spark):
    index = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], "ref long, name string, short string")
    refs = spark.createDataFrame([("a", "q"), ("z", "y"), ("z", "x")], "name string, short string")
    out = M.tiers(refs, "name", index, "ref", [("name", F.col("name"), F.col("name"), 1.0), ("short", F.col("short"), F.col("short"), 0.7)])
    assert [(r.target, r["method"], r.confidence) for r in out.orderBy("name", F.desc("short")).collect()] == [(1, "name", 1.0), (3, "short", 0.7), (None, "unresolved", 0.0)]


def test_contained_names_of_any_length(spark):
    texts = spark.createDataFrame([(1, "The Law of Big Numbers holds"), (2, "law"), (3, None)], "id long, text string")
    names = spark.createDataFrame([(1, "law of big numbers"), (2, "LAW"), (3, ""), (4, "aw of big numb")], "n long, name string")
    assert {tuple(r) for r in M.contained(texts, "id", "text", names, "n", "name").collect()} == {(1, 1), (1, 2), (2, 2), (1, 4)}


def test_survivorship(spark):
    rows = spark.createDataFrame([("k", 1, "valid", 1), ("k", 2, "valid", 1), ("k", 3, "void", 0), ("k", 4, "void", 3)], "k string, d int, s string, r int")
    assert R.survivorship(rows, ["k"], ["d"], "s", "r").first()[1:] == ("void", 3, 1, 2, 1, 1)


def test_snapshot_diff_and_digest(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, d string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "id long, d string")
    assert {tuple(r) for r in R.snapshot_diff(a, b, "id", "d").collect()} == {(1, "removed"), (2, "changed"), (3, "added")}
    assert R.table_digest(a, ["id", "d"]).first() == R.table_digest(a.orderBy(F.desc("id")), ["id", "d"]).first() != R.table_digest(b, ["id", "d"]).first()


def test_streak_and_upsert(spark):
    rows = spark.createDataFrame([(1, 1, "ok"), (1, 2, "bad"), (1, 3, "bad"), (2, 1, "bad"), (3, 1, "ok")], "u long, t long, s string")
    assert {tuple(r) for r in W.streak(rows, "u", ["t"], F.col("s") == "bad").collect()} == {(1, 2), (2, 1), (3, 0)}
    out = {r.u: (r.opened, r.seen, r.state) for r in G.upsert(rows, ["u"], "t", "s", ["ok"]).collect()}
    assert out == {1: (2, 2, "open"), 2: (1, 1, "open"), 3: (None, 0, "closed")}


def test_reach_is_safe_on_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "s long, d long")
    assert {tuple(r) for r in GR.reach(edges, "s", "d", [1], 6).collect()} == {(1, 0), (2, 1), (3, 2), (4, 3)}


def test_majority_abstains_on_ties(spark):
    votes = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "b")], "i long, c string")
    assert {tuple(r) for r in GR.majority(votes, "i", "c").collect()} == {(1, "a", 0.667, 3), (2, "uncertain", 0.0, 2)}


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, ["x"]), ("b", 2, [])], "k string, n long, tags array<string>")
    S.write_table(rows, str(tmp_path / "csv"))
    assert {(r.k, r.tags) for r in S.read_table(spark, str(tmp_path / "csv")).collect()} == {("a", '["x"]'), ("b", "[]")}
    (tmp_path / "r.jsonl").write_text('{"_meta": "m"}\n{"k": "a"}\nbroken\n')
    assert [r.k for r in S.read_records(spark, str(tmp_path / "r.jsonl"), "_meta string, k string, _broken string").where("_broken is null").collect()] == ["a"]
    S.write_records(rows, str(tmp_path / "p"), ["k"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert {r.k for r in S.append_new(rows, rows.union(spark.createDataFrame([("c", 3, ["y"])], rows.schema)), ["k"]).collect()} == {"c"}
    assert S.aliased(rows, {"key": ["k", "old"], "none": []}).first().key == "a"
    found = S.files(spark, str(tmp_path / "csv"))
    assert S.unseen(found, found).count() == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert C.articles(none).count() == 0 and RE.relations(none).count() == 0
    assert R.facets(none, ["doc_id"]).count() == 0 and R.content_duplicates(none, "text", "doc_id").count() == 0


def test_hubs_are_told_in_two_steps(spark):
    from docloom.operators import graph as G

    produced = spark.createDataFrame([(i, "hub") for i in range(6)] + [(1, "x"), (2, "y")], "node int, artifact string")
    used = spark.createDataFrame([(i, "hub") for i in range(4, 20)] + [(3, "x"), (4, "x"), (5, "none")], "node int, artifact string")
    pairs, steps = G.through_hubs(produced, used, "node", "artifact", 10)
    two = steps.where("role = 'producer'").join(steps.where("role = 'user'").withColumnRenamed("node", "to"), "artifact").where("node <> to").select("node", "to")
    whole = {(r.node, r.neighbour) for r in G.through(produced, used, "node", "artifact").collect()}
    assert {(r.node, r.neighbour) for r in pairs.collect()} == {(1, 3), (1, 4)} and {tuple(r) for r in two.collect()} | {(1, 3), (1, 4)} == whole and steps.count() == 22


def test_secrets_deep_in_json_and_rows_of_duplicate_keys(spark):
    from pyspark.sql import functions as F

    from docloom.operators import mapping as M
    from docloom.operators import records as R

    texts = ['{"a": [{"Api_Key": "x", "b": {"user_token": [1]}}, 2], "名": "值"}', "no json", None, "[]", '"token"']
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(M.scrubbed_json(F.col("t"))).collect()]
    assert got == ['{"a": [{"Api_Key": "***redacted***", "b": {"user_token": "***redacted***"}}, 2], "名": "值"}', None, None, "[]", '"token"']
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, id int")
    assert sorted(map(tuple, R.duplicate_rows(rows, ["k"], "id").collect())) == [("a", 2, 1), ("a", 2, 2)]


def test_names_by_words_and_by_automaton_agree(spark, monkeypatch):
    from docloom.operators import matching as M

    texts = spark.createDataFrame([(1, "The quick brown fox jumps"), (2, "a b c quick"), (3, None), (4, "xquick brown foxy")], "id int, text string")
    names = spark.createDataFrame([(1, "quick brown fox"), (2, "quick"), (3, "b c"), (4, "uick brown fo"), (5, ""), (6, "ox"), (7, None), (8, "c")], "n int, name string")
    whole = {tuple(r) for r in M.contained(texts, "id", "text", names, "n", "name").collect()}
    monkeypatch.setattr(M, "PART", 2)
    assert {tuple(r) for r in M.contained(texts, "id", "text", names, "n", "name").collect()} == whole == {(1, 1), (1, 2), (1, 4), (1, 6), (1, 8), (2, 2), (2, 3), (2, 8), (4, 1), (4, 2), (4, 4), (4, 6), (4, 8)}
