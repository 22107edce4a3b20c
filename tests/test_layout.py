from __future__ import annotations

import random

from pyspark.sql import functions as F

from docloom.operators import layout as L
from docloom.operators import tables as T


def boxes_of_page(rnd, columns, title):
    """Boxes in their true order: a title over all columns, then column by column."""
    out, top = [], 40 if title else 0
    if title:
        out.append((0.0, 0.0, 100.0 * columns - 20, 20.0, "title"))
    for c in range(columns):
        y = float(top)
        for i in range(rnd.randint(3, 8)):
            h = rnd.choice([8.0, 9.0, 10.0])
            out.append((100.0 * c, y, rnd.choice([60.0, 80.0, 75.5]), h, f"c{c}l{i}"))
            y += h + 2
    return out


def test_columns_before_lines(spark):
    rnd = random.Random(1)
    pages = {p: boxes_of_page(rnd, 1 + p % 3, p % 2 == 0) for p in range(24)}
    rows = [(p, *b) for p, bs in pages.items() for b in bs]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "page long, x double, y double, w double, h double, text string")
    got = {}
    for r in L.reading_order(df, "page").orderBy("page", "n").collect():
        got.setdefault(r.page, []).append(r.text)
    assert got == {p: [b[-1] for b in bs] for p, bs in pages.items()}


def test_boxes_without_a_place_and_cut_words(spark):
    rows = [(1, 0.0, 20.0, 50.0, 9.0, "mation here"), (1, 0.0, 0.0, 50.0, 9.0, "infor-"), (1, None, 1.0, 1.0, 1.0, "lost"), (2, 0.0, 0.0, 1.0, 1.0, None), (2, 0.0, 5.0, 1.0, 1.0, "A-"), (2, 0.0, 9.0, 1.0, 1.0, "B")]
    ordered = L.reading_order(spark.createDataFrame(rows, "page long, x double, y double, w double, h double, text string"), "page")
    assert {r.page: r.text for r in L.page_texts(ordered, "page").collect()} == {1: "information here\nlost", 2: "A-\nB"}
    assert L.reading_order(ordered.drop("n").limit(0), "page").count() == 0


def test_reflow(spark):
    texts = [
        ("工作职责、增员入司、营\n销组织架构。\n第一条 适用。\n第二条 指符合条件获得\n《执业证书》的人员", "工作职责、增员入司、营销组织架构。\n\n第一条 适用。\n\n第二条 指符合条件获得《执业证书》的人员"),
        ("one two\nthree\n\nfour：）\nfive", "one two three\n\nfour：）\n\nfive"), (" a \n，b\nLHQ-D-1\nc", "a，b\n\nLHQ-D-1 c"), (None, ""), ("\n \n", ""), ("序号 名称\n1", "序号 名称1"),
    ]
    got = [r[0] for r in spark.createDataFrame([(t, i) for i, (t, _) in enumerate(texts)], "t string, i int").orderBy("i").select(L.reflowed(F.col("t"))).collect()]
    assert got == [x for _, x in texts]


def sheet(rows):
    return [("s", r, c, v) for r, row in enumerate(rows) for c, v in enumerate(row)]


def test_blocks_of_a_sheet(spark):
    grid = [["附件一 某某明细表格"], [""], ["序号", "名称", "金额", "", "", "备注", "说明"], ["1", "甲", "3.5", "", "", "x", "y"], ["", "", "", "", "", "", ""], ["2", "乙", "4", "", "", "", ""], [""], [""], [""], ["", "另表"]]
    df = spark.createDataFrame(sheet(grid) + [("t", 0, 0, " "), ("t", 1, 0, None)], "sheet string, row int, col int, value string")
    found = T.blocks(df)
    assert [tuple(r) for r in found.orderBy("block").collect()] == [("s", 0, 0, 5, 0, 2, 10), ("s", 1, 2, 3, 5, 6, 4), ("s", 2, 9, 9, 1, 1, 1)]
    cells = T.in_blocks(df, found)
    assert {tuple(r)[1:] for r in T.header_rows(cells).collect()} == {(0, 2, 1), (1, 0, 2), (2, 0, 1)}


def test_blocks_against_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for s in range(12):
        full_rows, full_cols = sorted(rnd.sample(range(30), 8)), sorted(rnd.sample(range(20), 6))
        rows += [(str(s), r, c, "v") for r in full_rows for c in full_cols if rnd.random() < 0.7]

    def runs(values):
        out = []
        for v in sorted(set(values)):
            if out and v - out[-1][-1] - 1 <= 1:
                out[-1].append(v)
            else:
                out.append([v])
        return out

    want = set()
    for s in {r[0] for r in rows}:
        n = 0
        for down in runs([r for x, r, _, _ in rows if x == s]):
            inside = [(r, c) for x, r, c, _ in rows if x == s and r in down]
            for across in runs([c for _, c in inside]):
                own = [(r, c) for r, c in inside if c in across]
                want.add((s, n, min(r for r, _ in own), max(r for r, _ in own), min(c for _, c in own), max(c for _, c in own), len(own)))
                n += 1
    assert {tuple(r) for r in T.blocks(spark.createDataFrame(rows, "sheet string, row int, col int, value string")).collect()} == want


def test_merged_ranges_and_repeated_heads(spark):
    grid = [["类别", "", "金额"], ["", "一季", "二季"], ["甲", "1", "2"], ["类别", "一季", "二季"], ["3", "一季", "二季"], ["乙", "", ""]]
    df = spark.createDataFrame(sheet(grid), "sheet string, row int, col int, value string")
    merged = spark.createDataFrame([("s", 0, 0, 1, 0), ("s", 0, 2, 0, 4), ("s", 5, 1, 5, 2)], "sheet string, r1 int, c1 int, r2 int, c2 int")
    filled = {(r.row, r.col): r.value for r in T.merged_filled(df, merged).collect()}
    assert filled[1, 0] == "类别" and filled[0, 3] == filled[0, 4] == "金额" and filled[5, 1] == "" and len(filled) == 20
    cells = T.in_blocks(T.merged_filled(df, merged).where("col < 3"), T.blocks(df))
    heads = T.header_rows(cells)
    assert [tuple(r)[2:] for r in heads.collect()] == [(0, 2)]
    assert sorted({r.row for r in T.without_repeated_headers(cells, heads).collect()}) == [0, 1, 2, 4, 5]
