"""Spreadsheet cells as rows (sheet, row, col, value): headers, dimensions, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMBER = r"^\s*[-+]?[0-9][0-9,]*(\.[0-9]+)?%?\s*$"


def cells(matrices: DataFrame, sheet: str = "sheet", row: str = "row", values: str = "cells") -> DataFrame:
    """Cells of rows of arrays, made rectangular: short rows get empty cells up to the sheet's widest row."""
    wide = matrices.groupBy(F.col(sheet).alias("_s")).agg(F.max(F.size(values)).alias("_w"))
    rows = matrices.join(wide, F.col(sheet).eqNullSafe(F.col("_s")))
    padded = F.transform(F.sequence(F.lit(0), F.greatest(F.col("_w") - 1, F.lit(0))), lambda i: F.coalesce(F.get(values, i), F.lit("")))
    return rows.where("_w > 0").select(F.col(sheet).alias("sheet"), F.col(row).alias("row"), F.posexplode(padded).alias("col", "value")).withColumn("value", F.trim("value"))


def fill_headers(found: DataFrame, n_header: int) -> DataFrame:
    """(sheet, col, header): the header rows' cells of each column, empty ones filled from the left, different ones joined."""
    head = found.where(F.col("row") < n_header).withColumn("_v", F.when(F.col("value") != "", F.col("value")))
    left = Window.partitionBy("sheet", "row").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    head = head.withColumn("_f", F.last("_v", ignorenulls=True).over(left))
    chain = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("row", "_f"))), lambda x: x["_f"]))
    return head.groupBy("sheet", "col").agg(F.array_join(F.filter(chain, lambda x: x.isNotNull()), "/").alias("header"))


def fill_down(found: DataFrame, columns: list[int]) -> DataFrame:
    """Empty cells of the given columns filled from above."""
    value = F.when(F.col("value") != "", F.col("value"))
    above = F.last(value, ignorenulls=True).over(Window.partitionBy("sheet", "col").orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    return found.withColumn("value", F.when(F.col("col").isin(columns), F.coalesce(above, F.lit(""))).otherwise(F.col("value")))


def dimensions(found: DataFrame, filled: float = 0.5, numeric: float = 0.15, size: float = 30.0, most: int = 12) -> DataFrame:
    """(sheet, col): the leading columns that hold words: well filled, seldom numbers, short on average; `most` at most.

    Columns count from the left until the first that does not fit.
    """
    known = F.col("value") != ""
    profile = found.groupBy("sheet", "col").agg(
        F.avg(known.cast("double")).alias("_fill"), F.coalesce(F.avg(F.when(known, F.col("value").rlike(NUMBER).cast("double"))), F.lit(0.0)).alias("_num"), F.coalesce(F.avg(F.when(known, F.length("value"))), F.lit(0.0)).alias("_len")
    )
    bad = ~((F.col("_fill") >= filled) & (F.col("_num") <= numeric) & (F.col("_len") <= size))
    so_far = F.sum(bad.cast("int")).over(Window.partitionBy("sheet").orderBy("col"))
    return profile.withColumn("_bad", so_far).where((F.col("_bad") == 0) & (F.col("col") < most)).select("sheet", "col")


def dimension_hash(values: list[Column]) -> Column:
    """A digest of a row's dimension values, in order."""
    return F.sha2(F.to_json(F.array(*(F.coalesce(v.cast("string"), F.lit("")) for v in values))), 256)


def is_total(label: Column) -> Column:
    """Whether a row's first label marks a total."""
    return F.trim(label).rlike(r"(?i)^(合计|总计|小计|total|sum)\b|^(合计|总计|小计)")


def blocks(found: DataFrame, gap: int = 1) -> DataFrame:
    """(sheet, block, top, bottom, left, right, n): where the filled cells of a sheet lie, block by block from 0.

    Rows and columns without a filled cell part blocks: more than `gap` empty rows part a sheet, and then more than `gap`
    empty columns part what lies between; bounds are those of the filled cells, ends included. Only distinct rows and
    columns pass a task at once, no cells.
    """
    filled = found.where(F.trim(F.coalesce("value", F.lit(""))) != "")

    def numbered(keys: list[str], axis: str, name: str) -> DataFrame:
        lines = filled_.select(*keys, axis).distinct()
        over = Window.partitionBy(*keys).orderBy(axis)
        fresh = F.coalesce(F.col(axis) - F.lag(axis).over(over) - 1 > gap, F.lit(False)).cast("int")
        return lines.withColumn("_fresh", fresh).withColumn(name, F.sum("_fresh").over(over)).drop("_fresh")

    filled_ = filled
    down = filled.join(numbered(["sheet"], "row", "_down"), ["sheet", "row"])
    filled_ = down
    across = down.join(numbered(["sheet", "_down"], "col", "_across"), ["sheet", "_down", "col"])
    bounds = across.groupBy("sheet", "_down", "_across").agg(F.min("row").alias("top"), F.max("row").alias("bottom"), F.min("col").alias("left"), F.max("col").alias("right"), F.count(F.lit(1)).alias("n"))
    block = F.row_number().over(Window.partitionBy("sheet").orderBy("_down", "_across")) - 1
    return bounds.withColumn("block", block.cast("int")).select("sheet", "block", "top", "bottom", "left", "right", "n")


def in_blocks(found: DataFrame, of: DataFrame) -> DataFrame:
    """Cells of found with the block of `blocks` that they lie in, rows and columns counted from the block's corner."""
    met = found.join(of.select(F.col("sheet").alias("_s"), "block", "top", "bottom", "left", "right"), F.col("sheet").eqNullSafe(F.col("_s")))
    inside = met.where(F.col("row").between(F.col("top"), F.col("bottom")) & F.col("col").between(F.col("left"), F.col("right")))
    return inside.select("sheet", "block", (F.col("row") - F.col("top")).alias("row"), (F.col("col") - F.col("left")).alias("col"), "value")


def merged_filled(found: DataFrame, merged: DataFrame) -> DataFrame:
    """Cells with the values of merged ranges (sheet, r1, c1, r2, c2, ends included) in all their empty cells; missing cells
    of a range are added."""
    m = merged.select(F.col("sheet").alias("_s"), "r1", "c1", "r2", "c2")
    corner = m.join(found, (F.col("sheet") == F.col("_s")) & (F.col("row") == F.col("r1")) & (F.col("col") == F.col("c1"))).where(F.trim(F.coalesce("value", F.lit(""))) != "")
    spread = corner.select("sheet", F.explode(F.sequence("r1", "r2")).alias("row"), "c1", "c2", "value").select("sheet", "row", F.explode(F.sequence("c1", "c2")).alias("col"), F.col("value").alias("_fill"))
    once = spread.groupBy("sheet", "row", "col").agg(F.min("_fill").alias("_fill"))
    both = found.select("sheet", "row", "col", "value").join(once, ["sheet", "row", "col"], "full")
    return both.select("sheet", "row", "col", F.when(F.trim(F.coalesce("value", F.lit(""))) != "", F.col("value")).otherwise(F.coalesce("_fill", F.lit(""))).alias("value"))


#: Fixed: words that heads of columns are told by.
HEAD_WORDS = ["序号", "项目", "名称", "指标", "单位", "数量", "金额", "备注", "代码", "类别", "说明", "年度", "日期", "编号"]


def header_rows(found: DataFrame, most: int = 4, scan: int = 6, first: float = 0.4, further: float = 0.25) -> DataFrame:
    """(sheet, block, n_skipped, n_header) of cells (sheet, block, row, col, value): rows before the head, and rows of it.

    A row's score is half the share of its filled cells that are words, and half the share of those with a HEAD_WORD. The
    head begins at the first of `scan` rows that scores `first` and is no lone title, and goes on, `most` rows in all, while
    rows score `further`, are no lone title and do not look like data (a number or code first, two numbers, or a code of
    three digits). A block without such a row has its first row as head.
    """
    value, filled = F.trim("value"), F.trim(F.coalesce("value", F.lit(""))) != ""
    word, hit = ~value.rlike(NUMBER), value.rlike("|".join(HEAD_WORDS))
    lead = F.min_by(F.when(filled, value), F.when(filled, F.col("col")))
    rows = found.where(F.col("row") < scan + most).groupBy("sheet", "block", "row").agg(
        F.sum(filled.cast("int")).alias("n"), F.sum((filled & word).cast("int")).alias("words"), F.sum((filled & hit).cast("int")).alias("hits"), lead.alias("lead"),
        F.sum((filled & ~word).cast("int")).alias("numbers"), F.count_if(filled & value.rlike(r"^\d{3,}$")).alias("codes"),
    )
    score = F.when(F.col("n") > 0, 0.5 * F.col("words") / F.col("n") + 0.5 * F.col("hits") / F.col("n")).otherwise(0.0)
    title = (F.col("n") == 1) & (F.length("lead") >= 6)
    code = F.col("lead").rlike(r"^\d+([-.]\d+)*$")
    data = (F.col("n") >= 2) & (code | (F.col("numbers") >= 2) | (F.col("codes") - F.col("lead").rlike(r"^\d{3,}$").cast("int") > 0))
    told = rows.select("sheet", "block", "row", ((score >= first) & ~(title & (F.col("hits") == 0)) & (F.col("row") < scan)).alias("opens"), ((score >= further) & ~title & ~data).alias("goes_on"))
    opened = told.groupBy("sheet", "block").agg(F.coalesce(F.min(F.when(F.col("opens"), F.col("row"))), F.lit(0)).alias("n_skipped"))
    later = told.join(opened, ["sheet", "block"]).where(F.col("row") > F.col("n_skipped"))
    ended = later.where(~F.col("goes_on")).groupBy("sheet", "block").agg(F.min("row").alias("_end"))
    last = told.groupBy("sheet", "block").agg((F.max("row") + 1).alias("_last"))
    met = opened.join(last, ["sheet", "block"]).join(ended, ["sheet", "block"], "left")
    end = F.least(F.coalesce("_end", "_last"), F.col("n_skipped") + most)
    return met.select("sheet", "block", F.col("n_skipped").cast("int").alias("n_skipped"), (end - F.col("n_skipped")).cast("int").alias("n_header"))


def without_repeated_headers(found: DataFrame, heads: DataFrame, share: float = 0.7) -> DataFrame:
    """Cells without the rows below a head that repeat its last row: at least `share` of the shorter one's cells agree.

    heads: (sheet, block, n_skipped, n_header). A row that begins with a digit is data, and stays.
    """
    met = found.join(heads, ["sheet", "block"])
    head = met.where(F.col("row") == F.col("n_skipped") + F.col("n_header") - 1).select("sheet", "block", "col", F.trim("value").alias("_head"))
    below = met.where(F.col("row") >= F.col("n_skipped") + F.col("n_header"))
    both = below.join(head, ["sheet", "block", "col"], "left")
    size = head.groupBy("sheet", "block").agg(F.count(F.lit(1)).alias("_size"))
    like = both.groupBy("sheet", "block", "row").agg(F.sum((F.trim("value") == F.col("_head")).cast("int")).alias("_same"), F.count(F.lit(1)).alias("_n"), F.min_by(F.trim("value"), "col").alias("_lead"))
    again = like.join(size, ["sheet", "block"]).where((F.col("_lead") != "") & ~F.col("_lead").rlike(r"^\d") & (F.col("_same") / F.greatest(F.least("_n", "_size"), F.lit(1)) >= share))
    return found.join(again.select("sheet", "block", "row"), ["sheet", "block", "row"], "left_anti")
