"""Reading order of boxes on pages, and paragraphs out of lines that were broken at the margin."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import bound

#: Fixed: marks that end a paragraph at the end of a line, and closing marks after which the mark before counts.
STOPS, CLOSES = "。！？…；：", "”』」）》"
#: Fixed: lines that stand alone: heads of chapters and articles, appendices; heads of tables; numbers of documents.
STANDING = [
    r"^\s*(第\s*[0-9０-９一二三四五六七八九十百千两]+\s*[章节条]|附件|附表|附录|附\s*则|目\s*录|目\s*次)",
    r"^\s*(序号|编号|项目|名称|内容|备注|金额|说明)[\s　]", r"^\s*[A-Za-z]{1,10}[-—][0-9A-Za-z\-]+\s*$",
]


def reflowed(text: Column) -> Column:
    """Text whose lines, broken at the margin, are joined to paragraphs, one empty line between two.

    An empty line, a line of STANDING, and a line after one that ends with a stop (a closing mark aside) begin a paragraph;
    other lines are joined to the one before, with a blank between two Latin letters or digits. null gives ''.
    """
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.regexp_replace(_joined(lines), r"(?U)^\s+|\s+$", "")


@bound
def _joined(lines: Column) -> Column:
    def piece(line: Column, i: Column) -> Column:
        before = F.coalesce(F.get(lines, i - 1), F.lit(""))
        opens = (before == "") | before.rlike(f"[{STOPS}]$|[{STOPS}]\\s*[{CLOSES}]$") | line.rlike("|".join(f"(?:{p})" for p in STANDING))
        stands = before.rlike("[A-Za-z0-9]$") & line.rlike("^[A-Za-z0-9]")
        return F.when(line == "", "").when(opens, F.concat(F.lit("\n\n"), line)).when(stands, F.concat(F.lit(" "), line)).otherwise(line)

    return F.array_join(F.transform(lines, piece), "")


def widest_gap(low: np.ndarray, high: np.ndarray) -> tuple[float, float]:
    """(width, middle) of the widest stretch between intervals that none of them covers; width 0 if there is none."""
    order = np.argsort(low, kind="stable")
    reach = np.maximum.accumulate(high[order])[:-1]
    gaps = low[order][1:] - reach
    if not len(gaps) or gaps.max() <= 0:
        return 0.0, 0.0
    at = int(gaps.argmax())
    return float(gaps[at]), float(reach[at] + gaps[at] / 2)


def cut_order(x: np.ndarray, y: np.ndarray, w: np.ndarray, h: np.ndarray, column_gap: float) -> list[int]:
    """Boxes in reading order: cut at the widest upright gap of column_gap or more, else at the widest level gap, and so on
    in both halves, left before right and upper before lower; what no gap parts goes by top and left edge."""
    out: list[int] = []
    todo = [np.arange(len(x))]
    while todo:
        own = todo.pop()
        upright, at_x = widest_gap(x[own], x[own] + w[own])
        level, at_y = widest_gap(y[own], y[own] + h[own])
        if len(own) > 1 and upright >= column_gap:
            left = x[own] + w[own] / 2 < at_x
            todo += [own[~left], own[left]]
        elif len(own) > 1 and level > 0:
            upper = y[own] + h[own] / 2 < at_y
            todo += [own[~upper], own[upper]]
        else:
            out += own[np.lexsort((x[own], y[own]))].tolist()
    return out


def reading_order(boxes: DataFrame, page: str, column_gap: float = 10.0) -> DataFrame:
    """boxes (page, x, y, w, h, text; y grows downwards) with `n`, each page's place in reading order from 0.

    A page's boxes meet in one task. Boxes without a place or size come last, repeated boxes keep their own numbers.
    """

    def run(found: pa.Table) -> pa.Table:
        x, y, w, h = (found.column(c).to_numpy().astype(float) for c in ("x", "y", "w", "h"))
        known = np.flatnonzero(np.isfinite(x) & np.isfinite(y) & np.isfinite(w) & np.isfinite(h))
        order = known[np.array(cut_order(x[known], y[known], w[known], h[known], column_gap), np.int64)]
        order = np.r_[order, np.setdiff1d(np.arange(len(x)), known)].astype(np.int64)
        return found.take(pa.array(order)).append_column("n", pa.array(np.arange(len(order), dtype=np.int64)))

    fields = ", ".join(f"`{c}` {t}" for c, t in boxes.dtypes)
    return boxes.groupBy(page).applyInArrow(run, f"{fields}, n long")


def page_texts(ordered: DataFrame, page: str, text: str = "text") -> DataFrame:
    """(page, text): boxes of `reading_order` as lines; a word cut by a hyphen at a line's end is joined with its rest."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("n", F.col(text).alias("t")))), lambda b: b["t"])
    joined = F.regexp_replace(F.array_join(lines, "\n"), r"(?<=\p{L})-\n(?=\p{Ll})", "")
    return ordered.where(F.col(text).isNotNull()).groupBy(page).agg(joined.alias("text"))
