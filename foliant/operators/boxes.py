"""Boxes of recognised text: extents, copies, reading order, rows and columns, tables.

Relations of boxes are columns; the two clusterings whose result depends on the order of the boxes (a box joins the
first group whose running mean is near) run per page in Arrow batches. A page's boxes fit a task; pages don't share.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliant.functions.plain import composed, plain_line
from foliant.functions.text import clean_line


def extent(points: Column) -> Column:
    """STRUCT left, top, right, bottom, center_y, height (1 at least) of ARRAY<STRUCT<x, y>>."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    top, bottom = F.array_min(ys), F.array_max(ys)
    return F.struct(F.array_min(xs).alias("left"), top.alias("top"), F.array_max(xs).alias("right"), bottom.alias("bottom"), ((top + bottom) / 2).alias("center_y"), F.greatest(F.lit(1.0), bottom - top).alias("height"))


def measured(boxes: DataFrame) -> DataFrame:
    """Adds ``x_center, y_center, height, width`` to boxes with x0, y0, x1, y1, whichever corner comes first."""
    x, y = (F.least("x0", "x1"), F.greatest("x0", "x1")), (F.least("y0", "y1"), F.greatest("y0", "y1"))
    return boxes.withColumns({"x_center": (x[0] + x[1]) / 2, "y_center": (y[0] + y[1]) / 2, "height": F.greatest(F.lit(1.0), y[1] - y[0]), "width": F.greatest(F.lit(1.0), x[1] - x[0])})


def overlap(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Do two boxes overlap? Touching ones do."""
    return ~((a["x1"] < b["x0"]) | (b["x1"] < a["x0"]) | (a["y1"] < b["y0"]) | (b["y1"] < a["y0"]))


def outside(blocks: DataFrame, areas: DataFrame, page: list[str]) -> DataFrame:
    """The blocks that overlap none of the areas of their page: an anti join on the page with the overlap behind."""
    corners = ["x0", "y0", "x1", "y1"]
    other = areas.select(*(F.col(k).alias(f"_{k}") for k in page), *(F.col(c).alias(f"_{c}") for c in corners))
    same = F.lit(True)
    for k in page:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return blocks.join(other, same & overlap({c: F.col(c) for c in corners}, {c: F.col(f"_{c}") for c in corners}), "left_anti")


def distinct_boxes(boxes: DataFrame, page: list[str], order: str) -> DataFrame:
    """Of the boxes of a page with equal rounded corners (half to even) the first."""
    corners = {f"_{c}": F.bround(c, 0) for c in ("x0", "y0", "x1", "y1")}
    rest = [c for c in boxes.columns if c not in page]
    firsts = boxes.withColumns(corners).groupBy(*page, *corners).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    return firsts.select(*page, *(F.col(f"_r.`{c}`").alias(c) for c in rest)).select(*boxes.columns)


def readable(boxes: DataFrame, text: str = "box_text", confidence: str = "conf", least: float | None = None) -> DataFrame:
    """Boxes with text, and with at least that confidence; an unknown confidence passes."""
    kept = boxes.where(clean_line(F.col(text)) != "")
    return kept if least is None else kept.where(F.col(confidence).isNull() | (F.col(confidence) >= least))


def page_heights(boxes: DataFrame, page: list[str]) -> DataFrame:
    """``page, row_gap, line_gap``: how far boxes of a row (of a line) may be apart, from the heights of a page."""
    return measured(boxes).groupBy(*page).agg(
        F.greatest(F.lit(12.0), F.avg("height") * 0.8).alias("row_gap"),
        F.greatest(F.lit(8.0), F.element_at(F.array_sort(F.collect_list("height")), (F.floor(F.count("*") / 2) + 1).cast("int")) * 0.65).alias("line_gap"),
    )


def nearest_column(x: Column, centers: Column) -> Column:
    """The index (from 0) of the nearest centre, of equals the first; 0 without centres."""
    at = F.transform(centers, lambda c, i: F.struct(F.abs(x - c).alias("d"), i.alias("i")))
    return F.coalesce(F.array_min(at)["i"], F.lit(0))


def _first_fit(values: list[float], gap: float) -> list[int]:
    """The group of each value: the first whose mean, of the members so far, is within ``gap``."""
    sums: list[float] = []
    sizes: list[int] = []
    out = []
    for v in values:
        for g, (s, n) in enumerate(zip(sums, sizes, strict=True)):
            if abs(v - s / n) <= gap:
                break
        else:
            g = len(sums)
            sums.append(0.0)
            sizes.append(0)
        sums[g] += v
        sizes[g] += 1
        out.append(g)
    return out


def _centers(xs: list[float], gap: float) -> list[float]:
    xs = sorted(xs)
    groups: dict[int, list[float]] = {}
    for x, g in zip(xs, _first_fit(xs, gap), strict=True):
        groups.setdefault(g, []).append(x)
    return sorted(sum(v) / len(v) for v in groups.values())


Box = dict  # box_no, left, top, x_center, y_center, height, text, conf


def _rows(page: list[Box]) -> list[list[Box]]:
    page = sorted(page, key=lambda b: (b["y_center"], b["box_no"]))
    gap = max(12.0, sum(b["height"] for b in page) / len(page) * 0.8)
    rows: dict[int, list[Box]] = {}
    for b, g in zip(page, _first_fit([b["y_center"] for b in page], gap), strict=True):
        rows.setdefault(g, []).append(b)
    return [sorted(r, key=lambda b: b["x_center"]) for _, r in sorted(rows.items())]


def _nearest(x: float, centers: list[float]) -> tuple[int, float]:
    near = [abs(x - c) for c in centers]
    return near.index(min(near)), min(near)


def grid_of(page: list[Box]) -> list[list[str]]:
    """Rows of cells of one page's boxes, or [] where they are no grid."""
    if len(page) < 4:
        return []
    rows = _rows(page)
    centers = _centers([b["x_center"] for r in rows for b in r], 50)
    if len(rows) < 2 or len(centers) < 2:
        return []
    out = []
    for r in rows:
        line = [""] * len(centers)
        for b in r:
            k, _ = _nearest(b["x_center"], centers)
            line[k] = f"{line[k]} {b['text']}".strip()
        out.append(line)
    return out


def is_grid(page: list[Box]) -> bool:
    """Do one page's boxes look like a table? Strict, so that running text isn't taken for one."""
    page = [b for b in page if b["conf"] is None or b["conf"] >= 0.25]
    if len(page) < 12:
        return False
    rows = _rows(page)
    several = [r for r in rows if len(r) >= 2]
    centers = _centers([b["x_center"] for r in several for b in r], 45)
    if len(several) < 4 or len(centers) < 2:
        return False
    good = sum(len({k for k, d in (_nearest(b["x_center"], centers) for b in r) if d <= 45}) >= 2 for r in several)
    return good >= 4 and good / len(rows) >= 0.45


def reading_order(page: list[Box]) -> list[tuple[int, Box]]:
    """(line, box) of one page's boxes in reading order: lines by their centre, then from the left."""
    heights = sorted(b["height"] for b in page)
    gap = max(8.0, heights[len(heights) // 2] * 0.65)
    page = sorted(page, key=lambda b: (b["top"], b["left"], b["box_no"]))
    lines = list(zip(_first_fit([b["y_center"] for b in page], gap), page, strict=True))
    return [(g + 1, b) for g, b in sorted(lines, key=lambda x: (x[0], x[1]["left"]))]


def _by_page(boxes: DataFrame, page: list[str]) -> DataFrame:
    """``page, boxes``: what the clusterings need of each page: boxes with corners and text, copies once."""
    have = boxes.dropna(subset=[*page, "x0", "y0", "x1", "y1"])
    m = measured(readable(distinct_boxes(have, page, "box_no")))
    box = F.struct("box_no", F.least("x0", "x1").alias("left"), F.least("y0", "y1").alias("top"), "x_center", "y_center", "height", clean_line(F.col("box_text")).alias("text"), "conf")
    return m.groupBy(*page).agg(F.collect_list(box).alias("boxes"))


def _each_page(boxes: DataFrame, page: list[str], fields: str, work: Callable[[list[Box]], list[tuple]]) -> DataFrame:
    """``page`` and ``fields`` of the rows that ``work`` makes of each page."""
    pages = _by_page(boxes, page)
    schema = T.StructType([*(pages.schema[k] for k in page), *T.StructType.fromDDL(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(len(page))), strict=True))
            rows = [(*k, *r) for k, b in zip(keys, batch.column(len(page)).to_pylist(), strict=True) for r in work(b)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
            kinds = to_arrow_schema(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds.field(i).type) for i, c in enumerate(columns)], schema=kinds)

    return pages.mapInArrow(run, schema)


def page_tables(boxes: DataFrame, page: list[str]) -> DataFrame:
    """``page, is_table, n_rows, n_columns, grid`` of every page with boxes; ``grid`` are its cells by row."""

    def work(b: list[Box]) -> list[tuple]:
        grid = grid_of(b)
        return [(is_grid(b), len(grid), len(grid[0]) if grid else 0, grid)]

    return _each_page(boxes, page, "is_table boolean, n_rows int, n_columns int, grid array<array<string>>", work)


def in_reading_order(boxes: DataFrame, page: list[str]) -> DataFrame:
    """``page, box_no, line_no, pos, text``: the boxes of each page in reading order, copies once."""

    def work(b: list[Box]) -> list[tuple]:
        return [(x["box_no"], g, n, x["text"]) for n, (g, x) in enumerate(reading_order(b), 1)]

    return _each_page(boxes, page, "box_no int, line_no int, pos int, text string", work)


def page_texts(boxes: DataFrame, page: list[str]) -> DataFrame:
    """``page, text``: the text of each page from its boxes, a line for each in the order they were recognised in.

    Boxes without text give no line; boxes that were written twice give two. Pages without any are left out.
    """
    said = boxes.select(*page, "box_no", plain_line(composed(F.coalesce("box_text", F.lit("")))).alias("text")).where("text <> ''")
    rows = F.array_sort(F.collect_list(F.struct("box_no", "text")))
    return said.groupBy(*page).agg(F.array_join(F.transform(rows, lambda x: x["text"]), "\n").alias("text"))


def clockwise(points: Column) -> Column:
    """ARRAY of STRUCT x, y: the corners of a box from the upper left one on, of four points in any order."""
    def pick(value: Callable[[Column], Column], least: bool) -> Column:
        # Of equal ones the first.
        at = F.transform(points, lambda p, i: F.struct((value(p) if least else -value(p)).alias("v"), i.alias("i")))
        return F.get(points, F.array_min(at)["i"])

    total, difference = (lambda p: p["x"] + p["y"]), (lambda p: p["y"] - p["x"])
    return F.array(pick(total, True), pick(difference, True), pick(total, False), pick(difference, False))


def recognised(df: DataFrame, key: str, result: str) -> DataFrame:
    """``key, box_no, x0, y0, x1, y1, box_text`` of a recogniser's results, JSON of nested lists and mappings.

    Boxes come breadth first, numbered from 1; what is no JSON, null or has no boxes gives no row.
    """
    rows = df.select(F.col(key), F.col(result).cast("string"))
    schema = T.StructType([rows.schema[0], T.StructField("box_no", T.IntegerType()), *(T.StructField(c, T.DoubleType()) for c in ("x0", "y0", "x1", "y1")), T.StructField("box_text", T.StringType())])
    kinds = to_arrow_schema(schema)

    def boxes_of(said: str | None) -> list[tuple]:
        try:
            found = json.loads(said or "null")
        except ValueError:
            return []
        return list(flattened(found)) if isinstance(found, (list, dict)) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, said in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for n, (box, text) in enumerate(boxes_of(said), 1):
                    xs, ys = [float(p[0]) for p in box], [float(p[1]) for p in box]
                    out.append((k, n, min(xs), min(ys), max(xs), max(ys), text))
            columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds.field(i).type) for i, c in enumerate(columns)], schema=kinds)

    return rows.mapInArrow(run, schema)


def flattened(values: Iterator) -> Iterator[tuple[list[list[float]], str | None]]:
    """Boxes with their texts, breadth first, out of a recogniser's nested lists and mappings."""
    todo = deque(values if not isinstance(values, dict) else [values])
    while todo:
        x = todo.popleft()
        if isinstance(x, dict):
            box, said = x.get("box") or x.get("points"), x.get("text") or x.get("rec_text")
            if _is_box(box):
                yield box, said
            else:
                todo.extend(x.values())
        elif isinstance(x, (list, tuple)):
            if len(x) == 2 and _is_box(x[0]):
                said = x[1]
                yield x[0], said[0] if isinstance(said, (list, tuple)) and said else said if isinstance(said, str) else None
            elif _is_box(x):
                yield x, None
            else:
                todo.extend(x)


def _is_box(x: object) -> bool:
    return isinstance(x, (list, tuple)) and len(x) == 4 and all(isinstance(p, (list, tuple)) and len(p) == 2 and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in p) for p in x)
