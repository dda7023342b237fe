"""Markdown tables as relations of lines: (keys, page, line_no, line) in, the same out.

Lines are numbered within their page or document. Blocks of adjacent table lines are islands: a running count of
the lines that aren't table lines names them, so all of it is windows over a document's lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.lines import is_watermark
from foliant.functions.text import clean_line, clean_text, form_layout, match_key, rx, strip, title_key, title_text
from foliant.operators.pages import folded, lines_of

# Patterns of the separator below a header, and of a row.
SEPARATOR = r"^\s*\|?\s*:?-{2,}:?\s*(\|\s*:?-{1,}:?\s*)+\|?\s*$"
ROW = r"^\s*\|.*\|\s*$"
# Words of data rows that were taken for headers; words of real headers; keys of two known layouts.
ACTIONS = "KTX|khiển trách|cảnh cáo|buộc ra khỏi|vi phạm|phân loại|khối ngành|cấp học|công nghệ|thạc sĩ|đại học"
HINTS = ["bước", "lưu đồ", "nội dung", "công việc", "người", "thực hiện", "thời gian", "ghi chú", "đơn vị", "phối hợp", "biểu mẫu", "minh chứng", "hồ sơ"]
DISCIPLINE = ["ktx", "khien trach", "canh cao", "buoc ra khoi", "vi pham"]
REPORT = ["doanh so", "du no", "khach hang", "phan loai"]
HEADED = [r"^CHƯƠNG\s+[IVXLCDM]+\b", r"^Chương\s+[IVXLCDM]+\b", r"^Điều\s+\d+\.?\s+", r"^PHỤ LỤC\s+", r"^QUYẾT ĐỊNH\b", r"^QUY ĐỊNH\b", r"^QUY TRÌNH\b"]


def is_separator(c: Column) -> Column:
    return c.rlike(f"(?U){SEPARATOR}")


def is_row(c: Column) -> Column:
    return c.rlike(f"(?U){ROW}") & ~is_separator(c)


def cells(c: Column, stars: bool = False) -> Column:
    """The cells of a row: one outer pipe on each side goes, blanks are collapsed. Escaped pipes split, too."""
    inner = F.regexp_replace(F.regexp_replace(strip(c), r"^\|", ""), r"\|$", "")
    out = F.transform(F.split(inner, r"\|"), lambda x: strip(rx(x, r"\s+", " ")))
    return F.transform(out, lambda x: F.regexp_replace(x, r"^[ *]+|[ *]+$", "")) if stars else out


def row(values: Column, n: Column | None = None) -> Column:
    """A row of ``n`` cells: short ones are padded, what is too much goes into the last cell."""
    values = F.transform(values, lambda x: strip(x))
    if n is not None:
        size = F.size(values)
        padded = F.concat(values, F.array_repeat(F.lit(""), F.greatest(n - size, F.lit(0))))
        cut = F.concat(F.slice(values, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(strip(F.array_join(F.slice(values, F.greatest(n, F.lit(1)), size), " "))))
        values = F.when(size > n, cut).otherwise(padded)
    return F.concat(F.lit("| "), F.array_join(values, " | "), F.lit(" |"))


def separator(n: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.greatest(F.lit(1), n)), " | "), F.lit(" |"))


def _columns(first: int, n: Column) -> Column:
    return F.when(n >= first, F.transform(F.sequence(F.lit(first), F.greatest(n, F.lit(first))), lambda i: F.concat(F.lit("Cột "), i))).otherwise(F.array().cast("array<string>"))


def guessed_header(values: Column) -> Column:
    """A header for a table that has none, from its number of columns and its words."""
    n, key = F.size(values), match_key(F.array_join(values, " "))
    any_of = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(key, w))
    known = F.array(*map(F.lit, ["TT", "Nội dung vi phạm", "Lần 1", "Lần 2", "Lần 3", "Ghi chú"]))
    return (
        F.when((n == 6) & any_of(DISCIPLINE), known)
        .when((n >= 10) & any_of(REPORT), _columns(1, n))
        .when(n >= 3, F.concat(F.array(F.lit("TT"), F.lit("Nội dung")), _columns(3, n)))
        .otherwise(_columns(1, n))
    )


def is_data_header(values: Column) -> Column:
    """Is this header a data row: an index, a phrase and words of data?"""
    first, second = strip(F.get(values, F.lit(0))), strip(F.get(values, F.lit(1)))
    return (F.size(values) >= 3) & first.rlike(r"(?i)^(\d{1,3}|[IVXLCDM]+)$") & (F.size(F.split(second, r"(?U)\s+")) >= 3) & F.array_join(values, " ").rlike(rf"(?iU)\b({ACTIONS})\b")


def rendered(rows: Column) -> Column:
    """ARRAY<ARRAY<STRING>> as a Markdown table: empty rows go, all are padded; one row gets a header "Cột i"."""
    from foliant.functions.text import cell_escape

    escaped = F.transform(rows, lambda r: F.transform(r, cell_escape))
    kept = F.filter(escaped, lambda r: F.exists(r, lambda x: x != ""))
    n = F.array_max(F.transform(kept, lambda r: F.size(r)))
    padded = F.transform(kept, lambda r: row(r, n))
    one = F.array_join(F.array(row(_columns(1, n)), separator(n), F.get(padded, F.lit(0))), "\n")
    more = F.array_join(F.concat(F.slice(padded, 1, 1), F.array(separator(n)), F.slice(padded, F.lit(2), F.greatest(F.size(padded) - 1, F.lit(0)))), "\n")
    return F.when(F.size(kept) == 0, "").when(F.size(kept) == 1, one).otherwise(more)


def _order(keys: list[str], *by: str) -> Window:
    return Window.partitionBy(*keys).orderBy(*(by or ("line_no",)))


def data_headers_repaired(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Data rows that stand as headers get a guessed header and separator before them; lines are renumbered."""
    w = _order(keys)
    marked = lines.withColumn("_h", is_row(F.col("line")) & F.coalesce(is_separator(F.lead("line").over(w)), F.lit(False)) & is_data_header(cells(F.col("line"))))
    marked = marked.withColumn("_after", F.coalesce(F.lag("_h").over(w), F.lit(False))).where("NOT _after")
    header = guessed_header(cells(F.col("line")))
    n = F.greatest(F.size(header), F.size(cells(F.col("line"))))
    three = F.array(row(header, n), separator(n), row(cells(F.col("line")), n))
    out = marked.select(*keys, "line_no", F.posexplode(F.when(F.col("_h"), three).otherwise(F.array("line"))).alias("_sub", "line"))
    return out.withColumn("line_no", F.row_number().over(_order(keys, "line_no", "_sub"))).drop("_sub")


def _blocks(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_row``, ``_sep`` and ``_block``: a block starts at a row and goes on over rows and separators."""
    lines = lines.withColumn("_sep", is_separator(F.col("line"))).withColumn("_row", is_row(F.col("line")))
    lines = lines.withColumn("_gap", F.sum((~(F.col("_row") | F.col("_sep"))).cast("int")).over(_order(keys)))
    # Separators before the first row of an island are outside.
    lines = lines.withColumn("_seen", F.max(F.col("_row").cast("int")).over(_order([*keys, "_gap"])))
    return lines.withColumn("_block", F.when((F.col("_row") | F.col("_sep")) & (F.col("_seen") == 1), F.col("_gap"))).drop("_gap", "_seen")


def columns_evened(lines: DataFrame, keys: list[str]) -> DataFrame:
    """All rows and separators of a block get as many cells as its longest row; blocks of one line stay."""
    b = _blocks(lines, keys)
    w = Window.partitionBy(*keys, "_block")
    b = b.withColumn("_n", F.max(F.when(F.col("_row"), F.size(cells(F.col("line"))))).over(w)).withColumn("_size", F.count("*").over(w))
    new = F.when(F.col("_block").isNull() | (F.col("_size") < 2), F.col("line")).when(F.col("_sep"), separator(F.col("_n"))).otherwise(row(cells(F.col("line")), F.col("_n")))
    return b.select(*keys, "line_no", new.alias("line"))


def table_rows(lines: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, table_no, row_no, is_header, cells``: the tables of each page, their rows numbered from 1."""
    b = _blocks(lines, keys).where("_block IS NOT NULL")
    b = b.withColumn("_first", F.min("line_no").over(Window.partitionBy(*keys, "_block"))).withColumn("table_no", F.dense_rank().over(_order(keys, "_first")))
    w = _order([*keys, "table_no"])
    b = b.withColumn("is_header", F.coalesce(F.lead("_sep").over(w), F.lit(False)) & F.col("_row")).where("_row")
    return b.select(*keys, "table_no", F.row_number().over(w).alias("row_no"), "is_header", cells(F.col("line")).alias("cells"))


def repeated_title(values: Column) -> Column:
    """STRUCT key, text of the title most cells of a header have before a break, or null; of equals the first.

    Titles have 12 characters at least and stand in two cells at least.
    """
    split = F.filter(F.transform(values, lambda c: F.split(c, r"(?i)<br\s*/?>", 2)), lambda p: F.size(p) > 1)
    titles = F.filter(F.transform(split, lambda p: F.struct(title_key(p[0]).alias("key"), title_text(p[0]).alias("text"))), lambda t: F.length(t["key"]) >= 12)
    counted = F.transform(titles, lambda t, i: F.struct(F.size(F.filter(titles, lambda u: u["key"] == t["key"])).alias("n"), (-i).alias("at"), t["key"].alias("key"), t["text"].alias("text")))
    best = F.array_max(counted)
    return F.when(best["n"] >= 2, F.struct(best["key"].alias("key"), best["text"].alias("text")))


def without_title(cell: Column, key: Column) -> Column:
    parts = F.split(cell, r"(?i)<br\s*/?>", 2)
    rest = strip(F.get(parts, F.lit(1)))
    return F.when((F.size(parts) > 1) & (title_key(F.get(parts, F.lit(0))) == key) & (rest != ""), rest).otherwise(strip(cell))


def _by_text(lines: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, _l``: the lines of each text, which come together by key, in their order."""
    return lines.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_l")).select(*keys, F.transform("_l", lambda x: x["line"]).alias("_l"))


def titles_hoisted(lines: DataFrame, keys: list[str], lookback: int = 6) -> DataFrame:
    """A title repeated in the cells of a header becomes a heading above the table.

    Not if one of the last ``lookback`` lines of the result that say something has it already: headings that were put
    in and headers without their title count there. So the lines are folded, with these lines' keys as the state.
    """
    df = _by_text(lines, keys)
    blank = lambda c: strip(c) == ""

    def seen(c: Column, i: Column) -> Column:
        head = F.contains(c, F.lit("|")) & F.coalesce(is_separator(F.get("_l", i + 1)), F.lit(False))
        said = F.when(~blank(c) & ~strip(c).startswith("<!--"), title_key(c))
        return F.struct(c.alias("c"), said.alias("said"), F.when(head, repeated_title(cells(c, stars=True))).alias("t"), F.coalesce(blank(F.get("_l", i - 1)), F.lit(True)).alias("after_blank"))

    def bare(x: Column) -> Column:
        return F.transform(cells(x["c"], stars=True), lambda c: without_title(c, x["t"]["key"]))

    def with_new(x: Column) -> Column:
        new = F.concat(F.lit("| "), F.array_join(F.transform(bare(x), lambda c: F.when(c == "", " ").otherwise(c)), " | "), F.lit(" |"))
        return F.struct(x["c"].alias("c"), F.when(x["t"].isNull(), x["said"]).otherwise(title_key(new)).alias("said"), x["t"].alias("t"), x["after_blank"].alias("after_blank"), new.alias("new"))

    df = df.withColumn("_x", F.transform(F.transform("_l", seen), with_new))

    def step(recent: Column, x: Column) -> tuple[Column, Column]:
        known = F.exists(recent, lambda k: F.contains(k, x["t"]["key"]))
        heading = x["t"].isNotNull() & ~F.coalesce(known, F.lit(False))
        more = F.concat(recent, F.when(heading, F.array(x["t"]["key"])).otherwise(F.array().cast("array<string>")), F.when(x["said"].isNull(), F.array().cast("array<string>")).otherwise(F.array(x["said"])))
        flag = F.when(x["t"].isNull(), "0").when(heading, "2").otherwise("1")
        return flag, F.struct(F.slice(more, F.greatest(F.size(more) - lookback + 1, F.lit(1)), F.lit(lookback)).alias("k"))

    flags = folded(F.col("_x"), F.struct(F.array().cast("array<string>").alias("k")), lambda s, x: step(s["k"], x))

    def written(x: Column, f: Column) -> Column:
        heading = F.concat(F.lit("## "), x["t"]["text"])
        return (
            F.when(f == "0", F.array(x["c"]))
            .when(f == "1", F.array(x["new"]))
            .when(x["after_blank"], F.array(heading, F.lit(""), x["new"]))
            .otherwise(F.array(F.lit(""), heading, F.lit(""), x["new"]))
        )

    out = F.flatten(F.filter(F.zip_with("_x", F.split(flags, ""), lambda x, f: F.when(x.isNotNull(), written(x, f))), lambda a: a.isNotNull()))
    return df.select(*keys, F.posexplode(out).alias("_n", "line")).select(*keys, (F.col("_n") + 1).alias("line_no"), "line")


def false_tables(lines: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, first_line, last_line, is_false`` of each run of lines with pipes that has a separator.

    A table is false if none of its words is a header's, it has two columns at most, and many cells are empty,
    first cells are section marks, or right cells hold a word or two.
    """
    piped = F.contains("line", F.lit("|")) & ~strip(F.col("line")).startswith("<!--")
    b = lines.withColumn("_p", piped).withColumn("_g", F.sum((~F.col("_p")).cast("int")).over(_order(keys))).where("_p")
    b = b.withColumn("_sep", is_separator(F.col("line"))).withColumn("_cells", cells(F.col("line"), stars=True))
    data = lambda value: F.when(~F.col("_sep"), value)
    right = F.slice("_cells", F.lit(2), F.greatest(F.size("_cells") - 1, F.lit(0)))
    filled = F.filter(right, lambda c: c != "")
    stats = b.groupBy(*keys, "_g").agg(
        F.min("line_no").alias("first_line"),
        F.max("line_no").alias("last_line"),
        F.count("*").alias("_n"),
        F.max("_sep").alias("_has"),
        F.max(data(F.size("_cells"))).alias("_columns"),
        F.max(data(F.exists(F.array(*map(F.lit, HINTS)), lambda h: F.contains(F.lower(F.array_join("_cells", " ")), h)))).alias("_hint"),
        F.sum(data(F.size(F.filter("_cells", lambda c: c == "")))).alias("_empty"),
        F.sum(data(F.size("_cells"))).alias("_all"),
        F.sum(data(F.get("_cells", F.lit(0)).rlike(r"(?iU)^(\d+(\.\d+)*\.?\s+|[a-zA-Zà-ỹ]\.|[IVXLCDM]+\.)").cast("int"))).alias("_marks"),
        F.sum(data(F.size(F.filter(filled, lambda c: F.size(F.split(c, r"(?U)\s+")) <= 2)))).alias("_short"),
        F.sum(data(F.size(filled))).alias("_right"),
    )
    odd = (F.col("_empty") / F.greatest("_all", F.lit(1)) >= 0.35) | (F.col("_marks") >= 1) | (F.col("_short") / F.greatest("_right", F.lit(1)) >= 0.7)
    return stats.where("_n >= 2 AND _has").select(*keys, "first_line", "last_line", (F.coalesce(~F.col("_hint") & (F.col("_columns") <= 2) & odd, F.lit(False))).alias("is_false"))


def false_tables_flat(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of false tables as plain text: separators and empty rows go, cells are joined by a blank."""
    false = false_tables(lines, keys).where("is_false").select(*(F.col(k).alias(f"_{k}") for k in keys), "first_line", "last_line")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    hit = lines.join(false, same & F.col("line_no").between(F.col("first_line"), F.col("last_line")), "left")
    plain = F.array_join(F.filter(cells(F.col("line"), stars=True), lambda c: c != ""), " ")
    flat = F.col("first_line").isNotNull()
    return hit.where(~flat | (~is_separator(F.col("line")) & (plain != ""))).select(*keys, "line_no", F.when(flat, plain).otherwise(F.col("line")).alias("line"))


def continued_row(c: Column, n: Column) -> Column:
    """A loose line of a continued table as a row of ``n`` cells, or null."""
    said = clean_line(c)
    index = r"(?iU)^(\d{1,3}|[IVXLCDM]+)\s+(.+)$"
    return (
        F.when((said == "") | said.startswith("<!--") | said.startswith("#"), None)
        .when(is_row(said), row(cells(said), n))
        .when(said.rlike(index), row(F.array(F.regexp_extract(said, index, 1), F.regexp_extract(said, index, 2)), n))
        .when(said.rlike(r"(?iU)^Tổng cộng\.?$"), row(F.array(F.lit(""), F.lit("Tổng cộng")), n))
    )


def tables_continued(lines: DataFrame, document: str, page: str) -> DataFrame:
    """Tables that go on over pages inherit the header of the page before: ``document, page, line_no, line``.

    A page continues a table if it has no header and its first line that says something is a row, or starts with
    an index or a total; the header is that of the last page before with one, if all pages between continue it.
    """
    keys = [document, page]
    w = _order(keys)
    said = strip(F.col("line"))
    skip = (said == "") | said.startswith("<!--") | said.startswith("## Trang") | said.rlike(r"^\d{1,3}$")
    rows = lines.withColumn("_skip", skip).withColumn("_head", is_row(F.col("line")) & F.coalesce(is_separator(F.lead("line").over(w)), F.lit(False)))
    first = F.min(F.when(~F.col("_skip"), F.col("line_no")))
    pages = rows.groupBy(*keys).agg(
        first.alias("_first"),
        F.min_by(F.when(~F.col("_skip"), said), F.when(~F.col("_skip"), F.col("line_no"))).alias("_line"),
        F.max_by(F.when(F.col("_head"), cells(F.col("line"))), F.when(F.col("_head"), F.col("line_no"))).alias("_header"),
        (F.max(said) != "").alias("_filled"),
    ).where("_filled")
    starts = is_row(F.col("_line")) | F.col("_line").rlike(r"(?iU)^(\d{1,3}|[IVXLCDM]+|Tổng cộng)\s+\S+")
    has = F.col("_header").isNotNull()
    p = _order([document], page)
    pages = pages.withColumn("_run", F.sum((~has & ~F.coalesce(starts, F.lit(False))).cast("int")).over(p))
    run = Window.partitionBy(document, "_run").orderBy(page)
    pages = pages.withColumn("_from", F.last("_header", ignorenulls=True).over(run)).withColumn("_goes", ~has & F.coalesce(starts, F.lit(False)) & F.col("_from").isNotNull())
    found = pages.where("_goes").select(*keys, "_first", "_from")
    j = lines.join(found, keys, "left")
    n = F.size("_from")
    own = F.when(F.col("_from").isNull(), F.col("line")).otherwise(F.coalesce(continued_row(F.col("line"), n), F.col("line")))
    out = F.when(F.col("line_no") == F.col("_first"), F.array(row(F.col("_from"), n), separator(n), own)).otherwise(F.array(own))
    exploded = j.select(*keys, "line_no", F.posexplode(out).alias("_sub", "line"))
    return exploded.withColumn("line_no", F.row_number().over(_order(keys, "line_no", "_sub"))).drop("_sub")


def without_watermarks(lines: DataFrame) -> DataFrame:
    return lines.where(~is_watermark(clean_line(F.col("line"))))


def headings_marked(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Headings that a parser left as plain lines get two #; not inside tables, which end at a blank line."""
    said = strip(F.col("line"))
    inside = F.last(F.when(said.rlike(r"^\|?.+\|"), True).when(said == "", False), ignorenulls=True).over(_order(keys))
    headed = F.lit(False)
    for p in HEADED:
        headed = headed | said.rlike(f"(?U){p}")
    new = F.when(headed & ~F.coalesce(inside, F.lit(False)) & ~said.startswith("#"), F.concat(F.lit("## "), said)).otherwise(F.col("line"))
    return lines.select(*keys, "line_no", new.alias("line"))


def finished(lines: DataFrame, document: str, page: str) -> DataFrame:
    """The lines after the last repairs, in their order: watermarks, forms, data rows as headers, columns, continued tables."""
    keys = [document, page]
    lines = without_watermarks(lines)
    formed = lines.select(*keys, "line_no", F.posexplode(F.split(form_layout(F.col("line")), "\n")).alias("_sub", "line"))
    lines = formed.withColumn("line_no", F.row_number().over(_order(keys, "line_no", "_sub"))).drop("_sub")
    return tables_continued(columns_evened(data_headers_repaired(lines, keys), keys), document, page)


def finished_texts(lines: DataFrame, document: str, page: str) -> DataFrame:
    """``document, text``: the documents after the last repairs (``finished``) as clean texts with a line end."""
    rows = finished(lines, document, page).groupBy(document).agg(F.array_sort(F.collect_list(F.struct(page, "line_no", "line"))).alias("_l"))
    text = F.array_join(F.transform("_l", lambda x: x["line"]), "\n")
    return rows.select(document, F.concat(clean_text(F.regexp_replace(text, "\n{4,}", "\n\n\n")), F.lit("\n")).alias("text"))


def normalised_markdown(df: DataFrame, key: str, text: str, flatten: bool = True) -> DataFrame:
    """``key, text``: a parser's Markdown made like our own, in this order: titles out of headers, false tables flat
    (with ``flatten``), blanks single outside of tables, headings marked, blank lines single, the last repairs.

    Null texts are left out; keys are unique. The text's own page headings are its pages.
    """
    lines = titles_hoisted(lines_of(df, [key], text), [key])
    if flatten:
        lines = false_tables_flat(lines, [key])
    spaced = F.when(F.col("line").rlike(r"(?U)^\s*\|?.+\|"), rx(F.col("line"), r"\s+$")).otherwise(strip(F.regexp_replace("line", "[ \t]+", " ")))
    lines = headings_marked(lines.withColumn("line", spaced), [key])
    # A blank line behind a blank line goes.
    w = _order([key])
    lines = lines.withColumn("_b", (F.col("line") == "") & (F.coalesce(F.lag("line").over(w), F.lit("x")) == "")).where("NOT _b").drop("_b")
    page = F.count_if(F.col("line").rlike(r"^## Trang +\d+[ \t\r]*$")).over(w)
    return finished_texts(lines.withColumn("_page", page), key, "_page")
