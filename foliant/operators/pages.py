"""Operators over pages: running lines, metrics, layout signals, routing, assembly."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.lines import Line, is_item, is_structural, starts
from foliant.functions import lines as P
from foliant.functions.text import clean_line, clean_text, edge_key, layout_key, match_key, strip, trim_rules


def lines_of(df: DataFrame, keys: list[str], text: str, number: str = "line_no", line: str = "line") -> DataFrame:
    """``keys, line_no (from 1), line``: every line of every text; null texts have none, empty ones one."""
    df = df.where(F.col(text).isNotNull()).select(*keys, F.posexplode(F.split(F.col(text), "\r\n|\n|\r")).alias("_n", line))
    return df.select(*keys, (F.col("_n") + 1).alias(number), line)


def analysed(lines: DataFrame, line: str = "line") -> tuple[DataFrame, Line]:
    """The lines with columns for what their predicates share, and a view of these columns.

    Each step is a projection of its own, so nothing is computed twice.
    """
    df = lines.withColumn("_c", clean_line(F.col(line))).withColumn("_m", P.marker(F.col("_c"))).withColumn("_key", match_key(F.col("_c")))
    df = df.withColumn("_content_key", F.when(F.col("_m.kind").isNull(), F.col("_key")).otherwise(match_key(F.col("_m.content"))))
    view = Line(F.col("_c"), F.col("_m"), F.col("_key"), F.col("_content_key"))
    return df.withColumn("_level", P.marker_level(view)), view


def repeated_lines(lines: DataFrame, document: str, page: str, line: str = "line", min_ratio: float = 0.6, pages: DataFrame | None = None) -> DataFrame:
    """``document, key, n_pages``: lines on at least max(2, floor(min_ratio * pages)) pages of a document.

    A document of less than three pages has none. ``pages`` has the (document, page) pairs that count as pages if
    some have no lines. Structural lines and lines under five characters don't count. Keys are counted first, and
    only those on enough pages are tested for structure: it depends on the key's lines alone.
    """
    every = (pages if pages is not None else lines).select(document, page).distinct().groupBy(document).agg(F.count("*").alias("_pages"))
    said = lines.select(document, page, clean_line(F.col(line)).alias("_c")).where(F.length("_c") >= 5)
    # Structure depends on the digits, too, so lines stay apart within a key until they are tested.
    texts = said.groupBy(document, "_c").agg(F.collect_set(page).alias("_on"))
    df, view = analysed(texts, "_c")
    # The test is aggregated, not filtered by: a filter would be pushed below the steps of the analysis and
    # take all of them into its condition.
    tested = df.select(document, edge_key(F.col("_c")).alias("key"), F.explode("_on").alias("_p"), is_structural(view, F.col("_level")).alias("_s"))
    kept = tested.groupBy(document, "key", "_p").agg(F.min("_s").alias("_s")).where("NOT _s")
    counts = kept.groupBy(document, "key").agg(F.count("*").alias("n_pages"))
    least = F.greatest(F.lit(2), F.floor(F.col("_pages") * min_ratio))
    return counts.join(every, document).where((F.col("_pages") >= 3) & (F.col("n_pages") >= least)).select(document, "key", "n_pages")


def without_repeated(lines: DataFrame, repeated: DataFrame, document: str, line: str = "line") -> DataFrame:
    """The lines whose key isn't a repeated one of their document."""
    keyed = lines.withColumn("_key", edge_key(F.col(line)))
    keys = repeated.select(F.col(document).alias("_d"), F.col("key").alias("_k")).distinct()
    return keyed.join(keys, (F.col(document) == F.col("_d")) & (F.col("_key") == F.col("_k")), "left_anti").drop("_key")


def page_metrics(pages: DataFrame, document: str, text: str, method: str, tables: str | None = None) -> DataFrame:
    """Of each document: pages, characters of their cleaned texts, pages from a text layer and from recognition.

    With ``tables``, a column with the number of tables on a page, their sum as ``n_tables``.
    """
    chars = F.length(clean_text(F.col(text)))
    more = [F.coalesce(F.sum(tables), F.lit(0)).alias("n_tables")] if tables else []
    return pages.groupBy(document).agg(
        *more,
        F.count("*").alias("total_pages"),
        F.sum(chars).alias("total_characters"),
        F.count_if(F.col(method) == "pymupdf_text").alias("text_pages"),
        F.count_if(F.col(method) == "ocr_pdf_scan").alias("ocr_pages"),
    )


def opens_list(c: Column) -> Column:
    return c.endswith(":") | F.lower(c).contains("các tiêu chí sau") | F.lower(c).contains("hồ sơ gồm")


def bulleted(lines: DataFrame, keys: list[str], number: str = "line_no", line: str = "line") -> DataFrame:
    """``keys, line_no, line``, cleaned and without blank lines; items below a line that announces a list have
    their bullet back. The state never resets within a text."""
    rows = lines.select(*keys, number, clean_line(F.col(line)).alias(line)).where(F.col(line) != "").withColumn("_opens", opens_list(F.col(line)))
    before = _window(*keys, order=number).rowsBetween(-(2**31), -1)
    inside = F.coalesce(F.max("_opens").over(before), F.lit(False))
    new = F.when(inside & ~F.col("_opens") & starts(F.col(line), P.BULLETED) & ~is_item(F.col(line)), F.concat(F.lit("- "), F.col(line))).otherwise(F.col(line))
    return rows.select(*keys, number, new.alias(line))


def _lines_in(text: Column) -> Column:
    """The cleaned lines of a text that aren't blank, as an array."""
    return F.filter(F.transform(F.split(text, "\r\n|\n|\r"), clean_line), lambda c: c != "")


def _bulleted_in(numbered: Column) -> Column:
    """``bulleted`` over an array of structs c, i, opens."""
    first = F.array_min(F.transform(numbered, lambda x: F.when(x["opens"], x["i"])))
    # Repeated beside the lines, the first opening line is looked for once and not per line.
    below = lambda x, at: (x["i"] > at) & ~x["opens"] & starts(x["c"], P.BULLETED) & ~is_item(x["c"])
    return F.zip_with(numbered, F.array_repeat(first, F.size(numbered)), lambda x, at: F.when(below(x, at), F.concat(F.lit("- "), x["c"])).otherwise(x["c"]))


def _analysed_in(lines: Column) -> Column:
    """Cleaned lines with what ``analysed`` gives them, as an array of structs: c, m, key, content_key, level.

    Each step is a pass of its own over the array, so nothing is computed twice.
    """
    x = F.transform(lines, lambda c: F.struct(c.alias("c"), P.marker(c).alias("m"), match_key(c).alias("key")))
    content = lambda x: F.when(x["m"]["kind"].isNull(), x["key"]).otherwise(match_key(x["m"]["content"]))
    x = F.transform(x, lambda x: F.struct(x["c"].alias("c"), x["m"].alias("m"), x["key"].alias("key"), content(x).alias("content_key")))
    return F.transform(x, lambda x: F.struct(x["c"].alias("c"), x["m"].alias("m"), x["key"].alias("key"), x["content_key"].alias("content_key"), P.marker_level(_view(x)).alias("level")))


def _view(x: Column) -> Line:
    return Line(x["c"], x["m"], x["key"], x["content_key"])


def folded(lines: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """How each line stands to those before it: a character per line, as ``step(state, line)`` gives it with the new state.

    The state is a struct of a bounded size and never the text, so that a text of many lines takes linear time.
    """
    def one(acc: Column, x: Column) -> Column:
        flag, state = step(acc["s"], x)
        return F.struct(F.concat(acc["flags"], flag).alias("flags"), state.alias("s"))

    return F.aggregate(lines, F.struct(F.lit("").alias("flags"), start.alias("s")), one, lambda acc: acc["flags"])


def unfolded(lines: Column, flags: Column, line: str = "c", glue: dict[str, str] | None = None) -> Column:
    """The lines as one text: each behind its flag's glue, by default a blank for 1 and a line end for all others."""
    between = lambda f: F.coalesce(*(F.when(f == k, v) for k, v in (glue or {"1": " "}).items()), F.lit("\n"))
    return F.array_join(F.zip_with(lines, F.split(flags, ""), lambda x, f: F.concat(between(f), x[line])), "")


def _no(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def with_merged(df: DataFrame, text: str, to: str, eager: bool = False) -> DataFrame:
    """Adds ``to``: the text with broken lines joined; null and empty texts give "".

    All of it is passes over the text's own lines: no row leaves its task. Of what stands before a line the fold
    keeps its length, whether it is upper case, has letters, and how it ends.
    """
    lines = F.transform(_lines_in(F.coalesce(F.col(text), F.lit(""))), lambda c, i: F.struct(c.alias("c"), i.alias("i"), opens_list(c).alias("opens")))
    df = df.withColumn("_x", lines)
    goes = lambda c: P.goes_on(c) | ~starts(c, P.SIGNATURES) if eager else P.goes_on(c)
    # A projection of its own: the lines are read by the fold and by what puts them together.
    df = df.withColumn(
        "_x",
        F.transform(
            _analysed_in(_bulleted_in(F.col("_x"))),
            lambda x: F.struct(
                x["c"].alias("c"),
                F.length(x["c"]).alias("n"),
                _no(is_structural(_view(x), x["level"]) | is_item(x["c"])).alias("apart"),
                _no(goes(x["c"])).alias("goes"),
                P.ends_open(x["c"]).alias("open"),
                x["c"].rlike(r"[.;:!?]$").alias("stop"),
                (F.upper(x["c"]) == x["c"]).alias("upper"),
                x["c"].rlike(r"\p{L}").alias("letter"),
            ),
        ),
    )

    def step(s: Column, x: Column) -> tuple[Column, Column]:
        shouted = (s["n"] > 8) & s["letter"] & s["upper"]
        join = ~x["apart"] & ~s["stop"] & ~shouted & (s["open"] | x["goes"])
        state = F.struct(
            F.when(join, s["n"] + 1 + x["n"]).otherwise(x["n"]).alias("n"),
            (x["upper"] & (~join | s["upper"])).alias("upper"),
            (x["letter"] | (join & s["letter"])).alias("letter"),
            x["open"].alias("open"),
            x["stop"].alias("stop"),
        )
        return F.when(join, "1").otherwise("0"), state

    nothing = F.struct(F.lit(0).alias("n"), F.lit(False).alias("upper"), F.lit(False).alias("letter"), F.lit(False).alias("open"), F.lit(True).alias("stop"))
    out = unfolded(F.col("_x"), folded(F.col("_x"), nothing, step))
    out = F.regexp_replace(out, r"(?iU)(các tiêu chí sau đây)\s+-\s+", "$1:\n- ")
    out = F.replace(out, F.lit("Trân trọng cảm ơn./ Nơi nhận:"), F.lit("Trân trọng cảm ơn./.\nNơi nhận:"))
    return df.withColumn(to, clean_text(out)).drop("_x")


def with_markdown(df: DataFrame, text: str, to: str, eager: bool = False) -> DataFrame:
    """Adds ``to``: the text as light Markdown: lines joined, headings marked, paragraphs apart."""
    df = with_merged(df, text, to, eager)
    return df.withColumn(to, F.array_join(F.transform(_analysed_in(_lines_in(F.col(to))), lambda x: P.markdown_line(_view(x), x["level"])), "\n\n"))


def merged(df: DataFrame, key: str, text: str, eager: bool = False) -> DataFrame:
    """``key, text``: the texts with broken lines joined, a row for each row, also where keys repeat."""
    rows = df.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    return with_merged(rows, "_t", "text", eager).select(F.col("_k").alias(key), "text")


def markdown(df: DataFrame, key: str, text: str, eager: bool = False) -> DataFrame:
    """``key, text``: the texts as light Markdown, a row for each row, also where keys repeat."""
    rows = df.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    return with_markdown(rows, "_t", "text", eager).select(F.col("_k").alias(key), "text")


# --- layout signals and routing -----------------------------------------------------------------------------

# Phrases, headers and fields that show a table, a flow chart or a form.
TABLE_PHRASES = ["ii. lưu đồ", "lưu đồ", "khung kế hoạch thực hiện", "số lần vi phạm", "hình thức xử lý", "doanh số cho vay", "doanh số thu nợ", "dư nợ", "số khách hàng"]
TABLE_HEADERS = ["bước", "nội dung công việc", "người thực hiện", "thời gian thực hiện", "ghi chú", "đơn vị", "phối hợp", "tt", "nội dung vi phạm", "lần 1", "lần 2", "lần 3", "phân loại", "trong kỳ báo cáo", "lũy kế", "nợ quá hạn"]
FORM_PHRASES = ["tờ khai", "mẫu", "phụ lục", "xác nhận của", "ký, ghi rõ", "đóng dấu"]
FORM_FIELDS = ["họ và tên", "ngày sinh", "giới tính", "cccd", "nơi cấp", "tên cơ sở giáo dục", "hệ đào tạo", "ngành, lĩnh vực đào tạo", "mã ngành", "loại hình đào tạo", "đồng/tháng", "người học"]
FLOW_LABELS = ("hồ sơ đạt", "hồ sơ không đạt")


def _found(key: Column, values: list[str]) -> Column:
    return F.filter(F.array(*map(F.lit, values)), lambda x: F.contains(key, x))


def _reason(found: Column, name: str, most: int, when: Column) -> Column:
    return F.when(when, F.concat(F.lit(name), F.array_join(F.slice(found, 1, most), ",")))


def with_keyword_scores(df: DataFrame, text: str) -> DataFrame:
    """Adds ``keyword_score``, ``form_score`` and ``reasons`` of a page's text; null counts as ""."""
    names = [c for c in df.columns if c not in ("keyword_score", "form_score", "reasons")]
    keyed = df.select(*names, layout_key(F.col(text)).alias("_key"))
    return keyed.withColumn("_s", keyword_scores(F.col(text), F.col("_key"))).select(*names, "_s.*")


def keyword_scores(text: Column, key: Column) -> Column:
    """STRUCT keyword_score, form_score, reasons of a page's text; ``key`` is its layout_key, as a column."""
    strong, heads, forms, fields = (_found(key, x) for x in (TABLE_PHRASES, TABLE_HEADERS, FORM_PHRASES, FORM_FIELDS))
    flow = F.contains(key, F.lit(FLOW_LABELS[0])) & F.contains(key, F.lit(FLOW_LABELS[1]))
    dots = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\.{6,}"))
    n = lambda x: F.size(x)
    table = F.when(n(strong) > 0, 2 + n(strong)).otherwise(0) + F.when(n(heads) >= 3, n(heads)).otherwise(0) + F.when(flow, 2).otherwise(0)
    form = F.when(n(forms) > 0, 2 + n(forms)).otherwise(0) + F.when(n(fields) >= 3, n(fields)).otherwise(0) + F.when(dots >= 3, F.least(dots, F.lit(8))).otherwise(0)
    reasons = F.array_compact(
        F.array(
            _reason(strong, "keyword_table_strong:", 4, n(strong) > 0),
            _reason(heads, "many_table_header_terms:", 6, n(heads) >= 3),
            F.when(flow, "flowchart_decision_labels"),
            _reason(forms, "form_strong:", 4, n(forms) > 0),
            _reason(fields, "form_fields:", 6, n(fields) > 0),
            F.when(dots >= 3, F.concat(F.lit("many_dot_leaders:"), dots)),
        )
    )
    return F.struct(table.cast("int").alias("keyword_score"), form.cast("int").alias("form_score"), reasons.alias("reasons"))


# From which scores on a page is a table or a form.
TABLE_AT = {"keywords": 3, "with_lines": 8, "with_raster": 0.30, "lines": 45, "raster": 0.70}
FORM_AT = {"fields": 5, "with_raster": 0.25, "with_lines": 8, "with_chars": 80, "raster": 0.80, "but_vertical": 5}
CONTINUED_AT = {"lines": 25, "raster": 0.55, "and_vertical": 3, "keywords": 2, "with_lines": 10, "with_raster": 0.30}


def _score(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def classified(signals: DataFrame) -> DataFrame:
    """Page signals with ``likely_table`` and ``likely_form`` decided from the scores; null scores count as 0."""
    lines, raster, frame = _score("vector_line_count"), _score("raster_line_score"), _score("raster_form_score")
    drawn = (lines >= TABLE_AT["with_lines"]) | (raster >= TABLE_AT["with_raster"])
    table = ((_score("keyword_score") >= TABLE_AT["keywords"]) & drawn) | (lines >= TABLE_AT["lines"]) | (raster >= TABLE_AT["raster"])
    filled = (frame >= FORM_AT["with_raster"]) | (lines >= FORM_AT["with_lines"]) | (_score("text_chars") > FORM_AT["with_chars"])
    form = ((_score("form_score") >= FORM_AT["fields"]) & filled) | ((frame >= FORM_AT["raster"]) & (_score("raster_vertical_lines") < FORM_AT["but_vertical"]))
    return signals.withColumns({"likely_table": table, "likely_form": ~table & form})


@F.arrow_udf(T.StringType())
def _two_places(values: pa.Array) -> pa.Array:
    """Rounded as the binary number is; the JVM rounds its shortest decimal form, which differs at halves."""
    return pa.array([None if v is None else f"{v:.2f}" for v in values.to_pylist()], pa.string())


def layout_reasons(signals: DataFrame) -> DataFrame:
    """Adds ``layout_reasons``: what a page's drawn and scanned lines say for a table or a form, as an array."""
    c = lambda name: F.coalesce(F.col(name), F.lit(0))
    score = lambda name, column: F.when(c(column) >= 0.45, F.concat(F.lit(f"{name}:"), _two_places(c(column).cast("double"))))
    reasons = F.array(
        F.when(c("vector_line_count") >= 20, F.concat(F.lit("many_vector_lines:"), F.col("vector_line_count"))),
        score("raster_table_score", "raster_line_score"),
        score("raster_form_score", "raster_form_score"),
        F.when((c("raster_horizontal_lines") != 0) | (c("raster_vertical_lines") != 0), F.concat(F.lit("raster_lines:h"), c("raster_horizontal_lines"), F.lit("/v"), c("raster_vertical_lines"))),
    )
    return signals.withColumn("layout_reasons", F.array_compact(reasons))


def raster_scores(horizontal: Column, vertical: Column) -> Column:
    """STRUCT table_score, form_score of a page from how many long lines its image has in each direction."""
    part = lambda n, of, most: F.least(n / of, F.lit(1.0)) * most
    capped = lambda n, of, most: F.least(n / of, F.lit(most))
    both = (horizontal >= 4) & (vertical >= 3)
    table = F.when(both, part(horizontal, 18.0, 0.45) + part(vertical, 12.0, 0.55)).otherwise(capped(horizontal, 30.0, 0.25) + capped(vertical, 20.0, 0.20))
    form = capped(horizontal, 18.0, 1.0)
    form = F.when(horizontal < 6, 0.0).when(vertical >= 3, F.least(form + 0.15, F.lit(1.0))).otherwise(form)
    return F.struct(table.alias("table_score"), form.alias("form_score"))


def continues_table(likely_table: str = "likely_table") -> Column:
    lines, raster = _score("vector_line_count"), _score("raster_line_score")
    ruled = (raster >= CONTINUED_AT["raster"]) & (_score("raster_vertical_lines") >= CONTINUED_AT["and_vertical"])
    named = (_score("keyword_score") >= CONTINUED_AT["keywords"]) & ((lines >= CONTINUED_AT["with_lines"]) | (raster >= CONTINUED_AT["with_raster"]))
    return F.coalesce(F.col(likely_table), F.lit(False)) | (lines >= CONTINUED_AT["lines"]) | ruled | named


def latest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per key: the greatest by ``by``. Aggregated before it is shuffled; rows with a null key are left out."""
    rest = [c for c in df.columns if c not in keys]
    kept = df.dropna(subset=keys).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_r"))
    return kept.select(*keys, *(F.col(f"_r.`{c}`").alias(c) for c in rest)).select(*df.columns)


def table_pages(signals: DataFrame, document: str, page: str, expand: bool = True) -> DataFrame:
    """``document, page``: pages that need table or form treatment.

    Tables and forms, and with ``expand`` the pages that are reachable from a table page through adjacent pages
    that continue one: an island of such pages stays if one of them is a table. ``signals`` has a row per page.
    """
    rows = signals.select(document, page, F.coalesce("likely_table", F.lit(False)).alias("_t"), F.coalesce("likely_form", F.lit(False)).alias("_f"), continues_table().alias("_c"))
    if not expand:
        return rows.where("_t OR _f").select(document, page)
    island = F.col(page) - F.row_number().over(_window(document, "_c", order=page))
    marked = rows.withColumn("_i", island).withColumn("_any", F.max("_t").over(_window(document, "_c", "_i")))
    return marked.where("_f OR (_c AND _any)").select(document, page)


def _window(*keys: str, order: str | None = None):
    from pyspark.sql import Window

    w = Window.partitionBy(*keys)
    return w.orderBy(order) if order else w


def contiguous(df: DataFrame, document: str, page: str) -> DataFrame:
    """``document, first_page, last_page, n_pages``: runs of adjacent pages; repeated pages count once."""
    rows = df.select(document, page).where(F.col(page).isNotNull()).distinct()
    rows = rows.withColumn("_i", F.col(page) - F.row_number().over(_window(document, order=page)))
    return rows.groupBy(document, "_i").agg(F.min(page).alias("first_page"), F.max(page).alias("last_page"), F.count("*").alias("n_pages")).drop("_i")


def clamped(df: DataFrame, document: str, page: str, first: int = 0, last: int = 0) -> DataFrame:
    """The pages from ``first`` to ``last`` of each document (0: open), within what the document has."""
    total = F.max(page).over(_window(document))
    lo = F.greatest(F.lit(1), F.least(F.lit(first if first > 0 else 1), total))
    hi = F.least(F.lit(last), total) if last > 0 else total
    return df.withColumn("_lo", lo).withColumn("_hi", F.greatest(lo, hi)).where(F.col(page).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def page_indices(total: Column, first: Column, last: Column) -> Column:
    """The indices (from 0) of the pages first..last (from 1, null or 0: open). The end is kept within the document and
    the start isn't: one beyond the end gives its own index."""
    lo = F.greatest(F.lit(1), F.coalesce(F.nullif(first, F.lit(0)), F.lit(1)))
    hi = F.greatest(lo, F.least(F.coalesce(F.nullif(last, F.lit(0)), total), total))
    return F.sequence(lo - 1, hi - 1)


def target_pages(first: int | None, last: int | None) -> str | None:
    """The pages of a request to a parser: "4-8", "4", or None for all. Pages count from 1."""
    if first is None and last is None:
        return None
    lo = first or 1
    hi = last or lo
    if lo < 1 or hi < lo:
        raise ValueError(f"no range of pages: {first}-{last}")
    return str(lo) if lo == hi else f"{lo}-{hi}"


def routed(pages: DataFrame, special: DataFrame, document: str, page: str) -> DataFrame:
    """``document, page, route``: cloud for the pages in ``special``, local for all others."""
    marks = special.select(document, page).distinct().withColumn("_s", F.lit(True))
    return pages.select(document, page).distinct().join(marks, [document, page], "left").select(document, page, F.when(F.col("_s"), "cloud").otherwise("local").alias("route"))


def route_override(detected: DataFrame, manual: str | None, document: str, page: str, documents: DataFrame) -> DataFrame:
    """The pages of a manual list ("4,6,8-10") for every document, if there is one; else the detected pages."""
    from foliant.functions.text import page_list

    if not (manual or "").strip():
        return detected.select(document, page)
    return documents.select(document).distinct().select(document, F.explode(page_list(F.lit(manual))).alias(page))


# --- Markdown documents -------------------------------------------------------------------------------------

PAGE = r"(?md)(?=^## Trang +\d+[ \t\r]*$)"


def page_blocks(df: DataFrame, document: str, text: str) -> DataFrame:
    """``document, page_no, block``: a Markdown document split at its page headings; of equal pages the last one.

    What stands before the first heading belongs to no page. Rules at the end of a block are cut.
    """
    parts = df.select(document, F.posexplode(F.split(F.col(text), PAGE)).alias("_pos", "_part"))
    parts = parts.withColumn("page_no", F.regexp_extract("_part", r"^## Trang +(\d+)[ \t\r]*(?:\n|$)", 1).try_cast("int")).where(F.col("page_no").isNotNull())
    return parts.groupBy(document, "page_no").agg(F.max_by("_part", "_pos").alias("_part")).select(document, "page_no", trim_rules(F.col("_part")).alias("block"))


def expected_blocks(found: DataFrame, expected: DataFrame, document: str) -> DataFrame:
    """Blocks (document, page_no, pos, block) brought to the expected pages (document, page_no).

    If any marker of a document is expected, its expected blocks are kept; otherwise blocks and expected pages are
    paired by position, as far as both go.
    """
    wanted = expected.select(document, "page_no").distinct()
    hit = found.join(wanted, [document, "page_no"], "left_semi")
    kept = hit.groupBy(document, "page_no").agg(F.max_by("block", "pos").alias("block"))
    rest = found.join(hit.select(document).distinct(), document, "left_anti").withColumn("_k", F.row_number().over(_window(document, order="pos")))
    slots = wanted.withColumn("_k", F.row_number().over(_window(document, order="page_no")))
    return kept.unionByName(rest.drop("page_no").join(slots, [document, "_k"]).select(document, "page_no", "block"))


def assembled(blocks: DataFrame, pages: DataFrame, document: str, placeholder: str = "_(no content)_", rule: str = "\n\n---\n\n") -> DataFrame:
    """``document, body``: the blocks of all pages in their order; pages without a block get a placeholder."""
    every = pages.select(document, "page_no").distinct().join(blocks.select(document, "page_no", "block"), [document, "page_no"], "left")
    block = F.coalesce("block", F.concat(F.lit("## Trang "), F.col("page_no"), F.lit(f"\n\n{placeholder}")))
    ordered = F.array_sort(F.collect_list(F.struct("page_no", block.alias("block"))))
    return every.groupBy(document).agg(F.array_join(F.transform(ordered, lambda x: x["block"]), rule).alias("body"))


def merged_blocks(*written: DataFrame, document: str) -> DataFrame:
    """``document, page_no, block`` of all inputs; of a page that several have, the block of the last input with it."""
    every = None
    for n, blocks in enumerate(written):
        rows = blocks.select(document, "page_no", "block", F.lit(n).alias("_n"))
        every = rows if every is None else every.unionByName(rows)
    return every.groupBy(document, "page_no").agg(F.max_by("block", "_n").alias("block"))


def marked_pages(pages: DataFrame, document: str, page: str, text: str, ordinal: str) -> DataFrame:
    """``document, body``: a parser's pages joined, each behind a comment with its number; unnumbered ones by ``ordinal``."""
    rows = pages.select(document, F.col(ordinal).alias("_o"), F.coalesce(F.nullif(F.col(page), F.lit(0)), F.col(ordinal)).alias("_p"), strip(F.coalesce(F.col(text), F.lit(""))).alias("_t"))
    block = strip(F.concat(F.lit("<!-- page: "), F.col("_p"), F.lit(" -->\n\n"), F.col("_t")))
    listed = F.array_sort(F.collect_list(F.struct("_o", block.alias("b"))))
    return rows.groupBy(document).agg(F.concat(F.array_join(F.transform(listed, lambda x: x["b"]), "\n\n"), F.lit("\n")).alias("body"))


def documents(headers: DataFrame, bodies: DataFrame, document: str) -> DataFrame:
    """``document, markdown``: heads (``header``) and bodies (``body``) as whole documents; one without a body is its head."""
    return headers.join(bodies, document, "left").select(document, F.concat(F.col("header"), F.lit("\n"), F.coalesce("body", F.lit(""))).alias("markdown"))


def document_header(source: Column, fields: dict[str, Column]) -> Column:
    """The head of a Markdown document: a bullet per field that isn't null."""
    items = F.array_compact(F.array(*(F.concat(F.lit(f"- {name}: "), c.cast("string")) for name, c in fields.items())))
    head = F.concat(F.lit("# PDF / Image Text Document\n\n## Metadata\n\n- Source file: `"), source, F.lit("`\n"))
    return F.concat(head, F.array_join(items, "\n"), F.lit("\n\n## Extracted Text\n"))


def blocks_of_pages(df: DataFrame, key: str, page: str, text: str, method: str, min_chars: int = 30) -> DataFrame:
    """``key, block``: each page's Markdown under its heading and comments, as a text layer or a scan."""
    long = F.length(clean_text(F.col(text))) >= min_chars
    route = F.coalesce(F.col(method), F.when(long, "pymupdf_text").otherwise("ocr_pdf_scan"))
    head = F.concat(F.lit("## Trang "), F.col(page), F.lit("\n\n<!-- page: "), F.col(page), F.lit(" -->\n\n<!-- extraction: "), route, F.lit(" -->\n\n"))
    rows = df.select(F.col(key).alias("_k"), head.alias("_head"), F.col(text).alias("_t"))
    return with_markdown(rows, "_t", "_md").select(F.col("_k").alias(key), F.concat("_head", "_md", F.lit("\n\n---")).alias("block"))
