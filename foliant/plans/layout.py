"""Queries over text layers, page signals, routing, tables and boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions.lines import suspicious_signs
from foliant.functions.text import better_text, clean_line, first_text
from foliant.operators import boxes, layers, pages, tables
from foliant.plans import plain, sql, texts
from foliant.session import table

PAGE = ["version_id", "page_no"]


def _raw(spark, d):
    return table(spark, d, "raw_pages")


def _bigint(df, *names):
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


def s12_text_probe(spark, d):
    return layers.has_text(_raw(spark, d), "version_id", "page_no", "raw_text")


def p22_bad_layers(spark, d):
    return _raw(spark, d).select("page_id", layers.is_bad(F.col("raw_text")).alias("is_bad"))


def a06_layer_reports(spark, d):
    return layers.with_report(_raw(spark, d).select("page_id", "raw_text"), "raw_text").select("page_id", "report.*")


def p24_dropped_layers(spark, d):
    return layers.dropped_layer(_raw(spark, d).select("page_id", "raw_text", "image_ratio"), "raw_text", "image_ratio", "image_ratio").select("page_id", "report.score", "report.reason", "drop_layer")


def a03_documents_to_recognise(spark, d):
    """A page counts as bad if its layer is dropped."""
    rows = layers.dropped_layer(_raw(spark, d).select("version_id", "raw_text", "image_ratio"), "raw_text", "image_ratio", "image_ratio").select("version_id", "drop_layer", F.col("report.length").alias("length"))
    return layers.documents_to_recognise(rows, "version_id", "drop_layer", F.col("length"))


def p26_table_heavy(spark, d):
    out = layers.table_heavy(pages.lines_of(_raw(spark, d), PAGE, "raw_text"), "version_id", "page_no")
    return out.withColumns({c: F.round(c, 6) for c in ("short_ratio", "number_ratio")})


def a01_page_metrics(spark, d):
    """A page's tables are counted by the separators below their headers."""
    lines = F.split(F.coalesce("raw_text", F.lit("")), "\r\n|\n|\r")
    rows = _raw(spark, d).withColumn("n_tables", F.size(F.filter(lines, tables.is_separator)))
    return pages.page_metrics(rows, "version_id", "raw_text", "extraction", "n_tables")


def a04_keyword_scores(spark, d):
    out = pages.with_keyword_scores(_raw(spark, d).select("page_id", "raw_text"), "raw_text").select("page_id", "keyword_score", "form_score", F.array_join("reasons", ";").alias("reasons"))
    return _bigint(out, "keyword_score", "form_score")


def _signals(spark, d):
    keys = table(spark, d, "page_signals").withColumnRenamed("page_number", "page_no")
    return pages.latest(keys, PAGE, ["scanned_at", "text_chars", "raster_line_score", "raster_form_score", "vector_line_count", "keyword_score", "form_score"])


def p29_page_classes(spark, d):
    out = pages.classified(_signals(spark, d)).select(*PAGE, "likely_table", "likely_form", pages.continues_table().alias("continues"))
    return _bigint(out, "page_no")


def q_p29_layout_reasons(spark, d):
    return _bigint(pages.layout_reasons(_signals(spark, d)).select(*PAGE, F.array_join("layout_reasons", ";").alias("reasons")), "page_no")


def a12_raster_scores(spark, d):
    s = pages.raster_scores(F.coalesce("raster_horizontal_lines", F.lit(0)), F.coalesce("raster_vertical_lines", F.lit(0)))
    return _bigint(_signals(spark, d).select(*PAGE, F.round(s["table_score"], 6).alias("table_score"), F.round(s["form_score"], 6).alias("form_score")), "page_no")


def o02_page_indices(spark, d):
    """The indices of pages 3 to 6 of each version, by its number of pages."""
    totals = _raw(spark, d).groupBy("version_id").agg(F.max("page_no").alias("n"))
    return totals.select("version_id", F.explode(pages.page_indices(F.col("n"), F.lit(3), F.lit(6))).alias("page_index")).withColumn("page_index", F.col("page_index").cast("bigint"))


def w02_table_pages(spark, d):
    return _bigint(pages.table_pages(pages.classified(_signals(spark, d)), "version_id", "page_no"), "page_no")


def w01_page_runs(spark, d):
    return _bigint(pages.contiguous(pages.table_pages(pages.classified(_signals(spark, d)), "version_id", "page_no"), "version_id", "page_no"), "first_page", "last_page")


def j04_routes(spark, d):
    special = pages.table_pages(pages.classified(_signals(spark, d)), "version_id", "page_no")
    return _bigint(pages.routed(_raw(spark, d), special, "version_id", "page_no"), "page_no")


def o01_page_range(spark, d):
    return _bigint(pages.clamped(_raw(spark, d).select("page_id", *PAGE), "version_id", "page_no", 2, 5).select("page_id", "page_no"), "page_no")


def d08_blocks(spark, d):
    return pages.blocks_of_pages(_raw(spark, d), "page_id", "page_no", "raw_text", "extraction")


# --- tables -------------------------------------------------------------------------------------------------


def _lines(spark, d):
    return pages.lines_of(_raw(spark, d), ["page_id"], "raw_text")


def t03_table_rows(spark, d):
    out = tables.table_rows(_lines(spark, d), ["page_id"])
    return _bigint(out.withColumn("cells", F.array_join("cells", "\x1f")), "table_no", "row_no")


def t09_even_columns(spark, d):
    return _bigint(tables.columns_evened(_lines(spark, d), ["page_id"]), "line_no")


def t08_data_headers(spark, d):
    return _bigint(tables.data_headers_repaired(_lines(spark, d), ["page_id"]), "line_no")


def t01_rendered(spark, d):
    rows = tables.table_rows(_lines(spark, d), ["page_id"])
    grid = F.array_sort(F.collect_list(F.struct("row_no", "cells")))
    return _bigint(rows.groupBy("page_id", "table_no").agg(grid.alias("g")).select("page_id", "table_no", tables.rendered(F.transform("g", lambda x: x["cells"])).alias("markdown")), "table_no")


def t11_hoisted_titles(spark, d):
    return _bigint(tables.titles_hoisted(_lines(spark, d), ["page_id"]), "line_no")


def t12_false_tables(spark, d):
    return _bigint(tables.false_tables(_lines(spark, d), ["page_id"]), "first_line", "last_line")


def t13_flat_tables(spark, d):
    return _bigint(tables.false_tables_flat(_lines(spark, d), ["page_id"]), "line_no")


def w09_marked_headings(spark, d):
    return _bigint(tables.headings_marked(_lines(spark, d), ["page_id"]), "line_no")


def _blocks(spark, d):
    return pages.page_blocks(table(spark, d, "extracted_docs"), "extract_id", "extracted_text")


def t16_continued_tables(spark, d):
    lines = pages.lines_of(_blocks(spark, d), ["extract_id", "page_no"], "block")
    return _bigint(tables.tables_continued(lines, "extract_id", "page_no"), "page_no", "line_no")


def t20_finished(spark, d):
    lines = pages.lines_of(_blocks(spark, d), ["extract_id", "page_no"], "block")
    return tables.finished_texts(lines, "extract_id", "page_no")


def l05_normalised(spark, d):
    return tables.normalised_markdown(_raw(spark, d), "page_id", "raw_text")


def l06_marked_pages(spark, d):
    """The deliveries of each version as a parser's pages, in the order of their ids."""
    return pages.marked_pages(_raw(spark, d).where("version_id IS NOT NULL"), "version_id", "page_no", "raw_text", "page_id")


# --- boxes --------------------------------------------------------------------------------------------------


def _boxes(spark, d):
    return table(spark, d, "ocr_boxes")


def a08_box_extents(spark, d):
    out = boxes.measured(_boxes(spark, d)).select("box_id", "x_center", "y_center", "height", "width")
    return out.withColumns({c: F.round(c, 4) for c in out.columns[1:]})


def o06_distinct_boxes(spark, d):
    return boxes.distinct_boxes(_boxes(spark, d), PAGE, "box_id").select("box_id")


def p39_readable_boxes(spark, d):
    return boxes.readable(_boxes(spark, d), least=0.25).select("box_id")


def a10_box_gaps(spark, d):
    out = boxes.page_heights(_boxes(spark, d).dropna(subset=["x0", "y0", "x1", "y1"]), PAGE)
    return _bigint(out.withColumns({c: F.round(c, 4) for c in ("row_gap", "line_gap")}), "page_no")


def j03_boxes_outside(spark, d):
    """Boxes that overlap none of the badly recognised boxes of their page."""
    b = _boxes(spark, d)
    return boxes.outside(b.where("conf IS NULL OR conf >= 0.4"), b.where("conf < 0.4"), PAGE).select("box_id")


def j07_nearest_columns(spark, d):
    """Every box with the nearest of its page's columns: the distinct left edges, on a grid of 50."""
    b = boxes.measured(_boxes(spark, d)).where("x_center IS NOT NULL")
    centers = b.groupBy(*PAGE).agg(F.array_sort(F.collect_set(F.floor(F.col("x0") / 50) * 50.0)).alias("centers"))
    return b.join(centers, PAGE).select("box_id", boxes.nearest_column(F.col("x_center"), F.col("centers")).cast("bigint").alias("column_no"))


def w07_page_grids(spark, d):
    return boxes.page_tables(_boxes(spark, d), PAGE)


def w10_reading_order(spark, d):
    return boxes.in_reading_order(_boxes(spark, d), PAGE)


def o09_corners(spark, d):
    """The corners of each box, given from the lower right one on and without order."""
    p = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    c = boxes.clockwise(F.array(p("x1", "y1"), p("x0", "y1"), p("x1", "y0"), p("x0", "y0")))
    rows = _boxes(spark, d).dropna(subset=["x0", "y0", "x1", "y1"]).select("box_id", c.alias("c"))
    return rows.select("box_id", *(F.col("c")[i][k].alias(f"{k}{i + 1}") for i in range(4) for k in ("x", "y")))


def q_p21_doubtful_boxes(spark, d):
    return _boxes(spark, d).where(suspicious_signs(clean_line(F.coalesce("box_text", F.lit(""))))).select("box_id")


def u14_better_texts(spark, d):
    """Of the box texts written first and last at a place the better one."""
    rows = _boxes(spark, d).groupBy(*PAGE, "box_no").agg(F.min_by("box_text", "box_id").alias("a"), F.max_by("box_text", "box_id").alias("b"))
    return _bigint(rows.select(*PAGE, "box_no", better_text(F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))).alias("text")), "page_no", "box_no")


def u02_first_texts(spark, d):
    """Of a page's deliveries, in the order of their ids, the first that says something."""
    rows = _raw(spark, d).groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("page_id", F.coalesce("raw_text", F.lit("")).alias("t")))).alias("r"))
    return _bigint(rows.select(*PAGE, first_text(F.transform("r", lambda x: x["t"])).alias("text")), "page_no")


def u13_crop_texts(spark, d):
    rows = _boxes(spark, d).groupBy(*PAGE, "box_no").agg(F.min_by("box_text", "box_id").alias("a"), F.max_by("box_text", "box_id").alias("b"))
    return _bigint(rows.select(*PAGE, "box_no", layers.crop_text(F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))).alias("text")), "page_no", "box_no")


def u07_recognised(spark, d):
    """The boxes of each page written as a recogniser's nested result, and read from it again."""
    p = lambda x, y: F.array(F.col(x), F.col(y))
    item = F.struct(F.array(p("x0", "y0"), p("x1", "y0"), p("x1", "y1"), p("x0", "y1")).alias("box"), F.coalesce("box_text", F.lit("")).alias("text"))
    rows = _boxes(spark, d).dropna(subset=["x0", "y0", "x1", "y1"]).select("box_id", F.to_json(F.struct(F.array(item).alias("page"))).alias("r"))
    return _bigint(boxes.recognised(rows, "box_id", "r"), "box_no")


def j08_manual_routes(spark, d):
    """The pages of a manual list instead of the detected ones, for each version."""
    detected = pages.table_pages(pages.classified(_signals(spark, d)), "version_id", "page_no")
    return _bigint(pages.route_override(detected, "4,6,8-10", "version_id", "page_no", _raw(spark, d)), "page_no")


def a13_box_texts(spark, d):
    return boxes.page_texts(_boxes(spark, d), PAGE)


QUERIES = {
    f.__name__: f
    for f in (
        s12_text_probe, p22_bad_layers, a06_layer_reports, p24_dropped_layers, a03_documents_to_recognise, p26_table_heavy, a01_page_metrics, a04_keyword_scores, p29_page_classes, w02_table_pages, w01_page_runs,
        j04_routes, o01_page_range, o02_page_indices, q_p29_layout_reasons, a12_raster_scores, d08_blocks, t03_table_rows, t09_even_columns, t08_data_headers, t01_rendered, t11_hoisted_titles, t12_false_tables, t13_flat_tables, w09_marked_headings, t16_continued_tables,
        t20_finished, l05_normalised, l06_marked_pages, o09_corners, q_p21_doubtful_boxes, u14_better_texts, u02_first_texts, u13_crop_texts, u07_recognised, j08_manual_routes, a08_box_extents, o06_distinct_boxes, p39_readable_boxes, a10_box_gaps, j03_boxes_outside, j07_nearest_columns, w07_page_grids, w10_reading_order, a13_box_texts,
    )
}
#: Names that begin with p and a number are kept for the training-data queries.
QUERIES = {("q_" + n if n[0] == "p" and n[1].isdigit() else n): f for n, f in QUERIES.items()}

_TEXT = sql.strip("coalesce(raw_text, '')")
_NOISE = " + ".join(f"contains(s, {sql.q(x)})::INT" for x in layers.NOISE)
_count = lambda p, x="s": f"len(regexp_extract_all({x}, {sql.q(p)}))"
_words = lambda p: f"len(list_filter(regexp_extract_all(s, '[\\p{{L}}\\p{{N}}\\p{{M}}_]+'), lambda x: regexp_full_match(x, {sql.q(p)})))"
_found = lambda values: f"list_filter([{', '.join(map(sql.q, values))}], lambda x: contains(k, x))"
_SIG = """sig AS (SELECT * EXCLUDE (rn) FROM (SELECT *, page_number AS page_no, row_number() OVER (PARTITION BY version_id, page_number ORDER BY scanned_at DESC, text_chars DESC, raster_line_score DESC, raster_form_score DESC, vector_line_count DESC, keyword_score DESC, form_score DESC) AS rn
      FROM page_signals WHERE version_id IS NOT NULL AND page_number IS NOT NULL) WHERE rn = 1),
    tab AS (SELECT *, ((coalesce(keyword_score, 0) >= 3 AND (coalesce(vector_line_count, 0) >= 8 OR coalesce(raster_line_score, 0) >= 0.30)) OR coalesce(vector_line_count, 0) >= 45 OR coalesce(raster_line_score, 0) >= 0.70) AS t FROM sig),
    cls AS (SELECT version_id, page_no, t, (NOT t AND ((coalesce(form_score, 0) >= 5 AND (coalesce(raster_form_score, 0) >= 0.25 OR coalesce(vector_line_count, 0) >= 8 OR coalesce(text_chars, 0) > 80)) OR (coalesce(raster_form_score, 0) >= 0.80 AND coalesce(raster_vertical_lines, 0) < 5))) AS f,
      (t OR coalesce(vector_line_count, 0) >= 25 OR (coalesce(raster_line_score, 0) >= 0.55 AND coalesce(raster_vertical_lines, 0) >= 3) OR (coalesce(keyword_score, 0) >= 2 AND (coalesce(vector_line_count, 0) >= 10 OR coalesce(raster_line_score, 0) >= 0.30))) AS c FROM tab),
    isl AS (SELECT *, page_no - row_number() OVER (PARTITION BY version_id, c ORDER BY page_no) AS i FROM cls),
    tp AS (SELECT version_id, page_no FROM (SELECT *, max(t) OVER (PARTITION BY version_id, c, i) AS a FROM isl) WHERE f OR (c AND a))"""
_SEP, _ROWP = r"^[\s]*\|?[\s]*:?-{2,}:?[\s]*(\|[\s]*:?-{1,}:?[\s]*)+\|?[\s]*$".replace("[\\s]", sql.WS), rf"^{sql.WS}*\|.*\|{sql.WS}*$"
_CELLS = f"list_transform(string_split(regexp_replace(regexp_replace({sql.strip('line')}, '^\\|', ''), '\\|$', ''), '|'), lambda x: {sql.strip(sql.rx('x', sql.WS + '+', ' '))})"
_BLOCKS = f"""l AS (SELECT page_id, line_no, line FROM {sql.lines('raw_pages', 'page_id', 'raw_text')}),
    a AS (SELECT *, {sql.matches('line', _SEP)} AS sep, ({sql.matches('line', _ROWP)} AND NOT {sql.matches('line', _SEP)}) AS isrow FROM l),
    g AS (SELECT *, sum((NOT (sep OR isrow))::INT) OVER (PARTITION BY page_id ORDER BY line_no) AS gap FROM a),
    b AS (SELECT *, CASE WHEN (sep OR isrow) AND max(isrow::INT) OVER (PARTITION BY page_id, gap ORDER BY line_no) = 1 THEN gap END AS block, {_CELLS} AS cells FROM g)"""
_MEASURED = "(least(x0, x1) + greatest(x0, x1)) / 2 AS x_center, (least(y0, y1) + greatest(y0, y1)) / 2 AS y_center, greatest(1.0, greatest(y0, y1) - least(y0, y1)) AS height, greatest(1.0, greatest(x0, x1) - least(x0, x1)) AS width"
_REASON = lambda name, found, most, when: f"CASE WHEN {when} THEN {sql.q(name)} || array_to_string({found}[1:{most}], ',') END"

_PLAIN_BOX = plain.plain_line_sql("coalesce(box_text, '')")
_SPLIT = "string_split(replace(replace(coalesce(raw_text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))"
_ESCAPED = lambda x: sql.strip(sql.rx(f"replace(replace(coalesce({x}, ''), chr(10), '<br>'), '|', {sql.q(chr(92) + '|')})", sql.WS + "+", " "))
_STARRED = f"list_transform({_CELLS}, lambda x: regexp_replace(x, '^[ *]+|[ *]+$', '', 'g'))"
_WORDS = lambda x: f"len(regexp_split_to_array({x}, {sql.q(sql.WS + '+')}))"
_LIST = lambda values: "[" + ", ".join(map(sql.q, values)) + "]"
_FALSE = f"""l AS (SELECT page_id, line_no, line FROM {sql.lines('raw_pages', 'page_id', 'raw_text')}),
    p AS (SELECT *, contains(line, '|') AND NOT starts_with({sql.strip('line')}, '<!--') AS p FROM l),
    g AS (SELECT *, sum((NOT p)::INT) OVER (PARTITION BY page_id ORDER BY line_no) AS g FROM p),
    c AS (SELECT *, {sql.matches('line', _SEP)} AS sep, {_STARRED} AS cells FROM g WHERE p),
    r AS (SELECT *, list_filter(cells[2:], lambda c: c <> '') AS filled FROM c),
    s AS (SELECT page_id, g, min(line_no) AS first_line, max(line_no) AS last_line, count(*) AS n, bool_or(sep) AS has,
        max(len(cells)) FILTER (NOT sep) AS columns, bool_or(len(list_filter({_LIST(tables.HINTS)}, lambda h: contains(lower(array_to_string(cells, ' ')), h))) > 0) FILTER (NOT sep) AS hint,
        sum(len(list_filter(cells, lambda c: c = ''))) FILTER (NOT sep) AS empty, sum(len(cells)) FILTER (NOT sep) AS every,
        sum({sql.matches('cells[1]', rf'(?i)^([0-9]+([.][0-9]+)*[.]?{sql.WS}+|[a-zA-Zà-ỹ][.]|[IVXLCDM]+[.])')}::INT) FILTER (NOT sep) AS marks,
        sum(len(list_filter(filled, lambda c: {_WORDS('c')} <= 2))) FILTER (NOT sep) AS short, sum(len(filled)) FILTER (NOT sep) AS right_ FROM r GROUP BY page_id, g),
    ft AS (SELECT page_id, first_line, last_line, coalesce(NOT hint AND columns <= 2 AND (empty / greatest(every, 1) >= 0.35 OR marks >= 1 OR short / greatest(right_, 1) >= 0.7), false) AS is_false FROM s WHERE n >= 2 AND has)"""
_HEADED = " OR ".join(sql.matches("s", x) for x in (
    rf"^CHƯƠNG{sql.WS}+[IVXLCDM]+([^\p{{L}}\p{{M}}\p{{N}}_]|$)", rf"^Chương{sql.WS}+[IVXLCDM]+([^\p{{L}}\p{{M}}\p{{N}}_]|$)", rf"^Điều{sql.WS}+\p{{Nd}}+[.]?{sql.WS}+", rf"^PHỤ LỤC{sql.WS}+",
    r"^QUYẾT ĐỊNH([^\p{L}\p{M}\p{N}_]|$)", r"^QUY ĐỊNH([^\p{L}\p{M}\p{N}_]|$)", r"^QUY TRÌNH([^\p{L}\p{M}\p{N}_]|$)"))
_ANY = lambda values: f"len(list_filter({_LIST(values)}, lambda w: contains(k, w))) > 0"
_NAMED = lambda first: f"list_transform(range({first}, n + 1), lambda i: 'Cột ' || i)"
_ROWN = "'| ' || array_to_string(CASE WHEN len({c}) > w THEN list_concat({c}[1:w - 1], [array_to_string({c}[w:], ' ')]) ELSE list_resize({c}, w, '') END, ' | ') || ' |'"

SQL = {
    "s12_text_probe": f"SELECT version_id, sum(CASE WHEN page_no <= 3 THEN length({_TEXT}) ELSE 0 END) >= 80 AS has_text FROM raw_pages GROUP BY version_id",
    "q_p22_bad_layers": f"""SELECT page_id, (length({_TEXT}) < 50 OR ({_NOISE}) >= 3 OR ({_count('[~}{' + chr(92) + ']' + chr(92) + '[)(]')} >= 8 AND marks < 0.04) OR ({_words('[A-ZĐ]{8,}')} >= 5 AND marks < 0.05)) AS is_bad
        FROM (SELECT *, {_count(layers.MARKED)}::DOUBLE / greatest({_count(layers.LETTER)}, 1) AS marks FROM (SELECT *, coalesce(raw_text, '')[1:3000] AS s FROM raw_pages))""",
    "q_p26_table_heavy": f"""SELECT version_id, round(avg((length(s) <= 30)::INT), 6) AS short_ratio, round(avg(regexp_matches(s, '[0-9]')::INT), 6) AS number_ratio,
        avg((length(s) <= 30)::INT) > 0.45 AND avg(regexp_matches(s, '[0-9]')::INT) > 0.35 AS table_heavy
        FROM (SELECT version_id, page_no, {sql.strip('line')} AS s FROM {sql.lines('raw_pages', 'version_id, page_no', 'raw_text')}) WHERE page_no <= 3 AND s <> '' GROUP BY version_id""",
    "a01_page_metrics": f"SELECT version_id, count(*) AS total_pages, sum(length({sql.clean_text('raw_text')})) AS total_characters, count(*) FILTER (extraction = 'pymupdf_text') AS text_pages, count(*) FILTER (extraction = 'ocr_pdf_scan') AS ocr_pages, sum(len(list_filter({_SPLIT}, lambda l: {sql.matches('l', _SEP)}))) AS n_tables FROM raw_pages GROUP BY version_id",
    "a04_keyword_scores": f"""WITH k AS (SELECT page_id, coalesce(raw_text, '') AS r, {sql.clean_line("lower(coalesce(raw_text, ''))")} AS k FROM raw_pages),
        f AS (SELECT *, {_found(pages.TABLE_PHRASES)} AS st, {_found(pages.TABLE_HEADERS)} AS he, {_found(pages.FORM_PHRASES)} AS fo, {_found(pages.FORM_FIELDS)} AS fi, (contains(k, 'hồ sơ đạt') AND contains(k, 'hồ sơ không đạt')) AS fl, {_count(chr(92) + '.{6,}', 'r')} AS dots FROM k)
        SELECT page_id, (CASE WHEN len(st) > 0 THEN 2 + len(st) ELSE 0 END + CASE WHEN len(he) >= 3 THEN len(he) ELSE 0 END + CASE WHEN fl THEN 2 ELSE 0 END) AS keyword_score,
        (CASE WHEN len(fo) > 0 THEN 2 + len(fo) ELSE 0 END + CASE WHEN len(fi) >= 3 THEN len(fi) ELSE 0 END + CASE WHEN dots >= 3 THEN least(dots, 8) ELSE 0 END) AS form_score,
        array_to_string(list_filter([{_REASON('keyword_table_strong:', 'st', 4, 'len(st) > 0')}, {_REASON('many_table_header_terms:', 'he', 6, 'len(he) >= 3')}, CASE WHEN fl THEN 'flowchart_decision_labels' END,
          {_REASON('form_strong:', 'fo', 4, 'len(fo) > 0')}, {_REASON('form_fields:', 'fi', 6, 'len(fi) > 0')}, CASE WHEN dots >= 3 THEN 'many_dot_leaders:' || dots END], lambda x: x IS NOT NULL), ';') AS reasons FROM f""",
    "q_p29_page_classes": f"WITH {_SIG} SELECT version_id, page_no, t AS likely_table, f AS likely_form, c AS continues FROM cls",
    "w02_table_pages": f"WITH {_SIG} SELECT version_id, page_no FROM tp",
    "w01_page_runs": f"WITH {_SIG} SELECT version_id, min(page_no) AS first_page, max(page_no) AS last_page, count(*) AS n_pages FROM (SELECT *, page_no - row_number() OVER (PARTITION BY version_id ORDER BY page_no) AS i FROM tp) GROUP BY version_id, i",
    "j04_routes": f"WITH {_SIG} SELECT r.version_id, r.page_no, CASE WHEN tp.page_no IS NOT NULL THEN 'cloud' ELSE 'local' END AS route FROM (SELECT DISTINCT version_id, page_no FROM raw_pages) r LEFT JOIN tp USING (version_id, page_no)",
    "o01_page_range": "SELECT page_id, page_no FROM (SELECT *, max(page_no) OVER (PARTITION BY version_id) AS n FROM raw_pages) WHERE page_no BETWEEN greatest(1, least(2, n)) AND greatest(greatest(1, least(2, n)), least(5, n))",
    "t03_table_rows": f"""WITH {_BLOCKS}, t AS (SELECT *, min(line_no) OVER (PARTITION BY page_id, block) AS first FROM b WHERE block IS NOT NULL),
        n AS (SELECT *, dense_rank() OVER (PARTITION BY page_id ORDER BY first) AS table_no FROM t),
        h AS (SELECT *, coalesce(lead(sep) OVER (PARTITION BY page_id, table_no ORDER BY line_no), false) AND isrow AS is_header FROM n)
        SELECT page_id, table_no, row_number() OVER (PARTITION BY page_id, table_no ORDER BY line_no) AS row_no, is_header, array_to_string(cells, chr(31)) AS cells FROM h WHERE isrow""",
    "t09_even_columns": f"""WITH {_BLOCKS}, w AS (SELECT *, max(CASE WHEN isrow THEN len(cells) END) OVER (PARTITION BY page_id, block) AS n, count(*) OVER (PARTITION BY page_id, block) AS size FROM b)
        SELECT page_id, line_no, CASE WHEN block IS NULL OR size < 2 THEN line WHEN sep THEN '| ' || array_to_string(list_resize(['---'], n, '---'), ' | ') || ' |' ELSE '| ' || array_to_string(list_resize(cells, n, ''), ' | ') || ' |' END AS line FROM w""",
    "a08_box_extents": f"SELECT box_id, round(x_center, 4) AS x_center, round(y_center, 4) AS y_center, round(height, 4) AS height, round(width, 4) AS width FROM (SELECT box_id, {_MEASURED} FROM ocr_boxes)",
    "o06_distinct_boxes": "SELECT min(box_id) AS box_id FROM ocr_boxes GROUP BY version_id, page_no, round_even(x0, 0), round_even(y0, 0), round_even(x1, 0), round_even(y1, 0)",
    "q_p39_readable_boxes": f"SELECT box_id FROM ocr_boxes WHERE {sql.clean_line('box_text')} <> '' AND (conf IS NULL OR conf >= 0.25)",
    "a10_box_gaps": f"SELECT version_id, page_no, round(greatest(12.0, avg(height) * 0.8), 4) AS row_gap, round(greatest(8.0, list_sort(list(height))[(count(*) // 2) + 1] * 0.65), 4) AS line_gap FROM (SELECT version_id, page_no, {_MEASURED} FROM ocr_boxes WHERE x0 IS NOT NULL AND y0 IS NOT NULL AND x1 IS NOT NULL AND y1 IS NOT NULL) GROUP BY ALL",
    "j03_boxes_outside": "SELECT box_id FROM ocr_boxes a WHERE (conf IS NULL OR conf >= 0.4) AND NOT EXISTS (SELECT 1 FROM ocr_boxes b WHERE b.conf < 0.4 AND a.version_id = b.version_id AND a.page_no = b.page_no AND NOT (a.x1 < b.x0 OR b.x1 < a.x0 OR a.y1 < b.y0 OR b.y1 < a.y0))",
    "j07_nearest_columns": f"""WITH m AS (SELECT box_id, version_id, page_no, x0, {_MEASURED} FROM ocr_boxes), c AS (SELECT version_id, page_no, list_sort(list_distinct(list(floor(x0 / 50) * 50.0))) AS centers FROM m WHERE x_center IS NOT NULL GROUP BY ALL),
        x AS (SELECT box_id, x_center, unnest(centers) AS center, unnest(range(len(centers))) AS i FROM m JOIN c USING (version_id, page_no) WHERE x_center IS NOT NULL)
        SELECT box_id, arg_min(i, (abs(x_center - center), i)) AS column_no FROM x GROUP BY box_id""",
    "q_p29_layout_reasons": f"""WITH {_SIG} SELECT version_id, page_no, array_to_string(list_filter([CASE WHEN vector_line_count >= 20 THEN 'many_vector_lines:' || vector_line_count END,
        CASE WHEN raster_line_score >= 0.45 THEN 'raster_table_score:' || printf('%.2f', raster_line_score) END, CASE WHEN raster_form_score >= 0.45 THEN 'raster_form_score:' || printf('%.2f', raster_form_score) END,
        CASE WHEN coalesce(raster_horizontal_lines, 0) <> 0 OR coalesce(raster_vertical_lines, 0) <> 0 THEN 'raster_lines:h' || coalesce(raster_horizontal_lines, 0) || '/v' || coalesce(raster_vertical_lines, 0) END], lambda x: x IS NOT NULL), ';') AS reasons FROM sig""",
    "a12_raster_scores": f"""WITH {_SIG}, h AS (SELECT version_id, page_no, coalesce(raster_horizontal_lines, 0) AS h, coalesce(raster_vertical_lines, 0) AS v FROM sig)
        SELECT version_id, page_no, round(CASE WHEN h >= 4 AND v >= 3 THEN least(h / 18.0, 1.0) * 0.45 + least(v / 12.0, 1.0) * 0.55 ELSE least(h / 30.0, 0.25) + least(v / 20.0, 0.20) END, 6)::DOUBLE AS table_score,
        round(CASE WHEN h < 6 THEN 0.0 WHEN v >= 3 THEN least(least(h / 18.0, 1.0) + 0.15, 1.0) ELSE least(h / 18.0, 1.0) END, 6)::DOUBLE AS form_score FROM h""",
    "o02_page_indices": "SELECT version_id, unnest(range(2, greatest(3, least(6, n)))) AS page_index FROM (SELECT version_id, max(page_no) AS n FROM raw_pages GROUP BY version_id)",
    "l06_marked_pages": f"""SELECT version_id, string_agg({sql.strip("'<!-- page: ' || coalesce(nullif(page_no, 0), page_id) || ' -->' || chr(10) || chr(10) || " + _TEXT)}, chr(10) || chr(10) ORDER BY page_id) || chr(10) AS body FROM raw_pages WHERE version_id IS NOT NULL GROUP BY version_id""",
    "o09_corners": "SELECT box_id, least(x0, x1) AS x1, least(y0, y1) AS y1, greatest(x0, x1) AS x2, least(y0, y1) AS y2, greatest(x0, x1) AS x3, greatest(y0, y1) AS y3, least(x0, x1) AS x4, greatest(y0, y1) AS y4 FROM ocr_boxes WHERE x0 IS NOT NULL AND y0 IS NOT NULL AND x1 IS NOT NULL AND y1 IS NOT NULL",
    "q_p21_doubtful_boxes": f"SELECT box_id FROM ocr_boxes WHERE {sql.matches(sql.clean_line('box_text'), '(?i)[?]|Email|ĐT|Điện thoại|www|http|[(]Q| Q[A-Za-z0-9]|[A-Za-z0-9._%+-]+ +[QO0] *[A-Za-z0-9.-]+[.](vn|com|edu[.]vn)')}",
    "u14_better_texts": f"""WITH x AS (SELECT version_id, page_no, box_no, {sql.clean_line('arg_min(box_text, box_id)')} AS a, {sql.clean_line('arg_max(box_text, box_id)')} AS b FROM ocr_boxes GROUP BY ALL)
        SELECT version_id, page_no, box_no, CASE WHEN a = '' THEN b WHEN b = '' THEN a WHEN contains(b, '@') AND NOT contains(a, '@') THEN b
          WHEN length(a) - length(replace(a, '?', '')) > length(b) - length(replace(b, '?', '')) THEN b WHEN length(b) > length(a) + 5 AND NOT contains(b, '?') THEN b ELSE a END AS text FROM x""",
    "u02_first_texts": f"SELECT version_id, page_no, coalesce(arg_min(t, page_id) FILTER (t <> ''), '') AS text FROM (SELECT *, {sql.clean_text('raw_text')} AS t FROM raw_pages) GROUP BY version_id, page_no",
    "a13_box_texts": f"""SELECT version_id, page_no, string_agg(t, chr(10) ORDER BY box_no, t) AS text FROM (SELECT version_id, page_no, box_no, {_PLAIN_BOX} AS t FROM ocr_boxes) WHERE t <> '' GROUP BY version_id, page_no""",
    "t12_false_tables": f"WITH {_FALSE} SELECT page_id, first_line, last_line, is_false FROM ft",
    "t13_flat_tables": f"""WITH {_FALSE}, j AS (SELECT l.*, ft.first_line IS NOT NULL AS flat, {sql.matches('line', _SEP)} AS sep, array_to_string(list_filter({_STARRED}, lambda c: c <> ''), ' ') AS plain FROM l LEFT JOIN ft ON l.page_id = ft.page_id AND ft.is_false AND line_no BETWEEN ft.first_line AND ft.last_line)
        SELECT page_id, line_no, CASE WHEN flat THEN plain ELSE line END AS line FROM j WHERE NOT flat OR (NOT sep AND plain <> '')""",
    "w09_marked_headings": f"""WITH l AS (SELECT page_id, line_no, line, {sql.strip('line')} AS s FROM {sql.lines('raw_pages', 'page_id', 'raw_text')}),
        i AS (SELECT *, last_value(CASE WHEN {sql.matches('s', '^[|]?.+[|]')} THEN true WHEN s = '' THEN false END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS inside FROM l)
        SELECT page_id, line_no, CASE WHEN ({_HEADED}) AND NOT coalesce(inside, false) AND NOT starts_with(s, '#') THEN '## ' || s ELSE line END AS line FROM i""",
    "t01_rendered": f"""WITH {_BLOCKS}, t AS (SELECT *, min(line_no) OVER (PARTITION BY page_id, block) AS first FROM b WHERE block IS NOT NULL),
        n AS (SELECT page_id, line_no, dense_rank() OVER (PARTITION BY page_id ORDER BY first) AS table_no, list_transform(cells, lambda x: {_ESCAPED('x')}) AS cells FROM t WHERE isrow),
        k AS (SELECT page_id, table_no, list(cells ORDER BY line_no) FILTER (len(list_filter(cells, lambda x: x <> '')) > 0) AS rows FROM n GROUP BY page_id, table_no),
        w AS (SELECT *, list_max(list_transform(rows, lambda r: len(r))) AS n FROM k),
        m AS (SELECT *, list_transform(rows, lambda r: '| ' || array_to_string(list_resize(r, n, ''), ' | ') || ' |') AS lines, '| ' || array_to_string(list_resize(['---'], n, '---'), ' | ') || ' |' AS sep FROM w)
        SELECT page_id, table_no, CASE WHEN rows IS NULL OR len(rows) = 0 THEN '' WHEN len(rows) = 1 THEN '| ' || array_to_string({_NAMED('1')}, ' | ') || ' |' || chr(10) || sep || chr(10) || lines[1]
          ELSE lines[1] || chr(10) || sep || chr(10) || array_to_string(lines[2:], chr(10)) END AS markdown FROM m""",
    "t08_data_headers": f"""WITH l AS (SELECT page_id, line_no, line FROM {sql.lines('raw_pages', 'page_id', 'raw_text')}),
        a AS (SELECT *, {_CELLS} AS cells, {sql.matches('line', _SEP)} AS sep, {sql.matches('line', _ROWP)} AND NOT {sql.matches('line', _SEP)} AS isrow FROM l),
        h AS (SELECT *, isrow AND coalesce(lead(sep) OVER w, false) AND len(cells) >= 3 AND regexp_matches(coalesce(cells[1], ''), '(?i)^([0-9]{{1,3}}|[IVXLCDM]+)$') AND {_WORDS("coalesce(cells[2], '')")} >= 3
            AND {sql.matches("array_to_string(cells, ' ')", rf'(?i)(^|[^\p{{L}}\p{{M}}\p{{N}}_])({tables.ACTIONS})([^\p{{L}}\p{{M}}\p{{N}}_]|$)')} AS h FROM a WINDOW w AS (PARTITION BY page_id ORDER BY line_no)),
        x AS (SELECT *, len(cells) AS n, {sql.match_key("array_to_string(cells, ' ')")} AS k, coalesce(lag(h) OVER (PARTITION BY page_id ORDER BY line_no), false) AS after FROM h),
        g AS (SELECT *, CASE WHEN n = 6 AND {_ANY(tables.DISCIPLINE)} THEN ['TT', 'Nội dung vi phạm', 'Lần 1', 'Lần 2', 'Lần 3', 'Ghi chú'] WHEN n >= 10 AND {_ANY(tables.REPORT)} THEN {_NAMED('1')}
            WHEN n >= 3 THEN list_concat(['TT', 'Nội dung'], {_NAMED('3')}) ELSE {_NAMED('1')} END AS header FROM x WHERE NOT after),
        w AS (SELECT *, greatest(len(header), n) AS w FROM g),
        e AS (SELECT page_id, line_no, unnest([1, 2, 3]) AS sub, unnest(CASE WHEN h THEN [{_ROWN.format(c='header')}, '| ' || array_to_string(list_resize(['---'], w, '---'), ' | ') || ' |', {_ROWN.format(c='cells')}] ELSE [line, NULL, NULL] END) AS line, h FROM w)
        SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY line_no, sub) AS line_no, line FROM e WHERE h OR sub = 1""",
    "u07_recognised": "SELECT box_id, 1 AS box_no, least(x0, x1) AS x0, least(y0, y1) AS y0, greatest(x0, x1) AS x1, greatest(y0, y1) AS y1, nullif(box_text, '') AS box_text FROM ocr_boxes WHERE x0 IS NOT NULL AND y0 IS NOT NULL AND x1 IS NOT NULL AND y1 IS NOT NULL",
    "j08_manual_routes": "SELECT version_id, unnest([4, 6, 8, 9, 10]) AS page_no FROM (SELECT DISTINCT version_id FROM raw_pages)",
}
SQL["d08_blocks"] = f"""SELECT page_id, '## Trang ' || page_no || chr(10) || chr(10) || '<!-- page: ' || page_no || ' -->' || chr(10) || chr(10) || '<!-- extraction: '
    || coalesce(extraction, CASE WHEN length({sql.clean_text('raw_text')}) >= 30 THEN 'pymupdf_text' ELSE 'ocr_pdf_scan' END) || ' -->' || chr(10) || chr(10) || text || chr(10) || chr(10) || '---' AS block
    FROM raw_pages JOIN ({texts.SQL['l02_markdown']}) m USING (page_id)"""
