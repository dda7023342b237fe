"""Queries of the plain formatter."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import plain as P
from foliant.functions.text import clean_line
from foliant.operators import pages, plain
from foliant.plans import sql
from foliant.session import table


def _raw(spark, d):
    return table(spark, d, "raw_pages").select("page_id", "version_id", "page_no", "raw_text")


def _lines(spark, d):
    rows = pages.lines_of(_raw(spark, d), ["page_id"], "raw_text")
    return rows.select("page_id", F.col("line_no").cast("bigint").alias("line_no"), P.composed(F.col("line")).alias("line"))


def f02_plain_texts(spark, d):
    return _raw(spark, d).select("page_id", P.composed(F.coalesce("raw_text", F.lit(""))).alias("t")).select("page_id", P.plain_text(F.col("t")).alias("text"))


def f04_plain_lines(spark, d):
    return _lines(spark, d).select("page_id", "line_no", P.plain_line(F.col("line")).alias("line"))


def f18_plain_rules(spark, d):
    return _raw(spark, d).select("page_id", P.composed(F.coalesce("raw_text", F.lit(""))).alias("t")).select("page_id", P.plain_rules(F.col("t")).alias("text"))


def f28_plain_layers(spark, d):
    return _raw(spark, d).select("page_id", P.composed(F.coalesce("raw_text", F.lit(""))).alias("t")).select("page_id", P.plain_layers(F.col("t")).alias("text"))


def plain_flags(spark, d):
    """Of each line what decides about joining it."""
    c = F.col("c")
    rows = _lines(spark, d).select("page_id", "line_no", P.plain_line(F.col("line")).alias("c"))
    return rows.select("page_id", "line_no", P.stands_apart(c).alias("apart"), P.starts_item(c).alias("item"), P.lone_marker(c).alias("lone"), P.major_title(c).alias("major"), P.opens_paragraph(c).alias("opening"))


def plain_joins(spark, d):
    """Would each line be joined to the one before it?"""
    before = F.coalesce(F.expr("lag(c) OVER (PARTITION BY page_id ORDER BY line_no)"), F.lit(""))
    rows = _lines(spark, d).select("page_id", "line_no", P.plain_line(F.col("line")).alias("c")).withColumn("b", before)
    return rows.select("page_id", "line_no", P.joins_plain(F.col("b"), F.col("c")).alias("joins"))


def l03_plain_markdown_lines(spark, d):
    return f04_plain_lines(spark, d).select("page_id", "line_no", P.plain_markdown_line(F.col("line")).alias("markdown"))


def w06_plain_merged(spark, d):
    rows = _raw(spark, d).select("page_id", P.composed(F.coalesce("raw_text", F.lit(""))).alias("t"))
    return plain.with_plain_merged(rows, "t", "text").select("page_id", "text")


def l04_plain_markdown(spark, d):
    return plain.plain_markdown(_raw(spark, d), "page_id", "raw_text")


def l20_extract_lines(spark, d):
    rows = pages.lines_of(_raw(spark, d), ["page_id"], "raw_text").select("page_id", F.col("line_no").cast("bigint").alias("line_no"), clean_line(F.col("line")).alias("c"))
    return rows.select("page_id", "line_no", P.extract_line(F.col("c")).alias("markdown"))


def l21_extract_pages(spark, d):
    return plain.extract_pages_markdown(_raw(spark, d), "page_id", "page_no", "raw_text")


QUERIES = {f.__name__: f for f in (f02_plain_texts, f04_plain_lines, f18_plain_rules, f28_plain_layers, plain_flags, plain_joins, l03_plain_markdown_lines, w06_plain_merged, l04_plain_markdown, l20_extract_lines, l21_extract_pages)}


def _fold(x: str) -> str:
    for a, b in P.SIGNS:
        x = f"replace({x}, {sql.q(a)}, {sql.q(b)})"
    return x


def plain_line_sql(x: str) -> str:
    return sql.strip(sql.rx(_fold(sql.strip(f"nfc_normalize({x})")), sql.WS + "+", " "))


_LINE = plain_line_sql("line")
_TEXT = sql.strip(sql.rx(sql.rx(_fold(sql.rx("nfc_normalize(coalesce(raw_text, ''))", "\r\n?", "\n")), "[ \t]+", " "), "\n{3,}", "\n\n"))
_LINES = sql.lines("raw_pages", "page_id", "raw_text")
_TITLED = lambda titles: f"(upper(c) IN ({', '.join(map(sql.q, titles))}) OR ({sql.any_start('upper(c)', titles)} AND length(c) <= 90 AND NOT {sql.matches('c', '[.,;]$')} AND {sql.upper_ratio('c')} >= 0.65))"
_CAPITALS = f"({sql.matches('c', chr(92) + 'p{Lu}')} AND NOT {sql.matches('c', chr(92) + 'p{Ll}')} AND length(c) <= 80)"
_PART = lambda words, number: sql.matches("c", rf"^({words}){sql.WS}+{number}")
_DIGITS, _ROMAN = r"\p{Nd}+", r"([IVXLCDM]+|\p{Nd}+)"
_APART = f"(c = '' OR {sql.matches('c', '^' + chr(92) + 'p{Nd}+$')} OR {_PART('Điều|ĐIỀU', _DIGITS)} OR {_PART('Chương|CHƯƠNG', _ROMAN)} OR {_PART('Mục|MỤC', _DIGITS)} OR starts_with(upper(c), 'PHỤ LỤC') OR {_TITLED(P.APART)})"
_ITEM = f"({sql.matches('c', rf'^{_DIGITS}[.)]({sql.WS}+.*)?$')} OR {sql.matches('c', rf'^[a-zA-ZđĐ][.)]({sql.WS}+.*)?$')} OR starts_with(c, '- '))"
_LONE = sql.matches("c", rf"^{_DIGITS}[.)]$|^[a-zA-ZđĐ][.)]$|^[-•]$")
_OPENING = sql.matches("c", rf"(?i)^(Căn cứ|Theo đề nghị|QUYẾT ĐỊNH|Điều|Chương|Mục)([^\p{{L}}\p{{M}}\p{{N}}_]|$)")
_FLAGS = f"l AS (SELECT page_id, line_no, {_LINE} AS c FROM {_LINES}), f AS (SELECT *, {_APART} AS apart, {_ITEM} AS item, {_LONE} AS lone, {_TITLED(P.MAJOR)} AS major, {_OPENING} AS opening FROM l)"
_PLAIN = f"""CASE WHEN c = '' THEN '' WHEN {_TITLED(P.MAJOR)} THEN '# ' || c WHEN {_PART('CHƯƠNG|Chương', _ROMAN)} THEN '## ' || c WHEN {_PART('MỤC|Mục|ĐIỀU|Điều', _DIGITS)} THEN '### ' || c
    WHEN {sql.any_start('c', ['Số:', 'Số ', 'Căn cứ'])} THEN '**' || c || '**' WHEN starts_with(c, 'Theo đề nghị') THEN '*' || c || '*'
    WHEN {sql.matches('c', rf'^[a-zA-ZđĐ][)]{sql.WS}+')} THEN '- ' || c WHEN starts_with(c, '- ') THEN c WHEN {_CAPITALS} THEN '# ' || c ELSE c END"""
_EXTRACT = f"""CASE WHEN c = '' THEN '' WHEN {sql.any_start('upper(c)', P.FIRST)} THEN '# ' || c WHEN {_PART('CHƯƠNG|Chương', _ROMAN)} THEN '## ' || c WHEN {_PART('MỤC|Mục|ĐIỀU|Điều', _DIGITS)} THEN '### ' || c
    WHEN {sql.matches('c', rf'^{_DIGITS}[.]{sql.WS}+')} THEN c WHEN {sql.matches('c', rf'^[a-zA-ZđĐ][)]{sql.WS}+')} THEN '- ' || c
    WHEN {sql.any_start('c', ['Số:', 'Số ', 'Căn cứ'])} THEN '**' || c || '**' WHEN starts_with(c, 'Theo đề nghị') THEN '*' || c || '*'
    WHEN {sql.any_start('upper(c)', [x.upper() for x in P.FOOT])} THEN '**' || c || '**' WHEN {_CAPITALS} THEN '# ' || c ELSE c END"""
_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"

SQL = {
    "f02_plain_texts": f"SELECT page_id, {_TEXT} AS text FROM raw_pages",
    "f04_plain_lines": f"SELECT page_id, line_no, {_LINE} AS line FROM {_LINES}",
    "plain_flags": f"WITH {_FLAGS} SELECT page_id, line_no, apart, item, lone, major, opening FROM f",
    "plain_joins": f"""WITH {_FLAGS}, b AS (SELECT *, lag(c, 1, '') OVER w AS b, lag(lone, 1, false) OVER w AS blone, lag(apart, 1, true) OVER w AS bapart FROM f WINDOW w AS (PARTITION BY page_id ORDER BY line_no))
        SELECT page_id, line_no, b <> '' AND c <> '' AND (blone OR (NOT apart AND NOT item AND NOT bapart AND NOT {sql.matches('b', '[.:;!?]$')} AND NOT opening)) AS joins FROM b""",
    "l03_plain_markdown_lines": f"SELECT page_id, line_no, {_PLAIN} AS markdown FROM (SELECT page_id, line_no, {_LINE} AS c FROM {_LINES})",
    "l20_extract_lines": f"SELECT page_id, line_no, {_EXTRACT} AS markdown FROM (SELECT page_id, line_no, {sql.clean_line('line')} AS c FROM {_LINES})",
    "l21_extract_pages": f"""WITH t AS (SELECT page_id, page_no, {sql.strip("coalesce(raw_text, '')")} AS t FROM raw_pages),
        l AS (SELECT page_id, unnest(range(1, len(x) + 1)) AS n, unnest(x) AS line FROM (SELECT page_id, string_split_regex(t, {sql.q(_ENDS)}) AS x FROM t)),
        m AS (SELECT page_id, n, {_EXTRACT} AS m FROM (SELECT page_id, n, {sql.clean_line('line')} AS c FROM l) WHERE c <> ''),
        b AS (SELECT page_id, string_agg(m, chr(10) ORDER BY n) AS body FROM m GROUP BY page_id)
        SELECT t.page_id, '## Trang ' || page_no || chr(10) || chr(10) || CASE WHEN t = '' THEN '[no text on this page]' ELSE coalesce(body, '') END || chr(10) || chr(10) || '---' || chr(10) AS block FROM t LEFT JOIN b USING (page_id)""",
}
