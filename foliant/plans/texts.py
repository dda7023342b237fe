"""Queries over texts and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import lines as L
from foliant.functions import rules, text
from foliant.operators import pages, review
from foliant.plans import sql
from foliant.session import table

RAW = "raw_pages"


def raw(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, RAW)


def raw_lines(spark: SparkSession, d: str, *keys: str) -> DataFrame:
    return pages.lines_of(raw(spark, d), list(keys) or ["page_id"], "raw_text")


def f01_clean_text(spark, d):
    return raw(spark, d).select("page_id", text.clean_text(F.col("raw_text")).alias("text"))


def f03_clean_lines(spark, d):
    return raw_lines(spark, d).select("page_id", F.col("line_no").cast("bigint").alias("line_no"), text.clean_line(F.col("line")).alias("line"))


def f07_match_keys(spark, d):
    return table(spark, d, "doc_meta").select("meta_id", text.match_key(F.col("title")).alias("title_key"), text.match_key(F.col("title"), spaces=False).alias("title_solid"), text.layout_key(F.col("department")).alias("unit_key"))


def f09_file_stems(spark, d):
    return table(spark, d, "doc_meta").select("meta_id", text.safe_stem(F.col("title")).alias("stem"))


def f10_checksums(spark, d):
    return raw(spark, d).select("page_id", F.md5(F.coalesce("raw_text", F.lit("")).cast("binary")).alias("checksum"))


def f29_upper_ratios(spark, d):
    c = F.coalesce("raw_text", F.lit(""))
    return raw(spark, d).select("page_id", F.round(text.upper_ratio(c), 6).alias("upper_ratio"))


def f31_markers(spark, d):
    m = L.marker(text.clean_line(F.col("line")))
    return raw_lines(spark, d).select("page_id", F.col("line_no").cast("bigint").alias("line_no"), m.alias("m")).select("page_id", "line_no", "m.kind", "m.mark", "m.content")


def f32_cells(spark, d):
    return raw(spark, d).select("page_id", text.cell_escape(F.col("raw_text")).alias("cell"))


def f37_page_lists(spark, d):
    docs = table(spark, d, "extracted_docs")
    said = F.array_join(F.transform(F.coalesce("cloud_pages", F.array().cast("array<int>")), lambda p: F.concat(p + 2, F.lit("-"), p)), ",")
    return docs.select("extract_id", F.explode(text.page_list(said)).alias("p")).select("extract_id", F.col("p").cast("bigint").alias("page_no"))


def f39_forms(spark, d):
    return raw(spark, d).select("page_id", text.form_layout(F.coalesce("raw_text", F.lit(""))).alias("text"))


def f17_common_layer(spark, d):
    return raw(spark, d).select("page_id", rules.common_layer(F.col("raw_text")).alias("text"))


def f27_three_layers(spark, d):
    terms = [rules.Rule(r"\bP\.\s*ĐT\b", "P. ĐT"), rules.Rule(r"\bP\.\s*CTSV\b", "P. CTSV")]
    user = rules.user_rules('{"replace": {"pliòng": "phòng"}, "regex_replace": [{"pattern": "(\\\\d+) - (\\\\d+)", "replacement": "\\\\1-\\\\2", "flags": ""}]}')
    return raw(spark, d).select("page_id", rules.three_layers(F.col("raw_text"), True, terms, user).alias("text"))


def l01_headings(spark, d):
    rows, x = pages.analysed(raw_lines(spark, d))
    return rows.select(
        "page_id", F.col("line_no").cast("bigint").alias("line_no"), L.is_article(x).alias("is_article"), L.is_chapter(x).alias("is_chapter"), L.is_section(x).alias("is_section"), L.is_title(x).alias("is_title"),
        L.is_contents(x.c).alias("is_contents"), L.is_process(x).alias("is_process"), F.col("_level").cast("bigint").alias("level"), L.markdown_line(x, F.col("_level")).alias("markdown"),
    )


def line_flags(spark, d):
    rows, x = pages.analysed(raw_lines(spark, d))
    c = x.c
    return rows.select("page_id", F.col("line_no").cast("bigint").alias("line_no"), L.is_structural(x, F.col("_level")).alias("is_structural"), L.is_item(c).alias("is_item"), L.ends_open(c).alias("ends_open"), L.is_page_number(c).alias("is_page_number"), L.is_isolated_marker(c).alias("is_marker"), L.is_watermark(c).alias("is_watermark"))


def a02_repeated_lines(spark, d):
    """Running lines by version, over all its pages; the share is the operator's default."""
    out = pages.repeated_lines(raw_lines(spark, d, "version_id", "page_no"), "version_id", "page_no", pages=raw(spark, d))
    return out.select("version_id", "key", F.col("n_pages").cast("bigint").alias("n_pages"))


def j01_kept_lines(spark, d):
    rows = raw_lines(spark, d, "page_id", "version_id", "page_no")
    repeated = pages.repeated_lines(rows, "version_id", "page_no", pages=raw(spark, d))
    return pages.without_repeated(rows, repeated, "version_id").select("page_id", F.col("line_no").cast("bigint").alias("line_no"), "line")


def w03_bullets(spark, d):
    return pages.bulleted(raw_lines(spark, d), ["page_id"]).select("page_id", F.col("line_no").cast("bigint").alias("line_no"), "line")


def w05_merged_lines(spark, d):
    return pages.merged(raw(spark, d), "page_id", "raw_text")


def l02_markdown(spark, d):
    return pages.markdown(raw(spark, d), "page_id", "raw_text")


def r01_warnings(spark, d):
    docs = table(spark, d, "extracted_docs")
    lines = pages.lines_of(docs, ["extract_id"], "extracted_text")
    found = review.line_warnings(lines, "extract_id").unionByName(review.number_warnings(docs, "extract_id", "extracted_text"))
    return review.distinct_warnings(found, "extract_id").select("extract_id", "rule", "message", F.col("line_no").cast("bigint").alias("line_no"))


def j06_term_warnings(spark, d):
    terms = ["Phòng Đào tạo", "Công tác sinh viên", "Học phần", "Sinh viên", "Điểm rèn luyện", "Tờ khai thông tin", "Quyết định", "Thông báo", "Quy định", "Biểu mẫu"]
    rows = raw_lines(spark, d).select("page_id", F.col("line_no").cast("bigint").alias("line_no"), text.match_key(text.clean_line(F.col("line"))).alias("key"))
    return rows.select("page_id", "line_no", F.explode(review.related_terms(F.col("key"), terms)).alias("term"))


QUERIES = {f.__name__: f for f in (f01_clean_text, f03_clean_lines, f07_match_keys, f09_file_stems, f10_checksums, f29_upper_ratios, f31_markers, f32_cells, f37_page_lists, f39_forms, f17_common_layer, f27_three_layers, l01_headings, line_flags, a02_repeated_lines, j01_kept_lines, w03_bullets, w05_merged_lines, l02_markdown, r01_warnings, j06_term_warnings)}

_TERMS = ["Phòng Đào tạo", "Công tác sinh viên", "Học phần", "Sinh viên", "Điểm rèn luyện", "Tờ khai thông tin", "Quyết định", "Thông báo", "Quy định", "Biểu mẫu"]
_STEM = sql.rx(sql.rx(sql.rx("coalesce(title, '')", r'[<>:"/\\|?*\x00-\x1f]', "_"), f"{sql.WS}+", "_"), r"^[._ ]+|[._ ]+$", "")
_OPEN = "(?:^| )(?:" + "|".join(L.OPEN_WORDS) + ")$"
_REPEATED = f"""WITH {sql.marker_cte('raw_pages', 'version_id, page_no', 'raw_text')}, {sql.heading_cte()},
    keys AS (SELECT DISTINCT version_id, page_no, {sql.edge_key('c')} AS key FROM f WHERE length(c) >= 5 AND NOT is_structural),
    n AS (SELECT version_id, count(*) AS n FROM (SELECT DISTINCT version_id, page_no FROM raw_pages) GROUP BY version_id),
    rep AS (SELECT version_id, key, count(*) AS n_pages FROM keys GROUP BY version_id, key)"""
_WARN = f"""
    WITH l AS (SELECT extract_id, line_no, {sql.clean_line('line')} AS c FROM {sql.lines('extracted_docs', 'extract_id', 'extracted_text')}),
    w AS (
        SELECT extract_id, line_no, 'question_mark' AS rule, 'Dòng ' || line_no || ': còn dấu ''?'' cần kiểm tra: ' || c AS message FROM l WHERE contains(c, '?')
        UNION ALL SELECT extract_id, line_no, 'letter_in_number', 'Dòng ' || line_no || ': cụm số/chữ có thể là OCR sai: ' || c FROM l
            WHERE len(list_filter(regexp_extract_all(c, '[\\p{{L}}\\p{{N}}\\p{{M}}_]+'), lambda x: regexp_full_match(x, '[0-9]+[A-Za-z][0-9]+'))) > 0
        UNION ALL SELECT extract_id, line_no, 'email_without_at', 'Dòng ' || line_no || ': dòng Email chưa có @, cần kiểm tra: ' || c FROM l WHERE regexp_matches(c, '(?i)Email') AND NOT contains(c, '@')
    ),
    d AS (SELECT extract_id, {sql.clean_line('m')} AS m FROM (SELECT extract_id, unnest(regexp_extract_all(extracted_text, '(?i)Số[\\t-\\r ]*:[\\t-\\r ]*([A-Za-z0-9]+[\\t-\\r ]*/[\\t-\\r ]*[^\\n]+)', 1)) AS m FROM extracted_docs))
    SELECT extract_id, rule, message, min(line_no) AS line_no FROM (
        SELECT extract_id, line_no, rule, message FROM w
        UNION ALL SELECT extract_id, NULL, 'letter_in_document_number', 'Nghi ngờ số văn bản OCR sai, cần kiểm tra ảnh gốc: Số: ' || m FROM d WHERE regexp_matches(split_part(m, '/', 1), '[A-Za-z]')
    ) GROUP BY extract_id, rule, message
"""

SQL = {
    "f01_clean_text": f"SELECT page_id, {sql.clean_text('raw_text')} AS text FROM raw_pages",
    "f03_clean_lines": f"SELECT page_id, line_no, {sql.clean_line('line')} AS line FROM {sql.lines('raw_pages', 'page_id', 'raw_text')}",
    "f07_match_keys": f"SELECT meta_id, {sql.match_key('title')} AS title_key, replace({sql.match_key('title')}, ' ', '') AS title_solid, {sql.clean_line('lower(department)')} AS unit_key FROM doc_meta",
    "f09_file_stems": f"SELECT meta_id, CASE WHEN s = '' THEN 'untitled' WHEN length(s) > 120 THEN s[1:120] || '_' || md5(s)[1:8] ELSE s END AS stem FROM (SELECT meta_id, {_STEM} AS s FROM doc_meta)",
    "f10_checksums": "SELECT page_id, md5(coalesce(raw_text, '')) AS checksum FROM raw_pages",
    "f29_upper_ratios": f"SELECT page_id, round({sql.upper_ratio(chr(99))}, 6) AS upper_ratio FROM (SELECT page_id, coalesce(raw_text, '') AS c FROM raw_pages)",
    "f31_markers": f"WITH {sql.marker_cte('raw_pages', 'page_id', 'raw_text')} SELECT page_id, line_no, kind, mark, content FROM m",
    "f32_cells": f"SELECT page_id, {sql.strip(sql.rx('replace(replace(coalesce(raw_text, %s), chr(10), %s), %s, %s)' % (sql.q(''), sql.q('<br>'), sql.q('|'), sql.q(chr(92) + '|')), sql.WS + '+', ' '))} AS cell FROM raw_pages",
    "f37_page_lists": "SELECT DISTINCT extract_id, p AS page_no FROM (SELECT extract_id, unnest(flatten(list_transform(cloud_pages, lambda c: range(c, c + 3)))) AS p FROM extracted_docs) WHERE p >= 1",
    "l01_headings": f"WITH {sql.marker_cte('raw_pages', 'page_id', 'raw_text')}, {sql.heading_cte()} SELECT page_id, line_no, is_article, is_chapter, is_section, is_title, is_contents, is_process, level, {sql.MARKDOWN} AS markdown FROM f",
    "line_flags": f"""WITH {sql.marker_cte('raw_pages', 'page_id', 'raw_text')}, {sql.heading_cte()} SELECT page_id, line_no, is_structural,
        {sql.matches('c', rf"^(-|[+]|•){sql.WS}+|^(\p{{Nd}}+[.]\p{{Nd}}+(?:[.]\p{{Nd}}+)*[.]?|\p{{Nd}}+[.)]){sql.WS}+|^([IVXLCDMivxlcdm]+)[.)]{sql.WS}+|^([a-zA-ZđĐ])[.)/]{sql.WS}+")} AS is_item,
        ({sql.matches('c', '[,;:–-]$')} OR {sql.matches('lower(c)', _OPEN)}) AS ends_open, {sql.matches('c', '^' + chr(92) + 'p{Nd}+$')} AS is_page_number,
        {sql.matches('c', '^(?:[0-9]+[.)]|[a-zA-ZđĐ][.)]|[-+•])$')} AS is_marker, {sql.matches('c', '(?i)^(scanned +with +(cs *)?camscanner|scanned +with +cs|camscanner)$')} AS is_watermark FROM f""",
    "a02_repeated_lines": f"{_REPEATED} SELECT rep.version_id, key, n_pages FROM rep JOIN n USING (version_id) WHERE n.n >= 3 AND n_pages >= greatest(2, floor(n.n * 0.6))",
    "j01_kept_lines": f"""{_REPEATED}, r AS (SELECT rep.version_id, key FROM rep JOIN n USING (version_id) WHERE n.n >= 3 AND n_pages >= greatest(2, floor(n.n * 0.6)))
        SELECT page_id, line_no, line FROM {sql.lines('raw_pages', 'page_id, version_id', 'raw_text')} AS x
        WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.version_id = x.version_id AND r.key = {sql.edge_key('x.line')})""",
    "w03_bullets": f"""WITH l AS (SELECT page_id, line_no, {sql.clean_line('line')} AS c FROM {sql.lines('raw_pages', 'page_id', 'raw_text')}),
        t AS (SELECT *, (ends_with(c, ':') OR contains(lower(c), 'các tiêu chí sau') OR contains(lower(c), 'hồ sơ gồm')) AS opens FROM l WHERE c <> ''),
        s AS (SELECT *, coalesce(max(opens::INT) OVER (PARTITION BY page_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside FROM t),
        b AS (SELECT page_id, line_no, CASE WHEN inside = 1 AND NOT opens AND {sql.any_start('c', L.BULLETED)} AND NOT {sql.matches('c', rf"^(-|[+]|•){sql.WS}+|^([IVXLCDMivxlcdm]+)[.)]{sql.WS}+|^([a-zA-ZđĐ])[.)/]{sql.WS}+")} THEN '- ' || c ELSE c END AS c FROM s)
        SELECT page_id, line_no, c AS line FROM b""",
    "r01_warnings": _WARN,
    "j06_term_warnings": f"""SELECT page_id, line_no, t.term FROM (SELECT page_id, line_no, {sql.match_key(sql.clean_line('line'))} AS key FROM {sql.lines('raw_pages', 'page_id', 'raw_text')}) l
        JOIN (SELECT term, {sql.match_key('term')} AS tk FROM (VALUES {', '.join(f"({sql.q(t)})" for t in _TERMS)}) v(term)) t ON contains(l.key, t.tk)""",
}

_EDGE = r"([^\p{L}\p{M}\p{N}_]|$)"
_IS_ITEM = sql.matches("c", rf"^(-|[+]|•){sql.WS}+|^(\p{{Nd}}+[.]\p{{Nd}}+(?:[.]\p{{Nd}}+)*[.]?|\p{{Nd}}+[.)]){sql.WS}+|^([IVXLCDMivxlcdm]+)[.)]{sql.WS}+|^([a-zA-ZđĐ])[.)/]{sql.WS}+")
_LINE = f"""{{'t': c, 'n': length(c), 'apart': is_structural OR {_IS_ITEM}, 'goes': {sql.matches('c', r'^\p{Ll}')} OR {sql.matches('c', '(?i)^(?:' + '|'.join(L.JOINING) + ')' + _EDGE)},
    'open': {sql.matches('c', '[,;:–-]$')} OR {sql.matches('lower(c)', _OPEN)}, 'stop': {sql.matches('c', '[.;:!?]$')}, 'upper': upper(c) = c, 'letter': {sql.matches('c', r'\p{L}')}}}"""
_STATE = lambda text, n, upper, letter: f"{{'t': {text}, 'n': {n}, 'apart': false, 'goes': false, 'open': x.open, 'stop': x.stop, 'upper': {upper}, 'letter': {letter}}}"
#: The fold over a page's lines: each is the state that the next one meets.
SQL["w05_merged_lines"] = f"""WITH bl AS (SELECT page_id, line_no AS ln, line AS t FROM ({SQL['w03_bullets']})), {sql.marker_cte('bl', 'page_id, ln', 't')}, {sql.heading_cte()},
    g AS (SELECT page_id, list({_LINE} ORDER BY ln) AS xs FROM f GROUP BY page_id),
    r AS (SELECT page_id, list_reduce(xs, lambda a, x: CASE WHEN NOT x.apart AND NOT a.stop AND NOT (a.n > 8 AND a.letter AND a.upper) AND (a.open OR x.goes)
        THEN {_STATE("a.t || ' ' || x.t", 'a.n + 1 + x.n', 'x.upper AND a.upper', 'x.letter OR a.letter')} ELSE {_STATE('a.t || chr(10) || x.t', 'x.n', 'x.upper', 'x.letter')} END).t AS t FROM g),
    o AS (SELECT page_id, replace(regexp_replace(t, '(?i)(các tiêu chí sau đây){sql.WS}+-{sql.WS}+', '\\1:' || chr(10) || '- ', 'g'), 'Trân trọng cảm ơn./ Nơi nhận:', 'Trân trọng cảm ơn./.' || chr(10) || 'Nơi nhận:') AS t FROM r)
    SELECT page_id, coalesce({sql.clean_text('t')}, '') AS text FROM raw_pages LEFT JOIN o USING (page_id)"""
SQL["l02_markdown"] = f"""WITH w AS (SELECT page_id, text AS t FROM ({SQL['w05_merged_lines']})), {sql.marker_cte('w', 'page_id', 't')}, {sql.heading_cte()},
    d AS (SELECT page_id, string_agg({sql.MARKDOWN}, chr(10) || chr(10) ORDER BY line_no) AS md FROM f WHERE c <> '' GROUP BY page_id)
    SELECT page_id, coalesce(md, '') AS text FROM raw_pages LEFT JOIN d USING (page_id)"""
