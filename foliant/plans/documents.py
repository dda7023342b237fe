"""Queries over Markdown extracts and the records of their versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.operators import chunks, pages, review
from foliant.plans import sql, texts
from foliant.session import table
from foliant.sources import files


def _docs(spark, d):
    return table(spark, d, "extracted_docs")


def w12_page_blocks(spark, d):
    return pages.page_blocks(_docs(spark, d), "extract_id", "extracted_text").select("extract_id", F.col("page_no").cast("bigint").alias("page_no"), "block")


def _expected(spark, d):
    pages_of = F.sequence(F.lit(1), F.greatest(F.coalesce("total_pages", F.lit(1)), F.lit(1)))
    return _docs(spark, d).select("extract_id", F.explode(pages_of).alias("page_no"))


def o07_assembled(spark, d):
    """Every extract put together again from its page blocks, with placeholders for the pages it lacks."""
    return pages.assembled(pages.page_blocks(_docs(spark, d), "extract_id", "extracted_text"), _expected(spark, d), "extract_id")


def j05_expected_blocks(spark, d):
    """Page blocks brought to the pages that went to the cloud parser."""
    found = pages.page_blocks(_docs(spark, d), "extract_id", "extracted_text").withColumn("pos", F.col("page_no"))
    wanted = _docs(spark, d).select("extract_id", F.explode("cloud_pages").alias("page_no"))
    return pages.expected_blocks(found, wanted, "extract_id").select("extract_id", F.col("page_no").cast("bigint").alias("page_no"), "block")


def k02_headers(spark, d):
    fields = {"Extraction mode": F.col("extraction_mode"), "Total pages": F.col("total_pages"), "Total characters": F.col("total_characters"), "Text pages": F.col("text_pages"), "OCR pages": F.col("ocr_pages"), "Tables": F.col("n_tables")}
    return _docs(spark, d).select("extract_id", pages.document_header(F.coalesce("source_name", F.lit("")), fields).alias("header"))


def k07_output_names(spark, d):
    return _docs(spark, d).select("extract_id", files.output_name(F.coalesce("source_name", F.lit(""))).alias("name"))


def g09_heading_chunks(spark, d):
    out = chunks.heading_chunks(pages.lines_of(_docs(spark, d), ["extract_id"], "extracted_text"), "extract_id")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("chunk_no", "page_start", "page_end")})


def g10_embedding_texts(spark, d):
    """The text to embed of every chunk, with the title and unit of the version's last record."""
    meta = pages.latest(table(spark, d, "doc_meta").select("version_id", "title", "department", "updated_at", "meta_id"), ["version_id"], ["updated_at", "meta_id"])
    parts = g09_heading_chunks(spark, d).join(_docs(spark, d).select("extract_id", "version_id"), "extract_id").join(meta, "version_id", "left")
    return parts.select("extract_id", "chunk_no", chunks.embedding_text(F.col("title"), F.col("department"), F.col("heading_path"), F.col("content")).alias("text"))


def g12_repeated_versions(spark, d):
    return chunks.repeated_versions(table(spark, d, "doc_meta"), "version_id", "updated_at")


REQUIRED = ["document_id", "version_id", "title", "document_type", "department", "source_file", "doc_language", "checksum"]


def g02_missing_fields(spark, d):
    return chunks.missing_fields(table(spark, d, "doc_meta"), "meta_id", REQUIRED).select("meta_id", F.array_join("missing", ",").alias("missing"))


def j09_merged_blocks(spark, d):
    """The blocks of each version's extracts, later extracts over earlier ones."""
    docs = _docs(spark, d).where("version_id IS NOT NULL")
    ends = docs.groupBy("version_id").agg(F.min("extract_id").alias("first"), F.max("extract_id").alias("last"))
    found = pages.page_blocks(docs, "extract_id", "extracted_text")
    of = lambda which: ends.select("version_id", F.col(which).alias("extract_id")).join(found, "extract_id")
    return pages.merged_blocks(of("first"), of("last"), document="version_id").select("version_id", F.col("page_no").cast("bigint").alias("page_no"), "block")


def k01_documents(spark, d):
    """Whole documents: head and body."""
    return pages.documents(k02_headers(spark, d), _docs(spark, d).select("extract_id", F.concat(F.lit("\n"), F.col("extracted_text")).alias("body")), "extract_id")


def k06_review_reports(spark, d):
    docs = _docs(spark, d)
    lines = pages.lines_of(docs, ["extract_id"], "extracted_text")
    found = review.distinct_warnings(review.line_warnings(lines, "extract_id").unionByName(review.number_warnings(docs, "extract_id", "extracted_text")), "extract_id")
    return review.review_reports(found.join(docs.select("extract_id", "source_name"), "extract_id"), "extract_id", "source_name")


def r04_term_warnings(spark, d):
    """Review warnings about terms next to words without their marks."""
    lines = pages.lines_of(_docs(spark, d), ["extract_id"], "extracted_text")
    out = review.line_warnings(lines, "extract_id", terms=TERMS).where("rule = 'term_unmarked'")
    return out.select("extract_id", F.col("line_no").cast("bigint").alias("line_no"), "rule", "message")


TERMS = ["Phòng Đào tạo", "Sinh viên", "Quyết định", "Thông báo", "Quy định"]


def k09_routed_files(spark, d):
    """Of each file: its kind, its output's names, and whether it is parsed in the cloud and its pages routed."""
    source = F.coalesce("source_name", F.lit(""))
    text = F.col("text_pages") > 0
    return _docs(spark, d).select(
        "extract_id",
        files.extension(source).alias("kind"),
        files.plain_output_name(source).alias("plain_name"),
        files.output_path(source, F.lit("out/")).alias("path"),
        files.is_markdown_path(source).alias("is_markdown"),
        F.coalesce(files.needs_cloud(source, text, F.col("n_tables") > 3), F.lit(False)).alias("cloud"),
        files.by_pages(source, F.lit("local")).alias("by_pages"),
    )


QUERIES = {f.__name__: f for f in (j09_merged_blocks, k01_documents, k06_review_reports, r04_term_warnings, k09_routed_files, w12_page_blocks, o07_assembled, j05_expected_blocks, k02_headers, k07_output_names, g09_heading_chunks, g10_embedding_texts, g12_repeated_versions, g02_missing_fields)}

_L = f"l AS (SELECT extract_id, line_no, line, {sql.strip('line')} AS s FROM {sql.lines('extracted_docs', 'extract_id', 'extracted_text')})"
_OWN = "l AS (SELECT extract_id, unnest(range(1, len(_l) + 1)) AS line_no, unnest(_l) AS line FROM (SELECT extract_id, string_split(extracted_text, chr(10)) AS _l FROM extracted_docs WHERE extracted_text IS NOT NULL))"
_BLOCK = f"""{_OWN}, h AS (SELECT *, sum(regexp_matches(line, '^## Trang +[0-9]+[ \\t\\r]*$')::INT) OVER (PARTITION BY extract_id ORDER BY line_no) AS n FROM l),
    p AS (SELECT extract_id, n, regexp_extract(first(line ORDER BY line_no), '([0-9]+)')::BIGINT AS page_no, string_agg(line, chr(10) ORDER BY line_no) AS part FROM h WHERE n > 0 GROUP BY extract_id, n),
    blocks AS (SELECT extract_id, page_no, regexp_replace({sql.strip('arg_max(part, n)')}, '(?:\\s*\\n-{{3,}}\\s*)+$', '') AS block FROM p GROUP BY extract_id, page_no)"""
_HEADER = "".join(f" || CASE WHEN {c} IS NULL THEN '' ELSE '- {n}: ' || {c} || chr(10) END" for n, c in (("Extraction mode", "extraction_mode"), ("Total pages", "total_pages"), ("Total characters", "total_characters"), ("Text pages", "text_pages"), ("OCR pages", "ocr_pages"), ("Tables", "n_tables")))
_BASE = sql.rx(sql.rx("regexp_replace(regexp_extract(coalesce(source_name, ''), '([^/\\\\]*)$', 1), '\\.[^.]*$', '')", r'[<>:"/\\|?*\x00-\x1f]', "_"), f"{sql.WS}+", "_")
_STEM = sql.rx(_BASE, r"^[._ ]+|[._ ]+$", "")
# A heading counts while none of a higher level came after it.
_ABOVE = ["h1.h"] + [f"CASE WHEN h{k}.n > greatest(" + ", ".join(f"coalesce(h{j}.n, 0)" for j in range(1, k)) + f") THEN h{k}.h END" for k in range(2, 7)]
_CHUNKS = f"""{_L}, v AS (SELECT *, coalesce(nullif(regexp_extract(s, '^<!-- page: ([0-9]+) -->', 1), ''), nullif(regexp_extract(s, '^## Trang +([0-9]+)$', 1), ''))::BIGINT AS p FROM l),
    w AS (SELECT *, CASE WHEN p IS NULL AND regexp_matches(s, '^#{{1,6}} ') THEN length(regexp_extract(s, '^(#+)', 1)) END AS lvl, regexp_replace(s, '^#+\\s*', '') AS h FROM v),
    x AS (SELECT *, last_value(p IGNORE NULLS) OVER o AS page, count(lvl) OVER o AS chunk_no,
        {', '.join(f"last_value(CASE WHEN lvl = {k} THEN {{'n': line_no, 'h': h}} END IGNORE NULLS) OVER o AS h{k}" for k in range(1, 7))}
        FROM w WINDOW o AS (PARTITION BY extract_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    y AS (SELECT *, concat_ws(' > ', {', '.join(_ABOVE)}) AS path FROM x),
    chunks AS (SELECT extract_id, chunk_no, max(CASE WHEN lvl IS NOT NULL THEN h END) AS heading, arg_max(path, line_no) AS heading_path, min(page) AS page_start, max(page) AS page_end,
        coalesce(string_agg(s, chr(10) ORDER BY line_no) FILTER (p IS NULL AND lvl IS NULL AND s <> '' AND NOT starts_with(s, '<!--') AND NOT regexp_matches(s, '^-{{3,}}$')), '') AS content FROM y GROUP BY extract_id, chunk_no)"""

SQL = {
    "w12_page_blocks": f"WITH {_BLOCK} SELECT extract_id, page_no, block FROM blocks",
    "o07_assembled": f"""WITH {_BLOCK}, e AS (SELECT DISTINCT extract_id, unnest(range(1, greatest(coalesce(total_pages, 1), 1) + 1)) AS page_no FROM extracted_docs)
        SELECT e.extract_id, string_agg(coalesce(block, '## Trang ' || e.page_no || chr(10) || chr(10) || '_(no content)_'), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY e.page_no) AS body FROM e LEFT JOIN blocks USING (extract_id, page_no) GROUP BY e.extract_id""",
    "j05_expected_blocks": f"""WITH {_BLOCK}, e AS (SELECT DISTINCT extract_id, unnest(cloud_pages)::BIGINT AS page_no FROM extracted_docs),
        hit AS (SELECT b.* FROM blocks b JOIN e USING (extract_id, page_no)),
        rest AS (SELECT *, row_number() OVER (PARTITION BY extract_id ORDER BY page_no) AS k FROM blocks WHERE extract_id NOT IN (SELECT extract_id FROM hit)),
        slots AS (SELECT *, row_number() OVER (PARTITION BY extract_id ORDER BY page_no) AS k FROM e)
        SELECT extract_id, page_no, block FROM hit UNION ALL SELECT s.extract_id, s.page_no, r.block FROM rest r JOIN slots s USING (extract_id, k)""",
    "k02_headers": f"SELECT extract_id, '# PDF / Image Text Document' || chr(10) || chr(10) || '## Metadata' || chr(10) || chr(10) || '- Source file: `' || coalesce(source_name, '') || '`' || chr(10){_HEADER} || chr(10) || '## Extracted Text' || chr(10) AS header FROM extracted_docs",
    "k07_output_names": f"SELECT extract_id, CASE WHEN s = '' THEN 'untitled' WHEN length(s) > 120 THEN s[1:120] || '_' || md5(s)[1:8] ELSE s END || '_structured.md' AS name FROM (SELECT extract_id, {_STEM} AS s FROM extracted_docs)",
    "g09_heading_chunks": f"WITH {_CHUNKS} SELECT * FROM chunks",
    "g10_embedding_texts": f"""WITH {_CHUNKS}, m AS (SELECT version_id, arg_max(title, (updated_at, meta_id)) AS title0, arg_max({{'t': title, 'd': department}}, (updated_at, meta_id)) AS r FROM doc_meta WHERE version_id IS NOT NULL GROUP BY version_id)
        SELECT c.extract_id, chunk_no, concat_ws(chr(10), 'Title: ' || nullif(r.t, ''), 'Unit: ' || nullif(r.d, ''), 'Section: ' || nullif(heading_path, ''), 'Content: ' || nullif(content, '')) AS text
        FROM chunks c JOIN extracted_docs d USING (extract_id) LEFT JOIN m USING (version_id) WHERE d.version_id IS NOT NULL""",
    "g12_repeated_versions": "SELECT version_id, count(*) AS n_rows, max(updated_at) AS last_updated FROM doc_meta WHERE version_id IS NOT NULL GROUP BY version_id HAVING count(*) > 1",
    "g02_missing_fields": "SELECT meta_id, missing FROM (SELECT meta_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {sql.strip(f'coalesce({c}::VARCHAR, {sql.q(str())})')} = '' THEN {sql.q(c)} END" for c in REQUIRED) + "], lambda x: x IS NOT NULL), ',') AS missing FROM doc_meta) WHERE missing <> ''",
    "j09_merged_blocks": f"""WITH {_BLOCK}, v AS (SELECT version_id, min(extract_id) AS f, max(extract_id) AS l FROM extracted_docs WHERE version_id IS NOT NULL GROUP BY version_id),
        x AS (SELECT version_id, page_no, block, 0 AS n FROM blocks JOIN v ON extract_id = f UNION ALL SELECT version_id, page_no, block, 1 FROM blocks JOIN v ON extract_id = l)
        SELECT version_id, page_no, arg_max(block, n) AS block FROM x GROUP BY version_id, page_no""",
    "k09_routed_files": f"""WITH s AS (SELECT *, coalesce(source_name, '') AS n FROM extracted_docs), x AS (SELECT *, lower(regexp_extract(n, '([.][^./\\\\]+)$', 1)) AS kind, CASE WHEN s2 = '' THEN 'untitled' WHEN length(s2) > 120 THEN s2[1:120] || '_' || md5(s2)[1:8] ELSE s2 END AS safe FROM (SELECT *, {_STEM} AS s2 FROM s))
        SELECT extract_id, kind, regexp_replace(regexp_extract(n, '([^/\\\\]*)$', 1), '(.)[.][^.]*$', '\\1') || '_structured.md' AS plain_name, 'out/' || safe || '_structured.md' AS path, kind = '.md' AS is_markdown,
          CASE WHEN kind IN ({', '.join(sql.q(k) for k in files.LOCAL[1:] + files.CLOUD)}) THEN true WHEN kind = '.pdf' THEN NOT coalesce(text_pages > 0, false) OR coalesce(n_tables > 3, false) ELSE false END AS cloud, kind = '.pdf' AS by_pages FROM x""",
}
SQL["k01_documents"] = f"SELECT h.extract_id, header || chr(10) || coalesce(chr(10) || extracted_text, '') AS markdown FROM ({SQL['k02_headers']}) h JOIN extracted_docs USING (extract_id)"
_NEAR = f"list_filter([{', '.join(f'{{{chr(39)}t{chr(39)}: {sql.q(t)}, {chr(39)}k{chr(39)}: {sql.match_key(sql.q(t))}}}' for t in TERMS)}], lambda x: contains(k, x.k))"
SQL["r04_term_warnings"] = f"""WITH l AS (SELECT extract_id, line_no, {sql.clean_line('line')} AS c FROM {sql.lines('extracted_docs', 'extract_id', 'extracted_text')}),
    k AS (SELECT *, {sql.match_key('c')} AS k FROM l WHERE c <> ''), n AS (SELECT *, {_NEAR} AS near FROM k)
    SELECT extract_id, line_no, 'term_unmarked' AS rule, 'Dòng ' || line_no || ': nên kiểm tra thuật ngữ gần ' || array_to_string(list_transform(near[1:3], lambda x: x.t), ', ') || ' -> ' || c AS message
    FROM n WHERE len(near) > 0 AND (contains(c, '?') OR {sql.matches('c', r'(^|[^\p{L}\p{M}\p{N}_])[Dd]ai hoc|[Ss]inh vien([^\p{L}\p{M}\p{N}_]|$)')})"""
SQL["k06_review_reports"] = f"""SELECT extract_id, '# OCR Review Report' || chr(10) || chr(10) || 'File gốc: ' || coalesce(source_name, '') || chr(10) || chr(10) || '## Dòng/cụm cần kiểm tra' || chr(10) || '- '
    || string_agg(message, chr(10) || '- ' ORDER BY coalesce(line_no, 2147483647), rule, message) AS report FROM ({texts.SQL['r01_warnings']}) w JOIN extracted_docs USING (extract_id) GROUP BY extract_id, source_name"""
