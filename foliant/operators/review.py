"""Review warnings: 0 to n rows per line or text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import clean_line, match_key


def line_warnings(lines: DataFrame, document: str, number: str = "line_no", line: str = "line", terms: Sequence[str] = ()) -> DataFrame:
    """``document, line_no, rule, message`` for lines with a "?", with letters in numbers, with an e-mail label
    but no address, or with one of ``terms`` next to words without their marks."""
    said = clean_line(F.col(line))
    rows = lines.select(document, F.col(number).alias("line_no"), said.alias("_l")).where("_l <> ''")
    if terms:
        rows = rows.withColumn("_k", match_key(F.col("_l")))

    def warning(rule: str, when: Column, text: Column | str) -> Column:
        head = F.concat(F.lit("Dòng "), F.col("line_no"), F.lit(": "), text if isinstance(text, Column) else F.lit(text))
        return F.when(when, F.struct(F.lit(rule).alias("rule"), F.concat(head, F.col("_l")).alias("message")))

    found = [
        warning("question_mark", F.contains("_l", F.lit("?")), "còn dấu '?' cần kiểm tra: "),
        warning("letter_in_number", F.col("_l").rlike(r"\b[0-9]+[A-Za-z][0-9]+\b"), "cụm số/chữ có thể là OCR sai: "),
        warning("email_without_at", F.col("_l").rlike("(?i)Email") & ~F.contains("_l", F.lit("@")), "dòng Email chưa có @, cần kiểm tra: "),
    ]
    if terms:
        near = related_terms(F.col("_k"), terms)
        unmarked = F.contains("_l", F.lit("?")) | F.col("_l").rlike(r"(?U)\b[Dd]ai hoc|[Ss]inh vien\b")
        text = F.concat(F.lit("nên kiểm tra thuật ngữ gần "), F.array_join(F.slice(near, 1, 3), ", "), F.lit(" -> "))
        found.append(warning("term_unmarked", (F.size(near) > 0) & unmarked, text))
    return rows.select(document, "line_no", F.explode(F.array_compact(F.array(*found))).alias("_w")).select(document, "line_no", "_w.rule", "_w.message")


def related_terms(key: Column, terms: Sequence[str]) -> Column:
    """The terms whose key is part of a line's key, in their order. Terms are a short list, part of the plan."""
    pairs = F.array(*(F.struct(F.lit(t).alias("term"), match_key(F.lit(t)).alias("key")) for t in terms))
    return F.transform(F.filter(pairs, lambda x: (x["key"] != "") & F.contains(key, x["key"])), lambda x: x["term"])


def number_warnings(df: DataFrame, document: str, text: str) -> DataFrame:
    """``document, line_no (null), rule, message`` for document numbers with letters before the slash."""
    found = F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(?iU)\bSố\s*:\s*([A-Za-z0-9]+\s*/\s*[^\n]+)"), 1))
    rows = df.select(document, found.alias("_m")).select(document, clean_line(F.col("_m")).alias("_m"))
    return rows.where(F.substring_index("_m", "/", 1).rlike("[A-Za-z]")).select(
        document, F.lit(None).cast("int").alias("line_no"), F.lit("letter_in_document_number").alias("rule"), F.concat(F.lit("Nghi ngờ số văn bản OCR sai, cần kiểm tra ảnh gốc: Số: "), F.col("_m")).alias("message")
    )


def distinct_warnings(warnings: DataFrame, document: str) -> DataFrame:
    """Every message of a document once, with the first line that gave it."""
    return warnings.groupBy(document, "rule", "message").agg(F.min("line_no").alias("line_no"))


def review_reports(warnings: DataFrame, document: str, source: str) -> DataFrame:
    """``document, report``: the review report of each document with warnings; those without have none.

    ``source`` is the column with the document's file. Warnings stand in the order of their lines.
    """
    listed = F.array_sort(F.collect_list(F.struct(F.coalesce("line_no", F.lit(2**31 - 1)).alias("n"), "rule", "message")))
    # The words of the report.
    head = F.concat(F.lit("# OCR Review Report\n\nFile gốc: "), F.coalesce(F.first(source), F.lit("")), F.lit("\n\n## Dòng/cụm cần kiểm tra\n- "))
    return warnings.groupBy(document).agg(F.concat(head, F.array_join(F.transform(listed, lambda x: x["message"]), "\n- ")).alias("report"))
