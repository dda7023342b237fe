"""The plain formatter: running text to Markdown by few rules, for documents without forms and flow charts.

Here lines are joined unless something speaks against it, and emphasis is given by how a line starts.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.lines import has, is_page_number, starts
from foliant.functions.rules import Rule, compile_rules
from foliant.functions.text import rx, strip, upper_ratio

# Signs and what is written for them, in this order.
SIGNS = [("\uf0b7", "- "), ("•", "- "), ("–", "-"), ("—", "-"), ("−", "-"), ("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'"), ("…", "...")]
# Spacing around signs and in document numbers.
SPACING = [
    Rule(r"\s+([,.;:!?])", "$1", False), Rule(r"([,.;:!?])(?=[^\s\n])", "$1 ", False), Rule(r"\b([A-ZĐ]{1,6})\s*-\s*([A-ZĐ]{1,10})\b", "$1-$2", False),
    Rule(r"\s*/\s*", "/", False), Rule(r"\(\s+", "(", False), Rule(r"\s+\)", ")", False), Rule(r"[ \t]+", " ", False),
]
# Rare misreadings, case ignored.
RARE = [Rule(r"\bC0NG\s+H[OÒ]A\b", "CỘNG HÒA"), Rule(r"\bXA\s+H[OỘ]I\b", "XÃ HỘI"), Rule(r"\bH[OỌ]ANH\s+PH[UÚ]C\b", "HẠNH PHÚC"), Rule(r"\bQÐ\b", "QĐ"), Rule(r"\bQD\b(?=\s*[-/])", "QĐ")]
# Titles that stand by themselves when lines are joined; titles of the first level; openings of a paragraph; lines of a signature.
APART = [
    "NỘI QUY", "QUYẾT ĐỊNH", "QUY ĐỊNH", "THÔNG BÁO", "KẾ HOẠCH", "HƯỚNG DẪN", "QUY CHẾ", "PHỤ LỤC", "NỘI DUNG VI PHẠM", "TRUNG TÂM PHỤC VỤ SINH VIÊN",
    "CỘNG HÒA XÃ HỘI CHỦ NGHĨA VIỆT NAM", "ĐỘC LẬP - TỰ DO - HẠNH PHÚC",
]
MAJOR = ["QUYẾT ĐỊNH", "QUY ĐỊNH", "THÔNG BÁO", "KẾ HOẠCH", "HƯỚNG DẪN", "QUY CHẾ", "HIỆU TRƯỞNG", "CỘNG HÒA XÃ HỘI CHỦ NGHĨA VIỆT NAM", "ĐỘC LẬP - TỰ DO - HẠNH PHÚC"]
FIRST = ["QUYẾT ĐỊNH", "QUY ĐỊNH", "THÔNG BÁO", "KẾ HOẠCH", "HƯỚNG DẪN", "HIỆU TRƯỞNG", "CỘNG HÒA XÃ HỘI CHỦ NGHĨA VIỆT NAM", "ĐỘC LẬP - TỰ DO - HẠNH PHÚC"]
OPENINGS = r"^(Căn cứ|Theo đề nghị|QUYẾT ĐỊNH|Điều|Chương|Mục)\b"
FOOT = ["Nơi nhận", "HIỆU TRƯỞNG", "KT. HIỆU TRƯỞNG", "PHÓ HIỆU TRƯỞNG", "TRƯỞNG PHÒNG", "Lưu:"]

#: What ends a line of a text.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


@F.arrow_udf(T.StringType())
def _composed(texts: pa.Array) -> pa.Array:
    return pa.array([x and unicodedata.normalize("NFC", x) for x in texts.to_pylist()], pa.string())


def composed(c: Column) -> Column:
    """The text in NFC, over Arrow batches: the JVM has no expression for it."""
    return _composed(c)


def _signs(c: Column) -> Column:
    return compile_rules(c, [Rule(a, b, literal=True) for a, b in SIGNS])


def plain_text(c: Column) -> Column:
    """A text in NFC (see ``composed``) with plain signs, LF line ends and single blanks; null gives ""."""
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\0"), F.lit(""))
    c = F.regexp_replace(_signs(F.regexp_replace(c, "\r\n?", "\n")), "[ \t]+", " ")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def plain_line(c: Column) -> Column:
    """A line in NFC with plain signs and single blanks; null gives ""."""
    return strip(rx(_signs(strip(F.coalesce(c, F.lit("")))), r"\s+", " "))


def plain_rules(c: Column) -> Column:
    """Plain text with one blank behind punctuation and none before it, and document numbers put together."""
    c = F.regexp_replace(compile_rules(plain_text(c), SPACING), "[ \t]+", " ")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def plain_layers(c: Column, terms: Sequence[Rule] = ()) -> Column:
    """Rules, a project's own terms (a parameter), rare misreadings, rules again."""
    return plain_rules(compile_rules(compile_rules(plain_rules(c), terms), RARE))


def _titled(line: Column, titles: list[str]) -> Column:
    """Is the line one of the titles, or does it start with one and is short, in capitals and no sentence?"""
    upper = F.upper(line)
    return upper.isin(titles) | (starts(upper, titles) & (F.length(line) <= 90) & ~line.rlike("[.,;]$") & (upper_ratio(line) >= 0.65))


def stands_apart(line: Column) -> Column:
    """Lines that nothing is joined to: empty, page numbers, articles, chapters, sections, annexes, titles."""
    return (
        (line == "")
        | is_page_number(line)
        | has(line, r"^(Điều|ĐIỀU)\s+\d+")
        | has(line, r"^(Chương|CHƯƠNG)\s+([IVXLCDM]+|\d+)")
        | has(line, r"^(Mục|MỤC)\s+\d+")
        | F.upper(line).startswith("PHỤ LỤC")
        | _titled(line, APART)
    )


def starts_item(line: Column) -> Column:
    return has(line, r"^\d+[\.)](\s+.*)?$") | has(line, r"^[a-zA-ZđĐ][\.)](\s+.*)?$") | line.startswith("- ")


def lone_marker(line: Column) -> Column:
    return has(line, r"^\d+[\.)]$|^[a-zA-ZđĐ][\.)]$|^[-•]$")


def major_title(line: Column) -> Column:
    return _titled(line, MAJOR)


def opens_paragraph(line: Column) -> Column:
    return line.rlike(f"(?iU){OPENINGS}")


def joins_plain(before: Column, line: Column) -> Column:
    """Is the line joined to what stands before it? Yes, unless something speaks against it."""
    free = ~stands_apart(line) & ~starts_item(line) & ~stands_apart(before) & ~before.rlike("[.:;!?]$") & ~opens_paragraph(line)
    return (before != "") & (line != "") & (lone_marker(before) | free)


def _capitals(line: Column) -> Column:
    return line.rlike(r"\p{Lu}") & ~line.rlike(r"\p{Ll}") & (F.length(line) <= 80)


def plain_markdown_line(line: Column) -> Column:
    """A plain line as Markdown: titles and parts as headings, openings with emphasis, letters as list items."""
    return (
        F.when(line == "", "")
        .when(major_title(line), F.concat(F.lit("# "), line))
        .when(has(line, r"^(CHƯƠNG|Chương)\s+([IVXLCDM]+|\d+)"), F.concat(F.lit("## "), line))
        .when(has(line, r"^(MỤC|Mục|ĐIỀU|Điều)\s+\d+"), F.concat(F.lit("### "), line))
        .when(starts(line, ["Số:", "Số ", "Căn cứ"]), F.concat(F.lit("**"), line, F.lit("**")))
        .when(line.startswith("Theo đề nghị"), F.concat(F.lit("*"), line, F.lit("*")))
        .when(has(line, r"^[a-zA-ZđĐ]\)\s+"), F.concat(F.lit("- "), line))
        .when(line.startswith("- "), line)
        .when(_capitals(line), F.concat(F.lit("# "), line))
        .otherwise(line)
    )


def extract_line(line: Column) -> Column:
    """The same for bare extracts, whose lines are not joined: every line that starts with a title is one, and the
    lines of a signature are bold."""
    return (
        F.when(line == "", "")
        .when(starts(F.upper(line), FIRST), F.concat(F.lit("# "), line))
        .when(has(line, r"^(CHƯƠNG|Chương)\s+([IVXLCDM]+|\d+)"), F.concat(F.lit("## "), line))
        .when(has(line, r"^(MỤC|Mục|ĐIỀU|Điều)\s+\d+"), F.concat(F.lit("### "), line))
        .when(has(line, r"^\d+\.\s+"), line)
        .when(has(line, r"^[a-zA-ZđĐ]\)\s+"), F.concat(F.lit("- "), line))
        .when(starts(line, ["Số:", "Số ", "Căn cứ"]), F.concat(F.lit("**"), line, F.lit("**")))
        .when(line.startswith("Theo đề nghị"), F.concat(F.lit("*"), line, F.lit("*")))
        .when(starts(F.upper(line), [x.upper() for x in FOOT]), F.concat(F.lit("**"), line, F.lit("**")))
        .when(_capitals(line), F.concat(F.lit("# "), line))
        .otherwise(line)
    )
