"""Column functions over texts and lines.

All take and give columns, stay in the JVM and are null for null unless said otherwise. White space is Unicode's.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s"


def rx(c: Column, pattern: str, to: str = "") -> Column:
    """Replaces every match; classes and borders are Unicode's."""
    return F.regexp_replace(c, f"(?U){pattern}", to)


def strip(c: Column) -> Column:
    return rx(c, r"^\s+|\s+$")


def clean_text(c: Column) -> Column:
    """No NUL, LF line ends, single blanks, two line ends at most in a row, stripped; null gives ""."""
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\0"), F.lit(""))
    c = F.regexp_replace(c, "\r\n?", "\n")
    c = F.regexp_replace(c, "[ \t]{2,}|\t", " ")  # single blanks stay
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def clean_line(c: Column) -> Column:
    """One line: white space collapsed and stripped; null gives ""."""
    return strip(rx(F.coalesce(c, F.lit("")), r"\s{2,}|[^\S ]", " "))


def _decomposable() -> tuple[str, str, str]:
    marked, bases, marks = [], [], []
    for c in range(0x80, 0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        parts = unicodedata.normalize("NFD", ch)
        if unicodedata.category(ch).startswith("M"):
            marks.append(ch)
        elif len(parts) > 1 and all(unicodedata.category(x).startswith("M") for x in parts[1:]):
            marked.append(ch)
            bases.append(parts[0])
    return "".join(marked), "".join(bases), "".join(marks)


_MARKED, _BASES, _MARKS = _decomposable()


def fold(c: Column) -> Column:
    """Letters without their marks; đ is d."""
    return F.translate(c, "Đđ" + _MARKED + _MARKS, "Dd" + _BASES)


def match_key(c: Column, spaces: bool = True) -> Column:
    """What lines are compared by: no marks, lower case, letters and digits of ASCII only."""
    c = F.lower(fold(F.coalesce(c, F.lit(""))))
    c = strip(rx(F.regexp_replace(c, r"[^a-z0-9 \t\n\x0B\f\r]", " "), r"\s+", " "))
    return c if spaces else F.replace(c, F.lit(" "), F.lit(""))


def layout_key(c: Column) -> Column:
    """Lower case with single blanks, marks kept."""
    return clean_line(F.lower(F.coalesce(c, F.lit(""))))


def safe_stem(c: Column, longest: int = 120) -> Column:
    """A file stem any file system takes; longer ones end in a digest, empty ones are "untitled"."""
    name = F.regexp_replace(F.coalesce(c, F.lit("")), r'[<>:"/\\|?*\x00-\x1f]', "_")
    name = F.regexp_replace(rx(name, r"\s+", "_"), r"^[._ ]+|[._ ]+$", "")
    short = F.concat(F.left(name, F.lit(longest)), F.lit("_"), F.left(F.md5(name.cast("binary")), F.lit(8)))
    return F.when(name == "", "untitled").when(F.length(name) > longest, short).otherwise(name)


def upper_ratio(c: Column) -> Column:
    """Share of upper-case letters among the letters; 0 without letters."""
    letters = F.length(F.regexp_replace(c, r"\P{L}", ""))
    return F.when(letters == 0, 0.0).otherwise(F.length(F.regexp_replace(c, r"\P{Lu}", "")) / letters)


def edge_key(c: Column) -> Column:
    """What running lines are compared by: lower case, numbers as #."""
    return rx(F.lower(clean_line(c)), r"\d+", "#")


def cell_escape(c: Column) -> Column:
    """A value as a cell of a Markdown table; null gives ""."""
    c = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit("<br>")), F.lit("|"), F.lit(r"\|"))
    return strip(rx(c, r"\s+", " "))


def title_text(c: Column) -> Column:
    """A table's title without breaks, tags and marks of emphasis."""
    c = F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", " "), r"<[^>]+>", " ")
    return F.regexp_replace(rx(F.regexp_replace(c, r"[*_`#]", ""), r"\s+", " "), r"^[ |]+|[ |]+$", "")


def title_key(c: Column) -> Column:
    return F.upper(title_text(c))


def trim_rules(c: Column) -> Column:
    """A page block without rules at its end."""
    return F.regexp_replace(strip(c), r"(?:\s*\n-{3,}\s*)+$", "")


def page_list(c: Column) -> Column:
    """Pages of "4,6,8-10": ranges in either order, pages from 1, each once, ascending; null gives none."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x.rlike(r"^\d+(\s*-\s*\d+)?$"))
    ends = F.transform(parts, lambda x: F.transform(F.split(x, r"\s*-\s*"), lambda y: y.cast("int")))
    pages = F.flatten(F.transform(ends, lambda x: F.sequence(F.array_min(x), F.array_max(x))))
    return F.array_sort(F.array_distinct(F.filter(pages, lambda p: p >= 1)))


# Labels of form fields and of boxes to tick.
FIELDS = ["Họ và tên", "Ngày sinh", "Giới tính", "CCCD", "Nơi cấp", "Tên cơ sở", "Hệ đào tạo", "Ngành", "Mã ngành", "Loại hình đào tạo"]
TICKS = ["Nam", "Nữ", "Có", "Không"]


def form_layout(c: Column) -> Column:
    """Dot leaders as one blank, boxes to tick as [ ], labels behind a blank on a line of their own."""
    ticks, fields = "|".join(TICKS), "|".join(FIELDS)
    c = F.regexp_replace(c, r"\.{6,}", "________")
    c = rx(c, r"\s+…{2,}", " ________")
    c = F.regexp_replace(c, rf"(?iU)\b({ticks})\s+[O0□☐]\b", "$1 [ ]")
    c = F.regexp_replace(c, rf"(?iU)[O0□☐]\s+({ticks})\b", "[ ] $1")
    return F.regexp_replace(c, rf"(?iU)(__+)\s+({fields})", "$1\n$2")


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def is_number(c: Column) -> Column:
    return F.coalesce(F.expr("NULL") if c is None else c.cast("string").try_cast("double").isNotNull(), F.lit(False))


def better_text(first: Column, second: Column) -> Column:
    """Of two readings of a crop: the one with an @ the other lacks, with fewer "?", or clearly longer without "?"."""
    a, b = clean_line(first), clean_line(second)
    marks = lambda x: F.length(x) - F.length(F.replace(x, F.lit("?"), F.lit("")))
    return (
        F.when(a == "", b)
        .when(b == "", a)
        .when(b.contains("@") & ~a.contains("@"), b)
        .when(marks(a) > marks(b), b)
        .when((F.length(b) > F.length(a) + 5) & ~b.contains("?"), b)
        .otherwise(a)
    )


def first_text(readings: Column) -> Column:
    """The first of several readings (an array, in the order they were tried) that says something, cleaned; else ""."""
    said = F.filter(F.transform(readings, clean_text), lambda x: x != "")
    return F.coalesce(F.get(said, F.lit(0)), F.lit(""))


def html_text(c: Column) -> Column:
    """The readable text of HTML: no scripts, styles, comments or tags; blocks end lines; common entities resolved."""
    c = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?i)<br\s*/?>|</(?:p|div|li|tr|h[1-6]|table|ul|ol)\s*>", "\n")
    c = F.regexp_replace(c, r"(?s)<[^>]*>", "")
    for entity, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(ch))
    return clean_text(F.regexp_replace(c, r" *\n *", "\n"))
