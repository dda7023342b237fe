"""Predicates over lines and what they make of a line in Markdown. All take cleaned lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.text import match_key, strip, upper_ratio

# Titles that stand alone, prefixes of form titles, prefixes of what headings with a marker say.
TITLES = ["quyet dinh", "quy dinh", "thong bao", "cong van", "ke hoach", "huong dan", "quy che", "noi quy", "phu luc", "bieu mau", "quy trinh"]
FORM_TITLES = ["to khai thong tin", "mau to khai", "mau bao cao", "phu luc i", "phu luc ii", "phu luc iii", "noi dung vi pham va khung xu ly"]
HEADINGS = [
    "quy trinh", "noi dung quy trinh", "noi dung cong viec", "co so thuc hien", "muc dich", "yeu cau", "pham vi ap dung", "van ban ap dung",
    "giai thich tu ngu", "tu viet tat", "luu do", "khung ke hoach thuc hien", "doi tuong", "dieu kien", "ho so", "thanh phan ho so",
    "trinh tu thuc hien", "cach thuc thuc hien", "thoi gian thuc hien", "don vi thuc hien", "don vi phoi hop", "can cu phap ly",
    "ket qua thuc hien", "ghi chu", "chu thich",
]
# Starts of lines that stay by themselves; words after which a sentence goes on, and with which it does.
APART = ["Kính gửi:", "Nơi nhận:", "KT.", "TM.", "TL.", "- ", "+ ", "• "]
OPEN_WORDS = [
    "và", "hoặc", "của", "theo", "gồm", "bao gồm", "để", "với", "từ", "đến", "trong", "ngoài", "khi", "nếu", "do", "bởi", "về", "cho", "tại",
    "chương", "ban", "quý", "các", "những", "đề nghị", "trân trọng", "nhà trường",
]
JOINING = ["và", "hoặc", "của", "theo", "với", "trong", "ngoài", "để", "nhằm", "khi", "nếu"]
SIGNATURES = ["Nơi nhận:", "KT.", "TM.", "PHÓ", "TỔNG"]
# Starts of lines that are items after a line that announces a list.
BULLETED = ["Sinh viên ", "Học sinh ", "Điểm trung bình", "Đánh giá rèn luyện", "Ưu tiên ", "Bản sao ", "Giấy xác nhận", "Đơn ", "Phiếu ", "Minh chứng "]

# Patterns of markers.
NUMBER = r"^(\d+\.\d+(?:\.\d+)*\.?|\d+[\.)])\s+(.+)$"
ROMAN = r"^([IVXLCDMivxlcdm]+)[\.)]\s+(.+)$"
LETTER = r"^([a-zA-ZđĐ])[\.)/]\s+(.+)$"


def starts(c: Column, values: list[str]) -> Column:
    """Does it start with one of these? One expression, whatever their number."""
    return c.rlike("^(?:" + "|".join(rf"\Q{v}\E" for v in values) + ")")


def has(c: Column, pattern: str) -> Column:
    return c.rlike(f"(?U){pattern}")


@dataclass(frozen=True)
class Line:
    """A cleaned line with what its predicates share: its marker and the keys of the line and of its content.

    Over a DataFrame, ``pages.analysed`` has these as columns, so that each is computed once per line.
    """

    c: Column
    marker: Column
    key: Column
    content_key: Column

    @classmethod
    def of(cls, x: Column | Line) -> Line:
        if isinstance(x, Line):
            return x
        m = marker(x)
        return cls(x, m, match_key(x), match_key(m["content"]))


def is_article(x: Column | Line) -> Column:
    return has(Line.of(x).c, r"^(Điều|ĐIỀU|Dieu|DIEU)\s+\d+[\.:]?\s*")


def is_chapter(x: Column | Line) -> Column:
    return has(Line.of(x).c, r"^(Chương|CHƯƠNG|Chuong|CHUONG)\s+([IVXLCDM]+|\d+)")


def is_section(x: Column | Line) -> Column:
    return has(Line.of(x).c, r"^(Mục|MỤC|Muc|MUC)\s+\d+")


def is_title(x: Column | Line) -> Column:
    key = Line.of(x).key
    return key.isin(TITLES) | (starts(key, FORM_TITLES) & (F.length(key) <= 120))


def is_contents(c: Column) -> Column:
    return has(c, r"\.{4,}|\s\.{2,}\s*\d+\s*$")


def marker(c: Column) -> Column:
    """STRUCT kind (number, roman, letter or null), mark, content; a line without a marker is all content."""

    def split(kind: str, pattern: str) -> Column:
        p = f"(?U){pattern}"
        return F.struct(F.lit(kind).alias("kind"), F.regexp_extract(c, p, 1).alias("mark"), strip(F.regexp_extract(c, p, 2)).alias("content"))

    none = F.struct(F.lit(None).cast("string").alias("kind"), F.lit("").alias("mark"), c.alias("content"))
    return F.when(has(c, NUMBER), split("number", NUMBER)).when(has(c, ROMAN), split("roman", ROMAN)).when(has(c, LETTER), split("letter", LETTER)).otherwise(none)


def is_process(x: Column | Line) -> Column:
    """The heading of a process or a flow chart, behind its marker if it has one."""
    x = Line.of(x)
    return (x.c != "") & x.content_key.rlike(r"^(quy trinh|luu do)\b") & ~is_contents(x.c)


def is_strong_heading(c: Column, key: Column | None = None) -> Column:
    return starts(match_key(c) if key is None else key, HEADINGS) | ((F.length(c) <= 130) & (upper_ratio(c) >= 0.65))


def says_heading(c: Column, key: Column | None = None) -> Column:
    """Does what stands behind a marker read like a heading?"""
    sentence = (F.length(c) > 120) & has(c, "[.;,]$")
    return (c != "") & ~is_contents(c) & ~sentence & (is_strong_heading(c, key) | ((F.length(c) <= 90) & c.endswith(":")))


def marker_level(x: Column | Line) -> Column:
    """The level of a heading by its marker, or null."""
    x = Line.of(x)
    m, content = x.marker, x.marker["content"]
    depth = F.length(F.regexp_replace(F.regexp_replace(m["mark"], r"[.)]+$", ""), r"[^.]", ""))
    after = strip(F.regexp_extract(content, "(?s)^[^:]*:(.*)$", 1))
    explained = content.contains(":") & (after != "") & (F.size(F.split(after, r"(?U)\s+")) >= 3)
    return F.when(
        m["kind"].isNotNull() & says_heading(content, x.content_key),
        F.when(m["kind"] == "roman", 2)
        .when((m["kind"] == "number") & (depth == 0), F.when(is_strong_heading(content, x.content_key), 2))
        .when((m["kind"] == "number") & (depth == 1), 3)
        .when(m["kind"] == "number", 4)
        .when(~explained, 4),
    )


def is_structural(x: Column | Line, level: Column | None = None) -> Column:
    """Lines that are never joined to the one before."""
    x = Line.of(x)
    return (
        (x.c == "")
        | starts(x.c, ["<!--", "#", *APART])
        | x.c.rlike(r"\.{6,}|_{4,}|\[ \]")
        | is_article(x)
        | is_chapter(x)
        | is_section(x)
        | is_title(x)
        | is_process(x)
        | (marker_level(x) if level is None else level).isNotNull()
    )


def is_item(c: Column) -> Column:
    return has(c, r"^(-|\+|•)\s+|^(\d+\.\d+(?:\.\d+)*\.?|\d+[\.)])\s+|^([IVXLCDMivxlcdm]+)[\.)]\s+|^([a-zA-ZđĐ])[\.)/]\s+")


def ends_open(c: Column) -> Column:
    """Does the sentence go on after this line?"""
    return has(c, "[,;:\\-–]$") | F.lower(c).rlike("(?:^| )(?:" + "|".join(OPEN_WORDS) + ")$")


def goes_on(c: Column) -> Column:
    return c.rlike(r"^\p{Ll}") | c.rlike(r"(?iU)^(?:" + "|".join(JOINING) + r")\b")


def joins_after(before: Column, line: Column, goes: Column, eager: bool = False) -> Column:
    """Does a line that may be joined continue what stands before it? ``goes``: goes_on(line)."""
    shouted = (F.length(before) > 8) & before.rlike(r"\p{L}") & (F.upper(before) == before)
    more = ends_open(before) | goes
    if eager:
        more = more | ~starts(line, SIGNATURES)
    return (before != "") & ~before.rlike(r"[.;:!?]$") & ~shouted & more


def joins(before: Column, line: Column, eager: bool = False) -> Column:
    """Is the line the continuation of the one before it?"""
    return (line != "") & ~is_structural(line) & ~is_item(line) & joins_after(before, line, goes_on(line), eager)


def markdown_line(x: Column | Line, level: Column | None = None) -> Column:
    """A line as Markdown: the first rule that holds gives its level."""
    x = Line.of(x)
    level = marker_level(x) if level is None else level
    return (
        F.when(x.c.startswith("<!--"), x.c)
        .when(is_title(x), F.concat(F.lit("# "), x.c))
        .when(is_process(x), F.concat(F.lit("## "), x.c))
        .when(level.isNotNull(), F.concat(F.repeat(F.lit("#"), level), F.lit(" "), x.c))
        .when(is_chapter(x), F.concat(F.lit("## "), x.c))
        .when(is_section(x) | is_article(x), F.concat(F.lit("### "), x.c))
        .otherwise(x.c)
    )


def is_page_number(c: Column) -> Column:
    return has(c, r"^\d+$")


def is_isolated_marker(c: Column) -> Column:
    return has(c, r"^(?:\d+[.)]|[a-zA-ZđĐ][.)]|[-+•])$")


def suspicious_signs(c: Column) -> Column:
    """Lines whose special characters a second recogniser should read again."""
    return c.rlike(r"(?iU)\?|Email|ĐT|Điện thoại|www|http|\(Q|\sQ[A-Za-z0-9]|[A-Za-z0-9._%+\-]+\s+[QO0]\s*[A-Za-z0-9.\-]+\.(vn|com|edu\.vn)")


def is_watermark(c: Column) -> Column:
    return c.rlike(r"(?iU)^\s*(scanned\s+with\s+(cs\s*)?camscanner|scanned\s+with\s+cs|camscanner)\s*$")


