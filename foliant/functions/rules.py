"""Ordered rewrite rules: data compiled to one column expression at plan time."""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.text import clean_text, rx


@dataclass(frozen=True)
class Rule:
    """A regular expression and what replaces it ($1 for groups), or a literal."""

    pattern: str
    to: str
    ignore_case: bool = True
    literal: bool = False
    #: A cheap pattern that every text with a match has; others are passed by.
    needs: str | None = None

    def apply(self, c: Column) -> Column:
        if self.literal:
            return F.replace(c, F.lit(self.pattern), F.lit(self.to))
        out = F.regexp_replace(c, ("(?iU)" if self.ignore_case else "(?U)") + self.pattern, self.to)
        return out if self.needs is None else F.when(c.rlike(self.needs), out).otherwise(c)


def compile_rules(c: Column, rules: Sequence[Rule]) -> Column:
    for rule in rules:
        c = rule.apply(c)
    return c


def _words(pattern: str) -> list[str]:
    """The plain pieces of a pattern of words, in lower case: every match has them all."""
    pieces = re.split(r"\\b|\\s[+*]|\[[^\]]*\]|\.\*\?|:\?", pattern)
    return [x.lower() for x in pieces if len(x) > 1]


def gated(c: Column, rules: Sequence[tuple[str, str, list[str], bool]]) -> Column:
    """Applies rules (pattern, what replaces it, pieces that every match has in lower case, ignore case) in their order.

    The rules are data of one fold over them. A rule's pattern is only run on texts with all its pieces, which are far
    cheaper to look for than a pattern; the text's lower-case form follows every rule that was run.
    """
    table = F.array(*(F.struct(F.array(*map(F.lit, w)).alias("words"), F.lit(("(?iU)" if i else "(?U)") + p).alias("pattern"), F.lit(to).alias("to")) for p, to, w, i in rules))
    pair = lambda x: F.struct(x.alias("text"), F.lower(x).alias("low"))

    def one(acc: Column, rule: Column) -> Column:
        return F.when(F.forall(rule["words"], lambda w: F.contains(acc["low"], w)), pair(F.regexp_replace(acc["text"], rule["pattern"], rule["to"]))).otherwise(acc)

    # Bound to a lambda's variable, the text is computed once for both forms.
    return F.aggregate(table, F.get(F.transform(F.array(c), pair), F.lit(0)), one, lambda acc: acc["text"])


# Glyphs of bullets and dashes, and quotes.
GLYPHS = [("●", "•"), ("·", "•"), ("▪", "•"), ("\uf0a7", "•"), ("\uf02d", "-"), ("—", "–"), ("−", "-"), ("„", "“"), ("‟", "”"), ("''", '"'), ("``", '"')]
# Frequent misreadings in administrative Vietnamese, as patterns and what is right, in this order, case ignored.
MISREADINGS = [
    (r"\bCăn\s+cử\b", "Căn cứ"), (r"\bCăn\s+củ\b", "Căn cứ"), (r"\bCăn\s+cửu\b", "Căn cứ"),
    (r"\btin dụng\b", "tín dụng"), (r"\btin\s+dụng\b", "tín dụng"), (r"\bđảo tạo\b", "đào tạo"), (r"\bĐào tào\b", "Đào tạo"),
    (r"\bđề\s+giải ngân\s+v[ôo]n\s+vay\b", "để giải ngân vốn vay"), (r"\bđề\s+hỗ trợ\b", "để hỗ trợ"),
    (r"\bkỳ han\b", "kỳ hạn"), (r"\bkỳ hạrn\b", "kỳ hạn"), (r"\bv[ôo]n vay\b", "vốn vay"), (r"\btỉnh hình\b", "tình hình"), (r"\bthay döi\b", "thay đổi"),
    (r"\bnganh, linh vuc\b", "ngành, lĩnh vực"), (r"\bnghi học\b", "nghỉ học"), (r"\bđóng dầu\b", "đóng dấu"),
    (r"\bnghiện cứu sinh\b", "nghiên cứu sinh"), (r"\bnghi[êe]n cứu sinh\b", "nghiên cứu sinh"), (r"\bthạc sỹ\b", "thạc sĩ"),
    (r"\bhọc bồng\b", "học bổng"), (r"\bđỉnh kèm\b", "đính kèm"), (r"\bkhoá học\b", "khóa học"),
    (r"\bviệt nam\b", "Việt Nam"), (r"\bnhà nước việt nam\b", "Nhà nước Việt Nam"), (r"\bngân hàng nhà nước việt nam\b", "Ngân hàng Nhà nước Việt Nam"),
    (r"\bbộ tài chính\b", "Bộ Tài chính"), (r"\bbộ giáo dục và đào tạo\b", "Bộ Giáo dục và Đào tạo"),
    (r"\bngân hàng chính sách xã hội\b", "Ngân hàng Chính sách xã hội"), (r"\bngân hàng chính sách xả hội\b", "Ngân hàng Chính sách xã hội"),
    (r"\bThủ tướng chính phủ\b", "Thủ tướng Chính phủ"), (r"\bphó thủ tướng chính phủ\b", "Phó Thủ tướng Chính phủ"), (r"\bchính phủ\b", "Chính phủ"),
    (r"\bCộng hòa xã hội chủ nghĩa việt nam\b", "Cộng hòa xã hội chủ nghĩa Việt Nam"), (r"\bCọng hòa xã hội chủ nghĩa việt nam\b", "Cộng hòa xã hội chủ nghĩa Việt Nam"),
    (r"\bCÒ G HÒA XÃ HỘI CHỦ NGHĨA VIỆT NAM\b", "CỘNG HÒA XÃ HỘI CHỦ NGHĨA VIỆT NAM"),
    (r"\bDai hoc\b", "Đại học"), (r"\bDẠI HỌC\b", "ĐẠI HỌC"), (r"\bQuyet dinh\b", "Quyết định"), (r"\bQUYET DINH\b", "QUYẾT ĐỊNH"),
    (r"\bThong bao\b", "Thông báo"), (r"\bTHONG BAO\b", "THÔNG BÁO"), (r"\bSinh vien\b", "Sinh viên"), (r"\bSINH VIEN\b", "SINH VIÊN"),
    (r"\bHoc vu\b", "Học vụ"), (r"\bHOC VU\b", "HỌC VỤ"), (r"\bCong tac sinh vien\b", "Công tác sinh viên"), (r"\bCONG TAC SINH VIEN\b", "CÔNG TÁC SINH VIÊN"),
    (r"\bPhong Dao tao\b", "Phòng Đào tạo"), (r"\bDao tao\b", "Đào tạo"), (r"\bHieu truong\b", "Hiệu trưởng"), (r"\bUu tiên\b", "Ưu tiên"),
    (r"\bM[ẪÃA]U\s+2\s+Ở\s+KÍ:?\s+AI\s+THÔNG\s+TIN\b", "MẪU TỜ KHAI THÔNG TIN"), (r"\bMAU\s+T[OỜ]\s+KHAI\b", "MẪU TỜ KHAI"),
    (r"\bNGÂN\s+JANG\s+CHÍNH\s+SÁCH\s+XÃ\s+HỘI\b", "NGÂN HÀNG CHÍNH SÁCH XÃ HỘI"), (r"\bTỜ\s+KHAI\s+THÔNG\s+TIN\s+HẰNG\s+NÃM\b", "TỜ KHAI THÔNG TIN HẰNG NĂM"),
    (r"\bMÀ\s+50\s*-U.*?THÔNG\s+TIN\s+HÀNG\s+NĂM\s+CỦA\s+NGƯỜI\s+HỌC\b", "MẪU TỜ KHAI THÔNG TIN HẰNG NĂM CỦA NGƯỜI HỌC"),
    (r"\bCCCD\s+số\b", "CCCD số"), (r"\bCCD\s+số\b", "CCCD số"), (r"\bngày cấp\b", "ngày cấp"),
]
# Abbreviations that are glued to the word behind them; other glued words, case ignored, each with a word of it.
GLUED = ["CTSV", "ĐRL", "CVHT", "QĐ", "BGH", "SV", "CTCT", "KHTH", "SQDB", "TTGDQP", "QK9"]
GLUED_WORDS = [
    (r"\b(Khoa)(tổng|thông|xét|cấp)\b", "$1 $2", "khoa"), (r"\b(Phòng)(CTSV|CTCT|Đào tạo|KHTH)\b", "$1 $2", "phòng"), (r"\b(PhòngCTSV)\b", "Phòng CTSV", "phòngctsv"),
    (r"\b(đơn vị)(quản lý|đào tạo)\b", "$1 $2", "đơn vị"), (r"\b(sinh viên)(đang|nhận|dự|có)\b", "$1 $2", "sinh viên"),
]
# Addresses, telephone numbers, spacing, dashes and watermarks of scanners.
LINKS = [
    Rule(r"([A-Za-z0-9._%+\-]+)\s*[\(\[]?\s*(?:@|Q|O|0|©|ⓐ)\s*([A-Za-z0-9.\-]+\.(?:vn|com|edu\.vn|org|net))", "$1@$2", needs=r"(?i)\.(?:vn|com|org|net)"),
    Rule(r"(https?://)\s+", "$1"),
    Rule(r"(www\.)\s+", "$1"),
    Rule(r"\s+(/[^\s]*)", "$1", False),
]
PHONE = r"\b(ĐT\s*:?\s*|Điện thoại\s*:?\s*)([0-9][0-9 .\-]{7,})"
SPACING = [
    Rule(r"\b(số|Số)(\d)", "$1 $2", False),
    Rule(r"\b(ngày)(\d{1,2})\b", "$1 $2"),
    Rule(r"([A-Za-zÀ-ỹ0-9])([“\"])", "$1 $2", False),
    Rule(r"([”\"])([A-Za-zÀ-ỹ0-9])", "$1 $2", False),
]
GLUED_RULES = [(rf"\b({x})(?=[A-Za-zÀ-ỹ])", "$1 ", [x.lower()], False) for x in GLUED] + [(a, b, [w], True) for a, b, w in GLUED_WORDS]
# Of the words before a "?" only the last sign decides; they stay as they are.
QUESTION_DASH = r"([A-Za-zÀ-ỹ0-9\)])\?\s+([A-ZĐÀ-Ỹ][A-Za-zÀ-ỹ0-9]+)"
WATERMARKS = [Rule(r"(?m)^\s*scanned\s+with\s+(cs\s*)?camscanner\s*$", ""), Rule(r"(?m)^\s*camscanner\s*$", "")]


def basic_signs(c: Column) -> Column:
    """One glyph for each bullet, dash and quote; no blanks inside brackets or before punctuation."""
    c = compile_rules(F.coalesce(c, F.lit("")), [Rule(a, b, literal=True) for a, b in GLYPHS])
    c = rx(c, r"\s+([,.;:!?])", "$1")
    c = rx(c, r"([(\[{“])\s+", "$1")
    return clean_text(rx(c, r"\s+([)\]}”])", "$1"))


def common_words(c: Column) -> Column:
    """The frequent misreadings put right, each by its own pattern: blanks match as the pattern has them."""
    return gated(c, [(a, b, _words(a), True) for a, b in MISREADINGS])


def phone_numbers(c: Column) -> Column:
    """Numbers of eight characters and more behind a telephone label lose all their blanks."""
    found = F.regexp_extract_all(c, F.lit(f"(?iU){PHONE}"), 0)
    whole = F.transform(found, lambda m: F.concat(F.regexp_extract(m, f"(?iU)^{PHONE}", 1), F.replace(F.regexp_extract(m, f"(?iU)^{PHONE}", 2), F.lit(" "), F.lit(""))))
    # What stands between the matches, each with the match behind it.
    out = F.array_join(F.zip_with(F.split(c, f"(?iU){PHONE}", -1), whole, lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), "")
    return F.when(c.rlike(f"(?iU){PHONE}"), out).otherwise(c)


def question_dashes(c: Column) -> Column:
    """A "?" between two noun phrases was a dash."""
    c = Rule(QUESTION_DASH, "$1 – $2", False, needs=r"\?").apply(c)
    return F.replace(c, F.lit(" ? "), F.lit(" – "))


def common_layer(c: Column) -> Column:
    """The general layer: signs, links, telephone numbers, misreadings, spacing, dashes, signs, watermarks."""
    c = phone_numbers(compile_rules(basic_signs(c), LINKS))
    c = clean_text(gated(compile_rules(common_words(c), SPACING), GLUED_RULES))
    return clean_text(compile_rules(basic_signs(question_dashes(c)), WATERMARKS))


def term_layer(c: Column, terms: Sequence[Rule]) -> Column:
    """The layer of a project's own terms, which are a parameter."""
    return clean_text(compile_rules(c, terms))


def user_rules(text: str) -> list[Rule]:
    """Rules of a JSON document {"replace": {..}, "regex_replace": [{pattern, replacement, flags}]}.

    Literals come first, in their order. Invalid JSON gives no rules, an invalid pattern a warning and no rule.
    """
    try:
        data = json.loads(text)
    except ValueError:
        return []
    out = [Rule(str(a), str(b), literal=True) for a, b in (data.get("replace") or {}).items() if a]
    for x in data.get("regex_replace") or []:
        pattern, to = str(x.get("pattern") or ""), str(x.get("replacement") or "")
        try:
            re.compile(pattern)
        except re.error as e:
            warnings.warn(f"rule left out: {pattern!r}: {e}", stacklevel=2)
            continue
        if pattern:
            to = re.sub(r"\\(\d)|\\g<(\d)>", lambda m: "\0" + (m[1] or m[2]), to).replace("\\", "\\\\").replace("$", "\\$").replace("\0", "$")
            out.append(Rule(pattern, to, "i" in str(x.get("flags") or "").lower()))
    return out


def three_layers(c: Column, common: bool = True, terms: Sequence[Rule] | None = None, user: Sequence[Rule] | None = None) -> Column:
    """The layers that are on, in their order; which ones is decided at plan time."""
    if common:
        c = common_layer(c)
    if terms:
        c = term_layer(c, terms)
    return compile_rules(c, user) if user else c
