"""Is the text layer of a page usable? Decisions per page and per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.lines import suspicious_signs
from foliant.functions.rules import common_layer
from foliant.functions.text import better_text, clean_line, fold, ratio, strip

# Fragments that broken Vietnamese text layers show.
NOISE = ["BQ GIAO", "Dl)C", "DAo T~o", "TRUONGD", "D~IHQ", "cANTHa", "DQc l", "H~nh", "QUYETDJNH", "Gido due", "Ludt", "a6i", "b6 sung", "vAn", "sire khoe", "ngO'01", "Di~u", "Can Clf", "thea"]
# Letters with Vietnamese marks; the range that counts as letters; frequent words without marks.
MARKED = "[àáạảãâầấậẩẫăằắặẳẵèéẹẻẽêềếệểễìíịỉĩòóọỏõôồốộổỗơờớợởỡùúụủũưừứựửữỳýỵỷỹđÀÁẠẢÃÂẦẤẬẨẪĂẰẮẶẲẴÈÉẸẺẼÊỀẾỆỂỄÌÍỊỈĨÒÓỌỎÕÔỒỐỘỔỖƠỜỚỢỞỠÙÚỤỦŨƯỪỨỰỬỮỲÝỴỶỸĐ]"
LETTER = "[A-Za-zÀ-ỹĐđ]"
FREQUENT = [
    "bo", "giao", "duc", "dao", "tao", "truong", "dai", "hoc", "can", "tho", "cong", "hoa", "xa", "hoi", "chu", "nghia", "viet", "nam", "doc", "lap",
    "tu", "do", "hanh", "phuc", "quyet", "dinh", "quy", "che", "cu", "luat", "nghi", "so", "ngay", "thang", "dieu", "khoan", "diem", "muc", "chuong",
    "phu", "luc", "ban", "kem", "theo", "hieu", "phong", "khoa", "vien", "trung", "tam", "don", "vi", "sinh", "nguoi", "tac", "suc", "khoe", "ly", "noi",
    "dung", "thuc", "hien", "duoc", "voi", "ve", "va", "cua", "cho", "trong", "ngoai", "phoi", "hop", "bao", "cao", "trach", "nhiem", "quan", "lien",
    "thong", "tin", "thoi", "gian",
]


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(f"(?U){pattern}"))


def is_bad(text: Column) -> Column:
    """The plain test: too short, several noise fragments, or odd signs or glued capitals without marks."""
    c = F.left(F.coalesce(text, F.lit("")), F.lit(3000))
    bad = sum((F.contains(c, F.lit(x)).cast("int") for x in NOISE[1:]), F.contains(c, F.lit(NOISE[0])).cast("int"))
    marks = ratio(count(c, MARKED), F.greatest(count(c, LETTER), F.lit(1)))
    odd, glued = count(c, r"[~\}\{\]\[\)\(]"), count(c, r"\b[A-ZĐ]{8,}\b")
    return (F.length(strip(F.coalesce(text, F.lit("")))) < 50) | (bad >= 3) | ((odd >= 8) & (marks < 0.04)) | ((glued >= 5) & (marks < 0.05))


def with_report(df: DataFrame, text: str) -> DataFrame:
    """Adds ``report``: the measures of the scored test, its reasons and whether the layer is bad (score 4 or more).

    Texts under 30 characters are not bad and have no measures. Null counts as "". The sample is the first 6,000
    characters: a page's text layer is bad from its start or not at all.
    """
    names = list(df.columns)
    df = df.withColumn("_t", strip(F.coalesce(F.col(text), F.lit("")))).withColumn("_s", F.left("_t", F.lit(6000)))
    s, word = F.col("_s"), r"[a-zà-ỹđ]"
    signs = r"[~\\{}\[\]<>£^\)\(]"
    inside = rf"(?i)\b{word}+\d+{word}+\b|\b{word}+\s+\d+{word}+\b"
    symbol = rf"(?i)\b{word}*{signs}+{word}+\b|\b{word}+{signs}+{word}*\b"
    # A projection between the measures and what is made of them keeps each measure to one evaluation.
    # All tokens are folded in one pass.
    df = df.withColumn("_tokens", F.regexp_extract_all(s, F.lit("([A-Za-zÀ-ỹĐđ0-9_]+)"), 1))
    df = df.withColumn("_plain", F.split(F.lower(fold(F.array_join("_tokens", " "))), " "))
    df = df.withColumns(
        {
            "_n": F.size("_tokens"),
            "_letters": count(s, LETTER),
            "_marks": count(s, MARKED),
            "_weird": count(s, r"[~\\{}\[\]<>£^�]"),
            "_suspicious": count(s, inside) + count(s, symbol),
            "_mojibake": count(s, "�|Ã.|Ä.|Æ.|Ð."),
            "_glued": count(s, r"\b[A-ZĐ]{10,}\b"),
            "_common": F.size(F.filter("_plain", lambda x: x.isin(FREQUENT))),
            "_long": F.size(F.filter("_tokens", lambda x: F.length(x) >= 22)),
        }
    )
    n = F.greatest("_n", F.lit(1))
    df = df.withColumns(
        {
            "_mark_ratio": ratio(F.col("_marks"), F.col("_letters")),
            "_common_ratio": ratio(F.col("_common"), n),
            "_weird_ratio": ratio(F.col("_weird"), F.greatest(F.length("_s"), F.lit(1))),
            "_suspicious_ratio": ratio(F.col("_suspicious"), n),
            "_glued_ratio": ratio(F.col("_glued"), n),
            "_long_ratio": ratio(F.col("_long"), n),
        }
    )
    c = F.col
    no_marks = (c("_common_ratio") >= 0.16) & (c("_mark_ratio") < 0.018) & (c("_letters") >= 120)
    steps = [
        (c("_mojibake") >= 2, 5, "mojibake_or_encoding_noise"),
        (c("_suspicious_ratio") >= 0.08, 4, "many_tokens_with_digit_or_symbol_inside"),
        ((c("_suspicious_ratio") < 0.08) & (c("_suspicious_ratio") >= 0.035), 2, "some_tokens_with_digit_or_symbol_inside"),
        (c("_weird_ratio") >= 0.012, 3, "high_weird_character_ratio"),
        ((c("_weird_ratio") < 0.012) & (c("_weird") >= 5), 1, "weird_characters_present"),
        ((c("_glued_ratio") >= 0.035) | (c("_glued") >= 4), 2, "glued_uppercase_words"),
        (c("_long_ratio") >= 0.04, 2, "many_unusually_long_tokens"),
        (no_marks, 4, "vietnamese_context_but_almost_no_diacritics"),
        (~no_marks & (c("_common_ratio") >= 0.12) & (c("_mark_ratio") < 0.035) & (c("_suspicious_ratio") >= 0.02), 2, "vietnamese_context_low_diacritics_with_noise"),
    ]
    good = (c("_common_ratio") >= 0.10) & (c("_mark_ratio") >= 0.055) & (c("_suspicious_ratio") < 0.025) & (c("_weird") <= 3)
    raw = sum((F.when(x, p).otherwise(0) for x, p, _ in steps[1:]), F.when(steps[0][0], steps[0][1]).otherwise(0))
    score = F.when(good, F.greatest(F.lit(0), raw - 3)).otherwise(raw)
    reasons = F.array_join(F.array_compact(F.array(*(F.when(x, name) for x, _, name in steps), F.when(good, "looks_like_valid_vietnamese_text"))), ",")
    short = F.length("_t") < 30

    def measure(name: str, value: Column) -> Column:
        return F.when(~short, value).alias(name)

    report = F.struct(
        (~short & (score >= 4)).alias("is_bad"),
        F.when(short, 0).otherwise(score).cast("int").alias("score"),
        F.when(short, "text_layer_too_short_or_empty").when(reasons == "", "ok").otherwise(reasons).alias("reason"),
        F.length("_t").alias("length"),
        measure("token_count", c("_n")),
        measure("mark_ratio", F.round("_mark_ratio", 4)),
        measure("common_ratio", F.round("_common_ratio", 4)),
        measure("weird_char_count", c("_weird")),
        measure("weird_char_ratio", F.round("_weird_ratio", 4)),
        measure("suspicious_token_count", c("_suspicious")),
        measure("suspicious_token_ratio", F.round("_suspicious_ratio", 4)),
        measure("mojibake_count", c("_mojibake")),
        measure("glued_upper_words", c("_glued")),
        measure("long_token_count", c("_long")),
    )
    return df.select(*(F.col(f"`{n}`") for n in names), report.alias("report"))


def dropped_layer(df: DataFrame, text: str, image_ratio: str, largest_image: str | None = None, min_chars: int = 30, force: bool = False, judge: bool = True) -> DataFrame:
    """Adds ``report`` and ``drop_layer``: is the text layer to be left out, and the page read from its image?

    Forced layers are; too short ones are not, for they are no bad layers (reason text_too_short). Otherwise bad ones
    are, and the weak layers of pages that look like scans: images of most of the page, some frequent words, few
    marks and signs of noise; ``report`` then says that they are bad and why. ``judge`` off keeps all layers.
    ``image_ratio`` is the share of the page under images, ``largest_image`` that under the largest one, where known.
    """
    names = [c for c in df.columns if c not in ("report", "drop_layer")]
    df = with_report(df.select(*(F.col(f"`{c}`") for c in names)), text)
    none = F.lit(0.0)
    largest = F.coalesce(F.col(largest_image), none) if largest_image else none
    scan = (largest >= 0.55) | (F.coalesce(F.col(image_ratio), none) >= 0.70)
    r = F.col("report")
    doubtful = (r["score"] >= 2) | (F.coalesce(r["suspicious_token_ratio"], none) >= 0.02)
    weak = scan & (F.coalesce(r["common_ratio"], none) >= 0.10) & (F.coalesce(r["mark_ratio"], none) < 0.04) & doubtful
    short = r["length"] < min_chars
    added = F.when(~short & ~r["is_bad"] & weak & F.lit(judge), F.concat(r["reason"], F.lit(",scan_page_with_weak_text_layer")))
    reason = F.when(short, "text_too_short").otherwise(F.coalesce(added, r["reason"]))
    if force:
        reason = F.lit("force_ocr")
    drop = F.lit(force) | (~short & F.lit(judge) & (r["is_bad"] | weak))
    report = r.withField("is_bad", r["is_bad"] | added.isNotNull()).withField("reason", reason)
    return df.select(*(F.col(f"`{c}`") for c in names), report.alias("report"), drop.alias("drop_layer"))


def documents_to_recognise(df: DataFrame, document: str, bad: str, length: Column) -> DataFrame:
    """``document, n_pages, n_bad, n_text, force``: is the whole document to be recognised from its images?"""
    n_bad, n_text = F.count_if(F.col(bad)), F.count_if(length >= 30)
    force = (n_bad >= 2) | (n_bad / F.greatest(n_text, F.lit(1)) >= 0.35)
    return df.groupBy(document).agg(F.count("*").alias("n_pages"), n_bad.alias("n_bad"), n_text.alias("n_text"), force.alias("force"))


def table_heavy(lines: DataFrame, document: str, page: str, line: str = "line", pages: int = 3) -> DataFrame:
    """``document, short_ratio, number_ratio, table_heavy`` over the lines of the first pages."""
    said = strip(F.col(line))
    rows = lines.where((F.col(page) <= pages) & (said != "")).select(document, said.alias("_l"))
    out = rows.groupBy(document).agg(F.avg((F.length("_l") <= 30).cast("double")).alias("short_ratio"), F.avg(F.col("_l").rlike(r"\d").cast("double")).alias("number_ratio"))
    return out.withColumn("table_heavy", (F.col("short_ratio") > 0.45) & (F.col("number_ratio") > 0.35))


def has_text(df: DataFrame, document: str, page: str, text: str, least: int = 80, pages: int = 3) -> DataFrame:
    """``document, has_text``: have the first pages a text layer of ``least`` characters?"""
    chars = F.sum(F.when(F.col(page) <= pages, F.length(strip(F.coalesce(F.col(text), F.lit(""))))).otherwise(0))
    return df.groupBy(document).agg((chars >= least).alias("has_text"))


def crop_text(first: Column, second: Column, check: bool = True) -> Column:
    """The text of a crop from two recognisers: the first one's, unless it says nothing or, with ``check``, has signs
    the second one may read better. The general rules are applied to what is taken as it is."""
    own, other = common_layer(first), common_layer(second)
    doubtful = suspicious_signs(clean_line(own)) & F.lit(check)
    return F.when(F.coalesce(first, F.lit("")) == "", other).when(doubtful, better_text(own, F.coalesce(second, F.lit("")))).otherwise(own)
