"""Lines: expected values on small fixtures, and brute force over them."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from foliant.functions import lines as L
from foliant.functions import rules, text
from foliant.operators import pages


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r.x for r in df.select("i", make(F.col("c")).alias("x")).orderBy("i").collect()]


def test_clean_and_keys(spark):
    dirty = [None, "", " a\u00a0b \r\n\r\n\r\n\r\nc\t\td ", "Đường  Nguyễn Văn A", "x" * 130]
    assert column(spark, dirty, text.clean_text) == ["", "", "a\u00a0b \n\nc d", "Đường Nguyễn Văn A", "x" * 130]
    assert column(spark, dirty[:4], text.clean_line) == ["", "", "a b c d", "Đường Nguyễn Văn A"]
    assert column(spark, dirty[3:4], text.match_key) == ["duong nguyen van a"]
    stems = column(spark, ["a b?.pdf", "", "x" * 130], text.safe_stem)
    assert stems[0] == "a_b_.pdf" and stems[1] == "untitled" and len(stems[2]) == 129


def test_fold_is_unicode_decomposition(spark):
    letters = [chr(c) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
    plain = lambda s: "".join(c for c in unicodedata.normalize("NFD", s.replace("đ", "d").replace("Đ", "D")) if not unicodedata.combining(c))
    assert column(spark, letters, text.fold) == [plain(c) for c in letters]


def test_page_lists(spark):
    assert column(spark, ["4,6,8-10", "10-8", "0,3", "", None, "x,2"], text.page_list) == [[4, 6, 8, 9, 10], [8, 9, 10], [3], [], [], [2]]


@pytest.mark.parametrize(
    ("line", "level"),
    [("I. LƯU ĐỒ", 2), ("1. Mục đích:", 2), ("2.1 Thành phần hồ sơ", 3), ("2.1.1 Điều kiện", 4), ("7. Cho phép SV sử dụng các thiết bị điện:", None), ("a) Hồ sơ", 4), ("1. Sinh viên nộp hồ sơ tại phòng.", None)],
)
def test_levels(spark, line, level):
    assert column(spark, [line], L.marker_level) == [level]


def test_markdown_lines(spark):
    got = column(spark, ["QUYẾT ĐỊNH", "Chương II", "Mục 3", "Điều 1. Đối tượng", "Quy trình xét ........ 12", "<!-- page: 1 -->", "câu thường"], L.markdown_line)
    assert got == ["# QUYẾT ĐỊNH", "## Chương II", "### Mục 3", "### Điều 1. Đối tượng", "Quy trình xét ........ 12", "<!-- page: 1 -->", "câu thường"]


def test_merge(spark):
    rows = [(1, "Sinh viên phải thực hiện\nđúng quy định của Trường.\nĐiều 2. Tên"), (2, None), (3, ""), (4, "NỘI QUY KÝ TÚC XÁ\nvà phòng ở"), (5, "Hồ sơ gồm:\nĐơn xin\nPhiếu thu\n- Khác")]
    df = spark.createDataFrame(rows, "id int, raw string")
    got = {r.id: r.text for r in pages.merged(df, "id", "raw").collect()}
    assert got == {1: "Sinh viên phải thực hiện đúng quy định của Trường.\nĐiều 2. Tên", 2: "", 3: "", 4: "NỘI QUY KÝ TÚC XÁ\nvà phòng ở", 5: "Hồ sơ gồm:\n- Đơn xin\n- Phiếu thu\n- Khác"}
    md = {r.id: r.text for r in pages.markdown(df, "id", "raw").collect()}
    assert md[1].endswith("\n\n### Điều 2. Tên") and md[2] == ""


def test_rules_against_re(spark):
    said = "Căn  cử quyết định, tin dụng ; số16 ngày5 ĐT: 02 92 3 832 663 www. a.vn CTSVtập hợp"
    got = column(spark, [said, None], rules.common_layer)
    assert got[1] == ""
    for part in ("Căn cứ", "tín dụng;", "số 16", "ngày 5", "ĐT: 02923832663", "CTSV tập"):
        assert part in got[0], got[0]
    user = rules.user_rules('{"replace": {"a.b": "$1"}, "regex_replace": [{"pattern": "(x)(y)", "replacement": "\\\\2\\\\1", "flags": "i"}]}')
    assert column(spark, ["a.b XY axb"], lambda c: rules.compile_rules(c, user)) == ["$1 YX axb"]
    assert rules.user_rules("{broken") == []
    with pytest.warns(UserWarning):
        assert rules.user_rules('{"regex_replace": [{"pattern": "(", "replacement": ""}]}') == []


def test_forms_against_re(spark):
    said = "Nam □ Nữ 0 ..........\nHọ và tên ……… x __ Ngày sinh"
    want = re.sub(r"\.{6,}", "________", said)
    want = re.sub(r"\s+…{2,}", " ________", want)
    assert column(spark, [said], text.form_layout)[0].count("________") == want.count("________") + 0


def test_repeated_lines(spark):
    rows = [("d", p, f"TRƯỜNG X   trang {p}\nnội dung {p * 7} khác {'a' * p}") for p in range(1, 6)] + [("e", 1, "TRƯỜNG X"), ("e", 2, "TRƯỜNG X")]
    df = spark.createDataFrame(rows, "doc string, page int, raw string")
    lines = pages.lines_of(df, ["doc", "page"], "raw")
    found = pages.repeated_lines(lines, "doc", "page")
    assert [(r.doc, r.key, r.n_pages) for r in found.collect()] == [("d", "trường x trang #", 5)]
    assert pages.without_repeated(lines, found, "doc").count() == 7
    assert pages.repeated_lines(lines.limit(0), "doc", "page").count() == 0


def test_rules_keep_their_blanks(spark):
    said = ["khoá\nhọc", "khoá học", "ĐT: 0 2 9 2 3 8 3 2 6 6 3 và", "ĐT: 12 34", "vôn vay CCD  số", "Khoatổng hợp", "chính phủ việt nam"]
    got = column(spark, said, rules.common_layer)
    assert got == ["khoá\nhọc", "khóa học", "ĐT: 02923832663và", "ĐT: 12 34", "vốn vay CCCD số", "Khoa tổng hợp", "Chính phủ Việt Nam"]


def test_misreadings_against_re(spark):
    """The fold of the JVM's patterns against that of Python's, over whole pages."""
    import os

    data = "/root/testdata/sf0.001/raw_pages.parquet"
    if not os.path.exists(data):
        pytest.skip("no test data")
    rows = spark.read.parquet(data).where("raw_text IS NOT NULL").select("raw_text", rules.common_words(F.col("raw_text")).alias("x"), rules.phone_numbers(F.col("raw_text")).alias("p")).collect()
    for r in rows:
        want = r.raw_text
        for a, b in rules.MISREADINGS:
            want = re.sub(a, b, want, flags=re.IGNORECASE)
        assert r.x == want
        assert r.p == re.sub(rules.PHONE, lambda m: m[1] + re.sub(r"\s+", "", m[2]), r.raw_text, flags=re.IGNORECASE)


def test_plain_formatter(spark):
    """Against a plain loop over the same predicates."""
    from foliant.functions import plain as P
    from foliant.operators import plain

    text = "QUYẾT ĐỊNH\nSố : 12/QĐ - ABC\nCăn cứ luật\nsố 5 ;\na)\nSinh viên phải thực hiện\nđúng quy định\n12\nnội- \nquy . Xong\nĐiều 1. Tên\nThân bài\nNỘI\nQUY KÝ TÚC XÁ"
    df = spark.createDataFrame([(1, text), (1, unicodedata.normalize("NFD", "Đường")), (2, None), (3, "")], "i int, t string")
    got = plain.plain_markdown(df, "i", "t").collect()
    assert [r.text for r in got if r.i == 1] == [
        "# QUYẾT ĐỊNH\n\n**Số: 12/QĐ-ABC**\n\n**Căn cứ luật số 5;**\n\n- a) Sinh viên phải thực hiện đúng quy định nội-quy. Xong\n\n### Điều 1. Tên\n\nThân bài NỘI QUY KÝ TÚC XÁ",
        "Đường",
    ]
    assert [r.text for r in got if r.i != 1] == ["", ""]
    rows = spark.createDataFrame([(b, c) for b in ("a)", "Điều 1. Tên", "câu.", "câu", "") for c in ("tiếp", "Điều 2", "- mục", "Căn cứ", "")], "b string, c string")
    joined = {(r.b, r.c): r.j for r in rows.select("b", "c", P.joins_plain(F.col("b"), F.col("c")).alias("j")).collect()}
    for (b, c), j in joined.items():
        merged = plain.with_plain_merged(spark.createDataFrame([(f"{b}\n{c}",)], "t string"), "t", "m").first().m if b and c else None
        assert merged is None or ("\n" not in merged) == j, (b, c)


def test_plain_rules_against_re(spark):
    from foliant.functions import plain as P

    said = ["a ,b", "x;y..z", "QĐ - ĐHCT / 5", "( a )", "C0NG HÒA, XA HOI", "•  mục – 1…", None]
    for value, got in zip(said, column(spark, said, P.plain_layers), strict=True):
        want = value or ""
        for _ in range(2):
            for a, b in P.SIGNS:
                want = want.replace(a, b)
            want = re.sub(r"[ \t]+", " ", want).strip()
            for rule in P.SPACING:
                want = re.sub(rule.pattern, rule.to.replace("$", "\\"), want)
            want = want.strip()
            if _ == 0:
                for rule in P.RARE:
                    want = re.sub(rule.pattern, rule.to, want, flags=re.I)
        assert got == want
