"""Tables, boxes, signals and chunks on fixtures with expected results."""

import random

from pyspark.sql import functions as F

from foliant.operators import boxes, chunks, layers, pages, tables


def lines(spark, text, page=1):
    return spark.createDataFrame([(page, i, x) for i, x in enumerate(text.split("\n"), 1)], "page_no int, line_no int, line string")


def out(df):
    return [r.line for r in df.orderBy("page_no", "line_no").collect()]


def test_columns_and_headers(spark):
    text = "| a | b |\n|---|---|\n| 1 |\n\n| 02 | Ra vào KTX quá giờ | Nhắc nhở | Khiển trách | Cảnh cáo | x |\n|--|--|--|--|--|--|\nxong"
    evened = out(tables.columns_evened(lines(spark, text), ["page_no"]))
    assert evened[:3] == ["| a | b |", "| --- | --- |", "| 1 |  |"]
    fixed = out(tables.data_headers_repaired(lines(spark, text), ["page_no"]))
    assert fixed[4:7] == ["| TT | Nội dung vi phạm | Lần 1 | Lần 2 | Lần 3 | Ghi chú |", "| --- | --- | --- | --- | --- | --- |", "| 02 | Ra vào KTX quá giờ | Nhắc nhở | Khiển trách | Cảnh cáo | x |"]


def test_continued_tables(spark):
    one = "## Trang 1\n\n| TT | Tên |\n| --- | --- |\n| 8 | A |"
    two = "## Trang 2\n\n9 Công nghệ tài chính\nTổng cộng"
    three = "## Trang 3\n\nVăn bản thường"
    df = lines(spark, one).unionByName(lines(spark, two, 2)).unionByName(lines(spark, three, 3)).withColumn("doc", F.lit(1))
    got = tables.tables_continued(df, "doc", "page_no")
    second = [r.line for r in got.where("page_no = 2").orderBy("line_no").collect()]
    assert second == ["## Trang 2", "", "| TT | Tên |", "| --- | --- |", "| 9 | Công nghệ tài chính |", "|  | Tổng cộng |"]
    assert got.where("page_no = 3").count() == 3


def test_titles_and_false_tables(spark):
    title = "QUY TRÌNH XÉT DUYỆT"
    text = f"mở đầu\n| {title}<br/>Bước | {title}<br>Lưu đồ |\n| --- | --- |\n| 1 | x |"
    got = out(tables.titles_hoisted(lines(spark, text), ["page_no"]))
    assert got == ["mở đầu", "", f"## {title}", "", "| Bước | Lưu đồ |", "| --- | --- |", "| 1 | x |"]
    false = "| 1. Phạm vi | |\n|---|---|\n| a | b |"
    assert out(tables.false_tables_flat(lines(spark, false), ["page_no"])) == ["1. Phạm vi", "a b"]


def test_rendered(spark):
    df = spark.createDataFrame([(1, [["a|b", "c"], ["", ""], ["d"]]), (2, [["x", "y"]]), (3, [])], "i int, g array<array<string>>")
    got = [r.m for r in df.select("i", tables.rendered(F.col("g")).alias("m")).orderBy("i").collect()]
    assert got == ["| a\\|b | c |\n| --- | --- |\n| d |  |", "| Cột 1 | Cột 2 |\n| --- | --- |\n| x | y |", ""]


def test_islands_against_walk(spark):
    rng = random.Random(5)
    rows = []
    for doc in range(60):
        for page in range(1, 13):
            if rng.random() < 0.9:
                rows.append((doc, page, rng.random() < 0.2, rng.random() < 0.1, rng.choice([0, 0, 30])))
    df = spark.createDataFrame(rows, "doc int, page int, likely_table boolean, likely_form boolean, vector_line_count int").withColumns({c: F.lit(0) for c in ("raster_line_score", "raster_vertical_lines", "keyword_score")})
    by = {(d, p): (t, f, t or v >= 25) for d, p, t, f, v in rows}
    want = {k for k, (t, f, _) in by.items() if t or f}
    for d, p in [k for k, v in by.items() if v[0]]:
        for step in (-1, 1):
            q = p + step
            while (d, q) in by and by[d, q][2]:
                want.add((d, q))
                q += step
    assert {(r.doc, r.page) for r in pages.table_pages(df, "doc", "page").collect()} == want


def grid(n_rows, n_columns):
    return [(1, r * n_columns + c, 100.0 * c, 40.0 * r, 100.0 * c + 30, 40.0 * r + 20, f"r{r}c{c}", 0.9) for r in range(n_rows) for c in range(n_columns)]


SCHEMA = "page_no int, box_no int, x0 double, y0 double, x1 double, y1 double, box_text string, conf double"


def test_boxes(spark):
    rows = grid(5, 3)
    df = spark.createDataFrame([*rows, (1, 99, *rows[0][2:]), (2, 1, 0.0, 0.0, 10.0, 10.0, None, None), (3, 1, 0.0, 0.0, 10.0, 10.0, "một", None)], SCHEMA)
    got = {r.page_no: r for r in boxes.page_tables(df, ["page_no"]).collect()}
    assert got[1].is_table and (got[1].n_rows, got[1].n_columns) == (5, 3) and got[1].grid[2] == ["r2c0", "r2c1", "r2c2"]
    assert not got[3].is_table and got[3].grid == [] and 2 not in got
    order = [r.text for r in boxes.in_reading_order(df.where("page_no = 1"), ["page_no"]).orderBy("pos").collect()]
    assert order == [r[6] for r in rows]
    assert boxes.distinct_boxes(df, ["page_no"], "box_no").count() == len(rows) + 2
    assert boxes.page_tables(df.limit(0), ["page_no"]).count() == 0
    areas = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 20.0)], "page_no int, x0 double, y0 double, x1 double, y1 double")
    assert boxes.outside(df, areas, ["page_no"]).where("page_no = 1").count() == len(rows) - 2  # touching overlaps
    assert list(boxes.flattened([{"a": [{"box": [[0, 0], [1, 0], [1, 1], [0, 1]], "text": "x"}]}, [[[0, 0], [1, 0], [1, 1], [0, 1]], ("y", 0.5)]]))[0][1] in ("x", "y")


def test_chunks(spark):
    text = "trước\n# A\n<!-- page: 1 -->\nmột\n## B\nhai\n## Trang 2\n### C\nba\n## D\nbốn"
    got = chunks.heading_chunks(lines(spark, text).withColumn("doc", F.lit(1)), "doc").orderBy("chunk_no").collect()
    assert [(r.heading, r.heading_path, r.page_start, r.page_end, r.content) for r in got] == [(None, "", None, None, "trước"), ("A", "A", 1, 1, "một"), ("B", "A > B", 1, 2, "hai"), ("C", "A > B > C", 2, 2, "ba"), ("D", "A > D", 2, 2, "bốn")]


def test_layers(spark):
    good = "Sinh viên thực hiện đúng các quy định của nhà trường về học tập và rèn luyện. " * 3
    bad = "BQ GIAO Dl)C DAo T~o TRUONGD D~IHQ cANTHa Gido due Ludt a6i b6 sung vAn sire khoe " * 2
    df = spark.createDataFrame([(1, good), (2, bad), (3, None), (4, "ngắn")], "i int, t string")
    got = {r.i: r for r in layers.with_report(df, "t").select("i", layers.is_bad(F.col("t")).alias("b"), "report").collect()}
    assert [got[i].b for i in (1, 2, 3, 4)] == [False, True, True, True]
    assert got[1].report.score == 0 and "looks_like_valid" in got[1].report.reason and got[2].report.is_bad
    assert got[3].report.reason == "text_layer_too_short_or_empty" and got[3].report.token_count is None


def test_headings_put_in_count_for_later_tables(spark):
    """The last lines are those of the result: a heading that was put in is out of reach after six lines."""
    title = "QUY TRÌNH XÉT DUYỆT"
    head = f"| {title}<br/>Bước | {title}<br>Lưu đồ |\n| --- | --- |"
    rows = "\n".join(f"| {i} | x |" for i in range(4))
    far = out(tables.titles_hoisted(lines(spark, f"{head}\n{rows}\n{head}"), ["page_no"]))
    assert [x for x in far if x.startswith("## ")] == [f"## {title}"] * 2
    near = out(tables.titles_hoisted(lines(spark, f"{head}\n| 1 | x |\n\n{head}"), ["page_no"]))
    assert near == [f"## {title}", "", "| Bước | Lưu đồ |", "| --- | --- |", "| 1 | x |", "", "| Bước | Lưu đồ |", "| --- | --- |"]


def test_finished_texts(spark):
    text = "| a | b |\n|---|---|\n\n\n\n\nscanned with CamScanner\nx   y"
    (got,) = tables.finished_texts(lines(spark, text).withColumn("doc", F.lit(1)), "doc", "page_no").collect()
    assert got.text == "| a | b |\n| --- | --- |\n\nx y\n"
    df = spark.createDataFrame([(1, "| 1. Phạm vi | |\r\n|---|---|\r\n| a | b |\r\n\r\n\r\nĐiều 1. Tên   dài\n# Có"), (2, None), (3, "")], "i int, t string")
    got = {r.i: r.text for r in tables.normalised_markdown(df, "i", "t").collect()}
    assert got == {1: "1. Phạm vi\na b\n\n## Điều 1. Tên dài\n# Có\n", 3: "\n"}


def test_box_texts_are_a_line_per_box(spark):
    rows = [(1, 2, 0.0, 0.0, 1.0, 1.0, "B", 0.9), (1, 1, 0.0, 0.0, 1.0, 1.0, "A", 0.9), (1, 3, 0.0, 0.0, 1.0, 1.0, "  ", None), (2, 1, 0.0, 0.0, 1.0, 1.0, None, None)]
    got = boxes.page_texts(spark.createDataFrame(rows, SCHEMA), ["page_no"]).collect()
    assert [(r.page_no, r.text) for r in got] == [(1, "A\nB")]
    df = spark.createDataFrame([(1,)], "i int").select(boxes.clockwise(F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((9, 8), (1, 7), (8, 0), (0, 0))))).alias("c"))
    assert [(p.x, p.y) for p in df.first().c] == [(0, 0), (8, 0), (9, 8), (1, 7)]


def test_dropped_layers(spark):
    plain = "Sinh vien phai thuc hien dung quy dinh cua nha truong ve hoc tap va ren luyen theo quyet dinh. "
    marked = "Sinh viên thực hiện đúng các quy định của nhà trường về học tập và rèn luyện. "
    rows = [(1, "ngắn", 1.0, 1.0), (2, marked * 3, 1.0, 1.0), (3, (marked + plain * 2) * 3, 0.8, 0.0), (4, (marked + plain * 2) * 3, 0.6, 0.6), (5, None, 0.0, None)]
    df = spark.createDataFrame(rows, "i int, t string, total double, largest double")
    got = {r.i: r for r in layers.dropped_layer(df, "t", "total", "largest").collect()}
    assert [got[i].drop_layer for i in (1, 2, 5)] == [False, False, False] and got[1].report.reason == "text_too_short"
    score = got[3].report
    assert got[3].drop_layer == (score.is_bad or score.score >= 2) == got[4].drop_layer
    forced = layers.dropped_layer(df, "t", "total", force=True).collect()
    assert all(r.drop_layer and r.report.reason == "force_ocr" for r in forced)
    assert not any(r.drop_layer for r in layers.dropped_layer(df, "t", "total", judge=False).collect())


def test_blocks_merge_and_mark(spark):
    local = spark.createDataFrame([("d", 1, "a"), ("d", 2, "b")], "doc string, page_no int, block string")
    cloud = spark.createDataFrame([("d", 2, "c"), ("e", 1, "f")], "doc string, page_no int, block string")
    got = sorted(tuple(r) for r in pages.merged_blocks(local, cloud, document="doc").collect())
    assert got == [("d", 1, "a"), ("d", 2, "c"), ("e", 1, "f")]
    rows = spark.createDataFrame([("d", None, " x ", 1), ("d", 7, None, 2)], "doc string, page int, t string, o int")
    assert pages.marked_pages(rows, "doc", "page", "t", "o").first().body == "<!-- page: 1 -->\n\nx\n\n<!-- page: 7 -->\n"
    assert [pages.target_pages(*x) for x in ((None, None), (4, None), (4, 8), (None, 1))] == [None, "4", "4-8", "1"]


def test_crops(spark):
    df = spark.createDataFrame([("", "Email: a@b.vn"), ("Email: a", "Email: a@b.vn"), ("chữ", "dài hơn nhiều"), (None, None)], "a string, b string")
    assert [r.t for r in df.select(layers.crop_text(F.col("a"), F.col("b")).alias("t")).collect()] == ["Email: a@b.vn", "Email: a@b.vn", "chữ", ""]
