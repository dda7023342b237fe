"""Sources and column functions that no query reaches."""

import pytest
from pyspark.sql import functions as F

from foliant import session
from foliant.functions import text
from foliant.operators import boxes, pages
from foliant.sources import files


def test_texts_and_html(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>một &amp; hai</p><script>x</script><br>ba", encoding="utf-8")
    assert [r.text for r in files.html_files(spark, str(tmp_path)).collect()] == ["một & hai\n\nba"]
    assert [r.text for r in files.text_files(spark, str(tmp_path / "a.html")).collect()][0].startswith("<p>")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.text_files(spark, str(tmp_path / "none")).collect()


def test_drawings_and_images(spark):
    df = spark.createDataFrame([(1, [("l",), ("re",), ("qu",)]), (2, [])], "i int, items array<struct<kind:string>>")
    assert [r.n for r in df.select(files.vector_lines(F.col("items")).alias("n")).collect()] == [2, 0]
    images = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 5.0, 100.0), (1, 0.0, 5.0, 10.0, 8.0, 100.0), (2, 0.0, 0.0, 99.0, 99.0, 100.0)], "page int, x0 double, y0 double, x1 double, y1 double, area double")
    got = {r.page: (r.image_ratio, r.largest_image) for r in files.image_ratios(images, ["page"], "area").collect()}
    assert got == {1: (0.8, 0.5), 2: (1.0, 1.0)}


def test_numbers_and_names(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "c string")
    assert [r.n for r in df.select(text.is_number(F.col("c")).alias("n")).collect()] == [True, False, False]
    paths = spark.createDataFrame([("a/b c.PDF", "out/x.MD"), ("d.docx", "out/")], "s string, o string")
    got = paths.select(files.output_path(F.col("s"), F.col("o")).alias("p"), files.plain_output_name(F.col("s")).alias("n"), files.by_pages(F.col("s"), F.lit("local")).alias("b"), files.needs_cloud(F.col("s"), F.lit(True), F.lit(False)).alias("c")).collect()
    assert [tuple(r) for r in got] == [("out/x.MD", "b c_structured.md", True, False), ("out/d_structured.md", "d_structured.md", False, True)]


def test_recognised(spark):
    box = "[[0, 0], [2, 0], [2, 1], [0, 1]]"
    rows = [(1, f'[[{box}, ["x", 0.5]], {{"r": [{{"points": {box}, "rec_text": "y"}}]}}, {box}]'), (2, None), (3, "{broken"), (4, "7"), (5, "[]")]
    got = boxes.recognised(spark.createDataFrame(rows, "i int, r string"), "i", "r").collect()
    assert {(r.i, r.x1, r.box_text) for r in got} == {(1, 2.0, "x"), (1, 2.0, "y"), (1, 2.0, None)} and len(got) == 3


def test_indices_and_scores(spark):
    df = spark.createDataFrame([(5, None, None), (5, 2, 9), (5, 7, 9), (5, 0, 3)], "n int, a int, b int")
    assert [r.i for r in df.select(pages.page_indices(F.col("n"), F.col("a"), F.col("b")).alias("i")).collect()] == [[0, 1, 2, 3, 4], [1, 2, 3, 4], [6], [0, 1, 2]]
    lines = spark.createDataFrame([(0, 0), (18, 12), (4, 3), (6, 0)], "h int, v int")
    got = [r.s for r in lines.select(pages.raster_scores(F.col("h"), F.col("v")).alias("s")).collect()]
    assert [s.table_score for s in got] == pytest.approx([0.0, 1.0, 0.2375, 0.2]) and [s.form_score for s in got] == pytest.approx([0.0, 1.0, 0.0, 1 / 3])


def test_shared_folder(spark, tmp_path, monkeypatch):
    """On a cluster the setting has to name a folder; what was written is deleted on request."""

    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "spark://x:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)
    written = session.materialise(spark.range(3), "test")
    assert written.count() == 3
    folder = session._work_dir(spark)
    p, fs = session.hadoop_path(spark, folder)
    assert fs.exists(p) and spark.sparkContext.applicationId in folder


def test_markdown_files(spark, tmp_path):
    out = str(tmp_path / "md")
    df = spark.createDataFrame([("a", "# A\n\nmột"), ("b", "")], "name string, t string")
    files.write_markdown(df, out, "name", "t")
    assert [p.parent.name for p in sorted((tmp_path / "md").rglob("*.txt"))] == ["document=a", "document=b"]
    assert next((tmp_path / "md/document=a").glob("*.txt")).read_text().rstrip("\n") == "# A\n\nmột"
