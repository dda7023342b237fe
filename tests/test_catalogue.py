"""Every query with SQL against DuckDB on the smallest data; sources, sinks and streams."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from foliant.plans import catalogue
from foliant.sources import files
from foliant.streaming import ingest

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    cur = duck.execute(catalogue.SQL[name])
    names = [x[0] for x in cur.description]
    assert got == sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_runs(spark, name):
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    df = catalogue.QUERIES[name](spark, DATA)
    assert len(df.collect()) > 0 or name in ("t01_rendered", "t12_false_tables")


def test_files(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/a.PDF").write_bytes(b"one\ftwo")
    (tmp_path / "in/sub/b.pdf").write_bytes(b"x")
    (tmp_path / "in/c.txt").write_bytes(b"no")
    found = files.discover(spark, str(tmp_path / "in"), content=True)
    assert found.count() == 2

    def read(path, content):
        if content == b"x":
            raise ValueError
        return [{"page_no": i, "raw_text": t} for i, t in enumerate(content.decode().split("\f"), 1)]

    rows = files.extract_pages(found, read).collect()
    assert sorted((r.page_no or 0, r.raw_text or "") for r in rows) == [(0, ""), (1, "one"), (2, "two")]
    docs = spark.createDataFrame([("d1", "x"), ("d2", "y")], "id string, body string")
    out = str(tmp_path / "out")
    files.write_documents(docs.limit(1), out, "id", "body")
    assert files.not_yet_written(docs, "id", spark, out).count() == 1
    files.write_documents(docs, out, "id", "body")
    assert spark.read.parquet(out).count() == 2


def test_stream(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    schema = "page_id long, raw_text string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(src)
    df = spark.read.parquet(src)
    for n in (2, 3):
        ingest.ingest(ingest.arriving(spark, src, df.schema), lambda x: x.selectExpr("page_id", "upper(raw_text) AS t"), out, state).awaitTermination()
        assert spark.read.parquet(out).count() == n
        spark.createDataFrame([(3, "c")], schema).write.mode("append").parquet(src)
