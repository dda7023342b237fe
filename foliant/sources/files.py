"""Files in, documents out: discovery, page extraction behind an interface, sinks that skip what is there."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliant.functions.text import html_text, safe_stem
from foliant.session import hadoop_path

# What is read here, and what else a cloud parser reads.
LOCAL = [".pdf", ".png", ".jpg", ".jpeg", ".webp", ".bmp", ".tif", ".tiff"]
CLOUD = [".docx", ".pptx", ".xlsx", ".csv", ".html"]

PAGES = T.StructType([T.StructField("path", T.StringType()), T.StructField("page_no", T.IntegerType()), T.StructField("raw_text", T.StringType()), T.StructField("n_vector_lines", T.IntegerType()), T.StructField("image_ratio", T.DoubleType())])


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))


def discover(spark: SparkSession, path: str, kinds: Iterable[str] = LOCAL, content: bool = False) -> DataFrame:
    """``path, modificationTime, length, extension`` (and ``content``) of the files below, by kind.

    A missing path raises; contents are only read if they are selected.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.withColumn("extension", extension(F.col("path"))).where(F.col("extension").isin([k.lower() for k in kinds]))
    return files if content else files.drop("content")


def checksums(files: DataFrame) -> DataFrame:
    return files.select("path", F.md5("content").alias("checksum"))


def extract_pages(files: DataFrame, read: Callable[[str, bytes], Iterable[dict]]) -> DataFrame:
    """Pages of files by ``read(path, content)``, which yields dicts of the fields of PAGES but the path.

    The reader (a PDF library, a recogniser) is the caller's and runs in the Python workers; a file it fails on
    gives one row with a null page, so that it can be found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(PAGES)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows = [{"path": path, **r} for r in read(path, content)]
                except Exception:  # a broken file must not end the job
                    rows = [{"path": path}]
                yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in kinds.names} for r in rows], schema=kinds)

    return files.select("path", "content").mapInArrow(run, PAGES)


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, text`` of whole UTF-8 files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def html_files(spark: SparkSession, path: str) -> DataFrame:
    return text_files(spark, path).select("path", html_text(F.col("text")).alias("text"))


def vector_lines(items: Column) -> Column:
    """How many of a page's drawing items are lines, curves or quads (an array of structs with ``kind``)."""
    return F.size(F.filter(items, lambda x: x["kind"].isin("l", "c", "qu")))


def image_ratios(images: DataFrame, page: list[str], page_area: str) -> DataFrame:
    """``page, image_ratio, largest_image``: the share of the page under images (x0, y0, x1, y1), 1 at most."""
    area = F.abs(F.col("x1") - F.col("x0")) * F.abs(F.col("y1") - F.col("y0"))
    whole = F.max(page_area)
    return images.groupBy(*page).agg(F.least(F.try_divide(F.sum(area), whole), F.lit(1.0)).alias("image_ratio"), F.least(F.try_divide(F.max(area), whole), F.lit(1.0)).alias("largest_image"))


def output_name(source: Column) -> Column:
    """The name of a document's Markdown file."""
    stem = F.regexp_replace(F.regexp_extract(source, r"([^/\\]*)$", 1), r"\.[^.]*$", "")
    return F.concat(safe_stem(stem), F.lit("_structured.md"))


def plain_output_name(source: Column) -> Column:
    """The same without making the name safe."""
    return F.concat(F.regexp_replace(F.regexp_extract(source, r"([^/\\]*)$", 1), r"(?<=.)\.[^.]*$", ""), F.lit("_structured.md"))


def is_markdown_path(path: Column) -> Column:
    """Does the output path name one Markdown file, rather than a folder?"""
    return extension(path) == ".md"


def output_path(source: Column, output: Column) -> Column:
    return F.when(is_markdown_path(output), output).otherwise(F.concat(F.regexp_replace(output, "/+$", ""), F.lit("/"), output_name(source)))


def needs_cloud(path: Column, has_text: Column, table_heavy: Column) -> Column:
    """Is a file parsed in the cloud? Images and office files are, and PDFs without a text layer or full of tables."""
    kind = extension(path)
    pdf = ~F.coalesce(has_text, F.lit(False)) | F.coalesce(table_heavy, F.lit(False))
    return F.when(kind.isin([k for k in LOCAL if k != ".pdf"] + CLOUD), True).when(kind == ".pdf", pdf).otherwise(False)


def by_pages(path: Column, engine: Column, engines: Iterable[str] = ("auto-page", "cloud", "local")) -> Column:
    """Are a file's pages routed one by one? PDFs are, with one of the engines that can."""
    return (extension(path) == ".pdf") & engine.isin(list(engines))


def not_yet_written(df: DataFrame, key: str, spark: SparkSession, path: str, force: bool = False) -> DataFrame:
    """The rows whose key isn't in the Parquet output at ``path``; all of them if it isn't there or with ``force``."""
    if force or not exists(spark, path):
        return df
    return df.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def write_documents(df: DataFrame, path: str, key: str, text: str, force: bool = False) -> DataFrame:
    """Appends the documents that aren't there yet as Parquet; gives those that were written."""
    new = not_yet_written(df, key, df.sparkSession, path, force)
    new.select(key, text).write.mode("overwrite" if force else "append").parquet(path)
    return new


def write_markdown(df: DataFrame, path: str, name: str, text: str) -> None:
    """A folder with one text file per document, named by ``name``: for exports; Parquet (``write_documents``) is the
    sink for many documents."""
    rows = df.select(F.col(name).alias("document"), F.col(text).alias("value")).repartition("document")
    rows.write.mode("overwrite").partitionBy("document").option("lineSep", "\n").text(path)
