"""Documents by their headings: sections, heading paths, page spans, the text to embed; checks of versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import strip

#: Levels of Markdown headings.
LEVELS = 6


def heading_chunks(lines: DataFrame, document: str, number: str = "line_no", line: str = "line") -> DataFrame:
    """``document, chunk_no, heading, heading_path, page_start, page_end, content``.

    A chunk starts at every Markdown heading but those of pages; what stands before the first is chunk 0. The path
    joins the headings above by " > ". Pages come from page comments and page headings, which are no content.
    """
    said = strip(F.col(line))
    page = F.coalesce(F.nullif(F.regexp_extract(said, r"^<!-- page: (\d+) -->", 1), F.lit("")), F.nullif(F.regexp_extract(said, r"^## Trang +(\d+)$", 1), F.lit(""))).try_cast("int")
    level = F.when(page.isNull() & said.rlike(r"^#{1,6} "), F.length(F.regexp_extract(said, r"^(#+)", 1)))
    rows = lines.select(document, F.col(number).alias("_n"), said.alias("_l"), page.alias("_p"), level.alias("_v"))
    w = Window.partitionBy(document).orderBy("_n")
    rows = rows.withColumn("_page", F.last("_p", ignorenulls=True).over(w)).withColumn("chunk_no", F.count("_v").over(w))
    # The last heading of each level, and where it stood; a heading counts while no higher one came after it.
    text = F.regexp_replace("_l", r"^#+\s*", "")
    for k in range(1, LEVELS + 1):
        at = F.when(F.col("_v") == k, F.struct(F.col("_n").alias("n"), text.alias("h")))
        rows = rows.withColumn(f"_h{k}", F.last(at, ignorenulls=True).over(w))
    above: Column = F.lit(0)
    parts = []
    for k in range(1, LEVELS + 1):
        h = F.col(f"_h{k}")
        parts.append(F.when(h["n"] > above, h["h"]))
        above = F.greatest(above, F.coalesce(h["n"], F.lit(0)))
    rows = rows.withColumn("_path", F.concat_ws(" > ", *parts))
    body = F.when(F.col("_p").isNull() & F.col("_v").isNull() & (F.col("_l") != "") & ~F.col("_l").startswith("<!--") & ~F.col("_l").rlike("^-{3,}$"), F.struct("_n", "_l"))
    return rows.groupBy(document, "chunk_no").agg(
        F.max(F.when(F.col("_v").isNotNull(), F.regexp_replace("_l", r"^#+\s*", ""))).alias("heading"),
        F.max_by("_path", "_n").alias("heading_path"),
        F.min("_page").alias("page_start"),
        F.max("_page").alias("page_end"),
        F.array_join(F.transform(F.array_sort(F.collect_list(body)), lambda x: x["_l"]), "\n").alias("content"),
    )


def embedding_text(title: Column, unit: Column, path: Column, content: Column) -> Column:
    """The text to embed: a labelled line for each part that isn't null or empty, then the content."""
    part = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{name}: "), c))
    return F.concat_ws("\n", part("Title", title), part("Unit", unit), part("Section", path), part("Content", content))


def repeated_versions(df: DataFrame, version: str, updated: str) -> DataFrame:
    """``version, n_rows, last_updated`` of the versions that are registered more than once."""
    return df.where(F.col(version).isNotNull()).groupBy(version).agg(F.count("*").alias("n_rows"), F.max(updated).alias("last_updated")).where("n_rows > 1")


def missing_fields(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, missing``: the required fields that are null or blank, for rows that miss any."""
    gaps = F.array_compact(F.array(*(F.when(F.coalesce(strip(F.col(f).cast("string")), F.lit("")) == "", F.lit(f)) for f in fields)))
    return df.select(key, gaps.alias("missing")).where(F.size("missing") > 0)
