"""The plain formatter over texts: lines joined by default, then marked. No row leaves its task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import plain as P
from foliant.functions.lines import is_page_number
from foliant.functions.rules import Rule
from foliant.functions.text import clean_line, strip
from foliant.operators.pages import folded, unfolded

#: So many characters of what stands before a line decide about it: titles are shorter, the rest are prefixes.
HEAD = 91


def with_plain_merged(df: DataFrame, text: str, to: str) -> DataFrame:
    """Adds ``to``: the text (in NFC) with its lines joined by default; page numbers and blank lines go, null gives "".

    A lone marker takes the next line, whatever it is; behind a hyphen lines are joined without a blank.
    """
    lines = F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), P.LINE_END), P.plain_line), lambda c: (c != "") & ~is_page_number(c))
    seen = F.transform(
        lines,
        lambda c: F.struct(
            c.alias("c"),
            F.left(c, F.lit(HEAD)).alias("head"),
            (P.stands_apart(c) | P.starts_item(c) | P.opens_paragraph(c)).alias("own"),
            c.rlike("[.:;!?]$").alias("stop"),
            c.endswith("-").alias("hyphen"),
        ),
    )

    def step(s: Column, x: Column) -> tuple[Column, Column]:
        join = (s["head"] != "") & (P.lone_marker(s["head"]) | (~x["own"] & ~s["stop"] & ~P.stands_apart(s["head"])))
        longer = F.left(F.concat(s["head"], F.when(s["hyphen"], "").otherwise(" "), x["c"]), F.lit(HEAD))
        state = F.struct(F.when(join, longer).otherwise(x["head"]).alias("head"), x["stop"].alias("stop"), x["hyphen"].alias("hyphen"))
        return F.when(~join, "0").when(s["hyphen"], "2").otherwise("1"), state

    nothing = F.struct(F.lit("").alias("head"), F.lit(False).alias("stop"), F.lit(False).alias("hyphen"))
    df = df.withColumn("_x", seen)
    return df.withColumn(to, F.substr(unfolded(F.col("_x"), folded(F.col("_x"), nothing, step), glue={"1": " ", "2": ""}), F.lit(2))).drop("_x")


def plain_markdown(df: DataFrame, key: str, text: str, terms: Sequence[Rule] = ()) -> DataFrame:
    """``key, text``: the texts as plain Markdown, a row for each row: layers of rules, lines joined, rules, lines marked."""
    rows = df.select(F.col(key).alias("_k"), P.composed(F.coalesce(F.col(text), F.lit(""))).alias("_t"))
    rows = with_plain_merged(rows.withColumn("_t", P.plain_layers(F.col("_t"), terms)), "_t", "_m").withColumn("_m", P.plain_layers(F.col("_m"), terms))
    lines = F.filter(F.transform(F.split("_m", P.LINE_END), P.plain_line), lambda c: c != "")
    return rows.select(F.col("_k").alias(key), F.array_join(F.transform(lines, P.plain_markdown_line), "\n\n").alias("text"))


def extract_pages_markdown(df: DataFrame, key: str, page: str, text: str, empty: str = "[no text on this page]") -> DataFrame:
    """``key, block``: bare extracts as page blocks, lines marked and not joined; pages without text get a placeholder."""
    said = strip(F.coalesce(F.col(text), F.lit("")))
    lines = F.filter(F.transform(F.split(said, P.LINE_END), clean_line), lambda c: c != "")
    body = F.when(said == "", empty).otherwise(F.array_join(F.transform(lines, P.extract_line), "\n"))
    return df.select(key, F.concat(F.lit("## Trang "), F.col(page), F.lit("\n\n"), body, F.lit("\n\n---\n")).alias("block"))
