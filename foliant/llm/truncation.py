"""Texts that stop before their end (problem 8).

Per source the lengths of all different texts are counted, in characters and in UTF-8 bytes, after what was put behind a
cut (dots, "read more" and the like) is taken off. A field limit shows as a spike at the upper end of a
histogram: far more texts at one length than the neighbouring lengths lead to expect, and hardly any beyond.
Texts at a spike without terminal punctuation are cut. Bytes get a tolerance of one character, which a cut may
have split.

Transfers that break off leave no spike. So the end of every text is judged as well: a last line of running text
without terminal punctuation is cut, a closing line (one that ends many different texts: signature, address, date), a
finished item, a table row, a form field or a bare title isn't. An item is unfinished if the corpus has no such
item but has one that goes on from there.

All counts run over all documents, copies of a text as one, and are aggregated before they are shuffled; the
histogram has at most sources x lengths rows, its spikes a few per source. Which items others go on from is asked
of the sorted items: an item's continuations follow it at once, so that neighbours are compared.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.session import materialise

# What publishing systems put behind a shortened text.
CONTINUATIONS = ["Đọc thêm", "Xem thêm", "Xem tiếp", "xem tiếp", "còn nữa", "còn tiếp", "Read more", "read more", "continued", "Continue reading", "more", "Lire la suite", "lire la suite", "à suivre", "suite"]
BLANK = " \t\r\n     ​ 　﻿"
TAIL = 80
MARK = (
    r"(?:[\s ]*(?:\[?(?:\.{2,}|…)\]?|>>+|»|→|[\(\[](?:\.\.\.|…)?\s*(?:" + "|".join(CONTINUATIONS) + r")\s*(?:\.\.\.|…)?[\)\]]|(?<=[.…>»\s])(?:" + "|".join(CONTINUATIONS) + r")))+[\s ]*$"
)
ITEM = r"^\s*(?:[-+*•·–▪◦]|[]|\(?\d{1,3}[.)]|\(?[a-zA-Zđ]\))\s+"
ROW = r"\t|\|| {3,}|^\d+;|;\S[^;]*;(?:\S|$)"
FIELD = r"(?:[_.…]{3,}|…|[☐□])\s*$|^[^.;!?]{2,60}:\s*$"
TERMINAL = r"[.!?。:;][\"'”’»)\]*_]*$|[.!?]\s*\([^()]*\)$|v\.v\W*$|[”»\"]$|^\W*[-–—=*_]{3,}\W*$"

#: A spike holds at least this many texts and this share of the source's, exceeds the mean count of the lengths
#: in the tenth below it so many times, and at most this share of the source's texts is longer than its band.
SPIKE_LEAST, SPIKE_SHARE, SPIKE_TIMES, BEYOND = 4, 0.02, 40.0, 0.1
#: A closing line ends at least so many different texts, and so large a share of all.
CLOSING_LEAST, CLOSING_SHARE = 3, 0.0003


def _core(text: Column) -> Column:
    """The text without blanks and continuation marks at its end."""
    bare = F.rtrim(text, F.lit(BLANK))
    tail = F.right(bare, F.lit(TAIL))
    kept = F.regexp_replace(tail, MARK, "")
    return F.rtrim(F.left(bare, F.length(bare) - F.length(tail) + F.length(kept)), F.lit(BLANK))


def _letters() -> tuple[str, str]:
    """Letters with marks and their base letters, from Unicode's decompositions; then the bare marks."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
    pairs = [(a, b) for a, b in pairs if a != b] + [("đ", "d"), ("Đ", "D"), ("\u00a0", " ")]
    drop = "".join(map(chr, [*range(0x300, 0x330), 0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF]))
    return "".join(a for a, _ in pairs) + drop, "".join(b for _, b in pairs)


def _key(line: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.translate(line, *_letters()))), r"\d+", "#")


def _item(line: Column) -> Column:
    """What an item says, without marker, codes and numbers at its end."""
    said = F.regexp_replace(line, ITEM, "")
    return F.trim(F.regexp_replace(F.lower(F.translate(said, *_letters())), r"[\s;,.]*(?:[\s(]*(?:[a-z]{1,3})?\d+\)?[\s;,.]*)*$", ""))


def profile(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """What the end of each text shows; null, empty and blank texts are left out."""
    df = df.select(F.col(key).alias("id"), F.col(source).alias("source"), F.col(text).alias("text"))
    df = df.where(F.length(F.trim(F.col("text"), F.lit(BLANK))) > 0)
    df = df.withColumn("core", _core(F.col("text"))).withColumn("last", F.substring_index("core", "\n", -1))
    lines = F.length("core") - F.length(F.replace(F.col("core"), F.lit("\n"), F.lit(""))) + 1
    # A text that is one line after all: a title, or a paragraph. Sentences tell them apart.
    words = F.size(F.split(F.trim(F.col("last")), r"\s+"))
    return df.select(
        "id",
        "source",
        F.length("core").alias("chars"),
        F.octet_length("core").alias("octets"),
        (F.length(F.rtrim(F.col("text"), F.lit(BLANK))) > F.length("core")).alias("marked"),
        lines.alias("n_lines"),
        words.alias("n_words"),
        (F.length("core") / lines < 30).alias("short_lines"),
        F.col("last").rlike(TERMINAL).alias("terminal"),
        F.col("last").rlike(r"�$").alias("split_char"),
        F.col("last").rlike(ITEM).alias("is_item"),
        F.col("last").rlike(ROW).alias("is_row"),
        F.col("last").rlike(FIELD).alias("is_field"),
        F.col("last").rlike(r"[.!?;,]\s").alias("has_sentence"),
        F.unhex(F.md5(_key(F.col("last")).cast("binary"))).alias("last_key"),
        F.trim(F.col("last")).endswith(",").alias("comma"),
        F.unhex(F.md5(F.col("core").cast("binary"))).alias("digest"),
        F.when(F.col("last").rlike(ITEM), _item(F.col("last"))).alias("item"),
    )


def spikes(ends: DataFrame) -> DataFrame:
    """``source``, ``unit`` (chars or octets), ``limit``, ``n``: the field limits that show in the lengths."""
    # Each text of a source counts once: the length of a text that is stored often is no limit.
    ends = ends.groupBy("source", "digest").agg(*(F.first(c).alias(c) for c in ("chars", "octets", "terminal")))
    counts = (
        ends.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("size")), F.struct(F.lit("octets").alias("unit"), F.col("octets").alias("size")))).alias("x"), "terminal")
        .select("source", "x.unit", "x.size", "terminal")
        .groupBy("source", "unit", "size")
        .agg(F.count("*").alias("n"), F.count_if(~F.col("terminal")).alias("open"))
    )
    # Histograms are small beside the documents: a source has at most as many rows as it has lengths.
    whole = "(PARTITION BY source, unit ORDER BY size RANGE BETWEEN"
    return (
        counts.withColumn("total", F.expr("sum(n) OVER (PARTITION BY source, unit)"))
        .withColumn("beyond", F.expr(f"coalesce(sum(n) OVER {whole} 4 FOLLOWING AND UNBOUNDED FOLLOWING), 0)"))
        .withColumn("reach", F.expr(f"coalesce(sum(n) OVER {whole} 400 PRECEDING AND 4 PRECEDING), 0)"))
        .withColumn("before", F.col("reach") / F.least(F.lit(397.0), F.greatest(F.col("size") - 3, F.lit(1))))
        .where(
            (F.col("n") >= SPIKE_LEAST)
            & (F.col("n") >= SPIKE_SHARE * F.col("total"))
            & (F.col("n") >= SPIKE_TIMES * F.greatest(F.col("before"), F.lit(1 / 397)))
            & (F.col("beyond") <= F.greatest(BEYOND * F.col("total"), 0.5 * F.col("n")))
            & (F.col("open") >= 0.6 * F.col("n"))
        )
        .select("source", "unit", F.col("size").alias("limit"), "n")
    )


def _corpus_items(df: DataFrame, text: str) -> DataFrame:
    """``item``: what the items of the corpus say, each once, but for the last line of each text."""
    lines = F.split(F.col(text), "\r?\n")
    inner = F.filter(F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: x.rlike(ITEM))
    return df.select(F.explode(inner).alias("line")).select(_item(F.col("line")).alias("item")).where("item <> ''").distinct()


def begun_items(items: DataFrame, lasts: DataFrame) -> DataFrame:
    """``item, known`` of the last items that are an item of the corpus (``known``) or that one of them goes on from.

    Both have a column ``item`` without repeats. They are sorted in ranges; what an item goes on as follows it. The
    last items at the end of a range are compared with the first items of the ranges behind, a row per range.
    """
    both = items.select("item", F.lit(False).alias("last")).unionByName(lasts.select("item", F.lit(True).alias("last")))
    both = both.groupBy("item").agg(F.max("last").alias("last"), F.max(~F.col("last")).alias("whole"))
    both = both.repartitionByRange("item").sortWithinPartitions("item").withColumn("part", F.spark_partition_id())
    schema = "item string, known boolean, part int, first boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of last items whose next item has come, of those that wait at the end (``known`` null), and of the first item."""
        waiting: list[str] = []
        part, began = None, False
        for batch in batches:
            out: list[tuple] = []
            for item, last, whole, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = at
                if whole:
                    if not began:
                        began = True
                        out.append((item, None, at, True))
                    # What waits is a chain of beginnings of one another, or ends here.
                    out += ((x, False, at, False) for x in waiting if item.startswith(x))
                    waiting.clear()
                    if last:
                        out.append((item, True, at, False))
                elif last:
                    waiting = [x for x in waiting if item.startswith(x)]
                    waiting.append(item)
            if out:
                yield _rows(out)
        if waiting:
            yield _rows([(x, None, part, False) for x in waiting])

    found = materialise(both.select("item", "last", "whole", "part").mapInArrow(run, schema), "items")
    # A row per range: the first item of the next range that has one.
    firsts = found.where("first").select("part", F.col("item").alias("first"))
    rest = found.where("NOT first AND known IS NULL").select("item", "part")
    ranges = rest.select("part", F.lit(None).cast("string").alias("first")).unionByName(firsts).groupBy("part").agg(F.max("first").alias("first"))
    ranges = ranges.select("part", F.expr("first(first, true) OVER (ORDER BY part ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)").alias("next"))
    across = rest.join(ranges, "part").where(F.startswith("next", F.col("item"))).select("item", F.lit(False).alias("known"))
    return found.where("known IS NOT NULL").select("item", "known").unionByName(across)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.bool_(), pa.int32(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["item", "known", "part", "first"])


def truncated(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per non-blank text: ``id``, ``source``, ``truncated``, ``reason`` (limit, open_end or null).

    A null source is a source of its own. Repeated rows are judged each; extra columns are not read.
    """
    # Read by five branches below; it holds no texts.
    ends = materialise(profile(df, key, text, source), "ends")
    found = spikes(ends)
    # A few rows per source; the list is joined, never collected.
    limits = found.groupBy(F.col("source").alias("limited")).agg(
        F.collect_set(F.when(F.col("unit") == "chars", F.col("limit"))).alias("char_limits"),
        F.collect_set(F.when(F.col("unit") == "octets", F.col("limit"))).alias("octet_limits"),
    )
    # Each text counts once: copies of a cut one don't make its last line a closing line.
    texts = ends.groupBy("digest").agg(F.first("last_key").alias("last_key"), F.first("comma").alias("comma"))
    counted = texts.groupBy("last_key", "comma").agg(F.count("*").alias("n_last"))
    n_all = counted.agg(F.sum("n_last")).scalar()
    closings = counted.where(~F.col("comma") & (F.col("n_last") >= F.greatest(F.lit(CLOSING_LEAST), CLOSING_SHARE * n_all))).select("last_key", F.lit(True).alias("closing"))
    last_items = ends.where("is_item AND item <> ''").select("item").distinct()
    open_items = begun_items(_corpus_items(df, text), last_items)

    joined = (
        ends.join(limits, F.col("source").eqNullSafe(F.col("limited")), "left")
        .join(closings, "last_key", "left")
        .join(open_items, "item", "left")
    )
    none = F.array().cast("array<int>")
    at_limit = F.array_contains(F.coalesce("char_limits", none), F.col("chars")) | F.exists(F.coalesce("octet_limits", none), lambda x: F.col("octets").between(x - 3, x + 2))
    closing = F.coalesce("closing", F.lit(False))
    fixed_end = F.col("terminal") | F.col("is_field")
    # A single word, as a code of fixed length, is no text that was cut.
    by_limit = at_limit & ~fixed_end & ((F.col("n_words") > 1) | (F.col("n_lines") > 1))
    unfinished_item = F.col("is_item") & ~F.coalesce("known", F.lit(True))
    title = (F.col("n_lines") == 1) & ~F.col("has_sentence") & (F.col("n_words") <= 16)
    prose = ~F.col("is_item") & ~F.col("is_row") & ~F.col("is_field") & ~F.col("short_lines") & ~title & ~closing
    by_end = ~F.col("terminal") & (unfinished_item | prose)
    by_mark = F.col("marked") & ~F.col("terminal") & ~F.col("is_field") & (F.col("n_words") > 1)
    reason = F.when(by_limit, "limit").when(F.col("split_char") | by_end | by_mark, "open_end")
    return joined.select("id", "source", reason.isNotNull().alias("truncated"), reason.alias("reason"))


def rates(judged: DataFrame) -> DataFrame:
    """Of each source: texts, cut texts, their share, and how many of them by a limit."""
    return judged.groupBy("source").agg(
        F.count("*").alias("n_docs"),
        F.count_if("truncated").alias("n_truncated"),
        F.count_if(F.col("reason") == "limit").alias("n_by_limit"),
        F.count_if(F.col("reason") == "open_end").alias("n_by_end"),
        F.round(F.count_if("truncated") / F.count("*"), 6).alias("rate"),
    )
