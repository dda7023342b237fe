"""Cutting oversized texts at natural boundaries (problem 3).

Recursive bisection: a text longer than its limit is cut at the strongest boundary near its middle, and the
halves are cut again while they exceed the limit less the overlap. Then each piece but the first is given the
overlap: the characters before it. Boundaries by strength: the end of a page, a heading, the end of a paragraph,
of a sentence, of a line, of a clause, of a word. If there is none near the middle, the nearest one anywhere in
the span is taken that leaves wording on both sides. Only a span without any is cut between characters, but never
between a letter and its marks or inside a line end.

The pieces, less their overlaps, are the text: nothing is lost, nothing is added.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A cut is near the middle up to this share of the span; boundaries further off are taken if there are none.
REACH = 0.3

STRUCTURE = re.compile(r"\n[ \t\r]*(?:(?P<page>---+[ \t\r]*\n\s*|(?=(?:## Trang |<!-- page:|\x0c)))|(?P<heading>\s*(?=#{1,6} |(?:Điều|Chương|Mục|Section|Article|Chapter|CHƯƠNG|ĐIỀU) \d))|(?P<paragraph>\n\s*))")
#: Ends within a paragraph, strongest first: of a sentence, of a line, of a clause, of a word.
ENDS = [re.compile(p) for p in (r"[.!?…][\"”’)\]]*\s+", r"\r?\n", r"[;:,][\"”’)\]]*\s+", r"\s+")]


def _structure(text: str) -> list[list[int]]:
    """Positions of the stronger boundaries, strongest first."""
    at: dict[str, list[int]] = {"page": [], "heading": [], "paragraph": []}
    for m in STRUCTURE.finditer(text):
        at[m.lastgroup or "page"].append(m.end())
    return list(at.values())


def _nearest(places: list[int], lo: int, mid: int, hi: int) -> int | None:
    """The place nearest to ``mid`` in lo..hi, of a sorted list."""
    k = bisect_left(places, mid)
    best = None
    for p in places[max(0, k - 1) : k + 1]:
        if lo <= p <= hi and (best is None or abs(p - mid) < abs(best - mid)):
            best = p
    return best


def _boundary(text: str, structure: list[list[int]], start: int, lo: int, mid: int, hi: int) -> int | None:
    """The strongest boundary in lo..hi, of equal ones the nearest to the middle."""
    for places in structure:
        if (p := _nearest(places, lo, mid, hi)) is not None:
            return p
    for end in ENDS:
        # Looked for around the middle, in a span that grows.
        span = 64
        while True:
            a, b = max(lo, mid - span), min(hi, mid + span)
            if (p := _nearest([m.end() for m in end.finditer(text, max(start, a - 8), b)], a, mid, b)) is not None:
                return p
            if (a, b) == (lo, hi):
                break
            span *= 4
    return None


def _cut(text: str, structure: list[list[int]], start: int, end: int) -> int:
    mid = (start + end) // 2
    reach = max(1, int((end - start) * REACH))
    p = _boundary(text, structure, start, max(start + 1, mid - reach), mid, min(end - 1, mid + reach))
    if p is None:
        # Anywhere between the first and the last wording of the span.
        said = text[start:end]
        lo, hi = start + len(said) - len(said.lstrip()) + 1, start + len(said.rstrip()) - 1
        p = _boundary(text, structure, start, lo, mid, hi) if lo <= hi else None
    if p is not None:
        return p
    p, hi = mid, min(end - 1, mid + reach)
    while p < hi and (_mark(text[p]) or text[p - 1 : p + 1] == "\r\n"):
        p += 1
    return p if p < hi else mid


def _mark(ch: str) -> bool:
    c = ord(ch)
    return 0x300 <= c < 0x370 or c in (0x200C, 0x200D) or 0xFE00 <= c <= 0xFE0F


def spans(text: str, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, end, overlap) of each piece: it is text[start - overlap:end]."""
    if len(text) <= limit:
        return [(0, len(text), 0)]
    structure = _structure(text)
    room = limit - overlap
    out: list[tuple[int, int]] = []
    todo = [(0, len(text))]
    while todo:
        start, end = todo.pop()
        if end - start <= room:
            out.append((start, end))
        else:
            p = _cut(text, structure, start, end)
            todo += [(p, end), (start, p)]
    return [(a, b, min(a, overlap)) for a, b in out]


def pieces(
    df: DataFrame, limits: DataFrame, key: str = "extract_id", text: str = "extracted_text", strategy: str = "chunking_strategy", fallback: str = "fallback"
) -> DataFrame:
    """``key, piece_no, n_pieces, start_char, overlap, n_chars, piece`` of every row with a text.

    ``start_char`` counts from 0 and is where the piece begins, its overlap included. A strategy that is null or
    has no limit takes the row ``fallback``. A null text gives no piece, an empty one a piece without characters.
    An overlap has to leave room: it counts as half the limit at most. Texts within the limit are one piece.
    ``limits`` has a row per strategy; if it names one twice, the smaller limit holds.
    """
    few = limits.where("chunking_strategy IS NOT NULL").groupBy(F.col("chunking_strategy").alias("s")).agg(F.min(F.struct("max_chars", "overlap_chars")).alias("l"))
    # A row per strategy, as one value of the plan: the texts are joined with nothing.
    of = few.agg(F.map_from_entries(F.collect_list(F.struct("s", "l")))).scalar()
    kind = df.schema[key].dataType
    rows = df.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(strategy).alias("s"), F.col(text).alias("t"))
    rows = rows.withColumn("l", F.coalesce(F.try_element_at(of, F.coalesce("s", F.lit(fallback))), F.try_element_at(of, F.lit(fallback))))
    rows = rows.select("k", F.col("l.max_chars").alias("limit"), F.col("l.overlap_chars").alias("overlap"), "t")
    schema = T.StructType(
        [T.StructField(key, kind), *(T.StructField(n, T.IntegerType()) for n in ("piece_no", "n_pieces", "start_char", "overlap", "n_chars")), T.StructField("piece", T.StringType())]
    )
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, limits_, overlaps, texts = (c.to_pylist() for c in batch.columns)
            out: list[list] = [[] for _ in names]
            held = 0
            for k, limit, overlap, said in zip(keys, limits_, overlaps, texts, strict=True):
                if not limit:  # without any limit the text is whole
                    limit = max(1, len(said))
                found = spans(said, limit, max(0, min(overlap or 0, limit // 2)))
                for n, (a, b, o) in enumerate(found, 1):
                    for column, value in zip(out, (k, n, len(found), a - o, o, b - a + o, said[a - o : b]), strict=True):
                        column.append(value)
                held += len(said)
                if held > 4_000_000:
                    yield _batch(out, batch.schema.field(0).type, names)
                    out, held = [[] for _ in names], 0
            if out[0]:
                yield _batch(out, batch.schema.field(0).type, names)

    return rows.mapInArrow(run, schema)


def _batch(columns: list[list], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [kind, *[pa.int32()] * 5, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)
