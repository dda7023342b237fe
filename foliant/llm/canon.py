"""One form for texts that look the same (problem 4).

Most text is already in the canonical form, and quick-check properties tell so without normalising: a text
without any character of ``UNSTABLE`` is returned as it is. Otherwise the unstable characters are widened to
segments with the context that decides about them (a combining mark needs the letter before it, a look-alike
letter its whole word), only the segments are normalised, and they are spliced into the unchanged rest.

The canonical form: line ends are LF; spaces of any width are one space each; letters of full or half width,
joined letters and non-breaking or typographic hyphens are the plain ones; accents are composed (NFC);
characters without a picture (zero-width, joiners, marks of direction, soft hyphens, controls) are gone; letters
of other scripts that look like Latin ones are Latin, in words that can be written with Latin letters throughout.
Case, line breaks, accents and visible characters stay.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.session import materialise

# Letters of other scripts beside the Latin letters they look like.
LOOKALIKES = {
    "Cyrillic": ("АВЕЅІЈКМНОРСТУХҮЗЬаеѕіјорсухһԁԛԝүѵгпк", "ABESIJKMHOPCTYXY3baesijopcyxhdqwyvrnk"),
    "Greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρυικγα", "ABEZHIKMNOPTYXovpuikya"),
    "Latin": ("ÐƉǃǀɑɡıℓ", "ĐĐ!|agıl"),
    "Hyphens": ("‐‑", "--"),
}
LOOKS = {ord(a): b for x, y in LOOKALIKES.values() for a, b in zip(x, y, strict=True) if a != b}
# Letters that are look-alikes only in print beside others: too unlike on their own.
for weak in "гпкγαЬЗ":
    LOOKS.pop(ord(weak), None)


def _becomes(c: int) -> str | None:
    """What a character becomes on its own; it stays if the answer is itself."""
    ch = chr(c)
    if ch in "\n\t" or 0xD800 <= c < 0xE000:
        return ch
    kind, parts = unicodedata.category(ch), unicodedata.decomposition(ch)
    if kind in ("Cf", "Cc") or 0xFE00 <= c <= 0xFE0F or 0xE0100 <= c <= 0xE01EF or c in (0x115F, 0x1160, 0x3164, 0xFFA0, 0x034F):
        return None
    if kind == "Zs":
        return " "
    if parts.startswith(("<wide>", "<narrow>", "<font>")) or 0xFB00 <= c <= 0xFB06 or ch in "ĲĳǇǈǉǊǋǌǱǲǳŉ":
        return unicodedata.normalize("NFKC", ch)
    return ch


def _maybe() -> set[int]:
    """Characters that NFC may join with the one before them (quick check "maybe"): the second halves of composites."""
    out = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}  # vowels and finals of Hangul syllables
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and parts[0][0] != "<" and unicodedata.normalize("NFC", "".join(chr(int(p, 16)) for p in parts)) == chr(c):
            out.add(int(parts[1], 16))
    return out


class _Single(dict):
    """A translation table that fills itself."""

    def __missing__(self, c: int) -> str | None:
        self[c] = out = _becomes(c)
        return out


def _unstable() -> str:
    """The class of all characters of the basic plane that aren't stable on their own, or not behind every other."""
    runs: list[list[int]] = []
    maybe = _maybe()
    for c in range(0x10000):
        ch = chr(c)
        if 0xD800 <= c < 0xE000 or _becomes(c) == ch and c not in LOOKS and c not in maybe and not unicodedata.category(ch).startswith("M") and unicodedata.normalize("NFC", ch) == ch:
            continue
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" if a != b else f"\\u{a:04x}" for a, b in runs)


SINGLE, CLASS = _Single(), _unstable()
#: Characters beyond the basic plane are rare here, so all of them count as unstable; the class stays a bit map.
UNSTABLE = re.compile(f"[{CLASS}]|[\U00010000-\U0010ffff]")
GAP = re.compile("[ \n\t]")
LETTERS = re.compile(r"(?:[^\W\d_][\u0300-\u036f]*)+")
CR = re.compile(r"\r\n?|[\x0b\x0c\x85  ]")


def _latin(word: re.Match[str]) -> str:
    """A word of look-alikes and Latin letters, in Latin letters; a word that needs another script, as it is."""
    said = word[0]
    out = said.translate(LOOKS)
    if out != said and all(ord(c) < 0x370 for c in out):
        return out
    return said


def _segment(said: str) -> str:
    # Marks come apart first: a look-alike may have been composed with one.
    out = unicodedata.normalize("NFD", said.translate(SINGLE))
    return unicodedata.normalize("NFC", LETTERS.sub(_latin, out)).replace("‐", "-").replace("‑", "-")


def canonical(text: str) -> str:
    """The canonical form; applying it again changes nothing."""
    if not UNSTABLE.search(text):
        return text
    if "\r" in text or "\x0b" in text or "\x0c" in text or "\x85" in text or " " in text or " " in text:
        text = CR.sub("\n", text)
    out: list[str] = []
    done = 0
    while found := UNSTABLE.search(text, done):
        # The segment is the word around: it decides about look-alikes and holds the letter before a mark.
        at = found.start()
        start = max(done, 1 + max(text.rfind(gap, done, at) for gap in " \n\t"))
        gap = GAP.search(text, found.end())
        end = gap.start() if gap else len(text)
        out += (text[done:start], _segment(text[start:end]))
        done = end
    out.append(text[done:])
    return "".join(out)


def canonical_texts(df: DataFrame, key: str = "page_id", text: str = "raw_text", digests: bool = False) -> DataFrame:
    """``key`` and ``text`` in the canonical form, one row for each row of ``df``; null stays null, "" stays "".

    With ``digests`` the texts stay out and 128-bit digests of the form (``form``) and of the text as it was
    (``raw``) come instead, with the length of the form without white space around it (``chars``).
    """
    kind = df.schema[key].dataType
    fields = [T.StructField(key, kind)]
    if digests:
        fields += [T.StructField("form", T.BinaryType()), T.StructField("raw", T.BinaryType()), T.StructField("chars", T.IntegerType())]
    else:
        fields += [T.StructField("text", T.StringType())]
    names = [f.name for f in fields]

    def digest(said: str) -> bytes:
        return hashlib.blake2b(said.encode("utf-8", "surrogatepass"), digest_size=16).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            forms = [None if x is None else canonical(x) for x in texts]
            if digests:
                ours = [None if x is None else digest(x) for x in forms]
                theirs = [o if x is y else digest(x) for x, y, o in zip(texts, forms, ours) if x is not None]
                it = iter(theirs)
                raws = [None if x is None else next(it) for x in texts]
                columns = [pa.array(ours, pa.binary()), pa.array(raws, pa.binary()), pa.array([None if x is None else len(x.strip()) for x in forms], pa.int32())]
            else:
                columns = [pa.array(forms, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return df.select(F.col(key), F.col(text)).mapInArrow(run, T.StructType(fields))


#: Rows or spellings of one form that meet in one block of a join.
BLOCK = 1000


def _spellings(rows: DataFrame, key: str) -> DataFrame:
    """``form, raw, n, first`` of the forms that are spelt in several ways, and how many (``ways``).

    Everything is counted in parts before it is shuffled: a form may have a third of all rows.
    """
    each = rows.groupBy("form", "raw").agg(F.count("*").alias("n"), F.min(key).alias("first"))
    forms = each.groupBy("form").agg(F.count("*").alias("ways"), F.sum("n").alias("all"), F.min("first").alias("class_id"))
    return each.join(forms.where("ways > 1"), "form")


def _forms(df: DataFrame, key: str, text: str, least: int) -> DataFrame:
    return materialise(canonical_texts(df, key, text, digests=True).where(F.col("chars") >= least).drop("chars"), "forms")


def lookalike_classes(df: DataFrame, key: str = "page_id", text: str = "raw_text", least: int = 30) -> DataFrame:
    """``key, class_id, n_members, n_spellings, n_links`` of the rows that look like a row with another text.

    ``class_id`` is the least key of the rows that look the same, ``n_links`` how many of them have another text.
    Null and short texts are in no class.
    """
    rows = _forms(df, key, text, least)
    several = _spellings(rows, key).select("form", "raw", "class_id", F.col("all").alias("n_members"), F.col("ways").alias("n_spellings"), (F.col("all") - F.col("n")).alias("n_links"))
    # The right side has a row per spelling, so that adaptive execution can split a hot one on the left.
    return rows.join(several, ["form", "raw"]).select(key, "class_id", "n_members", "n_spellings", "n_links")


def _blocks(n: str) -> Column:
    return F.ceil(F.col(n) / BLOCK).cast("int")


def _block(value: str, n: str) -> Column:
    return F.pmod(F.xxhash64(value), _blocks(n)).cast("int")


def _numbers(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def lookalike_pairs(df: DataFrame, key: str = "page_id", text: str = "raw_text", least: int = 30) -> DataFrame:
    """``<key>_a`` < ``<key>_b``: rows whose texts differ but have one canonical form of ``least`` characters.

    Null and short texts are in no pair, nor are equal texts. Forms with a single spelling leave before any join;
    then spellings are paired within their form, then the rows of two spellings. Both are done in blocks of BLOCK,
    each pair of blocks by itself, so no task gets all rows of a form. (``lookalike_classes`` has the same result in
    a row per row.)
    """
    rows = _forms(df, key, text, least)
    each = materialise(_spellings(rows, key).select("form", "raw", "n", "ways", _block("raw", "ways").alias("at")), "spellings")
    # Every two blocks of a form's spellings meet once in each order; the order of the digests picks one.
    left = each.select("form", F.col("raw").alias("raw_a"), F.col("n").alias("n_a"), F.col("at").alias("i"), _numbers(_blocks("ways")).alias("j"))
    right = each.select("form", F.col("raw").alias("raw_b"), F.col("n").alias("n_b"), F.col("at").alias("j"), _numbers(_blocks("ways")).alias("i"))
    pairs = left.join(right, ["form", "i", "j"]).where("raw_a < raw_b").select("form", "raw_a", "raw_b", "n_a", "n_b")
    members = rows.join(each.select("form", "raw", "n"), ["form", "raw"]).select("form", "raw", F.col(key).alias("x"), _block(key, "n").alias("at"))
    cells = pairs.withColumn("i", _numbers(_blocks("n_a"))).withColumn("j", _numbers(_blocks("n_b"))).drop("n_a", "n_b")
    a = cells.join(members.select("form", F.col("raw").alias("raw_a"), F.col("at").alias("i"), F.col("x").alias("x")), ["form", "raw_a", "i"])
    b = cells.join(members.select("form", F.col("raw").alias("raw_b"), F.col("at").alias("j"), F.col("x").alias("y")), ["form", "raw_b", "j"])
    found = a.join(b, ["form", "raw_a", "raw_b", "i", "j"])
    return found.select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))
