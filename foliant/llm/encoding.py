"""Text that was decoded with the wrong encoding (problem 2).

A latent chain of encodings lies behind every line: none, or one of ``CHAINS`` (UTF-8 read as some one-byte or
Chinese encoding, once or twice; legacy Vietnamese fonts and code pages read as Western ones; bytes lost for
good), or noise. The likelihood of a line under a chain is that of its text with the chain undone, by a
letter-pair model of the corpus' own clean pages. How often each chain occurs in a source and field is not known
and is found by expectation-maximisation: lines that could be read either way follow the source they come from.
Each line is then repaired by the chain of the highest posterior.

Only lines with a suspicious character become evidence. The model has a fixed size; a source has a row of as many
numbers as there are chains; texts are never shuffled.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm import letters
from foliant.llm.canon import LOOKALIKES, canonical
from foliant.session import materialise

# TCVN 5712 (the "ABC" fonts) from 0xA1, in its order; · stands for bytes without a letter.
TCVN3 = "ĂÂÊÔƠƯĐăâêôơưđ······àảãáạ·ằẳẵắ·······ặầẩẫấậè·ẻẽéẹềểễếệìỉ···ĩíịò·ỏõóọồổỗốộờởỡớợù·ủũúụừửữứựỳỷỹýỵ"
# VISCII (RFC 1456) from 0x80, in its order.
VISCII = "ẠẮẰẶẤẦẨẬẼẸẾỀỂỄỆỐỒỔỖỘỢỚỜỞỊỎỌỈỦŨỤỲÕắằặấầẩậẽẹếềểễệốồổỗỠƠộờởịỰỨỪỬơớƯÀÁÂÃẢĂẳẵÈÉÊẺÌÍĨỳĐứÒÓÔạỷừửÙÚỹỵÝỡưàáâãảăữẫèéêẻìíĩỉđựòóôõỏọụùúũủýợỮ"
# The second characters of the VNI fonts and what they put on a letter; then its single letters.
VNI_MARKS = {"ø": "̀", "ù": "́", "û": "̉", "õ": "̃", "ï": "̣", "â": "̂", "á": "̂́", "à": "̂̀", "å": "̂̉", "ã": "̂̃", "ä": "̣̂", "ê": "̆", "é": "̆́", "è": "̆̀", "ú": "̆̉", "ü": "̆̃", "ë": "̣̆"}
VNI_LETTERS = {"ñ": "đ", "ö": "ư", "ô": "ơ", "æ": "ỉ", "ó": "ĩ", "ò": "ị", "î": "ỵ", "Ñ": "Đ", "Ö": "Ư", "Ô": "Ơ", "Æ": "Ỉ", "Ó": "Ĩ", "Ò": "Ị", "Î": "Ỵ"}

Undo = Callable[[str], str]


def _byte_of(name: str) -> dict[str, int]:
    """The upper bytes of a one-byte encoding by the characters it shows them as; undefined ones show as C1."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            ch = bytes([b]).decode(name)
        except UnicodeDecodeError:
            ch = chr(b)
        out.setdefault(ch, b)
    return out


def _utf8_as(name: str, times: int = 1) -> Undo:
    """Undoes reading UTF-8 as ``name``: wherever characters stand for the bytes of one character, it comes back."""
    byte = _byte_of(name)
    inside = lambda lo, hi: re.escape("".join(c for c, b in byte.items() if lo <= b <= hi))
    rest = f"[{inside(0x80, 0xBF)}]"
    # A byte that the reading could not show is lost; the character is lost with it.
    gone = f"[{inside(0x80, 0xBF)}�]"
    whole = re.compile(f"[{inside(0xC2, 0xDF)}]{rest}|[{inside(0xE0, 0xEF)}]{rest}{{2}}|[{inside(0xF0, 0xF4)}]{rest}{{3}}")
    broken = re.compile(f"[{inside(0xC2, 0xDF)}]�|[{inside(0xE0, 0xEF)}](?:�{gone}|{rest}�)")

    def one(m: re.Match[str]) -> str:
        try:
            return bytes(byte[c] for c in m[0]).decode("utf-8")
        except UnicodeDecodeError:
            return m[0]

    def undo(text: str) -> str:
        for _ in range(times):
            text = whole.sub(one, text)
        return broken.sub("�", text) if "�" in text else text

    return undo


def _utf8_as_wide(name: str) -> Undo:
    """The same for an encoding that shows two bytes as one character."""
    wide = re.compile(r"[⺀-鿿︰-﹯＀-￯-]+(?:�[⺀-鿿]*)*[�?]?")

    def one(m: re.Match[str]) -> str:
        data = b"".join(ch.encode(name, "replace") if ch != "�" else b"\xff" for ch in m[0])
        out = data.decode("utf-8", "replace")
        return re.sub("�+", "�", out)

    return lambda text: wide.sub(one, text)


def _page_as(true: str, seen: str) -> Undo:
    """One-byte text of the code page ``true`` that was read as ``seen``; for lines that ``seen`` can write."""

    def undo(text: str) -> str:
        try:
            return unicodedata.normalize("NFC", text.encode(seen).decode(true))
        except UnicodeError:
            return text

    return undo


def _letters_as_cp1252(letters: str, first: int) -> Undo:
    """One-byte text whose bytes from ``first`` on are ``letters``, read as cp1252; · is no letter."""
    table = {b: ch for b, ch in enumerate(letters, first) if ch != "·"}
    shown = {ord(c): table[b] for c, b in _byte_of("cp1252").items() if b in table}
    strange = re.compile("[^\x00-\x7f " + re.escape("".join(map(chr, shown))) + "–—‘’“”…]")

    def undo(text: str) -> str:
        return text if strange.search(text) else text.translate(shown)

    return undo


def _vni() -> Undo:
    def both(x: dict[str, str]) -> dict[str, str]:
        return x | {k.upper(): v for k, v in x.items()}

    marks = both(VNI_MARKS)
    pair = re.compile("([aeiouyAEIOUYôöÔÖ])([" + "".join(marks) + "])")
    strange = re.compile("[^\x00-\xff–—‘’“”…]")

    def one(m: re.Match[str]) -> str:
        return unicodedata.normalize("NFC", VNI_LETTERS.get(m[1], m[1]) + marks[m[2]])

    def undo(text: str) -> str:
        if strange.search(text):
            return text
        # Pairs first; single letters only outside of them.
        return "".join(one(m) if (m := pair.fullmatch(x)) else "".join(VNI_LETTERS.get(c, c) for c in x) for x in re.split(f"((?:{pair.pattern.replace('(', '(?:')}))", text))

    return undo


#: The chains by name; each undoes itself on a line and leaves what it can't have made.
CHAINS: dict[str, Undo] = {
    "utf8_as_cp1252": _utf8_as("cp1252"),
    "utf8_as_latin1": _utf8_as("latin-1"),
    "utf8_as_cp1252_twice": _utf8_as("cp1252", 2),
    "utf8_as_cp1258": _utf8_as("cp1258"),
    "utf8_as_cp437": _utf8_as("cp437"),
    "utf8_as_cp850": _utf8_as("cp850"),
    "utf8_as_mac_roman": _utf8_as("mac_roman"),
    "utf8_as_cp1250": _utf8_as("cp1250"),
    "utf8_as_cp1251": _utf8_as("cp1251"),
    "utf8_as_gbk": _utf8_as_wide("gbk"),
    "cp1258_as_cp1252": _page_as("cp1258", "cp1252"),
    "tcvn3_as_cp1252": _letters_as_cp1252(TCVN3, 0xA1),
    "vni_as_cp1252": _vni(),
    "viscii_as_cp1252": _letters_as_cp1252(VISCII, 0x80),
}
NAMES = ["none", "noise", "lost", *CHAINS]
K = len(NAMES)
#: Log probability of a character under noise; what a line pays for each character lost for good; the prior.
NOISE, LOST = -3.6, -3.0
PRIOR = [0.93, 0.02] + [0.05 / (K - 2)] * (K - 2)
#: So many lines' worth of the overall mixture are in every source's.
PULL = 4.0
ROUNDS = 3

#: Characters that clean text of these languages does not have, so that a line without them needs no look.
_PLAIN = "".join(ch for ch in letters.KNOWN if ch not in "°") + "".join(map(chr, [0x2002, 0x2003, 0x2007, 0x2009, 0x202F, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x2010, 0x2011, 0xF0B7, 0x0D, *range(0x300, 0x330), *range(0xFF01, 0xFF5F), 0xFB01, 0xFB02, 0xD0, 0x189])) + "".join(seen for seen, _ in LOOKALIKES.values())
SUSPECT = "[^\\x00-\\x7f" + "".join(f"\\u{ord(c):04x}" for c in sorted(_PLAIN) if ord(c) > 0x7F) + "]"
_SUSPECT = re.compile(SUSPECT)
#: Legacy code pages may use letters of the languages only, but then in places where none can be.
MISPLACED = r"[ìòÌÒÞðÑØ](?:(?<=[aeiouyêôâăơưýìòAEIOUY][ìòÌÒÞ])|(?<=ð)|(?<=[a-z][ÌÒÞÑØ]))"
_MISPLACED = re.compile(MISPLACED)


def strange(text: str) -> bool:
    """Has it characters that clean text doesn't have, or that one can't have there?

    Python's character classes are bit maps; the same class is many times slower in the JVM.
    """
    return bool(_SUSPECT.search(text) or _MISPLACED.search(text) or "?" in text)


QUOTED = re.compile(r"([“\"«‘'])([^“”\"«»‘’'\s]{1,8})([”\"»’'])")
EDGE = re.compile("[¬­‐-]+[ \\t]*$|^[ \\t]*[-·•*]")


def _bare(line: str) -> str:
    """The line without what it only quotes and without the marks of a cut word, neither of which is evidence."""
    if _SUSPECT.search(line):
        line = QUOTED.sub(lambda m: m[1] + m[3] if _SUSPECT.search(m[2]) or "Ã" in m[2] or "Æ" in m[2] else m[0], line)
    return EDGE.sub("", line)


def _lost(line: str) -> int:
    """Characters in words that were replaced by a sign."""
    return len(re.findall("�", line)) + len(re.findall(r"(?<=[^\W\d_])\?(?=[^\W\d_])", line))


def _evidence(model: np.ndarray, lines: list[str]) -> np.ndarray:
    """Log likelihoods, lines x chains; -inf where a chain changes nothing."""
    out = np.full((len(lines), K), -np.inf)
    texts: list[str] = []
    at: list[tuple[int, int, float]] = []
    for i, line in enumerate(lines):
        plain = canonical(line)
        texts.append(plain)
        gone = _lost(line)
        # An unexplained sign of loss is as good as impossible in clean text.
        at.append((i, 0, -14.0 * gone))
        if gone:
            texts.append(texts[-1])
            at.append((i, 2, LOST * gone))
        out[i, 1] = NOISE * len(line)
        seen: set[str] = set()
        for k, undo in enumerate(CHAINS.values(), 3):
            said = undo(line)
            if said != line and said not in seen:
                seen.add(said)
                said = canonical(said)
                if said != plain:
                    texts.append(said)
                    at.append((i, k, LOST * _lost(said)))
    for (i, k, extra), s in zip(at, letters.scores(texts, model), strict=True):
        out[i, k] = s + extra
    return out


def evidence(df: DataFrame, key: str, text: str, sources: list[str]) -> DataFrame:
    """One row per suspicious line: ``id``, ``source``, ``line`` (from 0), ``likes``: a log likelihood for each of NAMES."""
    source = F.concat_ws("\x1f", *(F.coalesce(F.col(s).cast("string"), F.lit("")) for s in sources), F.lit(text))
    rows = df.select(F.col(key).alias("id"), source.alias("source"), F.col(text).alias("text"))
    rows = rows.where(F.length("text") > 0)
    model = letters.log_model(letters.pair_counts(rows, "text", strange))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("source", T.StringType()), T.StructField("line", T.IntegerType()), T.StructField("likes", T.ArrayType(T.DoubleType()))])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, froms, texts = (c.to_pylist() for c in batch.columns)
            where: list[tuple] = []
            lines: list[str] = []
            for i, s, said in zip(ids, froms, texts, strict=True):
                if not strange(said):
                    continue
                for n, line in enumerate(said.split("\n")):
                    if strange(line):
                        bare = _bare(line.rstrip("\r"))
                        if strange(bare):
                            where.append((i, s, n))
                            lines.append(bare)
            if lines:
                found = np.maximum(_evidence(model, lines), -1e6)
                head = [pa.array(c, t) for c, t in zip(zip(*where, strict=True), (batch.schema.field(0).type, pa.string(), pa.int32()), strict=True)]
                yield pa.RecordBatch.from_arrays([*head, _lists(found)], names)

    return rows.mapInArrow(run, schema)


def _weights(likes: pa.Array, mixture: np.ndarray) -> np.ndarray:
    """The posterior of each chain, rows x chains, under a mixture (K numbers) or one for each row."""
    w = np.asarray(likes.flatten()).reshape(-1, K) + np.log(mixture)
    w = np.exp(w - w.max(1, keepdims=True))
    return w / w.sum(1, keepdims=True)


def _summed(seen: DataFrame) -> DataFrame:
    """``source, n, w``: of each source its lines and the sums of their posteriors, under the mixtures in ``p``.

    Each Arrow batch is summed by itself, so that a source with a third of all lines moves as a few rows per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = _weights(batch.column(1), np.asarray(batch.column(2).flatten()).reshape(-1, K))
                coded = batch.column(0).dictionary_encode()
                at = np.asarray(coded.indices)
                n = np.bincount(at, minlength=len(coded.dictionary))
                sums = np.stack([np.bincount(at, weights=w[:, k], minlength=len(n)) for k in range(K)], 1)
                yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n), _lists(sums)], ["source", "n", "w"])

    parts = seen.select("source", "likes", "p").mapInArrow(run, "source string, n long, w array<double>")
    return parts.groupBy("source").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("w")[k]) for k in range(K))).alias("w"))


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, K, dtype=np.int32)), pa.array(values.ravel()))


def mixtures(seen: DataFrame) -> DataFrame:
    """``source, p``: how often each chain occurs in each source, by expectation-maximisation.

    A row of K numbers per source. Each round is written, so no round's plan holds those before it.
    """
    constant = lambda values: F.array(*map(F.lit, map(float, values)))
    # The first round gives the overall mixture: K numbers.
    first = materialise(_summed(seen.withColumn("p", constant(PRIOR))), "mixture")
    total = first.agg(F.sum("n").alias("n"), *(F.sum(F.col("w")[k]).alias(f"w{k}") for k in range(K))).first()
    n = total["n"] or 0
    overall = [((total[f"w{k}"] or 0.0) + 20 * PRIOR[k]) / (n + 20) for k in range(K)]

    def maximised(sums: DataFrame) -> DataFrame:
        return sums.select("source", F.zip_with("w", constant(overall), lambda w, o: (w + PULL * o) / (F.col("n") + PULL)).alias("p"))

    now = seen.withColumn("p", constant(overall))
    for _ in range(ROUNDS):
        mixture = materialise(maximised(_summed(now)), "mixture")
        now = seen.join(mixture, "source")
    return mixture


def posteriors(seen: DataFrame) -> DataFrame:
    """``id, source, line, chain, sure, wrong``: the most likely chain of each line, its posterior, and that of any, after EM.

    Mixtures are joined to lines. Small ones are broadcast, by their size as written; beyond that adaptive execution
    splits a source that has many lines.
    """
    now = seen.join(mixtures(seen), "source").select("id", "source", "line", "likes", "p")
    schema = T.StructType([*now.schema.fields[:3], T.StructField("chain", T.StringType()), T.StructField("sure", T.DoubleType()), T.StructField("wrong", T.DoubleType())])
    names = pa.array(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = _weights(batch.column(3), np.asarray(batch.column(4).flatten()).reshape(-1, K))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], names.take(pa.array(w.argmax(1))), pa.array(w.max(1)), pa.array(1 - w[:, 0] - w[:, 1])], schema.fieldNames())

    return now.mapInArrow(run, schema)


def garbled_lines(df: DataFrame, key: str = "page_id", text: str = "raw_text", sources: tuple[str, ...] = ("document_id",)) -> DataFrame:
    """The lines that were wrongly decoded, with their chain. Null and empty texts have none; a null source is one."""
    seen = materialise(evidence(df, key, text, list(sources)), "evidence")
    return posteriors(seen).where("wrong > 0.5").select("id", "source", "line", F.when(F.col("chain").isin("none", "noise"), "lost").otherwise(F.col("chain")).alias("chain"), "sure")


def repaired(df: DataFrame, key: str = "page_id", text: str = "raw_text", sources: tuple[str, ...] = ("document_id",)) -> DataFrame:
    """``key, text, n_lines_repaired, n_lost``: every row's text with its garbled lines restored.

    Characters that are lost for good stay as U+FFFD and are counted. Null stays null.
    """
    lines = garbled_lines(df, key, text, sources).groupBy("id").agg(F.collect_list(F.struct("line", "chain")).alias("todo"))
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField(key, rows.schema["id"].dataType), T.StructField("text", T.StringType()), T.StructField("n_lines_repaired", T.IntegerType()), T.StructField("n_lost", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, todos = (c.to_pylist() for c in batch.columns[1:])
            repaired_, losses = [0] * len(texts), [0] * len(texts)
            for n, (said, todo) in enumerate(zip(texts, todos, strict=True)):
                if not todo:
                    continue
                parts = said.split("\n")
                for x in todo:
                    if x["chain"] in CHAINS:
                        parts[x["line"]] = CHAINS[x["chain"]](parts[x["line"]])
                    losses[n] += _lost(parts[x["line"]])
                texts[n], repaired_[n] = "\n".join(parts), len(todo)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(repaired_, pa.int32()), pa.array(losses, pa.int32())], schema.fieldNames())

    # One join for all rows: texts move once, to what is to be done in them.
    return rows.join(lines, "id", "left").select("id", "text", "todo").mapInArrow(run, schema)
