"""Text statistics of pages and the kind of page they show (problem 1).

Every line becomes one of ``SYMBOLS`` by its statistics (length, marks, columns, case, share of readable words). A
hidden Markov model whose states are prose, list, table and junk reads the sequence of a page's lines; it starts
from what the symbols mean and is trained by Baum-Welch on the sequences of all pages. The posterior shares of the
states, weighted by what the lines hold, are aggregated per page; the largest share is the page's kind.

Lines are judged in canonical form with their encoding put right. Page numbers and headings say nothing about the
kind. Sequences are short strings, written once; every training round sums a table of fixed size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm import encoding, scans
from foliant.llm.canon import canonical
from foliant.session import materialise

STATES = ["prose", "list", "table", "junk"]
# Symbols of lines, and how likely each state writes them at the start of the training.
EMISSIONS = {
    #                        prose  list   table  junk
    "s": ("sentence line", 0.2500, 0.0100, 0.0040, 0.004),
    "w": ("lower-case line within running text", 0.4000, 0.0200, 0.0060, 0.004),
    "W": ("upper-case line of some length", 0.1700, 0.0300, 0.0100, 0.004),
    "u": ("short lower-case line", 0.0600, 0.0400, 0.0300, 0.01),
    "U": ("short upper-case line", 0.0400, 0.2300, 0.1600, 0.02),
    "c": ("numbered clause of sentences", 0.0600, 0.0150, 0.0010, 0.001),
    "L": ("item", 0.0080, 0.3600, 0.0080, 0.002),
    "C": ("contents line", 0.0005, 0.1400, 0.0020, 0.001),
    "F": ("blank field", 0.0005, 0.1400, 0.0040, 0.002),
    "T": ("row of columns", 0.0008, 0.0030, 0.5200, 0.005),
    "N": ("cell: a number, code or mark", 0.0020, 0.0050, 0.2400, 0.02),
    "J": ("nothing readable", 0.0010, 0.0010, 0.0050, 0.55),
    "R": ("part of a phrase repeated all over", 0.0010, 0.0020, 0.0050, 0.37),
    "o": ("says nothing: heading, page number", 0.0100, 0.0100, 0.0100, 0.01),
}
SYMBOLS = list(EMISSIONS)
CODE = {s: i for i, s in enumerate(SYMBOLS)}
STAY, ROUNDS, BELIEF = 0.93, 3, 200.0

TOKEN = re.compile(r"[\"“”‘’'«(\[]*([^\W\d_]{1,18}(?:[-’'][^\W\d_]{1,18})*)[\"”’'»)\].,;:!?…]*")
VOWEL = re.compile("[aeiouyàáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵœæëïüûî]", re.I)
CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxzđ]{5}|(?<![a-z])[bcdfgjklmpqrstvwxz][bcdfgjkmpqtvwxz][bcdfghjklmnpqrstvwxz]", re.I)
ITEM = re.compile(r"(?:[-+*•·–▪◦]|(?:\(?\d{1,3}[.)])+(?:\d{1,3}[.)])*|\(?[a-zđA-Z][.)]|[IVXLC]{1,6}[.)])\s+(?=\S)")
LEADER = re.compile(r"(?:\.{3,}|…+|_{3,}|(?:\. ){3,}\.?|-{4,}|·{3,})\s*\d{1,4}\W*$")
FIELD = re.compile(r"(?:\.{4,}|…{2,}|_{3,}|(?:\. ){4,}|☐|□)\W*$|^[^.!?]{2,48}:\W*$")
CELL = re.compile(r"\W*(?:\d[\d.,/%-]*|[A-Z]{1,3}-?\d+|[xX✓✗–-]|\d+[.)]?)\W*$")
COLUMNS = re.compile(r"\t|\S *\| *\S|^\s*\|| {3,}\S.* {3,}\S")
SHEET = re.compile(r"^\s*\d{1,3}\s*([;,\t])\s?[^;,.]+(?:\1[^;,]*)+$|^[^;.]{1,60}(?:;[^;.\s][^;]{0,60}){2,}$|^\w+(?:\s+\S+)*;\S.*;\S*$")
ALIGNED = re.compile(r"^\s*\d{1,3}\s+\D{4,60}(?:\s+(?:\d+(?:[.,]\d+)?|[A-Z]{2}\d+|x))+\s*$")


def _plain(token: str) -> bool:
    """Could it be a word? Numbers don't count, so they can't be asked here."""
    m = TOKEN.fullmatch(token)
    if not m:
        return False
    word = m[1]
    if not word.islower() and not word.istitle() and not word.isupper() and any(a.islower() and b.isupper() for a, b in zip(word, word[1:])):
        return False
    return bool(VOWEL.search(word)) and not CONSONANTS.search(word) or len(word) == 1 and word.isalpha()


class _Words(dict):
    """Remembers of each token whether it is readable (1), not (0) or no word but a number (None)."""

    def __missing__(self, token: str) -> int | None:
        if len(self) > 400_000:
            self.clear()
        core = token.strip(".,;:()[]|\"'-–/%")
        out = None if not core or core.replace(".", "").replace(",", "").replace("/", "").replace("-", "").isdigit() or re.fullmatch(r"[A-Z]{1,4}-?\d+|x|.*@.*\..*|(?:www\.|https?:).*|[_.…]+", core) else int(_plain(token))
        self[token] = out
        return out


WORDS = _Words()


def _readable(words: list[str]) -> float:
    """Share of readable words; 1 without any words."""
    judged = [x for x in map(WORDS.__getitem__, words) if x is not None]
    return sum(judged) / len(judged) if judged else 1.0


def _symbol(line: str, doubtful: bool) -> str:
    said = line.strip()
    if doubtful and len(said) > 2:
        cells = said.replace("|", " ")
        judged = [x for x in map(WORDS.__getitem__, re.split(r"[\s;]+", cells)) if x is not None]
        signs = sum(not c.isalnum() and not c.isspace() for c in cells)
        if not judged and signs * 2 > len(said) and not LEADER.search(said) and not FIELD.search(said) and cells.strip(" -:=+"):
            return "J" if len(said) > 8 else "o"
        if judged and sum(judged) < 0.45 * len(judged):
            return "J"
        # Single letters and signs, far apart.
        pieces = re.sub(r"(?:[.·] ){3,}[.·]?", "", cells).split()
        if len(pieces) >= 6 and sum(len(x) == 1 and not x.isdigit() for x in pieces) > 0.6 * len(pieces):
            return "J"
    first, last, n = said[0], said[-1], len(said)
    if ("|" in said or "\t" in said or "   " in said) and COLUMNS.search(said) and not LEADER.search(said):
        return "T"
    if n <= 14 and CELL.match(said):
        return "N"
    if (last.isdigit() or last in ".-]") and LEADER.search(said):
        return "C"
    if (last in "._…:☐□ ") and FIELD.search(said):
        return "F"
    if ";" in said and first.isdigit() and SHEET.search(said):
        return "T"
    if first.isdigit() and ALIGNED.search(said):
        return "T"
    if scans.HEADING.search(said) and n < 90:
        return "o"
    if first in "-+*•·–▪◦(" or first.isdigit() or said[1:2] in ".)" or said[2:3] in ".)":
        m = ITEM.match(said)
        if m:
            rest = said[m.end() :]
            return "c" if len(rest) > 62 or re.search(r"[.;!?]\s+\S", rest) else "L"
    if ";" in said and SHEET.search(said):
        return "T"
    if last in ".!?" and n > 12 or last == ";" and n > 40:
        return "s"
    if first.isupper():
        return "W" if n >= 46 or re.search(r"[.;!?,] ", said) else "U"
    return "w" if n >= 24 or "," in said else "u"


def _repeated(words: list[str]) -> bool:
    """Is the page one phrase over and over?"""
    # Numbers count, too: the rows of a table may say the same, but not with the same numbers.
    said = [w.lower().strip(".,;:!?") for w in words if WORDS[w] is not None or any(map(str.isdigit, w))]
    if len(said) < 16:
        return False
    triples = list(zip(said, said[1:], said[2:]))
    return len(set(triples)) < 0.34 * len(triples)


def page_facts(text: str, common: frozenset[str]) -> tuple:
    """Statistics of a page, and its lines as symbols and weights."""
    strange = encoding.strange(text)
    said = "\n".join(map(scans.readable, text.split("\n"))) if strange else canonical(text)
    said = said.replace("�", "a")
    words = said.split()
    n_words = len(words)
    letters = len(said) - said.count(" ") - said.count("\n")
    symbols = len(re.findall(r"[^\w\s]", said))
    lines = [x for x in said.split("\n") if x and not x.isspace()]
    ended = sum(x.rstrip()[-1] in ".!?;:…" for x in lines)
    frequent = sum(w.lower().strip(".,;:!?()") in common for w in words)
    doubtful = strange or n_words >= 12 and letters < 1.8 * n_words or _readable(words) < 0.85 or symbols * 6 > letters
    codes, weights = [], []
    if len(said.strip()) >= 30:
        if _repeated(words):
            codes = [CODE["R"]] * len(lines)
        else:
            last = len(lines) - 1
            for i, line in enumerate(lines):
                if (i < 2 or i > last - 2) and len(line) < 30 and (number := scans.page_number(line)) and (number[0] != "bare" or i in (0, last)):
                    codes.append(CODE["o"])
                else:
                    codes.append(CODE[_symbol(line, doubtful)])
        weights = [0 if c == CODE["o"] else min(len(x), 80) + 12 for c, x in zip(codes, lines, strict=True)]
    return n_words, letters / n_words if n_words else None, symbols / letters if letters else None, ended / len(lines) if lines else None, frequent / n_words if n_words else None, bytes(codes), weights


FACTS = T.StructType(
    [
        T.StructField("n_words", T.IntegerType()),
        *(T.StructField(n, T.DoubleType()) for n in ("mean_word_length", "symbol_ratio", "line_end_share", "common_share")),
        T.StructField("symbols", T.BinaryType()),
        T.StructField("weights", T.ArrayType(T.IntegerType())),
    ]
)
ARROW = [pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.int32())]


def _facts(df: DataFrame, key: str, text: str, common: frozenset[str]) -> DataFrame:
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema.fields[0], *FACTS.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_facts(x or "", common) for x in batch.column(1).to_pylist()]
            columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), ARROW, strict=True)] if found else [pa.array([], k) for k in ARROW]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.fieldNames())

    return rows.mapInArrow(run, schema)


# --- the model ----------------------------------------------------------------------------------------------


def start_model() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = len(STATES)
    emit = np.array([EMISSIONS[s][1:] for s in SYMBOLS]).T
    move = np.full((k, k), (1 - STAY) / (k - 1))
    np.fill_diagonal(move, STAY)
    return np.array([0.6, 0.18, 0.18, 0.04]), move, emit / emit.sum(1, keepdims=True)


def posteriors(sequences: list[bytes], model: tuple) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """State posteriors of each sequence (lines x states), and the expected counts of starts, moves and symbols."""
    start, move, emit = model
    k, m = emit.shape
    out: list[np.ndarray] = [np.zeros((0, k))] * len(sequences)
    starts, moves, symbols = np.zeros(k), np.zeros((k, k)), np.zeros((k, m))
    order = sorted((i for i, s in enumerate(sequences) if s), key=lambda i: -len(sequences[i]))
    # Sequences of like length run side by side.
    for lo in range(0, len(order), 512):
        group = order[lo : lo + 512]
        size = [len(sequences[i]) for i in group]
        top = size[0]
        seen = np.full((len(group), top), -1, dtype=np.int64)
        for r, i in enumerate(group):
            seen[r, : size[r]] = np.frombuffer(sequences[i], dtype=np.uint8)
        likes = np.where(seen[:, :, None] >= 0, emit.T[np.maximum(seen, 0)], 1.0)
        ahead = np.empty((len(group), top, k))
        a = start * likes[:, 0]
        ahead[:, 0] = a / a.sum(1, keepdims=True)
        for t in range(1, top):
            a = (ahead[:, t - 1] @ move) * likes[:, t]
            ahead[:, t] = a / a.sum(1, keepdims=True)
        back = np.ones((len(group), k))
        both = np.empty_like(ahead)
        both[:, top - 1] = ahead[:, top - 1]
        for t in range(top - 2, -1, -1):
            live = (seen[:, t + 1] >= 0)[:, None]
            pull = likes[:, t + 1] * back
            pair = ahead[:, t][:, :, None] * move[None] * pull[:, None, :]
            pair /= pair.sum((1, 2), keepdims=True)
            moves += (pair * live[:, :, None]).sum(0)
            back = np.where(live, pull @ move.T, 1.0)
            back /= back.sum(1, keepdims=True)
            g = ahead[:, t] * back
            both[:, t] = g / g.sum(1, keepdims=True)
        starts += both[:, 0].sum(0)
        for r, i in enumerate(group):
            out[i] = both[r, : size[r]]
        flat, at = both.reshape(-1, k), seen.ravel()
        for c in range(k):
            symbols[c] += np.bincount(at[at >= 0], weights=flat[at >= 0, c], minlength=m)
    return out, starts, moves, symbols


def trained(facts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The model after Baum-Welch over all pages; what the symbols mean weighs like BELIEF lines per state, or a
    hundredth of the corpus' lines if that is more."""
    first = model = start_model()
    k, m = first[2].shape
    for _ in range(ROUNDS):
        now = model

        def run(batches: Iterator[pa.RecordBatch], now: tuple = now) -> Iterator[pa.RecordBatch]:
            total = np.zeros(k + k * k + k * m)
            for batch in batches:
                _, a, b, c = posteriors(batch.column(0).to_pylist(), now)
                total += np.concatenate([a, b.ravel(), c.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "n"])

        sums = facts.where(F.octet_length("symbols") > 0).select("symbols").mapInArrow(run, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
        total = np.zeros(k + k * k + k * m)
        for row in sums:  # a table of fixed size
            total[row["at"]] = row["n"]
        a, b, c = total[:k], total[k : k + k * k].reshape(k, k), total[k + k * k :].reshape(k, m)
        belief = max(BELIEF, 0.01 * c.sum())
        a, b, c = a + belief * first[0], b + belief * first[1], c + belief * first[2] * 10
        model = a / a.sum(), b / b.sum(1, keepdims=True), c / c.sum(1, keepdims=True)
        # A symbol that says nothing keeps saying nothing.
        model[2][:, CODE["o"]] = first[2][:, CODE["o"]].mean()
    return model


def page_kinds(df: DataFrame, common_words: DataFrame, key: str = "page_id", text: str = "raw_text") -> DataFrame:
    """``key``, the statistics, ``share_<state>`` and ``kind`` of every row of ``df``.

    Null and empty texts have no words, null ratios, null shares and a null kind; so have pages of less than 30
    characters, apart from their statistics. ``common_words`` is a list of words (its size is that of the list).
    """
    common = frozenset(r.word.lower() for r in common_words.select("word").where(F.col("word").isNotNull()).distinct().collect())
    facts = materialise(_facts(df, key, text, common), "facts")
    model = trained(facts)
    shares = [f"share_{s}" for s in STATES]
    slim = facts.select("id", "n_words", "mean_word_length", "symbol_ratio", "line_end_share", "common_share", "symbols", "weights")
    schema = T.StructType([T.StructField(key, facts.schema["id"].dataType), *FACTS.fields[:5], *(T.StructField(s, T.DoubleType()) for s in shares), T.StructField("kind", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, *_ = posteriors(batch.column(6).to_pylist(), model)
            out = []
            for p, w in zip(found, batch.column(7).to_pylist(), strict=True):
                weight = np.array(w, dtype=float)
                if not weight.sum():
                    out.append((None,) * (len(STATES) + 1))
                    continue
                s = weight @ p / weight.sum()
                out.append((*map(float, s), STATES[int(s.argmax())]))
            columns = list(zip(*out, strict=True)) if out else [()] * (len(STATES) + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], *(pa.array(c, pa.float64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], schema.fieldNames())

    return slim.mapInArrow(run, schema)
