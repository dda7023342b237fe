"""Noise of paper in page texts, and readable paragraphs in its place (problem 5).

* A character editor, an averaged perceptron, reads each word that the corpus' vocabulary does not have and says
  for every character: keep it, replace it, delete it, put letters in, or, at a mark at a line end, join the lines.
  It is trained here, on the corpus' frequent words spoilt the way scanners spoil them. An edit counts if it gives
  a word of the vocabulary.
* Running lines and page numbers: a second averaged perceptron, over where a line stands on its page and what form it
  has, says which lines may belong to the page's frame. It is trained here on a bounded number of pages, whose lines
  are labelled by what recurs. An exact count follows: a line at the edge (one of the two outermost, or with nothing
  but such lines outside it) whose wording, numbers aside, stands there on three or more pages of the version; a
  number there that keeps its distance to the page's number through the version, or says it is a page's.

The vocabulary is the words with a share of ``WORD_SHARE`` of all texts' words, which bounds it (counts cover all
pages), and the editor's size with it. Words are edited once per worker. Between tasks only keys and numbers move.
"""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm import encoding
from foliant.llm.canon import canonical
from foliant.session import materialise

# What scanners read (second) for a letter (first).
MISREADS = [
    ("h", "li"), ("n", "ri"), ("m", "rn"), ("u", "ii"), ("g", "q"), ("g", "9"), ("i", "l"), ("i", "!"), ("i", "1"), ("l", "1"),
    ("l", "I"), ("o", "0"), ("e", "c"), ("s", "5"), ("b", "8"), ("d", "cl"), ("n", "^"), ("a", "@"), ("t", "f"), ("t", "+"),
    ("b", "6"), ("ậ", "$"), ("ọ", "9"), ("á", "ci"), ("à", "ä"), ("é", "ê)"), ("z", "2"), ("y", "v"), ("r", "i"), ("w", "vv"),
]
# Several letters (first) that are read as one (second), and letters thin enough to be missed.
MERGED = [
    ("rn", "m"), ("li", "h"), ("ri", "n"), ("cl", "d"), ("ii", "u"), ("vv", "w"), ("ci", "a"), ("nn", "m"),
]
DROPPED = "ilt"
#: Fewest times a word of the vocabulary must occur, and as a share of all words.
WORD_LEAST, WORD_SHARE = 3, 5e-6
#: A word is a misreading itself if its correction is so many times as frequent; accents alone need more.
TIMES, TIMES_ACCENT = 40, 200
#: Misread words that make a page noisy.
SEVERAL = 2
#: Unknown words that are nothing misread, for each that is: with more of them the page is no scan but nonsense.
STRANGERS = 3
#: Most words the editor is trained on, and most pages the judge of lines is (so many lines of each of their edges).
TRAINED_WORDS, TRAINED_PAGES, TAUGHT, EPOCHS = 3000, 1500, 6, 3

MARK = "-­¬‐‑"
CUT = re.compile(rf"[{MARK}][ \t]*\r?\n\s*")
RIGHT = re.compile(r"[^\W\d_]+")
STRIP = ".,;:?()[]\"“”‘’'«»…|/*_–—- "
WORD, TOKEN = re.compile(r"[^\s|/]+"), re.compile(r"\S+")
CODE = re.compile(r"\W*[A-Z]{1,4}-?\d+\W*$")
LETTER = re.compile(r"[^\W\d_]")


def _accents(ch: str) -> list[str]:
    """What is left of a letter when a scanner misses one of its marks, or shifts the tone."""
    parts = unicodedata.normalize("NFD", ch)
    out = {unicodedata.normalize("NFC", parts[:i] + parts[i + 1 :]) for i in range(1, len(parts))}
    if ch in "àèìòù":
        out |= {unicodedata.normalize("NFC", parts[0] + m) for m in "́̈̉"}
    return sorted(out - {ch})


def _confusions() -> dict[str, list[str]]:
    out: dict[str, list[str]] = defaultdict(list)
    for true, seen in MISREADS:
        out[true].append(seen)
    for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        ch = chr(c)
        if ch.islower() and unicodedata.decomposition(ch):
            out[ch] += _accents(ch)
    return dict(out)


CONFUSIONS = _confusions()


#: What the editor sees of a character: stretches (start, end) of the word around it, from two before to two behind.
WINDOWS = [(2, 3), (1, 3), (2, 4), (1, 4), (0, 3), (2, 5), (0, 4), (1, 5)]
Weights = dict[str, dict[str, float]]


class Averaged:
    """Weights of an averaged perceptron, by feature and label."""

    def __init__(self, kinds: int) -> None:
        self.weights: list[Weights] = [{} for _ in range(kinds)]
        self._total: list[Weights] = [{} for _ in range(kinds)]
        self._step = 1

    def scores(self, feats: list[str]) -> dict[str, float]:
        out: dict[str, float] = {}
        for known, f in zip(self.weights, feats):
            for label, v in known.get(f, {}).items():
                out[label] = out.get(label, 0.0) + v
        return out

    def learn(self, feats: list[str], right: str, wrong: str) -> None:
        for n, f in enumerate(feats):
            now, total = self.weights[n].setdefault(f, {}), self._total[n].setdefault(f, {})
            for label, by in ((right, 1.0), (wrong, -1.0)):
                now[label] = now.get(label, 0.0) + by
                total[label] = total.get(label, 0.0) + by * self._step

    def step(self) -> None:
        self._step += 1

    def average(self) -> None:
        for known, total in zip(self.weights, self._total, strict=True):
            for f, by in list(known.items()):
                known[f] = {label: x for label, v in by.items() if (x := v - total[f][label] / self._step)}
                if not known[f]:
                    del known[f]
        self._total = [{} for _ in self.weights]


class Editor:
    """An averaged perceptron over characters; its labels are what is written for a character: "" deletes it, several put letters in."""

    def __init__(self) -> None:
        self.model = Averaged(len(WINDOWS))
        self.labels: dict[str, list[str]] = {}
        self.longer: Editor | None = None

    @staticmethod
    def features(padded: str, i: int) -> list[str]:
        return [padded[i + a : i + b] for a, b in WINDOWS]

    def best(self, padded: str, i: int) -> str:
        """The label of character ``i`` of a word that stands in ^^ and $$."""
        ch = padded[i + 2]
        options = self.labels.get(ch)
        if not options:
            return ch
        scores = self.model.scores(self.features(padded, i))
        top, out = scores.get(ch, 0.0), ch
        for label in options:
            if (s := scores.get(label, 0.0)) > top and label != ch:
                top, out = s, label
        return out

    def edit(self, word: str) -> str:
        padded = f"^^{word}$$"
        return "".join(self.best(padded, i) for i in range(len(word)))

    def train(self, pairs: list[list[tuple[str, str]]], epochs: int) -> None:
        """``pairs``: words as (seen character, what to write) sequences."""
        seen: dict[str, set[str]] = defaultdict(set)
        for word in pairs:
            for ch, label in word:
                seen[ch].add(label)
        self.labels = {ch: sorted(x) for ch, x in seen.items() if x != {ch}}
        rng = random.Random(7)
        for _ in range(epochs):
            rng.shuffle(pairs)
            for word in pairs:
                padded = "^^" + "".join(ch for ch, _ in word) + "$$"
                for i, (_, label) in enumerate(word):
                    if (got := self.best(padded, i)) != label:
                        self.model.learn(self.features(padded, i), label, got)
                self.model.step()
        self.model.average()


def _spoil(word: str, rng: random.Random, rate: float) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for ch in word:
        seen = CONFUSIONS.get(ch)
        if seen and rng.random() < rate:
            s = rng.choice(seen)
            out += [(s[0], ch), *((x, "") for x in s[1:])]
        else:
            out.append((ch, ch))
    return out


JOINED = dict(MERGED)


def _short(word: str) -> Iterator[list[tuple[str, str]]]:
    """The word with two letters read as one, or a thin one missed inside it, at each place where they can be."""
    for i in range(len(word) - 1):
        two = word[i : i + 2]
        seen = [JOINED[two]] if two in JOINED else []
        if i and two[0] in DROPPED and len(word) > 4:
            # A missed letter is put before the next.
            seen.append(two[1])
        for s in seen:
            yield [*((c, c) for c in word[:i]), (s, two), *((c, c) for c in word[i + 2 :])]


def _cuts(word: str, rng: random.Random) -> list[tuple[str, str]]:
    """A word cut at a line end: the mark and the end are deleted, which joins the lines."""
    k = rng.randrange(1, len(word))
    return [*((c, c) for c in word[:k]), ("-", ""), ("\n", ""), *((c, c) for c in word[k:])]


class _Bases(dict):
    """A translation table from letters to their base letters that fills itself."""

    def __missing__(self, c: int) -> str:
        self[c] = out = "".join(x for x in unicodedata.normalize("NFD", chr(c)) if not unicodedata.combining(x))
        return out


_BASES = _Bases()


def _base(word: str) -> str:
    return word.translate(_BASES)


def vocabulary(counts: dict[str, int]) -> dict[str, int]:
    """The words that aren't misreadings of far more frequent ones: of a like shape, that is."""
    alike: dict[str, list[str]] = defaultdict(list)
    for word in counts:
        alike[shape(word)].append(word)
    out = {}
    for group in alike.values():
        for word in group:
            if not any(counts[c] >= counts[word] * (TIMES_ACCENT if _base(c) == _base(word) else TIMES) for c in group):
                out[word] = counts[word]
    return out


def trained(words: dict[str, int]) -> Editor:
    rng = random.Random(11)
    common = sorted(words, key=lambda w: (-words[w], w))[:TRAINED_WORDS]
    pairs: list[list[tuple[str, str]]] = []
    for n, w in enumerate(common):
        pairs.append([(c, c) for c in w])
        pairs += [_spoil(w, rng, 0.35), _spoil(w, rng, 0.6)]
        if len(w) > 3:
            pairs.append(_cuts(w, rng))
        # Two words around a mark at a line end are no cut word: it is part of the compound.
        other = common[rng.randrange(len(common))]
        if len(w) > 1 and len(other) > 1 and n % 2:
            pairs.append([*((c, c) for c in w), ("-", "-"), ("\n", ""), *((c, c) for c in other)])
    editor = Editor()
    editor.train(pairs, EPOCHS)
    # Letters are put in by an editor of its own: both kinds of misreading in one would blur each other.
    editor.longer = Editor()
    editor.longer.train([x for w in common for x in ([(c, c) for c in w], *_short(w))], EPOCHS)
    return editor


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """``word, n`` over all different texts: letters only, without case, in canonical form; partial counts per task.

    Copies of a text count once, so that no misreading is common by them. They are put together in each task first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for said in batch.column(0).to_pylist():
                counts.update(said.split())
            if len(counts) > 300_000:
                yield _counted(counts)
                counts = Counter()
        yield _counted(counts)

    return df.where(F.length(text) > 0).select(text).distinct().mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(tokens: Counter[str]) -> pa.RecordBatch:
    """The words in what stands between blanks, each such token looked at once."""
    counts: Counter[str] = Counter()
    for token, n in tokens.items():
        for word in RIGHT.findall(canonical(token).lower()):
            if not encoding._SUSPECT.search(word) and not encoding._MISPLACED.search(word):
                counts[word] += n
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def _model(df: DataFrame, text: str) -> tuple[dict[str, int], Editor]:
    counts = materialise(word_counts(df, text), "words")
    least = max(WORD_LEAST, WORD_SHARE * (counts.agg(F.sum("n")).first()[0] or 0))
    # So large a share bounds the list: 1 / WORD_SHARE words at most.
    words = vocabulary({r.word: r.n for r in counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").collect()})
    return words, trained(words)


def _judge(df: DataFrame, text: str, version: str, page: str) -> Judge:
    """A judge of lines, trained on TRAINED_PAGES pages at most: whole versions, picked by their digest."""
    share = TRAINED_PAGES / max(1, df.count())
    rows = df.select(F.col(version).alias("v"), F.col(page).alias("p"), F.col(text).alias("t")).where(F.col("v").isNotNull() & F.col("p").isNotNull() & (F.length("t") > 0))
    picked = F.pmod(F.xxhash64(F.col("v").cast("string")), F.lit(1_000_000)) < F.lit(share * 1_000_000)
    judge = Judge()
    judge.train(judged_lines([(r.v, r.p, r.t) for r in rows.where(picked).limit(TRAINED_PAGES).collect()]))
    return judge


# --- a page -------------------------------------------------------------------------------------------------

HEADING = re.compile(r"^\W*(điều|chương|mục|phần|khoản|section|article|chapter|part|phụ lục|annexe|appendix)\b\W*[\divxlc#]+\b", re.I)
BODY = re.compile(r"^\s*(?:[-+*•·–]\s|\(?\d{1,3}[.)]\s|\(?[a-zđ]\)\s)|^\s*\|.*\||\t|\S {3,}\S.* {3,}\S|[_.…]{4,}\s*$|^\W*$|^[^:]{2,40}:\s*[_.…]*$|^\s*(?:stt|tt|no\.?|n°)\b|^[^;]*;[^;]*;[^;]*$", re.I)
BARE = re.compile(r"\W*$")
NUMBER = re.compile(
    r"^\W{0,3}(?P<word>trang|page|tr|p|pg|trg|số trang|tờ)?[.:\s]*\W{0,2}(?P<n>[\dlIoO!]{1,4}|[ivxlc]{1,9})\s*(?P<of>(?:[/|]|of|sur|trên|trong|de)\s*(?P<m>[\dlIoO!]{1,4}))?\W{0,3}$", re.I
)
MIRROR = str.maketrans("([{<«", ")]}>»")
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
ALIKE = {"l": "i", "1": "i", "!": "i", "j": "i", "0": "o", "9": "g", "q": "g", "5": "s", "^": "n", "@": "a", "8": "b", "6": "b", "$": "a", "f": "t", "+": "t", "c": "e", "v": "y", "h": "ii"}


def _roman(word: str) -> int | None:
    values = [ROMAN[c] for c in word.lower()]
    n = sum(-a if a < b else a for a, b in zip(values, [*values[1:], 0], strict=True))
    good = ""
    for v, s in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        while n >= v:
            good, n = good + s, n - v
    return sum(-a if a < b else a for a, b in zip(values, [*values[1:], 0], strict=True)) if good == word.lower() else None


def page_number(line: str) -> tuple[str, int] | None:
    """The style and number of a line that may be a page's number."""
    m = NUMBER.match(line.strip())
    if not m:
        return None
    said = m["n"]
    # A frame is the same on both sides; what stands on one side only belongs to a sentence.
    before, after = re.match(r"\W*", line.strip())[0].strip(), re.search(r"\W*$", line.strip())[0].strip()
    if before.translate(MIRROR) != after[::-1] and not (m["word"] and after in ("", ".")):
        return None
    if re.fullmatch(r"[\dlIoO!]+", said) and re.search(r"\d", said) or said.isdigit():
        n = int(said.translate(str.maketrans("lI!oO", "11100")))
    elif re.fullmatch(r"[ivxlc]+", said, re.I) and (r := _roman(said)):
        return ("word" if m["word"] else "roman"), r
    else:
        return None
    if m["word"] or m["of"] and re.search("[a-z]", m["of"], re.I):
        return "word", n
    if m["of"]:
        return "of", n
    return ("bare" if said == line.strip() else "framed"), n


class _Shapes(dict):
    """A translation table to base letters, those that scanners confuse as one; signs go, blanks and # stay."""

    def __missing__(self, c: int) -> str:
        base = "".join(x for x in unicodedata.normalize("NFD", chr(c).lower().replace("đ", "d")) if not unicodedata.combining(x))
        self[c] = out = "".join(ALIKE.get(x, x if x.isalpha() or x in " #" else "") for x in base)
        return out


_SHAPES = _Shapes()
NUMERAL = re.compile(r"(?<![^\W_])(?:\d[\d.,:/-]*|[^\W\d_]*\d[^\W\d_]*\d\w*)(?![^\W_])|(?<![^\W_])[ivxlc]+$")


def shape(line: str) -> str:
    """A line's wording without numbers, accents and what scanners confuse."""
    said = NUMERAL.sub("#", line.lower()).translate(_SHAPES)
    return " ".join(said.replace("ii", "u").replace("rn", "m").replace("ri", "n").split())


#: VISCII makes a letter of every upper byte, so that fewer strange characters are no sign of it.
_PLAIN_CHAINS = [undo for name, undo in encoding.CHAINS.items() if name != "viscii_as_cp1252"]


def readable(line: str) -> str:
    """A line in canonical form, its encoding put right where a chain plainly does so; the line alone decides."""
    n = len(encoding._SUSPECT.findall(line)) + len(encoding._MISPLACED.findall(line))
    if not n:
        return canonical(line)
    best, out = n, line
    for undo in _PLAIN_CHAINS:
        said = undo(line)
        if said != line and (n := len(encoding._SUSPECT.findall(said)) + len(encoding._MISPLACED.findall(said))) < best:
            best, out = n, said
            if not n:
                break
    return canonical(out)


def _kind(ch: str) -> str:
    return "u" if ch.isupper() else "l" if ch.islower() else "d" if ch.isdigit() else ch if ch in ".,;:!?)-" else "s"


class Judge:
    """An averaged perceptron over a line's place and form: does it belong to the page's frame or to the body?"""

    KINDS = 11

    def __init__(self) -> None:
        self.model = Averaged(self.KINDS)
        # Without any line to learn from all are candidates; what recurs is counted exactly.
        self.least = {"header": float("-inf"), "number": float("-inf")}

    @staticmethod
    def features(line: str, side: str, depth: int, raw: list[str], at: int, filled: int, style: str) -> list[str]:
        """The place: side, depth from it, blank lines next to the line, size of the page. The form: length, signs, capitals."""
        inner, outer = (at + 1, at - 1) if side == "t" else (at - 1, at + 1)
        gap = "".join("b" if 0 <= k < len(raw) and not raw[k].strip() else "-" for k in (inner, outer))
        length, letters = min(len(line) // 8, 16), sum(map(str.isalpha, line))
        caps = sum(map(str.isupper, line)) * 4 // letters if letters else 9
        last, deep = _kind(line[-1]), min(depth, 5)
        form = "h" if HEADING.search(line) else "b" if BODY.search(line) else "-"
        return [f"{side}{deep}", str(length), f"{last}{length}", f"{_kind(line[0])}{last}", f"{caps}{length}", f"{gap}{side}{deep}", f"{form}{last}", f"{style}{deep}", f"{min(filled // 6, 6)}{side}{deep}", f"{form}{caps}", style]

    def margin(self, feats: list[str], label: str) -> float:
        scores = self.model.scores(feats)
        return scores.get(label, 0.0) - scores.get("body", 0.0)

    def framed(self, feats: list[str], label: str) -> bool:
        return self.margin(feats, label) >= self.least[label]

    def train(self, rows: list[tuple[list[str], str]]) -> None:
        rng = random.Random(13)
        labels = sorted({label for _, label in rows})
        for _ in range(EPOCHS):
            rng.shuffle(rows)
            for feats, label in rows:
                scores = self.model.scores(feats)
                got = max(labels, key=lambda x: scores.get(x, 0.0))
                if got != label:
                    self.model.learn(feats, label, got)
                self.model.step()
        self.model.average()
        for label in self.least:
            # Below every line that recurs in the training pages, by half their usual margin: the exact count decides.
            margins = [self.margin(feats, label) for feats, own in rows if own == label]
            if margins:
                self.least[label] = min(0.0, *margins) - 0.5 * sum(map(abs, margins)) / len(margins)


def _edges(raw: list[str]) -> Iterator[tuple[str, list[int]]]:
    """The filled lines of a page from its top and from its bottom."""
    filled = [n for n, x in enumerate(raw) if x and not x.isspace()]
    yield "t", filled
    yield "b", filled[:0:-1]


def judged_lines(pages: list[tuple[str, int, str]]) -> list[tuple[list[str], str]]:
    """Lines with labels (header, number, body) to train a judge on, of pages (version, number, text).

    What recurs labels itself: a line at the edge whose wording stands at the edge of three pages of its version is a
    header, unless it reads like a heading or a row of the body; a number that is its page's, or keeps its distance to
    it on two pages, is a page number.
    """
    seen: list[tuple] = []
    wordings: dict[tuple[str, str], set[int]] = defaultdict(set)
    ahead: dict[tuple[str, int], set[int]] = defaultdict(set)
    for version, page, text in pages:
        raw = text.split("\n")
        for side, order in _edges(raw):
            for depth, at in enumerate(order[:TAUGHT]):
                line = readable(raw[at].strip())
                if BARE.match(line):
                    continue
                number = page_number(line)
                key = None
                if number:
                    ahead[version, number[1] - page].add(page)
                elif not re.search(r"[.;,!?]$", line) and not HEADING.search(line) and not BODY.search(line) and len(key := shape(line)) >= 5:
                    wordings[version, key].add(page)
                else:
                    key = None
                seen.append((Judge.features(line, side, depth, raw, at, len(order), number[0] if number else "-"), version, page, key, number))
    out = []
    for feats, version, page, key, number in seen:
        if number:
            d = number[1] - page
            label = "number" if d == 0 or number[0] == "word" or len(ahead[version, d]) >= 2 else "body"
        else:
            label = "header" if key and len(wordings[version, key]) >= 3 else "body"
        out.append((feats, label))
    return out


class Reader:
    """Judges pages with a trained editor, a judge of lines and a vocabulary; words are judged once."""

    def __init__(self, words: dict[str, int], editor: Editor, judge: Judge | None = None):
        self.words, self.editor, self.judge = words, editor, judge or Judge()
        self.known: dict[str, str | None] = {}
        self.fine: set[str] = set()
        self.stays: set[str] = set()
        # No edit makes a word of more characters that stay than the longest word has.
        self.longest = max(map(len, words), default=0)
        self.deletable = str.maketrans("", "", "".join(ch for ch, labels in editor.labels.items() if "" in labels))

    def misread(self, token: str) -> str | None:
        """The right word if the token is a misread one."""
        if token in self.known:
            return self.known[token]
        if len(self.known) > 300_000:
            self.known.clear()
        self.known[token] = out = self._misread(token)
        return out

    def _misread(self, token: str) -> str | None:
        word = token.lower()
        for said in dict.fromkeys((word.strip(STRIP + "!"), word.strip(STRIP), word.strip(STRIP.replace(")", "")))):
            if len(said) < 3 or said in self.words or not LETTER.search(said):
                return None
        if CODE.match(token):
            return None
        for said in dict.fromkeys((word.strip(STRIP), word.strip(STRIP.replace(")", "")), word.strip(STRIP + "!"))):
            if len(said) > self.longest and len(said.translate(self.deletable)) > self.longest or sum(c.isdigit() for c in said) * 2 > len(said) or "@" in said[1:] and "." in said:
                continue
            # Compounds are judged part by part.
            if "-" in said and all(p in self.words or not LETTER.search(p) for p in said.split("-")):
                return None
            for right in self.readings(said):
                if right != said and right in self.words and (len(right) > 2 or not right.isascii()):
                    return right
        return None

    def mended(self, line: str) -> str:
        """The line with its misread words right. Most of what stands between blanks is known to stay as it is."""
        changed: dict[str, str] = {}
        for token in line.split():
            if token not in self.stays and token not in changed:
                if (new := WORD.sub(self._mended, token)) != token:
                    changed[token] = new
                else:
                    if len(self.stays) > 500_000:
                        self.stays.clear()
                    self.stays.add(token)
        return TOKEN.sub(lambda m: changed.get(m[0], m[0]), line) if changed else line

    def _mended(self, m: re.Match[str]) -> str:
        token = m[0]
        right = self.misread(canonical(token))
        if right is None:
            return token
        core = token.strip(STRIP)
        return token.replace(core, right.upper() if core.isupper() and len(core) > 1 else right.capitalize() if core[:1].isupper() else right, 1)

    def readings(self, said: str) -> Iterator[str]:
        """The word edited, with letters put in, and both; each is made only if those before it are no word."""
        yield (fixed := self.editor.edit(said))
        if self.editor.longer:
            yield self.editor.longer.edit(said)
            if fixed != said:
                yield self.editor.longer.edit(fixed)

    def cut_words(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, whole word) of each word cut at a line end; marks that belong to a compound are none."""
        out = []
        for m in CUT.finditer(text):
            start = m.start()
            while start and LETTER.match(text, start - 1):
                start -= 1
            before, after = text[start : m.start()], RIGHT.match(text, m.end())
            if not before or not after:
                continue
            left, right = canonical(before).lower(), canonical(after[0]).lower()
            if encoding._SUSPECT.search(left + right):
                continue
            whole = left + right
            if whole in self.words or m[0][0] in "­¬":
                good = True
            elif left in self.words and right in self.words:
                good = False
            else:
                good = "-" not in self.editor.edit(f"{left}-\n{right}") or self.misread(whole) is not None
            if good:
                out.append((start, after.end(), before + after[0]))
        return out

    def edge(self, raw: list[str], side: str, order: list[int]) -> Iterator[tuple[int, dict, tuple[str, int] | None, str | None]]:
        """Lines that may be running lines or page numbers, from the outside inward up to the first that can't be.

        The judge says which may be. Each has its place: whether it is of the first two, and how many lines with
        wording stand outside and inside. Signs alone (rules) are passed over.
        """
        outside, outer, open_ = 0, None, True
        worded = None
        for depth, n in enumerate(order):
            if depth >= 2 and not open_:
                return
            line = readable(raw[n].strip())
            if BARE.match(line):
                continue
            number = page_number(line)
            feats = Judge.features(line, side, depth, raw, n, len(order), number[0] if number else "-")
            if number and not self.judge.framed(feats, "number"):
                number = None
            key = None
            if not number and self.judge.framed(feats, "header"):
                # Numbers alone are no wording.
                key = made if any(map(str.isalpha, made := shape(line))) else None
            # Further in, a second number is the page's only if it is the same.
            if depth >= 2 and (not (number or key) or number and outer not in (None, number[1])):
                return
            if number or key:
                if worded is None:
                    worded = sum(not BARE.match(raw[k].strip()) for k in order)
                yield n, {"near": depth < 2, "outside": outside, "inside": worded - outside - 1}, number, key
            else:
                open_ = False
            if number and outer is None:
                outer = number[1]
            outside += 1

    def page(self, text: str) -> dict:
        raw = text.split("\n")
        strange = encoding._SUSPECT.search(text) or encoding._MISPLACED.search(text)
        body = "\n".join(map(readable, raw)) if strange else canonical(text)
        misread: set[str] = set()
        count = strangers = 0
        words = body.split()
        # Most words are ordinary and known to be so: they leave at once.
        for token in set(words) - self.fine:
            plain = True
            for part in WORD.findall(token):
                right = self.misread(part)
                if right is not None:
                    plain = False
                    count += words.count(token)
                    misread.add(part)
                elif LETTER.search(part) and not CODE.match(part) and part.strip(STRIP + "!").lower() not in self.words:
                    plain = False
                    strangers += 1
            if plain:
                if len(self.fine) > 500_000:
                    self.fine.clear()
                self.fine.add(token)
        marked = "\n".join(x if "­" in x or "¬" in x else readable(x) for x in raw) if strange else text
        edges, numbers = [], []
        for side, order in _edges(raw):
            for n, place, number, key in self.edge(raw, side, order):
                if number:
                    numbers.append({"line": n, "side": side, **place, "style": number[0], "n": number[1]})
                else:
                    edges.append({"line": n, "side": side, **place, "key": key})
        return {"hyphen": bool(self.cut_words(marked)), "n_misread": count, "n_forms": len(misread), "n_strange": strangers, "edges": edges, "numbers": numbers}


#: The worker's last reader, with the model it was made of: models are told apart by identity, so the model is kept.
_LAST: list[tuple] = []


def _reader(bound) -> Reader:
    """One reader per worker and broadcast model."""
    model = bound.value
    if not _LAST or _LAST[0][0] is not model:
        _LAST[:] = [(model, Reader(*model))]
    return _LAST[0][1]


PLACE = [T.StructField("line", T.IntegerType()), T.StructField("side", T.StringType()), T.StructField("near", T.BooleanType()), T.StructField("outside", T.IntegerType()), T.StructField("inside", T.IntegerType())]
SEEN = T.StructType(
    [
        T.StructField("hyphen", T.BooleanType()),
        T.StructField("n_misread", T.IntegerType()),
        T.StructField("n_forms", T.IntegerType()),
        T.StructField("n_strange", T.IntegerType()),
        T.StructField("edges", T.ArrayType(T.StructType([*PLACE, T.StructField("key", T.StringType())]))),
        T.StructField("numbers", T.ArrayType(T.StructType([*PLACE, T.StructField("style", T.StringType()), T.StructField("n", T.IntegerType())]))),
    ]
)


def examined(df: DataFrame, bound, key: str, text: str, version: str, page: str) -> DataFrame:
    """``id, version, page`` and what ``SEEN`` lists, for each row with a text."""
    rows = df.where(F.length(text) > 0).select(F.col(key).alias("id"), F.col(version).alias("version"), F.col(page).alias("page"), F.col(text).alias("text"))
    schema = T.StructType([*rows.schema.fields[:3], *SEEN.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(bound)
        place = [("line", pa.int32()), ("side", pa.string()), ("near", pa.bool_()), ("outside", pa.int32()), ("inside", pa.int32())]
        kinds = [pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.struct([*place, ("key", pa.string())])), pa.list_(pa.struct([*place, ("style", pa.string()), ("n", pa.int32())]))]
        for batch in batches:
            found = [reader.page(x) for x in batch.column(3).to_pylist()]
            columns = [pa.array([f[n] for f in found], k) for n, k in zip(SEEN.fieldNames(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], schema.fieldNames())

    return rows.mapInArrow(run, schema)


def _running(edges: DataFrame) -> DataFrame:
    """``version, key`` of the wordings on three or more pages of a version."""
    # Distinct pages first, so that a version with very many rows is counted in parts.
    edges = edges.where("version IS NOT NULL AND page IS NOT NULL")
    return edges.select("version", "key", "page").distinct().groupBy("version", "key").agg(F.count("*").alias("n")).where("n >= 3").select("version", "key")


def _own(numbers: DataFrame) -> DataFrame:
    """The numbers that are their page's."""
    numbers = numbers.withColumn("ahead", F.col("n") - F.col("page"))
    steady = numbers.where("version IS NOT NULL AND page IS NOT NULL").select("version", "ahead", "page").distinct().groupBy("version", "ahead").agg(F.count("*").alias("pages"))
    own = (F.col("style") == "word") | (F.col("ahead") == 0) | (F.coalesce("pages", F.lit(0)) >= 2) | F.col("style").isin("framed", "roman", "of")
    return numbers.join(steady, ["version", "ahead"], "left").where(own).drop("ahead", "pages")


def _furniture(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, line`` of the running lines, and of the page numbers.

    A line stands at the edge if it is one of the two outermost, or if all lines outside it recur or are numbers.
    """
    placed = ["id", "version", "page", "line", "side", "near", "outside", "inside", "key", "style", "n"]
    edges = seen.select("id", "version", "page", F.explode("edges").alias("e")).select("id", "version", "page", "e.*")
    numbers = seen.select("id", "version", "page", F.explode("numbers").alias("e")).select("id", "version", "page", "e.*")
    found = edges.join(_running(edges), ["version", "key"], "left_semi").unionByName(_own(numbers), allowMissingColumns=True)
    # A row per line that may be furniture; a page's are few. Where they leave no line inside, they are a body that recurs.
    outer = "collect_set(outside) OVER (PARTITION BY id, side ORDER BY outside RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    found = found.withColumn("open", F.expr(f"size({outer}) = outside")).withColumn("left", F.expr("min(if(open, inside, null)) OVER (PARTITION BY id, side)"))
    found = materialise(found.where("near OR open AND left > 0").select(placed), "edges")
    edges, numbers = found.where("key IS NOT NULL"), found.where("n IS NOT NULL")
    return edges.join(_running(edges), ["version", "key"], "left_semi").select("id", "line"), _own(numbers).select("id", "line")


def prepared(df: DataFrame, key: str, text: str, version: str, page: str):
    """The broadcast model (its size is bounded by WORD_SHARE) and what was seen on each page."""
    words, editor = _model(df, text)
    bound = df.sparkSession.sparkContext.broadcast((words, editor, _judge(df, text, version, page)))
    return bound, materialise(examined(df, bound, key, text, version, page), "pages")


def noise(df: DataFrame, key: str = "page_id", text: str = "raw_text", version: str = "version_id", page: str = "page_no") -> DataFrame:
    """``key, noise``: one row per row of ``df`` and kind of noise in it: hyphen, chars, header, pageno.

    Null and empty texts have none. Rows without a version or page have no running lines.
    """
    _, seen = prepared(df, key, text, version, page)
    headers, numbers = _furniture(seen)
    on_page = seen.select("id", F.explode(F.array_compact(F.array(F.when(F.col("hyphen"), "hyphen"), F.when((F.col("n_misread") >= SEVERAL) & (F.col("n_forms") >= 2) & (F.col("n_strange") <= STRANGERS * F.col("n_misread")), "chars")))).alias("noise"))
    return (
        on_page.unionByName(headers.select("id", F.lit("header").alias("noise")).distinct())
        .unionByName(numbers.select("id", F.lit("pageno").alias("noise")).distinct())
        .withColumnRenamed("id", key)
    )


ITEM = re.compile(r"^\s*(?:[-+*•·–]\s|\(?\d{1,3}[.)]\s|\(?[a-zđ]\)\s|\||#)")


def tidy(text: str, furniture: set[int], reader: Reader) -> str:
    """Paragraphs of a page: no running lines, words whole, misread words right, lines joined."""
    lines = [x for n, x in enumerate(re.split(r"\r?\n", text)) if n not in furniture]
    text = "\n".join(lines)
    for start, end, whole in reversed(reader.cut_words(text)):
        text = text[:start] + whole + text[end:]

    out: list[str] = []
    for raw in text.split("\n"):
        line = reader.mended(raw.strip())
        if not line:
            out.append("")
        elif out and out[-1] and not ITEM.search(line) and not HEADING.search(line) and not HEADING.search(out[-1]) and "\t" not in line and "   " not in line and not re.search(r"[.!?:;]$", out[-1]):
            out[-1] += " " + line
        elif out and out[-1] and (line[:1].islower() and not ITEM.search(line)):
            out[-1] += " " + line
        else:
            out.append(line)
    return re.sub(r"\n{2,}", "\n\n", "\n".join(out)).strip("\n")


def clean_pages(df: DataFrame, key: str = "page_id", text: str = "raw_text", version: str = "version_id", page: str = "page_no") -> DataFrame:
    """``key, text``: every row's text as continuous paragraphs; null stays null, "" stays ""."""
    bound, seen = prepared(df, key, text, version, page)
    headers, numbers = _furniture(seen)
    gone = headers.unionByName(numbers).groupBy("id").agg(F.collect_set("line").alias("gone"))
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("text")).join(gone, "id", "left")
    kind = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(bound)
        for batch in batches:
            texts = [x and tidy(x, set(g or ()), reader) for x, g in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    return rows.select("id", "text", "gone").mapInArrow(run, T.StructType([T.StructField(key, kind), T.StructField("text", T.StringType())]))
