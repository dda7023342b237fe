"""Byte-level BPE over a corpus (problem 6).

Encoding is exact without running merges: an Aho-Corasick automaton gives, for each byte position, the
vocabulary entries that start there; the encoder walks left to right with the longest entry and keeps it only
if the pair with the entry before it is compatible, that is, if merging the two texts by rank could not have
joined characters across their border. Where no entry fits it steps back and takes the next shorter one; a bit
per position keeps it from trying a dead end twice, so the work is linear in the bytes.

Decoding gathers byte ranges from one flat table by an offset table.

The vocabulary is a file every executor can read; its folder is a parameter.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZERS = os.environ.get("FOLIANT_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"

# Fixed value: the split pattern of this vocabulary's pre-tokenizer.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: Words with their leading space, and runs of white space: unions of whole pieces of SPLIT. Python counts
#: U+001C to U+001F as white space, Unicode's property doesn't.
COARSE = re.compile(r" ?[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+(?![\S\x1c-\x1f])|[^\S\x1c-\x1f]+")

#: Distinct words kept per worker with their ids; beyond it the table starts anew. It bounds memory only.
KEPT = 400_000


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for n, b in enumerate(x for x in range(256) if x not in set(plain)):
        out[chr(256 + n)] = b
    return out


class Encoder:
    """One vocabulary, loaded once per worker process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = _byte_letters()
        size = max(model["vocab"].values()) + 1
        self.bytes: list[bytes] = [b""] * size
        ids: dict[bytes, int] = {}
        for text, i in model["vocab"].items():
            if all(ch in letters for ch in text):
                b = bytes(letters[ch] for ch in text)
                self.bytes[i] = b
                ids[b] = i
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        self.split: list[tuple[int, int]] = [(i, i) for i in range(size)]
        at: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (ids[bytes(letters[ch] for ch in x)] for x in (left, right))
            whole = ids[self.bytes[a] + self.bytes[b]]
            self.rank.setdefault((a, b), rank)
            if whole not in at:
                at[whole] = rank
                self.split[whole] = (a, b)
        # Order of making: single bytes before all merges.
        self.order = [-1] * size
        for i, r in at.items():
            self.order[i] = r
        self.trie = ahocorasick.Automaton()
        for b, i in ids.items():
            if len(b) == 1 or i in at:
                self.trie.add_word(b.decode("latin-1"), (i, len(b)))
        self.trie.make_automaton()
        lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.flat = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self._fits: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.code: dict[str, int] = {}
        self.starts: list[int] = [0]
        self.store: list[int] = []
        self._arrays = None

    def fits(self, left: int, right: int) -> bool:
        """Would merging by rank leave the border between these two entries alone?"""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            known = self._fits[left, right] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        # Undo merges beside the border from the latest to the earliest; at each moment the two entries that
        # touch it must not merge earlier than the merge that, in truth, used one of them up.
        until = 1 << 60
        while True:
            joined = self.rank.get((left, right))
            if joined is not None and joined < until:
                return False
            a, b = self.order[left], self.order[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                until, left = a, self.split[left][1]
            else:
                # Of equal ranks the left one is applied first, so here an equal rank at the border counts too.
                until, right = b + 1, self.split[right][0]

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        n = len(piece)
        options: list[list[int]] = [[] for _ in range(n)]
        for end, (i, length) in self.trie.iter(piece.decode("latin-1")):
            options[end - length + 1].append(i)
        if n > 1 and len(self.bytes[options[0][-1]]) == n:
            return [options[0][-1]]
        out: list[int] = []
        tried: list[int] = []
        dead = bytearray(n + 1)
        pos, k = 0, len(options[0]) - 1
        while pos < n:
            row = options[pos]
            while k >= 0:
                i = row[k]
                if not dead[pos + len(self.bytes[i])] and (not out or self.fits(out[-1], i)):
                    break
                k -= 1
            if k >= 0:
                out.append(i)
                tried.append(k)
                pos += len(self.bytes[i])
                k = len(options[pos]) - 1 if pos < n else -1
            else:
                dead[pos] = 1
                pos -= len(self.bytes[out.pop()])
                k = tried.pop() - 1
        return out

    def word(self, text: str) -> int:
        """The code of a coarse word; new ones are encoded and added to the store."""
        for part in SPLIT.findall(text):
            self.store += self.piece(part.encode("utf-8", "surrogatepass"))
        code = self.code[text] = len(self.starts) - 1
        self.starts.append(len(self.store))
        self._arrays = None
        return code

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's ids start."""
        if len(self.code) > KEPT:
            self._reset()
        codes: list[int] = []
        ends = [0]
        for text in texts:
            if text:
                words = COARSE.findall(text)
                try:
                    codes += map(self.code.__getitem__, words)
                except KeyError:
                    del codes[ends[-1] :]
                    known = self.code.get
                    for w in words:
                        c = known(w)
                        codes.append(self.word(w) if c is None else c)
            ends.append(len(codes))
        if self._arrays is None:
            self._arrays = np.array(self.starts, dtype=np.int64), np.array(self.store, dtype=np.int32)
        starts, store = self._arrays
        return gather(store, starts, np.array(codes, dtype=np.int64), np.array(ends, dtype=np.int64))

    def decode(self, ids: np.ndarray) -> str:
        data, _ = gather(self.flat, self.offsets, ids.astype(np.int64), np.array([0, len(ids)]))
        return data.tobytes().decode("utf-8", "surrogatepass")


def gather(flat: np.ndarray, offsets: np.ndarray, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joins the ranges of ``flat`` that ``codes`` name; ``ends`` cuts codes into rows, the result's are returned."""
    lengths = offsets[codes + 1] - offsets[codes]
    total = np.concatenate([[0], np.cumsum(lengths)])
    index = np.arange(total[-1], dtype=np.int64) + np.repeat(offsets[codes] - total[:-1], lengths)
    return flat[index], total[ends]


_LOADED: dict[str, Encoder] = {}


def encoder(folder: str = TOKENIZERS, name: str = VOCABULARY) -> Encoder:
    path = os.path.join(folder, name)
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def token_ids(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """``key`` and ``ids``, one row for each row of ``df``, without special tokens.

    Null and empty texts give an empty list; a null key stays null; repeated rows give repeated rows; strings
    of special tokens inside a text are ordinary text; other columns, whatever their names, are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for batch in batches:
            texts = batch.column(1)
            # A few MB of text at a time: ids take several times the room of the text.
            for lo, hi in _slices(texts):
                ids, ends = enc.encode(texts.slice(lo, hi - lo).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, type=pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], [key, "ids"])

    kind = df.schema[key].dataType
    slim = df.select(F.col(key), F.col(text))
    return slim.mapInArrow(run, T.StructType([T.StructField(key, kind), T.StructField("ids", T.ArrayType(T.IntegerType(), False))]))


def token_counts(df: DataFrame, text: str = "text", count: str = "n_tokens", folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """``df`` without ``text``, with its number of tokens; 0 for null and empty texts."""
    rest = [f for f in df.schema.fields if f.name not in (text, count)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for batch in batches:
            texts = batch.column(len(rest))
            for lo, hi in _slices(texts):
                _, ends = enc.encode(texts.slice(lo, hi - lo).to_pylist())
                own = [batch.column(i).slice(lo, hi - lo) for i in range(len(rest))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(ends))], [*(f.name for f in rest), count])

    schema = T.StructType([*rest, T.StructField(count, T.LongType())])
    return df.select(*(F.col(f"`{f.name}`") for f in rest), F.col(text)).mapInArrow(run, schema)


def token_text(df: DataFrame, key: str = "doc_id", ids: str = "ids", folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """``key`` and ``text``: the texts that ``ids`` stand for; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for batch in batches:
            texts = [None if x is None else enc.decode(np.array(x, dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], [key, "text"])

    kind = df.schema[key].dataType
    return df.select(key, ids).mapInArrow(run, T.StructType([T.StructField(key, kind), T.StructField("text", T.StringType())]))


def _slices(texts: pa.Array, rows: int = 2000, size: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Cuts a batch into row ranges of about ``size`` bytes at most; one long text is a range of its own."""
    lo, used = 0, 0
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        if i > lo and (used + n > size or i - lo >= rows):
            yield lo, i
            lo, used = i, 0
        used += int(n)
    if lo < len(texts):
        yield lo, len(texts)
