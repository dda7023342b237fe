"""A letter-pair model of the corpus, shared by the operators that judge how natural a text is.

Characters fall into at most ``SIZE`` classes (letters without case, digits together, the usual marks, the rest),
so the counts of all pairs, over all texts, are a table of a fixed size: it can be summed in Spark, brought to the
driver and sent to every task, whatever the corpus.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOWELS = "aăâeêioôơuưy"
TONES = ["", "̀", "́", "̉", "̃", "̣"]
VIETNAMESE = [unicodedata.normalize("NFC", v + t) for v in VOWELS for t in TONES] + list("bcdđghklmnpqrstvx")
OTHERS = list("fjwzçœëïüûî")
MARKS = list(".,;:!?()[]/-–—…’‘“”'\"|_%&@+*#<>=•\t\n °$")


def _classes() -> tuple[np.ndarray, int]:
    names = [*dict.fromkeys([*VIETNAMESE, *OTHERS, *MARKS])]
    table = np.full(0x10001, len(names) + 2, dtype=np.int64)
    for c in range(0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        if chr(c).isalpha():
            table[c] = len(names) + 1
    for i, ch in enumerate(names):
        for form in {ch, ch.upper(), ch.lower()}:
            if len(form) == 1:
                table[ord(form)] = i
    for ch in "0123456789":
        table[ord(ch)] = len(names)
    table[0xA0] = table[ord(" ")]
    # The sign of a lost character is a class of its own, the last one.
    table[0xFFFD] = len(names) + 3
    return table, len(names) + 4


CLASSES, SIZE = _classes()
KNOWN = "".join(sorted({ch for c in range(0x10000) if CLASSES[c] < SIZE - 3 and (ch := chr(c))}))


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return CLASSES[np.minimum(points, 0x10000)]


def pair_counts(df: DataFrame, text: str, strange: Callable[[str], bool] = lambda said: False) -> np.ndarray:
    """How often each class follows each class, over all texts of ``df`` that aren't strange.

    The result has at most SIZE x SIZE numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE * SIZE, dtype=np.int64)
        for batch in batches:
            held: list[str] = []
            size = 0
            for said in batch.column(0).to_pylist():
                if strange(said):
                    continue
                held.append(said)
                size += len(said)
                if size > 1_000_000:
                    total += _pairs("\n".join(held))
                    held, size = [], 0
            if held:
                total += _pairs("\n".join(held))
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    counted = df.where(F.col(text).isNotNull()).select(text).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(SIZE * SIZE)
    for row in counted.toLocalIterator():  # at most SIZE x SIZE rows
        out[row.pair] = row.n
    return out.reshape(SIZE, SIZE)


def _pairs(text: str) -> np.ndarray:
    c = codes("\n" + text + "\n")
    return np.bincount(c[:-1] * SIZE + c[1:], minlength=SIZE * SIZE)


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(class | class before), smoothed by how common a class is and by a floor for the unseen."""
    single = counts.sum(0) + 0.01
    single = single / single.sum()
    joint = counts + 2.0 * single[None, :]
    out = np.log(np.maximum(joint / joint.sum(1, keepdims=True), 1e-6))
    # A lost character may be any: it costs nothing here, and what follows it is judged by itself.
    out[SIZE - 1, :], out[:, SIZE - 1] = np.log(np.maximum(single, 1e-6)), 0.0
    return out.ravel()


def scores(texts: list[str], model: np.ndarray) -> np.ndarray:
    """The log probability of each text, read as a line."""
    if not texts:
        return np.zeros(0)
    c = codes("\n" + "\n".join(texts) + "\n")
    each = model[c[:-1] * SIZE + c[1:]]
    ends = np.cumsum(np.array([len(t) + 1 for t in texts]))
    total = np.concatenate([[0.0], np.cumsum(each)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])]
