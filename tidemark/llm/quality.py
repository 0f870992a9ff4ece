"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Two kinds of n-grams are hashed into one weight vector of a fixed size: one and two words as
written (lower case), and one to three word *forms*. A form keeps what kind of characters a word
has, in order and without repeats ("Then," is "Aa,", "THEN!!" is "A!"), and whether the word
repeats the one before; so the model also judges words that training has not seen.

Defined cases: null text counts as empty; an empty text has only the bias as feature; very long
texts are scored whole; equal texts get equal scores; with no usable label the score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tidemark.llm.common import labelled_sample, with_columns

BITS = 18  # 262,144 weights: 1 MB, whatever the size of the corpus
SAMPLE_ROWS = 8192  # bound of the labelled rows a model is fitted on
THRESHOLD = 0.3
EPOCHS = 3
_CACHE_WORDS = 300_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SALTS = [np.uint64(s) for s in (0x1D8E4E27C47D124F, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D,
                                 0x6C62272E07BB0142, 0x369DEA0F31A53F85)]


def word_form(word: str) -> str:
    """Kinds of characters in order, without repeats: A upper, a other letter, 0 digit, or itself.

    The first case is a short cut of the loop for most words; both give the same form.
    """
    if word.islower() and word.isalpha():
        return "a"
    form, last = [], ""
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if kind != last:
            form.append(kind)
            last = kind
    return "".join(form)[:24]


class _Words(dict):
    """Two 32-bit hashes of a word in one number: of its form above, of its lower case below."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        form = xxhash.xxh32_intdigest(word_form(word)) >> 1
        value = form << 32 | xxhash.xxh32_intdigest(word.lower())
        self[word] = value
        return value


_WORDS = _Words()


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, number of features by row) of a list of texts; repeats are kept."""
    split = [(t or "").split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    total = int(counts.sum())
    both = np.fromiter((_WORDS[w] for words in split for w in words), np.int64, total)
    both = both.view(np.uint64)
    row = np.repeat(np.arange(len(split)), counts)
    word, form = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
    if total:
        same = np.zeros(total, bool)
        same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
        form = form * np.uint64(2) + same
    shift = np.uint64(64 - BITS)

    def hashed(values: np.ndarray, salt: int) -> np.ndarray:
        mixed = (values ^ _SALTS[salt]) * _MIX
        return ((mixed ^ (mixed >> np.uint64(29))) * _MIX) >> shift

    rows, out = [np.arange(len(split)), row, row], [
        np.zeros(len(split), np.uint64), hashed(word, 0), hashed(form, 1)]
    for salt, base, n in ((2, word, 2), (3, form, 2), (4, form, 3)):
        if total >= n:
            joined = base[: total - n + 1]
            for k in range(1, n):
                joined = joined * _MIX + base[k : total - n + 1 + k]
            inside = row[: total - n + 1] == row[n - 1 :]
            rows.append(row[: total - n + 1][inside])
            out.append(hashed(joined[inside], salt))
    rows, ids = np.concatenate(rows), np.concatenate(out).astype(np.int64)
    return rows, ids, np.bincount(rows, minlength=len(split))


@dataclass
class Ftrl:
    """Per-coordinate FTRL-proximal state of a logistic regression."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1

    def __post_init__(self) -> None:
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)

    def weights(self, ids: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, ids: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(ids)
        g = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
        n = self.n[ids]
        self.z[ids] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[ids] += g * g


def train(sample: list[tuple[int, str, int]]) -> np.ndarray:
    """Weights after passes over (id, text, label) in an order that depends on the rows only."""
    sample = sorted(sample, key=lambda r: (xxhash.xxh64_intdigest(str(r[0])), r[1]))
    examples = []
    for _, text, label in sample:
        _, ids, count = features([text])
        ids, times = np.unique(ids, return_counts=True)
        examples.append((ids.astype(np.int32), (times / np.sqrt(count[0])).astype(np.float32),
                         int(label > 0)))
    model = Ftrl()
    for _ in range(EPOCHS):
        for ids, values, label in examples:
            model.update(ids, values, label)
    return model.weights().astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Fits on at most `max_rows` labelled documents, in one task; returns the weights."""
    sample = labelled_sample(docs, labels, "quality", max_rows)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in b.schema.names))]
        yield pa.RecordBatch.from_arrays([pa.array([train(rows).tobytes()], pa.binary())], ["w"])

    found = sample.repartition(1).mapInArrow(learn, "w binary").first()
    return np.frombuffer(found["w"], np.float32) if found else np.zeros(1 << BITS, np.float32)


def score_texts(weights: np.ndarray, texts: list[str | None]) -> np.ndarray:
    rows, ids, counts = features(texts)
    margin = np.bincount(rows, weights[ids], len(texts)) / np.sqrt(np.maximum(counts, 1))
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text",
          threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")
          ) -> DataFrame:
    """All columns of `docs` with the score (double) and the decision (int), a row for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def compute(texts: list[str | None]) -> list[pa.Array]:
        p = score_texts(shared.value, texts)
        return [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))]

    return with_columns(docs, "{} double, {} int".format(*names), text_col, compute)
