"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A text is cut into windows, and each window is compressed with the ordinary dictionary and with
the toxic dictionary in front of the ordinary one. The bytes saved by the second say how much of
the window only toxic text explains. A window that saves nothing in a fast pass is done; the rest
are measured again with the optimal parser. A logistic curve over the savings of a document,
fitted on labelled documents that the dictionaries have not seen, gives the calibrated score.

The toxic dictionary is trained on what sets toxic text apart: from toxic documents the words
remain whose document frequency is significantly higher there (G-squared). Frequencies count
families of documents with one smallest hash of four words, so near copies count about once.

Words are compared in lower case, with runs of anything but letters as one space. Defined cases:
null text counts as empty; an empty text saves nothing and gets the score of that; equal texts
get equal scores; texts of any length are scored whole; with no toxic or no ordinary label, all
scores are the rate of toxic labels (0 without labels).
"""

from __future__ import annotations

import math
import pickle
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zs
from pyspark.sql import DataFrame

from tidemark.llm.common import labelled_sample, with_columns

SAMPLE_ROWS = 16384  # bound of the labelled rows a model is fitted on
WINDOW = 128  # bytes
ORDINARY_BYTES = 4096
TOXIC_BYTES = 8192  # at most
FAST, EXACT = 6, 17  # compression levels
THRESHOLD = 0.5

_NOT_WORD = re.compile(r"[\W\d_]+")


def words_of(text: str | None) -> str:
    return " " + _NOT_WORD.sub(" ", (text or "").lower()).strip() + " "


def windows(text: str | None) -> list[bytes]:
    """Windows of WINDOW bytes; each but the first starts at the last space of the one before, so
    that a word cut at a border is whole in the next. Windows within a word that no window holds
    overlap by half."""
    data = words_of(text).encode()
    out, start = [data[:WINDOW]], 0
    while (end := start + WINDOW) < len(data):
        space = data.rfind(b" ", start + 1, end + 1)
        start = space if space > 0 else start + WINDOW // 2
        out.append(data[start : start + WINDOW])
    return out


def distinct_words(texts: list[str], labels: list[int], least: float = 40.0) -> set[str]:
    """Words of toxic texts whose family frequency there is higher, with G-squared >= least."""
    families: tuple[dict, dict] = (defaultdict(set), defaultdict(set))
    every: tuple[set, set] = (set(), set())
    for text, label in zip(texts, labels):
        words = words_of(text).split()
        if words:
            family = min(xxhash.xxh64_intdigest(" ".join(words[i : i + 4]))
                         for i in range(max(1, len(words) - 3)))
            every[label].add(family)
            for w in set(words):
                families[label][w].add(family)
    n0, n1 = max(1, len(every[0])), max(1, len(every[1]))
    kept = set()
    for w, own in families[1].items():
        a, b = len(own), len(families[0].get(w, ()))
        if len(w) > 2 and a / n1 > 3 * (b + 0.5) / n0:
            g2 = 2 * (a * math.log(a * (n0 + n1) / ((a + b) * n1))
                      + (b * math.log(b * (n0 + n1) / ((a + b) * n0)) if b else 0))
            if g2 >= least:
                kept.add(w)
    return kept


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """Content of a dictionary trained on samples; their own text if there is too little."""
    plain = b"".join(dict.fromkeys(samples))
    if len(plain) <= size:
        return plain
    try:
        made = zs.train_dictionary(size + 1024, samples, k=segment, d=6).as_bytes()
    except zs.ZstdError:
        return plain[:size]
    return made[-size:]


class Model:
    """Two dictionaries and the weights of the calibration."""

    def __init__(self, toxic: bytes, ordinary: bytes, weights: np.ndarray) -> None:
        self.toxic, self.ordinary, self.weights = toxic, ordinary, weights
        self.pairs: list | None = None

    def __getstate__(self) -> tuple:
        return self.toxic, self.ordinary, self.weights

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def compressors(self) -> list:
        if self.pairs is None:
            self.pairs = []
            for level in (FAST, EXACT):
                pair = []
                for content in (self.ordinary, self.toxic + self.ordinary):
                    d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
                    d.precompute_compress(level=level)
                    pair.append(zs.ZstdCompressor(
                        level=level, dict_data=d, write_content_size=False,
                        write_checksum=False, write_dict_id=False).compress)
                self.pairs.append(pair)
        return self.pairs

    def savings(self, text: str | None) -> np.ndarray:
        """Features of a text: mean, scaled sum, mean of the three largest, and largest saving."""
        (fast0, fast1), (exact0, exact1) = self.compressors()
        saved = []
        for w in windows(text):
            s = len(fast0(w)) - len(fast1(w))
            saved.append(len(exact0(w)) - len(exact1(w)) if s > 0 else 0)
        a = np.array(saved, float)
        top = np.sort(a)[-3:]
        return np.array([a.mean(), a.sum() / math.sqrt(len(a)), top.mean(), a.max()])

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.toxic or not self.ordinary:
            return np.full(len(texts), self.weights[-1])
        x = np.array([[*self.savings(t), 1.0] for t in texts]).reshape(len(texts), 5)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(sample: list[tuple[int, str, int]]) -> Model:
    """Three quarters of the sample make the dictionaries, one quarter the calibration."""
    unique = {}
    for doc_id, text, label in sample:
        unique.setdefault(text, (xxhash.xxh64_intdigest(text, 7), text, int(label > 0)))
    rows = sorted(unique.values())
    labels = [r[2] for r in rows]
    if len(set(labels)) < 2:
        return Model(b"", b"", np.array([0, 0, 0, 0, np.mean(labels) if labels else 0.0]))
    seen, rest = [r for r in rows if r[0] % 4], [r for r in rows if r[0] % 4 == 0]
    kept = distinct_words([r[1] for r in seen], [r[2] for r in seen])
    toxic = [f" {' '.join(found)} ".encode() for _, text, label in seen if label
             if (found := [w for w in words_of(text).split() if w in kept])]
    distinct = sum(len(w.encode()) + 1 for w in kept)
    ordinary = [w for _, text, label in seen if not label for w in windows(text)[::4]]
    model = Model(trained(toxic, min(TOXIC_BYTES, max(2048, 4 * distinct)), 32),
                  trained(ordinary[: 40 * ORDINARY_BYTES // 4], ORDINARY_BYTES, 64), np.zeros(5))
    if not model.toxic or not model.ordinary or len({r[2] for r in rest}) < 2:
        return Model(b"", b"", np.array([0, 0, 0, 0, np.mean(labels)]))
    x = np.array([[*model.savings(r[1]), 1.0] for r in rest])
    model.weights = logistic(x, np.array([r[2] for r in rest], float))
    return model


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on at most `max_rows` labelled documents, in one task."""
    sample = labelled_sample(docs, labels, "toxic", max_rows)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in b.schema.names))]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(rows))], pa.binary())],
                                         ["model"])

    found = sample.repartition(1).mapInArrow(learn, "model binary").first()
    return pickle.loads(found["model"]) if found else train([])


def score(docs: DataFrame, model: Model, text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """All columns of `docs` with `score` (double) and `predicted` (int), one row for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list[str | None]) -> list[pa.Array]:
        p = shared.value.score(texts)
        return [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))]

    return with_columns(docs, "score double, predicted int", text_col, compute)
