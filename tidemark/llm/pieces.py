"""SentencePiece encoding and decoding: N-best segmentation of whole texts.

A text's segmentations are paths through the lattice of vocabulary pieces; a path's score is the
sum of its pieces' scores. A forward Viterbi pass gives the best score of each prefix. A backward
A* search from the end then uses it as the heuristic; as it is exact, complete paths leave the
queue in order of their scores, and no position needs to be entered more than N times.

No piece spans two characters that follow one another in no piece, so the lattice falls apart
there, before a space marker above all. Parts are searched by themselves and remembered by their
text, and the N best of the whole are the N least sums of losses over the parts; only the N - 1
parts with the least first losses can take part in them.

Text is normalised as the model does: a space marker in front and for each space. A character
without a piece is written as its UTF-8 bytes, with a score under all pieces. Equal scores come in
an order that depends on the text only. Defined cases: null text counts as empty, which has no
pieces and one segmentation, of score 0; a text with fewer than N segmentations has that many
rows; texts of any length are searched whole; decoding gives the text back unless it holds the
space marker itself.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from heapq import heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices

N_BEST = 4
SPACE = "▁"
_CACHE_UNITS = 1_000_000
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Vocabulary:
    """Pieces and scores of a model file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        usual = [i for i in range(size)
                 if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.pieces = {names[i]: (model.get_score(i), struct.pack("<I", i)) for i in usual}
        self.longest = max(map(len, self.pieces))
        # a tree of the pieces by their characters: what is known of a piece, and what goes on
        self.tree: dict[str, list] = {}
        for piece, known in self.pieces.items():
            below = self.tree
            for c in piece[:-1]:
                below = below.setdefault(c, [None, {}])[1]
            below.setdefault(piece[-1], [None, {}])[0] = (*known, len(piece))
        self.bytes = {int(names[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.unknown = min(s for s, _ in self.pieces.values()) - 10
        self.joined = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        self.lines_apart = not any("\n" in pair for pair in self.joined)
        self.texts = [b""] * size
        for i in usual:
            self.texts[i] = names[i].replace(SPACE, " ").encode()
        for value, i in self.bytes.items():
            self.texts[i] = bytes([value])
        self.add(*self.pieces)
        self.atoms: dict[str, tuple[float, bytes, float]] = {}
        self.choices: dict[tuple[str, int], list[tuple[float, bytes]]] = {}
        self.units = _Units(self)

    def add(self, *texts: str) -> None:
        """Lets the tree write each character of the texts as bytes, if it is no piece."""
        for char in set().union(*texts):
            begun = self.tree.setdefault(char, [None, {}])
            begun[0] = begun[0] or (*self.edges(char, 0, 1), 1)

    def edges(self, text: str, j: int, i: int) -> tuple[float, bytes] | None:
        found = self.pieces.get(text[j:i])
        if found is None and j == i - 1:
            raw = [self.bytes[b] for b in text[j].encode()]
            return self.unknown, struct.pack(f"<{len(raw)}I", *raw)
        return found

    def two_best(self, text: str) -> tuple[float, bytes, float]:
        """Best score, its ids, and how much less the second best has (infinite: none)."""
        tree, most = self.tree, self.longest
        none, size = -float("inf"), len(text)
        best, second = [0.0] + [none] * size, [none] * (size + 1)
        back: list[tuple[float, bytes, int]] = [(0.0, b"", 0)] * (size + 1)
        for j in range(size):
            b, c = best[j], second[j]
            below, i = tree, j
            for char in text[j : j + most]:
                if char not in below:
                    break
                found, below = below[char]
                i += 1
                if found is not None:
                    s = b + found[0]
                    old = best[i]
                    if s > old:
                        other = c + found[0]
                        second[i] = old if old > other else other
                        best[i], back[i] = s, found
                    elif s > second[i]:
                        second[i] = s
        if best[-1] == none:  # a character that is in no piece
            self.add(text)
            return self.two_best(text)
        ids, at = [], size
        while at:
            piece = back[at]
            ids.append(piece[1])
            at -= piece[2]
        return best[-1], b"".join(ids[::-1]), best[-1] - second[-1]

    def n_best(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The n best (score, ids) of a text that is searched in one piece."""
        ends: list[list[tuple[int, float, bytes]]] = [[]]
        best = [0.0]
        for i in range(1, len(text) + 1):
            ends.append([(j, *found) for j in range(max(0, i - self.longest), i)
                         if (found := self.edges(text, j, i)) is not None])
            best.append(max(best[j] + s for j, s, _ in ends[-1]))
        queue: list[tuple] = [(-best[-1], 0, len(text), 0.0, None)]
        out: list[tuple[float, bytes]] = []
        entered = [0] * (len(text) + 1)
        pushed = 0
        while queue and len(out) < n:
            _, _, at, score, link = heappop(queue)
            if at == 0:
                ids = []
                while link is not None:
                    ids.append(link[0])
                    link = link[1]
                out.append((score, b"".join(ids)))
                continue
            entered[at] += 1
            if entered[at] > n:
                continue
            for j, s, piece in ends[at]:
                pushed += 1
                heappush(queue, (-(best[j] + s + score), pushed, j, s + score, (piece, link)))
        return out

    def parts(self, unit: str) -> list[str]:
        together = [*map(self.joined.__contains__, map(add, unit, unit[1:]))]
        out, at = [], 0
        for _ in range(together.count(False)):
            cut = together.index(False, at) + 1
            out.append(unit[at:cut])
            at = cut
        out.append(unit[at:])
        return out

    def encode(self, text: str | None, n: int = N_BEST) -> list[tuple[float, bytes]]:
        """The n best (score, ids); ids are little-endian, 32 bits each."""
        if not text:
            return [(0.0, b"")]
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            units = _UNIT.findall(SPACE + text.replace(" ", SPACE))
            units = [u[1:] if u[0] == SPACE and len(u) > 1 and u[1] != SPACE else "\0" + u
                     for u in units]
        else:
            units = text.split(" ")
        scores, ids, lost = zip(*map(self.units.__getitem__, units))
        whole = sum(scores)
        out = [(whole, b"".join(ids))]
        if n > 1:
            losses = np.array(lost)
            # the n - 1 least losses, the first ones of equals
            most = np.partition(losses, n - 2)[n - 2] if len(losses) >= n else np.inf
            below = np.flatnonzero(losses < most)
            level = np.flatnonzero((losses == most) & np.isfinite(losses))[: n - 1 - len(below)]
            out += self.others(units, ids, whole, [*below.tolist(), *level.tolist()], n)
        return out

    def others(self, units: list[str], ids: tuple[bytes, ...], whole: float, open_: list[int],
               n: int) -> list[tuple[float, bytes]]:
        """The second to n-th best; only the units at `open_` differ from the best."""
        choices = [self.unit_choices(units[k], n) for k in open_]
        ranked: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
        for c in choices:
            ranked = sorted((loss + c[0][0] - c[p][0], (*picks, p))
                            for loss, picks in ranked for p in range(len(c)))[:n]
        out = []
        for loss, picks in ranked[1:]:
            own = list(ids)
            for k, c, p in zip(open_, choices, picks):
                own[k] = c[p][1]
            out.append((whole - loss, b"".join(own)))
        return out

    def unit_choices(self, unit: str, n: int) -> list[tuple[float, bytes]]:
        """The n best of a unit, of the n best of its parts; the first is the remembered best."""
        made = self.choices.get((unit, n))
        if made is None:
            if len(self.choices) >= _CACHE_UNITS // 10:
                self.choices.clear()
            made = [(0.0, b"")]
            for part in self.parts(unit[1:] if unit[:1] == "\0" else SPACE + unit):
                made = sorted(((a + s, ids + more) for a, ids in made for s, more in
                               self.n_best(part, n)), key=lambda x: -x[0])[:n]
            first = self.units[unit]
            made = [first[:2], *[m for m in made if m[1] != first[1]]][: max(1, len(made))]
            self.choices[unit, n] = made
        return made

    def decode(self, ids: bytes) -> str:
        texts = self.texts
        out = b"".join(map(texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return out.decode("utf-8", "replace")[1:]  # without the space in front


class _Units(dict):
    """Score, ids, and loss of the second best (infinite: none) of units.

    A unit stands for a space marker and what follows it, or, after a NUL, for itself.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, unit: str) -> tuple[float, bytes, float]:
        if len(self) >= _CACHE_UNITS:
            self.clear()
        value = None
        head = 2 if unit[:1] == "\0" else 1
        several = "\n" in unit[head:] and self.vocabulary.lines_apart
        for found in self.lines(unit, head) if several else self.atoms(unit):
            if value is None:
                value = found
            else:
                value = (value[0] + found[0], value[1] + found[1],
                         value[2] if value[2] < found[2] else found[2])
        self[unit] = value
        return value

    def lines(self, unit: str, head: int) -> Iterator[tuple[float, bytes, float]]:
        """Values of the lines of a unit, which are met more often than the whole."""
        first, *others = unit[head:].split("\n")
        yield self[unit[:head] + first]
        for other in others:
            yield self["\0\n" + other]

    def atoms(self, unit: str) -> Iterator[tuple[float, bytes, float]]:
        v = self.vocabulary
        for part in v.parts(unit[1:] if unit[:1] == "\0" else SPACE + unit):
            found = v.atoms.get(part)
            if found is None:
                if len(v.atoms) >= _CACHE_UNITS:
                    v.atoms.clear()
                found = v.atoms[part] = v.two_best(part)
            yield found


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def encode(docs: DataFrame, path: str, n: int = N_BEST, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, rank, score, ids, round_trip): the n best segmentations of every text.

    `ids` is binary, 32 bits each; `round_trip` tells whether the best one decodes to the text.
    `path` is a model file that every executor can open.
    """
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for part in in_slices(batches, "text", 1 << 20):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(),
                                    part.column("text").to_pylist()):
                found = v.encode(text, n)
                same = v.decode(found[0][1]) == (text or "")
                rows += [(doc_id, k, s, ids, same) for k, (s, ids) in enumerate(found, 1)]
            types = [part.column("doc_id").type, pa.int32(), pa.float64(), pa.binary(), pa.bool_()]
            names = ["doc_id", "rank", "score", "ids", "round_trip"]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names)

    return plain.mapInArrow(
        run, f"doc_id {kind}, rank int, score double, ids binary, round_trip boolean")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """All columns of `encoded` and `text`, decoded from its ids (null: empty)."""
    kept = [c for c in encoded.columns if c != "text"]
    plain = encoded.select(*[F.col(f"`{c}`") for c in kept])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema]
                       + ["text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for part in in_slices(batches, ids_col):
            texts = [v.decode(ids or b"") for ids in part.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                             [*kept, "text"])

    return plain.mapInArrow(run, schema)
