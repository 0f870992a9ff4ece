"""Spelling variants of words, found with k-d trees over letter counts.

Words are near if one inserted, deleted or replaced letter turns one into the other. Seen as a
vector of letter counts, a replacement takes one from a count and adds one to another (L1 distance
2), and an insertion adds one to a count (L1 distance 1). So the near words of a word lie in a small
box query among the words of its own length, and among those one letter longer.

1. Words are counted per batch, then over all documents; those of at least `MIN_COUNT` stay.
2. A k-d tree for each length, grown on a bounded sample of the words (about `SAMPLE`, picked by
   a hash), cuts the vectors into cells; it decides only where the work is done. Every word is a point
   of its own cell, and goes as a query to each cell, of its length and of the next, whose box it
   could reach: the sums by which its counts lie above and below the box are pruned on the way
   down. A cell whose share of the sample makes it large is dealt out by hash, and queries to all
   its parts.
3. A task grows a full k-d tree over the points of one part, searches it with batches of queries,
   and compares the letters of what the leaves hold. It returns for each word the number of near
   words and the best of them, never the pairs.
4. Forms are followed to the last by doubling; each is at least ten times as frequent as the one
   before, so chains are short.

Letters are those of the run pattern, all of them below U+0100: a word is held as Latin-1 bytes,
whose order is that of the code points.

Defined cases: null text has no words; in the hashed text a null id reads as empty; repeated rows
count again; ties go to the smaller word; texts are read whole and words may have any length; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, runs, stored, tasks

MIN_LENGTH, MIN_COUNT = 7, 2
TIMES = 10  # how many times as frequent a form is at least
DROP = 31  # one run in so many loses a letter
SAMPLE = 1 << 16  # words that the cells are made from
CELL = 1 << 15  # words by cell that the sample is asked for
LEAST_SAMPLE = 64  # words of the sample by cell
PART = 1 << 20  # words of a cell that one task holds
LEAF = 32  # words by leaf of a task's tree
BATCH = 1 << 16  # queries searched at a time
_HELD = 400_000  # distinct words counted before they are handed on

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
_DIMENSION = np.full(256, len(_LETTERS), np.int64)
_DIMENSION[_LETTERS] = np.arange(len(_LETTERS))
_SUMS = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + 1


def words_of(doc_id: int | None, text: str | None) -> Counter[str]:
    """The words of a text of the least length and more, some of them with a letter deleted."""
    found: Counter[str] = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_RUN.findall((text or "").translate(_LOWER))).items():
        if len(run) < MIN_LENGTH:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % DROP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < MIN_LENGTH:
                continue
        found[run] += n
    return found


def vocabulary(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word in Latin-1, n) of the words with at least `MIN_COUNT` occurrences."""
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))

    def counted(held: Counter[str]) -> pa.RecordBatch:
        words = pa.array([w.encode("latin-1") for w in held], pa.binary())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())],
                                          ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for part in in_slices(batches, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(),
                                    part.column("text").to_pylist()):
                held.update(words_of(doc_id, text))
                if len(held) >= _HELD:
                    yield counted(held)
                    held.clear()
        yield counted(held)

    found = plain.mapInArrow(count, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def letters_of(words: pa.Array, length: int) -> np.ndarray:
    """(n, length) bytes of words of one length."""
    data = b"".join(words.to_pylist())
    return np.frombuffer(data, np.uint8).reshape(len(words), length)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """(n, letters of the alphabet) counts, 255 at most; a cut count only loosens a bound."""
    out = np.zeros((len(letters), len(_LETTERS)), np.uint8)
    for start in range(0, len(letters), 4096):
        some = _DIMENSION[letters[start : start + 4096]]
        cells = some + np.arange(len(some))[:, None] * (len(_LETTERS) + 1)
        made = np.bincount(cells.ravel(), minlength=len(some) * (len(_LETTERS) + 1))
        out[start : start + 4096] = np.minimum(made.reshape(len(some), -1)[:, :-1], 255)
    return out


@dataclass
class Tree:
    """A k-d tree over letter counts: an inner node sends counts up to `cut` to the left."""

    dim: list[int] = field(default_factory=list)  # -1 at a leaf
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)  # number of the leaf at a leaf
    right: list[int] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)  # points of each

    @staticmethod
    def grown(points: np.ndarray, most: int) -> Tree:
        """Leaves of at most `most` points, unless those of one are all equal."""
        tree = Tree()
        tree._grow(points, np.arange(len(points)), most)
        return tree

    def _grow(self, points: np.ndarray, own: np.ndarray, most: int) -> int:
        node = len(self.dim)
        for values in (self.dim, self.cut, self.left, self.right):
            values.append(-1)
        split = self._split(points[own]) if len(own) > most else None
        if split is None:
            self.left[node] = len(self.leaves)
            self.leaves.append(own)
        else:
            self.dim[node], self.cut[node] = split
            low = points[own, split[0]] <= split[1]
            self.left[node] = self._grow(points, own[low], most)
            self.right[node] = self._grow(points, own[~low], most)
        return node

    @staticmethod
    def _split(own: np.ndarray) -> tuple[int, int] | None:
        """The letter and count that halve the points best."""
        low, high = own.min(0).astype(int), own.max(0).astype(int)
        if (low == high).all():
            return None
        above = np.stack([(own > cut).sum(0) for cut in range(3)])
        worth = np.minimum(above, len(own) - above)
        if worth.any():
            cut, dim = np.unravel_index(worth.argmax(), worth.shape)
            return int(dim), int(cut)
        dim = int((high - low).argmax())
        return dim, int((low[dim] + high[dim]) // 2)

    def search(self, queries: np.ndarray, more: int, less: int,
               visit: Callable[[int, np.ndarray], None]) -> None:
        """Calls `visit(leaf, rows)` for the queries that could reach a box.

        A point in reach has at most `more` letters that the query lacks, and lacks at most `less`
        of the query's, both counted with repeats.
        """
        dims = queries.shape[1]
        rows = np.arange(len(queries))
        none = np.zeros(len(queries), np.int64)
        waiting = [(0, rows, none, none, [0] * dims, [255] * dims)]
        while waiting:
            node, rows, up, down, low, high = waiting.pop()
            if not len(rows):
                continue
            dim, cut = self.dim[node], self.cut[node]
            if dim < 0:
                visit(self.left[node], rows)
                continue
            count = queries[rows, dim].astype(np.int64)
            lost = down - np.maximum(count - high[dim], 0) + np.maximum(count - cut, 0)
            ok = lost <= less
            narrower = high.copy()
            narrower[dim] = cut
            waiting.append((self.left[node], rows[ok], up[ok], lost[ok], low, narrower))
            won = up - np.maximum(low[dim] - count, 0) + np.maximum(cut + 1 - count, 0)
            ok = won <= more
            narrower = low.copy()
            narrower[dim] = cut + 1
            waiting.append((self.right[node], rows[ok], won[ok], down[ok], narrower, high))

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        out = np.full(len(points), -1, np.int64)
        dim, cut = np.array(self.dim), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        while (out < 0).any():
            ended = dim[at] < 0
            out = np.where(ended, left[at], out)
            go = points[np.arange(len(points)), np.maximum(dim[at], 0)] <= cut[at]
            at = np.where(ended, at, np.where(go, left[at], right[at]))
        return out


@dataclass
class Cells:
    """The trees of all lengths in the sample, with the parts of each cell."""

    trees: dict[int, Tree]
    parts: dict[int, list[int]]

    @staticmethod
    def made(sample: list[bytes], total: int) -> Cells:
        by_length = defaultdict(list)
        for word in sample:
            by_length[len(word)].append(word)
        factor = max(1.0, total / max(1, len(sample)))
        most = max(LEAST_SAMPLE, math.ceil(CELL / factor))
        trees, parts = {}, {}
        for length, words in by_length.items():
            tree = Tree.grown(counts_of(letters_of(pa.array(words, pa.binary()), length)), most)
            parts[length] = [math.ceil(len(leaf) * factor / PART) for leaf in tree.leaves]
            tree.leaves = [leaf[:0] for leaf in tree.leaves]
            trees[length] = tree
        return Cells(trees, parts)

    def points(self, length: int, counts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cell and part of each word; lengths that the sample lacks are one cell."""
        if length not in self.trees:
            none = np.zeros(len(counts), np.int64)
            return none, none
        cell = self.trees[length].leaf_of(counts)
        return cell, hashes % np.array(self.parts[length], np.int64)[cell]

    def queries(self, length: int, counts: np.ndarray, more: int, less: int) -> tuple[
            np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, part) for all parts of all cells of a length that the words could reach."""
        if length not in self.trees:
            rows = np.arange(len(counts))
            return rows, 0 * rows, 0 * rows
        found: list[tuple[np.ndarray, int, int]] = []

        def visit(leaf: int, rows: np.ndarray) -> None:
            found.extend((rows, leaf, part) for part in range(self.parts[length][leaf]))

        self.trees[length].search(counts, more, less, visit)
        if not found:
            return (np.zeros(0, np.int64),) * 3
        sizes = [len(rows) for rows, _, _ in found]
        return (np.concatenate([rows for rows, _, _ in found]),
                np.repeat([leaf for _, leaf, _ in found], sizes),
                np.repeat([part for _, _, part in found], sizes))


_POINT, _SAME, _SHORTER = 0, 1, 2  # what a row is to its cell


def dealt(words: DataFrame, cells: Cells) -> DataFrame:
    """(length, cell, part, kind, word, n): points of the cells, and queries to them."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("word")).to_numpy()
            for length in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == length))
                word, n = own.column("word"), own.column("n")
                letters = letters_of(word, length)
                counts = counts_of(letters)
                hashes = (_sums(letters) >> np.uint64(33)).astype(np.int64)
                cell, part = cells.points(length, counts, hashes)
                yield rows_of(length, cell, part, _POINT, word, n)
                for target, more, less, kind in ((length, 1, 1, _SAME),
                                                 (length + 1, 1, 0, _SHORTER)):
                    row, cell, part = cells.queries(target, counts, more, less)
                    yield rows_of(target, cell, part, kind, word.take(pa.array(row)),
                                  n.take(pa.array(row)))

    def rows_of(length, cell, part, kind, word, n):
        m = len(cell)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, length, np.int32)), pa.array(cell.astype(np.int32)),
             pa.array(part.astype(np.int32)), pa.array(np.full(m, kind, np.int32)), word, n],
            ["length", "cell", "part", "kind", "word", "n"])

    return words.mapInArrow(
        deal, "length int, cell int, part int, kind int, word binary, n long")


def _sums(letters: np.ndarray) -> np.ndarray:
    """Sums of a random number for each letter: equal for equal letter counts."""
    return _SUMS[letters].sum(1, dtype=np.uint64)


def _slots() -> np.ndarray:
    """The numbers of the letters in a table by their upper bits, several a slot."""
    slots = np.zeros((4, 1024), np.uint64)
    for value in _SUMS[_LETTERS]:
        at = int(value >> np.uint64(54))
        free = int((slots[:, at] != 0).sum())
        slots[free, at] = value
    return slots


_SLOTS = [slot for slot in _slots() if slot.any()]


class Near:
    """Words near the points of one part of a cell, gathered over batches of queries."""

    def __init__(self, length: int, words: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(words)  # a smaller number is a smaller word
        self.length, self.words, self.n = length, words[order], n[order]
        self.letters = self._letters(self.words, length)
        self.tree = Tree.grown(counts_of(self.letters), LEAF)
        self.packed, self.sums = self._packed(self.letters), _sums(self.letters)

    @staticmethod
    def _letters(words: np.ndarray, length: int) -> np.ndarray:
        return np.frombuffer(b"".join(words.tolist()), np.uint8).reshape(len(words), length)

    @staticmethod
    def _packed(letters: np.ndarray) -> np.ndarray:
        """(words of 8 letters, n)"""
        wide = -(-letters.shape[1] // 8) * 8
        out = np.zeros((len(letters), wide), np.uint8)
        out[:, : letters.shape[1]] = letters
        return np.ascontiguousarray(out.view(np.uint64).T)

    def found(self, words: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs of near words; queries are of the same length or one shorter."""
        letters = self._letters(words, self.length if same else self.length - 1)
        packed, sums = self._packed(letters), _sums(letters)
        queries, points = [], []

        def visit(leaf: int, rows: np.ndarray) -> None:
            own = self.tree.leaves[leaf]
            step = max(1, (1 << 18) // max(1, len(own)))
            for start in range(0, len(rows), step):
                some = rows[start : start + step]
                if same:
                    hit = self._replaced(packed[:, some], own)
                else:
                    hit = self._could_be_longer(sums[some], own)
                q, p = np.nonzero(hit)
                if len(q):
                    queries.append(some[q])
                    points.append(own[p])

        self.tree.search(counts_of(letters), 1, 1 if same else 0, visit)
        if not queries:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, p = np.concatenate(queries), np.concatenate(points)
        if not same:
            ok = self._inserted(letters, q, p)
            q, p = q[ok], p[ok]
        return q, p

    def _replaced(self, packed: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Where exactly one letter differs."""
        differing = None
        low, high = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
        for mine, theirs in zip(packed, self.packed):
            x = mine[:, None] ^ theirs[own][None, :]
            x = np.bitwise_count((((x & low) + low) | x) & high)  # the bytes that are not zero
            differing = x if differing is None else np.minimum(differing + x, 2)
        return differing == 1

    def _could_be_longer(self, sums: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Where the letter counts differ by one letter more."""
        more = self.sums[own][None, :] - sums[:, None]
        at = (more >> np.uint64(54)).astype(np.int64)
        hit = _SLOTS[0][at] == more
        for slot in _SLOTS[1:]:
            hit |= slot[at] == more
        return hit & (more != 0)

    def _inserted(self, letters: np.ndarray, q: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Whether the point is the query with one letter inserted, by the order of the letters."""
        ok = np.zeros(len(q), bool)
        for start in range(0, len(q), BATCH):
            short, long = letters[q[start : start + BATCH]], self.letters[p[start : start + BATCH]]
            head = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
            tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
            ok[start : start + BATCH] = head + tail >= short.shape[1]
        return ok


def _best(owner: np.ndarray, size: int, n: np.ndarray, word: np.ndarray) -> tuple[
        np.ndarray, np.ndarray]:
    """Of each owner, how many rows it has, and its row of largest n and smallest word, or -1."""
    order = np.lexsort((word, -n, owner))
    own = owner[order]
    first = np.ones(len(own), bool)
    first[1:] = own[1:] != own[:-1]
    best = np.full(size, -1, np.int64)
    best[own[first]] = order[first]
    return np.bincount(owner, minlength=size), best


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, part and kind; gives (word, n_near, form_n, form) for those with any."""
    schema = ["word", "n_near", "form_n", "form"]

    def arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return (np.array(table.column("word").to_pylist(), object),
                table.column("n").to_numpy())

    def given(words: np.ndarray, count: np.ndarray, n: np.ndarray, form: np.ndarray):
        return pa.RecordBatch.from_arrays(
            [pa.array(words.tolist(), pa.binary()), pa.array(count.astype(np.int64)),
             pa.array(n.astype(np.int64)), pa.array(form.tolist(), pa.binary())], schema)

    near, where = None, None
    for rows in _chunks(batches, ["length", "cell", "part", "kind"], BATCH):
        length, cell, part, kind = (rows.column(c)[0].as_py()
                                    for c in ("length", "cell", "part", "kind"))
        words, n = arrays(rows)
        if kind == _POINT:
            near, where = Near(length, words, n), (length, cell, part)
            continue
        if where != (length, cell, part):
            continue  # a cell without points
        q, p = near.found(words, kind == _SAME)
        if not len(q):
            continue
        count, best = _best(q, len(words), near.n[p], p)
        some = np.flatnonzero(best >= 0)
        yield given(words[some], count[some], near.n[p[best[some]]], near.words[p[best[some]]])
        if kind == _SHORTER:
            rank = np.empty(len(words), np.int64)
            rank[np.argsort(words)] = np.arange(len(words))
            count, best = _best(p, len(near.words), n[q], rank[q])
            some = np.flatnonzero(best >= 0)
            yield given(near.words[some], count[some], n[q[best[some]]], words[q[best[some]]])


def _chunks(batches: Iterator[pa.RecordBatch], keys: list[str],
            most: int) -> Iterator[pa.Table]:
    """Tables of equal keys of a sorted stream: points together, queries up to about `most`."""
    held: list[pa.RecordBatch] = []
    key, size = None, 0
    for batch in batches:
        for table in runs(iter([batch]), keys):
            own = tuple(table.column(k)[0].as_py() for k in keys)
            if held and (own != key or (size >= most and key[-1] != _POINT)):
                yield pa.Table.from_batches(held)
                held, size = [], 0
            key = own
            held += table.to_batches()
            size += table.num_rows
    if held:
        yield pa.Table.from_batches(held)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): the words that have near ones, and the best of these.

    `words` (word binary, n long) is a stored table of distinct words.
    """
    total = words.count()
    some = words.where(F.pmod(F.xxhash64("word"), F.lit(max(total, 1))) < SAMPLE).select("word")
    cells = Cells.made(sorted(bytes(r["word"]) for r in some.collect()), total)
    order = ["length", "cell", "part"]
    rows = dealt(words, cells).repartition(tasks(words.sparkSession) * 4, *order)
    found = rows.sortWithinPartitions(*order, "kind").mapInArrow(
        _searched, "word binary, n_near long, form_n long, form binary")
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.minus")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root): the end of the chain of forms, of up to 2 ** rounds links."""
    up = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = stored(up.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")), "roots")
    return up


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root (text); n, n_near, form_n."""
    words = stored(vocabulary(docs, id_col, text_col), "words")
    near = stored(near_words(words), "near")
    known = words.join(near, "word", "left")
    taken = F.col("form_n") >= TIMES * F.col("n")
    known = stored(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("form")).alias("form"),
        F.when(taken, F.col("form_n")).alias("form_n")), "known")
    forms = known.where("form is not null")
    most = forms.agg(F.max("form_n")).first()[0] or 1
    links = int(math.log10(most)) + 1  # each form is ten times as frequent
    found = known.join(roots(forms, math.ceil(math.log2(links + 1))), "word", "left")
    text = {c: F.decode(c, "ISO-8859-1") for c in ("word", "form", "root")}
    return found.withColumn("root", F.coalesce("root", "word")).select(
        text["word"].alias("word"), text["form"].alias("form"), text["root"].alias("root"),
        "n", "n_near", "form_n")
