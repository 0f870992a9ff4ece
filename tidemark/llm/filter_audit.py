"""How five document filters interact in every order, with exact duplicates found by radix tries.

A filter fails a document if (A) it has under 100 words, (B) under 80 % of its words are distinct,
(C) over 10 % of its code points are capitals A-Z, (D) it holds one of #$%&*| or (E) a smaller id
anywhere in the table has the identical text. Applied one after another, a filter removes what
fails it and is still there, so the counts for all 120 orders follow from how many documents have
each set of failures, by part (language) and label.

1. A task inserts whole texts into a compressed trie, a bounded amount at a time, whose terminals
   hold the smallest id and what has it. Copies with larger ids are known to fail E; one row per
   distinct text goes on.
2. These are range-partitioned by text. The bounds are prefixes, each as long as it takes to tell
   two neighbours of a bounded sample apart, so much-used beginnings are cut more finely. A range
   whose texts agree in the whole of the compared prefix is dealt out by a checksum of the text.
3. A task inserts the texts of one range into a trie and, traversing it, flags those whose id is
   above the terminal's smallest.
4. The sets of failures are counted by part and label, and the few counts expanded to all orders.

Defined cases: null text counts as empty, null language as the empty string; a null id counts as
larger than all others, so its text fails E if any row with an id has it; rows with the same
smallest id and the same text are no copies of each other; a document counts as labelled if any
row of `labels` with its id says so; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, stored, tasks

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of the words
MOST_CAPITALS = 10  # percent of the code points
MARKS = "#$%&*|"
HELD_BYTES = 32 << 20  # of text in the trie of a task that reads documents
RANGE_BYTES = 16 << 20  # of text by range, at most
DEPTH = 1024  # bytes of a text that bounds compare
SAMPLE = 1 << 14  # texts that bounds are made from
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_COPY = 1 << FILTERS.index("E")


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a text in UTF-8 fails."""
    words = text.split()  # at ASCII white space alone, as the text is bytes
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.decode()) if not text.isascii() else len(text)
    failed = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * capitals > MOST_CAPITALS * points,
        len(text.translate(None, MARKS.encode())) < len(text),
    )
    return sum(1 << bit for bit, fails in enumerate(failed) if fails)


def _common(a: bytes, start: int, b: bytes, most: int) -> int:
    """How many of the first `most` bytes of a[start:] and b agree."""
    size = 64
    done = 0
    while done < most:
        end = min(done + size, most)
        if a[start + done : start + end] != b[done:end]:
            while end - done > 1:
                half = (done + end) // 2
                if a[start + done : start + half] == b[done:half]:
                    done = half
                else:
                    end = half
            return done
        done, size = end, size * 2
    return most


class Node:
    """A node of a compressed trie: the bytes that lead to it, and what its terminal holds."""

    __slots__ = ("label", "children", "least", "failed", "rows")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, Node] = {}
        self.least: float | None = None  # smallest id; None: no text ends here
        self.failed = 0
        self.rows: Counter | list | None = None  # what has been seen of the text


class Trie:
    """Texts with the smallest id of each. Null ids are infinite."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def terminal(self, text: bytes) -> Node:
        """The node where the text ends, made if it is not there."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                return child
            label = child.label
            same = _common(text, at, label, min(len(label), len(text) - at))
            if same < len(label):  # the edge is cut in two
                middle = Node(label[:same])
                child.label = label[same:]
                middle.children[child.label[0]] = child
                node.children[text[at]] = middle
                child = middle
            node, at = child, at + same
        return node

    def terminals(self) -> Iterator[tuple[bytes, Node]]:
        """Every text and its terminal."""
        waiting: list[tuple[bytes, Node]] = [(b"", self.root)]
        while waiting:
            before, node = waiting.pop()
            text = before + node.label
            if node.least is not None:
                yield text, node
            waiting += [(text, child) for child in node.children.values()]


class Ranges:
    """Bounds of text ranges: prefixes, and the number of parts of each range."""

    def __init__(self, bounds: list[bytes], parts: list[int]) -> None:
        self.bounds, self.parts = bounds, parts

    @staticmethod
    def made(sample: list[tuple[bytes, int]], total_bytes: int, most: float) -> Ranges:
        """Of (first DEPTH bytes, size of the texts) of some texts, and the size of all texts.

        A range is meant to hold `most` bytes, and a part of one that cannot be cut twice as many.
        """
        sample = sorted(sample)
        share = total_bytes / max(1, sum(size for _, size in sample))
        bounds: list[bytes] = []
        held, sizes = 0.0, []
        for (before, _), (text, size) in zip([(b"", 0), *sample], sample):
            if held >= most and text != before:
                same = _common(text, 0, before, min(len(text), len(before)))
                bounds.append(text[: same + 1])
                sizes.append(held)
                held = 0.0
            held += size * share
        sizes.append(held)
        return Ranges(bounds, [max(1, math.ceil(size / (2 * most))) for size in sizes])

    def of(self, text: bytes) -> tuple[int, int]:
        number = bisect.bisect_right(self.bounds, text[:DEPTH])
        parts = self.parts[number]
        return number, zlib.crc32(text) % parts if parts > 1 else 0


def ranges(texts: DataFrame) -> Ranges:
    """Bounds from about `SAMPLE` of the texts, picked by a hash."""
    size = F.octet_length("text").cast("long")
    about = texts.agg(F.count("*").alias("n"), F.sum(size).alias("size")).first()
    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(max(about["n"], 1))) < SAMPLE)
    distinct = some.groupBy(F.substring("text", 1, DEPTH).alias("head"), F.xxhash64("text")).agg(
        F.max(size).alias("size"))
    heads = distinct.groupBy("head").agg(F.sum("size").alias("size")).collect()
    total = about["size"] or 0
    most = min(RANGE_BYTES, total / (2 * tasks(texts.sparkSession)))  # no task without a range
    return Ranges.made([(bytes(r["head"]), r["size"]) for r in heads], total, max(most, 1))


_SENT = pa.schema([("number", pa.int32()), ("piece", pa.int32()), ("text", pa.binary()),
                   ("doc_id", pa.int64()), ("failed", pa.int32()),
                   ("parts", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_FOUND = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("failed", pa.int32()),
                    ("n", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _id(least: float) -> int | None:
    return None if least == math.inf else int(least)


class Gathered:
    """Documents of one task: a trie of the texts, and copies that it has already told."""

    def __init__(self) -> None:
        self.trie, self.copies = Trie(), Counter()
        self.bytes = 0

    def add(self, text: bytes, doc_id: int | None, part: str) -> None:
        i = math.inf if doc_id is None else doc_id
        node = self.trie.terminal(text)
        if node.least is None:
            self.bytes += len(text) + 500
            node.least, node.rows, node.failed = i, Counter({part: 1}), failures(text)
        elif i == node.least:
            node.rows[part] += 1
        elif i > node.least:
            self.copies[i, part, node.failed | _COPY] += 1
        else:
            for p, n in node.rows.items():
                self.copies[node.least, p, node.failed | _COPY] += n
            node.least, node.rows = i, Counter({part: 1})

    def full(self) -> bool:
        return self.bytes > HELD_BYTES or len(self.copies) > 100_000

    def sent(self, bounds: Ranges) -> Iterator[pa.RecordBatch]:
        """A row for each distinct text, and rows of copies without text, dealt out by their ids."""
        yield _batch([(-1 - zlib.crc32(str(i).encode()) % 65_536, 0, None, _id(i), failed, [part],
                       [n]) for (i, part, failed), n in self.copies.items()], _SENT)
        rows, size = [], 0
        for text, node in self.trie.terminals():
            rows.append((*bounds.of(text), text, _id(node.least), node.failed,
                         list(node.rows), list(node.rows.values())))
            size += len(text)
            if size > 4 << 20:
                yield _batch(rows, _SENT)
                rows, size = [], 0
        yield _batch(rows, _SENT)


def _of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range: those above the smallest id of their text fail E as well."""
    def flagged(trie: Trie) -> Iterator[pa.RecordBatch]:
        out = []
        for _, node in trie.terminals():
            for i, parts, counts in node.rows:
                failed = node.failed | (_COPY if i > node.least else 0)
                out += [(_id(i), part, failed, n) for part, n in zip(parts, counts)]
            if len(out) > 50_000:
                yield _batch(out, _FOUND)
                out = []
        yield _batch(out, _FOUND)

    trie, where = Trie(), None
    for batch in batches:
        known = []
        for number, piece, text, doc_id, failed, parts, counts in zip(
                *(batch.column(name).to_pylist() for name in _SENT.names)):
            if text is None:
                known.append((doc_id, parts[0], failed, counts[0]))
                continue
            if (number, piece) != where:
                yield from flagged(trie)
                trie, where = Trie(), (number, piece)
            i = math.inf if doc_id is None else doc_id
            node = trie.terminal(text)
            if node.least is None:
                node.least, node.failed, node.rows = i, failed, []
            node.least = min(node.least, i)
            node.rows.append((i, parts, counts))
        yield _batch(known, _FOUND)
    yield from flagged(trie)


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "lang") -> DataFrame:
    """(doc_id, part, failed, n): how many rows of an id fail which filters (bits, A lowest)."""
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b"")).alias("text"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    bounds = ranges(texts)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Gathered()
        for some in in_slices(batches, "text"):
            for row in zip(*(some.column(c).to_pylist() for c in ("text", "doc_id", "part"))):
                held.add(*row)
            if held.full():
                yield from held.sent(bounds)
                held = Gathered()
        yield from held.sent(bounds)

    sent = texts.mapInArrow(gather, "number int, piece int, text binary, doc_id long, failed int, "
                                    "parts array<string>, counts array<long>")
    dealt = sent.repartition(tasks(docs.sparkSession), "number", "piece")
    found = dealt.sortWithinPartitions("number", "piece").mapInArrow(
        _of_range, "doc_id long, part string, failed int, n long")
    return found.groupBy("doc_id", "part", "failed").agg(F.sum("n").alias("n"))


def labelled_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic, n): how many documents have each set of failures and labels."""
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    return (failed.join(known, "doc_id", "left")
            .groupBy("part", "failed", F.coalesce("good", F.lit(False)).alias("good"),
                     F.coalesce("toxic", F.lit(False)).alias("toxic"))
            .agg(F.sum("n").alias("n")))


def _bits(letters: Column) -> Column:
    bit = F.create_map(*[F.lit(v) for k, f in enumerate(FILTERS) for v in (f, 1 << k)])
    return F.aggregate(letters, F.lit(0), lambda bits, f: bits.bitwiseOR(bit[f]))


def audit(counts: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step, from (part, failed, good, toxic, n)."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = counts.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders)))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letters = F.split("filter_order", "")
    steps = steps.withColumns({
        "before": _bits(F.slice(letters, F.lit(1), F.col("step") - 1)),
        "own": _bits(F.slice(letters, F.col("step"), F.lit(1)))})
    fails = F.col("failed").bitwiseAND(F.col("own")) != 0
    gone = F.col("failed").bitwiseAND(F.col("before")) != 0
    n = F.col("n")
    # of the orders, those in which the filter comes first of all that the document fails
    first = n * len(orders) / F.bit_count("failed")
    measures = {
        "kept": (~gone & ~fails, n),
        "removed": (~gone & fails, n),
        "redundant": (gone & fails, n),
        "unique_fails": (F.col("failed") == F.col("own"), n),
        "good_lost": (~gone & fails & F.col("good"), n),
        "toxic_lost": (~gone & fails & F.col("toxic"), n),
        "shapley": (fails, first.cast("long")),
    }
    return steps.groupBy("part", "filter_order", "step").agg(*[
        F.sum(F.when(chosen, amount).otherwise(F.lit(0).cast("long"))).alias(name)
        for name, (chosen, amount) in measures.items()])


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What every filter removes at every step of every order, by language."""
    return audit(stored(labelled_counts(failed_filters(docs), labels), "failed"))
