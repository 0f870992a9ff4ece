"""Exact removal of repeated byte strings, by bucket-pointer refinement of sampled suffixes.

A string of LENGTH bytes (200) counts as repeated if it starts anywhere else in the corpus too;
all bytes that repeated strings cover are removed.

**Initial buckets.** A suffix's bucket identifier for its first q bytes is built by doubling: the
identifier of 2s bytes at a position is made of those of s bytes there and at the offset s later.
Of all suffixes only anchors are kept: for each LENGTH-byte window the position whose identifier
is least (leftmost of equals). Equal windows have their anchor at the same offset, so the windows
that an anchor stands for can only be repeated at anchors of the same bucket. Buckets of one
member are finished.

**Refinement.** An anchor stands for windows at SLACK possible offsets. A bucket is refined by the
identifiers of what lies before and after the q bytes, for a block of offsets at a time: first all
SLACK, then 16, then 1. Of a block, `whole` is the identifier of the bytes that its windows cover
together, and `core` that of the bytes common to all of them. Repeated `whole`: every window of
the block is repeated. Single `core`: none is. What remains goes on to smaller blocks, together
with one representative of each finished `whole` in its bucket, whose identifiers are thus reused.

Nothing is compared in pairs: each step counts identifiers, with partial sums before the shuffle,
and joins back those that occur more than once. Distinct texts are kept once, in a table bucketed
by row, so later steps read them without a shuffle. A text with an equal copy is removed whole.

Defined cases: null text counts as empty; texts under LENGTH bytes are kept whole; repeated rows
remove each other; strings that overlap themselves count, as their starts differ; texts of any
length are read whole, in pieces; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_path, in_slices, shuffles_removed, stored, tasks

LENGTH = 200
SLACK = 128  # offsets of an anchor in a window, a power of two
BLOCK = 16
_PIECE = 1 << 19  # bytes looked at together

_RNG = np.random.default_rng(7)
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _RNG.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bucket_ids(data: np.ndarray, q: int) -> np.ndarray:
    """Identifiers of the q bytes from each position, by doubling."""
    h, size, level = _BYTES[data], 1, 0
    while size < q:
        step = min(size, q - size)
        h = h[:-step] * _MUL[level] + h[step:]
        h ^= h >> np.uint64(29)
        size, level = size + step, level + 1
    return h * _MUL[7]


def anchors(data: np.ndarray, length: int = LENGTH, slack: int = SLACK) -> tuple[np.ndarray, ...]:
    """(position, bucket, first window, last window) of the anchors of one text."""
    found: list[tuple[np.ndarray, ...]] = []
    for base in range(0, max(0, len(data) - length + 1), _PIECE):
        piece = data[base : base + _PIECE + length - 1]
        ids = bucket_ids(piece, length - slack + 1)
        # identifier in the upper bits, position in the lower ones: the least is leftmost
        least = (ids & ~np.uint64(0xFFFFF)) | np.arange(len(ids), dtype=np.uint64)
        size = 1
        while size < slack:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        at = (least & np.uint64(0xFFFFF)).astype(np.int64)
        start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        end = np.r_[start[1:], len(at)] - 1
        found.append((at[start] + base, ids[at[start]].view(np.int64), start + base, end + base))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    at, ids, first, last = (np.concatenate(c) for c in zip(*found))
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])  # one row where pieces meet
    return at[new], ids[new], first[new], last[np.r_[new[1:], len(at)] - 1]


def _identifier(data: bytes, seed: int) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(data, seed)
    return (h >> 64) - (1 << 63), (h & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def distinct_texts(docs: DataFrame, row_col: str, text_col: str,
                   length: int) -> tuple[DataFrame, DataFrame]:
    """(row, node, copies) of every row, and (node, text) of each distinct text that can matter.

    node is the smallest row of a text. The second is a table bucketed by node.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{row_col}`").cast("long").alias("row"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    keyed = plain.select("row", F.unhex(F.md5("text")).alias("key"))
    classes = stored(keyed.groupBy("key").agg(F.min("row").alias("node"),
                                              F.count("*").alias("copies")), "texts")
    name = f"texts_{uuid.uuid4().hex}"
    # dealt out by row whatever kind of join follows, so that each bucket is one file
    with shuffles_removed(spark):
        (plain.where(F.octet_length("text") >= length).repartition(tasks(spark), "row")
         .join(classes.select(F.col("node").alias("row")), "row").withColumnRenamed("row", "node")
         .write.bucketBy(tasks(spark), "node").option("compression", "zstd")
         .option("path", fresh_path(spark, "texts")).saveAsTable(name))
    return keyed.join(classes, "key").drop("key"), spark.table(name)


def _at(rows: DataFrame, texts: DataFrame, items: list[str]) -> DataFrame:
    """Texts joined with the rows of each, as an array of structs of `items`."""
    listed = rows.groupBy("node").agg(F.collect_list(F.struct(*items)).alias("items"))
    return texts.join(listed, "node")


def _repeated(rows: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """`rows` with a flag: whether the keys (null: no) occur in another row too."""
    often = (rows.where(F.col(keys[0]).isNotNull()).groupBy(*keys)
             .agg(F.count("*").alias("times")).where("times > 1").drop("times")
             .withColumn(flag, F.lit(True)))
    return rows.join(often, keys, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def _refine(rows: DataFrame, group: list[str], whole: list[str]) -> DataFrame:
    """What goes on: the unfinished rows, and of each finished `whole` one, where a bucket has both.

    `rows` has the flag `done`. A bucket is given by the columns `group`.
    """
    open_ = rows.where("not done")
    one = rows.where("done").dropDuplicates([*group, *whole])
    return open_.unionByName(one.join(open_.select(*group).distinct(), group, "left_semi"))


_ITEM = "at long, first long, last long, bucket long"


def _level_rows(joined: DataFrame, schema: str, make) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.bool_() if c.endswith("boolean") else pa.int64() for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, "text"):
            out: list[tuple] = []
            for node, text, items in zip(part.column("node").to_pylist(),
                                         part.column("text").cast(pa.binary()).to_pylist(),
                                         part.column("items").to_pylist()):
                make(out, node, text, items)
            columns = list(zip(*out)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return joined.select("node", "text", "items").mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, row_col: str, text_col: str = "text",
                   length: int = LENGTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their distinct text, the table of texts, and (node, first, last) byte spans.

    A span [first, last) is covered by repeated strings; spans may overlap. `row_col` numbers the
    rows of `docs`, which must be a table that reads the same each time.
    """
    slack, block = SLACK, BLOCK
    rows, texts = distinct_texts(docs, row_col, text_col, length)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, "text"):
            node = part.column("node").to_numpy()
            made = [anchors(np.frombuffer(t, np.uint8), length, slack)
                    for t in part.column("text").cast(pa.binary()).to_pylist()]
            owner = np.repeat(node, [len(m[0]) for m in made])
            at, bucket, first, last = (np.concatenate(c) for c in zip(*made))
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner), pa.array(bucket), pa.array((at << 16) | ((at - first) << 8)
                                                             | (at - last))],
                ["node", "bucket", "anchor"])

    # an anchor and its windows in one number: position, most and least offset
    sampled = texts.select("node", "text").mapInArrow(
        sample, "node long, bucket long, anchor long")
    often = (sampled.groupBy("bucket").agg(F.count("*").alias("times")).where("times > 1")
             .select("bucket"))
    start = stored(sampled.join(often, "bucket"), "anchors")

    def whole_context(out: list, node: int, text: bytes, items: list) -> None:
        for item in items:
            at = item["anchor"] >> 16
            a, b = at - slack + 1, at + length
            h = _identifier(text[a:b], 0) if a >= 0 and b <= len(text) else (None, None)
            out.append((node, item["bucket"], item["anchor"], *h))

    level = _level_rows(_at(start, texts, ["bucket", "anchor"]),
                        "node long, bucket long, anchor long, w1 long, w2 long", whole_context)
    level = stored(_repeated(level, ["w1", "w2"], "done"), "level")
    most = F.shiftright("anchor", 8).bitwiseAND(255)
    least = F.col("anchor").bitwiseAND(255)

    def span(rows: DataFrame, most: Column, least: Column) -> DataFrame:
        at = F.shiftright("anchor", 16)
        return rows.select("node", (at - most).alias("first"),
                           (at - least + length).alias("last"))

    spans = [span(level.where("done"), most, least)]

    def blocks(out: list, node: int, text: bytes, items: list) -> None:
        for item in items:
            anchor = item["anchor"]
            at, far, near = anchor >> 16, anchor >> 8 & 255, anchor & 255
            for low in range(near // block * block, far + 1, block):
                a, b = at - low - block + 1, at - low + length
                w = _identifier(text[a:b], low + 1) if a >= 0 and b <= len(text) else (None, None)
                c = _identifier(text[at - low : b - block + 1], low + 1)
                clipped = at << 16 | min(far, low + block - 1) << 8 | max(near, low)
                out.append((node, clipped, item["done"], *w, *c))

    level = _level_rows(
        _at(_refine(level, ["bucket"], ["w1", "w2"]), texts, ["anchor", "done"]),
        "node long, anchor long, known boolean, w1 long, w2 long, c1 long, c2 long", blocks)
    level = _repeated(_repeated(level, ["w1", "w2"], "done"), ["c1", "c2"], "alive")
    level = stored(level.where("alive").drop("alive"), "level")
    spans.append(span(level.where("done and not known"), most, least))

    def single(out: list, node: int, text: bytes, items: list) -> None:
        for item in items:
            anchor = item["anchor"]
            at, far, near = anchor >> 16, anchor >> 8 & 255, anchor & 255
            for o in range(near, far + 1):
                h = _identifier(text[at - o : at - o + length], 0)
                out.append((node, at << 16 | o << 8 | o, *h))

    level = _level_rows(_at(_refine(level, ["c1", "c2"], ["w1", "w2"]), texts, ["anchor"]),
                        "node long, anchor long, w1 long, w2 long", single)
    level = _repeated(level, ["w1", "w2"], "done")
    spans.append(span(level.where("done"), most, least))
    return rows, texts, spans[0].unionAll(spans[1]).unionAll(spans[2])


def merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint spans that cover the same bytes; spans that touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(first, last)):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _listed(spans: DataFrame) -> DataFrame:
    return spans.groupBy("node").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def dedup(docs: DataFrame, row_col: str, text_col: str = "text",
          length: int = LENGTH) -> DataFrame:
    """(row, copies, spans): merged spans to remove from the text of each row (null: none).

    Where copies > 1 and the text has `length` bytes, all of it goes, whatever `spans` says.
    """
    rows, _, spans = repeated_spans(docs, row_col, text_col, length)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for batch in batches:
            out = []
            for items in batch.column("spans").to_pylist():
                found = merged([i["first"] for i in items], [i["last"] for i in items])
                out.append([{"first": a, "last": b} for a, b in found])
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, kind)],
                                             ["node", "spans"])

    single = _listed(spans).mapInArrow(
        merge, "node long, spans array<struct<first: long, last: long>>")
    return rows.join(single, "node", "left").select("row", "copies", "spans")


def digests(docs: DataFrame, row_col: str, text_col: str = "text",
            length: int = LENGTH) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    rows, texts, spans = repeated_spans(docs, row_col, text_col, length)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, "text"):
            out = []
            for node, text, items in zip(part.column("node").to_pylist(),
                                         part.column("text").cast(pa.binary()).to_pylist(),
                                         part.column("spans").to_pylist()):
                found = merged([i["first"] for i in items], [i["last"] for i in items])
                kept = cut(text, [{"first": a, "last": b} for a, b in found])
                out.append((node, len(text) - len(kept), len(found),
                            hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) if out else [[] for _ in range(4)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["node", "removed", "spans", "sha"])

    changed = texts.join(_listed(spans), "node").select("node", "text", "spans").mapInArrow(
        digest, "node long, removed long, spans long, sha string")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    plain = docs.select(F.col(f"`{row_col}`").cast("long").alias("row"),
                        F.octet_length(text).cast("long").alias("n_bytes"),
                        F.sha2(text.cast("binary"), 256).alias("plain"))
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return plain.join(rows, "row").join(changed, "node", "left").select(
        "row", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("removed", none)).alias("n_removed"),
        F.when(gone, one).otherwise(F.coalesce("spans", none)).alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("sha", "plain")).alias("kept_sha256"))


def cut(text: bytes, spans: list[dict] | None) -> bytes:
    kept, end = [], 0
    for s in spans or ():
        kept.append(text[end : s["first"]])
        end = s["last"]
    return b"".join(kept) + text[end:]


def removed_text(docs: DataFrame, row_col: str, text_col: str = "text",
                 length: int = LENGTH) -> DataFrame:
    """`docs` without the repeated bytes of their texts; null text stays null.

    Where a span cuts a character's bytes apart, what is left of the character goes too.
    """
    found = dedup(docs, row_col, text_col, length).select(
        F.col("row").alias("__of"), F.col("copies").alias("__copies"),
        F.col("spans").alias("__spans"))
    joined = docs.join(found, F.col(f"`{row_col}`") == F.col("__of")).drop("__of")
    names = [*joined.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, text_col):
            texts = []
            for text, copies, spans in zip(part.column(text_col).cast(pa.binary()).to_pylist(),
                                           part.column("__copies").to_pylist(),
                                           part.column("__spans").to_pylist()):
                if text is not None:
                    gone = copies > 1 and len(text) >= length
                    text = "" if gone else cut(text, spans).decode("utf-8", "ignore")
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == text_col else part.column(n)
                 for n in names[:-2]], names[:-2])

    return joined.mapInArrow(run, schema)
