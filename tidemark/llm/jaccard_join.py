"""Near-duplicate documents: n-gram Jaccard join with Bayesian pruning of MinHash candidates.

Texts are sets of word n-grams (lower case, split at white space; a text of fewer words is one
n-gram of all of them). Equal texts are one class, and only classes are compared. Bands of a
MinHash signature give the candidates. In each bucket, values are compared a few at a time: after
m of n values agreed, the similarity of a pair has a Beta(m + 1, n - m + 1) posterior, and the pair
is dropped once the probability that it reaches the threshold is below the tolerance. What passes
is joined to candidate groups, within which every pair is verified exactly on the n-grams.

Buckets and candidate groups of any size are dealt out as pairs of bounded blocks, so no task
gets an unbounded group, and what leaves a block pair is one row per member (its number of links
and one edge of a spanning forest), never all pairs.

Defined cases: null text counts as empty; empty texts are one class without n-grams, like none but
each other; equal rows are members of one class; a null id is never the smallest of its group if
another id is there; texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, runs, stored
from tidemark.llm.components import components

WORDS = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, ROWS = 30, 5  # a pair of similarity 0.8 shares no band with probability 7e-6
STEP = 15  # values compared between two looks at the posterior
BUCKET_BLOCK = 1024  # members of a bucket by block
GROUP_BLOCK = 256  # members of a candidate group by block
_CACHE_WORDS = 300_000

_RNG = np.random.default_rng(20240229)
_A = (_RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1))
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_C = _RNG.integers(0, 1 << 63, WORDS + ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RNG.integers(0, 1 << 63, BANDS, dtype=np.uint64)


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.lower())
        return value


_WORDS = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word n-grams."""
    split = (text or "").split()
    h = np.fromiter(map(_WORDS.__getitem__, split), np.uint64, len(split))
    n = min(words, len(h))
    if n == 0:
        return h
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = _mixed(out + h[k : len(h) - n + 1 + k] * _C[k])
    return np.unique(out)


def signature(grams: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set."""
    x = (grams ^ (grams >> np.uint64(32))).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 256):
        np.minimum(least, (x[i : i + 256, None] * _A + _B).min(0), out=least)
    return least


def bands_of(values: np.ndarray) -> np.ndarray:
    parts = values.astype(np.uint64).reshape(BANDS, ROWS)
    h = _BAND.copy()
    for k in range(ROWS):
        h = _mixed(h + parts[:, k] * _C[WORDS + k])
    return h.view(np.int64)


def fewest_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest of n equal values for which P(similarity >= threshold) is not below tolerance.

    The posterior's tail is a binomial sum: P = P(Bin(n + 1, threshold) <= matches).
    """
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


def pruning(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    return [(n, fewest_matches(n, threshold, tolerance))
            for n in range(STEP, BANDS * ROWS + 1, STEP)]


def passing(one: np.ndarray, many: np.ndarray, rules: list[tuple[int, int]]) -> np.ndarray:
    """Indexes of the rows of `many` that pruning leaves as partners of `one`."""
    left = np.arange(len(many))
    matches = np.zeros(len(many), np.int64)
    start = 0
    for n, least in rules:
        matches += (many[left, start:n] == one[start:n]).sum(1)
        ok = matches >= least
        left, matches, start = left[ok], matches[ok], n
        if not len(left):
            break
    return left


def _in_blocks(members: DataFrame, key: str, size: str, node: str, block: int) -> DataFrame:
    """A row for each block pair of a member's group: bi <= bj, and `own` (its own block)."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(node), blocks.cast("long")).cast("int")
    return (
        members.withColumn("own", own).withColumn("other", F.explode(F.sequence(
            F.lit(0), blocks - 1)))
        .withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other"))
        .drop("other", size)
        .repartition(F.col(key), F.col("bi"), F.col("bj")).sortWithinPartitions(key, "bi", "bj")
    )


def classes(docs: DataFrame, row_col: str, id_col: str, text_col: str) -> tuple[DataFrame,
                                                                               DataFrame]:
    """(row, doc_id, key) of every row, and (node, key, row, bands, sig) of every distinct text."""
    plain = docs.select(
        F.col(f"`{row_col}`").alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    plain = plain.select("row", "doc_id", F.unhex(F.md5("text")).alias("key"), "text")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, "text"):
            bands, sigs = [], []
            for text in part.column("text").to_pylist():
                grams = shingles(text)
                if len(grams):
                    values = signature(grams)
                    bands.append(bands_of(values))
                    sigs.append(values.astype(np.uint8).tobytes())
                else:
                    bands.append([])
                    sigs.append(b"")
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), part.column("key"),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                ["row", "doc_id", "key", "bands", "sig"])

    signed = stored(plain.mapInArrow(
        sign, "row long, doc_id long, key binary, bands array<long>, sig binary"), "signed")
    first = signed.groupBy("key").agg(F.min("row").alias("row"))
    nodes = signed.join(first.drop("key"), "row").select(
        F.monotonically_increasing_id().alias("node"), "key", "row", "bands", "sig")
    return signed.select("row", "doc_id", "key"), stored(nodes, "classes")


def candidates(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(node, root): candidate groups, joined by pairs that share a bucket and pass pruning."""
    rows = nodes.select(F.explode("bands").alias("bucket"), "node")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = rows.join(shared, "bucket")
    cells = _in_blocks(members.join(nodes.select("node", "sig"), "node"), "bucket", "n", "node",
                       BUCKET_BLOCK)
    rules = pruning(threshold, tolerance)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u: list[int] = []
        v: list[int] = []
        for cell in runs(batches, ["bucket", "bi", "bj"]):
            if cell.num_rows > 1:
                node = cell.column("node").to_numpy()
                sig = np.frombuffer(b"".join(cell.column("sig").to_pylist()), np.uint8)
                sig = sig.reshape(len(node), -1)
                waiting = np.argsort(node)
                while len(waiting) > 1:  # breadth-first search of one component at a time
                    queue, waiting = [waiting[0]], waiting[1:]
                    root = node[queue[0]]
                    while queue and len(waiting):
                        i = queue.pop()
                        found = passing(sig[i], sig[waiting], rules)
                        if len(found):
                            queue += waiting[found].tolist()
                            u += node[waiting[found]].tolist()
                            v += [root] * len(found)
                            waiting = np.delete(waiting, found)
            if len(u) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()),
                                                  pa.array(v, pa.int64())], ["u", "v"])
                u, v = [], []
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())],
                                         ["u", "v"])

    return components(cells.mapInArrow(join, "u long, v long"))


def common_counts(sets: list[np.ndarray], rows: slice, columns: slice) -> np.ndarray:
    """Sizes of the pairwise intersections of sorted sets."""
    sizes = [len(s) for s in sets]
    values, local = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    often = np.bincount(local, minlength=len(values)) > 1
    local, owner = (np.cumsum(often) - 1)[local[often[local]]], owner[often[local]]
    total = int(often.sum())
    out = np.zeros((len(range(*rows.indices(len(sets)))), len(range(*columns.indices(len(sets))))))
    order = np.argsort(local, kind="stable")
    local, owner = local[order], owner[order]
    for start in range(0, total, 4096):
        a, b = np.searchsorted(local, [start, start + 4096])
        dense = np.zeros((len(sets), min(4096, total - start)), np.float32)
        dense[owner[a:b], local[a:b] - start] = 1
        out += dense[rows] @ dense[columns].T
    return out


def verified(docs: DataFrame, nodes: DataFrame, groups: DataFrame, row_col: str, text_col: str,
             threshold: float) -> DataFrame:
    """(node, links, root): links of each member found in a block pair, and a forest edge."""
    sizes = groups.groupBy("root").agg(F.count("*").alias("n")).where("n > 1")
    members = (groups.join(sizes, "root").withColumnRenamed("root", "grp")
               .join(nodes.select("node", "row"), "node"))
    texts = docs.select(F.col(f"`{row_col}`").alias("row"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    cells = _in_blocks(texts.join(members, "row").drop("row"), "grp", "n", "node", GROUP_BLOCK)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["grp", "bi", "bj"]):
            own = cell.column("own").to_numpy()
            order = np.argsort(own, kind="stable")
            cell, own = cell.take(pa.array(order)), own[order]
            node = cell.column("node").to_numpy()
            sets = [shingles(t) for t in cell.column("text").to_pylist()]
            size = np.array([len(s) for s in sets])
            cut = int(np.searchsorted(own, own[-1])) if own[0] != own[-1] else 0
            one_block = cell.column("bi")[0].as_py() == cell.column("bj")[0].as_py()
            if len(node) < 2 or (not one_block and cut == 0):
                continue
            rows, columns = (slice(None), slice(None)) if one_block else (
                slice(0, cut), slice(cut, None))
            common = common_counts(sets, rows, columns)
            union = size[rows][:, None] + size[columns][None, :] - common
            linked = common >= threshold * union - 1e-9
            if one_block:
                np.fill_diagonal(linked, False)
                links = linked.sum(1)
                full = linked
            else:
                links = np.concatenate([linked.sum(1), linked.sum(0)])
                full = np.zeros((len(node), len(node)), bool)
                full[:cut, cut:] = linked
                full[cut:, :cut] = linked.T
            root = np.arange(len(node))
            seen = np.zeros(len(node), bool)
            for i in np.argsort(node):
                if seen[i]:
                    continue
                seen[i], queue = True, [i]
                while queue:
                    j = queue.pop()
                    root[j] = i
                    new = np.flatnonzero(full[j] & ~seen)
                    seen[new] = True
                    queue += new.tolist()
            some = links > 0
            if some.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[some]), pa.array(links[some].astype(np.int64)),
                     pa.array(node[root[some]])], ["node", "links", "root"])

    return cells.mapInArrow(check, "node long, links long, root long")


def near_duplicates(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row of `docs`: row, doc_id, class_id, group_id, n_copies, n_links.

    `row_col` numbers the rows of `docs`, which must be a table that reads the same each time.
    class_id and group_id are the smallest ids of the rows with equal text, and of the connected
    group of similar texts. n_copies counts the rows of equal text, and n_links the other distinct
    texts of at least the threshold's similarity.
    """
    rows, nodes = classes(docs, row_col, id_col, text_col)
    groups = candidates(nodes, threshold, tolerance)
    found = stored(verified(docs, nodes, groups, row_col, text_col, threshold), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    ids = rows.groupBy("key").agg(F.min("doc_id").alias("class_id"),
                                  F.count("*").alias("n_copies"))
    known = (nodes.select("node", "key").join(ids, "key").join(links, "node", "left")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    of_group = known.groupBy("root").agg(F.min("class_id").alias("group_id"))
    described = known.join(of_group, "root").select(
        "key", "root", "class_id", "group_id", "n_copies",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    return rows.join(described, "key").drop("key")
