"""Near duplicates by SimHash: fingerprints at most two bits apart, found by Golay-code keys.

A text becomes words (maximal runs without ASCII white space, A-Z in lower case) and 3-word
shingles, repeats included; a shorter text is one shingle of all its words, and one without words
has the fingerprint zero. A bit of the fingerprint is set where more than half of the shingles'
XXH64 values (seed 42) have it.

1. Keys. The 64 bits are cut into three segments, each read as a word of the perfect binary Golay
   code of length 23 (short segments end in zeros). Every word has a codeword within three bits of
   it, and so has the word half way between two that differ by two bits; so two words at most two
   bits apart have a codeword within four bits of both. A segment is decoded to the indices of all
   codewords within four bits: one or six.
2. Pigeonhole. Of three segments with at most two errors in all, one is free of errors while the
   next one (the first after the third) has at most one or both. A key is such an exact segment
   with an index of the next one: 3 to 18 keys a fingerprint.
3. Join. Distinct fingerprints that share a key are compared exactly. Within a bucket of more than
   `BUCKET` of them, each deals itself out under all words one bit away (outside the exact
   segment) and its own. Two share such a word if and only if they are at most two bits apart, so
   the groups hold links only and at most 65 members, and work grows with the members of the
   bucket, not with their pairs.
4. Components of the links, by distributed star steps.

Rows of equal fingerprints are one node; rows of frequent fingerprints, keys and components are
joined without bringing them together in one task.

Defined cases: null text counts as empty; all texts without words are linked to each other and to
whatever is near zero; repeated rows and ties share their component; a null id is never the
smallest if another one is there, and a component of null ids alone has none; texts are read
whole; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, runs, stored
from tidemark.llm.components import components
from tidemark.llm.spread import frequent, join_spread

SEED = 42
WORDS = 3
DISTANCE = 2  # bits; the keys are complete up to this many
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # lowest bit and width
PAIRS = ((0, 1), (1, 2), (2, 0))  # exact and decoded segment of a key
BUCKET = 512  # fingerprints of one key up to which all are compared with each other

_LENGTH, _CHECK = 23, 11  # of the Golay code: bits, and check bits among them
_GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
_RADIUS = 4
_SOME = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(text: bytes) -> int:
    """Unsigned fingerprint of a text in UTF-8."""
    words = text.lower().split()  # both touch ASCII alone in bytes
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(WORDS))))
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _SOME):
        bits = np.unpackbits(h[i : i + _SOME].view(np.uint8), bitorder="little")
        ones += np.add.reduce(bits.reshape(-1, 64), axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of the division by the generator."""
    left = words.copy()
    for bit in range(_LENGTH - 1, _CHECK - 1, -1):
        left ^= (left >> bit & 1) * (_GENERATOR << bit - _CHECK)
    return left


def _patterns() -> np.ndarray:
    """By syndrome, the error patterns of at most `_RADIUS` bits: one, or six; -1 where absent."""
    found = np.full((1 << _CHECK, 6), -1, np.int64)
    for weight in range(_RADIUS + 1):
        errors = np.array([sum(1 << b for b in bits)
                           for bits in combinations(range(_LENGTH), weight)], np.int64)
        for error, syndrome in zip(errors, _syndromes(errors)):
            free = int((found[syndrome] >= 0).sum())
            found[syndrome, free] = error
    return found


_PATTERNS = _patterns()


def indices(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices of the codewords within four bits of 23-bit words, -1 where absent."""
    errors = _PATTERNS[_syndromes(words)]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> _CHECK)


def keys(prints: np.ndarray) -> np.ndarray:
    """(n, 18) keys of signed fingerprints, -1 where absent."""
    bits = prints.view(np.uint64)
    parts = [(bits >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
             for low, width in SEGMENTS]
    made = []
    for number, (exact, decoded) in enumerate(PAIRS):
        index = indices(parts[decoded])
        head = (number << 22 | parts[exact]) << _LENGTH - _CHECK
        made.append(np.where(index < 0, -1, head[:, None] | index))
    return np.concatenate(made, axis=1)


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fp").to_numpy()
        made = keys(prints)
        there = made >= 0
        owner = np.repeat(prints, there.sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(made[there]), pa.array(owner)], ["key", "fp"])


def forest(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to the least member of each connected group of distinct fingerprints."""
    near = np.bitwise_count((prints[:, None] ^ prints[None, :]).view(np.uint64)) <= DISTANCE
    root = np.arange(len(prints))
    if near.all():
        root[:] = prints.argmin()
    else:
        seen = np.zeros(len(prints), bool)
        for i in np.argsort(prints):
            if not seen[i]:
                group = near[i] & ~seen
                while True:
                    wider = near[group].any(0) & ~seen
                    if (wider == group).all():
                        break
                    group = wider
                root[group] = i
                seen |= group
    some = np.flatnonzero(root != np.arange(len(prints)))
    return prints[some], prints[root[some]]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    us, vs, held = [], [], 0
    for bucket in runs(batches, ["key"]):
        u, v = forest(bucket.column("fp").to_numpy())
        if len(u):
            us.append(u)
            vs.append(v)
            held += len(u)
        if held > 50_000:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])
            us, vs, held = [], [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])


def _one_bit_away(fp: Column, key: Column) -> Column:
    """`fp` and all words one bit away from it outside the exact segment of the key."""
    def outside(exact: int) -> Column:
        low, width = SEGMENTS[exact]
        flips = [1 << b for b in range(64) if not low <= b < low + width]
        signed = np.array([0, *flips], np.uint64).view(np.int64).tolist()
        return F.transform(F.array(*[F.lit(f) for f in signed]), lambda f: fp.bitwiseXOR(f))

    number = F.shiftright(key, 22 + _LENGTH - _CHECK)
    chosen = outside(PAIRS[0][0])
    for k in range(1, len(PAIRS)):
        chosen = F.when(number == k, outside(PAIRS[k][0])).otherwise(chosen)
    return chosen


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(u, v) pairs of distinct fingerprints `fp` whose components are those of all links."""
    members = nodes.select("fp").mapInArrow(_with_keys, "key long, fp long")
    counts = stored(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "keys")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    hot = F.broadcast(counts.where((F.col("n") > bucket) & frequent(F.col("n"), total))
                      .select("key"))  # bounded, see spread.py
    shared = members.join(hot, "key", "left_anti").join(counts, "key")
    small = (shared.where(F.col("n") <= bucket).select("key", "fp")
             .repartition("key").sortWithinPartitions("key"))
    large = shared.where(F.col("n") > bucket).select("key", "fp").unionByName(
        members.join(hot, "key"))
    met = large.select("fp", F.explode(_one_bit_away(F.col("fp"), F.col("key"))).alias("word"))
    stars = met.groupBy("word").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    stars = stars.select(F.explode("all").alias("u"), F.array_min("all").alias("v"))
    return small.mapInArrow(_compared, "u long, v long").unionByName(stars.where("u <> v"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    bucket: int = BUCKET) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (signed long), component_id.

    component_id is the smallest id of all rows that can be reached by links.
    """
    plain = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b"")).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, "text"):
            prints = [fingerprint(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))],
                ["doc_id", "fp"])

    rows = stored(plain.mapInArrow(sign, "doc_id long, fp long"), "prints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first"),
                                          F.count("*").alias("n")), "nodes")
    groups = components(links(nodes, bucket)).withColumnRenamed("node", "fp")
    known = stored(nodes.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp")),
                   "known")
    of_root = stored(known.groupBy("root").agg(F.min("first").alias("component_id"),
                                               F.count("*").alias("size")), "roots")
    total = of_root.agg(F.sum("size")).scalar()
    named = join_spread(known.drop("first"), of_root, "root", "size", total).drop("root")
    named = stored(named, "named")
    found = join_spread(rows, named, "fp", "n", named.agg(F.sum("n")).scalar())
    return found.select("doc_id", F.col("fp").alias("fingerprint"), "component_id")
